"""op3, op4, op6: against the libraries, brute force and round trips."""

import struct
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from crawlstats.llm import best_fit_packing as P
from crawlstats.llm import bin_completion as B
from crawlstats.llm import sentencepiece_coding as S
from crawlstats.llm.byte_bpe import WholeTokenBpe, prove_whole
from crawlstats.llm.pieces import PieceModel, read_model
from crawlstats.llm.token_counts import over_limit, token_counts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab AB 'sT re\n\t0129.,éß中\U0001f600▁ \x85\x1c<|>"), st.characters(codec="utf-8")), max_size=40)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def own():
    spec = open(BPE, encoding="utf-8").read()
    return WholeTokenBpe(spec, prove_whole(spec))


@pytest.fixture(scope="module")
def model():
    return PieceModel(read_model(PIECES))


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_bpe_equals_the_library(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.count(text) == len(ids)
    assert list(struct.unpack(f"<{len(ids)}I", own.ids(text))) == ids


def test_special_strings_and_latin1_bounds(library, own):
    for text in ("<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", *(f"a{chr(c)}b {chr(c)}\n{chr(c)}" for c in range(256))):
        assert list(struct.unpack(f"<{own.count(text)}I", own.ids(text))) == library.encode(text, add_special_tokens=False).ids


def test_token_counts(spark, library, hard_documents, no_documents):
    rows = over_limit(token_counts(hard_documents, BPE), 512).collect()
    exp = Counter()
    for r in hard_documents.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        exp[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == exp
    assert token_counts(no_documents, BPE).collect() == []


# --- packing -------------------------------------------------------------------------

def used(patterns, cap):
    counts = np.zeros(cap + 1, dtype=np.int64)
    for filling, n in patterns:
        assert n > 0 and sum(x * k for x, k in filling) <= cap
        for x, k in filling:
            counts[x] += k * n
    return counts


def fewest(items, cap):
    """The fewest bins, by trying all ways."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in {b for b in bins if b >= items[i]}:
            rest = list(bins)
            rest.remove(room)
            place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*bins, cap - items[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9), st.integers(12, 14))
def test_bin_completion_is_optimal_on_small_cases(items, cap):
    counts = np.bincount(np.array(items, dtype=np.int64), minlength=cap + 1)
    patterns = B.solve(counts)
    assert (used(patterns, cap) == counts).all()
    bins = sum(n for _, n in patterns)
    assert B.lower_bound(counts) <= bins == fewest(sorted(items, reverse=True), cap)


@pytest.mark.parametrize("seed", range(4))
def test_bin_completion_is_optimal_on_random_cases(seed):
    rng = np.random.default_rng(seed)
    for _ in range(1250):
        cap = int(rng.choice([10, 12, 14, 20, 54, 100, 1024]))
        low, high = int(rng.choice([1, cap // 8 + 1, cap // 5])), int(rng.choice([cap, cap // 2, cap // 3]))
        items = rng.integers(low, max(low, high) + 1, rng.integers(1, 14))
        if rng.random() < 0.4:  # few lengths, many times
            items = rng.choice(items[:3], len(items))
        counts = np.bincount(items, minlength=cap + 1)
        patterns = B.solve(counts)
        assert (used(patterns, cap) == counts).all()
        assert sum(n for _, n in patterns) == fewest(sorted(items.tolist(), reverse=True), cap), (cap, sorted(items.tolist()))


def test_bin_completion_gives_a_filling_to_some_of_the_bins_it_could_have():
    counts = np.bincount([10, 12, 10, 11, 11, 10, 12, 10, 11, 11], minlength=55)
    assert sum(n for _, n in B.solve(counts)) == 2


@pytest.mark.parametrize("low,high,cap", [(1, 1024, 1024), (300, 700, 1024), (1, 3, 1024), (1024, 1024, 1024), (1, 40, 100)])
def test_bin_completion_on_many_items(low, high, cap):
    counts = np.bincount(np.random.default_rng(1).integers(low, high + 1, 20000), minlength=cap + 1)
    patterns = B.solve(counts, max_nodes=2000)
    assert (used(patterns, cap) == counts).all()
    best_fit = B.best_fit_decreasing(counts)
    assert (used(best_fit, cap) == counts).all()
    assert B.lower_bound(counts) <= sum(n for _, n in patterns) <= sum(n for _, n in best_fit)


def test_packing(spark, library, hard_documents, no_documents):
    cap, end = 64, 2
    rows = P.best_fit_packing(hard_documents, BPE, end, cap).collect()
    exp = Counter()
    for d in hard_documents.collect():
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, end]
        first = len(ids) % cap or cap
        for k, start in enumerate([0, *range(first, len(ids), cap)]):
            stop = first if k == 0 else start + cap
            exp[d.doc_id, k, start, struct.pack(f"<{stop - start}I", *ids[start:stop])] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows) == exp
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for pieces in bins.values():
        at = 0
        for offset, length, ids in sorted(pieces):
            assert offset == at and len(ids) == 4 * length
            at += length
        assert at <= cap
    counts = np.bincount([r.length for r in rows], minlength=cap + 1)
    assert len(bins) == sum(n for _, n in B.solve(counts))
    packed = P.best_fit_packing(hard_documents, BPE, end, cap)
    whole = {s: b"".join(ids for _, _, ids in sorted(p)) for s, p in bins.items()}
    assert {len(r.ids) for r in P.sequences(packed).collect()} == {len(w) for w in whole.values()}
    light = P.best_fit_packing(hard_documents, BPE, end, cap, carry="crc32").collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in light) == Counter((r.doc_id, r.piece, zlib.crc32(bytes(r.ids))) for r in rows)
    assert P.best_fit_packing(no_documents, BPE, end, cap).collect() == []


# --- SentencePiece ---------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_pieces_equal_the_library(model, text):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = model.encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == sp.encode(text)
    if "▁" not in text:
        assert model.decode(ids) == text


def test_long_stretches_commit_as_they_go(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in ("abcdeinotrsh" * 900, "a" * 3000, " " * 100 + "the", "中文" * 500, "x" + " " * 40):
        ids = model.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == sp.encode(text)


def test_unigram_viterbi_takes_the_best_sum():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("ba", -3.2, 1), ("▁a", -3.5, 1), ("aba", -5.1, 1)]
    m = PieceModel({"pieces": pieces, "kind": 1, "prefix": True, "suffix": False, "bytes": False})
    score = {p: s for p, s, _ in pieces[1:]}

    def best(text):
        found = (float("-inf"), None)
        for cuts in product((0, 1), repeat=len(text) - 1):
            parts, at = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(text[at:i])
                    at = i
            if all(p in score for p in parts):
                found = max(found, (sum(score[p] for p in parts), parts))
        return found

    for n in range(1, 9):
        for letters in product("ab", repeat=n):
            text = "".join(letters)
            ids = m.encode(text)
            got = [m.text_of[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)]
            assert "".join(got) == "▁" + text
            assert sum(score[p] for p in got) == pytest.approx(best("▁" + text)[0])


def test_sentencepiece_operator(spark, hard_documents, no_documents):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = S.encode(hard_documents, PIECES)
    got = Counter((r.doc_id, tuple(struct.unpack(f"<{r.n_tokens}I", r.ids)), r.round_trip) for r in rows.collect())
    assert got == Counter((r.doc_id, tuple(sp.encode(r.text or "")), True) for r in hard_documents.collect())
    back = Counter((r.doc_id, r.text) for r in S.decode(rows, PIECES).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in hard_documents.collect())
    assert S.encode(no_documents, PIECES).collect() == []
