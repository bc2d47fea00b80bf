"""Personal data: base spans and the random field against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlstats.llm import pii
from crawlstats.llm.crf import NEVER, OUTSIDE, Crf, Features, coarse_shape, fine_shape

PLAIN_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_base(text):
    out = []
    for kind, pattern in PLAIN_PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d or "1"),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def found(text):
    return [(k, a, b) for k, spans in pii.base_spans(text).items() for a, b in spans]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1205.@+- ()_é\n%", max_size=40))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert found(text) == brute_base(text)


def test_base_spans_by_hand():
    text = "a@b.c_d@e.f 4111 1111 1111 1111, +1 (017) 555-7713; 256.1.1.1 10.0.0.255 x@y 1.2.3.4.5.6.7.8 é+49 30 1234567"
    assert found(text) == brute_base(text)
    assert [k for k, _, _ in found(text)] == ["email", "email", "ip", "ip", "ip", "card", "phone", "phone"]


def test_long_runs_take_linear_time():
    for run in ["a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "a@" * 100_000, "+1" * 100_000, "+1" + "(" * 200_000, "1 " * 100_000 + "."]:
        pii.base_spans(run)
        list(pii.runs(run))


def every_run(text):
    """Runs by splitting into all words."""
    words = [(m.start(), m.end(), re.search("[0-9@+]", m.group()) is not None) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out = []
    for special, group in itertools.groupby(enumerate(words), key=lambda x: x[1][2]):
        group = list(group)
        if special:
            out.append(([w[:2] for _, w in group], "#" if group[0][0] == 0 else "a", "#" if group[-1][0] == len(words) - 1 else "a"))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1@+ \n\x1c.", max_size=40))
def test_runs_are_the_words_with_digits_at_or_plus(text):
    assert list(pii.runs(text)) == every_run(text)


def small_model(seed, kinds=("x", "y")):
    draw = np.random.default_rng(seed)
    features = Features(Counter({"9": 5, "a9": 4, "99": 3, "a": 9, "#": 2}))
    m = Crf(kinds, features)
    m.weights[:] = draw.normal(size=m.weights.shape)
    m.transitions[:] = draw.normal(size=m.transitions.shape)
    return m


def scored(m, chain, path):
    t, moves = m.table(list(chain)), m.moves()
    p = [OUTSIDE, *path, OUTSIDE]
    s = sum(moves[a, b] for a, b in zip(p, p[1:]))
    return s + sum(t[0, i][y] + t[1, i + 1][y] + t[2, i + 2][y] for i, y in enumerate(path))


def every_path(m, chain):
    return [(scored(m, chain, p), p) for p in itertools.product(range(len(m.labels)), repeat=len(chain) - 2)]


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_finds_the_best_of_all_paths(seed):
    m, rng = small_model(seed), random.Random(seed)
    chains = [tuple(rng.choice(["9", "a9", "99", "a", "#", "?"]) for _ in range(rng.randrange(3, 8))) for _ in range(25)]
    for chain, got in zip(chains, m.decode(chains, words=20)):
        assert tuple(got) == max(every_path(m, chain))[1]


def test_expected_counts_are_those_over_all_paths():
    m = small_model(3)
    chain = ("a", "9", "a9", "99", "9", "#")
    paths = [(s, p) for s, p in every_path(m, chain) if s > NEVER / 2]
    z = np.array([s for s, _ in paths])
    weight = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    k = len(m.labels)
    label, move = np.zeros((4, k)), np.zeros((k, k))
    for w, (_, p) in zip(weight, paths):
        label[range(4), p] += w
        for a, b in zip([OUTSIDE, *p], [*p, OUTSIDE]):
            move[a, b] += w
    t = m.table(list(chain))
    score = (t[0, :-2] + t[1, 1:-1] + t[2, 2:])[None]
    got_label, got_move = m._expected(np.concatenate([score, score]), np.ones((2, 4), dtype=bool), np.array([4, 4]))
    assert np.allclose(got_label[0], label) and np.allclose(got_move, 2 * move)


def test_shapes():
    assert [fine_shape(w) for w in ["+1", "(017)", "555-7713", "die.55@mail4.example.com", "1234567890", "é!!"]] == ["+9", "(999)", "999-9999", "a.99@a9.a.a", "99999", "a!"]
    assert [coarse_shape(s) for s in ["999.99.99.999,", "a.99@a9.a.a", "99999", "!"]] == ["9.9", "a.9@a9.a.a", "9", "!"]


def corpus(n, seed=0):
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        while not luhn(d := digits(16)):
            pass
        return d

    make = [lambda: f"ab.{digits(2)}@mail{digits(1)}.example.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), card, lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"version {digits(1)}.0", lambda: digits(6)]
    return [" ".join(rng.choice(["word", "other,", "and"]) + " " + rng.choice(make)() for _ in range(rng.randrange(1, 5))) + " end" for _ in range(n)], card


def test_neighbours_that_patterns_take_for_one_are_found(spark):
    texts, card = corpus(400)
    a, b = card(), card()
    hard = [f"see {a} {b} now", f"call +1 (826) 555-4081 190.137.223.204 now", f"x {a} y", "plain words only", f"call (826) 555-4081 now", "in 2021 and 1999-12-31 at 10:30"]
    docs = spark.createDataFrame(list(enumerate(texts + hard)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in pii.personal_data(docs).collect()}
    for i, t in enumerate(texts):
        assert [s[:3] for s in got[i] if s[3]] == brute_base(t)
    k = len(texts)
    assert got[k] == [("card", 4, 20, False), ("card", 21, 37, False)]
    assert got[k + 1] == [("ip", 23, 38, True), ("phone", 5, 22, False)]
    assert got[k + 2] == [("card", 2, 18, True)]
    assert got[k + 3] == [] and got[k + 5] == []
    assert got[k + 4] == [("phone", 5, 19, False)]


def test_hard_and_empty_tables(spark, hard_documents, no_documents):
    text = "mail a.b@c.example.com and +1 (017) 555-7713 " + "1 " * 30_000
    more = spark.createDataFrame([(70, text), (70, text), (71, "+1 " * 5000)], "doc_id long, text string")
    docs = hard_documents.unionByName(more, allowMissingColumns=True)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == docs.count()
    long = [r.spans for r in rows if r.doc_id == 70]
    assert long[0] == long[1] and [(s.kind, s.start, s.end) for s in long[0] if s.base] == brute_base(text)
    assert pii.personal_data(no_documents).collect() == []


def test_query_lists_base_and_all_spans(spark):
    from crawlstats.llm.queries import queries

    rows = queries()["op12_personal_data"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        base = [f"{k}:{a}:{b}" for k, a, b in brute_base(docs[r.doc_id])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in PLAIN_PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""} or not base
