"""Repeated passages: words under any window of ``WINDOW`` words that occurs again.

1. Every window has one anchor, its 8 words with the least hash, so equal
   windows have equal anchors. Windows of a document in a row with the same
   anchor make a snippet. Anchors are written as a table without text.
2. Anchors that occur once are left out. Equal snippets of an anchor are
   combined, with their number. An anchor with one distinct snippet that
   occurs twice is repeated whole.
3. Of the other anchors the distinct snippets are the reference: it is
   sharded by anchor, each shard gets a suffix automaton that counts weighted
   occurrences, and the shard's snippets stream through it: windows whose
   matching statistics reach the window and that occur twice are repeated. An
   automaton over a corpus has no size bound, so automata go where their
   shard's snippets go instead of to every task; a shard holds at most
   ``SHARD`` snippets. Anchors with more are settled by counting their windows
   by a 128-bit digest, combined before the shuffle.
4. Repeated windows go back to their documents as spans, the union of which is
   removed.

Defined cases: a null or empty text has no words; a null id is carried as
null; repeated rows count as occurrences of their own, so their windows go; a
document with fewer words than a window loses none; an empty table gives an
empty result; long texts are read in blocks; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlstats.llm.common import documents, map_batches, words, written
from crawlstats.llm.suffix_automaton import SuffixAutomaton

WINDOW = 35
ANCHOR = 8
SHARD = 256
#: Windows of a text that are looked at together.
BLOCK = 1 << 16
#: A snippet's place: first window << 8 | number of windows (at most 28).
PLACE_BITS = 8
BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    @staticmethod
    def _grown(p: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        return p

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.up = self._grown(self.up, BASE, n)
        self.down = self._grown(self.down, pow(BASE, -1, 1 << 64), n)
        return self.up, self.down


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def snippets(own: list[bytes], powers: Powers, window: int = WINDOW, anchor: int = ANCHOR):
    """(anchor hash, snippet digest, first window, windows) arrays of a text's words, block by block."""
    for at in range(0, len(own) - window + 1, BLOCK):
        block = own[at : at + BLOCK + window - 1]
        joined = b" ".join(block)
        letters = np.frombuffer(joined, dtype=np.uint8)
        size = np.fromiter(map(len, block), np.int64, len(block))
        stop = np.cumsum(size + 1) - 1
        start = stop - size
        up, down = powers.upto(len(letters) + 1)
        prefix = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * up[: len(letters)], out=prefix[1:])
        first = start[: len(block) - anchor + 1]
        h = mixed((prefix[stop[anchor - 1 :]] - prefix[first]) * down[first])  # of each run of `anchor` words
        least = np.lib.stride_tricks.sliding_window_view(h, window - anchor + 1).argmin(axis=1)
        least += np.arange(len(least))
        cut = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        n = np.diff(np.r_[cut, len(least)])
        ends = stop[cut + n - 1 + window - 1].tolist()
        digest = [xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(start[cut].tolist(), ends)]
        yield h[least[cut]].view(np.int64), np.array(digest, dtype=np.uint64).view(np.int64), cut + at, n


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with (k, h), which tell rows apart but for repeated ones."""
    return docs.withColumns({"k": F.coalesce("doc_id", F.lit(0)), "h": F.xxhash64("text")})


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """(a, q, k, h, place) of every snippet, written."""

    def run(batches):
        powers = Powers()
        for b in batches:
            parts, rows = [], []
            for i, t in enumerate(b.column(2).cast(pa.binary())):
                for a, q, first, n in snippets(words(t.as_py()), powers, window):
                    parts.append((a, q, (first << PLACE_BITS) | n))
                    rows.append(np.full(len(a), i))
            if parts:
                a, q, place = (np.concatenate(c) for c in zip(*parts))
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(q), b.column(0).take(row), b.column(1).take(row), pa.array(place)], ["a", "q", "k", "h", "place"]
                )

    return written(map_batches(_keyed(docs).select("k", "h", "text"), run, "a long, q long, k long, h long, place long"), "anchors")


def _texts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(a, q, n, text, i, w): the words of each wanted snippet; for large shards the digest of each of its windows."""
    by_doc = wanted.groupBy("k", "h").agg(F.collect_list(F.struct("a", "q", "n", "place", "large")).alias("own"))
    # Rows that are equal in id and text hold the same snippets: one of them speaks for all.
    joined = _keyed(docs).select("k", "h", "text").join(by_doc, ["k", "h"]).dropDuplicates(["k", "h"]).select("text", "own")

    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
        names = ["a", "q", "n", "text", "i", "w"]
        out: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for b in batches:
            for t, own in zip(b.column(0).cast(pa.binary()), b.column(1)):
                if len(out) >= 1 << 14:
                    yield batch()
                    out.clear()
                w = words(t.as_py())
                for s in own.as_py():
                    first, n = s["place"] >> PLACE_BITS, s["place"] & ((1 << PLACE_BITS) - 1)
                    text = w[first : first + n + window - 1]
                    if not s["large"]:
                        out.append((s["a"], s["q"], s["n"], b" ".join(text), None, None))
                        continue
                    for i in range(n):
                        out.append((s["a"], s["q"], s["n"], None, i, xxhash.xxh3_128_digest(b" ".join(text[i : i + window]))))
        if out:
            yield batch()

    return written(map_batches(joined, run, "a long, q long, n long, text binary, i int, w binary"), "snippets")


def _by_automaton(texts: DataFrame, window: int) -> DataFrame:
    """(a, q, mask): bit i is set if window i of the snippet occurs twice among its anchor's."""

    def settle(a: int, group: list[tuple]):
        sam = SuffixAutomaton()
        split = [(q, n, words(text)) for q, n, text in group]
        for _, n, text in split:
            sam.add(text, n)
        sam.finish()
        for q, _, text in split:
            yield a, q, sum(1 << i for i, c in enumerate(sam.windows(text, window)) if c >= 2)

    def run(batches):
        held: list[tuple] = []
        anchor, out = None, []
        for b in batches:
            for a, q, n, text in zip(*[c.to_pylist() for c in b.columns]):
                if a != anchor and held:
                    out += settle(anchor, held)
                    held = []
                anchor = a
                held.append((q, n, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "q", "mask"])
                out = []
        if held:
            out = list(settle(anchor, held))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "q", "mask"])

    shards = texts.where("text is not null").select("a", "q", "n", "text").repartition("a").sortWithinPartitions("a")
    return map_batches(shards, run, "a long, q long, mask long")


def _by_count(texts: DataFrame) -> DataFrame:
    """(a, q, mask) of snippets in large shards, by their windows' digests."""
    each = texts.where("w is not null")
    twice = written(each.groupBy("a", "w").agg(F.sum("n").alias("n")).where("n >= 2").select("a", "w"), "repeated-windows")
    hit = each.select("a", "w", "q", "i").join(twice, ["a", "w"]).select("a", "q", "i")
    bit = F.expr("shiftleft(1L, i)")
    return written(hit, "hits").groupBy("a", "q").agg(F.bit_or(bit).alias("mask"))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k, h, own): per document key the places and masks of its repeated windows."""
    table = anchors(docs, window)
    twice = table.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("a")
    found = written(table.join(written(twice, "repeated-anchors"), "a"), "repeated")
    group = found.groupBy("a", "q").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "h", "place")).alias("rep"))
    group = written(group, "distinct-snippets")
    shard = written(group.groupBy("a").agg(F.count(F.lit(1)).alias("m")), "shards")
    sized = written(group.join(shard, "a").select("a", "q", "n", "rep", "m"), "sized-snippets")
    whole = sized.where("m = 1").select("a", "q", F.lit(-1).cast("long").alias("mask"))
    wanted = sized.where("m > 1").select("a", "q", "n", "rep.*", (F.col("m") > SHARD).alias("large"))
    texts = _texts(docs, wanted, window)
    masks = whole.unionByName(_by_automaton(texts, window)).unionByName(_by_count(texts)).where("mask <> 0")
    own = found.join(written(masks, "masks"), ["a", "q"]).select("k", "h", "place", "mask")
    return written(own, "repeated-places").groupBy("k", "h").agg(F.collect_set(F.struct("place", "mask")).alias("own"))


def removed(n_words: int, own: list[dict], window: int) -> np.ndarray:
    """Which words the repeated windows cover."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for s in own:
        first, n, mask = s["place"] >> PLACE_BITS, s["place"] & ((1 << PLACE_BITS) - 1), s["mask"]
        if mask == -1:  # all of them
            edge[first] += 1
            edge[first + n - 1 + window] -= 1
            continue
        for i in range(n):
            if mask >> i & 1:
                edge[first + i] += 1
                edge[first + i + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, text, kept, n_words, n_removed): ``kept`` is what is left, its words joined by one space."""
    d = documents(docs, id_col, text_col)
    return _without(d, repeated_windows(d, window), window).select("doc_id", "text", "kept", "n_words", "n_removed")


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The input's rows and columns; texts that lose words become what is left, the others stay as they are."""
    d = documents(docs, id_col, text_col)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("input")
    carried = docs.select(
        own, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    left = _without(carried, repeated_windows(d, window), window)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return left.select(*[text.alias(c) if c == text_col else F.col(f"input.`{c}`") for c in docs.columns])


def _without(docs: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """``docs`` with kept, n_words and n_removed."""
    joined = _keyed(docs).join(repeated, ["k", "h"], "left").select(*docs.columns, "own")
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            kept, total, gone = [], [], []
            for t, own in zip(b.column(at).cast(pa.binary()), b.column(b.num_columns - 1)):
                w = words(t.as_py())
                total.append(len(w))
                if own.is_valid:
                    drop = removed(len(w), own.as_py(), window)
                    gone.append(int(drop.sum()))
                    w = [x for x, d in zip(w, drop.tolist()) if not d]
                else:
                    gone.append(0)
                kept.append(b" ".join(w))
            found = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            names = [*b.schema.names[:-1], "kept", "n_words", "n_removed"]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *found], names)

    more = [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    schema = T.StructType([*docs.schema, *more])
    return map_batches(joined, run, schema)
