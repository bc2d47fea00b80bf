"""SimHash near-duplicates by segment popcounts and a grid join.

A fingerprint of 64 bits maps to the bit counts of its 32 two-bit segments.
The Manhattan distance of two such vectors is at most the number of differing
bits, so fingerprints within ``MAX_BITS`` = 3 lie within Manhattan distance
3, and in one half of the segments within 1. The grid has one cell per half
and vector of counts in it. A fingerprint is at home in two cells and probes
the neighbouring cells whose count is one higher; of two fingerprints one
higher count apart, the lower one probes the other's cell. Pairs that meet in
a cell pass the Manhattan bound over all segments and then the exact check.

Rows are combined to distinct fingerprints first, so copies cost nothing.
A task joins the linked fingerprints of its cells at once and returns one
link a fingerprint, never all pairs. Cells with more than ``LARGE`` rows are
divided over tasks by four blocks of 16 bits, in one of which near fingerprints
are equal. Parts that still have more, where pairs would grow with the square,
are settled exactly through the values near their fingerprints: two
fingerprints are within 3 bits if and only if a value is within 1 bit of one
and within 2 of the other.

Defined cases: a null or empty text has fingerprint zero, which links like any
other; a null id takes part in links, is ignored by component_id, which is
null only where all ids of a component are; repeated rows give repeated
results, and a repeated id with another text is a row with its own component;
very long texts are hashed whole, ``BLOCK`` shingles at a time; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import documents, map_batches, words, written
from crawlstats.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
#: Shingles hashed at once, so that a long text needs bounded memory.
BLOCK = 1 << 16
#: Rows of a cell up to which its pairs are compared one by one.
LARGE = 4096
ODD = np.uint64(0x5555555555555555)
NIBBLE = np.uint64(0x3333333333333333)
MIDDLE = np.uint64(0x4444444444444444)


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text; bit 63 is the highest."""
    own = words(text.lower())
    if not own:
        return 0
    k = min(shingle_words, len(own))
    size = np.fromiter(map(len, own), np.int64, len(own))
    joined, stop = b" ".join(own), np.cumsum(size + 1) - 1
    first, last = (stop - size)[: len(own) - k + 1].tolist(), stop[k - 1 :].tolist()
    digest, set_in = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), BLOCK):
        h = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK])])
        set_in += np.unpackbits(np.frombuffer(h, dtype=np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed long."""
    return _fingerprints(documents(docs, id_col, text_col), shingle_words)


def _fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``fp`` in place of the text."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column("text").cast(pa.binary())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(fp.view(np.int64))], [*names, "fp"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return map_batches(docs, run, f"{schema}, fp long")


def counts(fp: np.ndarray) -> np.ndarray:
    """The bit counts of the 32 segments, each in its own two bits."""
    return fp - ((fp >> np.uint64(1)) & ODD)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the absolute differences of the segments' counts."""
    total = np.zeros(len(a), dtype=np.int64)
    for shift in (np.uint64(0), np.uint64(2)):
        lanes = ((a >> shift) & NIBBLE) + MIDDLE - ((b >> shift) & NIBBLE)  # 4 + difference in four bits
        total += _LANES[lanes.view(np.uint8)].reshape(-1, 8).sum(axis=1)
    return total


_LANES = np.array([abs((x & 15) - 4) + abs((x >> 4) - 4) for x in range(256)], dtype=np.int64)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, row of fp, probe): two home cells a fingerprint, and the cells one count higher."""
    v, rows = counts(fp), np.arange(len(fp))
    cell, row, probe = [], [], []
    for half in (0, 1):
        own = ((v >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64) + (half << 32)
        cell.append(own)
        row.append(rows)
        probe.append(np.zeros(len(fp), dtype=bool))
        for i in range(16):
            room = ((own >> (2 * i)) & 3) < 2
            cell.append(own[room] + (1 << (2 * i)))
            row.append(rows[room])
            probe.append(np.ones(int(room.sum()), dtype=bool))
    return np.concatenate(cell), np.concatenate(row), np.concatenate(probe)


class Joined:
    """Disjoint sets over the distinct fingerprints of a block of cells."""

    def __init__(self, fp: np.ndarray):
        self.fp, self.node = np.unique(fp, return_inverse=True)
        self.root = np.arange(len(self.fp))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.node[a], self.node[b]
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def link_small(cell: np.ndarray, fp: np.ndarray, v: np.ndarray, home: np.ndarray, sets: Joined) -> None:
    """Compares each home row with the rows after it in its cell (homes come first)."""
    i, step = np.flatnonzero(home), 0
    while len(i):
        step += 1
        i = i[i + step < len(cell)]
        i = i[cell[i + step] == cell[i]]
        j = i + step
        near = manhattan(v[i], v[j]) <= MAX_BITS
        a, b = i[near], j[near]
        exact = np.bitwise_count(fp[a] ^ fp[b]) <= MAX_BITS
        sets.link(a[exact], b[exact])


_ONE = np.concatenate([np.zeros(1, dtype=np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
_TWO = np.concatenate([_ONE, np.array([(1 << i) | (1 << j) for i in range(64) for j in range(i)], dtype=np.uint64)])


def link_large(fp: np.ndarray, rows: np.ndarray, sets: Joined) -> None:
    """Links all rows within 3 bits, in work proportional to their number."""
    near = (fp[rows][:, None] ^ _ONE).ravel()
    order = np.argsort(near, kind="stable")
    near, owner = near[order], np.repeat(rows, len(_ONE))[order]
    same = near[1:] == near[:-1]
    sets.link(owner[1:][same], owner[:-1][same])
    for at in range(0, len(rows), 512):
        part = rows[at : at + 512]
        far = (fp[part][:, None] ^ _TWO).ravel()
        k = np.minimum(np.searchsorted(near, far), len(near) - 1)
        hit = near[k] == far
        sets.link(np.repeat(part, len(_TWO))[hit], owner[k[hit]])


def link_cells(cell: np.ndarray, fp: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): links that join the near fingerprints of whole cells; rows sorted by cell, homes first."""
    sets = Joined(fp)
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[start, len(cell)])
    large = size > LARGE
    small = ~np.repeat(large, size)
    link_small(cell[small], fp[small], counts(fp[small]), ~probe[small], _Rows(sets, np.flatnonzero(small)))
    for a, n in zip(start[large].tolist(), size[large].tolist()):
        link_large(fp, np.arange(a, a + n), sets)
    u = np.flatnonzero(sets.root != np.arange(len(sets.root)))
    return sets.fp[u], sets.fp[sets.root[u]]


class _Rows:
    """Links between a selection of the rows."""

    def __init__(self, sets: Joined, rows: np.ndarray):
        self.sets, self.rows = sets, rows

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.sets.link(self.rows[a], self.rows[b])


def near_links(fps: DataFrame) -> DataFrame:
    """(u, v): links that connect exactly the distinct fingerprints ``fp`` within 3 bits of each other."""

    def spread(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fp), 1 << 12):
                block = fp[at : at + (1 << 12)]
                cell, row, probe = cells(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(block[row].view(np.int64)), pa.array(probe)], ["cell", "fp", "probe"]
                )

    def join(batches):
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def out(columns):
            u, v = link_cells(*columns)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        def stack():
            return [np.concatenate(c) for c in zip(*held)]

        for b in batches:
            if not b.num_rows:
                continue
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(zero_copy_only=False)))
            rows += b.num_rows
            if rows >= 1 << 17:
                columns = stack()
                cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last cell may go on
                if cut:
                    yield out([c[:cut] for c in columns])
                held, rows = [tuple(c[cut:] for c in columns)], len(columns[0]) - cut
        if rows:
            yield out(stack())

    spread_out = map_batches(fps.select("fp"), spread, "cell long, fp long, probe boolean")
    large = written(spread_out.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE).select("cell"), "large-cells")
    small = spread_out.join(large, "cell", "left_anti")
    # Fingerprints within 3 bits are equal in one of four blocks of 16 bits, so the
    # rows of a large cell that agree in a block can meet apart from the others.
    block = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.shiftright("fp", 16 * i).bitwiseAND(0xFFFF).alias("bits")) for i in range(4)]))
    parts = spread_out.join(large, "cell", "left_semi").select("cell", "fp", "probe", block.alias("block"))
    parts = parts.select(F.xxhash64("cell", "block.i", "block.bits").alias("cell"), "fp", "probe")
    links = [map_batches(rows.repartition("cell").sortWithinPartitions("cell", "probe"), join, "u long, v long") for rows in (small, parts)]
    return links[0].union(links[1])


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows, one of each component; rows with a null id all stay.

    The row that stays has the component's smallest id; of several with that
    id it is the first staged. Rows are told apart by the place they are staged
    at, so a repeated id with another text is judged by its own component.
    """
    staged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input"))
    staged = written(staged.withColumn("place", F.monotonically_increasing_id()), "near-rows")
    texts = staged.select(F.col(f"input.`{id_col}`").alias("doc_id"), F.col(f"input.`{text_col}`").alias("text"), "place")
    own = written(_fingerprints(documents(texts, keep=("place",)), SHINGLE_WORDS), "fingerprints")
    near = own.where("doc_id is not null").join(_known(own).where("n_near > 1"), "fp").select("root", "doc_id", "place")
    near = written(near, "near")
    keep = near.groupBy("root").agg(F.min(F.struct("doc_id", "place")).alias("keep"))
    gone = near.join(keep, "root").where(F.col("place") != F.col("keep.place")).select("place")
    return staged.join(gone, "place", "left_anti").select("input.*")


def _known(own: DataFrame) -> DataFrame:
    """(fp, root, component_id, n_near) of the distinct fingerprints in (doc_id, fp); ``root`` names the component."""
    distinct = written(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    star = components(near_links(distinct))
    root = star.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = written(distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("n_near")), "least")
    return written(rooted.join(least, "root").select("fp", "root", "component_id", "n_near"), "known")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, component_id, n_near): each row with the smallest id it reaches; n_near rows share its component."""
    own = written(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words), "fingerprints")
    return own.join(_known(own), "fp").select("doc_id", "fp", "component_id", "n_near")
