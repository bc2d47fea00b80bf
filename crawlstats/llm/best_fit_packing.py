"""Best-fit packing of tokenised documents into sequences.

Documents become pieces of at most ``capacity`` tokens in one pass that
writes a small table (no text in it). The packing itself is decided on the
histogram of piece lengths, at most ``capacity`` numbers, by bin completion
(``bin_completion``). Each piece then finds its place by its rank among the
pieces of its length: the first pass numbers the pieces of a length within
each task, a small table of counts turns that into a global rank, and the
rank selects pattern, bin and slot. Nothing is sorted, and no length, however
frequent, meets in one task.

Defined cases: a null or empty text is the end token alone; a null id is
carried as null; repeated rows are packed once each; ties of length go in the
order of the written pieces; an empty table gives no pieces; very long texts
are cut into pieces; other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlstats.llm.bin_completion import Pattern, solve
from crawlstats.llm.byte_bpe import SharedBpe
from crawlstats.llm.common import documents, map_batches, written

RANK_BITS = 44  # a slot's key is length * 2**RANK_BITS + first rank
PIECE = "doc_id long, piece int, start long, length int, {}, part int, nth long"
CARRIED = {"ids": "ids binary", "crc32": "ids_crc32 long"}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, *, carry: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents, as a written table.

    ``carry`` is ``ids`` (little-endian unsigned 32-bit ids) or ``crc32``
    (their checksum only, for callers that do not need the ids). ``part`` and
    ``nth`` number the pieces of a length within a task. A document's first
    piece is the shorter one.
    """
    bpe = SharedBpe(docs.sparkSession, tokenizer)
    end = int(end_id).to_bytes(4, "little")
    carried = CARRIED[carry]

    def cut(batches):
        enc, part, seen = bpe.encoder(), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            doc, piece, start, length, content, nth = rows
            for d, text in zip(batch.column(0), batch.column(1)):
                ids, d = enc.ids(text.as_py()) + end, d.as_py()
                n = len(ids) // 4
                at, stop = 0, n % capacity or capacity
                for k in range(-(-n // capacity)):
                    own = ids[4 * at : 4 * stop]
                    size = stop - at
                    doc.append(d)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    content.append(own if carry == "ids" else zlib.crc32(own))
                    nth.append(int(seen[size]))
                    seen[size] += 1
                    at, stop = stop, stop + capacity
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary() if carry == "ids" else pa.int64(), pa.int64())
            doc, piece, start, length, content, nth = (pa.array(r, k) for r, k in zip(rows, kinds))
            same = pa.array(np.full(len(doc), part, dtype=np.int32))
            names = ["doc_id", "piece", "start", "length", carried.split()[0], "part", "nth"]
            yield pa.RecordBatch.from_arrays([doc, piece, start, length, content, same, nth], names)

    return written(map_batches(documents(docs, id_col, text_col), cut, PIECE.format(carried)), "pieces")


class Slots:
    """Where the r-th piece of a length goes; as many entries as the patterns have lengths."""

    def __init__(self, patterns: list[Pattern]):
        entries, first_bin, used = [], 0, {}
        for filling, bins in patterns:
            at = 0
            for length, k in filling:
                rank = used.get(length, 0)
                entries.append(((length << RANK_BITS) + rank, first_bin, k, at, length))
                used[length] = rank + k * bins
                at += k * length
            first_bin += bins
        columns = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5).T
        self.key, self.first_bin, self.each, self.at, self.length = columns

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << RANK_BITS) + rank
        i = np.searchsorted(self.key, key, side="right") - 1
        b, slot = np.divmod(key - self.key[i], self.each[i])
        return self.first_bin[i] + b, self.at[i] + slot * self.length[i]


def pack(cut: DataFrame, capacity: int, max_nodes: int = 200_000) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, in as few sequences as the search finds."""
    spark = cut.sparkSession
    by_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    slots = spark.sparkContext.broadcast(Slots(solve(counts, max_nodes)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(offsets, ["length", "part"])
    names = [c for c in cut.columns if c not in ("part", "nth")]
    ranked = ranked.select(*names, (F.col("earlier") + F.col("nth")).alias("rank"))

    def place(batches):
        s = slots.value
        for b in batches:
            t = pa.table(b)
            seq, off = s.find(t["length"].to_numpy(), t["rank"].to_numpy())
            yield from t.drop(["rank"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off)).to_batches()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return map_batches(ranked, place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` pieces
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")
    )


def best_fit_packing(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, *, carry: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer, end_id, capacity, carry=carry, id_col=id_col, text_col=text_col), capacity)
