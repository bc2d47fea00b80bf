"""Exact top-k inner products by no-random-access aggregation.

Candidates stay where they are read and are cut into blocks there. In a block
there is one list per dimension, sorted by that component; a query reads it
from its high end where its own component is positive and from its low end
where it is negative. A round of the block reads all lists to a depth, in
order, for all queries of a block at once. What has been read of a candidate
gives its partial score; for the rest the last value read bounds it from above
and the list's far end from below. A candidate whose upper bound is below the
k-th lower bound, or below the k-th score that the task has found for the query
so far, cannot qualify. When few are left, or the lists are read, their final
scores are computed and merged into the query's running list of the k best.

The stated queries come to the candidates in rounds of about ``ROUND_BYTES``,
each a broadcast; only the k best of each query and task are shuffled.

Defined cases: vectors that are null, or hold null or non-finite components,
and rows with a null id take no part; a query's own row is any row with its
id; of a repeated query id the smallest vector asks; a vector only meets
vectors of its length; ties go to the smaller id, repeated rows are separate
candidates; an empty table gives an empty result; other columns are not read.
Components are integers of any size: vectors with large ones (``plain``) are
scored in Python integers and rank exactly, and a score that no long holds is
null. A component that overflows a double when scaled is an integer as it is
and scaled as one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlstats.llm.common import map_batches, pick, written

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 512
#: Bytes of queries that a round brings to all candidates.
ROUND_BYTES = 16 << 20
#: Depths of the rounds, as shares of the lists.
DEPTHS = (0.25, 0.5, 0.75)
EXACT_FLOAT = 2.0**53


def taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    d = pick(vectors, vec_id=id_col, v=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return d.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles; infinite where that is no double."""
    with np.errstate(over="ignore"):
        x = float(scale) * x
    return np.where(np.abs(x) < EXACT_FLOAT, np.floor(x), x)  # larger doubles are integers


def as_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers."""
    whole = zip(x.ravel().tolist(), quantised(x, scale).ravel().tolist())
    return np.array([int(q) if math.isfinite(q) else int(c) * scale for c, q in whole], dtype=object).reshape(x.shape)


def plain(x: np.ndarray) -> np.ndarray:
    """Rows whose products with each other are exact in doubles."""
    return np.abs(x).max(axis=1, initial=0) < math.sqrt(EXACT_FLOAT / max(1, x.shape[1])) - 1


#: Rows that are Python integers at a time.
INTEGER_ROWS = 1024


def integer_top(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, scale: int = 1) -> tuple[list, list, list]:
    """(query_id, vec_id, score) as Python integers: per query the k best of each ``INTEGER_ROWS`` candidates."""
    found: list[tuple[int, int, int]] = []
    asked = as_integers(q, scale)
    for at in range(0, len(ids), INTEGER_ROWS):
        own, part = ids[at : at + INTEGER_ROWS].tolist(), as_integers(x[at : at + INTEGER_ROWS], scale)
        for query, v in zip(query_ids.tolist(), asked):
            scored = zip((part @ v).tolist() if x.shape[1] else [0] * len(own), own)
            best = heapq.nsmallest(k, ((-s, i) for s, i in scored if i != query))
            found += [(query, i, -s) for s, i in best]
    return tuple(map(list, zip(*found))) if found else ([], [], [])


def beyond(s: int) -> tuple[int | None, int, bytes | None]:
    """(score, side, order) of a score: one that no long holds is on a side of all others, in the order of the bytes."""
    if -(1 << 63) <= s < 1 << 63:
        return s, 0, None
    size = (s.bit_length() + 7) // 8
    order = size.to_bytes(2, "big") + abs(s).to_bytes(size, "big")
    return (None, 1, order) if s > 0 else (None, -1, bytes(255 - b for b in order))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer matrix product; in doubles where all sums fit."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]))
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < EXACT_FLOAT:
        return a.astype(np.float64) @ b.astype(np.float64)
    return a @ b


class SortedLists:
    """The candidates of a block: one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        by_value = np.argsort(self.x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, by_value, axis=0)
        self.place = np.empty_like(by_value)
        np.put_along_axis(self.place, by_value, np.arange(len(ids))[:, None], axis=0)

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores (candidates x queries) after ``depth`` entries of each list."""
        n = len(self.ids)
        lower = upper = 0
        for part, read, frontier, far, bounded in (
            (np.maximum(q, 0), self.place >= n - depth, self.sorted[n - depth], self.sorted[0], np.maximum),
            (np.minimum(q, 0), self.place < depth, self.sorted[depth - 1], self.sorted[-1], np.minimum),
        ):
            # What is not read lies beyond the last value read, what is read does not.
            upper = upper + product(bounded(self.x, frontier), part.T)
            lower = lower + product(np.where(read, self.x, far), part.T)
        return lower, upper

    def into(self, best: Best, k: int) -> None:
        """Merge this block's candidates into the lists of the k best of each query."""
        n, q, query_ids = len(self.ids), best.q, best.ids
        few = max(4 * k, n // 64)
        alive = self.ids[:, None] != query_ids[None, :]
        todo = np.arange(len(query_ids))
        for share in DEPTHS:
            depth = int(n * share)
            if not len(todo) or n <= few or not depth:
                break
            lower, upper = self.bounds(q[todo], depth)
            lower = np.where(alive[:, todo], lower, -np.inf)
            kth = np.partition(lower, n - k, axis=0)[n - k]  # n > 4 k here
            alive[:, todo] &= upper >= np.maximum(kth, best.least[todo])
            todo = todo[alive[:, todo].sum(axis=0) > few]
        scores = dict(zip(todo.tolist(), product(self.x, q[todo].T).T))  # lists read to their end
        for j in range(len(query_ids)):
            left = np.flatnonzero(alive[:, j])
            s = scores[j][left] if j in scores else product(self.x[left], q[j][:, None])[:, 0]
            best.add(j, s.astype(np.int64), self.ids[left], k)


class Best:
    """A block of queries with the k best candidates that a task has found for each."""

    def __init__(self, query_ids: np.ndarray, q: np.ndarray):
        self.ids, self.q = query_ids, q
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64),) * 2] * len(query_ids)
        #: Score below which no candidate qualifies.
        self.least = np.full(len(query_ids), -np.inf)

    def add(self, j: int, scores: np.ndarray, ids: np.ndarray, k: int) -> None:
        s, i = (np.concatenate(c) for c in zip(self.found[j], (scores, ids)))
        if len(s) > k:
            keep = s >= np.partition(s, len(s) - k)[len(s) - k]
            s, i = s[keep], i[keep]
        order = np.lexsort((i, -s))[:k]
        self.found[j] = s[order], i[order]
        if len(order) == k:
            self.least[j] = s[order[-1]]


def _by_length(ids: np.ndarray, v: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, ids, x) of the vectors of each length."""
    size = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
    flat, start = v.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(size)]
    for dims in np.unique(size).tolist():
        rows = np.flatnonzero(size == dims)
        yield dims, ids[rows], flat[(start[rows][:, None] + np.arange(dims)).ravel()].reshape(len(rows), dims)


class Round:
    """The queries of a round in a task, and what has been found for them."""

    def __init__(self, asked: list[tuple[int, list[float]]], k: int, scale: int):
        self.k, self.scale = k, scale
        #: dims -> query blocks of exact products; ids and vectors of the others
        self.blocks: dict[int, list[Best]] = {}
        self.large: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.plain: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: candidates that wait for their block to fill
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        if not asked:
            return
        ids, v = zip(*asked)
        for dims, own, x in _by_length(np.array(ids, dtype=np.int64), pa.array(v, pa.list_(pa.float64()))):
            whole = quantised(x, scale)
            small = plain(whole)
            self.large[dims], self.plain[dims] = (own[~small], x[~small]), (own[small], x[small])
            q = whole[small].astype(np.int64)
            self.blocks[dims] = [Best(own[small][a : a + QUERY_BLOCK], q[a : a + QUERY_BLOCK]) for a in range(0, len(q), QUERY_BLOCK)]

    def add(self, ids: np.ndarray, v: pa.ListArray) -> list[tuple]:
        """Take candidates; rows (query_id, vec_id, score as an integer) of products that doubles do not hold."""
        out = []
        for dims, own, x in _by_length(ids, v):
            if dims not in self.blocks:
                continue
            whole = quantised(x, self.scale)
            small = plain(whole)
            for some, (asks, q) in ((~small, self.plain[dims]), (np.ones(len(own), dtype=bool), self.large[dims])):
                if some.any() and len(asks):
                    out += zip(*integer_top(own[some], x[some], asks, q, self.k, self.scale))
            held = self.held.setdefault(dims, [])
            held.append((own[small], whole[small].astype(np.int64)))
            if sum(len(i) for i, _ in held) >= CANDIDATE_BLOCK:
                self.settle(dims)
        return out

    def settle(self, dims: int) -> None:
        ids, x = (np.concatenate(c) for c in zip(*self.held.pop(dims)))
        for at in range(0, len(ids), CANDIDATE_BLOCK):
            lists = SortedLists(ids[at : at + CANDIDATE_BLOCK], x[at : at + CANDIDATE_BLOCK])
            for best in self.blocks[dims]:
                lists.into(best, self.k)

    def end(self) -> Iterator[tuple[list, list, list]]:
        """(query_id, vec_id, score) of the k best, a query block at a time."""
        for dims in list(self.held):
            self.settle(dims)
        for blocks in self.blocks.values():
            for best in blocks:
                size = [len(s) for s, _ in best.found]
                if sum(size):
                    s, i = (np.concatenate(c) for c in zip(*best.found))
                    yield np.repeat(best.ids, size).tolist(), i.tolist(), s.tolist()


FOUND = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "side": pa.int32(), "order": pa.binary()}


def _rows(query_ids: list, vec_ids: list, scores: list) -> pa.RecordBatch:
    columns = (query_ids, vec_ids, *zip(*map(beyond, scores)))
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, FOUND.values())], list(FOUND))


def top_k(vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row that ``is_query`` (on ``vec_id``) selects."""
    d = taking_part(vectors, id_col, vector_col)
    spark = d.sparkSession
    asks = written(d.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    size = asks.agg(F.coalesce(F.sum(8 * F.size("v") + 8), F.lit(0))).first()[0]
    rounds = max(1, -(-size // ROUND_BYTES))
    found = None
    for r in range(rounds):
        own = asks.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r).collect()  # about ROUND_BYTES
        shared = spark.sparkContext.broadcast([(x.vec_id, x.v) for x in own])

        def search(batches, shared=shared):
            now = Round(shared.value, k, scale)
            for b in batches:
                if more := now.add(b.column(0).to_numpy(), b.column(1)):
                    yield _rows(*map(list, zip(*more)))
            for rows in now.end():
                yield _rows(*rows)

        part = written(map_batches(d, search, "query_id long, vec_id long, score long, side int, order binary"), "found")
        found = part if found is None else found.unionByName(part)
        shared.unpersist()
    best = Window.partitionBy("query_id").orderBy(F.desc("side"), F.desc("order"), F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
