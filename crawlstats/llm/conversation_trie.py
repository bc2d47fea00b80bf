"""Prefix trie of conversations from sorted neighbours.

A conversation is the sequence of its turns. Equal conversations are combined
first; the distinct ones are sorted by their turns, and the longest common
prefix of two neighbours (LCP) is the depth at which their paths part. Within
a run of neighbours the LCP edges are taken in descending depth and their ends
united (union-find): a merge of two components is a branching node at the
edge's depth, and the path from a component's top up to that depth holds nodes
with one child each. Nodes on the path of the run's first or last conversation
may go on in the neighbouring run; they stay open, all others are finished and
leave the run. What remains of a run, its contracted forest, is these two paths
with the sums of what was finished below each open node: two elements of the
same kind as a conversation, so runs of contracted forests are merged by the
same code, first within a task, then over groups of ``GROUP`` tasks in written
rounds, until one group is left, whose open nodes end too.

A finished node below an open one does not know its parent's smallest member
yet; it carries the parent's key, and a join brings the value.

Turns are compared by 128 bits of the SHA-256 of role and text. A conversation
is one row with 16 bytes and a word count for each turn, never its texts; a
task holds ``RUN_BYTES`` of such rows at a time.

Defined cases: a null role or text is empty; null turns come first, turns with
equal numbers go in the order of their digests; repeated rows are turns of
their own; rows without a conversation id belong to none and take no part; a
conversation without turns is a member of the root only; an empty table gives
no nodes; very long texts count as others do; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import map_batches, pick, written

#: Bytes that stand for a turn.
SYMBOL = 16
#: Bytes of paths in a run: what a task holds at a time.
RUN_BYTES = 4 << 20
#: Contracted forests (tasks) that a task of the next round merges.
GROUP = 64
WORD = "[^ \\t-\\r]+"

TURNS = "array<struct<turn: bigint, symbol: string, words: int>>"
NODE = {
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
    "key": pa.binary(),
    "parent_key": pa.binary(),
}
MARK = pa.struct(
    [("depth", pa.int64()), ("n", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())]
    + [(c, pa.int64()) for c in ("children", "leaves", "saved")]
)
OPEN = {"part": pa.int64(), "at": pa.int32(), "path": pa.binary(), "words": pa.list_(pa.int32()), "marks": pa.list_(MARK)}
MERGED = pa.schema(list((NODE | OPEN).items()))
MERGED_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, parent_key binary, part long, at int, path binary, words array<int>, "
    "marks array<struct<depth: bigint, n: bigint, conv: bigint, ends: string, children: bigint, leaves: bigint, saved: bigint>>"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as symbols and word counts."""
    t = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    symbol = F.substring(F.sha2(content.cast("binary"), 256), 1, 2 * SYMBOL)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), symbol.alias("symbol"), F.regexp_count(text, F.lit(WORD)).cast("int").alias("words")
    )
    grouped = t.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.col("turns").cast(TURNS).alias("turns"))


def with_heads(convs: DataFrame, every: int, head: Column) -> DataFrame:
    """Conversations whose first ``head`` turns are those of conversation c - c % ``every``, which may be absent."""
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("head", head.cast("int"))
    heads = convs.where("conv_id = base").select("base", F.col("turns").alias("first"))
    rest = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    first = F.when(F.col("first").isNotNull(), F.slice("first", 1, F.col("head"))).otherwise(F.array().cast(TURNS))
    return convs.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(path, words, conv, n, ends): each distinct sequence with the smallest id, the number and the hash of its conversations.

    The hash runs over the ids in ascending order. A sort by (sequence, id)
    spreads equal conversations over tasks, which write their ids into pieces
    of text; only these pieces meet, in order, where they are hashed one after
    the other and never held.
    """
    symbols = F.transform("turns", lambda t: t["symbol"])
    path = F.unhex(F.array_join(symbols, ""))
    each = written(convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")), "sequences")
    same = each.select(F.sha2("path", 256).alias("same"), "conv_id")
    pieces = map_batches(same.repartitionByRange("same", "conv_id").sortWithinPartitions("same", "conv_id"), _id_pieces, PIECE_DDL)
    ordered = pieces.repartition("same").sortWithinPartitions("same", "first")
    groups = map_batches(ordered, _hashed, "conv_id long, n long, ends string")
    return each.join(groups, "conv_id").select("path", "words", F.col("conv_id").alias("conv"), "n", "ends")


PIECE_DDL = "same string, first long, n long, ids string"


def _id_pieces(batches) -> Iterator[pa.RecordBatch]:
    """Within a batch, the ids of each group in ascending order as one text."""
    for b in batches:
        same, conv = b.column(0).to_pylist(), b.column(1).to_pylist()
        starts = [i for i, s in enumerate(same) if i == 0 or s != same[i - 1]]
        spans = list(zip(starts, [*starts[1:], len(same)]))
        columns = {
            "same": pa.array([same[i] for i, _ in spans], pa.string()),
            "first": pa.array([conv[i] for i, _ in spans], pa.int64()),
            "n": pa.array([j - i for i, j in spans], pa.int64()),
            "ids": pa.array([",".join(map(str, conv[i:j])) for i, j in spans], pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """(smallest id, number, hash) of each group, from its pieces in order."""
    now, sha, first, total = None, None, None, 0
    done: list[tuple] = []

    def batch() -> pa.RecordBatch:
        conv, n, ends = zip(*done) if done else ((), (), ())
        columns = {"conv_id": pa.array(conv, pa.int64()), "n": pa.array(n, pa.int64()), "ends": pa.array(ends, pa.string())}
        done.clear()
        return pa.RecordBatch.from_pydict(columns)

    for b in batches:
        for same, conv, n, ids in zip(*(c.to_pylist() for c in b.columns)):
            if same == now:
                sha.update(b"," + ids.encode())
                total += n
                continue
            if now is not None:
                done.append((first, total, sha.hexdigest()))
            now, sha, first, total = same, hashlib.sha256(ids.encode()), conv, n
        yield batch()
    if now is not None:
        done.append((first, total, sha.hexdigest()))
        yield batch()


class Mark:
    """What is known of a node so far: members, the hash of those that end here, and sums over its finished children."""

    __slots__ = ("n", "conv", "ends", "children", "leaves", "saved")

    def __init__(self, n=0, conv=None, ends=None, children=0, leaves=0, saved=0):
        self.n, self.conv, self.ends, self.children, self.leaves, self.saved = n, conv, ends, children, leaves, saved

    def add(self, m: Mark) -> None:
        self.n += m.n
        self.conv = m.conv if self.conv is None else self.conv if m.conv is None else min(self.conv, m.conv)
        self.ends = self.ends or m.ends
        self.children += m.children
        self.leaves += m.leaves
        self.saved += m.saved


class Element:
    """A path with marks at some depths, the last at its end: a conversation, or a side of a contracted forest."""

    __slots__ = ("path", "words", "marks")

    def __init__(self, path: bytes, words: np.ndarray, marks: dict[int, Mark]):
        self.path, self.words, self.marks = path, words, marks


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common, by bisection over equal prefixes."""
    lo, hi = 0, min(len(a), len(b)) // SYMBOL
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * SYMBOL : mid * SYMBOL] == b[lo * SYMBOL : mid * SYMBOL]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class _Component:
    """United neighbours: the node at its top, the rows of that node's children, and the marks that wait further up."""

    __slots__ = ("element", "depth", "top", "rows", "marks")

    def __init__(self, e: Element):
        self.element, self.depth, self.marks = e, len(e.path) // SYMBOL, dict(e.marks)
        self.top, self.rows = self.marks.pop(self.depth), []

    def unite(self, c: _Component) -> None:
        """Take in a component whose top is the same node."""
        self.top.add(c.top)
        if len(self.rows) < len(c.rows):
            self.rows, c.rows = c.rows, self.rows
        self.rows += c.rows
        for at, m in c.marks.items():
            self.marks.setdefault(at, Mark()).add(m)


class Forest:
    """Merges runs of neighbouring elements; finished nodes gather in ``rows``."""

    def __init__(self):
        self.rows: dict[str, list] = {c: [] for c in NODE}

    @staticmethod
    def key(path: bytes, depth: int) -> bytes:
        return hashlib.sha256(path[: depth * SYMBOL]).digest()[:SYMBOL]

    def _finish(self, c: _Component, stop: int) -> None:
        """The node at the top and the one-child nodes above it, down to depth ``stop`` + 1; the top becomes the node at ``stop``."""
        t, k = c.top, c.depth - stop
        saved = t.saved + (t.n - 1) * np.cumsum(c.element.words[stop : c.depth][::-1], dtype=np.int64)
        leaves = self._rows(c, np.arange(c.depth, stop, -1), saved)
        c.rows = [len(self.rows["key"]) - 1]
        c.top, c.depth = Mark(t.n, t.conv, None, 1, leaves, int(saved[-1])), stop

    def _rows(self, c: _Component, depth: np.ndarray, saved: np.ndarray) -> int:
        """One row for the top and each one-child node above it; returns the leaves below them."""
        t, r, k = c.top, self.rows, len(depth)
        for row in c.rows:
            r["parent_conv_id"][row] = t.conv
        leaves = t.leaves if t.children else 1
        r["conv_id"].append(np.full(k, t.conv))
        r["depth"].append(depth)
        r["n_convs"].append(np.full(k, t.n))
        r["n_children"].append(np.concatenate([[t.children], np.ones(k - 1, dtype=np.int64)]))
        r["n_leaves"].append(np.full(k, leaves))
        r["saved_tokens"].append(saved)
        r["parent_conv_id"] += [t.conv] * (k - 1) + [None]
        r["parent_key"] += [None] * k
        r["ends_sha256"] += [t.ends or NO_ENDS] + [NO_ENDS] * (k - 1)
        # Nodes of earlier runs may wait for one that has children.
        r["key"] += [self.key(c.element.path, c.depth) if t.children else None] + [None] * (k - 1)
        return leaves

    def _lift(self, c: _Component, depth: int) -> _Component:
        """Raise the top to ``depth``, past the marks on the way."""
        while c.depth > depth:
            stop = max((d for d in c.marks if depth < d < c.depth), default=depth)
            self._finish(c, stop)
            if stop in c.marks:
                c.top.add(c.marks.pop(stop))
        return c

    def merge(self, run: list[Element], last: bool) -> list[Element]:
        """Unite a run's neighbours. Returns its contracted forest; nothing if ``last``, for then the root ends too."""
        if not last and len(run) < 2:
            return run
        depth = [lcp(a.path, b.path) for a, b in zip(run, run[1:])]
        root = list(range(len(run)))
        part: dict[int, _Component] = {i: _Component(e) for i, e in enumerate(run)}
        sides = {} if last else {0: run[0], len(run) - 1: run[-1]}
        sides = {i: Element(e.path, e.words, dict(e.marks)) for i, e in sides.items()}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in sorted(range(len(depth)), key=depth.__getitem__, reverse=True):
            a, b, d = find(i), find(i + 1), depth[i]
            if a in sides and b in sides:
                continue  # the two paths part here; whatever is above stays open
            if a in sides or b in sides:
                side = a if a in sides else b
                c = self._lift(part.pop(a + b - side), d)
                for row in c.rows:  # their parent stays open
                    self.rows["parent_key"][row] = self.key(c.element.path, d)
                marks = sides[side].marks
                for at, m in [(d, c.top), *c.marks.items()]:
                    marks.setdefault(at, Mark()).add(m)
                root[a + b - side] = side
            else:
                self._lift(part[a], d).unite(self._lift(part.pop(b), d))
                root[b] = a
        if not last:
            return list(sides.values())
        for c in part.values():  # one, unless there are no conversations
            self._lift(c, 0)
            self._rows(c, np.zeros(1, dtype=np.int64), np.array([c.top.saved]))
        return []

    def take(self) -> pa.RecordBatch:
        """The finished nodes so far, as a batch; they are forgotten."""
        n = len(self.rows["key"])
        flat = {c: np.concatenate(v) if v and isinstance(v[0], np.ndarray) else v for c, v in self.rows.items()}
        self.rows = {c: [] for c in NODE}
        columns = [pa.array(flat[c], kind) for c, kind in NODE.items()] + [pa.nulls(n, kind) for kind in OPEN.values()]
        return pa.RecordBatch.from_arrays(columns, schema=MERGED)


def open_batch(part: int, elements: list[Element]) -> pa.RecordBatch:
    """A contracted forest as rows."""
    marks = [
        [{"depth": d, **{f: getattr(m, f) for f in Mark.__slots__}} for d, m in sorted(e.marks.items())] for e in elements
    ]
    columns = {
        "part": [part] * len(elements),
        "at": list(range(len(elements))),
        "path": [e.path for e in elements],
        "words": [e.words for e in elements],
        "marks": marks,
    }
    arrays = [pa.nulls(len(elements), kind) for kind in NODE.values()] + [pa.array(columns[c], kind) for c, kind in OPEN.items()]
    return pa.RecordBatch.from_arrays(arrays, schema=MERGED)


def _contract(forest: Forest, elements: Iterable[Element], last: bool) -> Iterator[pa.RecordBatch | list[Element]]:
    """Merge elements in runs bounded by bytes; batches of finished nodes, at the end the contracted forest."""
    held: list[Element] = []
    run: list[Element] = []
    size = 0
    for e in elements:
        run.append(e)
        size += len(e.path) + 512
        if size >= RUN_BYTES:
            held += forest.merge(run, False)
            run, size = [], 0
            yield forest.take()
            if len(held) >= 2 * GROUP:
                held = forest.merge(held, False)
    held = forest.merge(held + run, last)
    yield forest.take()
    yield held


def _elements(batches) -> Iterator[Element]:
    """Distinct sequences as elements."""
    for b in batches:
        path, words, conv, n, ends = (b.column(c) for c in ("path", "words", "conv", "n", "ends"))
        flat, at = words.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(words).to_numpy(zero_copy_only=False))])
        for i, (p, c, k, e) in enumerate(zip(path.to_pylist(), conv.to_pylist(), n.to_pylist(), ends.to_pylist())):
            yield Element(p, flat[at[i] : at[i + 1]], {len(p) // SYMBOL: Mark(k, c, e)})


def _open_rows(batches) -> Iterator[tuple[int, Element]]:
    """(group, element) of contracted forests."""
    for b in batches:
        for r in b.to_pylist():
            marks = {m.pop("depth"): Mark(**m) for m in r["marks"]}
            yield r["group"], Element(r["path"], np.array(r["words"], dtype=np.int32), marks)


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, turns), one row each."""
    sequences = distinct_sequences(convs)
    ordered = sequences.repartitionByRange("path").sortWithinPartitions("path")

    def local(batches):
        part, forest = TaskContext.get().partitionId(), Forest()
        for out in _contract(forest, _elements(batches), False):
            yield open_batch(part, out) if isinstance(out, list) else out

    def merged(batches, last):
        from itertools import groupby

        forest = Forest()
        for group, rows in groupby(_open_rows(batches), key=lambda r: r[0]):
            for out in _contract(forest, (e for _, e in rows), last):
                yield open_batch(group, out) if isinstance(out, list) else out

    steps = [written(map_batches(ordered, local, MERGED_DDL), "trie")]
    parts = steps[0].agg(F.max("part")).first()[0]
    while parts is not None:
        last = parts < GROUP
        rows = steps[-1].where("part is not null").select(F.floor(F.col("part") / GROUP).cast("long").alias("group"), "part", "at", "path", "words", "marks")
        rows = rows.repartition("group").sortWithinPartitions("group", "part", "at")
        steps.append(written(map_batches(rows, lambda b, last=last: merged(b, last), MERGED_DDL), "trie"))
        parts = None if last else parts // GROUP
    nodes = steps[0]
    for s in steps[1:]:
        nodes = nodes.union(s)
    nodes = nodes.where("depth is not null")
    named = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    waiting = nodes.where("parent_key is not null").join(named, "parent_key").withColumn("parent_conv_id", F.col("named"))
    columns = [c for c in NODE if c not in ("key", "parent_key")]
    return nodes.where("parent_key is null").select(*columns).union(waiting.select(*columns))
