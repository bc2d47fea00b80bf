"""Document log-likelihoods under a gated recurrent language model.

1. Spark counts the words of all training documents. The words that occur
   most become the head, modelled one by one, in classes of ``SIZE`` by
   frequency. All others are in ``TAILS`` classes by their last letters; within
   such a class a word's share is its smoothed count, and unknown words share
   one place. A dictionary of at most ``DICTIONARY`` frequent words is
   broadcast; rarer words meet their counts in a join.
   Words are split, counted and looked up a batch at a time by Arrow kernels.
2. Documents are encoded once, as symbols of the network, in a written table.
3. The network (``gru``) starts as the unigram model. All training documents
   are dealt to ``ROUNDS`` rounds by a hash of their symbols; in a round each
   task trains a copy on its documents by truncated backpropagation, its state
   carried across windows, and the copies are averaged, by tokens, in two steps
   of a shuffle by parameter block. Counts, dictionary, base and rounds do not
   depend on the cluster; which documents share a task and so a copy does, and
   with it the trained parameters.
4. Every whole document is scored: its state is carried across windows from
   its first word to its end.

Gathered from the corpus: all counts, and parameters trained on all training
documents. To the driver go the dictionary and the parameters, both of fixed
size.

Defined cases: a null or empty text is the end token alone; a null id is in
the fold of the empty text; repeated rows are scored, and learned from, each;
equal counts go in the order of the words, and at the dictionary's end by a
hash of the word; without training documents the base
is 0 for each token and the classes are equally likely; an empty table gives an
empty result; long texts are one lane of many windows; other columns are not
read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import documents, fold, map_batches, written
from crawlstats.llm.gru import LANES, Gru, lanes, windows

HEADS, SIZE, TAILS, HIDDEN = 16, 64, 64, 24
HEAD = HEADS * SIZE
END = HEAD + TAILS  # the symbol that ends a document, and begins it
DICTIONARY = 1 << 18
ROUNDS = 3
#: Documents of more tokens share lanes with their like, as lanes end with the longest.
LONG = 4096
#: Tokens of documents that a task runs through the network at a time.
GATHERED = 3 << 19
#: Parameters in a block, and parts of the first averaging step.
PARAMETERS, SALTS = 1 << 14, 32
OUTER = b".,;:!?\"'()|&"


def tail_class(word: bytes) -> int:
    return zlib.crc32(word.rstrip(OUTER)[-2:] or word[-2:]) % TAILS


_OUTER = np.isin(np.arange(256), list(OUTER))
_ONE_BYTE = np.array([zlib.crc32(bytes([b])) % TAILS for b in range(256)], dtype=np.int16)
_TWO_BYTES = np.array([zlib.crc32(bytes([a, b])) % TAILS for a in range(256) for b in range(256)], dtype=np.int16)


def tail_classes(words: pa.Array) -> np.ndarray:
    """``tail_class`` of every word."""
    n = len(words)
    words = words.cast(pa.binary())
    if not n:
        return np.zeros(0, dtype=np.int16)
    offset = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    start, end = offset[:-1], offset[1:].copy()
    on = np.flatnonzero(end > start)
    while len(on):
        on = on[_OUTER[data[end[on] - 1]]]
        end[on] -= 1
        on = on[end[on] > start[on]]
    end = np.where(end > start, end, offset[1:])  # nothing but outer characters
    last = data[end - 1].astype(np.int64)
    return np.where(end - start > 1, _TWO_BYTES[data[np.maximum(end - 2, start)].astype(np.int64) * 256 + last], _ONE_BYTE[last])


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts, lower-cased, and how many each text has."""
    lists = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(texts))
    flat, size = lists.flatten(), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pa.compute.greater(pa.compute.binary_length(flat), 0)  # white space at an end leaves an empty piece
    text = np.repeat(np.arange(len(size)), size)
    size = np.bincount(text, weights=some.to_numpy(zero_copy_only=False), minlength=len(size)).astype(np.int64)
    return flat.filter(some), size


def blank() -> Gru:
    return Gru(END + 1, HEADS + TAILS + 1, HEADS, SIZE, HIDDEN)


class Vocabulary:
    """The dictionary in order of frequency, and the totals; bounded, so it may be broadcast."""

    def __init__(self, frequent: list[tuple[bytes, int]], kinds: dict[int, tuple[int, int]], n_docs: int):
        frequent.sort(key=lambda p: (-p[1], p[0]))
        self.index = {w: i for i, (w, _) in enumerate(frequent)}
        count = np.array([n for _, n in frequent], dtype=np.float64)
        self.tokens = sum(n for n, _ in kinds.values()) + n_docs
        self.distinct = sum(v for _, v in kinds.values()) + (n_docs > 0)
        self.docs = n_docs
        in_tail, varied = np.zeros(TAILS), np.zeros(TAILS)
        for k, (n, v) in kinds.items():
            in_tail[k], varied[k] = n, v
        kind = np.array([tail_class(w) for w, _ in frequent], dtype=np.int64)
        np.subtract.at(in_tail, kind[:HEAD], count[:HEAD])
        np.subtract.at(varied, kind[:HEAD], 1)
        self.tail_mass = in_tail + 0.5 * (varied + 1)
        self.base_below = math.log10(self.tokens + 0.5 * (self.distinct + 1))
        self.base = np.log10(count + 0.5) - self.base_below
        self.base_end = math.log10(n_docs + 0.5) - self.base_below
        self.symbol = np.where(np.arange(len(kind)) < HEAD, np.arange(len(kind)), HEAD + kind)
        self.share = np.where(np.arange(len(kind)) < HEAD, 0.0, np.log10(count + 0.5) - np.log10(self.tail_mass)[kind])
        self.head = np.zeros(HEAD)
        self.head[: min(HEAD, len(count))] = count[:HEAD]

    def unigram(self) -> Gru:
        """The network that gives what the counts give."""
        g = blank()
        head = self.head + 1e-3  # places without a word stay possible, barely
        by_class = head.reshape(HEADS, SIZE)
        if self.docs:
            mass = np.concatenate([by_class.sum(axis=1), self.tail_mass, [self.docs + 0.5]])
            g.out_bias[:] = np.log(mass / mass.sum())
        g.tok_bias[:] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).ravel()
        return g


def word_counts(train: DataFrame) -> DataFrame:
    """(word, kind, n) over the whole texts of ``train``, written."""

    def run(batches):
        for b in batches:
            found = split(b.column(0))[0].value_counts()
            own = found.field("values")
            columns = [own.cast(pa.binary()), pa.array(tail_classes(own), pa.int32()), found.field("counts").cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "kind", "n"])

    counted = map_batches(train.select("text"), run, "word binary, kind int, n long")
    return written(counted.groupBy("word").agg(F.first("kind").alias("kind"), F.sum("n").alias("n")), "word-counts")


#: Hash places among which words of one count are divided at the dictionary's end.
PLACES = 1 << 16


def _first(sizes: list[tuple[int, int]], room: int) -> tuple[int, int]:
    """Of (key, size) in order: how many fit into ``room`` one after the other, and the room they leave."""
    for i, (_, v) in enumerate(sizes):
        if v > room:
            return i, room
        room -= v
    return len(sizes), room


def in_dictionary(counts: DataFrame) -> Column:
    """The condition on (word, n) of the ``DICTIONARY`` most frequent words.

    Counts are narrowed down by histograms: eighths of powers of two, then the
    counts within one of these, then hash places of the words with one count.
    """
    sized = lambda key, rows: rows.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("v"))
    listed = lambda df, down: sorted(((r.k, r.v) for r in df.collect()), reverse=down)
    step, place = F.floor(F.log2("n") * 8).cast("int"), F.pmod(F.xxhash64("word"), F.lit(PLACES)).cast("int")
    steps = listed(sized(step, counts), True)  # at most 8 * 64
    i, room = _first(steps, DICTIONARY)
    if i == len(steps):
        return F.lit(True)
    at = steps[i][0]
    own = listed(sized(F.col("n"), counts.where(step == at)), True)  # few counts where words are many, few words where counts are many
    i, room = _first(own, room)
    n = own[i][0]
    places = listed(sized(place, counts.where(F.col("n") == n)), False)
    i, _ = _first(places, room)
    return (F.col("n") > n) | ((F.col("n") == n) & (place < places[i][0]))


def vocabulary(counts: DataFrame, frequent: Column, n_docs: int) -> Vocabulary:
    """The vocabulary, with the words that ``frequent`` selects as its dictionary."""
    kinds = {r.kind: (r.n, r.v) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    rows = counts.where(frequent).select("word", "n").collect()  # at most DICTIONARY rows
    return Vocabulary([(bytes(r.word), r.n) for r in rows], kinds, n_docs)


class Flat:
    """Documents, given as symbols that end with ``END``, as one run of tokens."""

    def __init__(self, docs: list[np.ndarray]):
        self.length = np.fromiter(map(len, docs), np.int64, len(docs))
        self.start = np.cumsum(self.length) - self.length
        self.symbol = np.concatenate(docs)
        head = self.symbol < HEAD
        self.kind = np.where(head, self.symbol // SIZE, np.where(self.symbol < END, HEADS + self.symbol - HEAD, HEADS + TAILS)).astype(np.int16)
        self.place = np.where(head, self.symbol % SIZE, 0).astype(np.int16)

    def in_lanes(self):
        """(place of each token in lane order, input, first of its document, kind, place in its class, tokens of each lane)."""
        start, length = self.start, self.length
        order, total = lanes(length, LANES)
        size = length[order]
        begin = np.cumsum(size) - size
        at = np.repeat(start[order] - begin, size) + np.arange(int(size.sum()))
        first = np.zeros(len(at), dtype=bool)
        first[begin] = True
        before = self.symbol[at - 1]
        before[first] = END
        return at, before, first, self.kind[at], self.place[at], total


def train_on(g: Gru, flat: Flat, memory: dict) -> None:
    _, before, first, kind, place, total = flat.in_lanes()
    h = np.zeros((len(total), g.hidden), np.float32)
    for on, at, live in windows(total):
        h = g.learn(before[at], first[at] & live, h[:on], kind[at], place[at], live.astype(np.float32), memory)


def log10_scores(g: Gru, flat: Flat) -> np.ndarray:
    """Per document the network's part of log10 probability."""
    where, before, first, kind, place, total = flat.in_lanes()
    lp = np.zeros(len(where), np.float32)
    h = np.zeros((len(total), g.hidden), np.float32)
    for on, at, live in windows(total):
        hs = g.states(before[at], first[at] & live, h[:on])
        h = hs[-1]
        lp[at[live]] = g.log_probs(hs.reshape(-1, g.hidden), kind[at].ravel(), place[at].ravel()).reshape(live.shape)[live]
    by_token = np.zeros(len(where))
    by_token[where] = lp
    return np.add.reduceat(by_token, flat.start) / math.log(10)


def averaged(copies: DataFrame) -> np.ndarray | None:
    """The mean of vectors that come in blocks (block, salt, n, v), weighted by n."""

    def add(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for block, n, v in zip(*b.columns):
                v = np.frombuffer(v.as_py(), dtype=np.float64)
                s = sums.setdefault(block.as_py(), [0, np.zeros(len(v))])
                s[0] += n.as_py()
                s[1] += v
        if sums:
            rows = [(k, n, v.tobytes()) for k, (n, v) in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["block", "n", "v"])

    kind = "block int, n long, v binary"
    some = map_batches(copies.repartition("block", "salt").select("block", "n", "v"), add, kind)
    total = map_batches(some.repartition("block"), add, kind).collect()  # one row a block
    return np.concatenate([np.frombuffer(r.v, dtype=np.float64) / r.n for r in sorted(total, key=lambda r: r.block)]) if total else None


class Gathered:
    """Documents held back until they fill the lanes; long ones wait for each other."""

    def __init__(self, use):
        self.use, self.held = use, ([], [])
        self.tokens = [0, 0]

    def add(self, key, symbols: np.ndarray) -> list:
        kind = int(len(symbols) > LONG)
        self.held[kind].append((key, symbols))
        self.tokens[kind] += len(symbols)
        return self._flush(kind) if self.tokens[kind] >= GATHERED else []

    def _flush(self, kind: int) -> list:
        if not self.held[kind]:
            return []
        keys, docs = zip(*self.held[kind])
        self.held[kind].clear()
        self.tokens[kind] = 0
        return [(keys, self.use(Flat(list(docs))))]

    def end(self) -> list:
        return self._flush(0) + self._flush(1)


def train(encoded: DataFrame, v: Vocabulary) -> Gru:
    """The network after ``ROUNDS`` rounds over the ``symbols`` of ``encoded``."""
    spark, g = encoded.sparkSession, v.unigram()
    size = len(g.vector())
    state = np.concatenate([g.vector(), np.full(size, 1e-2)]).astype(np.float32)  # parameters, then their step memory

    def learner(shared):
        def run(batches):
            state = shared.value
            g, m = (blank().set_vector(s) for s in (state[:size], state[size:]))
            memory = {n: getattr(m, n) for n in g.NAMES}
            seen = 0
            gathered = Gathered(lambda flat: train_on(g, flat, memory))
            for b in batches:
                for s in b.column(0):
                    own = np.frombuffer(s.as_py(), dtype=np.int16)
                    seen += len(own)
                    gathered.add(None, own)
            gathered.end()
            if seen:
                out = np.concatenate([g.vector(), *[memory[n].ravel() for n in g.NAMES]]).astype(np.float64) * seen
                salt = TaskContext.get().partitionId() % SALTS
                for block, at in enumerate(range(0, len(out), PARAMETERS)):
                    row = (pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([seen], pa.int64()), pa.array([out[at : at + PARAMETERS].tobytes()], pa.binary()))
                    yield pa.RecordBatch.from_arrays(list(row), ["block", "salt", "n", "v"])

        return run

    for r in range(ROUNDS):
        own = encoded.where(F.pmod(F.xxhash64("symbols"), F.lit(ROUNDS)) == r).select("symbols")
        shared = spark.sparkContext.broadcast(state)
        mean = averaged(map_batches(own, learner(shared), "block int, salt int, n long, v binary"))
        if mean is not None:
            state = mean.astype(np.float32)
    return g.set_vector(state[:size])


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Written, by document: row, doc_id, what the dictionary gives of the results, rare words, symbols."""
    shared = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches):
        v = shared.value
        known_end, dictionary = int(v.docs > 0), pa.array(list(v.index), pa.binary()).cast(pa.string())
        columns = ["doc_id", "n_tokens", "n_known", "base", "share", "rare", "symbols"]
        for b in batches:
            if not b.num_rows:
                continue
            n = b.num_rows
            own, size = split(b.column(1))
            doc = np.repeat(np.arange(n), size)
            found = pa.compute.index_in(own, value_set=dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
            unknown = np.flatnonzero(found < 0)
            rare = own.take(pa.array(unknown)).dictionary_encode()
            code, kind = rare.indices.to_numpy(zero_copy_only=False).astype(np.int64), tail_classes(rare.dictionary)
            # Symbols of all documents one after the other, each with its end.
            symbols = np.full(len(found) + n, END, dtype=np.int16)
            place = np.arange(len(found)) + doc
            if len(v.symbol):
                symbols[place] = v.symbol[found]
            symbols[place[unknown]] = HEAD + kind[code]
            stop = np.cumsum(size + 1) * 2
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.r_[0, stop].astype(np.int32)), pa.py_buffer(symbols)])
            in_it = found >= 0
            summed = lambda values: np.bincount(doc[in_it], weights=values[found[in_it]], minlength=n).astype(np.float64)  # noqa: E731, B023
            # Each rare word of a document once, with its times.
            width = max(1, len(kind))
            pair, times = np.unique(doc[unknown] * width + code, return_counts=True)
            word = rare.dictionary.take(pa.array(pair % width)).cast(pa.binary())
            rows = pa.StructArray.from_arrays([word, pa.array(kind[pair % width], pa.int32()), pa.array(times, pa.int64())], ["word", "kind", "n"])
            ends = np.searchsorted(pair // width, np.arange(n), side="right")
            rares = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), rows)
            known = np.bincount(doc[in_it], minlength=n) + known_end
            arrays = [b.column(0), pa.array(size + 1), pa.array(known.astype(np.int64)), pa.array(summed(v.base) + v.base_end), pa.array(summed(v.share)), rares, packed]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    kind = "doc_id long, n_tokens long, n_known long, base double, share double, rare array<struct<word: binary, kind: int, n: bigint>>, symbols binary"
    return written(map_batches(docs, run, kind).withColumn("row", F.monotonically_increasing_id()), "encoded")


def network_scores(encoded: DataFrame, g: Gru) -> DataFrame:
    """(row, lp): the network's part of each document's log10 probability."""
    shared = encoded.sparkSession.sparkContext.broadcast(g.vector())

    def run(batches):
        g = blank().set_vector(shared.value)
        gathered = Gathered(lambda flat: log10_scores(g, flat))

        def out(done):
            for rows, lp in done:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(lp)], ["row", "lp"])

        for b in batches:
            for row, s in zip(b.column(0), b.column(1)):
                yield from out(gathered.add(row.as_py(), np.frombuffer(s.as_py(), dtype=np.int16)))
        yield from out(gathered.end())

    return map_batches(encoded.select("row", "symbols"), run, "row long, lp double")


def lm_scores(docs: DataFrame, *, folds: int = 5, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    d = documents(docs, id_col, text_col)
    held_out = fold("doc_id", folds) == held
    known = d.where(~held_out)
    counts = word_counts(known)
    frequent = in_dictionary(counts)
    v = vocabulary(counts, frequent, known.count())
    encoded = encode(d, v)
    scored = network_scores(encoded, train(encoded.where(~held_out), v))
    rare = encoded.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    met = rare.join(counts.where(~frequent).select("word", "n"), "word", "left")
    c = F.coalesce("n", F.lit(0))
    below = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(v.tail_mass)]), F.col("kind") + 1)
    more = met.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known_more"),
        F.sum(F.col("times") * (F.log10(c + 0.5) - F.lit(v.base_below))).alias("base_more"),
        F.sum(F.col("times") * (F.log10(c + 0.5) - below)).alias("share_more"),
    )
    out = encoded.drop("rare", "symbols").join(scored, "row").join(more, "row", "left")
    return out.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"),
        (F.col("lp") + F.col("share") + F.coalesce("share_more", F.lit(0.0))).alias("score"),
    )
