"""Toxicity scores by weak supervision.

1. Labelled rows of the training folds, at most ``SAMPLE_ROWS`` in
   expectation and picked by a hash of the id, are read as sets of terms:
   words without outer punctuation, and word beginnings of 4 to 6 letters, as
   inflected forms share them. Spark counts the documents per term and label.
2. The terms that tell the labels apart best become lexicon voters (present:
   toxic, or clean), beside pattern voters on the whole text. The label model
   (``label_model``) estimates their accuracies and correlations and gives
   each sampled row a posterior label.
3. A logistic regression on terms and patterns learns from the posteriors.
   Its weights, a table bounded by ``TERMS``, are broadcast, and every whole
   text is scored in one pass without a shuffle.

Defined cases: a null or empty text has no terms and gets the score of the
bias; a null id is scored, never learned from; labels other than 0 and 1 are
no labels; of a doc_id labelled twice the larger label counts, of one with
several texts the smallest text is learned from; a tie of terms goes to the
smaller one; very long texts are read whole; without labels, or with one class
only, all scores are that share (0.5 if none); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import documents, fold, map_batches, pick, written
from crawlstats.llm.label_model import LabelModel, fit_linear

#: Labelled rows that the model is fitted on, in expectation.
SAMPLE_ROWS = 20_000
#: Terms that the classifier weighs, half for each label.
TERMS = 2048
#: Lexicon voters for toxic and for clean.
TOXIC_VOTERS, CLEAN_VOTERS = 64, 16
#: Documents that must hold a term for it to be used.
LEAST_DOCUMENTS = 3
BEGINNINGS = (4, 5, 6)
OUTER = ".,;:!?\"'()[]{}<>|&*-_/\\#+=~`«»“”„‘’¿¡…"
REMEMBERED = 200_000

MARKS = re.compile(r"[!?]{3,}|[@#$%&*]{3,}")
CAPITALS = re.compile(r"\b[A-Z]{4,}\b")
LETTER_RUN = re.compile(r"([A-Za-z])\1{3}")
ADDRESS = re.compile(r"\b(?:you|your|you're|ur)\b", re.IGNORECASE)
#: Pattern voters that look at the text alone; each is also a feature.
PATTERNS = (MARKS, CAPITALS, LETTER_RUN, ADDRESS)


def word_terms(word: str) -> tuple[str, ...]:
    """The terms of one lower-case word."""
    w = word.strip(OUTER)
    if not w:
        return ()
    return (w, *(w[:n] + "*" for n in BEGINNINGS if len(w) > n))


class Reader:
    """Texts -> indexes of known terms; remembers words up to a bound."""

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.seen: dict[str, tuple[int, ...]] = {}

    def features(self, text: str) -> list[int]:
        """Sorted indexes: terms, then the patterns behind them."""
        found: set[int] = set()
        seen, index = self.seen, self.index
        for w in set(text.lower().split()):
            hit = seen.get(w)
            if hit is None:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                hit = seen[w] = tuple(index[t] for t in word_terms(w) if t in index)
            if hit:
                found.update(hit)
        found.update(len(index) + k for k, p in enumerate(PATTERNS) if p.search(text))
        return sorted(found)


def _sample(docs: DataFrame, labels: DataFrame, folds: int, held: int) -> DataFrame:
    """(label, text) of the labelled training rows, one for each id; at most ``SAMPLE_ROWS`` ids, so their join may broadcast them."""
    known = labels.where((fold("doc_id", folds) != held) & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = known.where(place < int(share * (1 << 30)))
    one = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.first("label").cast("int").alias("label"), F.min("text").alias("text"))
    return written(one.select("label", "text"), "toxicity-sample")


def _terms(sample: DataFrame, toxic: int, clean: int) -> tuple[list[str], list[str]]:
    """The terms that speak for each label, strongest first."""

    def count(batches):
        by_term: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = set(text.as_py().lower().split())
                by_term[label].update({t for w in own for t in word_terms(w)})
        for label, c in enumerate(by_term):
            items = list(c.items())
            for at in range(0, len(items), 1 << 16):
                term, n = zip(*items[at : at + (1 << 16)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term), pa.array([label] * len(term), pa.int32()), pa.array(n, pa.int64())], ["term", "label", "n"]
                )

    counts = map_batches(sample, count, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c"),
    ).where(F.col("t") + F.col("c") >= LEAST_DOCUMENTS)
    t, c = F.lit(float(toxic)), F.lit(float(clean))
    # Log-odds of the shares, by how far the term's count is from chance.
    odds = F.log((F.col("t") + 0.5) / (t + 1)) - F.log((F.col("c") + 0.5) / (c + 1))
    strength = odds * F.sqrt(F.col("t") + F.col("c"))
    scored = written(counts.select("term", strength.alias("strength")), "toxicity-terms")
    half = TERMS // 2
    return tuple(
        [r.term for r in scored.where(keep).orderBy(order, "term").limit(half).collect()]
        for keep, order in (("strength > 0", F.desc("strength")), ("strength < 0", F.asc("strength")))
    )


def lexicon(rows: list[list[int]], label: np.ndarray, n_toxic: int) -> list[int]:
    """Toxic terms that vote: each the one in most toxic rows that hold none chosen before, the stronger on ties."""
    left = [{f for f in r if f < n_toxic} for r, y in zip(rows, label) if y == 1]
    chosen: list[int] = []
    while left and len(chosen) < TOXIC_VOTERS:
        n = Counter(f for r in left for f in r)
        if not n:
            break
        best = min(n, key=lambda f: (-n[f], f))
        chosen.append(best)
        left = [r for r in left if best not in r]
    return chosen


def votes_of(rows: list[list[int]], chosen: list[int], n_toxic: int, n_terms: int) -> np.ndarray:
    """The voters' votes on feature rows: chosen toxic terms, the strongest clean ones, patterns."""
    lex, clean = len(chosen), min(CLEAN_VOTERS, n_terms - n_toxic)
    place = {f: i for i, f in enumerate(chosen)}
    v = np.zeros((len(rows), lex + clean + len(PATTERNS) + 2), dtype=np.int8)
    for r, features in enumerate(rows):
        hits = 0
        for f in features:
            if f < n_toxic:
                hits += 1
                if f in place:
                    v[r, place[f]] = 1
            elif f < n_terms:
                if f - n_toxic < clean:
                    v[r, lex + f - n_toxic] = -1
            else:
                v[r, lex + clean + f - n_terms] = 1
        v[r, -2] = 1 if hits >= 2 else 0  # pattern: several toxic terms
        v[r, -1] = 0 if hits else -1  # pattern: none at all
    return v


class Classifier:
    """Terms, weights and what the label model found; small enough to broadcast."""

    def __init__(self, terms: list[str], weights: np.ndarray, model: LabelModel | None):
        self.terms, self.weights, self.model = terms, weights, model

    def scorer(self):
        reader, w = Reader(self.terms), self.weights.tolist()
        bias = w[-1]

        def score(text: str) -> float:
            z = bias + sum([w[f] for f in reader.features(text)])
            return 1 / (1 + float(np.exp(-min(30.0, max(-30.0, z)))))

        return score


def learn(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0) -> Classifier:
    """The classifier, from ``docs`` (doc_id, text) and ``labels`` (doc_id, label) outside the held-out fold."""
    sample = _sample(docs, labels, folds, held)
    by_label = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    none = np.zeros(len(PATTERNS) + 1)
    if not toxic or not clean:
        none[-1] = 0.0 if toxic == clean else (30.0 if toxic else -30.0)
        return Classifier([], none, None)
    for_toxic, for_clean = _terms(sample, toxic, clean)
    terms = for_toxic + for_clean
    width = len(terms) + len(PATTERNS)

    def read(batches):
        reader = Reader(terms)
        for b in batches:
            rows = [reader.features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "features"])

    read_rows = map_batches(sample, read, "label int, features array<int>").collect()  # at most SAMPLE_ROWS of TERMS
    rows = [r.features for r in read_rows]
    label = np.array([r.label for r in read_rows], dtype=np.float64)
    votes = np.column_stack([2 * label - 1, votes_of(rows, lexicon(rows, label, len(for_toxic)), len(for_toxic), len(terms))]).astype(np.int8)
    model = LabelModel().fit(votes, label)
    target = model.posterior(votes)
    start = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int64)
    feature = np.fromiter((f for r in rows for f in r), np.int64, int(start[-1]))
    return Classifier(terms, fit_linear(start, feature, target, width), model)


def _learned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int):
    known = pick(labels, doc_id=id_col, label=label_col)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").try_cast("long").alias("label"))
    found = learn(documents(docs, id_col, text_col), known, folds=folds, held=held)
    return docs.sparkSession.sparkContext.broadcast(found)


def non_toxic(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The input's rows and columns, without the rows predicted toxic."""
    shared = _learned(docs, labels, id_col, text_col, label_col, folds, held)
    at = docs.columns.index(text_col)

    def run(batches):
        score = shared.value.scorer()
        for b in batches:
            texts = (t.as_py() or "" for t in b.column(at))
            yield b.filter(pa.array([score(t) < 0.5 for t in texts], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    d = documents(docs, id_col, text_col)
    shared = _learned(docs, labels, id_col, text_col, label_col, folds, held)

    def run(batches):
        score = shared.value.scorer()
        for b in batches:
            s = np.array([score(t.as_py()) for t in b.column(1)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    scored = map_batches(d, run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
