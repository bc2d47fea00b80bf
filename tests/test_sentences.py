"""G3 sentence ends: period statistics against plain Python, and hand-written sentences."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlstats.functions.text import split_words
from crawlstats.operators import reports, sentences

SF001 = "/root/testdata/sf0.01"


def plain_scores(pieces):
    """{word: (with, without, score)} of [(piece, n)], one word at a time."""
    yes, no = Counter(), Counter()
    for raw, n in pieces:
        if not (raw[:1].isascii() and raw[:1].isalnum()):
            continue
        if len(raw) > 1 and raw[-1] == "." and raw[-2] != ".":
            yes[raw[:-1].lower()] += n
        else:
            no[raw.lower()] += n
    total, periods = sum(yes.values()) + sum(no.values()), sum(yes.values())
    out = {}
    for w, a in yes.items():
        if not any("a" <= c <= "z" for c in w):
            continue
        b, p = no[w], min(periods / total, 1 - 1e-9)
        log = a * (math.log(0.99) - math.log(p)) + b * (math.log(1 - 0.99) - math.log(1 - p))
        letters = w.replace(".", "")
        out[w] = (a, b, 2 * log * math.exp(-len(letters)) * (1 + w.count(".")) * float(len(letters)) ** -b)
    return out


def check(spark, texts):
    pieces = reports.piece_counts(texts)
    want = plain_scores([(r.raw, r.n) for r in pieces.collect()])
    got = {r.word: (r.n_with, r.n_without, r.score) for r in sentences.period_statistics(pieces).collect()}
    assert got.keys() == want.keys()
    for w, (a, b, s) in got.items():
        assert (a, b) == want[w][:2]
        assert s == pytest.approx(want[w][2], rel=1e-6, abs=1e-12), w
    known = {r.word for r in sentences.abbreviations(pieces).collect()}
    assert known == {w for w, (_, _, s) in want.items() if s >= 0.3}
    return known


def test_statistics_equal_plain_python_on_documents(spark):
    check(spark, spark.read.parquet(f"{SF001}/documents.parquet").select("text"))


HAND = " Dr. Ny met the U.S. team, e.g. today. It ended today. They left the team. The U.S. side won. We met. Today they won it."


def test_final_periods_split_and_abbreviations_stay(spark):
    texts = spark.createDataFrame([(HAND * 40,), ("No period here at all, just the team and today.",), (None,), ("",), ("...",)], "text string")
    assert check(spark, texts) == {"dr", "u.s", "e.g"}
    pieces = reports.piece_counts(texts)
    got = {r.token: r.n for r in sentences.sentence_words(pieces, sentences.abbreviations(pieces)).collect()}
    assert got["u.s."] == 80 and got["dr."] == 40 and got["e.g."] == 40
    assert got["today"] == 121 and got["team"] == 81 and not any(t in got for t in ("u.s", "today.", "team."))
    plain = {r.token: r.n for r in reports.word_counts(texts).collect()}
    assert sum(plain.values()) == sum(got.values()) and plain["u.s"] == 80


def test_corpora_without_periods_or_words(spark):
    for rows in ([("no periods here",)], [("",)], [(None,)], [("a. b. c.",)]):
        check(spark, spark.createDataFrame(rows, "text string"))
    none = reports.piece_counts(spark.createDataFrame([("x",)], "text string").where("false"))
    assert sentences.abbreviations(none).collect() == [] and sentences.sentence_words(none, sentences.abbreviations(none)).collect() == []


def test_word_counts_shuffle_distinct_pieces_only(spark):
    """A piece leaves its task once, however often it occurs."""
    df = spark.range(0, 20_000, 1, 4).select(F.lit("Same same, SAME 'same' same.").alias("text"))
    assert {r.token: r.n for r in reports.word_counts(df).collect()} == {"same": 80_000}  # 'same' starts with a quote
    assert split_words("x") is not None
    plan = reports.word_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("partial_sum")  # the tree prints the top first


def test_only_pieces_that_end_in_a_period_are_joined(spark):
    """The others have no word to look up: with one null key for all, a single task would sort them."""
    rows = [(f"w{i}", 1) for i in range(1000)] + [("Dr.", 5), ("dr.", 2), ("End.", 3), ("w7.", 4), ("...", 1), ("'x", 1)]
    pieces = spark.createDataFrame(rows, "raw string, n long")
    known = spark.createDataFrame([("dr",), ("u.s",)], "word string")
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        df = sentences.sentence_words(pieces, known)
        got = {r.token: r.n for r in df.collect()}
        plan = [df._jdf.queryExecution().executedPlan()]
        for node in plan:
            plan += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {f"w{i}": 1 for i in range(1000)} | {"dr.": 7, "end": 3, "w7": 5}
    side = next(n for n in plan if n.nodeName() == "SortMergeJoin").children().apply(0)
    while side.nodeName() != "Exchange":
        side = side.children().apply(0)
    assert side.metrics().apply("shuffleRecordsWritten").value() == 4
