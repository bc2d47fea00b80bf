"""Physical-plan properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF0001
from crawlstats.operators import links as L
from crawlstats.plans import queries as registry
from crawlstats.sources.pages import responses


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan))


def test_reports_read_only_needed_columns(spark):
    q = E.queries()
    for name in ("q1_unique_pages", "q4_subdomains", "url_reject_reason"):
        reads = re.findall(r"ReadSchema: (struct<[^>]*>)", _final_plan(q[name](spark, SF0001)))
        assert reads and all("html" not in r for r in reads), (name, reads)
    reads = re.findall(r"ReadSchema: (struct<[^>]*>)", _final_plan(q["q3_top_words"](spark, SF0001)))
    # Without later captures of a URL the anti join goes at run time, and so do ids and URLs.
    assert reads == ["struct<html:string>"]


def test_stop_words_join_is_broadcast_after_aggregate(spark):
    plan = _final_plan(E.queries()["q3_top_words"](spark, SF0001))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "TakeOrderedAndProject" in plan


def test_no_python_in_batch_queries(spark):
    for name, fn in registry.queries().items():
        if name.startswith("stream_") or name.startswith("crawl_"):
            continue
        plan = _final_plan(fn(spark, SF0001))
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas)", plan), name


def test_links_do_not_shuffle_on_split_input(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").repartition(16)  # one exchange of our own
    plan = _final_plan(L.page_links(responses(pages)))
    assert _exchanges(plan) == 1


def test_round_joins_shuffle_both_sides_beyond_the_bounds(spark):
    """A frontier over the byte bound is not broadcast: a hub's edges then come from a plain shuffle, which Spark can split."""
    from crawlstats.operators.crawl import reachable

    edges = spark.range(200).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    seeds = spark.createDataFrame([(0,)], "node long")
    got = {r.node: r.depth for r in reachable(seeds, edges, broadcast_max_bytes=0).collect()}
    assert got == {i: min(i, 1) for i in range(200)}


def test_rounds_keep_their_sizes_and_ignore_the_uncommitted(spark, tmp_dir):
    from crawlstats.operators.crawl import Rounds

    t = Rounds(spark, tmp_dir + "/rounds", "node long")
    assert t.last() is None
    assert t.commit(0, spark.range(5).select(F.col("id").alias("node")), "node") == (5, 5)
    spark.range(9).select(F.col("id").alias("node")).write.parquet(tmp_dir + "/rounds/rounds/round=1")  # died before its commit
    assert t.last() == 0 and t.read(0).count() == 5
    assert t.commit(1, spark.range(2).select(F.col("id").alias("node")), "node") == (2, 2)
    assert t.read(1).count() == 7 and t.one(1).count() == 2


def _exchanged(plan: str) -> list[str]:
    """The output columns of what each exchange shuffles (formatted plan)."""
    return re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]", plan)


def test_streams_shuffle_no_html(spark, tmp_dir):
    from crawlstats.config import TEST_PARAMS as P
    from crawlstats.functions.stop_words import ENGLISH_STOP_WORDS
    from crawlstats.streaming import streams as S

    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    pages.write.parquet(tmp_dir + "/src")
    stream = S.page_stream(spark, tmp_dir + "/src")
    for df in (S.running_word_counts(stream, ENGLISH_STOP_WORDS), S.running_new_urls(stream, P)):
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        inputs = _exchanged(plan)
        assert inputs and all("html" not in i for i in inputs), plan


def test_word_count_of_recaptured_pages_shuffles_no_html(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    twice = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from crawlstats.operators import reports as R

        df = R.top_page_words(spark, responses(twice))
        assert df.collect() == R.top_page_words(spark, responses(pages)).collect()
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        inputs = _exchanged(plan)
        assert inputs and all("html" not in i for i in inputs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
