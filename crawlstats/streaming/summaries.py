"""Reports of a stream whose state is bounded: distinct sketches and heavy hitters.

The exact running reports keep a key for every page or word ever seen. These
keep summaries that merge: each trigger reduces its own pages to a summary and
merges it with that of the triggers before, which ``slots.Slots`` holds. No
state store is used, and a page delivered twice counts twice among the words
(the sketches do not mind).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlstats.functions.urls import normalize, page_key, subdomain, url_parts
from crawlstats.operators.reports import remove_stop_words, word_counts
from crawlstats.sources.pages import ok_responses
from crawlstats.streaming.slots import Slots

#: log2 of a sketch's registers; the relative standard error is 1.04 / sqrt(2 ** LG_K), 0.8 %.
LG_K = 14
SKETCHES = "name string, sketch binary"
WORDS = "token string, lower long, upper long, error long"


def relative_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an estimate."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def sketches(pages: DataFrame, anchor: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """(name, sketch): HLL sketch of the distinct pages, per subdomain of ``anchor`` (Q4) or of all (Q1, name empty)."""
    key = F.to_json(page_key(normalize("url"))).alias("key")
    if anchor is None:
        rows = pages.select(F.lit("").alias("name"), key)
    else:
        rows = ok_responses(pages).select(subdomain(url_parts("url")["netloc"], anchor).alias("name"), key).where("name is not null")
    return rows.groupBy("name").agg(F.hll_sketch_agg("key", lg_k).alias("sketch"))


def estimates(sketch_rows: DataFrame) -> DataFrame:
    """(name, n_pages): the estimated number of distinct pages."""
    return sketch_rows.select("name", F.hll_sketch_estimate("sketch").alias("n_pages"))


def _run(stream: DataFrame, slots: Slots, checkpoint: str, merge, available_now: bool) -> StreamingQuery:
    def trigger(batch: DataFrame, i: int) -> None:
        slots.write(merge(batch, slots.before(i)), i)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(trigger)
    return (w.trigger(availableNow=True) if available_now else w).start()


def write_sketches(
    pages: DataFrame, out_path: str, checkpoint: str, anchor: str | None = None, *, lg_k: int = LG_K, available_now: bool = True
) -> StreamingQuery:
    """A1 or A5 as a stream of merged sketches: a row a name, whatever the number of pages."""

    def merge(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        own = sketches(batch, anchor, lg_k)
        if before is None:
            return own
        return own.unionByName(before).groupBy("name").agg(F.hll_union_agg("sketch").alias("sketch"))

    return _run(pages, Slots(pages.sparkSession, out_path, SKETCHES), checkpoint, merge, available_now)


def read_sketches(spark: SparkSession, out_path: str) -> DataFrame:
    return Slots(spark, out_path, SKETCHES).last()


def merge_heavy(counts: DataFrame, before: DataFrame | None, size: int) -> DataFrame:
    """Heavy hitters of counts (token, n) and a summary: (token, lower, upper, error), at most ``size`` tokens.

    Counts are added; with more than ``size`` tokens the count of the first
    one left out is taken off all (P. Agarwal and others, Mergeable Summaries,
    PODS 2012). ``lower`` is what is left, ``error`` what has been taken off
    in all, and a token's true count lies between ``lower`` and ``lower + error``;
    that of a token without a row is ``error`` at most.
    """
    both = counts.select("token", F.col("n").alias("lower"))
    error: Column = F.lit(0).cast("long")
    if before is not None:
        both = both.unionByName(before.where("token is not null").select("token", "lower")).groupBy("token").agg(F.sum("lower").alias("lower"))
        error = F.coalesce(before.agg(F.max("error")).scalar(), F.lit(0)).cast("long")
    # The most frequent tokens and the first one left out; bounded by the summary's size.
    top = both.orderBy(F.col("lower").desc(), "token").limit(size + 1)
    top = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("lower")).alias("minus"), "token"))).alias("top"))
    cut = F.coalesce(-F.try_element_at("top", F.lit(size + 1))["minus"], F.lit(0))
    left = top.select((error + cut).alias("error"), cut.alias("cut"), F.explode_outer("top").alias("t"))
    left = left.select(F.col("t.token").alias("token"), (-F.col("t.minus") - F.col("cut")).alias("lower"), "error")
    # One row carries the error where no token is left.
    whole = left.select(F.when(F.col("lower") > 0, F.col("token")).alias("token"), F.greatest("lower", F.lit(0)).alias("lower"), "error").distinct()
    return whole.select("token", "lower", (F.col("lower") + F.col("error")).alias("upper"), "error")


def write_heavy_words(
    pages: DataFrame, stop_words: DataFrame, out_path: str, checkpoint: str, *, size: int = 10_000, available_now: bool = True
) -> StreamingQuery:
    """A4 + T1 as a stream of bounded state: the most frequent words with lower and upper counts."""

    def merge(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        counts = remove_stop_words(word_counts(ok_responses(batch), "html", html=True), stop_words)
        return merge_heavy(counts, before, size)

    return _run(pages, Slots(pages.sparkSession, out_path, WORDS), checkpoint, merge, available_now)


def read_heavy_words(spark: SparkSession, out_path: str) -> DataFrame:
    """(token, lower, upper) of the words in the summary."""
    return Slots(spark, out_path, WORDS).last().where("token is not null").select("token", "lower", "upper")
