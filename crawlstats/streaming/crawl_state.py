"""The crawl state kept current as pages arrive.

A URL is unseen, pending or complete, and only ever moves forward. The stream
holds events: a URL was found (on a page, or as a seed) or is done (fetched).
One streaming aggregation keyed by the URL hash keeps what the state needs:
the URL as it was first found, the URL as fetched, and the triggers (their
time stamps, which a replayed trigger keeps) of the first event, of the first
completion and of the last event. A row that a trigger changed thus tells by
itself which step it took: its first event, or its completion, is from that
trigger if it has the stamp of the last event. The running counts add up
these steps; no trigger joins or scans the state.

The changed rows of trigger b are folder ``rows/batch=b`` and its counts a
slot that is written last, so a reader sees whole triggers only, and a
replayed one writes the same again. The aggregation's state is in the
checkpoint; a query started again goes on after the last whole trigger. It
needs a driver clock that does not run backwards between triggers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlstats.config import CrawlParams
from crawlstats.functions.urls import domain_bucket
from crawlstats.operators.frontier import keyed, scope_rule
from crawlstats.operators.links import link_array
from crawlstats.sources.pages import ok_responses

ROWS = "url_hash string, url string, completed boolean, batch long"
COUNTS = "total long, pending long, batch long"


def page_events(pages: DataFrame, params: CrawlParams) -> DataFrame:
    """(url, done, ord) of arriving pages: the page's own URL is done, its valid links are found."""
    own = pages.select("url", F.lit(True).alias("done"), F.col("page_id").alias("ord"))
    links = ok_responses(pages).select(F.col("page_id").alias("ord"), F.explode(link_array("url", "html")).alias("url"))
    valid = links.where(scope_rule(params).isNull())
    return own.unionByName(valid.select("url", F.lit(False).alias("done"), "ord"))


def running_state(events: DataFrame) -> DataFrame:
    """One row per URL hash seen so far (update mode: per trigger, those that had an event).

    ``events`` is (url, done, ord). A found URL keeps its first spelling (by
    trigger, ``ord``, URL); the URL as fetched last replaces it.
    """
    e = keyed(events).withColumn("at", F.current_timestamp())
    done_at = F.when(F.col("done"), F.col("at"))
    return e.groupBy("url_hash").agg(
        F.min_by("url", F.struct("at", "ord", "url")).alias("found_url"),
        F.min_by("url", F.when(F.col("done"), F.struct(-F.unix_micros("at"), "url"))).alias("done_url"),
        F.min("at").alias("first_at"),
        F.min(done_at).alias("done_at"),
        F.max("at").alias("last_at"),
    )


def _changes(rows: DataFrame, params: CrawlParams, revalidate: bool) -> DataFrame:
    """(total, pending): what a trigger's rows add to the counts."""
    counted = (scope_rule(params, "found_url").isNull()) if revalidate else F.lit(True)
    new, complete = F.col("first_at") == F.col("last_at"), F.col("done_at").isNotNull()
    completed_now = complete & (F.col("done_at") == F.col("last_at"))
    pending = F.when(new & ~complete, 1).when(~new & completed_now, -1).otherwise(0)
    return rows.agg(
        F.count_if(new).alias("total"), F.coalesce(F.sum(F.when(counted, pending)), F.lit(0)).alias("pending")
    )


def write_state(
    events: DataFrame, params: CrawlParams, out_path: str, checkpoint: str, *, revalidate: bool = True, available_now: bool = True
) -> StreamingQuery:
    """J5 + A7 as a stream: the state's changed rows and the running counts of every trigger.

    Read them with ``read_state`` and ``read_counts``. ``revalidate`` as in
    ``state_counts``: a pending URL outside the scope rules does not count.
    """
    spark = events.sparkSession

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # the state store has committed it; read twice
        try:
            state = rows.select("url_hash", F.coalesce("done_url", "found_url").alias("url"), F.col("done_at").isNotNull().alias("completed"))
            state.write.mode("overwrite").parquet(f"{out_path}/rows/batch={batch_id}")
            counts = _changes(rows, params, revalidate)
            if batch_id:
                before = _slot(spark, out_path, batch_id - 1)
                if before.isEmpty():
                    raise RuntimeError(f"the counts of trigger {batch_id - 1} are not in {out_path}")
                counts = counts.unionByName(before.select("total", "pending"))
            counts = counts.agg(F.sum("total").alias("total"), F.sum("pending").alias("pending"))
            counts.withColumn("batch", F.lit(batch_id).cast("long")).coalesce(1).write.mode("overwrite").parquet(
                f"{out_path}/counts/slot={batch_id % 2}"
            )
        finally:
            rows.unpersist()

    w = running_state(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(commit)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _slot(spark: SparkSession, out_path: str, batch_id: int) -> DataFrame:
    return spark.read.schema(COUNTS).parquet(f"{out_path}/counts/slot={batch_id % 2}").where(F.col("batch") == batch_id)


def read_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """A7 after the last whole trigger: (total, pending)."""
    slots = spark.read.schema(COUNTS).parquet(f"{out_path}/counts")
    return slots.orderBy(F.col("batch").desc()).limit(1).select("total", "pending")


def read_state(spark: SparkSession, out_path: str) -> DataFrame:
    """The state after the last whole trigger: (url_hash, url, completed)."""
    last = spark.read.schema(COUNTS).parquet(f"{out_path}/counts").agg(F.max("batch")).scalar()
    rows = spark.read.schema(ROWS).parquet(f"{out_path}/rows").where(F.col("batch") <= last)
    latest = F.max_by(F.struct("url", "completed"), "batch")
    return rows.groupBy("url_hash").agg(latest.alias("s")).select("url_hash", "s.url", "s.completed")


def read_pending(spark: SparkSession, out_path: str, params: CrawlParams) -> DataFrame:
    """S4 after the last whole trigger: pending URLs within the scope rules, with their bucket."""
    todo = read_state(spark, out_path).where(~F.col("completed") & scope_rule(params).isNull())
    return todo.select("url_hash", "url", domain_bucket("url", params.buckets).alias("bucket"))
