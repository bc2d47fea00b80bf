"""Reports and URL dedup kept current as pages arrive.

Pages arrive as Parquet files read by a file stream. A page file delivered
twice (a re-capture of the same URL) is dropped by a streaming
``dropDuplicates`` before anything is counted, so the running reports equal
the batch reports over the distinct captures. Bounded reports (Q1, Q2, Q4)
run in ``complete`` mode and are written by ``foreachBatch`` as an overwrite
of a Parquet table (idempotent, so a replayed batch leaves the same table);
the top words run in ``update`` mode and merge only changed counts into the
stored top k;
discovered URLs run in ``append`` mode into a Parquet file sink, whose
commit log makes the output exactly-once. The checkpoint (offsets and the
RocksDB state store) lives under ``spark.checkpoint.dir``, so a restarted
query resumes where it stopped.

No event time exists in this data, so there are no watermarks: dedup state
grows with the number of distinct keys, as the crawl state itself does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlstats.config import CrawlParams
from crawlstats.functions.scope import reject_reason
from crawlstats.functions.text import clean_token, page_token_count, split_words, visible_text
from crawlstats.functions.urls import nice_link, normalize, page_key, subdomain, url_hash, url_parts
from crawlstats.operators.links import link_array
from crawlstats.sources.pages import capture_schema, ok_responses, responses


def page_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1, size_limit: int | None = None) -> DataFrame:
    """Responses (S1, F19) as a file stream, with the status that the first files have."""
    files = (
        spark.readStream.schema(capture_schema(spark, path))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )
    return responses(files, size_limit)


def distinct_captures(pages: DataFrame, value: Column) -> DataFrame:
    """(value) of one status-200 capture of a page: a later one of the same URL hash is dropped.

    ``value`` is made in the page's own row first, so the shuffle by URL hash
    holds what is counted, never the HTML. The capture that arrives first
    stays; the batch reports keep the one with the smallest id, which differs
    only where a page was captured again with other content.
    """
    ok = ok_responses(pages).select(url_hash("url").alias("url_hash"), value.alias("value"))
    return ok.dropDuplicates(["url_hash"]).select("value")


def running_unique_pages(pages: DataFrame) -> DataFrame:
    """Distinct fragment-free URLs so far (dedup, then count)."""
    keyed = pages.select(F.to_json(page_key(normalize("url"))).alias("key")).dropDuplicates(["key"])
    return keyed.agg(F.count(F.lit(1)).alias("unique_pages"))


def running_longest_page(pages: DataFrame) -> DataFrame:
    """The longest page so far (status-200 captures).

    No dedup: a re-delivery has the same URL and length and a larger id, so
    the max (ties to the smallest id) is the same whatever the arrival order.
    """
    counts = ok_responses(pages).where(F.col("html").isNotNull()).select(
        "page_id", "url", page_token_count("html").alias("n_tokens")
    )
    best = F.max_by(F.struct("url", "n_tokens"), F.struct(F.col("n_tokens"), -F.col("page_id")))
    return counts.agg(best.alias("b")).select(
        normalize(F.col("b.url")).alias("url"), F.col("b.n_tokens").alias("n_tokens")
    )


def running_word_counts(pages: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """Count per word so far, stop words removed.

    Stop words are removed before the aggregation here (an ``InSet`` filter
    on a fixed list), since a stream-static anti join cannot follow a
    streaming aggregation.
    """
    kept = list(stop_words)
    words = F.filter(F.transform(split_words(visible_text("html")), clean_token), lambda w: w.isNotNull() & ~w.isin(kept))
    toks = distinct_captures(pages, words).select(F.explode("value").alias("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def running_top_words(pages: DataFrame, stop_words: Sequence[str], k: int = 50) -> DataFrame:
    """R1 / Q3 in complete mode: top-k words so far (re-ranks every word each
    trigger; ``write_top_k_updates`` does the same work per changed word)."""
    counts = running_word_counts(pages, stop_words)
    return counts.orderBy(F.col("n").desc(), F.col("token").asc()).limit(k)


def write_top_k_updates(
    counts: DataFrame, out_path: str, checkpoint: str, k: int = 50, *, available_now: bool = True
) -> StreamingQuery:
    """R1 / Q3 in update mode: keep a top-k table exact from changed counts only.

    Counts only grow, so a word outside the current top k can enter it only
    in a trigger where its count changed, and then it is among the trigger's
    updated rows. The new top k is the top k of (current table with updated
    words replaced) and the updates: each trigger ranks its changed words and
    k stored rows instead of the whole vocabulary. Updated rows carry
    absolute counts, so a replayed trigger leaves the same table.

    Two slots take turns: trigger i writes slot i mod 2 and reads the other,
    which it never touches, so a driver that dies while it writes loses
    nothing. Rows carry their trigger's number; a slot that is not the one of
    the trigger before is an error, never an empty history. Read the result
    with ``read_top_k``.
    """
    spark = counts.sparkSession
    order = [F.col("n").desc(), F.col("token").asc()]

    def merge(batch: DataFrame, batch_id: int) -> None:
        merged = batch.select("token", "n")
        if batch_id:
            stored = spark.read.schema(_TOP_SCHEMA).parquet(f"{out_path}/slot={(batch_id - 1) % 2}")
            if stored.where(F.col("batch") == batch_id - 1).isEmpty():
                raise RuntimeError(f"the top words of trigger {batch_id - 1} are not in {out_path}")
            current = stored.where("token is not null").select("token", "n")
            merged = current.join(merged.select("token"), "token", "left_anti").unionByName(merged)
        mark = spark.range(1).select(F.lit(None).cast("string").alias("token"), F.lit(0).cast("long").alias("n"))
        top = merged.orderBy(*order).limit(k).unionByName(mark).withColumn("batch", F.lit(batch_id).cast("long"))
        top.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/slot={batch_id % 2}")

    w = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(merge)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


_TOP_SCHEMA = "token string, n long, batch long"


def read_top_k(spark: SparkSession, out_path: str) -> DataFrame:
    """(token, n): the top words after the last trigger that ended."""
    rows = spark.read.schema(_TOP_SCHEMA + ", slot int").parquet(out_path)
    last = rows.agg(F.max("batch").alias("last"))
    return rows.join(F.broadcast(last), F.col("batch") == F.col("last")).where("token is not null").select("token", "n")


def _subdomain_rows(pages: DataFrame, anchor: str) -> DataFrame:
    p = url_parts("url")
    return pages.select(
        "page_id",
        subdomain(p["netloc"], anchor).alias("subdomain"),
        nice_link(p["netloc"]).alias("nice_link"),
        F.to_json(page_key(normalize("url"))).alias("key"),
    ).where(F.col("subdomain").isNotNull())


def running_subdomain_counts(pages: DataFrame, anchor: str) -> DataFrame:
    """Unique pages per subdomain so far.

    ``count_distinct`` is not allowed on a stream, so page keys are
    deduplicated first and then counted.
    """
    rows = _subdomain_rows(ok_responses(pages), anchor).select("subdomain", "key")
    return rows.dropDuplicates(["key"]).groupBy("subdomain").agg(F.count(F.lit(1)).alias("n_pages"))


def running_subdomain_links(pages: DataFrame, anchor: str) -> DataFrame:
    """Host of the first page (smallest id) of each subdomain so far.

    Taken over every row rather than after the dedup, so it does not depend on
    which delivery of a page arrived first.
    """
    rows = _subdomain_rows(ok_responses(pages), anchor)
    return rows.groupBy("subdomain").agg(F.min_by("nice_link", "page_id").alias("nice_link"))


def running_new_urls(pages: DataFrame, params: CrawlParams) -> DataFrame:
    """R2: every valid discovered URL once, keyed by its hash (append mode)."""
    links = distinct_captures(pages, link_array("url", "html")).select(F.explode("value").alias("link"))
    reason = reject_reason(
        F.col("link"), params.domains, max_len=params.max_url_length, extra_rules=params.extra_rules, host_only=params.host_only
    )
    valid = links.where(reason.isNull()).select(normalize("link").alias("url"))
    keyed = valid.withColumn("url_hash", url_hash(F.col("url"), normalized=True))
    return keyed.dropDuplicates(["url_hash"])


def write_report(df: DataFrame, out_path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Complete-mode report: every trigger overwrites a Parquet table."""

    def overwrite(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(overwrite)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def write_appends(df: DataFrame, out_path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Append-mode output into an exactly-once Parquet file sink."""
    w = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
    )
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
