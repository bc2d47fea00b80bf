"""Registered streaming queries (R1, R2): run to completion, read the sink.

The source folder holds every page of ``pages`` and, in files written later,
a second delivery of every page under a new id (``page_id + max + 1``), so the
stream sees repeats in later micro-batches. The streaming result must equal
the batch query over ``pages``, so the oracle SQL is the batch SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import shared_dir
from crawlstats.functions.stop_words import ENGLISH_STOP_WORDS
from crawlstats.functions.urls import url_parts
from crawlstats.plans import oracle as O
from crawlstats.plans.q_links import link_audit_sql
from crawlstats.operators import reports
from crawlstats.plans.queries import _ORACLES, P, _top_words_sql, pages, register, subdomains_sql
from crawlstats.sources.pages import responses
from crawlstats.plans import q_frontier as QF
from crawlstats.streaming import crawl_state as CS
from crawlstats.streaming import line_sinks as LS
from crawlstats.streaming import streams as S
from crawlstats.streaming import summaries as SU


def stage_source(spark: SparkSession, pg: DataFrame) -> tuple[str, int]:
    """Write the stream's input (pages, then re-deliveries) to the shared folder, a file a split.

    Also returns the files of a delivery, which one trigger reads.
    """
    offset = pg.select(F.max("page_id") + 1).scalar()
    path = shared_dir(spark, "stream-src")
    pg.write.parquet(path)
    files = max(1, len(spark.read.parquet(path).inputFiles()))
    pg.withColumn("page_id", F.col("page_id") + offset).write.mode("append").parquet(path)
    return path, files


def run_report(spark, pg, build) -> DataFrame:
    src, files = stage_source(spark, pg)
    out, ckpt = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-ckpt")
    q = S.write_report(build(S.page_stream(spark, src, files)), out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out)


def run_top_words(spark, pg) -> DataFrame:
    """Q3 kept current in update mode: each trigger re-ranks changed words only."""
    src, files = stage_source(spark, pg)
    out, ckpt = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-ckpt")
    counts = S.running_word_counts(S.page_stream(spark, src, files), ENGLISH_STOP_WORDS)
    S.write_top_k_updates(counts, out, ckpt).awaitTermination()
    return S.read_top_k(spark, out)


def run_subdomains(spark, pg) -> DataFrame:
    """Q4 as two running aggregates over one source (page counts after dedup,
    first host over all rows); the report joins their small result tables."""
    src, files = stage_source(spark, pg)
    outs = []
    for build in (S.running_subdomain_counts, S.running_subdomain_links):
        out, ckpt = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-ckpt")
        S.write_report(build(S.page_stream(spark, src, files), P.anchor), out, ckpt).awaitTermination()
        outs.append(spark.read.parquet(out))
    counts, links = outs
    return links.join(counts, "subdomain").select("subdomain", "nice_link", "n_pages")


@register("stream_top_words")
def q_stream_top_words(spark, sf_dir):
    return run_top_words(spark, pages(spark, sf_dir))


@register("stream_subdomains")
def q_stream_subdomains(spark, sf_dir):
    return run_subdomains(spark, pages(spark, sf_dir))


@register("stream_unique_pages")
def q_stream_unique_pages(spark, sf_dir):
    return run_report(spark, pages(spark, sf_dir), S.running_unique_pages)


@register("stream_longest_page")
def q_stream_longest_page(spark, sf_dir):
    return run_report(spark, pages(spark, sf_dir), S.running_longest_page)


@register(
    "stream_new_urls",
    f"""
    SELECT DISTINCT {O.url_hash('url', normalized=True)} AS url_hash, {O.netloc('url')} AS netloc,
           {O.path('url')} AS path, {O.query('url')} AS query
    FROM (SELECT {O.normalize('link')} AS url FROM ({link_audit_sql()}) WHERE is_valid)
    """,
)
def q_stream_new_urls(spark, sf_dir):
    src, files = stage_source(spark, pages(spark, sf_dir))
    out, ckpt = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-ckpt")
    q = S.write_appends(S.running_new_urls(S.page_stream(spark, src, files), P), out, ckpt)
    q.awaitTermination()
    p = url_parts("url")
    # Twins differing only in scheme share a hash; the parts below are fixed by it.
    return spark.read.parquet(out).select(
        "url_hash", p["netloc"].alias("netloc"), p["path"].alias("path"), p["query"].alias("query")
    )


# --- the crawl state as events and pages arrive (J5, A7, S4) --------------------

def run_state(spark, deliveries: list[DataFrame]) -> str:
    """The state's folder after each delivery of events (url, done, ord) was read by a trigger."""
    src, out, ckpt = (shared_dir(spark, f"stream-{d}") for d in ("events", "state", "ckpt"))
    for events in deliveries:
        events.write.mode("append").parquet(src)
        files = max(1, len(events.sparkSession.read.parquet(src).inputFiles()))
        stream = spark.readStream.schema("url string, done boolean, ord long").option("maxFilesPerTrigger", files).parquet(src)
        CS.write_state(stream, P, out, ckpt).awaitTermination()
    return out


def _state_deliveries(spark, sf_dir) -> list[DataFrame]:
    """The fixture's state as events, then the completions of ``state_complete``, in a query started again."""
    st = QF._state(spark, sf_dir)
    loaded = st.select("url", F.col("completed").alias("done"), F.lit(0).cast("long").alias("ord"))
    done = QF.completions(spark, sf_dir, st).select("url", F.lit(True).alias("done"), F.lit(1).cast("long").alias("ord"))
    return [loaded, done]


@register("stream_state", QF.state_complete_sql())
def q_stream_state(spark, sf_dir):
    return CS.read_state(spark, run_state(spark, _state_deliveries(spark, sf_dir)))


@register(
    "stream_state_counts",
    f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE NOT completed AND {O.reject_reason('url', P.domains)} IS NULL) AS pending
    FROM ({QF.state_complete_sql()})
    """,
)
def q_stream_state_counts(spark, sf_dir):
    return CS.read_counts(spark, run_state(spark, _state_deliveries(spark, sf_dir)))


def _crawl_state_sql() -> str:
    return f"""
    WITH found AS (
      SELECT {O.url_hash('url', normalized=True)} AS url_hash, arg_min(url, (page_id, url)) AS url
      FROM (SELECT page_id, {O.normalize('link')} AS url FROM ({link_audit_sql()}) WHERE is_valid) GROUP BY 1
    ),
    done AS (
      SELECT {O.url_hash('url', normalized=True)} AS url_hash, min(url) AS url FROM (SELECT {O.normalize('url')} AS url FROM pages) GROUP BY 1
    )
    SELECT url_hash, url, true AS completed FROM done
    UNION ALL SELECT url_hash, url, false AS completed FROM found WHERE url_hash NOT IN (SELECT url_hash FROM done)
    """


@register("stream_crawl_state", _crawl_state_sql())
def q_stream_crawl_state(spark, sf_dir):
    """The state of a crawl whose pages arrive twice: captured URLs are complete, their other valid links pending."""
    src, files = stage_source(spark, pages(spark, sf_dir))
    out, ckpt = shared_dir(spark, "stream-state"), shared_dir(spark, "stream-ckpt")
    CS.write_state(CS.page_events(S.page_stream(spark, src, files), P), P, out, ckpt).awaitTermination()
    return CS.read_state(spark, out)


@register(
    "stream_crawl_pending",
    f"""
    SELECT url_hash, url, {O.domain_bucket('url', P.buckets)} AS bucket FROM ({_crawl_state_sql()})
    WHERE NOT completed AND {O.reject_reason('url', P.domains)} IS NULL
    """,
)
def q_stream_crawl_pending(spark, sf_dir):
    src, files = stage_source(spark, pages(spark, sf_dir))
    out, ckpt = shared_dir(spark, "stream-state"), shared_dir(spark, "stream-ckpt")
    CS.write_state(CS.page_events(S.page_stream(spark, src, files), P), P, out, ckpt).awaitTermination()
    return CS.read_pending(spark, out, P)


# --- bounded summaries and line sinks -------------------------------------------

#: Triggers in which ``page_files`` delivers the pages.
TRIGGERS = 4


def page_files(spark, pg) -> tuple[DataFrame, str]:
    """A stream that reads the pages in four triggers, and a checkpoint for it.

    A file has few row groups, and a row group is read by one task. So a
    trigger gets as many files as the pages have splits, not a single one
    that grows with them.
    """
    src = shared_dir(spark, "stream-src")
    pg.repartition(TRIGGERS * max(1, pg.rdd.getNumPartitions()), "page_id").write.parquet(src)
    files = len(spark.read.parquet(src).inputFiles())
    return S.page_stream(spark, src, max(1, math.ceil(files / TRIGGERS))), shared_dir(spark, "stream-ckpt")


@register(
    "stream_page_lines",
    f"""
    WITH a AS ({link_audit_sql()}), lines AS (
      SELECT 'visited' AS file, regexp_replace(url, '#.*$', '') AS line FROM pages
      UNION ALL SELECT 'valid' AS file, link AS line FROM a WHERE is_valid
      UNION ALL SELECT 'rejected' AS file, unnest(['From: ' || src, link]) AS line FROM a WHERE NOT is_valid
    )
    SELECT file, line FROM lines
    """,
)
def q_stream_page_lines(spark, sf_dir):
    stream, ckpt = page_files(spark, pages(spark, sf_dir))
    out = shared_dir(spark, "page-lines")
    LS.write_page_lines(stream, P, out, ckpt).awaitTermination()
    return LS.read_lines(spark, out)


#: Words that the summary of the registered query keeps.
HEAVY_WORDS = 2000


@register(
    "stream_heavy_words",
    f"SELECT token, n, true AS within FROM ({_top_words_sql('pages', O.visible_text('html'))})",
)
def q_stream_heavy_words(spark, sf_dir):
    """The true top words, each with whether its count lies within the bounds of the stream's summary."""
    pg = pages(spark, sf_dir)
    stream, ckpt = page_files(spark, pg)
    out, stop = shared_dir(spark, "heavy-words"), reports.english_stop_words(spark)
    SU.write_heavy_words(stream, stop, out, ckpt, size=HEAVY_WORDS).awaitTermination()
    top = reports.top_words(reports.remove_stop_words(reports.word_counts(responses(pg), "html", html=True), stop))
    found = top.join(SU.read_heavy_words(spark, out), "token", "left")
    within = F.coalesce(F.col("n").between(F.col("lower"), F.col("upper")), F.lit(False))
    return found.select("token", "n", within.alias("within"))


@register(
    "stream_page_sketches",
    f"""
    SELECT '' AS name, count(DISTINCT {O.page_key(O.normalize('url'))}) AS n_pages, true AS within FROM pages
    UNION ALL SELECT subdomain AS name, n_pages, true AS within FROM ({subdomains_sql()})
    """,
)
def q_stream_page_sketches(spark, sf_dir):
    """Q1 and Q4 exactly, each with whether the stream's merged sketch is within its stated error."""
    pg = pages(spark, sf_dir)
    stream, ckpt = page_files(spark, pg)
    estimates = []
    for anchor in (None, P.anchor):
        out = shared_dir(spark, "sketches")
        SU.write_sketches(stream, out, ckpt if anchor else shared_dir(spark, "stream-ckpt"), anchor).awaitTermination()
        estimates.append(SU.estimates(SU.read_sketches(spark, out)).withColumnRenamed("n_pages", "estimate"))
    resp = responses(pg)
    exact = reports.unique_pages(resp).select(F.lit("").alias("name"), F.col("unique_pages").alias("n_pages"))
    exact = exact.unionByName(reports.subdomain_pages(resp, P.anchor).select(F.col("subdomain").alias("name"), "n_pages"))
    found = exact.join(estimates[0].unionByName(estimates[1]), "name", "left")
    close = F.abs(F.col("estimate") - F.col("n_pages")) <= F.greatest(F.lit(1.0), SU.relative_error() * F.col("n_pages"))
    return found.select("name", "n_pages", F.coalesce(close, F.lit(False)).alias("within"))


# The running reports must equal the batch reports: same oracle SQL.
for _stream, _batch in (
    ("stream_top_words", "q3_top_words"),
    ("stream_subdomains", "q4_subdomains"),
    ("stream_unique_pages", "q1_unique_pages"),
    ("stream_longest_page", "q2_longest_page"),
):
    _ORACLES[_stream] = _ORACLES[_batch]
