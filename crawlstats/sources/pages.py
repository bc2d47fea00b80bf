"""Scans: captured pages as responses (S1, F19), seed lists (S2), URL files (S3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlstats.functions.scope import Rule, reject_reason

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

RESPONSES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Columns that a table of captures may also have.
OPTIONAL_FIELDS = (
    T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_bytes", T.LongType()),
)

# ---------------------------------------------------------------------------
# What the crawler records for a body over the size limit.
TOO_LARGE_STATUS = 606
TOO_LARGE_ERROR = "FILE TOO LARGE !"
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def capture_schema(spark: SparkSession, path: str) -> T.StructType:
    """The page columns, and those of ``status``, ``error`` and ``n_bytes`` that the files hold."""
    there = spark.read.parquet(path).schema
    kept = [T.StructField(f.name, there[f.name].dataType) for f in OPTIONAL_FIELDS if f.name in there.names]
    return T.StructType([*PAGES_SCHEMA, *kept])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages, with their status, error and stored length where the table has them."""
    return spark.read.schema(capture_schema(spark, path)).parquet(path)


def responses(pages: DataFrame, size_limit: int | None = None) -> DataFrame:
    """S1 + F19: one response per captured page.

    A page table without ``status``/``error`` columns holds fetched bodies,
    so status is 200 and error null. With ``size_limit`` (bytes) a larger body
    becomes status 606 with error ``FILE TOO LARGE !`` and no body. When the
    table stores ``n_bytes`` (the content length) the gate reads that column,
    which Parquet can prune and filter; otherwise it measures the body.
    Without a limit the body is only read by jobs that use it.
    """
    cols = set(pages.columns)
    status = F.col("status").cast("int") if "status" in cols else F.lit(200)
    error = F.col("error").cast("string") if "error" in cols else F.lit(None).cast("string")
    html = F.col("html")
    if size_limit is not None:
        n_bytes = F.col("n_bytes") if "n_bytes" in cols else F.octet_length(html)
        too_large = F.coalesce(n_bytes > F.lit(size_limit), F.lit(False))
        status = F.when(too_large, F.lit(TOO_LARGE_STATUS)).otherwise(status)
        error = F.when(too_large, F.lit(TOO_LARGE_ERROR)).otherwise(error)
        html = F.when(too_large, F.lit(None).cast("string")).otherwise(html)
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        status.alias("status"),
        error.alias("error"),
        html.alias("html"),
    )


def ok_responses(resp: DataFrame) -> DataFrame:
    """only status-200 responses feed links and the Q2-Q4 reports."""
    return resp.where(F.col("status") == 200)


def seed_urls(spark: SparkSession, seeds: str | Sequence[str]) -> DataFrame:
    """Seed URLs from a comma-separated string or a list, one row each.

    Seeds bypass the scope rules (the crawler adds them unchecked).
    """
    csv = seeds if isinstance(seeds, str) else ",".join(seeds)
    return seed_lines(spark.range(1).select(F.lit(csv).alias("seeds")))


def seed_lines(lines: DataFrame, col: str = "seeds") -> DataFrame:
    """S2 over a table of comma-separated seed lists: one row per URL."""
    return lines.select(F.explode(F.split(F.col(col), ",")).alias("url")).where(F.col("url") != "")


def url_file_scan(
    spark: SparkSession,
    path: str,
    domains: Sequence[str],
    profile: str = "basic",
    extra_rules: Sequence[Rule] = (),
    host_only: bool = False,
) -> DataFrame:
    """S3 + F17: one URL per line of a text file, with its verdict."""
    lines = spark.read.text(path).select(F.col("value").alias("url"))
    reason = reject_reason(F.col("url"), domains, profile=profile, extra_rules=extra_rules, host_only=host_only)
    return lines.select("url", reason.isNull().alias("is_valid"), reason.alias("reason"))
