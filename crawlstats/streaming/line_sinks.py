"""The crawler's text files as pages arrive: several append sinks of one trigger.

A trigger turns each page into lines in one pass: its own visited line, the
valid links it holds, and its rejected links with their source. All lines of a
trigger are one write, a folder for each file below ``lines/trigger=i``; the
row in ``commits`` that follows makes them visible together. A trigger that is
replayed writes its folder again, so no line is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlstats.config import CrawlParams
from crawlstats.functions.scope import reject_reason
from crawlstats.operators.links import link_array
from crawlstats.sources.sinks import without_fragment

FILES = ("visited", "valid", "rejected")


def page_lines(pages: DataFrame, params: CrawlParams) -> DataFrame:
    """(file, value): the lines of each page; pages of any status are visited, those with status 200 have links."""
    reason = lambda link: reject_reason(
        link, params.domains, max_len=params.max_url_length, extra_rules=params.extra_rules, host_only=params.host_only
    )
    line = lambda file, value: F.struct(file.alias("file"), value.alias("value"))
    src = F.col("url")

    def of_link(link):
        valid = reason(link).isNull()
        return F.when(valid, line(F.lit("valid"), link)).otherwise(line(F.lit("rejected"), F.concat(F.lit("From: "), src, F.lit("\n"), link)))

    links = F.when(F.col("status") == 200, F.transform(link_array("url", "html"), of_link))
    visited = F.array(line(F.lit("visited"), without_fragment("url")))
    lines = pages.select(F.explode(F.concat(visited, F.coalesce(links, F.slice(visited, 1, 0)))).alias("l"))
    return lines.select("l.file", "l.value").where("value is not null")


def write_page_lines(pages: DataFrame, params: CrawlParams, out_path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """S6 + S7 as a stream; read the lines with ``read_lines``."""
    spark = pages.sparkSession

    def trigger(batch: DataFrame, i: int) -> None:
        page_lines(batch, params).write.mode("overwrite").partitionBy("file").text(f"{out_path}/lines/trigger={i}")
        row = spark.createDataFrame([(i,)], "trigger long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/commits/own={i}")

    w = pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(trigger)
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_lines(spark: SparkSession, out_path: str, files: Sequence[str] = FILES) -> DataFrame:
    """(file, line) of the triggers that are committed; a rejected link is two lines, its source first."""
    lines = spark.read.schema("value string, trigger long, file string").option("basePath", f"{out_path}/lines").text(f"{out_path}/lines")
    done = spark.read.schema("trigger long").parquet(f"{out_path}/commits")
    return lines.join(done, "trigger", "left_semi").where(F.col("file").isin(*files)).select("file", F.col("value").alias("line"))
