"""Fetch lists that follow each other (W1, W2): a committed clock per bucket.

A list starts, in each bucket, where the list before ended, so no bucket is
visited more often than its delay allows across lists either. The clock is the
number of URLs that earlier lists took from the bucket; several workers share
a bucket's URLs in turn, each keeping the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import written_once
from crawlstats.operators.crawl import Rounds
from crawlstats.operators.frontier import fetch_list


class Clocks:
    """Clocks under ``root``: one committed round for each list, with the URLs it took per bucket."""

    def __init__(self, spark: SparkSession, root: str):
        self.rounds = Rounds(spark, root, "bucket int, taken long")

    def read(self) -> DataFrame:
        """(bucket, taken): URLs of all committed lists, per bucket."""
        last = self.rounds.last()
        if last is None:
            return self.rounds.spark.createDataFrame([], "bucket int, taken long")
        return self.rounds.read(last).groupBy("bucket").agg(F.sum("taken").alias("taken"))

    def commit(self, listed: DataFrame) -> None:
        """Move the clocks past a list."""
        last = self.rounds.last()
        taken = listed.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("taken"))
        self.rounds.commit(0 if last is None else last + 1, taken, "bucket")

    def next_list(self, frontier: DataFrame, delay: float, cap: int | None = None, workers: int = 1) -> DataFrame:
        """(url, bucket, rn, worker, earliest_s): the next list, with its clocks committed.

        ``rn`` goes on where the bucket's clock stands; ``worker`` is 0 up to
        ``workers`` - 1. The list is written once, before the clocks move: a
        driver lost in between repeats the list, never skips a turn.
        """
        own = fetch_list(frontier, delay, cap).select("url", F.col("bucket").cast("int").alias("bucket"), "rn")
        clocks = self.read().select(F.col("bucket").alias("known"), "taken")  # a row a bucket
        own = own.join(clocks, own["bucket"].eqNullSafe(clocks["known"]), "left")
        turn = F.col("rn") + F.coalesce("taken", F.lit(0)) - 1
        listed = written_once(
            own.select(
                "url",
                "bucket",
                (turn + 1).alias("rn"),
                (turn % workers).cast("int").alias("worker"),
                (F.floor(turn / workers) * F.lit(float(delay))).alias("earliest_s"),
            ),
            "fetch-list",
        )
        self.commit(listed)
        return listed
