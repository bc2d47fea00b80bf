"""Connected components of a links table by alternating stars.

A round rewires the links of each node to its smallest neighbour, first for
its larger neighbours (large star), then for its smaller ones (small star).
The links end as one star per component, after a number of rounds
logarithmic in its length. Minima are combined before the shuffle, each
round is a written table, and the joins shuffle both sides, so that Spark can
split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import written


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _rewired(links: DataFrame) -> DataFrame:
    """(u, v, m): each link with the smallest of u and u's partners."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(written(least, "least"), "u")


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node u with the smallest node v of its component, u > v.

    ``links`` holds pairs (u, v) of longs in any order; loops are ignored.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = written(links, "links")
    mark = _mark(links)
    while mark[0]:
        both = written(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = _rewired(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        r = _rewired(large)
        small = r.select("u", F.col("m").alias("v")).union(r.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = written(small.distinct(), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links
