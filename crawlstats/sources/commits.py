"""The commit log of a table that is only appended to: one small row for each commit.

Data is written first, its row last, so what a dead writer left is in no
commit and never read.
"""

from __future__ import annotations

from pyspark.sql import Row, SparkSession

from crawlstats.config import path_exists


class CommitLog:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def rows(self) -> list[Row]:
        if not path_exists(self.spark, self.path):
            return []
        return self.spark.read.schema(self.schema).parquet(self.path).collect()

    def append(self, *values) -> None:
        self.spark.createDataFrame([values], self.schema).coalesce(1).write.mode("append").parquet(self.path)
