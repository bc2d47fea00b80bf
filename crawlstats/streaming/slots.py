"""A small table that every trigger of a stream replaces, kept whole through crashes.

Two slots take turns: trigger i writes slot i mod 2 and reads the other, which
it never touches, so a driver that dies while it writes loses nothing and a
replayed trigger writes the same again. Rows carry their trigger's number, and
a row of nulls marks a table without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Slots:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, trigger long, marked boolean").parquet(path)

    def before(self, trigger: int) -> DataFrame | None:
        """The rows of the trigger before; None for the first one."""
        if not trigger:
            return None
        rows = self._read(f"{self.path}/slot={(trigger - 1) % 2}").where(F.col("trigger") == trigger - 1)
        if rows.isEmpty():
            raise RuntimeError(f"what trigger {trigger - 1} wrote is not in {self.path}")
        return rows.where("not marked").drop("trigger", "marked")

    def write(self, rows: DataFrame, trigger: int) -> None:
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
        whole = rows.withColumn("marked", F.lit(False)).unionByName(mark.withColumn("marked", F.lit(True)))
        whole.withColumn("trigger", F.lit(trigger).cast("long")).write.mode("overwrite").parquet(f"{self.path}/slot={trigger % 2}")

    def last(self) -> DataFrame:
        """The rows that the last whole trigger wrote."""
        rows = self._read(self.path)
        return rows.where((F.col("trigger") == rows.agg(F.max("trigger")).scalar()) & ~F.col("marked")).drop("trigger", "marked")
