"""Durable crawl state (S5, R3 for batch): an append-only Parquet table.

A commit writes the rows that changed as a new ``v=<n>`` folder and then
appends its number to a small ``commits`` table, with the version that the
crawl started from. The state is the last row of each URL hash from there on.
A commit that dies half-written is never read, and the crawl resumes from the
one before. Restarting from the seeds starts a new base (older versions stay
as history).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.operators.frontier import STATE_COLUMNS, seed_state
from crawlstats.sources.commits import CommitLog


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits", "version int, base int")

    def _commits(self) -> dict[int, int]:
        """version -> base."""
        return {r.version: r.base for r in self.log.rows()}

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        return sorted(self._commits())

    def latest(self) -> int | None:
        return max(self._commits(), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        """The state as of a version (default: the latest)."""
        commits = self._commits()
        v = max(commits, default=None) if version is None else version
        if v not in commits:
            raise FileNotFoundError(f"no committed crawl state {v} under {self.root}")
        own = [n for n in commits if commits[v] <= n <= v]
        paths = [f"{self.root}/v={n:06d}" for n in sorted(own)]
        schema = "url_hash string, url string, completed boolean, v int"
        rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
        if len(paths) == 1:
            return rows.select(*STATE_COLUMNS)
        last = F.max_by(F.struct("url", "completed"), "v")
        return rows.groupBy("url_hash").agg(last.alias("s")).select("url_hash", "s.url", "s.completed")

    def commit(self, changes: DataFrame, *, base: bool = False) -> int:
        """Append the rows that are new or changed, then record the commit; ``base`` starts a new state."""
        commits = self._commits()
        last = max(commits, default=None)
        v = 0 if last is None else last + 1
        changes.select(*STATE_COLUMNS).write.mode("overwrite").parquet(f"{self.root}/v={v:06d}")
        self.log.append(v, v if base or last is None else commits[last])
        return v

    def start(self, seeds: DataFrame, restart: bool = False) -> DataFrame:
        """Resume the latest state, or start from the seeds.

        ``restart`` starts from the seeds even when a state exists; an empty
        or missing state also starts from the seeds.
        """
        if not restart and self.latest() is not None:
            state = self.read()
            if not state.isEmpty():
                return state
        self.commit(seed_state(seeds), base=True)
        return self.read()
