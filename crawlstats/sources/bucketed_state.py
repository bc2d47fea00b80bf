"""Crawl state in hash buckets, with a membership filter and compaction.

A generation is one bucketed table: every commit appends its changed rows to
the same buckets of the URL hash, so the latest row of a hash, a join on the
hash and an update by key read the state without an exchange; only the other
side is shuffled, to the state's buckets.

Beside it lies a Bloom filter: a row per block of 32,768 bits. A hash belongs
to one block and sets ``PROBES`` bits in it, built by Spark's bitmap
aggregate. A candidate that misses a bit has never been seen and does not meet
the state at all; hits are checked exactly.

``commits`` is the only truth: a small row for each commit with its
generation, the writer's mark that its rows carry, and the size of the filter.
Rows and bits of a writer that died are in no commit and are never read.
``compact`` writes the latest rows as a new generation and then commits it; a
reader goes by the last commit it saw and reads one generation throughout. A
state has one writer at a time. Older generations are deleted by ``drop_before`` when no reader needs them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import written_once
from crawlstats.functions.urls import domain_bucket
from crawlstats.operators.frontier import STATE_COLUMNS, dedup_by_hash, keyed, seed_state
from crawlstats.sources.commits import CommitLog

COMMITS = "version int, generation int, writer string, blocks long, buckets int"
ROWS = "url_hash string, url string, completed boolean, version int, writer string"
FILTER = "block long, bits binary, writer string"
#: Bits of a block, as the bitmap functions have them, and bits that a hash sets in its block.
BLOCK_BITS, PROBES = 32_768, 7
#: Bits of the filter for each row that a generation starts with; commits after it fill the rest.
BITS_PER_ROW = 16


@dataclass(frozen=True)
class Commit:
    version: int
    generation: int
    writer: str
    blocks: int
    buckets: int


def block_of(url_hash: str | Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(url_hash) if isinstance(url_hash, str) else url_hash), F.lit(blocks))


def probe_bits(url_hash: str = "url_hash") -> list[Column]:
    """Places within its block of the bits that a hash sets: two hashes, combined."""
    a = F.pmod(F.xxhash64(F.lit("a"), F.col(url_hash)), F.lit(BLOCK_BITS))
    b = F.pmod(F.xxhash64(F.lit("b"), F.col(url_hash)), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return [F.pmod(a + i * b, F.lit(BLOCK_BITS)) for i in range(PROBES)]


def filter_of(rows: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): the Bloom filter of the hashes in ``rows``."""
    bits = rows.select(block_of("url_hash", blocks).alias("block"), F.explode(F.array(*probe_bits())).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def maybe_seen(bits: Column) -> Column:
    """Whether all bits of the hash beside it are set in its block; false without a block."""
    byte = lambda p: F.conv(F.hex(F.substring(bits, (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.lit(True)
    for p in probe_bits():
        hit = hit & (F.getbit(byte(p), (p % 8).cast("int")) == 1)
    return F.coalesce(hit, F.lit(False))


class BucketedState:
    """Versions of a crawl state under ``root``; ``buckets`` is the layout of generations it starts."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.log = CommitLog(spark, f"{self.root}/commits", COMMITS)

    # --- commits --------------------------------------------------------------

    def commits(self) -> list[Commit]:
        """All commits, by version and generation."""
        return sorted((Commit(*r) for r in self.log.rows()), key=lambda c: (c.generation, c.version))

    def latest(self) -> Commit | None:
        return max(self.commits(), key=lambda c: (c.generation, c.version), default=None)

    def _record(self, c: Commit) -> Commit:
        self.log.append(c.version, c.generation, c.writer, c.blocks, c.buckets)
        return c

    # --- tables -----------------------------------------------------------------

    def _folder(self, generation: int, name: str) -> str:
        return f"{self.root}/generation={generation:06d}/{name}"

    def _table(self, c: Commit) -> str:
        """The catalog's name of a generation's rows; its definition is made where this session lacks it."""
        name = "crawl_state_" + uuid.uuid5(uuid.NAMESPACE_URL, self._folder(c.generation, "rows")).hex
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({ROWS}) USING parquet CLUSTERED BY (url_hash) SORTED BY (url_hash) "
                f"INTO {c.buckets} BUCKETS LOCATION '{self._folder(c.generation, 'rows')}'"
            )
        return name

    def _append(self, c: Commit, rows: DataFrame) -> Commit:
        """Rows and filter bits of a commit, then the commit itself."""
        rows = rows.select(*STATE_COLUMNS, F.lit(c.version).alias("version"), F.lit(c.writer).alias("writer"))
        table = self._table(c)
        placed = rows.repartition(c.buckets, "url_hash")  # one file a bucket
        placed.write.mode("append").format("parquet").bucketBy(c.buckets, "url_hash").sortBy("url_hash").saveAsTable(
            table, path=self._folder(c.generation, "rows")
        )
        self.spark.catalog.refreshTable(table)
        own = self.spark.table(table).where(F.col("writer") == c.writer)
        bits = filter_of(own, c.blocks).withColumn("writer", F.lit(c.writer))
        bits.write.mode("append").parquet(self._folder(c.generation, "filter"))
        return self._record(c)

    def _writers(self, c: Commit) -> list[str]:
        """Marks of the commits whose rows belong to a state."""
        return [x.writer for x in self.commits() if x.generation == c.generation and x.version <= c.version]

    # --- reading ------------------------------------------------------------------

    def rows(self, c: Commit | None = None) -> DataFrame:
        """Every row of the versions up to a commit (default: the latest)."""
        c = c or self.latest()
        if c is None:
            raise FileNotFoundError(f"no committed crawl state under {self.root}")
        table = self._table(c)
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table).where(F.col("writer").isin(self._writers(c)))

    def read(self, c: Commit | None = None) -> DataFrame:
        """The state as of a commit; the buckets make it without an exchange."""
        last = F.max_by(F.struct("url", "completed"), "version")
        return self.rows(c).groupBy("url_hash").agg(last.alias("s")).select("url_hash", "s.url", "s.completed")

    def filter(self, c: Commit | None = None) -> DataFrame:
        """(block, bits): the Bloom filter of all hashes of a commit's state."""
        c = c or self.latest()
        own = self.spark.read.schema(FILTER).parquet(self._folder(c.generation, "filter")).where(F.col("writer").isin(self._writers(c)))
        return own.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    # --- writing --------------------------------------------------------------------

    def start(self, rows: DataFrame) -> Commit:
        """A new state of these rows (url_hash, url, completed), as a new generation."""
        last = self.latest()
        n = rows.count()
        blocks = max(1, -(-n * BITS_PER_ROW // BLOCK_BITS))
        generation = 0 if last is None else last.generation + 1
        version = 0 if last is None else last.version + 1
        return self._append(Commit(version, generation, uuid.uuid4().hex, blocks, self.buckets), rows)

    def seed(self, seeds: DataFrame) -> Commit:
        """A new state of uncompleted seeds."""
        return self.start(seed_state(seeds))

    def commit(self, changes: DataFrame) -> Commit:
        """Append the rows that are new or changed."""
        last = self.latest()
        if last is None:
            raise FileNotFoundError(f"no committed crawl state under {self.root}")
        return self._append(Commit(last.version + 1, last.generation, uuid.uuid4().hex, last.blocks, last.buckets), changes)

    def compact(self) -> Commit:
        """The latest rows as a new generation, with a filter of fitting size."""
        return self.start(self.read())

    def drop_before(self, generation: int) -> None:
        """Delete older generations; only when no reader holds one of them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for c in {c.generation: c for c in self.commits() if c.generation < generation}.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(c)}")
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/generation={c.generation:06d}")
            p.getFileSystem(conf).delete(p, True)

    # --- operators ------------------------------------------------------------------

    def new_urls(self, candidates: DataFrame, buckets: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
        """J1 + X2 as ``frontier.new_urls``: candidates whose hash this state has never seen.

        Candidates that the filter does not know are new; the others meet the
        state's buckets, which are not exchanged.
        """
        c = self.latest()
        fresh = dedup_by_hash(keyed(candidates.select("url", *order)), order)
        placed = fresh.withColumn("block", block_of("url_hash", c.blocks))
        tested = placed.join(self.filter(c), "block", "left").select("url_hash", "url", maybe_seen(F.col("bits")).alias("hit"))
        tested = written_once(tested, "tested")  # read twice
        sure, hits = tested.where(~F.col("hit")), tested.where("hit")
        unseen = hits.join(self.rows(c).select("url_hash").hint("merge"), "url_hash", "left_anti").unionByName(sure)
        return unseen.select("url_hash", "url", domain_bucket("url", buckets).alias("bucket"))

    def complete(self, done: DataFrame) -> Commit:
        """J5 as ``frontier.mark_complete``: fetched URLs become completed rows of the next version.

        An update by key only appends, so the state is not read at all.
        """
        return self.commit(dedup_by_hash(keyed(done.select("url"))).withColumn("completed", F.lit(True)))
