"""Crawl rounds: captured-page lookup (J4), link-graph closure and the crawl loop.

A round is one DataFrame plan that writes its new rows as a folder of a
rounds table and then commits them with their number and size, which the
write itself counts; the size ends the loop at a true fixpoint and decides
whether the next frontier is broadcast (within bounds of rows and bytes) or
shuffled. The crawl loop reads the captured HTML once, into a table of links
keyed by the hash of the URL each page answers. Written rounds cut lineage, so
a lost executor recomputes at most one round, and a lost driver resumes after
the last committed one.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import CrawlParams, ensure_checkpoint_dir, shared_dir
from crawlstats.operators.frontier import STATE_COLUMNS, dedup_by_hash, keyed, pending, scope_rule, seed_state, small_enough
from crawlstats.operators.gates import robots_gate
from crawlstats.operators.links import Extractor, page_links
from crawlstats.sources.commits import CommitLog

NOT_CAPTURED = "not captured"


def captured_index(captured: DataFrame) -> DataFrame:
    """(url_hash, page_id): one captured page per URL hash, the smallest id.

    Built once per crawl from two columns, so the HTML is not moved.
    """
    k = keyed(captured.select("page_id", "url"))
    return k.groupBy("url_hash").agg(F.min("page_id").alias("page_id"))


def lookup_captured(
    frontier: DataFrame,
    captured: DataFrame,
    index: DataFrame | None = None,
    *,
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """The captured response of each frontier URL (the re-aimed fetch).

    Frontier rows without a captured page get status null and an error. With
    ``broadcast_max_rows``, a frontier within the bound (written once and
    counted) is broadcast into the index and the captured pages, which are
    then scanned instead of shuffled; only the matching rows meet the frontier.
    """
    idx = index if index is not None else captured_index(captured)
    cap = captured.select("page_id", "status", "error")
    frontier, small = small_enough(frontier, broadcast_max_rows)
    if small:
        idx = idx.join(F.broadcast(frontier.select("url_hash")), "url_hash", "left_semi")
        cap = cap.join(F.broadcast(idx.select("page_id")), "page_id", "left_semi")
    hit = frontier.join(idx, "url_hash", "left")
    out = hit.join(cap, "page_id", "left")
    return out.select(
        "url_hash",
        "url",
        "page_id",
        F.col("status").cast("int").alias("status"),
        F.when(F.col("page_id").isNull(), F.lit(NOT_CAPTURED)).otherwise(F.col("error")).alias("error"),
    )


class Rounds:
    """A table of rounds under ``root``, only ever appended to.

    Round k is a folder of its own, committed by a row in ``commits`` that
    holds its size, so a round that dies half-written is written again and
    never read. Sizes come from the write itself.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.root}/commits", "round int, n long, bytes long")

    def _commits(self) -> dict[int, tuple[int, int]]:
        return {r["round"]: (r["n"], r["bytes"]) for r in self.log.rows()}

    def last(self) -> int | None:
        return max(self._commits(), default=None)

    def size(self, k: int) -> tuple[int, int]:
        """Rows of round k, and the bytes of its key."""
        return self._commits()[k]

    def commit(self, k: int, df: DataFrame, key: str) -> tuple[int, int]:
        seen = Observation()
        size = F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0))
        df = df.observe(seen, F.count(F.lit(1)).alias("n"), size.alias("bytes"))
        df.write.mode("overwrite").parquet(f"{self.root}/rounds/round={k}")
        n, size = seen.get["n"], seen.get["bytes"]
        self.log.append(k, n, size)
        return n, size

    def read(self, upto: int) -> DataFrame:
        """All rows of the rounds up to ``upto``, with their round."""
        return self.spark.read.schema(f"{self.schema}, round int").parquet(f"{self.root}/rounds").where(F.col("round") <= upto)

    def one(self, k: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/rounds/round={k}")


def reachable(
    seeds: DataFrame,
    edges: DataFrame,
    *,
    broadcast_max_rows: int = 1_000_000,
    broadcast_max_bytes: int = 64 << 20,
    root: str | None = None,
) -> DataFrame:
    """I1 on a graph: every node reachable from the seeds, with its depth.

    Semi-naive breadth-first rounds: only the nodes found in the previous
    round are expanded, and only unseen ones are kept, up to the fixpoint.
    Rounds are committed under ``root``; a later call with the same root goes
    on after the last one. A frontier within both bounds is broadcast against
    the edges; a larger one shuffles, where Spark can split the edges of a hub.
    """
    spark = seeds.sparkSession
    ensure_checkpoint_dir(spark)
    edges = edges.select("src", "dst")
    kind = dict(seeds.dtypes)["node"]
    table = Rounds(spark, root or shared_dir(spark, "visited"), f"node {kind}")
    depth = table.last()
    if depth is None:
        depth = 0
        n, size = table.commit(0, seeds.select("node").distinct(), "node")
    else:
        n, size = table.size(depth)
    while n:
        src = table.one(depth).withColumnRenamed("node", "src")
        small = n <= broadcast_max_rows and size <= broadcast_max_bytes
        step = edges.join(F.broadcast(src) if small else src, "src", "left_semi")
        fresh = step.select(F.col("dst").alias("node")).distinct().join(table.read(depth).select("node"), "node", "left_anti")
        depth += 1
        n, size = table.commit(depth, fresh, "node")
    return table.read(depth).select("node", F.col("round").alias("depth"))


def crawl_edges(
    captured: DataFrame,
    params: CrawlParams,
    *,
    extractor: Extractor | None = None,
    robots: DataFrame | None = None,
) -> DataFrame:
    """(src_hash, url_hash, url, page_id): the valid out-links of the page that
    answers each URL hash (G1, G4, F16, optional J3), from one pass over the
    captured pages.

    Every captured page is fetched at most once in a crawl, so its HTML is read
    once here instead of once per round; only the (small) link rows are
    shuffled, to keep the links of the page each hash is answered by
    (``captured_index``: the smallest page_id).
    """
    extract_fn = extractor or page_links
    links = extract_fn(captured)
    reason = scope_rule(params, "link")
    valid = links.where(reason.isNull()).select("page_id", F.col("link").alias("url"))
    if robots is not None:
        valid = robots_gate(valid, robots).where("allowed").drop("allowed")
    answering = captured_index(captured).withColumnRenamed("url_hash", "src_hash")
    return keyed(valid).join(answering, "page_id").select("src_hash", "url_hash", "url", "page_id")


def crawl_rounds(
    captured: DataFrame,
    seeds: DataFrame,
    params: CrawlParams,
    *,
    root: str,
    extractor: Extractor | None = None,
    state: DataFrame | None = None,
    robots: DataFrame | None = None,
    revalidate: bool = True,
) -> Iterator[int]:
    """The crawl loop, one committed round at a time; yields each round's number.

    All state is under ``root``: the link table of the captured pages, and the
    rounds. A call with a root that has rounds goes on after the last one; with
    ``revalidate`` its pending URLs pass the scope rules again first (S4), as
    do those of a given ``state``.
    """
    spark = captured.sparkSession
    table = Rounds(spark, root, "url_hash string, url string, completed boolean")
    links = Rounds(spark, f"{root.rstrip('/')}/links", "src_hash string, url_hash string, url string, page_id long")
    if links.last() is None:
        links.commit(0, crawl_edges(captured, params, extractor=extractor, robots=robots), "src_hash")
    edges = links.one(0)
    k = table.last()
    resumed = k is not None or state is not None
    if k is None:
        k = 0
        n, size = table.commit(0, state.select(*STATE_COLUMNS) if state is not None else seed_state(seeds), "url_hash")
        yield 0
    else:
        n, size = table.size(k)
    while n:
        todo = table.one(k).where(~F.col("completed"))
        if resumed and revalidate:
            todo, resumed = pending(todo, params), False
        src = todo.select(F.col("url_hash").alias("src_hash"))
        small = n <= params.broadcast_max_rows and size <= params.broadcast_max_bytes
        found = edges.join(F.broadcast(src) if small else src, "src_hash", "left_semi").select("url_hash", "url", "page_id")
        fresh = dedup_by_hash(found, ("page_id",)).join(table.read(k).select("url_hash"), "url_hash", "left_anti")
        k += 1
        n, size = table.commit(k, fresh.select("url_hash", "url", F.lit(False).alias("completed")), "url_hash")
        yield k


def crawl(
    captured: DataFrame,
    seeds: DataFrame,
    params: CrawlParams,
    *,
    root: str | None = None,
    extractor: Extractor | None = None,
    state: DataFrame | None = None,
    robots: DataFrame | None = None,
    revalidate: bool = True,
) -> DataFrame:
    """I1 on captured pages: the crawl loop until no unseen valid URL is left.

    Each round fetches the pending URLs from the captured responses (J4),
    takes the valid links of the fetched pages (G1, G4) and keeps the unseen
    ones (J1, X2, earliest by page_id then URL); those are the next round's
    frontier. ``captured`` holds ``(page_id, url, status, error, html)``;
    seeds bypass the scope rules; ``state`` resumes an earlier crawl state
    instead of the seeds; ``root`` keeps the crawl, and resumes one that
    stopped there (see ``crawl_rounds``); ``robots`` (host, path_prefix, allow)
    drops links the rules disallow (J3, off when not given).

    The HTML is read once: ``crawl_edges`` turns the captured pages into link
    rows keyed by the hash of the URL that fetches them. Every URL added in
    round k is fetched in round k+1, so rounds are only ever appended, and
    completion (J5) is settled by one projection at the end: all are completed
    but a given state's URLs that ``revalidate`` dropped. Returns the crawl
    state ``(url_hash, url, completed)``.
    """
    spark = captured.sparkSession
    ensure_checkpoint_dir(spark)
    root = root or shared_dir(spark, "crawl")
    for _ in crawl_rounds(captured, seeds, params, root=root, extractor=extractor, state=state, robots=robots, revalidate=revalidate):
        pass
    table = Rounds(spark, root, "url_hash string, url string, completed boolean")
    rows = table.read(table.last())
    done = F.lit(True)
    if state is not None and revalidate:
        done = (F.col("round") > 0) | F.col("completed") | scope_rule(params).isNull()
    return rows.select("url_hash", "url", done.alias("completed"))
