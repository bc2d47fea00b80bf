"""Crawl state and fetch planning.

The crawl state is a table ``(url_hash, url, completed)`` keyed by the URL
hash. Every operator here shuffles on ``url_hash`` at most once: the hash is
sha256, so keys spread evenly whatever the hosts, and a URL repeated many
times collapses in the map-side partial aggregate before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlstats.config import CrawlParams, ensure_checkpoint_dir
from crawlstats.functions.scope import reject_reason
from crawlstats.functions.urls import domain_bucket, normalize, url_hash

STATE_COLUMNS = ("url_hash", "url", "completed")


def keyed(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the normalised URL (U2) and its hash."""
    return df.withColumn(url_col, normalize(url_col)).withColumn(
        "url_hash", url_hash(F.col(url_col), normalized=True)
    )


def dedup_by_hash(df: DataFrame, order: Sequence[str] = ("url",)) -> DataFrame:
    """One row per url_hash, the earliest by ``order`` (then by URL).

    Links repeat heavily (every page of a site links its navigation), so
    exact repeats are collapsed first by a hash aggregate on (url_hash, url)
    whose buffer is one number; only the distinct spellings of a hash then
    meet in the string-valued ``min_by``, which Spark runs sort-based.
    """
    order = tuple(c for c in order if c != "url")
    if len(order) == 1:
        df = df.groupBy("url_hash", "url").agg(F.min(order[0]).alias(order[0]))
    elif not order:
        df = df.select("url_hash", "url").distinct()
    key = F.struct(*[F.col(c) for c in order], F.col("url"))
    return df.groupBy("url_hash").agg(F.min_by("url", key).alias("url"))


# Bytes of URLs and hashes that a broadcast side may have, whatever its rows.
BROADCAST_MAX_BYTES = 64 << 20


def small_enough(df: DataFrame, broadcast_max_rows: int | None) -> tuple[DataFrame, bool]:
    """Write ``df`` once and tell whether it is within the bounds of rows and bytes.

    Without a bound the plan stays lazy and joins shuffle both sides.
    """
    if broadcast_max_rows is None:
        return df, False
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint()
    size = F.sum(F.octet_length("url_hash") + F.octet_length("url"))
    n, size = done.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return done, n <= broadcast_max_rows and size <= BROADCAST_MAX_BYTES


def new_urls(
    candidates: DataFrame,
    state: DataFrame,
    buckets: Sequence[str],
    order: Sequence[str] = (),
    *,
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """J1 + X2: candidate URLs whose hash the state has never seen.

    Candidates are normalised, hashed and deduplicated first (keeping the
    earliest by ``order``). By default the anti join against the state then
    reuses the aggregate's hash partitioning on ``url_hash``, so only the
    state's hash column is exchanged. With ``broadcast_max_rows``, the deduped
    candidates are written once and, when within the bound, broadcast: the
    state is scanned for the hashes it already knows and never shuffled.
    """
    fresh = dedup_by_hash(keyed(candidates.select("url", *order)), order)
    fresh, small = small_enough(fresh, broadcast_max_rows)
    if small:
        known = state.select("url_hash").join(F.broadcast(fresh.select("url_hash")), "url_hash", "left_semi")
        unseen = fresh.join(known, "url_hash", "left_anti")
    else:
        unseen = fresh.join(state.select("url_hash"), "url_hash", "left_anti")
    return unseen.select("url_hash", "url", domain_bucket("url", buckets).alias("bucket"))


def seed_state(seeds: DataFrame) -> DataFrame:
    """S2 -> state: seeds enter uncompleted, unchecked by the scope rules."""
    fresh = dedup_by_hash(keyed(seeds.select("url")))
    return fresh.select("url_hash", "url", F.lit(False).alias("completed"))


def mark_complete(state: DataFrame, done: DataFrame, *, broadcast_max_rows: int | None = None) -> DataFrame:
    """Set ``completed`` for fetched URLs, inserting unseen ones.

    The fetched URL replaces the stored one, as an update by key would. By
    default this is a full outer join on url_hash. With
    ``broadcast_max_rows``, the fetched set is written once and, when within
    the bound, broadcast: the state is updated in place by a broadcast join
    (no shuffle of the state) and the unseen fetched URLs are appended.
    """
    d = dedup_by_hash(keyed(done.select("url"))).withColumn("done", F.lit(True))
    d, small = small_enough(d, broadcast_max_rows)
    s = state.select("url_hash", F.col("url").alias("old_url"), F.col("completed").alias("old_completed"))
    if small:
        updated = s.join(F.broadcast(d), "url_hash", "left")
        known = s.select("url_hash").join(F.broadcast(d.select("url_hash")), "url_hash", "left_semi")
        inserted = d.join(known, "url_hash", "left_anti").select(
            "url_hash", "url", "done", F.lit(None).cast("string").alias("old_url"),
            F.lit(None).cast("boolean").alias("old_completed"),
        )
        joined = updated.unionByName(inserted)
    else:
        joined = s.join(d, "url_hash", "full_outer")
    return joined.select(
        "url_hash",
        F.coalesce("url", "old_url").alias("url"),
        (F.coalesce("done", F.lit(False)) | F.coalesce("old_completed", F.lit(False))).alias("completed"),
    )


def scope_rule(params: CrawlParams, url: str = "url"):
    """The first rule of the crawl, its own ones included, that a URL fails."""
    return reject_reason(
        url, params.domains, max_len=params.max_url_length, extra_rules=params.extra_rules, host_only=params.host_only
    )


def pending(state: DataFrame, params: CrawlParams, revalidate: bool = True) -> DataFrame:
    """Uncompleted URLs to resume, with their bucket.

    ``revalidate`` re-applies the scope rules as a resumed crawler does; the
    stored URL is normalised, so a bare host root loses the '/' the domain
    rule needs and is dropped. ``revalidate=False`` keeps every pending URL.
    """
    todo = state.where(~F.col("completed"))
    if revalidate:
        todo = todo.where(scope_rule(params).isNull())
    return todo.select("url_hash", "url", domain_bucket("url", params.buckets).alias("bucket"))


def state_counts(state: DataFrame, params: CrawlParams, revalidate: bool = True) -> DataFrame:
    """Total URLs in the state and how many are still to fetch."""
    todo = ~F.col("completed")
    if revalidate:
        todo = todo & scope_rule(params).isNull()
    return state.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(todo).alias("pending"),
    )


def rank_in_group(
    df: DataFrame, group: str, order: str, fanout_hex: int = 3, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without one
    task per group.

    ``order`` is a hex hash (uniform), so its first ``fanout_hex`` digits cut
    every group into 16**fanout_hex even slices. Rows are numbered within a
    slice, slice sizes are counted (at most groups x 16**fanout_hex rows; Spark
    broadcasts them where their size allows) and each slice is shifted by
    the sizes of the slices before it. A group holding a third of all rows
    still spreads over thousands of tasks.
    """
    sliced = df.withColumn("_slice", F.substring(F.col(order), 1, fanout_hex))
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(group, "_slice").orderBy(order, *tiebreak))
    )
    sizes = local.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # Null-safe on both keys: an inner equi-join would make Catalyst add an
    # inferred not-null filter that recomputes the hash expression.
    on = local[group].eqNullSafe(offsets[group]) & local["_slice"].eqNullSafe(offsets["_slice"])
    ranked = local.join(offsets, on, "inner").select(
        local["*"], (offsets["_off"] + local["_local"]).cast("long").alias("rn")
    )
    return ranked.drop("_slice", "_local")


def fetch_list(
    frontier: DataFrame,
    delay: float,
    cap: int | None = None,
    ordered: bool = False,
    fanout_hex: int = 3,
) -> DataFrame:
    """W1 + W2: a domain-balanced, polite fetch list.

    ``rn`` numbers the URLs of each bucket in hash order (then URL); reading by
    ``(rn, bucket)`` takes one URL per bucket in turn. ``earliest_s`` is the
    earliest start (seconds) keeping one fetch per bucket per ``delay``.
    ``cap`` bounds the list per bucket (the job's stated size), ``ordered``
    adds the global read order (a range-partitioned sort).
    """
    ranked = rank_in_group(
        frontier.select("url_hash", "url", "bucket"), "bucket", "url_hash", fanout_hex, tiebreak=("url",)
    )
    out = ranked.select(
        "url",
        "bucket",
        "rn",
        ((F.col("rn") - 1) * F.lit(float(delay))).alias("earliest_s"),
    )
    if cap is not None:
        out = out.where(F.col("rn") <= cap)
    if ordered:
        out = out.orderBy("rn", F.col("bucket").asc_nulls_last())
    return out
