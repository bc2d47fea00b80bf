"""Registered crawl-state, fetch-planning, gate and closure queries.

J1/X2 frontier_new_urls, J5 state_complete, A7 state_counts, S4
resume_pending, W1/W2 fetch_list, J4 captured_lookup, F19 size_gate, J3
robots_gate, I1 crawl_closure (link graph) and crawl_pages (the crawl loop
over captured pages).

The fixture state here is derived from the same pages as the candidates, so
it is no larger than them; J1, J4 and J5 therefore run their default lazy
plans. Their ``broadcast_max_rows`` option (write the small side once, then
broadcast it) pays off when the state dwarfs a round's candidates, as in a
long crawl, and is tested on every path in pytest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlstats.config import shared_dir
from crawlstats.operators import crawl as C
from crawlstats.operators import frontier as FR
from crawlstats.operators import gates as G
from crawlstats.operators import links as L
from crawlstats.operators.clocks import Clocks
from crawlstats.plans import fixtures as X
from crawlstats.plans import oracle as O
from crawlstats.plans.q_links import link_audit_sql
from crawlstats.plans.queries import P, pages, register, resp
from crawlstats.sources.pages import TOO_LARGE_ERROR, TOO_LARGE_STATUS, responses


# --- Spark side ----------------------------------------------------------------

def _state(spark, sf_dir):
    return X.crawl_state(pages(spark, sf_dir))


def candidates(spark, sf_dir):
    """(page_id, url): every valid link of a page, and scheme twins of the pages."""
    pg = pages(spark, sf_dir)
    valid = L.valid_links(L.page_links(responses(pg)), P.domains, max_len=P.max_url_length)
    return valid.select("page_id", F.col("link").alias("url")).unionByName(X.scheme_twins(pg))


def _new(spark, sf_dir, st=None):
    st = st if st is not None else _state(spark, sf_dir)
    return FR.new_urls(candidates(spark, sf_dir), st, P.buckets, order=("page_id",))


def _frontier(spark, sf_dir):
    st = _state(spark, sf_dir)
    return FR.pending(st, P).unionByName(_new(spark, sf_dir, st))


# --- SQL side -------------------------------------------------------------------

def new_urls_sql() -> str:
    return f"""
    SELECT url_hash, url, {O.domain_bucket('url', P.buckets)} AS bucket FROM (
      SELECT url_hash, arg_min(url, (page_id, url)) AS url FROM (
        SELECT page_id, url, {O.url_hash('url', normalized=True)} AS url_hash FROM (
          SELECT page_id, {O.normalize('url')} AS url FROM (
            SELECT page_id, link AS url FROM ({link_audit_sql()}) WHERE is_valid
            UNION ALL
            SELECT page_id, url FROM ({X.scheme_twins_sql()})
          )
        )
      ) GROUP BY url_hash
    ) WHERE url_hash NOT IN (SELECT url_hash FROM ({X.crawl_state_sql()}))
    """


def _pending_sql() -> str:
    return f"""
    SELECT url_hash, url, {O.domain_bucket('url', P.buckets)} AS bucket
    FROM ({X.crawl_state_sql()})
    WHERE NOT completed AND {O.reject_reason('url', P.domains)} IS NULL
    """


def _frontier_sql() -> str:
    return f"SELECT * FROM ({_pending_sql()}) UNION ALL SELECT * FROM ({new_urls_sql()})"


# --- queries ------------------------------------------------------------------

@register("frontier_new_urls", new_urls_sql())
def q_frontier_new_urls(spark, sf_dir):
    return _new(spark, sf_dir)


@register("resume_pending", _pending_sql())
def q_resume_pending(spark, sf_dir):
    return FR.pending(_state(spark, sf_dir), P)


@register(
    "state_counts",
    f"""
    SELECT count(*) AS total,
           count(*) FILTER (WHERE NOT completed AND {O.reject_reason('url', P.domains)} IS NULL) AS pending
    FROM ({X.crawl_state_sql()})
    """,
)
def q_state_counts(spark, sf_dir):
    return FR.state_counts(_state(spark, sf_dir), P)


def state_complete_sql() -> str:
    return f"""
    WITH st AS ({X.crawl_state_sql()}),
    done AS (
      SELECT url_hash, min(url) AS url FROM (
        SELECT url_hash, url FROM ({new_urls_sql()})
        UNION ALL
        SELECT url_hash, url FROM ({_pending_sql()}) WHERE bucket = 0
      ) GROUP BY url_hash
    )
    SELECT coalesce(st.url_hash, done.url_hash) AS url_hash,
           coalesce(done.url, st.url) AS url,
           (done.url_hash IS NOT NULL) OR coalesce(st.completed, false) AS completed
    FROM st FULL OUTER JOIN done ON st.url_hash = done.url_hash
    """


def completions(spark, sf_dir, st):
    """(url): what was fetched next, all new URLs and the pending ones of the first bucket."""
    return _new(spark, sf_dir, st).select("url").unionByName(FR.pending(st, P).where(F.col("bucket") == 0).select("url"))


@register("state_complete", state_complete_sql())
def q_state_complete(spark, sf_dir):
    st = _state(spark, sf_dir)
    return FR.mark_complete(st, completions(spark, sf_dir, st))


@register(
    "fetch_list",
    f"""
    SELECT url, bucket, rn, CAST((rn - 1) * {P.delay} AS DOUBLE) AS earliest_s FROM (
      SELECT url, bucket, row_number() OVER (PARTITION BY bucket ORDER BY url_hash, url) AS rn
      FROM ({_frontier_sql()})
    )
    """,
)
def q_fetch_list(spark, sf_dir):
    return FR.fetch_list(_frontier(spark, sf_dir), P.delay)


@register(
    "fetch_lists_clocked",
    f"""
    SELECT url, bucket, rn, CAST((rn - 1) % 2 AS INTEGER) AS worker, CAST((rn - 1) // 2 * {P.delay} AS DOUBLE) AS earliest_s FROM (
      SELECT url, bucket, row_number() OVER (PARTITION BY bucket ORDER BY list, url_hash, url) AS rn
      FROM (SELECT *, 1 AS list FROM ({_pending_sql()}) UNION ALL SELECT *, 2 AS list FROM ({new_urls_sql()}))
    )
    """,
)
def q_fetch_lists_clocked(spark, sf_dir):
    """Two lists in a row, the pending URLs and then the new ones, for two workers a bucket."""
    st = _state(spark, sf_dir)
    clocks = Clocks(spark, shared_dir(spark, "clocks"))
    first = clocks.next_list(FR.pending(st, P), P.delay, workers=2)
    return first.unionByName(clocks.next_list(_new(spark, sf_dir, st), P.delay, workers=2))


@register(
    "captured_lookup",
    f"""
    WITH idx AS (
      SELECT {O.url_hash('url')} AS url_hash, min(page_id) AS page_id FROM pages GROUP BY 1
    ),
    cap AS (
      SELECT page_id,
             CASE WHEN strlen(html) > {P.size_limit} THEN {TOO_LARGE_STATUS} ELSE 200 END AS status,
             CASE WHEN strlen(html) > {P.size_limit} THEN {O.q(TOO_LARGE_ERROR)} END AS error
      FROM pages
    )
    SELECT f.url_hash, f.url, idx.page_id, cap.status,
           CASE WHEN idx.page_id IS NULL THEN {O.q(C.NOT_CAPTURED)} ELSE cap.error END AS error
    FROM ({_frontier_sql()}) f LEFT JOIN idx ON f.url_hash = idx.url_hash
    LEFT JOIN cap ON idx.page_id = cap.page_id
    """,
)
def q_captured_lookup(spark, sf_dir):
    captured = resp(spark, sf_dir, P.size_limit)
    return C.lookup_captured(_frontier(spark, sf_dir), captured)


@register(
    "size_gate",
    f"""
    SELECT page_id, url,
           CASE WHEN strlen(html) > {P.size_limit} THEN {TOO_LARGE_STATUS} ELSE 200 END AS status,
           CASE WHEN strlen(html) > {P.size_limit} THEN {O.q(TOO_LARGE_ERROR)} END AS error
    FROM pages
    """,
)
def q_size_gate(spark, sf_dir):
    return resp(spark, sf_dir, P.size_limit).select("page_id", "url", "status", "error")


@register(
    "robots_gate",
    f"""
    WITH r AS ({X.robots_rules_sql()}),
    u AS (
      SELECT page_id, url, {O.netloc('url')} AS host,
             CASE WHEN {O.path('url')} = '' THEN '/' ELSE {O.path('url')} END
             || CASE WHEN {O.query('url')} <> '' THEN '?' || {O.query('url')} ELSE '' END AS path
      FROM ({X.root_urls_sql()})
    ),
    m AS (
      SELECT u.page_id, u.url, r.allow, length(r.path_prefix) AS len
      FROM u LEFT JOIN r ON r.host = u.host AND r.path_prefix <> '' AND starts_with(u.path, r.path_prefix)
    )
    SELECT page_id, url, coalesce(arg_max(allow, (len, allow)), true) AS allowed
    FROM m GROUP BY page_id, url
    """,
)
def q_robots_gate(spark, sf_dir):
    pg = pages(spark, sf_dir)
    return G.robots_gate(X.root_urls(pg), X.robots_rules(pg))


@register(
    "crawl_closure",
    f"""
    WITH RECURSIVE e AS ({X.edges_sql()}),
    walk(node, depth) AS (
      SELECT node, 0 FROM ({X.seed_pages_sql(P.buckets)})
      UNION
      SELECT e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.node
      WHERE w.depth < (SELECT count(*) FROM pages)
    )
    SELECT node, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY node
    """,
)
def q_crawl_closure(spark, sf_dir):
    pg = pages(spark, sf_dir)
    out = C.reachable(X.seed_pages(pg, P.buckets), X.edges(pg), broadcast_max_rows=P.broadcast_max_rows)
    return out.select("node", F.col("depth").cast("long").alias("depth"))


@register(
    "crawl_pages",
    f"""
    WITH seeds AS (
      SELECT url_hash, min(url) AS url FROM (
        SELECT {O.normalize('url')} AS url, {O.url_hash('url')} AS url_hash FROM pages
      ) GROUP BY url_hash
    ),
    fetched AS (
      SELECT min(page_id) AS page_id FROM (SELECT page_id, {O.url_hash('url')} AS h FROM pages) GROUP BY h
    ),
    cand AS (
      SELECT url_hash, arg_min(url, (page_id, url)) AS url FROM (
        SELECT page_id, url, {O.url_hash('url', normalized=True)} AS url_hash FROM (
          SELECT page_id, {O.normalize('link')} AS url FROM ({link_audit_sql()})
          WHERE is_valid AND page_id IN (SELECT page_id FROM fetched)
        )
      ) GROUP BY url_hash
    )
    SELECT url_hash, url, true AS completed FROM seeds
    UNION ALL
    SELECT url_hash, url, true AS completed FROM cand WHERE url_hash NOT IN (SELECT url_hash FROM seeds)
    """,
)
def q_crawl_pages(spark, sf_dir):
    """I1 over the captured pages, seeded with every captured URL (a re-crawl).

    Round 1 fetches every page and queues the unseen valid links; round 2
    finds none of them captured (every captured URL is already a seed), so the
    loop stops with all URLs completed.
    """
    pg = pages(spark, sf_dir)
    return C.crawl(responses(pg), pg.select("url"), P)
