"""Registered queries of sources, sinks and options: what they write is read back.

S2 seed_scan, S3 url_file_scan, S5/R3 state_store, S6 link_audit_lines, S7
visited_lines, S8 report_lines, E2 extra_rules_audit and
resume_pending_extra, E1/R3/I1 crawl_resume, F1/F19 by the ``_status``
queries (batch and stream), G1-G3 on ordinary HTML by the ``_variants``
queries.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from crawlstats.config import shared_dir
from crawlstats.operators import crawl as C
from crawlstats.operators import frontier as FR
from crawlstats.operators import links as L
from crawlstats.operators import reports
from crawlstats.plans import fixtures as X
from crawlstats.plans import oracle as O
from crawlstats.plans import q_frontier as QF
from crawlstats.plans import q_streams as QS
from crawlstats.plans.q_links import link_audit_sql, page_links_sql
from crawlstats.plans.queries import P, longest_page_sql, page_words_sql, pages, register, resp, subdomains_sql
from crawlstats.sources import sinks
from crawlstats.sources.bucketed_state import BucketedState
from crawlstats.sources.pages import responses, seed_lines, url_file_scan
from crawlstats.sources.state import StateStore
from crawlstats.streaming import streams as S

# A user's rule, in Spark and in SQL.
ODD_PATH = ("odd_path", lambda u, p: F.length(p["path"]) % 2 == 1)
EXTRA = replace(P, extra_rules=(ODD_PATH,))


def _odd_path_sql(u: str) -> str:
    return f"length({O.path(u)}) % 2 = 1"


# --- S2, S3, S5 --------------------------------------------------------------------

@register("seed_scan", "SELECT unnest([url, url || '?seed']) AS url FROM pages")
def q_seed_scan(spark, sf_dir):
    lists = pages(spark, sf_dir).select(F.concat("url", F.lit(",,"), "url", F.lit("?seed")).alias("seeds"))
    return seed_lines(lists)


@register(
    "url_file_scan",
    f"""
    SELECT url, ({O.reject_reason('url', P.domains, 'basic')}) IS NULL AS is_valid,
           {O.reject_reason('url', P.domains, 'basic')} AS reason
    FROM pages
    """,
)
def q_url_file_scan(spark, sf_dir):
    path = shared_dir(spark, "url-file")
    pages(spark, sf_dir).select("url").write.text(path)
    return url_file_scan(spark, path, P.domains)


@register("state_store", X.crawl_state_sql())
def q_state_store(spark, sf_dir):
    """Seeds, then one commit with the completed URLs only; the store is opened again to read."""
    state, root = X.crawl_state(pages(spark, sf_dir)), shared_dir(spark, "state")
    StateStore(spark, root).start(state.select("url"))
    StateStore(spark, root).commit(state.where("completed"))
    return StateStore(spark, root).read()


def _bucketed_state(spark, sf_dir) -> BucketedState:
    store = BucketedState(spark, shared_dir(spark, "bucketed-state"), buckets=16)
    store.start(QF._state(spark, sf_dir))
    return store


@register("state_bucketed_new_urls", QF.new_urls_sql())
def q_state_bucketed_new_urls(spark, sf_dir):
    """J1 against the bucketed state: the filter tells most new URLs, hits meet the buckets."""
    return _bucketed_state(spark, sf_dir).new_urls(QF.candidates(spark, sf_dir), P.buckets, order=("page_id",))


@register("state_bucketed_complete", QF.state_complete_sql())
def q_state_bucketed_complete(spark, sf_dir):
    """J5 as an append of completed rows, read after a compaction of both versions."""
    store = _bucketed_state(spark, sf_dir)
    store.complete(QF.completions(spark, sf_dir, store.read()))
    store.compact()
    return store.read()


# --- S6, S7, S8 ----------------------------------------------------------------------

@register(
    "link_audit_lines",
    f"""
    WITH a AS ({link_audit_sql()})
    SELECT 'valid' AS file, link AS line FROM a WHERE is_valid
    UNION ALL
    SELECT 'rejected' AS file, unnest(['From: ' || src, link]) AS line FROM a WHERE NOT is_valid
    """,
)
def q_link_audit_lines(spark, sf_dir):
    valid, rejected = shared_dir(spark, "valid-links"), shared_dir(spark, "rejected-links")
    L.write_link_audit_text(L.scrape(resp(spark, sf_dir), P.domains, max_len=P.max_url_length), valid, rejected)
    files = [spark.read.text(p).select(F.lit(n).alias("file"), F.col("value").alias("line")) for n, p in (("valid", valid), ("rejected", rejected))]
    return files[0].unionByName(files[1])


@register("visited_lines", "SELECT unnest([regexp_replace(url, '#.*$', ''), regexp_replace(url, '#.*$', '')]) AS line FROM pages")
def q_visited_lines(spark, sf_dir):
    path = shared_dir(spark, "visited")
    for _ in range(2):  # the sink appends
        sinks.write_visited(resp(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _line_sql(line: str, *columns: str) -> str:
    return f"printf({O.q(line)}, {', '.join(columns)})"


@register(
    "report_lines",
    f"""
    SELECT 'Q2' AS report, {_line_sql(sinks.LONGEST_PAGE_LINE, 'url', 'n_tokens')} AS line FROM ({longest_page_sql()})
    UNION ALL SELECT 'Q3' AS report, {_line_sql(sinks.TOP_WORD_LINE, 'token', 'n')} AS line FROM ({page_words_sql()})
    UNION ALL SELECT 'Q4' AS report, {_line_sql(sinks.SUBDOMAIN_LINE, 'nice_link', 'n_pages')} AS line FROM ({subdomains_sql()})
    """,
)
def q_report_lines(spark, sf_dir):
    r = resp(spark, sf_dir)
    lines = {
        "Q2": sinks.longest_page_lines(reports.longest_page(r)),
        "Q3": sinks.top_words_lines(reports.top_page_words(spark, r)),
        "Q4": sinks.subdomain_lines(reports.subdomain_pages(r, P.anchor)),
    }
    out = None
    for name, df in lines.items():
        path = shared_dir(spark, f"report-{name}")
        sinks.write_report_lines(df, path)
        back = spark.read.text(path).select(F.lit(name).alias("report"), F.col("value").alias("line"))
        out = back if out is None else out.unionByName(back)
    return out


# --- E1, E2, R3 ------------------------------------------------------------------------

@register("extra_rules_audit", link_audit_sql(f" WHEN {_odd_path_sql('link')} THEN 'odd_path'"))
def q_extra_rules_audit(spark, sf_dir):
    return L.scrape(resp(spark, sf_dir), P.domains, max_len=P.max_url_length, extra_rules=EXTRA.extra_rules)


@register(
    "resume_pending_extra",
    f"""
    SELECT url_hash, url, {O.domain_bucket('url', P.buckets)} AS bucket FROM ({X.crawl_state_sql()})
    WHERE NOT completed AND {O.reject_reason('url', P.domains)} IS NULL AND NOT ({_odd_path_sql('url')})
    """,
)
def q_resume_pending_extra(spark, sf_dir):
    return FR.pending(X.crawl_state(pages(spark, sf_dir)), EXTRA)


@register(
    "crawl_resume",
    f"""
    WITH RECURSIVE e AS ({X.edges_sql()}),
    ok AS (SELECT page_id FROM pages WHERE {O.reject_reason('url', P.domains)} IS NULL),
    walk(node) AS (
      SELECT node FROM ({X.seed_pages_sql(P.buckets)})
      UNION
      SELECT e.dst FROM walk w JOIN e ON e.src = w.node JOIN ok ON ok.page_id = e.dst
    )
    SELECT DISTINCT {O.url_hash('url')} AS url_hash, true AS completed FROM pages JOIN walk ON page_id = node
    """,
)
def q_crawl_resume(spark, sf_dir):
    """A crawl over derived links that stops after its second round and is resumed from its folder."""
    pg = pages(spark, sf_dir)
    to = pg.select(F.col("page_id").alias("dst"), F.col("url").alias("link"))
    derived = X.edges(pg).join(to, "dst").select(F.col("src").alias("page_id"), "link")
    extractor = lambda captured: derived.join(captured.select("page_id", F.col("url").alias("src")), "page_id").select("page_id", "src", "link")
    seeds = pg.join(X.seed_pages(pg, P.buckets), F.col("page_id") == F.col("node")).select("url")
    root, captured = shared_dir(spark, "crawl"), responses(pg)
    rounds = C.crawl_rounds(captured, seeds, P, root=root, extractor=extractor)
    for k in rounds:
        if k == 2:
            break
    rounds.close()
    return C.crawl(captured, seeds, P, root=root, extractor=extractor, revalidate=False).select("url_hash", "completed")


# --- F1, F19: pages with a status ----------------------------------------------------------

def _status_pages(spark, sf_dir):
    return X.with_status(pages(spark, sf_dir))


@register("q2_longest_page_status", longest_page_sql(X.with_status_sql()))
def q2_status(spark, sf_dir):
    return reports.longest_page(responses(_status_pages(spark, sf_dir)))


@register("q3_top_words_status", page_words_sql(X.with_status_sql()))
def q3_status(spark, sf_dir):
    return reports.top_page_words(spark, responses(_status_pages(spark, sf_dir)))


@register("q4_subdomains_status", subdomains_sql(X.with_status_sql()))
def q4_status(spark, sf_dir):
    return reports.subdomain_pages(responses(_status_pages(spark, sf_dir)), P.anchor)


@register("stream_longest_page_status", longest_page_sql(X.with_status_sql()))
def stream_q2_status(spark, sf_dir):
    return QS.run_report(spark, _status_pages(spark, sf_dir), S.running_longest_page)


@register("stream_top_words_status", page_words_sql(X.with_status_sql()))
def stream_q3_status(spark, sf_dir):
    return QS.run_top_words(spark, _status_pages(spark, sf_dir))


@register("stream_subdomains_status", subdomains_sql(X.with_status_sql()))
def stream_q4_status(spark, sf_dir):
    return QS.run_subdomains(spark, _status_pages(spark, sf_dir))


# --- G1-G3: ordinary HTML ---------------------------------------------------------------------

@register("q3_top_words_variants", page_words_sql(X.html_variants_sql()))
def q3_variants(spark, sf_dir):
    return reports.top_page_words(spark, responses(X.html_variants(pages(spark, sf_dir))))


@register("page_links_variants", page_links_sql(X.html_variants_sql()))
def page_links_variants(spark, sf_dir):
    return L.page_links(responses(X.html_variants(pages(spark, sf_dir))))
