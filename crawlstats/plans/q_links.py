"""Registered link queries: G1/X1/F15 (page_links), G4 (valid_links), F16+S6 (link_audit)."""

from __future__ import annotations

from crawlstats.operators import links as L
from crawlstats.operators.page_function import call_pages
from crawlstats.plans import oracle as O
from crawlstats.plans.queries import P, register, resp


def page_links_sql(pages: str = "pages") -> str:
    quoted = "starts_with(v, '\"') OR starts_with(v, '\'\'')"
    strip = f"(CASE WHEN {quoted} THEN substr(v, 2, length(v) - 2) ELSE v END)"
    return f"""
    SELECT DISTINCT page_id, src, link FROM (
      SELECT page_id, src, {O.resolve_href('src', 'href')} AS link FROM (
        SELECT page_id, src, {O.decode_entities(strip)} AS href FROM (
          SELECT page_id, url AS src, unnest({O.anchor_hrefs('html')}) AS v FROM {pages}
        )
      )
    ) WHERE NOT contains(link, {O.q(L.ACTION_MARKER)})
    """


def link_audit_sql(extra: str = "", host_only: bool = False) -> str:
    """``extra``: WHEN branches after those of the built-in rules."""
    r = O.reject_reason("link", P.domains, host_only=host_only)[: -len("END)")] + f"{extra} END)"
    return f"SELECT page_id, src, link, {r} AS reason, ({r}) IS NULL AS is_valid FROM ({page_links_sql()})"


@register("page_links", page_links_sql())
def q_page_links(spark, sf_dir):
    return L.page_links(resp(spark, sf_dir))


@register("link_audit", link_audit_sql())
def q_link_audit(spark, sf_dir):
    return L.scrape(resp(spark, sf_dir), P.domains, max_len=P.max_url_length)


@register("link_audit_host_only", link_audit_sql(host_only=True))
def q_link_audit_host_only(spark, sf_dir):
    return L.scrape(resp(spark, sf_dir), P.domains, max_len=P.max_url_length, host_only=True)


@register(
    "valid_links",
    f"SELECT page_id, src, link FROM ({link_audit_sql()}) WHERE is_valid",
)
def q_valid_links(spark, sf_dir):
    return L.valid_links(L.page_links(resp(spark, sf_dir)), P.domains, max_len=P.max_url_length)


@register(
    "crawl_page_function",
    f"""
    SELECT page_id, src, link, NULL::VARCHAR AS failure FROM ({page_links_sql('(SELECT * FROM pages WHERE NOT contains(url, chr(63)))')})
    UNION ALL
    SELECT page_id, url AS src, NULL AS link, 'ValueError: a query' AS failure FROM pages WHERE contains(url, chr(63))
    """,
)
def q_crawl_page_function(spark, sf_dir):
    """A page function that reads anchors with the standard library and fails on URLs with a query."""

    def anchors(url, resp):
        from html.parser import HTMLParser
        from urllib.parse import urljoin

        found = []

        class Reader(HTMLParser):
            def handle_starttag(self, tag, attrs):
                if tag == "a" and dict(attrs).get("href"):
                    found.append(urljoin(url, dict(attrs)["href"]))

        if "?" in url:
            raise ValueError("a query")
        Reader().feed(resp.raw_response.content.decode("utf-8"))
        return [link for link in found if "do=" not in link]

    return call_pages(resp(spark, sf_dir), anchors)
