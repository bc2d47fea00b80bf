"""Inputs derived from the supplied tables (FIXTURES.md §3), in Spark and SQL.

The supplied page URLs trigger few scope rules, so the URL queries also run
over variants built from every page URL by appending fixed suffixes. Each
variant set is a generator over the whole ``pages`` table (``explode`` of a
literal array), never a join with a literal table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.functions.urls import normalize
from crawlstats.plans import oracle as O

# ---------------------------------------------------------------------------
# Suffixes appended to page URLs, each with the rule it should
# trigger (None: must stay valid; the near misses).
SUFFIXES = (
    ("/x", None),
    ("/x.pdf", "path_extension"),
    ("/x?f=a.zip", "query_extension"),
    ("/2024-01-31/x", "date"),
    ("/events/category/x", "event_category"),
    ("/x#top", "fragment"),
    ("/" + "a" * 250, "length"),
    ("/x?a=1&filter%5Bk%5D=2", "filter"),
    ("/q/x/q/y", "repeating_directory"),
    ("/q/q/y", "repeating_directory"),
    ("/sites/all/themes/x", "cms_directories"),
    ("/calendar/x", "calendar"),
    ("/x?ical=1", "ical"),
    ("/q/x/q", None),
    ("/sites/all/x", None),
    ("/x.pdfx", None),
    ("/2024-1-31/x", None),
    ("/x?a=1&filter=2", None),
)
# Hrefs resolved against every page URL (U7, F15):
HREFS = (
    "/a/b",
    "/a/../b",
    "//www.x.example.com/p",
    "//cdn.example.com/p",
    "www.x.example.com/p",
    "page.html",
    "../x",
    "#top",
    "?q=1",
    "mailto:a@b",
    "https://x.example.com/p?do=edit",
    "https://x.example.com/p",
    "/a/./b/.",
    "/../c;p?q=1#f",
    "////x.example.com/p",
)
# ---------------------------------------------------------------------------

STEM_END = "[?#].*$"


def url_variants(pages: DataFrame) -> DataFrame:
    """(page_id, url, expected): page URLs, suffix variants and other schemes.

    Suffix variants are made from every page URL with its query, fragment
    and trailing slashes taken off; ``ftp:`` twins of https pages must fail
    the scheme rule; a stray '[' in the host must be malformed.
    """
    u = F.col("url")
    suffix = F.explode(
        F.array(*[F.struct(F.lit(s).alias("s"), F.lit(r).cast("string").alias("r")) for s, r in SUFFIXES])
    )
    stem = normalize(F.regexp_replace(u, STEM_END, ""))
    variants = pages.select("page_id", stem.alias("stem"), suffix.alias("v")).select(
        "page_id", F.concat("stem", "v.s").alias("url"), F.col("v.r").alias("expected")
    )
    originals = pages.select("page_id", "url", F.lit(None).cast("string").alias("expected"))
    ftp = pages.where(u.startswith("https:")).select(
        "page_id", F.concat(F.lit("ftp:"), F.substring(u, 7, 1 << 30)).alias("url"), F.lit("scheme").alias("expected")
    )
    bad_host = pages.select(
        "page_id", F.regexp_replace(u, "://", "://[").alias("url"), F.lit("malformed").alias("expected")
    )
    noisy = pages.select("page_id", F.concat(F.lit(" \t"), u, F.lit("\n#a\r\nb")).alias("url"), F.lit("fragment").alias("expected"))
    return originals.unionByName(variants).unionByName(ftp).unionByName(bad_host).unionByName(noisy)


def url_variants_sql() -> str:
    structs = ", ".join(
        "{'s': " + O.q(s) + ", 'r': " + (O.q(r) if r else "NULL::VARCHAR") + "}" for s, r in SUFFIXES
    )
    return f"""
    SELECT page_id, url, NULL::VARCHAR AS expected FROM pages
    UNION ALL
    SELECT page_id, {O.normalize(f"regexp_replace(url, {O.q(STEM_END)}, '')")} || v.s AS url, v.r AS expected
    FROM (SELECT page_id, url, unnest([{structs}]) AS v FROM pages)
    UNION ALL
    SELECT page_id, 'ftp:' || substr(url, 7) AS url, 'scheme' AS expected FROM pages WHERE starts_with(url, 'https:')
    UNION ALL
    SELECT page_id, replace(url, '://', '://[') AS url, 'malformed' AS expected FROM pages
    UNION ALL
    SELECT page_id, ' ' || chr(9) || url || chr(10) || '#a' || chr(13) || chr(10) || 'b' AS url, 'fragment' AS expected FROM pages
    """


# What ordinary web HTML holds beyond the supplied pages.
HTML_TAIL = (
    '<p title="a>b">don&rsquo;t John&#39;s caf&eacute; a&ndash;b &#8217;t 1,000 at 10:30, x,y: z\u201cquoted\u201d foo\u00a0bar can&apos;t</p>'
    '<a class="b"href="/v1">1</a><a title="a>b" href="/v2">2</a><a title="see href=/bad" href="/v3">3</a>'
    "<a href='/v4' href='/v5'>4</a><a\thref = /v6?a=1&amp;b=&#50;>6</a><a name=x>none</a>"
)


# An anchor with very many attributes before its href:
WIDE_TAG = ("<p>wide</p><a", ' a="b>c"', 100_000, ' href="/wide">w</a>')
# What nothing closes, one for each remainder of the page id: it runs to the end of the page.
UNCLOSED = ("", '<p>last <a href="/open', "last <!-- <a href=/hidden>gone</a>", "last <script>gone <a href=/hidden>x</a>")
# ---------------------------------------------------------------------------


def html_variants(pages: DataFrame) -> DataFrame:
    """(page_id, url, html): every page with the hard tail and something unclosed after its HTML, the first with a very wide tag too."""
    start, attribute, n, end = WIDE_TAG
    first = pages.select(F.min("page_id")).scalar()
    # The number comes from the row, so that no plan holds the whole tag as a literal.
    wide = F.concat(F.lit(start), F.repeat(F.lit(attribute), F.when(F.col("page_id") == first, n).otherwise(0)), F.lit(end))
    unclosed = F.element_at(F.array(*map(F.lit, UNCLOSED)), (F.col("page_id") % len(UNCLOSED) + 1).cast("int"))
    tail = F.concat(F.lit(HTML_TAIL), F.when(F.col("page_id") == first, wide).otherwise(""), unclosed)
    return pages.select("page_id", "url", F.concat("html", tail).alias("html"))


def html_variants_sql() -> str:
    start, attribute, n, end = WIDE_TAG
    wide = f"CASE WHEN page_id = (SELECT min(page_id) FROM pages) THEN {O.q(start)} || repeat({O.q(attribute)}, {n}) || {O.q(end)} ELSE '' END"
    unclosed = f"[{', '.join(map(O.q, UNCLOSED))}][page_id % {len(UNCLOSED)} + 1]"
    return f"(SELECT page_id, url, html || {O.q(HTML_TAIL)} || {wide} || {unclosed} AS html FROM pages)"


# Sentences with abbreviations, after every document's text.
SENTENCES = " Dr. Ny and Mr. Low met the U.S. team in St. Paul, e.g. today. It ended today. They left. The U.S. side won, as Dr. Ny said."


def sentence_documents(docs: DataFrame) -> DataFrame:
    """(text): every document's text with the sentences."""
    return docs.select(F.concat("text", F.lit(SENTENCES)).alias("text"))


def sentence_documents_sql() -> str:
    return f"(SELECT text || {O.q(SENTENCES)} AS text FROM documents)"


def with_status(pages: DataFrame) -> DataFrame:
    """Pages with a status: of ten ids in a row one is a 404 and one a 606 without body."""
    i = F.col("page_id") % 10
    status = F.when(i == 3, 404).when(i == 7, 606).otherwise(200).cast("int")
    return pages.select(
        "page_id", "url", status.alias("status"),
        F.when(i == 7, F.lit("FILE TOO LARGE !")).alias("error"),
        F.when(i != 7, F.col("html")).alias("html"),
    )


def with_status_sql() -> str:
    """The rows that count for Q2-Q4."""
    return "(SELECT page_id, url, html FROM pages WHERE page_id % 10 NOT IN (3, 7))"


def scheme_twins(pages: DataFrame) -> DataFrame:
    """(page_id, url): each page URL, its http/https twin and a '/'-suffixed copy."""
    u = F.col("url")
    twin = (
        F.when(u.startswith("https:"), F.concat(F.lit("http:"), F.substring(u, 7, 1 << 30)))
        .when(u.startswith("http:"), F.concat(F.lit("https:"), F.substring(u, 6, 1 << 30)))
        .otherwise(u)
    )
    return pages.select(
        "page_id", F.explode(F.array(u, twin, F.concat(u, F.lit("/")))).alias("url")
    )


def scheme_twins_sql() -> str:
    twin = (
        "CASE WHEN starts_with(url, 'https:') THEN 'http:' || substr(url, 7) "
        "WHEN starts_with(url, 'http:') THEN 'https:' || substr(url, 6) ELSE url END"
    )
    return f"SELECT page_id, unnest([url, {twin}, url || '/']) AS url FROM pages"


def hrefs(pages: DataFrame) -> DataFrame:
    """(page_id, url, href): the fixed href list against every page URL."""
    return pages.select("page_id", "url", F.explode(F.array(*[F.lit(h) for h in HREFS])).alias("href"))


def hrefs_sql() -> str:
    return f"SELECT page_id, url, unnest([{', '.join(O.q(h) for h in HREFS)}]) AS href FROM pages"


def netloc_variants(pages: DataFrame) -> DataFrame:
    """(netloc): every distinct page host, with www/WWW, port and deeper-label forms."""
    from crawlstats.functions.urls import url_parts

    n = url_parts("url")["netloc"]
    bare = F.regexp_replace(n, "(?i)^www\\.", "")
    forms = F.array(
        n,
        bare,
        F.concat(F.lit("www."), bare),
        F.concat(F.lit("WWW."), bare),
        F.concat(bare, F.lit(":8080")),
        F.concat(F.lit("b."), bare),
        F.upper(bare),
    )
    return pages.select(F.explode(forms).alias("netloc")).distinct()


def netloc_variants_sql() -> str:
    n = O.netloc("url")
    bare = f"regexp_replace({n}, '^[wW][wW][wW]\\.', '')"
    return (
        f"SELECT DISTINCT unnest([{n}, {bare}, 'www.' || {bare}, 'WWW.' || {bare}, "
        f"{bare} || ':8080', 'b.' || {bare}, upper({bare})]) AS netloc FROM pages"
    )


# --- crawl state, edges, robots rules ------------------------------------------

def crawl_state(pages: DataFrame) -> DataFrame:
    """(url_hash, url, completed) over every page.

    The completion flag is the fixture's rule ``page_id % 3 = 0`` (a flag on
    every row, not a filter); URLs sharing a hash keep the smallest page_id.
    """
    from crawlstats.operators.frontier import keyed

    k = keyed(pages.select("page_id", "url")).withColumn("completed", F.col("page_id") % 3 == 0)
    best = F.min_by(F.struct("url", "completed"), "page_id")
    return k.groupBy("url_hash").agg(best.alias("b")).select("url_hash", "b.url", "b.completed")


def crawl_state_sql() -> str:
    return f"""
    SELECT url_hash, arg_min(url, page_id) AS url, arg_min(completed, page_id) AS completed FROM (
      SELECT page_id, {O.normalize('url')} AS url, {O.url_hash('url')} AS url_hash,
             page_id % 3 = 0 AS completed
      FROM pages
    ) GROUP BY url_hash
    """


def edges(pages: DataFrame) -> DataFrame:
    """(src, dst): two out-edges per page, ``(7i+1) mod N`` and ``(13i+5) mod N``.

    N is the page count, taken as a scalar subquery; the graph has cycles.
    """
    n = pages.select(F.count(F.lit(1))).scalar()
    i = F.col("page_id")
    return pages.select(
        i.alias("src"), F.explode(F.array((i * 7 + 1) % n, (i * 13 + 5) % n)).alias("dst")
    )


def edges_sql() -> str:
    n = "(SELECT count(*) FROM pages)"
    return f"""
    SELECT page_id AS src, unnest([(page_id * 7 + 1) % {n}, (page_id * 13 + 5) % {n}]) AS dst
    FROM pages
    """


def seed_pages(pages: DataFrame, buckets) -> DataFrame:
    """(node): the first page (smallest id) of each politeness bucket."""
    from crawlstats.functions.urls import domain_bucket

    return (
        pages.select("page_id", domain_bucket("url", buckets).alias("bucket"))
        .groupBy("bucket")
        .agg(F.min("page_id").alias("node"))
        .select("node")
    )


def seed_pages_sql(buckets) -> str:
    return f"SELECT min(page_id) AS node FROM pages GROUP BY {O.domain_bucket('url', buckets)}"


def root_urls(pages: DataFrame) -> DataFrame:
    """(page_id, url): every page URL, and the root of its site without a path, bare and with a query."""
    from crawlstats.functions.urls import url_parts

    p = url_parts("url")
    root = F.concat(p["scheme"], F.lit("://"), p["netloc"])
    return pages.select("page_id", F.explode(F.array("url", root, F.concat(root, F.lit("?page=1")))).alias("url"))


def root_urls_sql() -> str:
    root = f"{O.scheme('url')} || '://' || {O.netloc('url')}"
    return f"SELECT page_id, unnest([url, {root}, {root} || '?page=1']) AS url FROM pages"


def robots_rules(pages: DataFrame) -> DataFrame:
    """(host, path_prefix, allow) derived from the page hosts.

    Hosts starting ``m.`` deny everything; hosts starting ``blog.`` deny
    ``/fr`` but allow ``/fr/1``, and deny what a query starting ``?page`` asks
    of English pages; hosts starting ``www.`` have an empty rule; every other
    host has no rules.
    """
    from crawlstats.functions.urls import url_parts

    hosts = pages.select(url_parts("url")["netloc"].alias("host")).distinct()
    rule = lambda p, a: F.struct(F.lit(p).alias("path_prefix"), F.lit(a).alias("allow"))
    rules = (
        F.when(F.col("host").startswith("m."), F.array(rule("/", False)))
        .when(F.col("host").startswith("blog."), F.array(rule("/fr", False), rule("/fr/1", True), rule("/en/1?page", False)))
        .when(F.col("host").startswith("www."), F.array(rule("", False)))
    )
    return hosts.select("host", F.explode(rules).alias("r")).select("host", "r.path_prefix", "r.allow")


def robots_rules_sql() -> str:
    return f"""
    SELECT host, r.path_prefix AS path_prefix, r.allow AS allow FROM (
      SELECT host, unnest(CASE
        WHEN starts_with(host, 'm.') THEN [{{'path_prefix': '/', 'allow': false}}]
        WHEN starts_with(host, 'blog.') THEN [{{'path_prefix': '/fr', 'allow': false}}, {{'path_prefix': '/fr/1', 'allow': true}},
                                                 {{'path_prefix': '/en/1?page', 'allow': false}}]
        WHEN starts_with(host, 'www.') THEN [{{'path_prefix': '', 'allow': false}}]
      END) AS r
      FROM (SELECT DISTINCT {O.netloc('url')} AS host FROM pages)
    )
    """
