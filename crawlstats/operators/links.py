"""Out-links of captured pages (G1, G4, X1, F15) and the link audit.

Every ``<a href=...>`` of a status-200 page is resolved against the URL that
was requested, links holding ``do=`` (state-changing actions) are dropped,
and duplicates within a page are removed. All of that happens inside the
page's own row (array functions), so extracting links needs no shuffle: the
per-page distinct is an ``array_distinct``, not a ``dropDuplicates`` over
(src, link).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.config import written_once
from crawlstats.functions.scope import Rule, reject_reason
from crawlstats.functions.text import ANY_TAG, BLANK, INVISIBLE, TAG_REST, decode_entities
from crawlstats.functions.urls import resolve_href
from crawlstats.sources.pages import ok_responses

# Markup with the inside of anchor tags as group 1; an anchor that nothing closes is a tag without.
ANCHORS = rf"{INVISIBLE}|<a(?:{BLANK}|/)({TAG_REST})>|{ANY_TAG}"
# An attribute: its name, and a value that is quoted or bare.
ATTRIBUTE = rf"""[^ \t\n\f\r"'>/=]+(?:{BLANK}*={BLANK}*(?:"[^"]*"|'[^']*'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*))?"""
# The attribute that holds the link; group 1 is its value.
HREF = rf"(?is)^href{BLANK}*={BLANK}*(.*)$"
QUOTED = r"(?s)^.(.*).$"
ACTION_MARKER = "do="

Extractor = Callable[[DataFrame], DataFrame]


def _strip_quotes(v: Column) -> Column:
    quoted = v.startswith('"') | v.startswith("'")
    return F.when(quoted, F.regexp_extract(v, QUOTED, 1)).otherwise(v)


def raw_hrefs(html) -> Column:
    """Href values of anchor tags outside comments, scripts and styles (one scan of the page's markup)."""
    h = F.col(html) if isinstance(html, str) else html
    tags = F.filter(F.regexp_extract_all(h, F.lit(ANCHORS), 1), lambda t: t != "")
    attribute = lambda t: F.filter(F.regexp_extract_all(t, F.lit(ATTRIBUTE), 0), lambda a: a.rlike(HREF))
    first = F.transform(tags, lambda t: F.regexp_extract(F.try_element_at(attribute(t), F.lit(1)), HREF, 1))
    return F.filter(first, lambda v: v.isNotNull())


def resolved_links(src, hrefs) -> Column:
    """Resolve an array of href values, drop ``do=`` links, keep each once."""
    base = F.col(src) if isinstance(src, str) else src
    resolved = F.transform(hrefs, lambda h: resolve_href(base, h))
    kept = F.filter(resolved, lambda link: ~link.contains(ACTION_MARKER))
    return F.array_distinct(kept)


def link_array(src, html) -> Column:
    """G1 for one page: distinct resolved links, ``do=`` links removed."""
    values = F.transform(raw_hrefs(html), lambda v: decode_entities(_strip_quotes(v)))
    return resolved_links(src, values)


def page_links(resp: DataFrame) -> DataFrame:
    """G1 + X1: (page_id, src, link), one row per distinct link of a page.

    The first ``href`` of an anchor counts; a ``>`` or ``href=`` inside a
    quoted value is part of that value. The per-page distinct is an array
    operation on the page's row, so nothing is shuffled.
    """
    ok = ok_responses(resp).select("page_id", "url", "html")
    return ok.select("page_id", F.col("url").alias("src"), F.explode(link_array("url", "html")).alias("link"))


def link_audit(
    links: DataFrame,
    domains: Sequence[str],
    *,
    max_len: int = 250,
    extra_rules: Sequence[Rule] = (),
    host_only: bool = False,
) -> DataFrame:
    """F16 + S6: every link with ``is_valid`` and the first rule it failed; ``host_only`` as in ``reject_reason``."""
    reason = reject_reason(F.col("link"), domains, max_len=max_len, extra_rules=extra_rules, host_only=host_only)
    return links.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def valid_links(links: DataFrame, domains: Sequence[str], **kw) -> DataFrame:
    """The links the crawler would queue (valid ones only)."""
    return link_audit(links, domains, **kw).where("is_valid").select(*links.columns)


def scrape(
    resp: DataFrame,
    domains: Sequence[str],
    *,
    extractor: Extractor | None = None,
    extra_rules: Sequence[Rule] = (),
    max_len: int = 250,
    host_only: bool = False,
) -> DataFrame:
    """G4 + E1: audit of the links a pluggable extractor finds on pages.

    ``extractor`` maps responses to (page_id, src, link); default G1.
    """
    links = (extractor or page_links)(resp)
    return link_audit(links, domains, max_len=max_len, extra_rules=extra_rules, host_only=host_only)


def write_link_audit(audit: DataFrame, path: str) -> None:
    """S6 sink: valid and rejected links land in separate partitions."""
    audit.write.mode("append").partitionBy("is_valid").parquet(path)


def write_link_audit_text(audit: DataFrame, valid_path: str, rejected_path: str) -> None:
    """S6 in the crawler's text layout: one valid link per line; each
    rejected link preceded by a ``From: <source page>`` line."""
    audit = written_once(audit, "link-audit")  # pages are parsed once for both files
    audit.where("is_valid").select(F.col("link").alias("value")).write.mode("append").text(valid_path)
    audit.where(~F.col("is_valid")).select(
        F.concat(F.lit("From: "), F.col("src"), F.lit("\n"), F.col("link")).alias("value")
    ).write.mode("append").text(rejected_path)
