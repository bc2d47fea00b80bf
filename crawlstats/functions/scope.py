"""Scope and crawler-trap rules (F2-F17, E2) with the name of the first rule hit.

``reject_reason`` evaluates the rules in a fixed order and returns the name
of the first one that rejects the URL, or null when it is valid; it is one
``coalesce`` of ``when`` expressions, so Catalyst keeps it a single
projection and short-circuits like the original rule chain. ``is_valid`` is
``reject_reason(...).isNull()``.

Extra rules (E2) are ``(name, predicate)`` pairs appended after the built-in
ones; a predicate receives the URL column and its parts struct.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlstats.functions.urls import let, url_parts

# ---------------------------------------------------------------------------
# These must equal the original rule set for identical results.
# File extensions rejected at the end of the lower-cased path or query:
FILE_EXTENSIONS = (
    "css js bmp gif jpg jpeg ico png tif tiff mid mp2 mp3 mp4 "
    "wav avi mov mpeg ram m4v mkv ogg ogv pdf "
    "ps eps tex ppt pptx doc docx xls xlsx names "
    "data dat exe bz2 tar msi bin 7z psd dmg iso "
    "epub dll cnf tgz sha1 "
    "thmx mso arff rtf jar csv "
    "rm smil wmv swf wma zip rar gz"
).split()
# CMS directory names; three in a row mark a trap:
CMS_DIRECTORIES = ("misc", "sites", "all", "themes", "modules", "profiles", "css", "field", "node", "theme")
# Path marker of event-category listings:
EVENT_MARKERS = ("/events/category/",)
# Query-string marker of search filters:
FILTER_MARKER = "&filter%"
# Substring of calendar pages (case-sensitive) and of ical downloads (query):
CALENDAR_MARKER = "calendar"
ICAL_MARKER = "ical"
# A date written yyyy-mm-dd anywhere in the URL:
DATE_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
# Longest URL kept:
MAX_URL_LENGTH = 250
# ---------------------------------------------------------------------------

EXTENSION_PATTERN = r"\.(" + "|".join(FILE_EXTENSIONS) + r")$"
CMS_PATTERN = "(" + "|".join("/" + d for d in CMS_DIRECTORIES) + "){3}"
# Runs of slashes that repeat a directory made only of slashes.
SLASH_LOOP_PATTERN = r"/////|///.*///"

RULE_NAMES = (
    "malformed",
    "scheme",
    "path_extension",
    "query_extension",
    "domain",
    "date",
    "event_category",
    "fragment",
    "length",
    "filter",
    "repeating_directory",
    "cms_directories",
    "calendar",
    "ical",
)
BASIC_RULE_NAMES = ("malformed", "scheme", "path_extension", "domain", "fragment")

Rule = tuple[str, Callable[[Column, Column], Column]]


def domain_pattern(domains: Sequence[str], guarded: bool = True) -> str:
    """Allow-list regex: ``[./]<domain>/`` anywhere (``<domain>/`` unguarded).

    Dots are literal; an entry may carry a path prefix.
    """
    alts = "|".join(re.escape(d.rstrip("/")) for d in domains)
    return ("[./]" if guarded else "") + "(?:" + alts + ")/"


def repeating_directory(url: Column) -> Column:
    """some directory repeats (``/a/x/a/``, ``/a/a/``) or slashes loop.

    The rule is usually written with back-references; this needs none. A
    repeated stretch that holds any character but a slash holds a whole
    segment between two slashes, which then occurs twice; stretches of
    slashes alone are the slash-run pattern.
    """
    segs = F.split(url, "/", -1)
    closed = F.slice(segs, 2, F.greatest(F.size(segs) - 2, F.lit(0)))
    closed = F.filter(closed, lambda s: s != "")
    return (F.size(closed) != F.size(F.array_distinct(closed))) | url.rlike(SLASH_LOOP_PATTERN)


def host_in_scope(netloc: Column, domains: Sequence[str]) -> Column:
    """Whether the host is one of the allowed hosts or below one; path prefixes are not looked at."""
    hosts = "|".join(sorted({re.escape(d.split("/")[0].lower()) for d in domains}))
    return F.lower(netloc).rlike(rf"^(?:[^@]*@)?(?:[^@:]*\.)?(?:{hosts})(?::[0-9]*)?$")


def _builtin_rules(domains: Sequence[str], max_len: int, profile: str, host_only: bool = False) -> list[Rule]:
    dom = domain_pattern(domains, guarded=(profile == "full"))
    malformed = lambda u, p: u.isNull() | (p["netloc"].contains("[") != p["netloc"].contains("]"))
    scheme = lambda u, p: ~p["scheme"].isin("http", "https")
    path_ext = lambda u, p: F.lower(p["path"]).rlike(EXTENSION_PATTERN)
    domain = (lambda u, p: ~host_in_scope(p["netloc"], domains)) if host_only else (lambda u, p: ~u.rlike(dom))
    fragment = lambda u, p: p["fragment"] != ""
    if profile == "basic":
        return [
            ("malformed", malformed),
            ("scheme", scheme),
            ("path_extension", path_ext),
            ("domain", domain),
            ("fragment", fragment),
        ]
    events = lambda u, p: F.lit(False) if not EVENT_MARKERS else _any_contains(u, EVENT_MARKERS)
    return [
        ("malformed", malformed),
        ("scheme", scheme),
        ("path_extension", path_ext),
        ("query_extension", lambda u, p: F.lower(p["query"]).rlike(EXTENSION_PATTERN)),
        ("domain", domain),
        ("date", lambda u, p: u.rlike(DATE_PATTERN)),
        ("event_category", events),
        ("fragment", fragment),
        ("length", lambda u, p: F.length(u) > max_len),
        ("filter", lambda u, p: u.contains(FILTER_MARKER)),
        ("repeating_directory", lambda u, p: repeating_directory(u)),
        ("cms_directories", lambda u, p: u.rlike(CMS_PATTERN)),
        ("calendar", lambda u, p: u.contains(CALENDAR_MARKER)),
        ("ical", lambda u, p: p["query"].contains(ICAL_MARKER)),
    ]


def _any_contains(u: Column, needles: Sequence[str]) -> Column:
    out = u.contains(needles[0])
    for n in needles[1:]:
        out = out | u.contains(n)
    return out


def reject_reason(
    url,
    domains: Sequence[str],
    *,
    max_len: int = MAX_URL_LENGTH,
    profile: str = "full",
    extra_rules: Sequence[Rule] = (),
    host_only: bool = False,
) -> Column:
    """Name of the first rule that rejects ``url``; null if valid.

    ``profile='full'`` is the crawler's rule chain, ``'basic'`` the looser
    scope check (scheme, path extension, unguarded domain, fragment). With
    ``host_only`` the domain rule looks at the host alone. The URL is split
    once for all rules.
    """
    u = F.col(url) if isinstance(url, str) else url
    rules = _builtin_rules(domains, max_len, profile, host_only) + list(extra_rules)
    return let(url_parts(u), lambda p: F.coalesce(*[F.when(pred(u, p), F.lit(name)) for name, pred in rules]))


def is_valid(url, domains: Sequence[str], **kw) -> Column:
    return reject_reason(url, domains, **kw).isNull()
