"""URL column functions (U1-U9): split, normalise, hash, subdomain, bucket.

All are plain Catalyst expressions, so they run inside whole-stage codegen
and never leave the JVM. ``parse_url``/``try_parse_url`` are not used: their
strict URI parser throws (ANSI) or returns nulls on the odd URLs crawls see,
while the generic RFC 3986 split below never fails and yields ``''`` for
absent parts, which the hash needs.
"""

from __future__ import annotations

from urllib.parse import uses_params, uses_relative

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3986 appendix B split: scheme, authority, path, query, fragment.
URL_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Not part of a URL: controls and spaces at its start, tabs and line ends anywhere.
URL_NOISE = r"^[\x00-\x20]+|[\t\r\n]"
# Params live on the last path segment, after its first ';'.
PATH_PARAMS = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$"

# Schemes whose last path segment may carry ';params' (Python stdlib list).
PARAM_SCHEMES = tuple(uses_params)
RELATIVE_SCHEMES = tuple(uses_relative)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_parts(url) -> Column:
    """struct<scheme, netloc, path, params, query, fragment>.

    Scheme is lower-cased, everything else keeps its case; absent parts are
    ``''`` (null only for a null URL). Leading controls and spaces, tabs and
    line ends are left out, as ``urlparse`` does.
    """
    u = F.regexp_replace(_col(url), URL_NOISE, "")
    scheme = F.lower(F.regexp_extract(u, URL_SPLIT, 1))
    full_path = F.regexp_extract(u, URL_SPLIT, 3)
    has_params = scheme.isin(*PARAM_SCHEMES)
    path = F.when(has_params, F.regexp_extract(full_path, PATH_PARAMS, 1)).otherwise(full_path)
    params = F.when(has_params, F.regexp_extract(full_path, PATH_PARAMS, 2)).otherwise(F.lit(""))
    return F.struct(
        scheme.alias("scheme"),
        F.regexp_extract(u, URL_SPLIT, 2).alias("netloc"),
        path.alias("path"),
        params.alias("params"),
        F.regexp_extract(u, URL_SPLIT, 4).alias("query"),
        F.regexp_extract(u, URL_SPLIT, 5).alias("fragment"),
    )


def normalize(url) -> Column:
    """Strip every trailing '/'."""
    return F.regexp_replace(_col(url), "/+$", "")


def hash_key(parts: Column) -> Column:
    """The string U3 hashes: every part but the scheme, '/'-joined."""
    return F.concat_ws(
        "/", parts["netloc"], parts["path"], parts["params"], parts["query"], parts["fragment"]
    )


def url_hash(url, *, normalized: bool = False) -> Column:
    """sha256 hex of netloc/path/params/query/fragment of the normalised URL.

    The scheme is left out, so http and https twins share one hash.
    """
    u = _col(url) if normalized else normalize(url)
    return F.sha2(hash_key(url_parts(u)), 256)


def page_key(url) -> Column:
    """U4: the URL without its fragment, as a struct (the page identity)."""
    p = url_parts(url)
    return F.struct(
        p["scheme"].alias("scheme"),
        p["netloc"].alias("netloc"),
        p["path"].alias("path"),
        p["params"].alias("params"),
        p["query"].alias("query"),
    )


def subdomain(netloc, anchor: str) -> Column:
    """The label just before the first label equal to ``anchor``.

    A leading ``www`` label (any case) is dropped first. Null when the anchor
    is absent or is the first label (the bare registrable domain).
    """
    labels = F.split(_col(netloc), r"\.")
    labels = F.when(F.lower(F.element_at(labels, 1)) == "www", F.slice(labels, 2, F.size(labels) - 1)).otherwise(
        labels
    )
    pos = F.array_position(labels, F.lit(anchor))
    return F.when(pos > 1, F.element_at(labels, (pos - 1).cast("int")))


def nice_link(netloc) -> Column:
    """``http://`` + netloc (the netloc keeps its ``www.``)."""
    return F.concat(F.lit("http://"), _col(netloc))


def domain_bucket(url, buckets) -> Column:
    """U8: index of the first bucket substring the URL contains, else null."""
    u = _col(url)
    out = F.lit(None).cast("int")
    for i in reversed(range(len(buckets))):
        out = F.when(u.contains(buckets[i]), F.lit(i)).otherwise(out)
    return out


def remove_dot_segments(path: Column) -> Column:
    """Dot-segment removal for an absolute path, as ``urljoin`` does it.

    '..' drops the previous segment (never failing at the root), '.' is
    skipped, empty segments (``//``) are kept; a trailing '.'/'..' leaves a
    trailing '/'.
    """
    segs = F.split(path, "/", -1)
    kept = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..",
            F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc),
        )
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segs, -1)
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(kept, "/")
    joined = F.when(joined == "", F.lit("/")).otherwise(joined)
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a one-element transform).

    Stages that read their input several times (URL parts, resolution steps)
    would otherwise copy the whole input expression into every reference.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _unsplit_tail(p: Column) -> Column:
    return F.concat(
        F.when(p["params"] != "", F.concat(F.lit(";"), p["params"])).otherwise(""),
        F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""),
        F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(""),
    )


def join_rooted(base, ref) -> Column:
    """``urljoin(base, ref)`` for a ref starting with '/'.

    A network-path ref (``//host/p``) takes only the base scheme; a
    root-relative ref takes scheme and host and has its dot segments removed.
    """
    base_c, ref_c = _col(base), _col(ref)

    def with_parts(b: Column, r: Column) -> Column:
        scheme_prefix = F.when(b["scheme"] != "", F.concat(b["scheme"], F.lit(":"))).otherwise("")
        network = F.concat(scheme_prefix, F.lit("//"), r["netloc"], r["path"], _unsplit_tail(r))
        rooted = F.concat(scheme_prefix, F.lit("//"), b["netloc"], remove_dot_segments(r["path"]), _unsplit_tail(r))
        # '//' with no host and no path keeps the base path (and its query
        # unless the ref has one), as urljoin does.
        query = F.when(r["query"] != "", r["query"]).otherwise(b["query"])
        base_path = F.concat(
            scheme_prefix,
            F.lit("//"),
            b["netloc"],
            b["path"],
            F.when(b["params"] != "", F.concat(F.lit(";"), b["params"])).otherwise(""),
            F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
            F.when(r["fragment"] != "", F.concat(F.lit("#"), r["fragment"])).otherwise(""),
        )
        joined = (
            F.when(r["netloc"] != "", network)
            .when((r["path"] == "") & (r["params"] == ""), base_path)
            .otherwise(rooted)
        )
        usable = (F.coalesce(base_c, F.lit("")) != "") & b["scheme"].isin(*RELATIVE_SCHEMES)
        return F.when(usable, joined).otherwise(ref_c)

    return let(url_parts(base_c), lambda b: let(url_parts(ref_c), lambda r: with_parts(b, r)))


def resolve_href(base, href) -> Column:
    """The link as the crawler records it, relative to the requested URL.

    In order: drop one leading ``//``; a ref that then starts with '/' is
    joined to the base; a ref starting with ``www.`` gets ``https://``.
    Anything else (``page.html``, ``#x``, ``?q``, ``mailto:``) stays as it is
    and later fails the scheme rule.
    """
    h = _col(href)
    h1 = F.when(h.startswith("//"), F.substring(h, 3, 1 << 30)).otherwise(h)

    def step2(v1: Column) -> Column:
        h2 = F.when(v1.startswith("/"), join_rooted(base, v1)).otherwise(v1)
        return let(h2, lambda v2: F.when(v2.startswith("www."), F.concat(F.lit("https://"), v2)).otherwise(v2))

    return let(h1, step2)
