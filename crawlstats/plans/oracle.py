"""DuckDB SQL expression builders mirroring ``crawlstats.functions``.

The registered queries are checked against independent SQL over the same
Parquet tables. These helpers spell each column function in DuckDB SQL so the
oracle strings stay readable; they share only the fixed values (patterns,
lists) with the Spark side, never the Spark code.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from crawlstats.functions import scope, text, urls
from crawlstats.functions.stop_words import ENGLISH_STOP_WORDS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# --- U1-U8 -----------------------------------------------------------------

def _part(u: str, group: int) -> str:
    return f"regexp_extract(regexp_replace({u}, {q(urls.URL_NOISE)}, '', 'g'), {q(urls.URL_SPLIT)}, {group})"


def scheme(u: str) -> str:
    return f"lower({_part(u, 1)})"


def netloc(u: str) -> str:
    return _part(u, 2)


def _full_path(u: str) -> str:
    return _part(u, 3)


def path(u: str) -> str:
    fp = _full_path(u)
    return (
        f"(CASE WHEN {scheme(u)} IN {in_list(urls.PARAM_SCHEMES)} "
        f"THEN regexp_extract({fp}, {q(urls.PATH_PARAMS)}, 1) ELSE {fp} END)"
    )


def params(u: str) -> str:
    fp = _full_path(u)
    return (
        f"(CASE WHEN {scheme(u)} IN {in_list(urls.PARAM_SCHEMES)} "
        f"THEN regexp_extract({fp}, {q(urls.PATH_PARAMS)}, 2) ELSE '' END)"
    )


def query(u: str) -> str:
    return _part(u, 4)


def fragment(u: str) -> str:
    return _part(u, 5)


def parts_select(u: str, prefix: str = "") -> str:
    return ", ".join(
        f"{fn(u)} AS {prefix}{name}"
        for name, fn in (
            ("scheme", scheme),
            ("netloc", netloc),
            ("path", path),
            ("params", params),
            ("query", query),
            ("fragment", fragment),
        )
    )


def normalize(u: str) -> str:
    return f"regexp_replace({u}, '/+$', '')"


def hash_key(u: str) -> str:
    return f"concat_ws('/', {netloc(u)}, {path(u)}, {params(u)}, {query(u)}, {fragment(u)})"


def url_hash(u: str, normalized: bool = False) -> str:
    n = u if normalized else normalize(u)
    return f"sha256({hash_key(n)})"


def page_key(u: str) -> str:
    return f"({scheme(u)}, {netloc(u)}, {path(u)}, {params(u)}, {query(u)})"


def subdomain(nl: str, anchor: str) -> str:
    labels = f"string_split({nl}, '.')"
    lab = f"(CASE WHEN lower({labels}[1]) = 'www' THEN {labels}[2:] ELSE {labels} END)"
    pos = f"list_position({lab}, {q(anchor)})"
    return f"(CASE WHEN {pos} > 1 THEN {lab}[{pos} - 1] END)"


def domain_bucket(u: str, buckets: Sequence[str]) -> str:
    whens = " ".join(f"WHEN contains({u}, {q(b)}) THEN {i}" for i, b in enumerate(buckets))
    return f"(CASE {whens} END)"


def remove_dot_segments(p: str) -> str:
    segs = f"string_split({p}, '/')"
    kept = (
        f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '..' THEN list_slice(acc, 1, len(acc) - 1) "
        f"WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])"
    )
    kept = f"(CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({kept}, '') ELSE {kept} END)"
    joined = f"array_to_string({kept}, '/')"
    joined = f"(CASE WHEN {joined} = '' THEN '/' ELSE {joined} END)"
    return f"(CASE WHEN starts_with({joined}, '/') THEN {joined} ELSE '/' || {joined} END)"


def _tail(u: str) -> str:
    return (
        f"(CASE WHEN {params(u)} <> '' THEN ';' || {params(u)} ELSE '' END"
        f" || CASE WHEN {query(u)} <> '' THEN '?' || {query(u)} ELSE '' END"
        f" || CASE WHEN {fragment(u)} <> '' THEN '#' || {fragment(u)} ELSE '' END)"
    )


def join_rooted(base: str, ref: str) -> str:
    prefix = f"(CASE WHEN {scheme(base)} <> '' THEN {scheme(base)} || ':' ELSE '' END)"
    network = f"{prefix} || '//' || {netloc(ref)} || {path(ref)} || {_tail(ref)}"
    rooted = f"{prefix} || '//' || {netloc(base)} || {remove_dot_segments(path(ref))} || {_tail(ref)}"
    query_ = f"(CASE WHEN {query(ref)} <> '' THEN {query(ref)} ELSE {query(base)} END)"
    base_path = (
        f"{prefix} || '//' || {netloc(base)} || {path(base)}"
        f" || (CASE WHEN {params(base)} <> '' THEN ';' || {params(base)} ELSE '' END)"
        f" || (CASE WHEN {query_} <> '' THEN '?' || {query_} ELSE '' END)"
        f" || (CASE WHEN {fragment(ref)} <> '' THEN '#' || {fragment(ref)} ELSE '' END)"
    )
    joined = (
        f"(CASE WHEN {netloc(ref)} <> '' THEN {network} "
        f"WHEN {path(ref)} = '' AND {params(ref)} = '' THEN {base_path} ELSE {rooted} END)"
    )
    usable = f"(coalesce({base}, '') <> '' AND {scheme(base)} IN {in_list(urls.RELATIVE_SCHEMES)})"
    return f"(CASE WHEN {usable} THEN {joined} ELSE {ref} END)"


def resolve_href(base: str, href: str) -> str:
    h1 = f"(CASE WHEN starts_with({href}, '//') THEN substr({href}, 3) ELSE {href} END)"
    h2 = f"(CASE WHEN starts_with({h1}, '/') THEN {join_rooted(base, h1)} ELSE {h1} END)"
    return f"(CASE WHEN starts_with({h2}, 'www.') THEN 'https://' || {h2} ELSE {h2} END)"


# --- F2-F17 ------------------------------------------------------------------

def repeating_directory(u: str) -> str:
    segs = f"string_split({u}, '/')"
    closed = f"list_filter({segs}[2:-2], lambda s: s <> '')"
    return (
        f"(len({closed}) <> len(list_distinct({closed})) "
        f"OR regexp_matches({u}, {q(scope.SLASH_LOOP_PATTERN)}))"
    )


def out_of_scope(u: str, domains: Sequence[str], guarded: bool, host_only: bool) -> str:
    if not host_only:
        return f"NOT regexp_matches({u}, {q(scope.domain_pattern(domains, guarded=guarded))})"
    host = f"'.' || regexp_replace(regexp_replace(lower({netloc(u)}), '^[^@]*@', ''), ':[0-9]*$', '')"
    return "NOT (" + " OR ".join(f"ends_with({host}, {q('.' + d.split('/')[0].lower())})" for d in domains) + ")"


def rule_sql(u: str, domains: Sequence[str], profile: str = "full", max_len: int = scope.MAX_URL_LENGTH, host_only: bool = False):
    nl = netloc(u)
    domain = out_of_scope(u, domains, profile == "full", host_only)
    rules = [
        ("malformed", f"({u} IS NULL OR contains({nl}, '[') <> contains({nl}, ']'))"),
        ("scheme", f"{scheme(u)} NOT IN ('http', 'https')"),
        ("path_extension", f"regexp_matches(lower({path(u)}), {q(scope.EXTENSION_PATTERN)})"),
    ]
    if profile == "basic":
        return rules + [
            ("domain", domain),
            ("fragment", f"{fragment(u)} <> ''"),
        ]
    events = " OR ".join(f"contains({u}, {q(m)})" for m in scope.EVENT_MARKERS) or "false"
    return rules + [
        ("query_extension", f"regexp_matches(lower({query(u)}), {q(scope.EXTENSION_PATTERN)})"),
        ("domain", domain),
        ("date", f"regexp_matches({u}, {q(scope.DATE_PATTERN)})"),
        ("event_category", f"({events})"),
        ("fragment", f"{fragment(u)} <> ''"),
        ("length", f"length({u}) > {max_len}"),
        ("filter", f"contains({u}, {q(scope.FILTER_MARKER)})"),
        ("repeating_directory", repeating_directory(u)),
        ("cms_directories", f"regexp_matches({u}, {q(scope.CMS_PATTERN)})"),
        ("calendar", f"contains({u}, {q(scope.CALENDAR_MARKER)})"),
        ("ical", f"contains({query(u)}, {q(scope.ICAL_MARKER)})"),
    ]


def reject_reason(u: str, domains: Sequence[str], profile: str = "full", host_only: bool = False) -> str:
    whens = " ".join(f"WHEN {cond} THEN {q(name)}" for name, cond in rule_sql(u, domains, profile, host_only=host_only))
    return f"(CASE {whens} END)"


# --- G1, G2, G3, A2 --------------------------------------------------------------

# Markup in the SQL engine's terms: these patterns are its own.
_INSIDE = r"""(?:=[ \t\n\f\r]*"[^"]*"|=[ \t\n\f\r]*'[^']*'|[^>])*"""
_ELEMENT = r"<{0}(?:[ \t\n\f\r/]" + _INSIDE + r")?(?:\z|>.*?(?:</{0}(?:[ \t\n\f\r/][^>]*)?>|\z))"
_SCANNED = "(?is)" + "|".join(
    [r"<!--(?:>|->)", r"<!--.*?(?:-->|--!>|\z)", _ELEMENT.format("script"), _ELEMENT.format("style"), "<[a-z/!?]" + _INSIDE + r"(?:>|\z)"]
)
_NAME_VALUE = r"""([^ \t\n\f\r"'>/=]+)(?:[ \t\n\f\r]*=[ \t\n\f\r]*("[^"]*"|'[^']*'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*))?"""


def anchor_hrefs(html: str) -> str:
    """List of the href values of a page's closed anchor tags, quotes and entities as written."""
    anchor = q(r"(?i)^<a[ \t\n\f\r/]")
    tags = f"list_filter(regexp_extract_all({html}, {q(_SCANNED)}), lambda t: regexp_matches(t, {anchor}) AND t[-1] = '>')"
    inside = "substr(t, 3, length(t) - 3)"
    pairs = f"list_zip(regexp_extract_all({inside}, {q(_NAME_VALUE)}, 1), regexp_extract_all({inside}, {q(_NAME_VALUE)}, 2))"
    first = f"list_filter({pairs}, lambda p: lower(p[1]) = 'href' AND p[2] <> '')[1][2]"
    return f"list_filter(list_transform({tags}, lambda t: {first}), lambda v: v IS NOT NULL)"


def _entity_text(e: str) -> str:
    keys, values = zip(*text.ENTITY_NAMES.items())
    names = f"map([{', '.join(map(q, keys))}], [{', '.join(map(q, values))}])"
    c1 = f"map([{', '.join(map(str, text.C1))}], [{', '.join(map(q, text.C1.values()))}])"
    n = (
        f"(CASE WHEN lower({e}[3]) = 'x' THEN CAST('0x' || regexp_extract({e}, '[xX]([0-9A-Fa-f]+);', 1) AS INTEGER)"
        f" ELSE CAST(regexp_extract({e}, '([0-9]+);', 1) AS INTEGER) END)"
    )
    bad = q(text.REPLACEMENT)
    number = (
        f"(CASE WHEN {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN {bad}"
        f" WHEN {n} BETWEEN 128 AND 159 THEN coalesce({c1}[{n}], {bad}) ELSE chr({n}) END)"
    )
    return f"(CASE WHEN {e}[2] <> '#' THEN coalesce({names}[{e}], {e}) ELSE {number} END)"


def decode_entities(t: str) -> str:
    between, found = f"regexp_split_to_array({t}, {q(text.ENTITY)})", f"regexp_extract_all({t}, {q(text.ENTITY)})"
    piece = f"lambda p: p[1] || coalesce(CASE WHEN p[2] IS NULL THEN '' ELSE {_entity_text('p[2]')} END, '')"
    joined = f"array_to_string(list_transform(list_zip({between}, {found}), {piece}), '')"
    return f"(CASE WHEN contains({t}, '&') THEN {joined} ELSE {t} END)"


def visible_text(html: str) -> str:
    return decode_entities(f"regexp_replace({html}, {q(_SCANNED)}, ' ', 'g')")


def spaced(t: str) -> str:
    commas = f"regexp_replace({t}, {q('[,:]+([^0-9,:]|$)')}, ' \\1', 'g')"
    return f"regexp_replace({commas}, {q(text.NEGATION)}, ' \\1\\2', 'g')"


_SEPARATORS = r"""[\s\v\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"\x{AB}\x{BB}\x{2018}-\x{201F}\x{2039}\x{203A};@#$%&?!()\[\]{}<>*]+"""


def raw_pieces(t: str) -> str:
    return f"regexp_split_to_array({spaced(t)}, {q(_SEPARATORS)})"


def clean_token(raw: str) -> str:
    return f"lower(regexp_replace({raw}, {q(text.TRAILING)}, ''))"


def is_word(raw: str) -> str:
    return f"regexp_matches({raw}, {q(text.TOKEN_START)})"


def token_count(t: str) -> str:
    return f"coalesce(len(list_filter({raw_pieces(t)}, lambda x: {is_word('x')})), 0)"


# --- stop words --------------------------------------------------------------

def stop_words_values() -> str:
    return "(VALUES " + ", ".join(f"({q(w)})" for w in ENGLISH_STOP_WORDS) + ") AS stop(token)"


def squash(sql: str) -> str:
    return re.sub(r"\s+\n", "\n", sql).strip()
