"""Text sinks in the crawler's line formats (S6 is in ``operators.links``).

S7 appends one line per processed URL (fragment removed); S8 overwrites the
report files:

    Q2  ``Longest Page: <url>, length: <n>``
    Q3  ``<word>: <n>``               (count descending, then word)
    Q4  ``<nice_link>, <n> + ``        (subdomain ascending)

A report is written in order: the part files, taken by name, are its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# The crawler's line formats.
LONGEST_PAGE_LINE = "Longest Page: %s, length: %d"
TOP_WORD_LINE = "%s: %d"
SUBDOMAIN_LINE = "%s, %d + "
# ---------------------------------------------------------------------------


def without_fragment(url) -> "F.Column":
    u = F.col(url) if isinstance(url, str) else url
    return F.regexp_replace(u, "#.*$", "")


def write_visited(resp: DataFrame, path: str) -> None:
    """Append the processed URLs (any status), fragment removed."""
    resp.select(without_fragment("url").alias("value")).write.mode("append").text(path)


def longest_page_lines(q2: DataFrame) -> DataFrame:
    return q2.select(F.format_string(LONGEST_PAGE_LINE, "url", "n_tokens").alias("value"))


def top_words_lines(q3: DataFrame) -> DataFrame:
    return q3.orderBy(F.col("n").desc(), "token").select(F.format_string(TOP_WORD_LINE, "token", "n").alias("value"))


def subdomain_lines(q4: DataFrame) -> DataFrame:
    return q4.orderBy("subdomain").select(F.format_string(SUBDOMAIN_LINE, "nice_link", "n_pages").alias("value"))


def write_report_lines(lines: DataFrame, path: str) -> None:
    """Overwrite a report as ordered text files (one, for a small report)."""
    lines.write.mode("overwrite").text(path)
