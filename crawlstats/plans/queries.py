"""Registered queries: one per operator group of the inventory.

Every query reads the supplied tables (``pages``, ``documents``) over their
whole extent, or data Spark derives from them, so its work grows with them.
``oracle_sql()`` gives the DuckDB equivalent of each, over the same Parquet
views; column names and types match the Spark result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import TEST_PARAMS
from crawlstats.operators import reports, sentences
from crawlstats.plans import fixtures as X
from crawlstats.plans import oracle as O
from crawlstats.sources.pages import read_table, responses

P = TEST_PARAMS

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = O.squash(sql)
        return fn

    return deco


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from crawlstats.plans import q_frontier, q_links, q_sources, q_streams, q_urls  # noqa: F401


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


def resp(spark: SparkSession, sf_dir: str, size_limit: int | None = None) -> DataFrame:
    return responses(pages(spark, sf_dir), size_limit)


# --- Q1-Q4 --------------------------------------------------------------------

@register(
    "q1_unique_pages",
    f"SELECT count(DISTINCT {O.page_key(O.normalize('url'))}) AS unique_pages FROM pages",
)
def q1_unique_pages(spark, sf_dir):
    return reports.unique_pages(resp(spark, sf_dir))


def longest_page_sql(table: str = "pages") -> str:
    return f"""
    SELECT {O.normalize('url')} AS url, n_tokens FROM (
      SELECT page_id, url, {O.token_count(O.visible_text('html'))} AS n_tokens FROM {table}
      WHERE html IS NOT NULL
    ) ORDER BY n_tokens DESC, page_id LIMIT 1
    """


@register("q2_longest_page", longest_page_sql())
def q2_longest_page(spark, sf_dir):
    return reports.longest_page(resp(spark, sf_dir))


@register(
    "page_tokens_count",
    f"SELECT page_id, url, {O.token_count(O.visible_text('html'))} AS n_tokens FROM pages",
)
def page_tokens_count(spark, sf_dir):
    return reports.page_token_counts(resp(spark, sf_dir))


def _top_words_sql(table: str, text_sql: str) -> str:
    return f"""
    WITH raw AS (SELECT unnest({O.raw_pieces(text_sql)}) AS raw FROM {table}),
    counts AS (
      SELECT {O.clean_token('raw')} AS token, count(*) AS n FROM raw
      WHERE {O.is_word('raw')} GROUP BY 1
    )
    SELECT token, n FROM counts
    WHERE token NOT IN (SELECT token FROM {O.stop_words_values()})
    ORDER BY n DESC, token LIMIT 50
    """


def page_words_sql(table: str = "pages") -> str:
    """Q3 over the first capture of each URL hash."""
    first = f"SELECT min(page_id) FROM {table} GROUP BY {O.url_hash('url')}"
    return _top_words_sql(f"(SELECT html FROM {table} WHERE page_id IN ({first}))", O.visible_text("html"))


@register("q3_top_words", page_words_sql())
def q3_top_words(spark, sf_dir):
    return reports.top_page_words(spark, resp(spark, sf_dir))


@register("q3_top_words_documents", _top_words_sql("documents", "text"))
def q3_top_words_documents(spark, sf_dir):
    return reports.top_text_words(spark, read_table(spark, sf_dir, "documents"))


def _periods_sql(table: str) -> str:
    """CTEs raw, score: words with a final period, their counts and scores."""
    return f"""
    raw AS (SELECT raw, count(*) AS n FROM (SELECT unnest({O.raw_pieces('text')}) AS raw FROM {table}) WHERE {O.is_word('raw')} GROUP BY raw),
    each AS (
      SELECT lower(CASE WHEN ends THEN raw[:-2] ELSE raw END) AS word, CASE WHEN ends THEN n ELSE 0 END AS y, CASE WHEN ends THEN 0 ELSE n END AS x
      FROM (SELECT *, raw[-1] = '.' AND raw[-2] <> '.' AS ends FROM raw)
    ),
    words AS (SELECT word, CAST(sum(y) AS BIGINT) AS n_with, CAST(sum(x) AS BIGINT) AS n_without FROM each GROUP BY word),
    rate AS (SELECT least(sum(n_with) / sum(n_with + n_without), 1 - 1e-9) AS p FROM words),
    score AS (
      SELECT word, n_with, n_without, -2 * (n_with * ln(p) + n_without * ln(1 - p) - n_with * ln(0.99) - n_without * ln(1 - 0.99))
             * exp(-m) * (length(word) - m + 1) / CAST(m AS DOUBLE) ** n_without AS score
      FROM (SELECT *, length(replace(word, '.', '')) AS m FROM words WHERE n_with > 0 AND regexp_matches(word, '[a-z]')), rate
    )"""


@register(
    "abbreviations",
    f"""
    WITH {_periods_sql(X.sentence_documents_sql())}
    SELECT word, n_with, n_without, score >= 0.3 AS is_abbreviation FROM score
    """,
)
def q_abbreviations(spark, sf_dir):
    pieces = reports.piece_counts(X.sentence_documents(read_table(spark, sf_dir, "documents")))
    scored = sentences.period_statistics(pieces)
    return scored.select("word", "n_with", "n_without", (F.col("score") >= sentences.THRESHOLD).alias("is_abbreviation"))


@register(
    "q3_top_words_sentences",
    f"""
    WITH {_periods_sql(X.sentence_documents_sql())},
    tokens AS (
      SELECT CASE WHEN raw[-1] = '.' AND raw[-2] <> '.' AND lower(raw[:-2]) IN (SELECT word FROM score WHERE score >= 0.3) THEN lower(raw)
                  ELSE {O.clean_token('raw')} END AS token, n
      FROM raw
    )
    SELECT token, CAST(sum(n) AS BIGINT) AS n FROM tokens
    WHERE token NOT IN (SELECT token FROM {O.stop_words_values()})
    GROUP BY token ORDER BY n DESC, token LIMIT 50
    """,
)
def q3_top_words_sentences(spark, sf_dir):
    docs = X.sentence_documents(read_table(spark, sf_dir, "documents"))
    return reports.top_text_words(spark, docs, sentences=True)


def subdomains_sql(table: str = "pages") -> str:
    return f"""
    WITH s AS (
      SELECT page_id, {O.netloc('url')} AS netloc, {O.page_key(O.normalize('url'))} AS key,
             {O.subdomain(O.netloc('url'), P.anchor)} AS subdomain
      FROM {table}
    )
    SELECT subdomain, arg_min('http://' || netloc, page_id) AS nice_link,
           count(DISTINCT key) AS n_pages
    FROM s WHERE subdomain IS NOT NULL GROUP BY subdomain ORDER BY subdomain
    """


@register("q4_subdomains", subdomains_sql())
def q4_subdomains(spark, sf_dir):
    return reports.subdomain_pages(resp(spark, sf_dir), P.anchor)
