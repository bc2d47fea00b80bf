"""The four corpus reports (A1-A6, T1, T2, J2) as batch jobs.

Q1 unique pages, Q2 longest page by tokens, Q3 top words after stop-word
removal, Q4 unique pages per subdomain. Each reads only the columns it needs
(Q1 and Q4 never touch the HTML), aggregates with a map-side partial step and
breaks every tie on a stable key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import written_once
from crawlstats.functions.stop_words import ENGLISH_STOP_WORDS
from crawlstats.functions.text import clean_token, page_token_count, split_words, visible_text
from crawlstats.functions.urls import nice_link, normalize, page_key, subdomain, url_hash, url_parts
from crawlstats.operators.sentences import abbreviations, sentence_words
from crawlstats.sources.pages import ok_responses

TOP_WORDS = 50


def english_stop_words(spark: SparkSession) -> DataFrame:
    """The fixed English stop-word list (181 words) as a table."""
    return spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "token string")


def unique_pages(resp: DataFrame, approx: bool = False) -> DataFrame:
    """A1 / Q1: distinct fragment-free URLs among processed pages (any status).

    A page is known by the URL the crawler requested, which is always the
    normalised one (U2), so ``.../x/`` and ``.../x`` are one page.
    """
    key = page_key(normalize("url"))
    agg = F.approx_count_distinct(key) if approx else F.count_distinct(key)
    return resp.select("url").agg(agg.cast("long").alias("unique_pages"))


def page_token_counts(resp: DataFrame) -> DataFrame:
    """A2: tokens per status-200 page (before stop words); null body gives 0."""
    pages = ok_responses(resp).select("page_id", "url", "html")
    return pages.select("page_id", "url", page_token_count("html").alias("n_tokens"))


def longest_page(resp: DataFrame) -> DataFrame:
    """A3 / Q2: the page with most tokens; ties go to the smallest page_id.

    Pages without a body are not candidates.

    One ``max_by`` aggregate: a partial max per task and a one-row final,
    no sort and no shuffle of pages.
    """
    counts = page_token_counts(resp.where(F.col("html").isNotNull()))  # D8: no body, no entry
    best = F.max_by(F.struct("url", "n_tokens"), F.struct(F.col("n_tokens"), -F.col("page_id")))
    return (
        counts.agg(best.alias("b"))
        .where(F.col("b").isNotNull())
        .select(normalize(F.col("b.url")).alias("url"), F.col("b.n_tokens").alias("n_tokens"))
    )


def piece_counts(texts: DataFrame, text_col: str = "text", html: bool = False) -> DataFrame:
    """(raw, n): occurrences of every piece of text between separators, as written.

    Generator and partial aggregate share one codegen stage and combine
    map-side, so a piece leaves its task once, however frequent.
    """
    text = visible_text(text_col) if html else F.col(text_col)
    return pieces_of(texts.select(split_words(text).alias("pieces")))


def pieces_of(texts: DataFrame) -> DataFrame:
    """(raw, n) of texts that are split already, from ``pieces``."""
    return texts.select(F.explode("pieces").alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


def clean_counts(pieces: DataFrame) -> DataFrame:
    """(token, n) from (raw, n): distinct pieces are cleaned, not occurrences; spellings of one token meet in a second sum."""
    toks = pieces.select(clean_token("raw").alias("token"), "n").where(F.col("token").isNotNull())
    return toks.groupBy("token").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame, text_col: str = "text", html: bool = False) -> DataFrame:
    """A4: occurrences of every token over all texts (duplicates counted)."""
    return clean_counts(piece_counts(texts, text_col, html))


def remove_stop_words(counts: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Drop stop words from the per-token counts.

    Done after A4, so the anti join touches distinct words only. Spark
    broadcasts the list where its size allows, as that of the default one does.
    """
    return counts.join(stop_words.select("token"), "token", "left_anti")


def top_words(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """The k most frequent words, ties by token (TakeOrderedAndProject)."""
    return counts.orderBy(F.col("n").desc(), F.col("token").asc()).limit(k)


def later_captures(resp: DataFrame) -> DataFrame:
    """(page_id, url) of status-200 responses whose URL hash has one with a smaller page_id.

    Only ids and URLs are shuffled to find them; they are few beside the pages.
    """
    ids = ok_responses(resp).select("page_id", "url", url_hash("url").alias("url_hash"))
    first = ids.groupBy("url_hash").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return ids.join(first, "url_hash").where("page_id <> first").select("page_id", "url").distinct()


def first_captures(resp: DataFrame, *values: Column) -> DataFrame:
    """One status-200 response of each URL hash, the one with the smallest page_id: all its columns, or ``values`` of it.

    ``values`` are made before the later captures are taken out, so where
    these are too many to broadcast, both sides shuffle without the HTML.
    """
    ok = ok_responses(resp)
    ok = ok.select("page_id", "url", *values) if values else ok
    return ok.join(later_captures(resp), ["page_id", "url"], "left_anti")


def top_page_words(spark: SparkSession, resp: DataFrame, k: int = TOP_WORDS, stop_words: DataFrame | None = None) -> DataFrame:
    """Q3 over HTML pages: status 200, visible text, stop words removed."""
    stop = stop_words if stop_words is not None else english_stop_words(spark)
    pages = first_captures(resp, split_words(visible_text("html")).alias("pieces"))
    return top_words(remove_stop_words(clean_counts(pieces_of(pages)), stop), k)


def top_text_words(
    spark: SparkSession, docs: DataFrame, text_col: str = "text", k: int = TOP_WORDS, stop_words: DataFrame | None = None, sentences: bool = False
) -> DataFrame:
    """Q3 over plain-text documents (no markup removal); with ``sentences`` abbreviations keep their period."""
    stop = stop_words if stop_words is not None else english_stop_words(spark)
    if sentences:
        pieces = written_once(piece_counts(docs.select(text_col), text_col), "pieces")  # read twice
        counts = sentence_words(pieces, abbreviations(pieces))
    else:
        counts = word_counts(docs.select(text_col), text_col)
    return top_words(remove_stop_words(counts, stop), k)


def subdomain_pages(resp: DataFrame, anchor: str) -> DataFrame:
    """A5 + A6 / Q4: unique pages per subdomain of the anchor domain.

    Status 200 only; hosts without the anchor label, or where it is the
    first label, are skipped. ``nice_link`` is ``http://<host>`` of the
    first page (smallest page_id) seen in the subdomain. Rows in ascending
    subdomain order, capitals first (T2).
    """
    p = url_parts("url")
    rows = ok_responses(resp).select(
        "page_id",
        subdomain(p["netloc"], anchor).alias("subdomain"),
        page_key(normalize("url")).alias("key"),
    )
    # Distinct pages first: a hash aggregate whose buffer is the first page_id
    # (a page key repeated many times combines map-side); then one row per
    # subdomain over distinct pages only.
    pages = rows.where(F.col("subdomain").isNotNull()).groupBy("subdomain", "key").agg(
        F.min("page_id").alias("first_id")
    )
    return (
        pages.groupBy("subdomain")
        .agg(
            F.min_by(nice_link(F.col("key.netloc")), "first_id").alias("nice_link"),
            F.count(F.lit(1)).alias("n_pages"),
        )
        .orderBy("subdomain")
    )


__all__: Sequence[str] = (
    "english_stop_words",
    "unique_pages",
    "page_token_counts",
    "longest_page",
    "piece_counts",
    "word_counts",
    "remove_stop_words",
    "top_words",
    "later_captures",
    "first_captures",
    "top_page_words",
    "top_text_words",
    "subdomain_pages",
)
