"""Registered URL queries: U1-U8 and the scope rules F2-F17."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlstats.functions import scope
from crawlstats.functions.urls import (
    domain_bucket,
    hash_key,
    normalize,
    resolve_href,
    subdomain,
    url_hash,
    url_parts,
)
from crawlstats.plans import fixtures as X
from crawlstats.plans import oracle as O
from crawlstats.plans.queries import P, pages, register


@register(
    "url_parts",
    f"SELECT page_id, url, {O.parts_select('url')} FROM ({X.url_variants_sql()})",
)
def q_url_parts(spark, sf_dir):
    v = X.url_variants(pages(spark, sf_dir))
    return v.select("page_id", "url", url_parts("url").alias("p")).select("page_id", "url", "p.*")


@register(
    "url_normalize",
    f"SELECT page_id, url, {O.normalize('url')} AS url_norm FROM ({X.scheme_twins_sql()})",
)
def q_url_normalize(spark, sf_dir):
    t = X.scheme_twins(pages(spark, sf_dir))
    return t.select("page_id", "url", normalize("url").alias("url_norm"))


@register(
    "url_hash",
    f"""
    SELECT page_id, url, {O.hash_key(O.normalize('url'))} AS hash_key, {O.url_hash('url')} AS url_hash
    FROM ({X.scheme_twins_sql()})
    """,
)
def q_url_hash(spark, sf_dir):
    t = X.scheme_twins(pages(spark, sf_dir))
    return t.select(
        "page_id",
        "url",
        hash_key(url_parts(normalize("url"))).alias("hash_key"),
        url_hash("url").alias("url_hash"),
    )


@register(
    "href_resolve",
    f"""
    SELECT page_id, url, href, {O.resolve_href('url', 'href')} AS link,
           contains({O.resolve_href('url', 'href')}, 'do=') AS dropped
    FROM ({X.hrefs_sql()})
    """,
)
def q_href_resolve(spark, sf_dir):
    h = X.hrefs(pages(spark, sf_dir))
    link = resolve_href("url", "href")
    return h.select("page_id", "url", "href", link.alias("link")).withColumn(
        "dropped", F.col("link").contains("do=")
    )


@register(
    "domain_bucket",
    f"SELECT page_id, url, {O.domain_bucket('url', P.buckets)} AS bucket FROM ({X.url_variants_sql()})",
)
def q_domain_bucket(spark, sf_dir):
    v = X.url_variants(pages(spark, sf_dir))
    return v.select("page_id", "url", domain_bucket("url", P.buckets).alias("bucket"))


@register(
    "url_subdomain",
    f"""
    SELECT netloc, {O.subdomain('netloc', P.anchor)} AS subdomain,
           'http://' || netloc AS nice_link
    FROM ({X.netloc_variants_sql()})
    """,
)
def q_url_subdomain(spark, sf_dir):
    n = X.netloc_variants(pages(spark, sf_dir))
    return n.select(
        "netloc",
        subdomain("netloc", P.anchor).alias("subdomain"),
        F.concat(F.lit("http://"), "netloc").alias("nice_link"),
    )


def _reason_sql(profile: str) -> str:
    r = O.reject_reason("url", P.domains, profile)
    return f"""
    SELECT page_id, url, expected, {r} AS reason, ({r}) IS NULL AS is_valid
    FROM ({X.url_variants_sql()})
    """


def _reason_df(spark, sf_dir, profile):
    v = X.url_variants(pages(spark, sf_dir))
    r = scope.reject_reason("url", P.domains, profile=profile, max_len=P.max_url_length)
    return v.select("page_id", "url", "expected", r.alias("reason")).withColumn(
        "is_valid", F.col("reason").isNull()
    )


@register("url_reject_reason", _reason_sql("full"))
def q_url_reject_reason(spark, sf_dir):
    return _reason_df(spark, sf_dir, "full")


@register("url_scope_basic", _reason_sql("basic"))
def q_url_scope_basic(spark, sf_dir):
    return _reason_df(spark, sf_dir, "basic")
