"""Reports (A1-A6, T1, T2) and crawl-state operators."""

from pyspark.sql import functions as F

from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import frontier as FR
from crawlstats.operators import reports as R
from crawlstats.sources.pages import responses


def _resp(spark, rows):
    return responses(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_q1_fragments_collapse(spark):
    rows = [(1, "http://a.example.com/x#1", ""), (2, "http://a.example.com/x#2", ""), (3, "HTTP://a.example.com/x", "")]
    assert R.unique_pages(_resp(spark, rows)).first().unique_pages == 1


def test_reports_use_the_normalised_requested_url(spark):
    rows = [(1, "http://a.example.com/x/", "a b c"), (2, "http://a.example.com/x", "d"), (3, "http://a.example.com//", "")]
    resp = _resp(spark, rows)
    assert R.unique_pages(resp).first().unique_pages == 2  # x/ and x are one page
    assert R.longest_page(resp).first().url == "http://a.example.com/x"
    assert [(r.subdomain, r.n_pages) for r in R.subdomain_pages(resp, "example").collect()] == [("a", 2)]


def test_q2_tie_goes_to_smallest_id(spark):
    rows = [(5, "http://a.example.com/5", "a b"), (2, "http://a.example.com/2", "c d"), (9, "http://a.example.com/9", "e")]
    r = R.longest_page(_resp(spark, rows)).first()
    assert (r.url, r.n_tokens) == ("http://a.example.com/2", 2)


def test_q2_null_body_is_not_a_candidate(spark):
    rows = [(1, "http://a.example.com/1", None), (2, "http://a.example.com/2", "")]
    r = R.longest_page(_resp(spark, rows)).first()
    assert (r.url, r.n_tokens) == ("http://a.example.com/2", 0)


def test_q2_skips_large_pages(spark):
    rows = [(1, "http://a.example.com/1", "a " * 10), (2, "http://a.example.com/2", "b c")]
    resp = responses(spark.createDataFrame(rows, "page_id long, url string, html string"), size_limit=10)
    assert R.longest_page(resp).first().url == "http://a.example.com/2"


def test_q3_ties_by_token_and_stop_words(spark):
    rows = [(1, "http://a.example.com/1", "<p>the zeta alpha Alpha zeta beta</p>")]
    out = R.top_page_words(spark, _resp(spark, rows), k=2).collect()
    assert [(r.token, r.n) for r in out] == [("alpha", 2), ("zeta", 2)]


def test_q4_case_www_and_order(spark):
    rows = [
        (3, "http://www.vision.example.com/a", ""),
        (1, "http://vision.example.com/b#x", ""),
        (2, "http://vision.example.com/b", ""),
        (4, "http://Vision.example.com/c", ""),
        (5, "http://example.com/root", ""),
        (6, "http://x.vision.example.com/d", ""),
    ]
    out = R.subdomain_pages(_resp(spark, rows), "example").collect()
    assert [(r.subdomain, r.nice_link, r.n_pages) for r in out] == [
        ("Vision", "http://Vision.example.com", 1),
        ("vision", "http://vision.example.com", 3),  # x.vision counts for vision
    ]


def _state(spark):
    rows = [("https://a.example.com/1", True), ("https://a.example.com/2", False), ("https://a.example.com/", False)]
    seeds = spark.createDataFrame([(u,) for u, _ in rows], "url string")
    st = FR.seed_state(seeds)
    done = spark.createDataFrame([("https://a.example.com/1",)], "url string")
    return FR.mark_complete(st, done)


def test_new_urls_dedup_and_anti_join(spark):
    st = _state(spark)
    cand = spark.createDataFrame(
        [(1, "http://a.example.com/2"), (2, "https://a.example.com/3/"), (3, "http://a.example.com/3"), (4, "https://b.example.net/x")],
        "page_id long, url string",
    )
    for bmax in (None, 0, 100):  # lazy shuffle join, written + shuffle, written + broadcast
        got = {r.url: r.bucket for r in FR.new_urls(cand, st, P.buckets, order=("page_id",), broadcast_max_rows=bmax).collect()}
        assert got == {"https://a.example.com/3": 0, "https://b.example.net/x": 1}


def test_mark_complete_upserts(spark):
    st = _state(spark)
    done = spark.createDataFrame([("https://a.example.com/2",), ("https://c.example.com/new",)], "url string")
    results = [{r.url: r.completed for r in FR.mark_complete(st, done, broadcast_max_rows=b).collect()} for b in (None, 0, 100)]
    assert results[0] == results[1] == results[2]
    got = results[0]
    assert got == {
        "https://a.example.com/1": True,
        "https://a.example.com/2": True,
        "https://a.example.com": False,
        "https://c.example.com/new": True,
    }


def test_pending_revalidate_drops_bare_root(spark):
    st = _state(spark)
    assert {r.url for r in FR.pending(st, P).collect()} == {"https://a.example.com/2"}
    assert {r.url for r in FR.pending(st, P, revalidate=False).collect()} == {
        "https://a.example.com/2",
        "https://a.example.com",
    }
    c = FR.state_counts(st, P).first()
    assert (c.total, c.pending) == (3, 1)


def test_fetch_list_matches_plain_window(spark):
    from pyspark.sql import Window

    from conftest import SF001
    from crawlstats.functions.urls import domain_bucket

    pg = spark.read.parquet(f"{SF001}/pages.parquet")
    fr = FR.keyed(pg.select("url")).withColumn("bucket", domain_bucket("url", P.buckets))
    got = FR.fetch_list(fr, 0.5, fanout_hex=1)
    w = Window.partitionBy("bucket").orderBy("url_hash")
    exp = fr.select("url", "bucket", F.row_number().over(w).cast("long").alias("rn"))
    assert got.select("url", "bucket", "rn").exceptAll(exp).count() == 0
    assert exp.exceptAll(got.select("url", "bucket", "rn")).count() == 0
    # Within one rn a bucket appears once; W2: spacing is the delay.
    assert got.groupBy("rn", "bucket").count().where("count > 1").count() == 0
    assert got.where(F.col("earliest_s") != (F.col("rn") - 1) * 0.5).count() == 0
    capped = FR.fetch_list(fr, 0.5, cap=3, ordered=True).collect()
    assert max(r.rn for r in capped) == 3 and [(r.rn, r.bucket) for r in capped] == sorted(
        (r.rn, r.bucket if r.bucket is not None else 99) for r in capped
    )


def test_status_gate_and_approx_q1(spark):
    rows = [
        (1, "http://a.example.com/1", 200, None, "<p>one two three</p>"),
        (2, "http://b.example.com/2", 404, None, "<p>a b c d e f</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, status int, error string, html string")
    resp = responses(pages)
    assert R.unique_pages(resp).first().unique_pages == 2  # Q1 takes any status
    assert R.unique_pages(resp, approx=True).first().unique_pages == 2
    assert R.longest_page(resp).first().url == "http://a.example.com/1"  # 404 skipped
    assert [r.subdomain for r in R.subdomain_pages(resp, "example").collect()] == ["a"]
