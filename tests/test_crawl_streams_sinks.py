"""I1 closure and crawl loop, J3/J4 gates, R1-R3 streams, S5-S8 sinks and state."""

import os
from collections import deque

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import crawl as C
from crawlstats.operators import gates as G
from crawlstats.operators import links as L
from crawlstats.operators import reports as R
from crawlstats.sources import sinks as K
from crawlstats.sources.pages import responses, seed_urls, url_file_scan
from crawlstats.sources.state import StateStore
from crawlstats.streaming import streams as S


def test_reachable_matches_bfs(spark):
    import random

    rnd = random.Random(7)
    n = 120
    edges = [(i, rnd.randrange(n)) for i in range(n) for _ in range(2)] + [(5, 5)]
    seeds = [0, 1]
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    depth = {s: 0 for s in seeds}
    q = deque(seeds)
    while q:
        u = q.popleft()
        for v in adj.get(u, []):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    e = spark.createDataFrame(edges, "src long, dst long")
    sd = spark.createDataFrame([(s,) for s in seeds], "node long")
    for bmax in (1_000_000, 0):  # broadcast path and shuffle path
        got = {r.node: r.depth for r in C.reachable(sd, e, broadcast_max_rows=bmax).collect()}
        assert got == depth


PAGES = [
    (1, "https://a.example.com/", '<a href="/b">b</a><a href="/c?do=x">c</a><a href="https://b.example.net/d">d</a>'),
    (2, "https://a.example.com/b", '<a href="/">home</a><a href="/e.pdf">e</a>'),
    (3, "https://b.example.net/d", '<a href="/f">f</a>'),
    (4, "https://z.example.org/", '<a href="/never">n</a>'),
]


def test_crawl_loop_reaches_fixpoint(spark):
    captured = responses(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    seeds = seed_urls(spark, "https://a.example.com/")
    state = C.crawl(captured, seeds, P)
    got = {r.url: r.completed for r in state.collect()}
    assert got == {
        "https://a.example.com": True,
        "https://a.example.com/b": True,
        "https://b.example.net/d": True,
        "https://b.example.net/f": True,
    }
    # Shuffle path (nothing broadcast, bucketed state): same result.
    from dataclasses import replace

    big = {r.url: r.completed for r in C.crawl(captured, seeds, replace(P, broadcast_max_rows=0)).collect()}
    assert big == got
    # J3 inside the loop: a host whose rules deny everything is never queued.
    rules = spark.createDataFrame([("b.example.net", "/", False)], "host string, path_prefix string, allow boolean")
    gated = {r.url for r in C.crawl(captured, seeds, P, robots=rules).collect()}
    assert gated == {"https://a.example.com", "https://a.example.com/b"}
    # A pluggable extractor replaces G1.
    only_b = lambda resp: L.page_links(resp).where(F.col("link").endswith("/b"))
    got = {r.url for r in C.crawl(captured, seeds, P, extractor=only_b).collect()}
    assert got == {"https://a.example.com", "https://a.example.com/b"}


def test_lookup_captured(spark):
    from crawlstats.operators.frontier import keyed

    captured = responses(spark.createDataFrame(PAGES, "page_id long, url string, html string"), size_limit=40)
    fr = keyed(spark.createDataFrame([("http://a.example.com/b",), ("https://q.example.com/x",)], "url string"))
    for bmax in (None, 0, 100):
        got = {r.url: (r.page_id, r.status, r.error) for r in C.lookup_captured(fr, captured, broadcast_max_rows=bmax).collect()}
        assert got["http://a.example.com/b"] == (2, 606, "FILE TOO LARGE !")
        assert got["https://q.example.com/x"] == (None, None, C.NOT_CAPTURED)


def test_robots_gate(spark):
    rules = spark.createDataFrame(
        [("a.example.com", "/", False), ("b.example.com", "/fr", False), ("b.example.com", "/fr/1", True)],
        "host string, path_prefix string, allow boolean",
    )
    urls = spark.createDataFrame(
        [("http://a.example.com/x",), ("http://b.example.com/fr/2",), ("http://b.example.com/fr/12",), ("http://b.example.com/en",), ("http://c.example.com/",)],
        "url string",
    )
    got = {r.url: r.allowed for r in G.robots_gate(urls, rules).collect()}
    assert got == {
        "http://a.example.com/x": False,
        "http://b.example.com/fr/2": False,
        "http://b.example.com/fr/12": True,
        "http://b.example.com/en": True,
        "http://c.example.com/": True,
    }


def test_robots_gate_query_and_empty_rule(spark):
    rules = [("a.example.com", "/search?q=", False), ("b.example.com", "", False), ("c.example.com", "/x", False), ("c.example.com", "/x", True)]
    urls = ["http://a.example.com/search?q=1", "http://a.example.com/search", "http://b.example.com/y", "http://c.example.com/x", None]
    r = spark.createDataFrame(rules, "host string, path_prefix string, allow boolean")
    u = spark.createDataFrame([(i, x) for i, x in enumerate(urls)] + [(0, urls[0])], "i int, url string")
    got = sorted((x.i, x.allowed) for x in G.robots_gate(u, r).collect())
    assert got == [(0, False), (0, False), (1, True), (2, True), (3, True), (4, True)]


def test_stream_stops_and_resumes_to_batch_result(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    stop = R.english_stop_words(spark).rdd.map(lambda r: r.token).collect()
    first = pages.where("page_id < 25")
    rest = pages.where("page_id >= 25").unionByName(pages.withColumn("page_id", F.col("page_id") + 1001))
    first.repartition(2).write.parquet(src)
    S.write_report(S.running_top_words(S.page_stream(spark, src), stop), out, ckpt).awaitTermination()
    partial = spark.read.parquet(out).count()
    assert partial > 0
    rest.repartition(3).write.mode("append").parquet(src)
    q = S.write_report(S.running_top_words(S.page_stream(spark, src), stop), out, ckpt)
    q.awaitTermination()
    got = {(r.token, r.n) for r in spark.read.parquet(out).collect()}
    exp = {(r.token, r.n) for r in R.top_page_words(spark, responses(pages)).collect()}
    assert got == exp


def test_stream_top_k_updates_resume(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src3", "out3", "ckpt3"))
    stop = R.english_stop_words(spark).rdd.map(lambda r: r.token).collect()
    pages.where("page_id < 20").write.parquet(src)
    S.write_top_k_updates(S.running_word_counts(S.page_stream(spark, src), stop), out, ckpt, k=20).awaitTermination()
    pages.where("page_id >= 20").repartition(3).write.mode("append").parquet(src)
    S.write_top_k_updates(S.running_word_counts(S.page_stream(spark, src), stop), out, ckpt, k=20).awaitTermination()
    got = {(r.token, r.n) for r in S.read_top_k(spark, out).collect()}
    exp = {(r.token, r.n) for r in R.top_page_words(spark, responses(pages), k=20).collect()}
    assert got == exp


def test_stream_top_k_survives_a_crash_while_writing(spark, tmp_dir):
    """A driver that dies inside a trigger leaves that trigger's slot broken; the replay gives the batch result."""
    import shutil

    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src5", "out5", "ckpt5"))
    stop = R.english_stop_words(spark).rdd.map(lambda r: r.token).collect()
    run = lambda: S.write_top_k_updates(S.running_word_counts(S.page_stream(spark, src), stop), out, ckpt, k=20).awaitTermination()
    pages.where("page_id < 15").coalesce(1).write.parquet(src)
    run()
    pages.where("page_id >= 15 and page_id < 30").coalesce(1).write.mode("append").parquet(src)
    run()
    # The third trigger (2) was writing slot 0 when it died: the slot is gone, its commit is missing.
    pages.where("page_id >= 30").coalesce(1).write.mode("append").parquet(src)
    shutil.rmtree(os.path.join(out, "slot=0"))
    run()
    got = {(r.token, r.n) for r in S.read_top_k(spark, out).collect()}
    assert got == {(r.token, r.n) for r in R.top_page_words(spark, responses(pages), k=20).collect()}
    # A missing history is an error, not an empty one.
    shutil.rmtree(os.path.join(out, "slot=0"))
    pages.withColumn("url", F.concat("url", F.lit("/again"))).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        run()


def test_recaptures_count_once(spark, tmp_dir):
    rows = [(1, "http://a.example.com/1", "<p>word</p>"), (2, "http://a.example.com/1", "<p>word</p>"), (3, "https://a.example.com/1/", "<p>word</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src6", "out6", "ckpt6"))
    pages.write.parquet(src)
    S.write_top_k_updates(S.running_word_counts(S.page_stream(spark, src), []), out, ckpt).awaitTermination()
    for got in (R.top_page_words(spark, responses(pages)), S.read_top_k(spark, out)):
        assert [(r.token, r.n) for r in got.collect()] == [("word", 1)]


def test_status_survives_the_reader(spark, tmp_dir):
    from crawlstats.sources.pages import ok_responses, read_pages

    path = os.path.join(tmp_dir, "with-status")
    rows = [(1, "http://a.example.com/1", 200, "<p>a</p>"), (2, "http://a.example.com/2", 404, "<p>b</p>")]
    spark.createDataFrame(rows, "page_id long, url string, status int, html string").write.parquet(path)
    assert [r.page_id for r in ok_responses(responses(read_pages(spark, path))).collect()] == [1]


def test_crawl_resumes_after_a_stop(spark, tmp_dir):
    captured = responses(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    seeds = seed_urls(spark, "https://a.example.com/")
    whole = {r.url for r in C.crawl(captured, seeds, P).collect()}
    root = os.path.join(tmp_dir, "crawl")
    rounds = C.crawl_rounds(captured, seeds, P, root=root)
    assert [next(rounds), next(rounds)] == [0, 1]
    rounds.close()
    assert {r.url for r in C.crawl(captured, seeds, P, root=root).collect()} == whole
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("crawlstats")]
    # A given state: pending URLs that the rules reject are not fetched, and stay pending.
    from crawlstats.operators.frontier import keyed

    state = keyed(spark.createDataFrame([("ftp://evil.test/x",), ("https://a.example.com/b",)], "url string"))
    state = state.select("url_hash", "url", F.lit(False).alias("completed"))
    got = {r.url: r.completed for r in C.crawl(captured, seeds, P, state=state).collect()}
    assert got["ftp://evil.test/x"] is False and got["https://a.example.com/b"] is True


def test_host_only_scope(spark):
    from crawlstats.functions.scope import is_valid

    urls = ["https://a.example.com", "https://a.example.com:8080", "https://example.com/x", "https://evil.test/.example.com/", "https://notexample.com/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.v for r in df.select(is_valid("url", P.domains, host_only=True).alias("v")).collect()]
    assert got == [True, True, True, False, False]


def test_stream_new_urls_append(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src2", "out2", "ckpt2"))
    pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1001)).repartition(4).write.parquet(src)
    S.write_appends(S.running_new_urls(S.page_stream(spark, src), P), out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("url_hash").distinct().count() > 0


def test_sinks_and_formats(spark, tmp_dir):
    resp = responses(spark.read.parquet(f"{SF0001}/pages.parquet"))
    audit = L.scrape(resp, P.domains)
    K_path = os.path.join(tmp_dir, "audit")
    L.write_link_audit(audit, K_path)
    assert sorted(d for d in os.listdir(K_path) if d.startswith("is_valid=")) == ["is_valid=false", "is_valid=true"]
    L.write_link_audit_text(audit, os.path.join(tmp_dir, "ok.txt"), os.path.join(tmp_dir, "bad.txt"))
    bad = [r.value for r in spark.read.text(os.path.join(tmp_dir, "bad.txt")).collect()]
    ok = spark.read.text(os.path.join(tmp_dir, "ok.txt")).count()
    assert ok == audit.where("is_valid").count()
    assert len(bad) == 2 * audit.where("not is_valid").count() and sum(v.startswith("From: ") for v in bad) == len(bad) // 2
    visited = os.path.join(tmp_dir, "visited")
    K.write_visited(resp, visited)
    K.write_visited(resp, visited)
    lines = spark.read.text(visited)
    assert lines.count() == 2 * resp.count() and lines.where(F.col("value").contains("#")).count() == 0
    q2 = K.longest_page_lines(R.longest_page(resp)).first().value
    assert q2.startswith("Longest Page: http") and ", length: " in q2
    q3 = [r.value for r in K.top_words_lines(R.top_page_words(spark, resp)).collect()]
    assert all(": " in v for v in q3) and len(q3) == 50
    q4_path = os.path.join(tmp_dir, "q4")
    K.write_report_lines(K.subdomain_lines(R.subdomain_pages(resp, P.anchor)), q4_path)
    q4 = [r.value for r in spark.read.text(q4_path).collect()]
    assert q4 and all(v.startswith("http://") and v.endswith(" + ") for v in q4)


def test_state_store_restart_and_resume(spark, tmp_dir):
    store = StateStore(spark, os.path.join(tmp_dir, "state"))
    seeds = seed_urls(spark, ["https://a.example.com/", "https://b.example.net/x"])
    st = store.start(seeds)
    assert store.versions() == [0] and st.count() == 2
    from crawlstats.operators.frontier import mark_complete

    store.commit(mark_complete(st, seeds.limit(1)))
    resumed = store.start(seeds)
    assert store.latest() == 1 and resumed.where("completed").count() == 1
    fresh = store.start(seeds, restart=True)
    assert store.latest() == 2 and fresh.where("completed").count() == 0


def test_url_file_scan(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    path = os.path.join(tmp_dir, "urls.txt")
    with open(path, "w") as f:
        f.write("https://a.example.com/x\nftp://a.example.com/x\nhttps://a.example.com/x#f\n")
    got = [(r.url, r.reason) for r in url_file_scan(spark, path, P.domains).collect()]
    assert got == [("https://a.example.com/x", None), ("ftp://a.example.com/x", "scheme"), ("https://a.example.com/x#f", "fragment")]


def test_state_store_ignores_uncommitted_version(spark, tmp_dir):
    store = StateStore(spark, os.path.join(tmp_dir, "state2"))
    seeds = seed_urls(spark, "https://a.example.com/")
    store.start(seeds)
    # A round that died after writing its data but before its commit row.
    store.read().write.parquet(os.path.join(store.root, "v=000007"))
    assert store.latest() == 0 and store.versions() == [0]


def test_size_gate_prefers_stored_length(spark):
    rows = [(1, "http://a.example.com/1", "<p>x</p>", 10), (2, "http://a.example.com/2", "<p>y</p>", 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_bytes long")
    got = {r.page_id: (r.status, r.error) for r in responses(pages, size_limit=1_000_000).collect()}
    assert got == {1: (200, None), 2: (606, "FILE TOO LARGE !")}


def test_robots_rules_reach_root_urls_without_a_path(spark):
    rules = [("m.x.com", "/", False), ("n.x.com", "/?q=", False), ("o.x.com", "/a", False)]
    urls = {"https://m.x.com": False, "https://m.x.com?q=1": False, "https://m.x.com/": False, "https://n.x.com": True, "https://n.x.com?q=1": False, "https://o.x.com": True, "https://o.x.com/a": False}
    r = spark.createDataFrame(rules, "host string, path_prefix string, allow boolean")
    got = {x.url: x.allowed for x in G.robots_gate(spark.createDataFrame([(u,) for u in urls], "url string"), r).collect()}
    assert got == urls


def test_host_only_reaches_every_link_job(spark, tmp_dir):
    html = '<a href="https://a.example.com">root</a><a href="https://evil.test/.example.com/">no</a><a href="https://b.example.com/x">x</a>'
    resp = responses(spark.createDataFrame([(1, "https://a.example.com/1", html)], "page_id long, url string, html string"))
    by = lambda df: {r.link for r in df.where("is_valid").collect()}
    loose, strict = {"https://evil.test/.example.com/", "https://b.example.com/x"}, {"https://a.example.com", "https://b.example.com/x"}
    assert by(L.scrape(resp, P.domains)) == loose and by(L.scrape(resp, P.domains, host_only=True)) == strict
    links = L.page_links(resp)
    assert by(L.link_audit(links, P.domains, host_only=True)) == strict
    assert {r.link for r in L.valid_links(links, P.domains, host_only=True).collect()} == strict
    path = os.path.join(tmp_dir, "urls")
    links.select("link").write.text(path)
    assert {r.url for r in url_file_scan(spark, path, P.domains, host_only=True).where("is_valid").collect()} == strict
