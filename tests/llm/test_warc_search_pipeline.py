"""op7, op10 and the pipeline, against brute force."""

import base64
import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from crawlstats.config import shared_dir
from crawlstats.llm import top_k as K
from crawlstats.llm import warc as W

# --- WARC --------------------------------------------------------------------------------

PAGES = [
    (1, "http://www.example.com/a?x=1", "<p>same</p>"),
    (5, "http://b.example.com:8080/", "<p>same</p>"),
    (3, "https://example.com/c\r\nWARC-Type: evil", "<p>same</p>"),
    (4, None, "tricky \r\n\r\nWARC/1.1\r\n\r\n payload é中"),
    (6, "http://example.com/", None),
    (7, "http://example.com/", ""),
    (-9, "not a url [", "x" * 300_000),
    (2**62, "http://z.example.com/", "big id"),
    (None, "http://null.example.com/", "<p>same</p>"),
    (5, "http://b.example.com:8080/", "<p>same</p>"),
]


def expected(rows, least=0):
    first, out = {}, Counter()
    for i, _, p in rows:
        p = (p or "").encode()
        if i is not None and len(p) >= least:
            first[p] = max(first.get(p, i), i)
    for i, _, p in rows:
        p = (p or "").encode()
        refers = first.get(p) if i is not None and first.get(p, i) != i else None
        out[i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if refers is not None else "response", refers] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.selectExpr("*", "'clash' as n", "'clash' as payload", "'clash' as refers_to").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_and_index(spark, pages, least):
    rows = W.archive_and_index(pages, min_bytes=least).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected(PAGES, least)
    ordered = sorted(rows, key=lambda r: (r.part, r.nth))
    keys = [(r.url_key, r.timestamp, -(1 << 64) if r.page_id is None else r.page_id) for r in ordered]
    assert keys == sorted(keys)
    assert {r.url_key for r in rows} >= {"com,example)/a?x=1", "com,example,b:8080)/", "com,example)/", ""}


def test_repeated_page_id_with_other_payloads(spark):
    """Each payload is archived, or refers to an equal one; no row is lost or doubled."""
    rows = [(5, "A"), (5, "B"), (9, "A"), (6, "C"), (6, "D"), (7, "C"), (8, "D"), (5, "B"), (9, "E"), (None, "A")]
    rows = [(i, f"http://example.com/{n}", p) for n, (i, p) in enumerate(rows)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = W.archive_and_index(df).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


def test_archives_are_plain_warc_files(spark, pages):
    path = shared_dir(spark, "warc-test")
    W.write_archives(pages, path)
    data = b"".join(gzip.decompress(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect())
    seen = at = 0
    while at < len(data):
        assert data[at:].startswith(b"WARC/1.1\r\nWARC-Type: ")
        end = data.index(b"\r\n\r\n", at) + 4
        at = end + int(W.parse_headers(data[at:end])["content-length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at, seen = at + 4, seen + 1
    assert seen == len(PAGES)


def test_damaged_archives_are_noticed(spark):
    [record] = W.records(spark.createDataFrame([(1, "http://a.example.com/", "payload")], "page_id long, url string, payload string"), 0).collect()
    whole = (record.value + "\r\n\r\n").encode()
    assert len(list(W.parse_archive("a", gzip.compress(whole) + gzip.compress(whole)))) == 2
    for broken in (whole.replace(b"payload\r\n", b"pay1oad\r\n"), whole[:-9], whole[:-1] + b"x"):
        with pytest.raises(ValueError):
            list(W.parse_archive("a", gzip.compress(broken)))


def test_record_ids_hold_page_ids(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901234567]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", W.record_id(F.col("i")).alias("r")).collect()
    assert [W.page_of(r.r) for r in rows] == ids and len({r.r for r in rows}) == len(ids)


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 16])
def test_loser_tree(runs):
    r = random.Random(runs)
    lists = [sorted(r.randrange(20) for _ in range(r.randrange(0, 30))) for _ in range(runs)]
    assert list(W.LoserTree([iter(x) for x in lists], lambda v: v)) == sorted(v for x in lists for v in x)


def test_one_hot_url_spans_ranges(spark):
    rows = spark.range(3000).selectExpr("id as page_id", "if(id % 3 = 0, 'http://hot.example.com/', concat('http://h', id, '.example.com/')) as url", "cast(id as string) as html")
    index = W.archive_and_index(rows.repartition(5))
    got = sorted(index.collect(), key=lambda r: (r.part, r.nth))
    assert [(r.url_key, r.page_id) for r in got] == sorted((r.url_key, r.page_id) for r in got) and len(got) == 3000


def captures(rng, archive, n):
    own = [(f"key{rng.randrange(9)}", f"2024{rng.randrange(5)}", rng.choice([None, *range(20)]), "u", "response", 1, "d", None, archive, i) for i in range(n)]
    return sorted(own, key=W.run_order)


@pytest.mark.parametrize("bound", [1, 4000, 1 << 30])
def test_runs_that_arrive_in_pieces(tmp_path, bound):
    """Pieces of an archive's run in any order, in memory and in files."""
    rng = random.Random(bound)
    runs, every, pieces = W.Runs(str(tmp_path), bound), [], []
    for a in range(7):
        rows = captures(rng, f"archive{a}", rng.randrange(60))
        every += rows
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(3))
        pieces += [p for p in (rows[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)])) if p]
    rng.shuffle(pieces)
    joined = [r for p in pieces for r in p]
    for at in range(0, len(joined), 11):  # batches that end inside a piece
        runs.add(W._batch(joined[at : at + 11], W.SCHEMA))
    assert list(runs.merged()) == sorted(every, key=W.run_order)
    assert bound > 1 or list(tmp_path.iterdir())


def test_a_run_split_over_map_tasks_is_merged_in_order(spark, pages):
    """Every row group of the runs is a split of its own, read by tasks in any order."""
    rows = spark.range(30_000).selectExpr("id as page_id", "concat('http://h', pmod(hash(id), 500), '.example.com/') as url", "'x' as html")
    path = shared_dir(spark, "warc-split")
    W.write_archives(rows.coalesce(1), path)
    runs = W.read_runs(spark, path).collect()
    small = shared_dir(spark, "small-runs")
    ordered = spark.createDataFrame(runs, W.CAPTURE).coalesce(1)
    ordered.write.option("parquet.block.size", 64 << 10).option("parquet.page.size", 8 << 10).option("parquet.block.size.row.check.min", 100).parquet(small)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))
    try:
        split = spark.read.schema(W.CAPTURE).parquet(small)
        assert split.rdd.getNumPartitions() > 4
        got = sorted(W.merge_runs(split).collect(), key=lambda r: (r.part, r.nth))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.url_key, r.timestamp, r.page_id) for r in got] == sorted((r.url_key, r.timestamp, r.page_id) for r in got) and len(got) == 30_000


def test_large_payloads_have_archives_of_fewer_records(spark, monkeypatch):
    monkeypatch.setattr(W, "SMALL_BYTES", 100)
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 8)
    rows = spark.range(64).selectExpr("id as page_id", "concat('http://h', id, '.example.com/') as url", "repeat('x', cast(if(id < 32, 50, 50 * id) as int)) as html")
    path = shared_dir(spark, "warc-sizes")
    W.write_archives(rows.coalesce(1), path)
    total = 0
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect():
        sizes = [r[5] for r in W.parse_archive("a", f.content)]
        total += len(sizes)
        assert len(sizes) <= 8 and (max(sizes) <= 100 or (len(sizes) - 1) * max(sizes) < 8 * 2 * 100)
    assert total == 64


def test_no_pages(spark, pages):
    assert W.archive_and_index(pages.where("false")).collect() == []


# --- search -------------------------------------------------------------------------------

def brute(rows, every, k):
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asks = {}
    for i, v in whole:
        if i % every == 0:
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, v in asks.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [K.CANDIDATE_BLOCK, 7])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(K, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    monkeypatch.setattr(K, "ROUND_BYTES", 16 << 20 if block > 7 else 200)  # many rounds
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.standard_normal(8)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8), (310, [0.0] * 8)]
    rows += [(320, [1.0, 2.0]), (321, [3.0, -1.0]), (330, []), (20, rows[5][1]), (331, [1e17] * 8), (340, [-2e3] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(3)
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in K.top_k(df.where("coalesce(vec_id, 0) <> 331"), F.col("vec_id") % 10 == 0, 5).collect())
    assert got == brute([x for x in rows if x[0] != 331], 10, 5)
    assert K.top_k(df.where("false"), F.col("vec_id") % 10 == 0, 5).collect() == []


@pytest.mark.parametrize("block", [K.CANDIDATE_BLOCK, 7])
def test_top_k_beyond_the_exact_range(spark, monkeypatch, block):
    """Large components rank exactly; a score that no long holds is null."""
    monkeypatch.setattr(K, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(K, "QUERY_BLOCK", 3)
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.standard_normal(8)]) for i in range(60)]
    rows += [(331, [1e17] * 8), (332, [1e17] * 7 + [2e17]), (333, [-1e17] * 8), (334, [1e300] * 8), (335, [1e17] * 8)]
    rows += [(340, [1e10] * 8), (341, [float(x) for x in r.standard_normal(8) * 1e8]), (342, [3e6, -3e6] * 4), (350, [1e17, -1e17] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    exp = brute(rows, 10, 40)
    held = lambda s: s if -(2**63) <= s < 2**63 else None
    assert {i for _, _, i, s in exp if held(s) is None} > {331, 334} and any(held(s) and abs(s) > 2**53 for *_, s in exp)
    got = sorted(((x.query_id, x["rank"], x.vec_id, x.score) for x in K.top_k(df, F.col("vec_id") % 10 == 0, 40).collect()), key=lambda x: x[:3])
    assert got == [(q, n, i, held(s)) for q, n, i, s in exp]


@pytest.mark.parametrize("candidates,queries", [(8192, 512), (16, 3), (50, 1)])
def test_running_lists_over_blocks(monkeypatch, candidates, queries):
    """Blocks of a task one after the other, with what was found before as a bound."""
    import pyarrow as pa

    monkeypatch.setattr(K, "CANDIDATE_BLOCK", candidates)
    monkeypatch.setattr(K, "QUERY_BLOCK", queries)
    r = np.random.default_rng(8)
    rows = [(i, r.standard_normal(6).round(1).tolist()) for i in range(300)]  # many ties
    asked = [x for x in rows if x[0] % 25 == 0]
    now = K.Round(asked, 4, 10)
    for at in range(0, 300, 37):
        part = rows[at : at + 37]
        assert now.add(np.array([i for i, _ in part]), pa.array([v for _, v in part], pa.list_(pa.float64()))) == []
    got = sorted((q, -s, i) for b in now.end() for q, i, s in zip(*b))
    whole = {i: np.floor(10 * np.array(v)).astype(int) for i, v in rows}
    want = []
    for q, _ in asked:
        want += [(q, *x) for x in sorted((-int(whole[q] @ w), i) for i, w in whole.items() if i != q)[:4]]
    assert got == sorted(want)


def test_candidates_are_not_shuffled(spark):
    df = spark.range(500).selectExpr("id as vec_id", "array(cast(id as double), 1.0D) as embedding")
    out = K.top_k(df, F.col("vec_id") % 100 == 0, 3)
    assert len(out.collect()) == 15
    files = spark.read.parquet(*{f.rpartition("/")[0] for f in out.inputFiles()})
    assert files.count() <= 5 * 3 * spark.sparkContext.defaultParallelism  # k rows of a query and task


def test_top_k_of_components_that_overflow(spark):
    rows = [(0, [1.0, 0.5]), (1, [1e308, 1e308]), (2, [-1.7e308, 1.7e308]), (3, [2.0, 1e306]), (4, [0.25, 3.0]), (10, [1.7e308, -1e308])]
    scaled = lambda v: [int(np.floor(1024 * x)) if abs(1024 * x) < 2**53 else int(1024 * x) if np.isfinite(1024 * x) else int(x) * 1024 for x in v]
    exp = []
    for q, v in rows:
        if q % 10 == 0:
            found = sorted((-sum(a * b for a, b in zip(scaled(v), scaled(w))), i) for i, w in rows if i != q)
            exp += [(q, n, i, -s if abs(s) < 2**63 else None) for n, (s, i) in enumerate(found, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = sorted(tuple(r) for r in K.top_k(df, F.col("vec_id") % 10 == 0, 10).collect())
    assert got == sorted(exp)


def test_bounds_hold_at_every_depth():
    r = np.random.default_rng(1)
    x, q = r.integers(-300, 300, (200, 6)), r.integers(-300, 300, (4, 6))
    lists = K.SortedLists(np.arange(200), x)
    exact = lists.x @ q.T
    width = np.inf
    for depth in (1, 20, 100, 150, 200):
        lower, upper = lists.bounds(q, depth)
        assert (lower <= exact).all() and (exact <= upper).all()
        assert (upper - lower).sum() <= width
        width = (upper - lower).sum()
    assert width == 0


# --- pipeline -------------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline as C
    from crawlstats.llm import exact_dedup, simhash, substring_dedup, toxicity

    assert [n for n, _ in C.STAGES][:2] == ["toxicity", "exact_dedup"] and C.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    before = docs
    for name, stage in C.STAGES:
        path = shared_dir(spark, f"test-stage-{name}")
        stage(spark, before, SF0001).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "best_fit_packing":
            assert after.columns == docs.columns
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.toxicity(before, spark.read.parquet(f"{SF0001}/labels.parquet")).collect() if r.predicted}
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "exact_dedup":
            stay = {r.doc_id for r in exact_dedup.exact_dedup(before).collect() if r.kept}
            assert {r.doc_id for r in after.collect()} == stay and after.count() == len(stay)
        elif name == "simhash_near_dedup":
            assert {r.doc_id for r in after.collect()} == {r.component_id for r in simhash.near_duplicates(before).collect()}
        elif name == "substring_dedup":
            exp = {r.doc_id: (r.kept if r.n_removed else r.text) for r in substring_dedup.remove_repeats(before).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == exp
            assert all(r.n_chars == len(r.text) for r in after.collect())
        else:
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
        before = after
    whole = C.run(spark, SF0001)
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in whole.collect()) == Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in before.collect())


def test_registered():
    import __spark_entry__ as E

    names = E.queries()
    for n in range(1, 11):
        assert [q for q in names if q.startswith(f"op{n}_")], n
    assert "pipeline" in names


def test_stages_take_hard_and_empty_tables(spark, hard_documents, no_documents):
    import corpus_pipeline as C

    for df in (hard_documents, no_documents):
        docs = df.withColumn("near_copy_id", F.lit("clash")).withColumn("sequence_id", F.lit("clash"))
        for name, stage in C.STAGES:
            path = shared_dir(spark, f"hard-stage-{name}")
            done = stage(spark, docs, SF0001)
            done.write.parquet(path)
            after = spark.read.schema(done.schema).parquet(path)
            if name != "best_fit_packing":
                assert after.columns == docs.columns
                docs = after
        assert (docs.count() == 0) == (df is no_documents)
        assert {r.doc_id for r in after.collect()} == {r.doc_id for r in docs.collect()}
