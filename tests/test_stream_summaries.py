"""Bounded stream summaries, line sinks and clocks."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import frontier as FR
from crawlstats.operators import links as L
from crawlstats.operators import reports as R
from crawlstats.operators.clocks import Clocks
from crawlstats.plans import q_streams as QS
from crawlstats.sources import sinks as K
from crawlstats.sources.pages import responses
from crawlstats.streaming import line_sinks as LS
from crawlstats.streaming import streams as S
from crawlstats.streaming import summaries as SU
from crawlstats.streaming.slots import Slots


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def counts_df(spark, c):
    return spark.createDataFrame(list(c.items()), "token string, n long")


@pytest.mark.parametrize("size", [1, 3, 8, 100])
def test_heavy_hitters_bound_every_count(spark, tmp_dir, size):
    rng, slots = random.Random(size), Slots(spark, os.path.join(tmp_dir, "heavy"), SU.WORDS)
    true = Counter()
    for i in range(5):
        batch = Counter(rng.choice("aaaabbbcdefghijklmnop") for _ in range(0 if i == 3 else 60))
        true += batch
        slots.write(SU.merge_heavy(counts_df(spark, batch), slots.before(i), size), i)
        rows = slots.last().collect()
        found = {r.token: r for r in rows if r.token is not None}
        assert len(found) <= size and len({r.error for r in rows}) == 1
        error = rows[0].error
        assert error * (size + 1) <= sum(true.values())  # the published bound
        for w, n in true.items():
            lower, upper = (found[w].lower, found[w].upper) if w in found else (0, error)
            assert lower <= n <= upper, (w, n, lower, upper)
    if size >= 16:
        assert error == 0 and {w: r.lower for w, r in found.items()} == dict(true)


def test_heavy_words_of_a_stream_that_stops_and_goes_on(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    stop = R.english_stop_words(spark)
    for part in pages.randomSplit([0.5, 0.5], 3):
        part.repartition(2).write.mode("append").parquet(src)
        SU.write_heavy_words(S.page_stream(spark, src, 1), stop, out, ckpt, size=300).awaitTermination()
    true = {r.token: r.n for r in R.remove_stop_words(R.word_counts(pages, "html", html=True), stop).collect()}
    found = {r.token: r for r in SU.read_heavy_words(spark, out).collect()}
    assert 0 < len(found) <= 300
    assert all(found[w].lower <= true[w] <= found[w].upper for w in found)
    top = sorted(true, key=lambda w: (-true[w], w))[:20]
    assert all(w in found for w in top)


def test_a_trigger_reads_its_pages_in_several_tasks(spark, tmp_dir):
    """Four triggers, whatever the number of pages, and no page twice; a trigger's files grow in number."""
    src = os.path.join(tmp_dir, "pages")
    pages = spark.range(0, 3000, 1, 6).select(F.col("id").alias("page_id"), F.lit("https://a.example.com/").alias("url"), F.lit("<p>x</p>").alias("html"))
    pages.write.parquet(src)
    pg = spark.read.parquet(src)
    splits = pg.rdd.getNumPartitions()
    assert splits > 1
    stream, ckpt = QS.page_files(spark, pg)
    seen, ids = [], []

    def trigger(batch, i):
        rows = batch.select("page_id", F.spark_partition_id().alias("task")).collect()
        seen.append(len({r.task for r in rows}))
        ids.extend(r.page_id for r in rows)

    stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(trigger).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and min(seen) > 1
    assert sorted(ids) == list(range(3000))


def test_few_pages_or_none_make_a_stream(spark, tmp_dir):
    for n in (0, 1, 5):
        pg = spark.range(n).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("html"))
        stream, ckpt = QS.page_files(spark, pg)
        ids = []
        stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(lambda b, i: ids.extend(r.page_id for r in b.collect())).trigger(availableNow=True).start().awaitTermination()
        assert sorted(ids) == list(range(n))


def test_merged_sketches_equal_the_sketch_of_all(spark, tmp_dir):
    ids = spark.range(60_000)
    pages = ids.select("id", F.concat(F.lit("https://h"), F.col("id") % 7, F.lit(".example.com/"), F.col("id") % 50_000).alias("url"))
    pages = pages.select(F.col("id").alias("page_id"), "url", F.lit(None).cast("string").alias("html"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"))
    src, ckpt, out = (os.path.join(tmp_dir, d) for d in ("src", "ckpt", "out"))
    pages.repartition(3).write.parquet(src)
    stream = S.page_stream(spark, src, 1)
    SU.write_sketches(stream, out, ckpt).awaitTermination()
    merged = SU.estimates(SU.read_sketches(spark, out)).first().n_pages
    whole = SU.estimates(SU.sketches(pages)).first().n_pages
    exact = R.unique_pages(pages).first().unique_pages
    assert merged == whole and abs(merged - exact) <= SU.relative_error() * exact
    assert SU.read_sketches(spark, out).count() == 1  # whatever the number of pages


def test_page_lines_equal_the_batch_sinks_after_a_replay(spark, tmp_dir):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    pages = pages.withColumn("status", F.when(F.col("page_id") % 9 == 0, 404).otherwise(200)).withColumn("error", F.lit(None).cast("string"))
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    pages.repartition(3).write.parquet(src)
    run = lambda: LS.write_page_lines(S.page_stream(spark, src, 1), P, out, ckpt).awaitTermination()
    run()
    resp = responses(pages)
    audit = L.scrape(resp, P.domains, max_len=P.max_url_length)
    L.write_link_audit_text(audit, os.path.join(tmp_dir, "valid"), os.path.join(tmp_dir, "rejected"))
    K.write_visited(resp, os.path.join(tmp_dir, "visited"))
    want = sorted((f, r.value) for f in LS.FILES for r in spark.read.text(os.path.join(tmp_dir, f)).collect())
    assert rows_of(LS.read_lines(spark, out)) == want
    # The last trigger died before the stream's own commit: it is run again.
    last = max(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        path = os.path.join(ckpt, "commits", f)
        if os.path.exists(path):
            os.remove(path)
    run()
    assert rows_of(LS.read_lines(spark, out)) == want
    # One that died between its lines and its own commit is not read.
    spark.createDataFrame([("half",)], "value string").write.text(os.path.join(out, "lines", "trigger=99", "file=visited"))
    assert rows_of(LS.read_lines(spark, out, ["visited"])) == [x for x in want if x[0] == "visited"]


def test_slots_survive_a_half_written_trigger(spark, tmp_dir):
    t = Slots(spark, os.path.join(tmp_dir, "t"), "v int")
    assert t.before(0) is None
    t.write(spark.createDataFrame([(1,)], "v int"), 0)
    t.write(spark.createDataFrame([], "v int"), 1)
    assert t.last().collect() == [] and t.before(2).collect() == []
    with pytest.raises(RuntimeError):
        t.before(4)


def frontier(spark, n, hosts):
    urls = [(f"https://{hosts[i % len(hosts)]}/{i}",) for i in range(n)]
    df = FR.keyed(spark.createDataFrame(urls, "url string"))
    from crawlstats.functions.urls import domain_bucket

    return df.withColumn("bucket", domain_bucket("url", P.buckets))


def test_two_lists_equal_one_of_their_union(spark, tmp_dir):
    a, b = frontier(spark, 40, ["a.example.com", "b.example.net"]), frontier(spark, 60, ["c.example.com", "d.example.org", "e.other.test"])
    clocks = Clocks(spark, os.path.join(tmp_dir, "clocks"))
    got = rows_of(clocks.next_list(a, 0.5, workers=3).unionByName(Clocks(spark, os.path.join(tmp_dir, "clocks")).next_list(b, 0.5, workers=3)))
    queues = {}
    for df in (a, b):
        for r in sorted(df.collect(), key=lambda r: (r.url_hash, r.url)):
            queues.setdefault(r.bucket, []).append(r.url)
    want = [(u, k, i + 1, i % 3, (i // 3) * 0.5) for k, us in queues.items() for i, u in enumerate(us)]
    assert got == sorted(want, key=str)
    # No worker of a bucket starts twice within the delay.
    turns = [(k, w, t) for _, k, _, w, t in got]
    assert len(set(turns)) == len(turns)
    assert {r.bucket: r.taken for r in clocks.read().collect()} == {k: len(us) for k, us in queues.items()}


def test_a_capped_list_moves_the_clock_by_what_it_took(spark, tmp_dir):
    clocks = Clocks(spark, os.path.join(tmp_dir, "clocks"))
    assert clocks.read().collect() == []
    df = frontier(spark, 10, ["a.example.com"])
    assert [r.rn for r in clocks.next_list(df, 1.0, cap=4).orderBy("rn").collect()] == [1, 2, 3, 4]
    assert [r.earliest_s for r in clocks.next_list(df, 1.0, cap=2).orderBy("rn").collect()] == [4.0, 5.0]
    assert clocks.next_list(df.where("false"), 1.0).collect() == []
