"""The crawl state as a stream: steps, counts, stop and resume, replay."""

import os
import random

import pytest
from pyspark.sql import functions as F

from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import frontier as FR
from crawlstats.streaming import crawl_state as CS

EVENTS = "url string, done boolean, ord long"


def deliver(spark, root, rows, per_trigger=1000, **kw):
    src = os.path.join(root, "src")
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", per_trigger).parquet(src)
    CS.write_state(stream, P, os.path.join(root, "out"), os.path.join(root, "ckpt"), **kw).awaitTermination()
    return os.path.join(root, "out")


def batch_state(spark, deliveries):
    """The same deliveries through the batch operators, one after the other."""
    state = spark.createDataFrame([], "url_hash string, url string, completed boolean")
    for rows in deliveries:
        df = spark.createDataFrame(rows, EVENTS)
        found = FR.new_urls(df.select("url", "ord"), state, P.buckets, order=("ord",))
        state = state.unionByName(found.select("url_hash", "url", F.lit(False).alias("completed")))
        state = FR.mark_complete(state, df.where("done").select("url")).checkpoint()
    return state


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_events(rng, n):
    urls = [f"{s}://{h}.example.com/{i}{t}" for s in ("http", "https") for h in "ab" for i in range(12) for t in ("", "/")]
    urls += [f"https://a.example.org/{i}" for i in range(5)] + ["https://a.example.com"]
    return [(rng.choice(urls), rng.random() < 0.3, rng.randrange(100)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_stop_equals_the_batch_state(spark, tmp_dir, seed):
    rng = random.Random(seed)
    deliveries = [random_events(rng, n) for n in (30, 40, 1, 30)]
    for i, rows in enumerate(deliveries, 1):  # each delivery is a query of its own, started from the checkpoint
        out = deliver(spark, tmp_dir, rows)
        state = batch_state(spark, deliveries[:i])
        assert rows_of(CS.read_state(spark, out)) == rows_of(state)
        assert rows_of(CS.read_counts(spark, out)) == rows_of(FR.state_counts(state, P))
        assert rows_of(CS.read_pending(spark, out, P)) == rows_of(FR.pending(state, P))


def test_counts_without_scope_rules_and_several_triggers(spark, tmp_dir):
    rows = [(f"ftp://x.test/{i}", False, i) for i in range(6)]
    for r in rows[:3]:
        spark.createDataFrame([r], EVENTS).coalesce(1).write.mode("append").parquet(os.path.join(tmp_dir, "src"))
    out = deliver(spark, tmp_dir, rows[3:] + [("ftp://x.test/0", True, 9)], per_trigger=1, revalidate=False)
    assert rows_of(CS.read_counts(spark, out)) == [(6, 5)]
    assert CS.read_state(spark, out).where("completed").count() == 1


def test_a_trigger_without_its_counts_is_not_read(spark, tmp_dir):
    out = deliver(spark, tmp_dir, [("https://a.example.com/1", False, 1)])
    # A trigger that died between its rows and its counts.
    half = spark.createDataFrame([("h", "https://a.example.com/2", True)], "url_hash string, url string, completed boolean")
    half.write.parquet(os.path.join(out, "rows", "batch=7"))
    assert [r.url for r in CS.read_state(spark, out).collect()] == ["https://a.example.com/1"]
