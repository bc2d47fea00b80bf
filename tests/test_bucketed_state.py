"""Bucketed crawl state: joins without an exchange, membership filter, compaction."""

import re

from pyspark.sql import functions as F

from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import frontier as FR
from crawlstats.sources import bucketed_state as B


def urls(spark, a, b, host="a.example.com"):
    return spark.range(a, b).select(F.concat(F.lit(f"https://{host}/"), "id").alias("url"))


def state_rows(df, done=False):
    return FR.keyed(df).withColumn("completed", F.lit(done))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def ancestors_of_scans(df, marker: str) -> list[list[str]]:
    """For each scan in the final plan whose line holds ``marker``: the operators above it, up to the next join or the root."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    out = []
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if marker in line:
            own, d = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < d:
                    d = depth(up)
                    own.append(up.strip(" :+-"))
                    if "Join" in up:
                        break
            out.append(own)
    return out


def test_new_urls_meet_the_state_only_on_hits(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=5)
    store.start(state_rows(urls(spark, 0, 3000)))
    store.commit(state_rows(urls(spark, 2990, 3100), True))
    candidates = urls(spark, 2500, 4000).union(urls(spark, 0, 10, "b.example.org")).union(urls(spark, 2500, 2600))
    want = FR.new_urls(candidates, store.read(), P.buckets)
    got = store.new_urls(candidates, P.buckets)
    assert rows_of(got) == rows_of(want) and got.count() == 900 + 10
    for above in ancestors_of_scans(got, "version"):
        assert not any(re.match(r"(\* )?(\(\d+\) )?Exchange", x) for x in above), above
    above = ancestors_of_scans(got, "Bucketed: true")
    assert above and all("Exchange" not in x for a in above for x in a), above


def test_latest_rows_without_an_exchange(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=4)
    store.start(state_rows(urls(spark, 0, 50)))
    store.complete(urls(spark, 40, 60))
    state = store.read()
    assert rows_of(state) == rows_of(FR.mark_complete(state_rows(urls(spark, 0, 50)).select("url_hash", "url", "completed"), urls(spark, 40, 60)))
    state.collect()
    assert "Exchange" not in state._jdf.queryExecution().executedPlan().toString()
    assert rows_of(FR.state_counts(state, P)) == [(60, 40)]


def test_filter_knows_all_and_few_others(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=3)
    c = store.start(state_rows(urls(spark, 0, 20_000)))
    assert c.blocks == -(-20_000 * B.BITS_PER_ROW // B.BLOCK_BITS)
    store.commit(state_rows(urls(spark, 20_000, 20_100)))
    tested = FR.keyed(urls(spark, 0, 60_000).withColumn("i", F.regexp_extract("url", "([0-9]+)$", 1).cast("long")))
    tested = tested.withColumn("block", B.block_of("url_hash", c.blocks)).join(store.filter(), "block", "left")
    hit = {r.known: r.share for r in tested.groupBy((F.col("i") < 20_100).alias("known")).agg(F.avg(B.maybe_seen(F.col("bits")).cast("int")).alias("share")).collect()}
    assert hit[True] == 1.0 and hit[False] < 0.01


def test_readers_see_one_version_through_compaction(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=4)
    store.seed(urls(spark, 0, 30))
    store.complete(urls(spark, 0, 10))
    before = store.latest()
    reading = store.read(before)  # a reader that has started
    want = rows_of(reading)
    # A compaction that died after its rows and before its commit.
    record, store._record = store._record, lambda c: (_ for _ in ()).throw(RuntimeError("died"))
    try:
        store.compact()
    except RuntimeError:
        pass
    store._record = record
    assert store.latest() == before and rows_of(store.read()) == want
    after = store.compact()
    assert after.generation == before.generation + 1 and rows_of(store.read()) == want == rows_of(reading)
    assert store.rows().count() == 30 and store.rows(before).count() == 40
    store.complete(urls(spark, 10, 20))
    assert rows_of(store.read(after)) == want and store.read().where("completed").count() == 20
    store.drop_before(after.generation)
    assert store.read().where("completed").count() == 20
    other = B.BucketedState(spark, tmp_dir + "/state")  # another reader: layout from the commits
    assert rows_of(other.read()) == rows_of(store.read())


def test_rows_of_a_dead_writer_are_never_read(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=2)
    store.seed(urls(spark, 0, 5))
    record, store._record = store._record, lambda c: (_ for _ in ()).throw(RuntimeError("died"))
    try:
        store.complete(urls(spark, 0, 5))
    except RuntimeError:
        pass
    store._record = record
    assert store.read().where("completed").count() == 0
    store.complete(urls(spark, 0, 2))
    assert store.read().where("completed").count() == 2
    assert store.new_urls(urls(spark, 4, 7), P.buckets).count() == 2


def test_an_empty_state(spark, tmp_dir):
    store = B.BucketedState(spark, tmp_dir + "/state", buckets=2)
    store.start(state_rows(urls(spark, 0, 0)))
    assert store.read().count() == 0 and store.new_urls(urls(spark, 0, 3), P.buckets).count() == 3
