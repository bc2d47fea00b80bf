"""Hot keys: one bucket or one URL holding most rows stays correct and spread."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import frontier as FR
from crawlstats.operators import reports as R
from crawlstats.functions.urls import domain_bucket


def _hot_frontier(spark, n=30000):
    ids = spark.range(n)
    url = (
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("https://hot.example.com/p"), F.col("id")))
        .when(F.col("id") % 6 == 0, F.concat(F.lit("https://b.example.net/q"), F.col("id")))
        .otherwise(F.concat(F.lit("https://c.example.org/r"), F.col("id")))
    )
    return FR.keyed(ids.select(url.alias("url"))).withColumn("bucket", domain_bucket("url", P.buckets))


def test_fetch_list_hot_bucket(spark):
    fr = _hot_frontier(spark)
    got = FR.fetch_list(fr, 0.5).select("url", "bucket", "rn")
    exp = fr.select("url", "bucket", F.row_number().over(Window.partitionBy("bucket").orderBy("url_hash")).cast("long").alias("rn"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    # The hot bucket (2/3 of rows) is ranked in thousands of independent slices.
    slices = fr.where("bucket = 0").select(F.substring("url_hash", 1, 3)).distinct().count()
    assert slices > 3000


def test_hot_url_dedup_and_anti_join(spark):
    hot = spark.range(20000).select(F.lit("https://hot.example.com/x").alias("url"), F.col("id").alias("page_id"))
    rest = spark.range(100).select(F.concat(F.lit("http://hot.example.com/y"), F.col("id")).alias("url"), F.col("id").alias("page_id"))
    twin = spark.createDataFrame([("http://hot.example.com/x", -1)], "url string, page_id long")
    cand = hot.unionByName(rest).unionByName(twin)
    state = FR.seed_state(spark.createDataFrame([("https://hot.example.com/y0",)], "url string"))
    got = FR.new_urls(cand, state, P.buckets, order=("page_id",))
    rows = {r.url for r in got.collect()}
    assert len(rows) == 100  # 99 y-URLs + one x (its http twin came first)
    assert "http://hot.example.com/x" in rows and "https://hot.example.com/x" not in rows


def test_hot_word_counts(spark):
    rows = [(i, f"https://a.example.com/{i}", "<p>" + ("spam " * 2000) + f"w{i}</p>") for i in range(40)]
    resp = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "page_id", "url", "200 as status", "cast(null as string) as error", "html"
    )
    top = R.top_page_words(spark, resp, k=3).collect()
    assert (top[0].token, top[0].n) == ("spam", 80000)
    assert [r.token for r in top[1:]] == ["w0", "w1"]
