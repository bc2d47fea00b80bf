"""Exact duplicates by stateful streaming.

Documents are staged in the shared folder as a content store: every row with
its digest and a locator that names the staged row. A stream reads the staged
digests in bounded micro-batches and keeps, per digest, a state without expiry
in the disk-backed state store: the smallest (doc_id, locator) seen, which is
stable identifier and content locator, and the number of rows. Rows that hit
a digest another row holds are then checked byte for byte against the content
their state's locator names. Digests under which contents differ (collisions)
are settled by the full contents.

Rows of a frequent digest are combined before the shuffle that feeds the
state; its byte checks are a join whose large side Spark can split.

Defined cases: a null text is an empty one; equal doc_ids are told apart by
their locators, the smaller stays; null ids sort first, so a row with a null
id stays before others; an empty table gives an empty result; columns with
names used here do not clash, as the input's own columns travel in one struct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.llm.common import SPACE_CLASS, scratch, written

#: Bytes of staged files that one micro-batch reads, at least, and micro-batches of a run, about.
BATCH_BYTES, TRIGGERS = 512 << 20, 100
#: Bytes of staged files for each state store; there are as many as shuffle partitions at most.
STORE_BYTES = 16 << 20
#: Set for the stream only.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Each partition is a store of its own; without this each sets aside 4 MB for its manifest.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_CLASS, " ")


def stage(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], rows: bool) -> DataFrame:
    """The content store: doc_id, content, digest, locator, and with ``rows`` the input's row."""
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input")] if rows else []
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("content"), *own)
    d = d.withColumn("digest", digest(F.col("content"))).withColumn("locator", F.monotonically_increasing_id())
    return written(d, "contents")


def _bytes_of(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def digest_states(staged: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """(digest, keep, n): the state of every digest at the end of the stream.

    Every micro-batch commits every store, so without ``batch_bytes`` their
    number stays about ``TRIGGERS`` however large the input, and a small input
    has few stores.
    """
    spark = staged.sparkSession
    out, checkpoint = scratch(spark, "states"), scratch(spark, "states-checkpoint")
    kind = dict(staged.dtypes)["digest"]
    source = sorted({f.rpartition("/")[0] for f in staged.inputFiles()})
    total = sum(_bytes_of(spark, folder) for folder in source)
    batch_bytes = batch_bytes or max(BATCH_BYTES, total // TRIGGERS)
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, -(-total // STORE_BYTES)))
    conf = STREAM_CONF | {"spark.sql.shuffle.partitions": str(stores)}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for folder in source:  # the one folder that `stage` wrote; none for an empty table without files
            stream = spark.readStream.schema(staged.schema).option("maxBytesPerTrigger", batch_bytes).parquet(folder)
            state = stream.groupBy("digest").agg(
                F.min(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n")
            )
            # A batch that is run again after a failure writes its own folder again.
            (
                state.writeStream.outputMode("update")
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}"))
                .start()
                .awaitTermination()
            )
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    schema = f"digest {kind}, keep struct<doc_id: bigint, locator: bigint>, n bigint"
    if not source:
        return spark.createDataFrame([], schema)
    states = spark.read.schema(schema).parquet(out)
    last = F.max_by(F.struct("keep", "n"), "n")  # counts only grow, so the last state has the largest
    return states.groupBy("digest").agg(last.alias("s")).select("digest", "s.keep", "s.n")


def collisions(staged: DataFrame, states: DataFrame) -> DataFrame:
    """Digests whose rows are not all equal to the row that their state names."""
    held = states.where("n > 1").select("digest", "keep")
    suspects = written(staged.join(held, "digest").select("digest", "content", (F.col("locator") == F.col("keep.locator")).alias("first")), "suspects")
    first = suspects.where("first").select("digest", F.col("content").alias("first_content"))
    hits = suspects.where("not first").select("digest", "content")
    unlike = hits.join(first, (hits["digest"] == first["digest"]) & (hits["content"] != first["first_content"])).select(hits["digest"])
    return written(unlike, "unlike").distinct()  # written first, so that the join may split a frequent digest


def classify(staged: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Every staged row: doc_id, digest, locator, keep_id, group_size, kept."""
    states = written(digest_states(staged, batch_bytes), "digests")
    found = staged.select("doc_id", "digest", "locator").join(states, "digest")
    different = written(collisions(staged, states), "collisions")
    if not different.isEmpty():
        own = staged.join(different, "digest", "left_semi").select("digest", "content", "doc_id", "locator")
        exact = own.groupBy("digest", "content").agg(
            F.min(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n")
        )
        settled = own.join(exact, ["digest", "content"]).select(found.columns)
        found = found.join(different, "digest", "left_anti").select(found.columns).unionByName(settled)
    return found.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"),
        "digest",
        "locator",
    )


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int | None = None,
) -> DataFrame:
    """One row per document: the document that stays for its text, the group's size, whether this row is it.

    Texts are equal when they are identical after each run of white space
    becomes one space. Of equal texts the smallest doc_id stays.
    """
    return classify(stage(docs, id_col, text_col, digest, rows=False), batch_bytes)


def distinct_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int | None = None) -> DataFrame:
    """The input's rows that stay, with all their columns."""
    staged = stage(docs, id_col, text_col, sha256, rows=True)
    gone = classify(staged, batch_bytes).where(~F.col("kept")).select("locator")
    return staged.join(gone, "locator", "left_anti").select("input.*")
