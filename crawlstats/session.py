"""Local session for tests, tools and the benchmark.

Jobs never build their own session; this helper exists for local runs only.
On a cluster the session comes from spark-submit with the cluster's settings.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "crawlstats") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Arrow batches sized by bytes as well as rows: HTML bodies are large.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.driver.memory", os.environ.get("CRAWLSTATS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    event_dir = os.environ.get("CRAWLSTATS_EVENT_LOG_DIR")
    if event_dir:
        # Stage and task times for later reading; the web UI stays off.
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
