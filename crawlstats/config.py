"""Job parameters and session helpers.

No global SparkSession: every job takes the session or DataFrames it works
on. ``shared_dir`` returns the folder the cluster names in
``spark.checkpoint.dir`` (shared storage reachable from every executor); a
local folder is only created on a local master that leaves it unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CrawlParams:
    """Scope, buckets and limits of one crawl.

    domains   allow-list for the domain rule; an entry may carry a path
              prefix (``host/path``), which is matched literally.
    anchor    label that marks the registrable domain when naming subdomains.
    buckets   ordered substring tests giving the politeness bucket of a URL;
              the first that matches wins, so list longer hosts first.
    """

    domains: tuple[str, ...] = ("example.com", "example.net")
    anchor: str = "example"
    buckets: tuple[str, ...] = ("example.com", "example.net", "example.org")
    size_limit: int = 1_000_000
    max_url_length: int = 250
    delay: float = 0.5
    # Broadcast a data-sized side only when it has at most this many rows:
    # a URL row with its hash is ~170 bytes, so 200k rows stay near 35 MB.
    broadcast_max_rows: int = 200_000
    # Broadcasts are bounded by bytes as well as by rows.
    broadcast_max_bytes: int = 64 << 20
    # (name, predicate) pairs that reject URLs after the built-in rules.
    extra_rules: tuple = field(default=())
    # Match the allow-list against the host alone instead of the whole URL.
    host_only: bool = False


# Parameters used by the registered queries and tests (FIXTURES.md §2).
TEST_PARAMS = CrawlParams(size_limit=6000)

_LOCAL_ROOT: dict[str, str] = {}
#: Folders that jobs made for themselves, by application.
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    The setting names storage that every executor reaches. Only a local
    master (one machine, as in tests) may leave it unset: a temporary folder
    is then made once per application. Any other master raises.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOT.get(sc.applicationId)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL_ROOT[sc.applicationId] = tempfile.mkdtemp(prefix="crawlstats-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    if name is None:
        return root
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    _MADE.setdefault(sc.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete every folder that ``shared_dir`` made for this application.

    Only for callers that have written their results elsewhere: results are
    lazy and read these folders until then. Roots that a caller names (a
    crawl, a state, a stream's output) are never among them.
    """
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the root folder."""
    return shared_dir(spark)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for results that are read more than once."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reaches it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
