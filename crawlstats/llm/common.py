"""What the training-data operators share: reading columns, Arrow tasks, written steps."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crawlstats.config import shared_dir

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, ``new=old``, so that no other column of the input can clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id long, text string) and the columns to ``keep``: a null text as the empty one."""
    d = pick(df, doc_id=id_col, text=text_col, **{c: c for c in keep})
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *keep)


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo n: the fold that a row belongs to."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application.

    Functions are pickled by reference, so a worker has to import the
    package; ``addPyFile`` brings it where it is not installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


#: Bytes of rows that a Python worker gets at a time, at most (a single longer row comes alone).
BATCH_BYTES = 16 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow``; rows never leave their task.

    Bounds the session's Arrow batches by bytes, since a count of rows does not
    bound the memory that long texts take.
    """
    spark = df.sparkSession
    ship(spark)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_CONF))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")
    return df.mapInArrow(_tidied(fn), schema)


def _tidied(fn: Callable) -> Callable:
    """``fn`` that gives the memory it freed back to the system when its task ends.

    A Python worker lives on for tasks of other operators, and the largest
    batch of one would stay with it otherwise.
    """

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)

    return run


#: Folders that operators made in the shared folder, by application.
_SCRATCH: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder for data that is only needed on the way to a result."""
    path = shared_dir(spark, name)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the scratch folders of this application.

    Only for callers that have written their results: results are lazy and
    read their scratch data until then.
    """
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    The table cuts the lineage and outlives lost executors; all executors
    reach the folder that ``spark.checkpoint.dir`` names.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` splits at exactly these six bytes."""
    return text.split()
