"""From raw documents to packed training sequences, stage by stage.

Each stage gets all that the one before kept, is written as Parquet and read
again. All stages but the last return the columns of ``documents``. A stage
that begins deletes the scratch tables of the one before, whose result has
been written by then.

Defined cases, for every stage: a null text is an empty one, and stays null
where its row stays unchanged; rows with a null id are judged by their text
like others, and stay in the SimHash stage; a repeated id with another text is
a row of its own; of equal rows exact dedup keeps one; very long texts are
read whole; an empty table gives an empty table; further columns, whatever
their names, are carried through but the last stage, which returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.config import shared_dir
from crawlstats.llm import best_fit_packing as packing
from crawlstats.llm import exact_dedup, simhash, substring_dedup
from crawlstats.llm import toxicity as toxic
from crawlstats.llm.common import delete, release, table
from crawlstats.llm.queries import END_TOKEN, SEQUENCE_TOKENS, tokenizer_file


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    release(spark)
    return toxic.non_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    release(spark)
    return exact_dedup.distinct_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest id stays."""
    release(spark)
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur again go; a document that loses all its words stays, empty."""
    release(spark)
    left = substring_dedup.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else left


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in training sequences."""
    release(spark)
    return packing.best_fit_packing(docs, tokenizer_file("byte_bpe_50k.json"), END_TOKEN, SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", sequences),
]

#: SQL cannot express the classifier, the components or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; of their results the last one is kept."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    release(spark)
    return docs
