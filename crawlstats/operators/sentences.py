"""Sentence ends (G3): which words keep their final period, learned from the corpus.

A period after a word ends a sentence or belongs to an abbreviation. An
abbreviation nearly always has its period, is short, and may have periods
inside; so each word is scored by the log-likelihood ratio of "its period is
part of it" (it follows with probability 0.99) against "periods follow words
as often as anywhere", scaled by its length, its inner periods and how often
it stands without (T. Kiss and J. Strunk, Unsupervised Multilingual Sentence
Boundary Detection, Computational Linguistics 32(4), 2006, section 3).

Everything is an aggregate over distinct pieces of text with their counts
(``reports.piece_counts``): one pass over the corpus, whose shuffle holds
each distinct piece of a task once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstats.functions.text import TOKEN_START, clean_token

# --- fixed values of the published method ------------------------------------
#: Probability of the period after an abbreviation.
WITH_PERIOD = 0.99
#: Score from which a word is an abbreviation.
THRESHOLD = 0.3
# -----------------------------------------------------------------------------
#: One period, the last character, after something else.
FINAL_PERIOD = r"[^.]\.$"


def _log_likelihood(both: Column, alone: Column, p: Column) -> Column:
    """-2 log of the likelihood of the counts at the corpus rate ``p`` over that at ``WITH_PERIOD``."""
    corpus = both * F.log(p) + alone * F.log(1 - p)
    abbreviation = both * F.log(F.lit(WITH_PERIOD)) + alone * F.log(F.lit(1 - WITH_PERIOD))
    return -2 * (corpus - abbreviation)


def period_statistics(pieces: DataFrame) -> DataFrame:
    """(word, n_with, n_without, score): words that occur with a final period, from (raw, n).

    ``word`` is lower-cased and without its period. Only words with a letter
    are candidates.
    """
    words = pieces.where(F.col("raw").rlike(TOKEN_START))
    ends = F.col("raw").rlike(FINAL_PERIOD)
    bare = F.lower(F.when(ends, F.substring("raw", F.lit(1), F.length("raw") - 1)).otherwise(F.col("raw")))
    counts = (
        words.select(bare.alias("word"), ends.alias("ends"), "n")
        .groupBy("word")
        .agg(F.sum(F.when(F.col("ends"), F.col("n")).otherwise(0)).alias("n_with"), F.sum(F.when(F.col("ends"), 0).otherwise(F.col("n"))).alias("n_without"))
    )
    rate = counts.select(F.sum("n_with") / F.sum(F.col("n_with") + F.col("n_without"))).scalar()
    candidates = counts.where((F.col("n_with") > 0) & F.col("word").rlike("[a-z]"))
    # Where every word has a period the rate says nothing; keep it below one.
    p = F.least(rate, F.lit(1 - 1e-9))
    length = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - length
    score = (
        _log_likelihood(F.col("n_with"), F.col("n_without"), p)
        * F.exp(-length)
        * (inner + 1)
        * F.pow(length.cast("double"), -F.col("n_without"))
    )
    return candidates.select("word", "n_with", "n_without", score.alias("score"))


def abbreviations(pieces: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(word): the words whose final period is part of them."""
    return period_statistics(pieces).where(F.col("score") >= threshold).select("word")


def sentence_words(pieces: DataFrame, known: DataFrame) -> DataFrame:
    """A4 with sentence ends: (token, n); an abbreviation of ``known`` (word) keeps its period.

    The join is over distinct pieces that end in a period; Spark broadcasts
    the abbreviations where their size allows. All others would have the same
    null key in it, and where it shuffles one task would sort them all.
    """
    ends = F.col("raw").rlike(FINAL_PERIOD)
    word = F.lower(F.substring("raw", F.lit(1), F.length("raw") - 1))
    keyed = pieces.where(ends).withColumn("word", word).join(known.select("word", F.lit(True).alias("kept")), "word", "left")
    token = F.when(F.col("kept"), F.lower("raw")).otherwise(clean_token("raw"))
    plain = pieces.where(~ends).select(clean_token("raw").alias("token"), "n")
    both = keyed.select(token.alias("token"), "n").unionByName(plain)
    return both.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("n").alias("n"))
