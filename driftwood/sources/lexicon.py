"""Scored lexicon: ``word<TAB>valence`` lines, and the bad-word set.

A TSV line is split at its last tab and nowhere else: no quoting, no trimming, so any word
without a line break survives.  Lines without a tab or with a valence that isn't an integer go to
the reject output.  The test lexicon is derived by Spark from ``benchmark``: its distinct
single-space tokens, ``valence = (length(word) % 11) - 5``; some hold line breaks, which no TSV
line can, so a landed lexicon keeps those without (``plain_words``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import single_space_tokens

# Fixed value: words scoring at or below this valence are "bad".
BAD_THRESHOLD = -4


def lexicon_from_texts(texts: DataFrame, col: str = "text") -> DataFrame:
    words = texts.select(F.explode(single_space_tokens(F.col(col))).alias("word")).distinct()
    return words.select("word", ((F.length("word") % 11) - 5).cast("int").alias("valence"))


def plain_words(lexicon: DataFrame) -> DataFrame:
    """The words that fit in a line of text."""
    return lexicon.filter(~F.col("word").rlike("[\n\r]"))


def land_lexicon_tsv(lexicon: DataFrame, path: str) -> str:
    lexicon.select(F.concat(F.col("word"), F.lit("\t"), F.col("valence").cast("string")).alias("value")).write.mode("overwrite").text(path)
    return path


def _lines(spark: SparkSession, path: str) -> DataFrame:
    cut = F.substring_index("value", "\t", -1)
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.when(F.contains("value", F.lit("\t")), F.left("value", F.length("value") - F.length(cut) - 1)).alias("word"),
        cut.try_cast("int").alias("valence"))


def scan_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Headerless TSV -> ``(word, valence)``."""
    return _lines(spark, path).filter(F.col("word").isNotNull() & F.col("valence").isNotNull()).select("word", "valence")


def lexicon_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``scan_lexicon`` leaves out."""
    return _lines(spark, path).filter(F.col("word").isNull() | F.col("valence").isNull()).select("line")


def bad_words(lexicon: DataFrame, threshold: int = BAD_THRESHOLD) -> DataFrame:
    return lexicon.filter(F.col("valence") <= threshold).select("word").distinct()
