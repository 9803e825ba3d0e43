"""Corpus pipeline over ``documents``: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and reread as the next stage's documents.  All but the last return the
columns of ``documents``.  A stage works on all that its predecessor kept, and decides from
its own input (the toxicity model is trained on it, duplicates are searched in it).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftwood.llm import decontam, packing, pii, probminhash, toxicity  # noqa: E402
from driftwood.llm.common import read_table, staged  # noqa: E402
from driftwood.session import ship_package  # noqa: E402


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below its threshold."""
    _prepare(spark)
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    _prepare(spark)
    return probminhash.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that mostly are such passages dropped."""
    _prepare(spark)
    return decontam.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"), length_col="n_chars")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    _prepare(spark)
    return pii.mask_pii(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequences."""
    _prepare(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", remove_benchmark),
          ("pii", mask_pii), ("packing", pack)]

# SQL can't express compression distances, ProbMinHash or a tokenizer; tests/llm/test_pipeline.py checks the rows instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are staged in the shared folder for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
