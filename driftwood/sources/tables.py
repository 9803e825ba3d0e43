"""Reading the driver tables and mapping ``events`` to quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import PRICE_TYPE, units


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition an under-split input on ``key``.

    A scan yields one task per file split (per parquet row group), so a small file or
    a single row group leaves every core but one idle during the row-local work that
    precedes the first shuffle (splitting texts, tokenizing, hashing).  Such an input
    is repartitioned on ``key`` (deterministic on retry; an explicit count, so AQE
    does not coalesce it away).  A scan with at least as many splits as the cluster
    has cores - the normal case at scale - is returned as is: no extra exchange.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, spread over the cores by ``doc_id`` when the scan is under-split."""
    return spread(read_table(spark, sf_dir, "documents"), "doc_id")


def quotes_from_events(events: DataFrame, symbol: str = "user_id") -> DataFrame:
    """events -> quotes ``(event_id, ts, symbol, price, units)``.

    ``symbol`` picks the key column (``user_id``: many symbols; ``event_type``: five).
    ``price`` is exact ``decimal(18,6)``; ``units`` (millionths) is the bigint used for arithmetic.
    ``ts`` stays ``timestamp_ntz`` (wall-clock, no zone) in batch plans.
    """
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col(symbol).alias("symbol"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        units(F.col("value")).alias("units"),
    )


def read_quotes(spark: SparkSession, sf_dir: str, symbol: str = "user_id") -> DataFrame:
    return quotes_from_events(read_table(spark, sf_dir, "events"), symbol)
