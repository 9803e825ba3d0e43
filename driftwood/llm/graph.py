"""Connected components by alternating large and small stars, all in shuffled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) edges in both directions.  Each node's smallest neighbour comes from a
    partially aggregated minimum and is joined back, so a node with many edges isn't one task's group."""
    both = edges.unionAll(edges.selectExpr("v AS u", "u AS v"))
    near = both if large else both.where("v <= u")
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:  # larger neighbours move to the smallest one
        out = near.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours and the node itself do
        out = near.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _done(edges: DataFrame) -> bool:
    """Whether every node of distinct edges (u, v), v < u, has one edge to a smaller node that has none itself, or is such a one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 AND up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it is connected to) for every node of the edges (u, v) that
    isn't itself the smallest.  Each round is staged; rounds grow with the logarithm of the longest path."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _done(now):
        old = now
        now = staged(_stars(_stars(now, True), False), "edges")
        dropped(old)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
