"""Nearest neighbours by inner product with a hash-prefix forest.

Rows are dealt by a hash of their id into blocks of about ``block_rows``; every block holds a
forest: per tree, the sorted array of its rows' long hash strings (signs of random
projections, 32 bits).  A query descends in all trees at once to the longest prefix at which
the trees together hold enough rows (a bisection over prefix lengths, as the number of rows
that share a prefix only grows when it is shortened: the synchronous ascent), takes the rows
that share the prefix in any tree, and ranks them by their exact inner product.  The best of
every block are merged.

Inner products of vectors of different length are searched as angles: a row is scaled by the
largest norm and given one more coordinate that makes it a unit vector.

The stated queries meet all rows in blocks: a task holds one block of rows and at most about
``block_queries`` queries, whatever the table's size; ids decide the blocks, so copies and clusters spread
evenly.  Only counts, the largest norm and the dimensions come to the driver.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows with a null id; vectors of different dimension aren't compared; rows that
share an id are one item with the best score; ties go to the smaller id; no rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

TREES, BITS, SEED = 128, 32, 20
#: Rows that the trees must hold together at the prefix (a row counts once for each tree): a share of the block's
#: rows, and so many for each neighbour wanted, as the last ones wanted of a small block are far away.
ENOUGH, EACH = 0.6, 40
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048


def projections(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim + 1, TREES * BITS)).astype(np.float32)


def hash_strings(unit: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(trees, rows) hash strings as unsigned numbers, first bit highest."""
    out = np.empty((TREES, len(unit)), dtype=np.uint64)
    for start in range(0, len(unit), 1024):  # bounds the table of signs
        signs = (unit[start:start + 1024] @ planes > 0).reshape(-1, TREES, BITS)
        packed = np.packbits(signs, axis=2).astype(np.uint64)
        out[:, start:start + 1024] = sum(packed[:, :, i] << np.uint64(8 * (BITS // 8 - 1 - i)) for i in range(BITS // 8)).T
    return out


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, vectors: np.ndarray, largest: float, planes: np.ndarray):
        scaled = vectors / largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled ** 2).sum(axis=1)))
        self.vectors, self.scaled, self.planes = vectors, scaled.astype(np.float32), planes
        codes = hash_strings(np.c_[scaled, rest].astype(np.float32), planes)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def ranges(self, codes: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows lie that share the first ``level`` bits, per tree and query."""
        shift = (BITS - level).astype(np.uint64)
        low, high = np.empty(codes.shape, dtype=np.int64), np.empty(codes.shape, dtype=np.int64)
        for t in range(TREES):
            prefix = codes[t] >> shift
            low[t] = np.searchsorted(self.sorted[t], prefix << shift)
            high[t] = np.searchsorted(self.sorted[t], (prefix + np.uint64(1)) << shift)
        return low, high

    def candidates(self, queries: np.ndarray, k: int):
        """Row numbers for each query (unit vectors), in turn."""
        codes = hash_strings(np.c_[queries, np.zeros(len(queries))].astype(np.float32), self.planes)
        enough = ENOUGH * len(self.vectors) + EACH * k + TREES  # the query itself is found by every tree
        short, long = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), BITS + 1)
        while (long - short > 1).any():
            level = (short + long) // 2
            low, high = self.ranges(codes, level)
            held = (high - low).sum(axis=0) >= enough
            short, long = np.where(held, level, short), np.where(held, long, level)
        low, high = self.ranges(codes, short)
        order, mark = self.order, np.zeros(len(self.vectors), dtype=bool)
        for i in range(len(queries)):
            mark[:] = short[i] == 0
            if short[i]:
                for rows, a, b in zip(order, low[:, i].tolist(), high[:, i].tolist()):
                    mark[rows[a:b]] = True
            yield np.flatnonzero(mark)

    def nearest(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query, row id, exact inner product) of the best ``k`` items of each query."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        for i, rows in enumerate(self.candidates(unit, k)):
            rows = rows[ids[rows] != query_ids[i]]
            close = self.scaled[rows] @ unit[i].astype(np.float32)
            if len(rows) > 2 * k:  # single precision, with room for its error, before the exact measure
                rows = rows[close >= np.partition(close, -2 * k)[-2 * k] - 1e-4]
            score = (self.vectors[rows] * queries[i]).sum(axis=1)
            best = np.lexsort((ids[rows], -score))
            _, first = np.unique(ids[rows][best], return_index=True)
            for j in best[np.sort(first)[:k]]:
                yield query_ids[i], ids[rows[j]], score[j]


def usable(vector) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("v").combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def nearest_neighbors(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
                      block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best items found for each row of ``queries``, its own id left out."""
    def vectors(df):
        return pick(df, id=id_col, v=vector_col).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v")).where(
            F.col("id").isNotNull() & usable(F.col("v")))
    items, asked = vectors(rows), vectors(queries)
    # Norms with the largest component taken out: squares of large components would overflow.
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    norm = top * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / top) * (x / top)))
    size = items.agg(F.count("*").alias("n"), F.max(norm).alias("norm")).first()
    n_blocks = max(1, math.ceil((size["n"] or 0) / block_rows))
    n_parts = max(1, math.ceil(asked.count() / block_queries))
    largest = size["norm"] or 1.0

    def numbers(n):
        return F.sequence(F.lit(0), F.lit(n - 1))
    left = items.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"), F.explode(numbers(n_parts)).alias("part"), "id", "v")
    right = asked.select(F.size("v").alias("dim"), F.explode(numbers(n_blocks)).alias("block"), F.pmod(F.xxhash64("id"), F.lit(n_parts)).cast("int").alias("part"), "id", "v")
    key = ["dim", "block", "part"]

    def search(items: pa.Table, asked: pa.Table) -> pa.Table:
        out = ([], [], [])
        if items.num_rows and asked.num_rows:
            x = matrix(items)
            forest = Forest(x, largest, projections(x.shape[1]))
            for found in forest.nearest(items.column("id").to_numpy(), asked.column("id").to_numpy(), matrix(asked), k):
                for col, value in zip(out, found):
                    col.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
