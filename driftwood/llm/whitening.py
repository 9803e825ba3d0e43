"""Whitening of embeddings with the leading eigenvectors of their covariance.

1. Entries become integers, ``floor(scale * c) + offset``; their sums per dimension are exact: each task adds
   up its vectors, Spark adds up the tasks' sums.
2. The covariance's products are taken after centring: (n * x - S) is exact and is divided by n once.  Each
   task has one matrix (a row for each dimension goes to the shuffle), added up there.
3. The driver gets that matrix alone, d * (d + 1) / 2 numbers for d dimensions whatever the number of vectors, and
   finds its leading eigenvalues and eigenvectors (``eigen``).
4. The d * k projection travels with the tasks and is applied row-locally.  The covariance of
   the result is measured over all vectors in the same way as in 2.

Nothing of the vectors is shuffled; each pass reads the table again rather than writing a copy.  The fit is made
before the result is returned, so a task that is run again projects with the same components.

Defined results: vectors that are null or hold null, NaN or infinite entries, or an entry whose integer doesn't fit
62 bits, take no part; empty vectors have no components and so no rows; vectors of each dimension are whitened by
themselves; rows that share an id, and rows with a null id, are rows like any other; a component without
variance (at most 1e-13 of the total) is projected to 0 and left out of ``identity_error``; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, release, small_batches
from .eigen import leading_eigenpairs

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0 ** 62
NO_VARIANCE = 1e-13  # share of the total


@dataclass
class Whitener:
    """What is fitted to the vectors of one dimension."""
    n: int
    sums: list[int]
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float
    identity_error: float = 0.0

    @property
    def projection(self) -> np.ndarray:
        live = self.values > NO_VARIANCE * self.trace
        return self.vectors * np.where(live, 1.0 / np.sqrt(np.where(live, self.values, 1.0)), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: 64-bit integers where they fit, Python's otherwise."""
        sums = np.array(self.sums, dtype=object)
        if self.n * int(np.max(np.abs(x), initial=0)) + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def differences(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (self.centred(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int]:
        y = self.centred(x)
        if y.dtype != object and y.shape[1] * int(np.max(np.abs(y), initial=0)) ** 2 >= 1 << 62:
            y = y.astype(object)
        return (y * y).sum(axis=1).tolist()


def integer_vectors(column: pa.Array, scale: int, offset: int):
    """(rows, x) for each dimension in a batch: the places of its usable vectors and their integer entries."""
    lists = column.cast(pa.list_(pa.float64())) if column.type.value_type != pa.float64() else column
    flat = lists.flatten()
    sizes = np.diff(np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))))
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        entries = np.floor(entries * scale)
        good = np.abs(entries) < LARGEST - abs(offset)  # false for NaN
    start = np.concatenate(([0], np.cumsum(sizes)))
    bad_before = np.concatenate(([0], np.cumsum(~good)))
    usable = (bad_before[start[1:]] == bad_before[start[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[usable & (sizes > 0)]).tolist():
        rows = np.flatnonzero(usable & (sizes == dim))
        yield dim, rows, entries[start[rows][:, None] + np.arange(dim)].astype(np.int64) + offset


def gather(vectors: DataFrame, scale: int, offset: int, begin, add, rows_of, schema: str) -> DataFrame:
    """Each task adds up its vectors, by dimension: ``begin(dim)`` makes a sum, ``add(dim, sum, x)`` returns the new one,
    ``rows_of(dim, sum)`` yields its rows for the shuffle."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        sums: dict = {}
        for batch in batches:
            if batch.num_rows:
                for dim, _, x in integer_vectors(batch.column("vector"), scale, offset):
                    sums[dim] = add(dim, sums.get(dim) or begin(dim), x)
        for dim, total in sums.items():
            rows = list(rows_of(dim, total))
            types = {"dim": pa.int32(), "i": pa.int32(), "n": pa.int64(), "total": pa.decimal128(38, 0), "row": pa.list_(pa.float64())}
            yield pa.RecordBatch.from_arrays([pa.array(col, types[name]) for name, col in zip(names, zip(*rows))], names)
        release()
    small_batches(vectors.sparkSession)
    return vectors.mapInArrow(run, schema)


def exact_sums(vectors: DataFrame, scale: int, offset: int) -> dict[int, tuple[int, list[int]]]:
    """dimension -> (number of vectors, exact sums of their integers)."""
    def add(dim, total, x):
        n, sums = total
        safe = int(np.max(np.abs(x), initial=0)) * max(len(x), 1) < 1 << 62
        more = x.sum(axis=0) if safe else x.astype(object).sum(axis=0)
        return n + len(x), [a + int(b) for a, b in zip(sums, more)]
    rows = gather(vectors, scale, offset, lambda dim: (0, [0] * dim), add,
                  lambda dim, total: ((dim, i, total[0], Decimal(s)) for i, s in enumerate(total[1])), "dim int, i int, n bigint, total decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim", "i").collect():  # a row for each dimension
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["total"]))
    return out


def product_sums(vectors: DataFrame, scale: int, offset: int, features: dict) -> dict[int, np.ndarray]:
    """dimension -> sum over all vectors of z z', z being ``features[dim](x)``.  The upper half only is sent."""
    def add(dim, total, x):
        z = features[dim](x)
        return [total[0] + z.T @ z]

    def halves(dim, total):
        return ((dim, i, total[0][i, i:]) for i in range(len(total[0])))
    rows = gather(vectors, scale, offset, lambda dim: [0.0], add, halves, "dim int, i int, row array<double>")
    cells = rows.select("dim", "i", F.posexplode("row").alias("k", "v")).groupBy("dim", "i", "k").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    got = cells.toPandas()  # d * (d + 1) / 2 numbers a dimension
    for dim, part in got.groupby("dim"):
        size = int(part["i"].max()) + 1
        m = np.zeros((size, size))
        i, j = part["i"].to_numpy(), (part["i"] + part["k"]).to_numpy()
        m[i, j] = m[j, i] = part["v"].to_numpy()
        out[int(dim)] = m
    return out


def fit_whitening(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> dict[int, Whitener]:
    """One ``Whitener`` for each dimension that the usable vectors have."""
    src = pick(vectors, vector=vector_col)
    models: dict[int, Whitener] = {}
    for dim, (n, sums) in exact_sums(src, scale, offset).items():
        models[dim] = Whitener(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    if not models:
        return models
    for dim, products in product_sums(src, scale, offset, {dim: m.differences for dim, m in models.items()}).items():
        m = models[dim]
        covariance = products / m.n
        m.trace = float(np.trace(covariance))
        values, m.vectors = leading_eigenpairs(covariance, components)
        m.values = np.maximum(values, 0.0)  # a covariance has none below zero but for rounding
    for dim, products in product_sums(src, scale, offset, {dim: (lambda x, m=m: m.differences(x) @ m.projection) for dim, m in models.items()}).items():
        m = models[dim]
        live = m.values > NO_VARIANCE * m.trace
        off = np.abs(products / m.n - np.eye(len(m.values)))[np.ix_(live, live)]
        m.identity_error = float(np.max(off, initial=0.0))
    return models


def whiten(vectors: DataFrame, models: dict[int, Whitener], id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row for each usable vector: ``vec_id, dim, n, deviation`` (sum of (n * x - S)^2, exact) and arrays ``whitened`` and
    ``explained`` with an entry for each component, and ``identity_error``."""
    src = pick(vectors, vec_id=id_col, vector=vector_col)
    kind = src.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", "dim", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for dim, rows, x in integer_vectors(batch.column("vector"), scale, offset):
                if dim not in models:
                    continue
                m = models[dim]
                white = m.differences(x) @ m.projection
                share = (m.values / m.trace if m.trace else np.zeros(len(m.values))).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array([dim] * len(rows), pa.int32()), pa.array([m.n] * len(rows), pa.int64()),
                     pa.array([Decimal(v) for v in m.deviations(x)], pa.decimal128(38, 0)), pa.array(list(white), pa.list_(pa.float64())),
                     pa.array([share] * len(rows), pa.list_(pa.float64())), pa.array([m.identity_error] * len(rows), pa.float64())], names)
        release()
    small_batches(src.sparkSession)
    return src.mapInArrow(run, f"vec_id {kind}, dim int, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")


def component_rows(rows: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each component of ``whiten`` rows.
    A deviation beyond 64 bits is null here (``whiten`` has it exactly)."""
    each = rows.select("vec_id", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "identity_error",
                       F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "z"))
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation", F.col("z.whitened").alias("whitened"),
                       F.col("z.explained").alias("explained"), "identity_error")
