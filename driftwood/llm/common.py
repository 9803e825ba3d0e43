"""Shared helpers: Arrow text access, tables staged in the shared folder, span digests."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import delete_path, materialize, settled
from ..sources.tables import read_table

__all__ = ["dropped", "kind_count", "map_batches", "null_as_empty", "pick", "read_table", "release", "row_chunks", "settled", "small_batches", "span_text", "staged", "tuning"]

BATCH_BYTES = 4 << 20


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: other columns of the input
    can then never clash with those that the operator adds."""
    return df.select(*[df[src].alias(name) for name, src in columns.items()])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared ``spark.checkpoint.dir`` and read it back: cuts the lineage,
    and a lost executor costs the tasks after this point only."""
    return materialize(df, name)


def dropped(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, path)


def release() -> None:
    """Give freed memory back: Python workers live on after a task, next to those of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only in glibc
        pass


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB, however long the texts of a table are (a longer row is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Row-local step: ``make`` builds the per-task state once, the result maps Arrow batches."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        try:
            for batch in batches:
                if batch.num_rows:
                    yield step(batch)
        finally:
            step = None
            release()
    return df.mapInArrow(run, schema)


def row_chunks(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes add up to ``most`` at the most; a larger row stands
    alone.  Bounds the temporary arrays of vectorized steps without cutting any text."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def span_text(spans) -> F.Column:
    """``kind:start:end`` of each struct of a span array, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def tuning(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: what the session asks shuffles for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def null_as_empty(col) -> F.Column:
    return F.coalesce(col, F.lit(""))
