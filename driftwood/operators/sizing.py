"""Broadcast behind a size check, and tables staged in the shared folder.

``bounded_broadcast`` materializes a side that is *expected* to be small as a table
in the shared ``spark.checkpoint.dir`` (one job; this also cuts its lineage), adds up
the bytes of its values, and marks it for broadcast only when they are within
``max_bytes``; otherwise the caller's join stays a shuffle join.  Only two scalars
reach the driver, never the data.

``discarding`` deletes what is staged inside it.  What belongs to it is known by context (a thread, or
a copy of its context), so queries that run at the same time never delete each other's tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType

from ..session import work_path

# Fixed sizing policy: a side of up to this many bytes of values may be broadcast.
DEFAULT_MAX_BYTES = 32 << 20
ROW_BYTES = 48  # of a row in a broadcast hash table, besides its values

# Paths staged since the innermost ``discarding`` block of this context began.
_SCOPE: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Delete what this context stages inside the block at its end: for work whose result is written there
    and then, such as a micro-batch."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        paths = _SCOPE.get() or []
        _SCOPE.reset(token)
        for path in paths:
            delete_path(spark, path)


def materialize(df: DataFrame, name: str = "side") -> DataFrame:
    path = work_path(df.sparkSession, name)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str = "result") -> DataFrame:
    """What ``build`` returns, written; all that it staged on the way is deleted."""
    path = work_path(spark, name)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    with discarding(spark):
        df = build()
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _value_bytes(col: Column, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint")
    if isinstance(kind, ArrayType):
        return F.coalesce(F.aggregate(col, F.lit(8).cast("bigint"), lambda a, v: a + _value_bytes(v, kind.elementType)), F.lit(0).cast("bigint"))
    return F.lit(16).cast("bigint")


def table_bytes(df: DataFrame) -> int:
    """Bytes of all values and rows, from one pass with partial sums."""
    width = sum((_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(ROW_BYTES).cast("bigint"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES, name: str = "side") -> tuple[DataFrame, bool]:
    m = materialize(df, name)
    small = table_bytes(m) <= max_bytes
    return (F.broadcast(m) if small else m), small
