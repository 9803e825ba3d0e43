"""Event-time operators as micro-batch jobs with their state in tables.

Spark drops rows behind the watermark before a keyed-state function sees them, and keeps a key's state in one
task.  Here the stream's state is a table a micro-batch (in the shared folder, under the batch's number), and each
micro-batch is a batch plan over state and new rows:

* the *high-water mark* is the greatest event time of all earlier micro-batches; a row is late if it is
  ``delay`` or more behind it when it arrives.  Late rows go to an output of their own;
* rows up to the new mark less the delay are final; they are taken in order, the others wait in the state;
* the crossover rule runs over the last rows of each symbol (state) and the final ones with the operator
  of the batch side, which splits a symbol into time buckets, so a hot symbol is spread over its buckets.

Every output belongs to its micro-batch (``batch_id=<n>``, overwritten), and a batch's state is read from the one
before, so a batch that is run again writes the same.  State older than the one before is deleted.

Results for odd rows: rows without a time, symbol or price (``sources.quotes.usable``) are late never and final
never: they go to the late output with the reason; rows that repeat are rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import moving_average as ma
from ..operators.rolling import bucket_micros
from ..operators.sizing import delete_path, discarding, materialize
from ..sources.quotes import unusable, usable

COLUMNS = ("symbol", "ts", "event_id", "units")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _state_path(root: str, batch_id: int) -> str:
    return f"{root}/state-{batch_id:09d}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _mark_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The high-water mark that the batches before left (none: no row with a time so far)."""
    path = f"{_state_path(root, batch_id - 1)}/mark"
    return spark.read.schema("mark bigint").parquet(path).first()[0] if batch_id and _exists(spark, path) else None


def _leave_mark(spark: SparkSession, root: str, batch_id: int, mark: int | None) -> None:
    spark.range(1).select(F.lit(mark).cast("bigint").alias("mark")).coalesce(1).write.mode("overwrite").parquet(f"{_state_path(root, batch_id)}/mark")
    if batch_id >= 2 and _exists(spark, _state_path(root, batch_id - 2)):
        delete_path(spark, _state_path(root, batch_id - 2))


def split_late(batch: DataFrame, mark: int | None, delay: str) -> tuple[DataFrame, DataFrame]:
    """(rows in time, the others with ``reject``) of a micro-batch against the high-water mark (microseconds)."""
    odd = unusable(batch)
    good = usable(batch)
    if mark is None:
        return good, odd
    behind = micros(F.col("ts")) <= F.lit(mark - bucket_micros(delay))
    return good.filter(~behind), good.filter(behind).withColumn("reject", F.lit("late")).unionByName(odd)


def late_split_writer(on_time: str, late: str, state: str, delay: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: rows in time and the others to an output each; on time plus late is the input."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            mark = _mark_before(spark, state, batch_id)
            good, odd = split_late(batch, mark, delay)
            good.write.mode("overwrite").parquet(f"{on_time}/batch_id={batch_id}")
            odd.write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
            newest = good.agg(F.max(micros(F.col("ts")))).first()[0]
            _leave_mark(spark, state, batch_id, max([x for x in (mark, newest) if x is not None], default=None))
        finally:
            batch.unpersist()
    return write


def crossover_writer(out: str, late: str, state: str, delay: str = "1 hour", fast: int = ma.FAST, slow: int = ma.SLOW,
                     bucket: str = "1 day") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of crossover signals (columns of ``crossover_signals``) and late rows.

    After a micro-batch all rows up to the high-water mark less ``delay`` have been judged, in (ts, event_id) order; the
    state holds the last ``slow`` + 1 rows of each symbol and the rows that wait."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kind = batch.schema["symbol"].dataType.simpleString()
        schema = f"symbol {kind}, ts {batch.schema['ts'].dataType.simpleString()}, event_id bigint, units bigint"
        before = _state_path(state, batch_id - 1)
        known = batch_id > 0 and _exists(spark, f"{before}/tail")
        empty = spark.createDataFrame([], schema)
        tail, waiting = ((spark.read.schema(schema).parquet(f"{before}/{x}") for x in ("tail", "waiting")) if known else (empty, empty))
        batch.persist()
        try:
            with discarding(spark):
                mark = _mark_before(spark, state, batch_id)
                good, odd = split_late(batch, mark, delay)
                odd.write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
                newest = good.agg(F.max(micros(F.col("ts")))).first()[0]
                now = max([x for x in (mark, newest) if x is not None], default=None)
                here = _state_path(state, batch_id)
                edge = F.lit(None if now is None else now - bucket_micros(delay)).cast("bigint")
                final = F.coalesce(micros(F.col("ts")) <= edge, F.lit(False))
                rows = materialize(waiting.unionByName(good.select(*COLUMNS)), "batch-rows")
                rows.filter(~final).write.mode("overwrite").parquet(f"{here}/waiting")
                judged = materialize(tail.unionByName(rows.filter(final)), "batch-final")
                # Rows in the tail are behind all new ones: a signal is new if it is later than the mark that finished them.
                signals = ma.crossover_signals(judged, fast, slow, bucket)
                if mark is not None:
                    signals = signals.filter(micros(F.col("ts")) > F.lit(mark - bucket_micros(delay)))
                signals.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
                # The last rows of each symbol: the rank filter is applied before the shuffle, too.
                last = Window.partitionBy("symbol").orderBy(F.col("ts").desc(), F.col("event_id").desc())
                (judged.withColumn("_k", F.row_number().over(last)).filter(F.col("_k") <= slow + 1).drop("_k")
                 .write.mode("overwrite").parquet(f"{here}/tail"))
                _leave_mark(spark, state, batch_id, now)
        finally:
            batch.unpersist()
    return write
