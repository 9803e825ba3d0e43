"""Row-count rolling sums that do not put a whole key into one task.

``Window.partitionBy(symbol)`` sends the full history of a symbol to one task; one
hot symbol (a third of all rows) would then be one task.  ``rolling_sums`` instead
partitions by ``(key, time bucket)`` and repairs the first rows of each bucket with
the values that precede it:

1. one Window pass over ``(key, bucket)`` ordered by ``order``: position ``p``, bucket
   size ``n``, in-bucket sums of the last ``w`` rows and of the ``w`` rows before;
2. a tail table: the last ``D = max(widths)`` values of every bucket (bounded lists);
3. per key, ordered by bucket (rows = buckets, not events): the row offset of each
   bucket and the last ``D`` values before it (each non-empty bucket has at least one
   row, so the ``D`` preceding buckets always hold them);
4. join back on ``(key, bucket)`` and add the carried part.

The result is exactly the plain ``rowsBetween`` answer (see the tests) while every
task holds at most one bucket of one key.  Pick ``bucket`` so that the hottest
``(key, bucket)`` stays well inside a task (for minute bars: a day; for ticks: an hour).

Plan shape: the rows are shuffled once by ``(key, bucket)`` - the tail branch reads
the same exchange (``ReusedExchange``), which is why the input is narrowed to
``key, order, value`` first - and the carry table, which grows with keys x buckets,
meets the rows in a sort-merge join that needs no exchange or sort on the row side
(the window already left it hash-partitioned and sorted by ``(key, bucket, ...)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNBOUNDED_PRECEDING = Window.unboundedPreceding
UNBOUNDED_FOLLOWING = Window.unboundedFollowing


_UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def bucket_micros(width: str) -> int:
    n, unit = width.split()
    return int(n) * _UNIT_US[unit.lower().rstrip("s")]


def time_bucket(ts: Column, width: str = "1 day") -> Column:
    """Epoch-aligned bucket number of ``ts`` (bigint)."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bucket_micros(width))).cast("bigint")


def bucket_for(df: DataFrame, key: str, ts: str = "ts", most_rows: int = 1_000_000) -> str:
    """The widest bucket that keeps the hottest (key, bucket) within about ``most_rows`` rows: one partially
    aggregated count per key and day (a day's rows taken as evenly spread); only the largest count comes
    to the driver.  Bucket width changes how the work is split, never the result."""
    day = df.select(key, time_bucket(F.col(ts), "1 day").alias("day"))
    hottest = day.groupBy(key, "day").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for width, per_day in (("1 day", 1), ("1 hour", 24), ("1 minute", 1440)):
        if hottest <= most_rows * per_day:
            return width
    return "1 second"


def _tail_sum(values: Column, n: Column) -> Column:
    """Sum of the last ``n`` elements of ``values`` (0 when n <= 0; all when n > size)."""
    start = F.greatest(F.size(values) - n + 1, F.lit(1))
    part = F.slice(values, start, F.greatest(n, F.lit(0)))
    return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def rolling_sums(df: DataFrame, key: str, order: Sequence[str], value: str,
                 widths: Sequence[int] = (10, 40), bucket: Column | str = "1 day") -> DataFrame:
    """Return ``key, order..., value`` plus ``rn`` (1-based row number within ``key``) and, per width ``w``,
    ``sum_w`` (sum of rows ``rn-w+1 .. rn``) and ``prev_sum_w`` (sum of rows
    ``rn-w .. rn-1``, null on the first row).  Sums over fewer than ``w`` rows are
    partial; callers gate on ``rn``.  ``value`` must be an integral column.  Rows with
    a null key or a null first order column are dropped.
    """
    widths = tuple(sorted(set(int(w) for w in widths)))
    depth = max(widths)
    bcol = time_bucket(F.col(order[0]), bucket) if isinstance(bucket, str) else bucket
    # rows without a key or a time cannot be placed in a sequence; dropping them here
    # (rather than letting the join infer it on one branch only) keeps both branches
    # identical, so the tail branch reuses the row exchange
    base = (df.select(key, *order, value).filter(F.col(key).isNotNull() & F.col(order[0]).isNotNull())
            .withColumn("_b", bcol))

    w = Window.partitionBy(key, "_b").orderBy(*order)
    cols = {
        "_p": F.row_number().over(w),
        "_n": F.count(F.lit(1)).over(w.rowsBetween(UNBOUNDED_PRECEDING, UNBOUNDED_FOLLOWING)),
    }
    for wd in widths:
        cols[f"_s{wd}"] = F.sum(value).over(w.rowsBetween(-(wd - 1), 0))
        cols[f"_q{wd}"] = F.sum(value).over(w.rowsBetween(-wd, -1))
    framed = base.withColumns(cols)

    tails = (framed.filter(F.col("_p") > F.col("_n") - depth)
             .groupBy(key, "_b")
             .agg(F.max("_n").alias("_n"),
                  F.sort_array(F.collect_list(F.struct(F.col("_p"), F.col(value).alias("v")))).alias("_t")))
    wb = Window.partitionBy(key).orderBy("_b")
    carry = tails.select(
        key, "_b",
        F.coalesce(F.sum("_n").over(wb.rowsBetween(UNBOUNDED_PRECEDING, -1)), F.lit(0)).alias("_off"),
        F.collect_list("_t").over(wb.rowsBetween(-depth, -1)).alias("_c"),
    ).select(key, "_b", "_off",
             F.transform(F.flatten("_c"), lambda s: s["v"]).alias("_c"))
    carry = carry.select(key, "_b", "_off",
                         F.slice("_c", F.greatest(F.size("_c") - depth + 1, F.lit(1)), depth).alias("_c"))

    # left join: every (key, bucket) has its carry row; "left" keeps join-inferred
    # filters off the row side so both branches share one exchange.
    out = framed.join(carry.hint("merge"), [key, "_b"], "left")
    p = F.col("_p")
    res = {"rn": (F.col("_off") + p).cast("bigint")}
    for wd in widths:
        res[f"sum_{wd}"] = F.col(f"_s{wd}") + _tail_sum(F.col("_c"), F.lit(wd) - p)
        res[f"prev_sum_{wd}"] = F.when(
            res["rn"] > 1, F.coalesce(F.col(f"_q{wd}"), F.lit(0)) + _tail_sum(F.col("_c"), F.lit(wd + 1) - p))
    internal = ["_b", "_p", "_n", "_off", "_c"] + [f"_s{wd}" for wd in widths] + [f"_q{wd}" for wd in widths]
    return out.withColumns(res).drop(*internal)


def rolling_sums_plain(df: DataFrame, key: str, order: Sequence[str], value: str,
                       widths: Sequence[int] = (10, 40)) -> DataFrame:
    """Same contract as ``rolling_sums`` with one Window per key (reference for tests)."""
    w = Window.partitionBy(key).orderBy(*order)
    cols = {"rn": F.row_number().over(w).cast("bigint")}
    for wd in widths:
        cols[f"sum_{wd}"] = F.sum(value).over(w.rowsBetween(-(wd - 1), 0))
        cols[f"prev_sum_{wd}"] = F.sum(value).over(w.rowsBetween(-wd, -1))
    return df.withColumns(cols)
