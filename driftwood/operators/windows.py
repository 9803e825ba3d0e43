"""Event-time tumbling windows over quotes.

Windows are epoch-aligned (``F.window``).  Means come from exact ``(sum of units, n)``
pairs, so a coarse window's mean can be rebuilt from its fine windows without
touching the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MAX_UNITS, UNITS, wide
from ..sources.quotes import usable


def _seconds(width: str) -> int:
    n, unit = width.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * mult[unit.rstrip("s")]


def mean_of(sum_units: Column, n: Column) -> Column:
    """Mean price from a units sum and a count (one IEEE division)."""
    return sum_units.cast("double") / (n * UNITS).cast("double")


def usable_by(quotes: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Quotes that count for a mean: with a price, a time and (if it is a key) a symbol."""
    return usable(quotes) if "symbol" in keys else quotes.filter(F.col("ts").isNotNull() & F.col("units").between(-MAX_UNITS, MAX_UNITS))


def window_sums(quotes: DataFrame, width: str, keys: Sequence[str] = ("symbol",),
                ts: str = "ts") -> DataFrame:
    """``(keys..., window_start, window_end, sum_units, n)`` per tumbling window (partial+final agg)."""
    w = F.window(ts, width)
    return (usable_by(quotes, keys).groupBy(*keys, w.alias("w"))
            .agg(F.sum(wide(F.col("units"))).alias("sum_units"), F.count(F.lit(1)).alias("n"))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "sum_units", "n"))


def tumbling_avg(quotes: DataFrame, width: str, keys: Sequence[str] = ("symbol",),
                 name: str = "avg_price") -> DataFrame:
    s = window_sums(quotes, width, keys)
    return s.select(*keys, "window_start", "window_end", mean_of(F.col("sum_units"), F.col("n")).alias(name), "n")


def _check_nesting(fine: str, coarse: str) -> None:
    if _seconds(coarse) % _seconds(fine):
        raise ValueError(f"{coarse} windows are not unions of {fine} windows")


def window_ma_join(quotes: DataFrame, fine: str = "10 minutes", coarse: str = "40 minutes",
                   fine_name: str = "ma10m", coarse_name: str = "ma40m") -> DataFrame:
    """Each fine window's mean next to the mean of the coarse window that contains it.

    (Joining the two window columns for equality never matches when the lengths
    differ; containment is the usable reading.)  One pass over the rows: the fine
    ``(sum, n)`` table is aggregated once, and the coarse mean is a window sum over
    the fine rows of the same ``(symbol, coarse window)`` - no second scan, no join.
    """
    _check_nesting(fine, coarse)
    f = window_sums(quotes, fine)
    c = F.window("window_start", coarse)
    f = f.withColumns({"coarse_start": c.start, "coarse_end": c.end})
    wc = Window.partitionBy("symbol", "coarse_start")
    return f.select(
        "symbol", "window_start", "window_end", mean_of(F.col("sum_units"), F.col("n")).alias(fine_name),
        "coarse_start", "coarse_end",
        mean_of(F.sum("sum_units").over(wc), F.sum("n").over(wc)).alias(coarse_name))


def window_ma_outer(quotes: DataFrame, fine: str = "10 days", coarse: str = "40 days",
                    fine_name: str = "ma10d", coarse_name: str = "ma40d",
                    fine_filter: Column | None = None, coarse_filter: Column | None = None) -> DataFrame:
    """Full outer join of two window aggregates on ``(symbol, containing coarse window)``.

    Optional filters (e.g. a minimum count per window) may drop windows on one side;
    unmatched windows then keep nulls on the other side.  Both sides are aggregates
    whose size is bounded by (symbols x windows), so this join never sees raw rows.
    """
    _check_nesting(fine, coarse)
    f = window_sums(quotes, fine)
    if fine_filter is not None:
        f = f.filter(fine_filter)
    c = window_sums(quotes, coarse)
    if coarse_filter is not None:
        c = c.filter(coarse_filter)
    f = f.select("symbol", "window_start", "window_end",
                 mean_of(F.col("sum_units"), F.col("n")).alias(fine_name),
                 F.window("window_start", coarse).start.alias("coarse_start"))
    c = c.select("symbol", F.col("window_start").alias("coarse_start"), F.col("window_end").alias("coarse_end"),
                 mean_of(F.col("sum_units"), F.col("n")).alias(coarse_name))
    return f.join(c, ["symbol", "coarse_start"], "full").select(
        "symbol", "window_start", "window_end", fine_name, "coarse_start", "coarse_end", coarse_name)
