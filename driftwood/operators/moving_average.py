"""Moving averages over quotes and the golden/death-cross detector.

Quotes are ``(event_id, ts, symbol, price, units)``; order within a symbol is
``(ts, event_id)`` (the id breaks timestamp ties deterministically).
Rows without a symbol, a time or a price take no part (``sources.quotes.usable``).  Means are
compared exactly on integer sums of units: ``ma_f > ma_s  <=>  sum_f * s > sum_s * f``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import UNITS, fits_long, price_of, shares_for_budget, signal_message
from ..sources.quotes import usable
from .rolling import rolling_sums

ORDER = ("ts", "event_id")
# Fixed values of the detector: 10-row and 40-row means.
FAST, SLOW = 10, 40


def _mean(sum_col: Column, width: int) -> Column:
    """Mean price in currency units from a sum of units (one IEEE division)."""
    return sum_col.cast("double") / F.lit(float(width * UNITS))


def with_moving_averages(quotes: DataFrame, fast: int = FAST, slow: int = SLOW,
                         bucket: str = "1 day") -> DataFrame:
    """``symbol, ts, event_id, units, price`` plus ``rn, sum_f, sum_s, prev_sum_f, prev_sum_s``
    and ``ma_f``/``ma_s`` (null before warm-up).  ``price`` is re-derived exactly from units."""
    r = rolling_sums(usable(quotes), "symbol", ORDER, "units", (fast, slow), bucket)
    return r.withColumns({
        "price": price_of(F.col("units")),
        f"ma{fast}": F.when(F.col("rn") >= fast, _mean(F.col(f"sum_{fast}"), fast)),
        f"ma{slow}": F.when(F.col("rn") >= slow, _mean(F.col(f"sum_{slow}"), slow)),
    })


def rolling_ma(quotes: DataFrame, width: int = FAST, bucket: str = "1 day") -> DataFrame:
    """Rows whose ``width``-row buffer is full: ``(symbol, ts, event_id, ma{width})``."""
    r = rolling_sums(usable(quotes), "symbol", ORDER, "units", (width,), bucket)
    return (r.filter(F.col("rn") >= width)
            .select("symbol", "ts", "event_id", _mean(F.col(f"sum_{width}"), width).alias(f"ma{width}")))


def rolling_ma_pair(quotes: DataFrame, fast: int = FAST, slow: int = SLOW, bucket: str = "1 day") -> DataFrame:
    """Every row with both means (null before each warm-up)."""
    return with_moving_averages(quotes, fast, slow, bucket).select(
        "symbol", "ts", "event_id", "price", f"ma{fast}", f"ma{slow}")


def _cmp(df_fast: Column, df_slow: Column, fast: int, slow: int):
    """(fast mean > slow mean, fast mean < slow mean) on exact sums."""
    if not fits_long(fast * slow):
        df_fast, df_slow = df_fast.cast("decimal(28,0)"), df_slow.cast("decimal(28,0)")
    lhs, rhs = df_fast * slow, df_slow * fast
    return lhs > rhs, lhs < rhs


def level_signal(quotes: DataFrame, fast: int = FAST, slow: int = SLOW, bucket: str = "1 day") -> DataFrame:
    """1 when the fast mean is above the slow one, -1 below, 0 when equal or not yet defined."""
    m = with_moving_averages(quotes, fast, slow, bucket)
    gt, lt = _cmp(F.col(f"sum_{fast}"), F.col(f"sum_{slow}"), fast, slow)
    ready = F.col("rn") >= slow
    sig = F.when(ready & gt, 1).when(ready & lt, -1).otherwise(0)
    return m.select("symbol", "ts", "event_id", f"ma{fast}", f"ma{slow}", sig.cast("int").alias("signal"))


def crossover_signals(quotes: DataFrame, fast: int = FAST, slow: int = SLOW, bucket: str = "1 day") -> DataFrame:
    """Golden cross (buy) / death cross (sell) rows.

    buy  at row i: ma_f(i) > ma_s(i) and ma_f(i-1) <= ma_s(i-1)
    sell at row i: ma_f(i) < ma_s(i) and ma_f(i-1) >= ma_s(i-1)
    Both means must exist at i-1, so the first candidate is row ``slow + 1``.
    """
    m = with_moving_averages(quotes, fast, slow, bucket)
    gt, lt = _cmp(F.col(f"sum_{fast}"), F.col(f"sum_{slow}"), fast, slow)
    pgt, plt = _cmp(F.col(f"prev_sum_{fast}"), F.col(f"prev_sum_{slow}"), fast, slow)
    ready = F.col("rn") >= slow + 1
    side = F.when(ready & gt & ~pgt, F.lit("buy")).when(ready & lt & ~plt, F.lit("sell"))
    return (m.withColumn("side", side).filter(F.col("side").isNotNull())
            .select("symbol", "ts", "event_id", "side", "price",
                    shares_for_budget(F.col("units")).alias("shares"),
                    F.col(f"ma{fast}"), F.col(f"ma{slow}"), "units"))


def crossover_messages(signals: DataFrame) -> DataFrame:
    """``(ts side SYMBOL) - n shares at $p.pp`` for each signal row."""
    return signals.select("symbol", "ts", "event_id",
                          signal_message(F.col("ts"), F.col("side"), F.col("symbol"),
                                         F.col("shares"), F.col("units")).alias("message"))


def batch_local_ma(quotes: DataFrame, batch: Column | str, arrival: str = "event_id",
                   width: int = FAST) -> DataFrame:
    """Per micro-batch rolling mean: the buffer starts empty in every batch and follows
    arrival order per symbol; a row is emitted once its buffer holds ``width`` prices.
    Partitions are ``(batch, symbol)``, bounded by the batch size.
    """
    b = F.col(batch) if isinstance(batch, str) else batch
    d = usable(quotes).withColumn("batch_id", b)
    w = Window.partitionBy("batch_id", "symbol").orderBy(arrival)
    full = F.count("units").over(w.rowsBetween(-(width - 1), 0)) == width
    s = F.sum("units").over(w.rowsBetween(-(width - 1), 0))
    return (d.withColumns({"_full": full, "_s": s}).filter("_full")
            .select("batch_id", "symbol", "ts", "event_id", _mean(F.col("_s"), width).alias(f"ma{width}")))
