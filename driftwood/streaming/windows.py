"""Windowed means on a quote stream.

* ``tumbling_avg_stream``: one windowed aggregate, complete mode (every trigger
  re-emits all windows; the watermark then evicts nothing).
* ``window_ma_stream``: fine and coarse means in one pass and append mode: fine
  ``(sum, n)`` per window, then the coarse window re-aggregates those partials
  (``window_time`` of the fine window), keeping the <= coarse/fine fine rows in a
  bounded list, and the list is exploded back.  One source, two state stores, no
  stream-stream join.  Only windows closed by the watermark are emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import wide
from ..operators.windows import _check_nesting, mean_of, usable_by


def with_event_time(quotes: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``); the session zone is UTC."""
    return quotes.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def tumbling_avg_stream(quotes: DataFrame, width: str = "10 days", delay: str = "1 day",
                        keys=(), name: str = "ma10d") -> DataFrame:
    q = with_event_time(usable_by(quotes, keys), delay)
    agg = q.groupBy(*keys, F.window("ts", width).alias("w")).agg(
        F.sum(wide(F.col("units"))).alias("sum_units"), F.count(F.lit(1)).alias("n"))
    return agg.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      mean_of(F.col("sum_units"), F.col("n")).alias(name), "n")


def window_ma_stream(quotes: DataFrame, fine: str = "10 minutes", coarse: str = "40 minutes",
                     delay: str = "10 minutes", fine_name: str = "ma10m", coarse_name: str = "ma40m") -> DataFrame:
    _check_nesting(fine, coarse)
    q = with_event_time(usable_by(quotes), delay)
    f = q.groupBy("symbol", F.window("ts", fine).alias("fw")).agg(
        F.sum(wide(F.col("units"))).alias("s"), F.count(F.lit(1)).alias("n"))
    c = f.groupBy("symbol", F.window(F.window_time("fw"), coarse).alias("cw")).agg(
        F.collect_list(F.struct(F.col("fw.start").alias("fs"), F.col("fw.end").alias("fe"), "s", "n")).alias("parts"),
        F.sum("s").alias("cs"), F.sum("n").alias("cn"))
    x = c.select("symbol", "cw", "cs", "cn", F.explode("parts").alias("p"))
    return x.select("symbol", F.col("p.fs").alias("window_start"), F.col("p.fe").alias("window_end"),
                    mean_of(F.col("p.s"), F.col("p.n")).alias(fine_name),
                    F.col("cw.start").alias("coarse_start"), F.col("cw.end").alias("coarse_end"),
                    mean_of(F.col("cs"), F.col("cn")).alias(coarse_name))


def window_ma_outer_stream(fine_quotes: DataFrame, coarse_quotes: DataFrame, fine: str = "10 minutes", coarse: str = "40 minutes", delay: str = "10 minutes",
                           fine_name: str = "ma10m", coarse_name: str = "ma40m", fine_filter: Column | None = None,
                           coarse_filter: Column | None = None) -> DataFrame:
    """Two streams of quotes, each with its own windows, joined full outer on (symbol, containing coarse window).

    The sides may be different feeds, or one that is read twice.  Both sides are aggregates that a watermark closes (append
    mode), so the join's state holds closed windows only, until the watermark has passed their coarse window; then a window without
    a partner is emitted with nulls.  Filters (on ``sum_units``, ``n``) leave windows out of their side."""
    _check_nesting(fine, coarse)

    def side(quotes: DataFrame, width: str, keep: Column | None) -> DataFrame:
        out = with_event_time(usable_by(quotes), delay).groupBy("symbol", F.window("ts", width).alias("w")).agg(
            F.sum(wide(F.col("units"))).alias("sum_units"), F.count(F.lit(1)).alias("n"))
        return out if keep is None else out.filter(keep)
    f = side(fine_quotes, fine, fine_filter).select(
        F.col("symbol").alias("f_symbol"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        mean_of(F.col("sum_units"), F.col("n")).alias(fine_name), F.window(F.window_time("w"), coarse).alias("f_coarse"))
    c = side(coarse_quotes, coarse, coarse_filter).select(
        F.col("symbol").alias("c_symbol"), F.col("w").alias("c_coarse"), mean_of(F.col("sum_units"), F.col("n")).alias(coarse_name))
    j = f.join(c, (F.col("f_symbol") == F.col("c_symbol")) & (F.col("f_coarse") == F.col("c_coarse")), "full_outer")
    return j.select(F.coalesce("f_symbol", "c_symbol").alias("symbol"), "window_start", "window_end", fine_name,
                    F.coalesce("f_coarse.start", "c_coarse.start").alias("coarse_start"), F.col("c_coarse.end").alias("coarse_end"), coarse_name)
