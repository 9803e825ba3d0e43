"""Streaming crossover detector: keyed state per group of symbols, event-time ordered.

Contract: a row is *final* once the watermark has passed it (Spark drops input older
than the watermark before it reaches the state function, so nothing can arrive
before a final row any more).  Final rows are taken in ``(ts, event_id)`` order and
pushed through the same rule as the batch detector; rows not yet final wait in the
group's state, and an event-time timeout wakes the group when the watermark passes
them.  Hence, for every row the watermark has passed, the stream emits exactly the
batch answer, whatever the arrival order within the watermark delay.

Symbols are dealt to ``groups`` by their hash, and a group's symbols are worked on together: a
call of the state function costs milliseconds however few rows it gets, so its calls follow the groups and
micro-batches, not the symbols.  ``groups`` grows with the cluster (``groups_for``); a checkpoint holds for one number of them.

State per symbol is bounded: ``rn`` (rows finalized), the last ``slow`` prices in
units, and the not-yet-final rows (at most the rows of one watermark delay and of one micro-batch).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.money import BUDGET_UNITS, UNITS, fits_long, price_of
from ..operators.moving_average import FAST, SLOW
from ..session import ship_package
from ..sources.quotes import usable

GROUPS = 256  # groups of symbols at least
GROUPS_PER_CORE = 32


def groups_for(spark: SparkSession) -> int:
    return max(GROUPS, GROUPS_PER_CORE * spark.sparkContext.defaultParallelism)


def _state_schema(symbol_type: str) -> str:
    """A group's symbols, each symbol's ``rn``, their last prices one after the other (min(rn, slow) each), and the rows
    that aren't final (place of the symbol, ts_us, event_id, units); numbers as 64-bit integers."""
    return f"symbols array<{symbol_type}>, rn binary, tails binary, pending binary"


def _output_schema(symbol_type: str) -> str:
    return (f"symbol {symbol_type}, ts_us long, event_id long, side string, units long, shares long, "
            "ma_fast double, ma_slow double")


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... in each of consecutive runs of these lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def detector(fast: int = FAST, slow: int = SLOW, budget_units: int = BUDGET_UNITS):
    """The state function of a group of symbols for ``applyInPandasWithState``.

    Vectorized per call: every symbol's carried tail and newly final rows form one run of a units
    array, and every rolling sum is a difference of its prefix sums, so a group's
    micro-batch costs a few numpy passes, not a Python loop per symbol or row.
    """
    cols = ["ts_us", "event_id", "units"]

    def step(key, pdfs, state):
        if state.exists:
            symbols, rn, tails, pending = state.get
            rn, tails, pending = (np.frombuffer(x, dtype=np.int64) for x in (rn, tails, pending))
        else:
            symbols, rn, tails, pending = [], *[np.zeros(0, dtype=np.int64)] * 3
        pdfs, place = list(pdfs), {s: i for i, s in enumerate(symbols)}
        parts = [pending.reshape(-1, 4)]
        for pdf in pdfs:
            codes, found = pd.factorize(pdf["symbol"])
            at = np.array([place.setdefault(s, len(place)) for s in found.tolist()], dtype=np.int64)
            parts.append(np.column_stack([at[codes], *[pdf[c].to_numpy(dtype=np.int64) for c in cols]]))
        symbols = list(place)
        rn = np.concatenate([rn, np.zeros(len(symbols) - len(rn), dtype=np.int64)])
        rows = np.concatenate(parts)
        wm_ms = state.getCurrentWatermarkMs()
        final = rows[:, 1] <= wm_ms * 1000
        ready, rest = rows[final], rows[~final]
        ready = ready[np.lexsort((ready[:, 2], ready[:, 1], ready[:, 0]))]  # (ts, event_id) order in each symbol

        # A run of vals for each symbol: its tail, then its ready rows.
        had, new = np.minimum(rn, slow), np.bincount(ready[:, 0], minlength=len(symbols))
        size = had + new
        start = np.cumsum(size) - size
        vals = np.empty(size.sum(), dtype=np.int64)
        vals[np.repeat(start, had) + _within(had)] = tails
        nth = _within(new)
        t = np.repeat(start + had, new) + nth  # positions of the ready rows in vals
        vals[t] = ready[:, 3]
        # Products stay in 64 bits, or are Python's integers; prefix sums may wrap, as their differences are right all the same.
        sums = vals if fits_long(fast * slow) else vals.astype(object)
        cs = np.concatenate([np.zeros(1, dtype=sums.dtype), np.cumsum(sums)])
        begin = np.repeat(start, new)

        def window(end, width):  # sum of vals[end - width : end] (fewer at the start)
            return cs[end] - cs[np.maximum(end - width, begin)]

        cur_f, cur_s = window(t + 1, fast), window(t + 1, slow)
        prev_f, prev_s = window(t, fast), window(t, slow)
        warm = np.repeat(rn, new) + 1 + nth >= slow + 1
        gt, lt = (cur_f * slow > cur_s * fast).astype(bool), (cur_f * slow < cur_s * fast).astype(bool)
        pgt, plt = (prev_f * slow > prev_s * fast).astype(bool), (prev_f * slow < prev_s * fast).astype(bool)
        buy, sell = warm & gt & ~pgt, warm & lt & ~plt

        kept = np.minimum(size, slow)
        tails = vals[np.repeat(start + size - kept, kept) + _within(kept)]
        state.update((symbols, (rn + new).tobytes(), tails.tobytes(), rest.tobytes()))
        if len(rest):
            wake = -(-int(rest[:, 1].min()) // 1000) - 1
            state.setTimeoutTimestamp(max(wake, wm_ms))
        hit = np.flatnonzero(buy | sell)
        if len(hit):
            c = ready[hit, 3]
            if (c > 0).all():
                shares = budget_units // c
            else:  # no whole number of shares for a non-positive price
                shares = pd.array(np.where(c > 0, budget_units // np.maximum(c, 1), 0), dtype="Int64")
                shares[c <= 0] = pd.NA
            yield pd.DataFrame({
                "symbol": [symbols[i] for i in ready[hit, 0]], "ts_us": ready[hit, 1], "event_id": ready[hit, 2],
                "side": np.where(buy[hit], "buy", "sell"), "units": c, "shares": shares,
                "ma_fast": cur_f[hit].astype(float) / float(fast * UNITS), "ma_slow": cur_s[hit].astype(float) / float(slow * UNITS)})
    return step


def crossover_stream(quotes: DataFrame, delay: str = "1 hour", fast: int = FAST, slow: int = SLOW,
                     symbol_type: str = "bigint", groups: int | None = None) -> DataFrame:
    """Streaming twin of ``operators.moving_average.crossover_signals``."""
    ship_package(quotes.sparkSession)
    q = (usable(quotes).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
         .select("symbol", "ts", F.unix_micros("ts").alias("ts_us"), "event_id", "units")
         .withColumn("bucket", F.pmod(F.xxhash64("symbol"), F.lit(groups or groups_for(quotes.sparkSession)))))
    out = q.groupBy("bucket").applyInPandasWithState(
        detector(fast, slow), _output_schema(symbol_type), _state_schema(symbol_type), "append",
        GroupStateTimeout.EventTimeTimeout)
    return out


def finish(signals: DataFrame, fast: int = FAST, slow: int = SLOW) -> DataFrame:
    """Typed output rows, same columns as the batch detector."""
    return signals.select(
        "symbol", F.timestamp_micros("ts_us").cast("timestamp_ntz").alias("ts"), "event_id", "side",
        price_of(F.col("units")).alias("price"), "shares",
        F.col("ma_fast").alias(f"ma{fast}"), F.col("ma_slow").alias(f"ma{slow}"))
