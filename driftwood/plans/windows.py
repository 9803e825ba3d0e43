"""Phase 2: tumbling windows and window-to-window means (symbol = event_type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as win
from ..sources.tables import read_quotes
from .registry import register

Q = """q AS (SELECT event_id, ts, event_type AS symbol, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""


def _bucket(width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01')"


def _agg_sql(width: str, where: str = "") -> str:
    return f"""SELECT symbol, {_bucket(width)} AS window_start, {_bucket(width)} + INTERVAL '{width}' AS window_end,
       sum(cents) AS sum_cents, count(*) AS n FROM q {where} GROUP BY ALL"""


def _mean(s: str, n: str) -> str:
    return f"CAST({s} AS DOUBLE) / CAST({n} * 100 AS DOUBLE)"


@register("tumbling_avg_10d", f"""
WITH {Q}, a AS ({_agg_sql('10 days', "WHERE symbol = 'purchase'")})
SELECT window_start, window_end, {_mean('sum_cents', 'n')} AS ma10d, n FROM a""")
def tumbling_avg_10d(spark, sf_dir):
    """One symbol, 10-day tumbling mean (no symbol key, as in the single-symbol job)."""
    q = read_quotes(spark, sf_dir, "event_type").filter(F.col("symbol") == "purchase")
    return win.tumbling_avg(q, "10 days", keys=(), name="ma10d")


@register("tumbling_avg_10m", f"""
WITH {Q}, a AS ({_agg_sql('10 minutes')})
SELECT symbol, window_start, window_end, {_mean('sum_cents', 'n')} AS ma10m, n FROM a""")
def tumbling_avg_10m(spark, sf_dir):
    return win.tumbling_avg(read_quotes(spark, sf_dir, "event_type"), "10 minutes", name="ma10m")


@register("tumbling_avg_40m", f"""
WITH {Q}, a AS ({_agg_sql('40 minutes')})
SELECT symbol, window_start, window_end, {_mean('sum_cents', 'n')} AS ma40m, n FROM a""")
def tumbling_avg_40m(spark, sf_dir):
    return win.tumbling_avg(read_quotes(spark, sf_dir, "event_type"), "40 minutes", name="ma40m")


WINDOW_JOIN_SQL = f"""
WITH {Q}, f AS ({_agg_sql('10 minutes')}),
g AS (SELECT *, {_bucket('40 minutes').replace('ts,', 'window_start,')} AS coarse_start FROM f)
SELECT symbol, window_start, window_end, {_mean('sum_cents', 'n')} AS ma10m,
       coarse_start, coarse_start + INTERVAL '40 minutes' AS coarse_end,
       {_mean('sum(sum_cents) OVER (PARTITION BY symbol, coarse_start)', 'sum(n) OVER (PARTITION BY symbol, coarse_start)')}
         AS ma40m
FROM g"""


@register("window_ma_join", WINDOW_JOIN_SQL)
def window_ma_join(spark, sf_dir):
    return win.window_ma_join(read_quotes(spark, sf_dir, "event_type"), "10 minutes", "40 minutes")


@register("window_ma_outer", f"""
WITH {Q}, f AS (SELECT * FROM ({_agg_sql('10 days')}) WHERE n % 3 > 0), c AS (SELECT * FROM ({_agg_sql('40 days')}) WHERE n % 2 = 0)
SELECT coalesce(f.symbol, c.symbol) AS symbol, f.window_start, f.window_end,
       {_mean('f.sum_cents', 'f.n')} AS ma10d, coalesce(c.window_start, f.cs) AS coarse_start,
       c.window_end AS coarse_end, {_mean('c.sum_cents', 'c.n')} AS ma40d
FROM (SELECT *, time_bucket(INTERVAL '40 days', window_start, TIMESTAMP '1970-01-01') AS cs FROM f) f
FULL OUTER JOIN c ON f.symbol = c.symbol AND f.cs = c.window_start""")
def window_ma_outer(spark, sf_dir):
    """Windows whose count passes a filter of their side, so that either side has windows without a partner."""
    return win.window_ma_outer(read_quotes(spark, sf_dir, "event_type"), "10 days", "40 days", fine_filter=F.col("n") % 3 > 0,
                               coarse_filter=F.col("n") % 2 == 0)
