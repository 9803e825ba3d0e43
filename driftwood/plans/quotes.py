"""Phase 1: quote lines, rolling means and the crossover detector (symbol = user_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import moving_average as ma
from ..operators.rolling import bucket_for
from ..session import work_path
from ..sources import quotes as qs
from ..sources.tables import read_quotes, read_table, quotes_from_events
from .registry import register

# Shared DuckDB fragments -------------------------------------------------------------
Q_USER = """q AS (SELECT event_id, ts, user_id AS symbol, CAST(value AS DECIMAL(18,6)) AS price,
                 CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""
Q_TYPE = """q AS (SELECT event_id, ts, event_type AS symbol, CAST(value AS DECIMAL(18,6)) AS price,
                 CAST(round(value * 100) AS BIGINT) AS cents FROM events)"""
ROLL = """r AS (SELECT *, row_number() OVER w AS rn,
       sum(cents) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s10,
       sum(cents) OVER (w ROWS BETWEEN 39 PRECEDING AND CURRENT ROW) AS s40,
       sum(cents) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS p10,
       sum(cents) OVER (w ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS p40
  FROM q WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id))"""
CROSSED = """s AS (SELECT *, CASE WHEN rn >= 41 AND 4*s10 > s40 AND NOT (4*p10 > p40) THEN 'buy'
                     WHEN rn >= 41 AND 4*s10 < s40 AND NOT (4*p10 < p40) THEN 'sell' END AS side FROM r)"""
SIGNALS = f"WITH {Q_USER}, {ROLL}, {CROSSED}"
PYTS = """CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END"""


def _q(spark, sf_dir, symbol="user_id"):
    return read_quotes(spark, sf_dir, symbol)


@register("quote_render", """
SELECT concat_ws(' ', strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type,
                 CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)) AS value FROM events""")
def quote_render(spark, sf_dir):
    return qs.render_lines4(_q(spark, sf_dir, "event_type"))


@register("quote_parse4", """
SELECT CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts, event_type AS symbol,
       CAST(value AS DECIMAL(18,6)) AS price FROM events""")
def quote_parse4(spark, sf_dir):
    lines = qs.render_lines4(_q(spark, sf_dir, "event_type"))
    return qs.parse_lines4(lines).filter("ok").select("ts", "symbol", "price")


@register("quote_parse3", """
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ts, event_type AS symbol,
       CAST(value AS DECIMAL(18,6)) AS price FROM events""")
def quote_parse3(spark, sf_dir):
    lines = qs.render_lines3(_q(spark, sf_dir, "event_type"))
    return qs.parse_lines3(lines).filter("ok").select("ts", "symbol", "price")


@register("quote_rejects", """
WITH p AS (
  SELECT event_id % 7 AS k, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS t, event_type AS s,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v FROM events),
l AS (
  SELECT k, CASE k WHEN 0 THEN concat_ws(' ', d, s, v) WHEN 1 THEN concat_ws(' ', d, t, s, v, 'x') WHEN 2 THEN concat_ws(' ', d, 'noon', s, v)
                   WHEN 3 THEN concat_ws(' ', d, t, '', v) WHEN 4 THEN concat_ws(' ', d, t, s, 'n/a')
                   WHEN 5 THEN concat_ws(' ', d, t, s, v || '0000001') ELSE concat_ws(' ', d, t, s, v) END AS line FROM p)
SELECT line, CASE WHEN k <= 1 THEN 'field_count' WHEN k = 2 THEN 'bad_timestamp' WHEN k = 3 THEN 'bad_symbol'
                  WHEN k = 4 THEN 'bad_price' ELSE 'bad_scale' END AS reject FROM l WHERE k < 6""")
def quote_rejects(spark, sf_dir):
    """Quote lines damaged in six ways (and left whole in a seventh): every reason to reject a line, none fails."""
    token = F.split(qs.line4(), " ")
    d, t, s, v = (F.get(token, F.lit(i)) for i in range(4))
    damaged = [F.concat_ws(" ", d, s, v), F.concat_ws(" ", d, t, s, v, F.lit("x")), F.concat_ws(" ", d, F.lit("noon"), s, v),
               F.concat_ws(" ", d, t, F.lit(""), v), F.concat_ws(" ", d, t, s, F.lit("n/a")),
               F.concat_ws(" ", d, t, s, F.concat(v, F.lit("0000001"))), qs.line4()]
    lines = _q(spark, sf_dir, "event_type").select(F.element_at(F.array(*damaged), (F.col("event_id") % 7 + 1).cast("int")).alias("value"))
    path = work_path(spark, "damaged-lines")
    lines.write.mode("overwrite").text(path)
    return qs.rejected(qs.parse_lines4(spark.read.text(path)))


@register("symbol_filter", """
SELECT event_id, ts, event_type AS symbol, CAST(value AS DECIMAL(18,6)) AS price
FROM events WHERE event_type IN ('purchase', 'view')""")
def symbol_filter(spark, sf_dir):
    q = _q(spark, sf_dir, "event_type")
    return q.filter(F.col("symbol").isin("purchase", "view")).select("event_id", "ts", "symbol", "price")


@register("rolling_ma10", f"""
WITH {Q_USER}, {ROLL}
SELECT symbol, ts, event_id, CAST(s10 AS DOUBLE) / CAST(1000 AS DOUBLE) AS ma10 FROM r WHERE rn >= 10""")
def rolling_ma10(spark, sf_dir):
    return ma.rolling_ma(_q(spark, sf_dir), 10)


@register("rolling_ma10_40", f"""
WITH {Q_USER}, {ROLL}
SELECT symbol, ts, event_id, price,
       CASE WHEN rn >= 10 THEN CAST(s10 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS ma10,
       CASE WHEN rn >= 40 THEN CAST(s40 AS DOUBLE) / CAST(4000 AS DOUBLE) END AS ma40 FROM r""")
def rolling_ma10_40(spark, sf_dir):
    return ma.rolling_ma_pair(_q(spark, sf_dir))


@register("ma_level_signal", f"""
WITH {Q_USER}, {ROLL}
SELECT symbol, ts, event_id,
       CASE WHEN rn >= 10 THEN CAST(s10 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS ma10,
       CASE WHEN rn >= 40 THEN CAST(s40 AS DOUBLE) / CAST(4000 AS DOUBLE) END AS ma40,
       CAST(CASE WHEN rn >= 40 AND 4*s10 > s40 THEN 1 WHEN rn >= 40 AND 4*s10 < s40 THEN -1 ELSE 0 END AS INTEGER)
         AS signal FROM r""")
def ma_level_signal(spark, sf_dir):
    return ma.level_signal(_q(spark, sf_dir))


CROSSOVER_SQL = f"""
{SIGNALS}
SELECT symbol, ts, event_id, side, price, CAST(10000000 // cents AS BIGINT) AS shares,
       CAST(s10 AS DOUBLE) / CAST(1000 AS DOUBLE) AS ma10, CAST(s40 AS DOUBLE) / CAST(4000 AS DOUBLE) AS ma40
FROM s WHERE side IS NOT NULL"""


@register("crossover_signals", CROSSOVER_SQL)
def crossover_signals(spark, sf_dir):
    return ma.crossover_signals(_q(spark, sf_dir)).drop("units")


@register("crossover_messages", f"""
{SIGNALS}
SELECT symbol, ts, event_id,
       printf('(%s %s %s) - %d shares at $%s', {PYTS}, side, CAST(symbol AS VARCHAR),
              10000000 // cents, CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR)) AS message
FROM s WHERE side IS NOT NULL""")
def crossover_messages(spark, sf_dir):
    return ma.crossover_messages(ma.crossover_signals(_q(spark, sf_dir)))


@register("crossover_by_type", f"""
WITH {Q_TYPE}, {ROLL},
s AS (SELECT *, CASE WHEN rn >= 41 AND 4*s10 > s40 AND NOT (4*p10 > p40) THEN 'buy'
                     WHEN rn >= 41 AND 4*s10 < s40 AND NOT (4*p10 < p40) THEN 'sell' END AS side FROM r)
SELECT symbol, ts, event_id, side, price, CAST(10000000 // cents AS BIGINT) AS shares
FROM s WHERE side IS NOT NULL""")
def crossover_by_type(spark, sf_dir):
    """The detector with five dense symbols (event_type): long histories per key,
    the case the bucketed windows exist for."""
    q = _q(spark, sf_dir, "event_type")
    return ma.crossover_signals(q, bucket=bucket_for(q, "symbol")).select(
        "symbol", "ts", "event_id", "side", "price", "shares")


@register("batch_local_ma10", f"""
WITH {Q_TYPE}, b AS (SELECT *, event_id // 250 AS batch_id FROM q),
r AS (SELECT *, count(cents) OVER w AS n, sum(cents) OVER w AS s FROM b
      WINDOW w AS (PARTITION BY batch_id, symbol ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT batch_id, symbol, ts, event_id, CAST(s AS DOUBLE) / CAST(1000 AS DOUBLE) AS ma10 FROM r WHERE n = 10""")
def batch_local_ma10(spark, sf_dir):
    """Micro-batches of 250 arrivals (event_id order); the buffer restarts per batch."""
    q = _q(spark, sf_dir, "event_type")
    return ma.batch_local_ma(q, F.floor(F.col("event_id") / 250).cast("bigint"))
