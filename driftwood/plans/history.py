"""Phase 3: backfill planning/assembly, union, latest quotes, CSV/JSON landing and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_path
from ..sources import history as hist
from ..sources import quotes as qs
from ..sources.tables import read_quotes
from .registry import register

# The test tables span one month, so the registered plans use a one-week step; the
# operators default to the reference's one-year step.
STEP, OVERLAP = "7 days", "30 minutes"

Q = """q AS (SELECT event_id, ts, event_type AS symbol, CAST(value AS DECIMAL(18,6)) AS price FROM events)"""
CHUNKS = f"""b AS (SELECT date_trunc('day', min(ts)) AS s, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS e FROM events),
c AS (SELECT CAST(row_number() OVER (ORDER BY fs) - 1 AS BIGINT) AS chunk_no, fs AS fetch_start,
             least(fs + INTERVAL '{STEP}' + INTERVAL '{OVERLAP}', e) AS fetch_end
      FROM b, range(s, e, INTERVAL '{STEP}') t(fs))"""


def _hist(spark, sf_dir):
    return read_quotes(spark, sf_dir, "event_type").select("event_id", "ts", "symbol", "price")


@register("backfill_chunks", f"WITH {CHUNKS} SELECT * FROM c")
def backfill_chunks(spark, sf_dir):
    return hist.backfill_chunks(_hist(spark, sf_dir), STEP, OVERLAP)


@register("backfill_overlap", f"""
WITH {Q}, {CHUNKS}
SELECT c.chunk_no, q.event_id, q.ts, q.symbol, q.price FROM q JOIN c ON q.ts >= c.fetch_start AND q.ts <= c.fetch_end""")
def backfill_overlap(spark, sf_dir):
    return hist.backfill_overlap(_hist(spark, sf_dir), STEP, OVERLAP)


@register("backfill_dedup", f"WITH {Q} SELECT event_id, ts, symbol, price FROM q")
def backfill_dedup(spark, sf_dir):
    return hist.dedup_overlap(hist.backfill_overlap(_hist(spark, sf_dir), STEP, OVERLAP))


@register("union_sorted", f"""
WITH {Q} SELECT event_id, ts, symbol, price FROM q""")
def union_sorted(spark, sf_dir):
    """The histories of two groups of symbols (by a hash, a missing symbol included) in one sorted table."""
    h = _hist(spark, sf_dir)
    group = F.pmod(F.xxhash64("symbol"), F.lit(2))
    return hist.union_sorted(*[h.filter(group == g) for g in (0, 1)])


@register("latest_per_symbol", f"""
WITH {Q} SELECT symbol, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
                arg_max(price, (ts, event_id)) AS price FROM q GROUP BY symbol""")
def latest_per_symbol(spark, sf_dir):
    return hist.latest_per_symbol(_hist(spark, sf_dir))


@register("latest_snapshot", f"""
WITH {Q} SELECT concat_ws(',', symbol, CAST(CAST(arg_max(price, (ts, event_id)) AS DECIMAL(18,2)) AS VARCHAR)) AS value
FROM q GROUP BY symbol""")
def latest_snapshot(spark, sf_dir):
    path = hist.write_snapshot(hist.latest_per_symbol(_hist(spark, sf_dir)), work_path(spark, "snapshot"))
    return spark.read.text(path)


@register("quote_csv_scan", """
SELECT CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS datetime, event_type AS stock,
       CAST(value AS DECIMAL(18,6)) AS close FROM events""")
def quote_csv_scan(spark, sf_dir):
    path = qs.land_quote_csv(_hist(spark, sf_dir), work_path(spark, "quotes-csv"))
    return qs.scan_quote_csv(spark, path)


@register("quote_json_latest", f"""
WITH {Q} SELECT symbol, max(ts) AS ts, arg_max(price, (ts, event_id)) AS close,
                concat_ws(',', symbol, CAST(CAST(arg_max(price, (ts, event_id)) AS DECIMAL(18,2)) AS VARCHAR)) AS line
FROM q GROUP BY symbol""")
def quote_json_latest(spark, sf_dir):
    path = qs.land_quote_json(_hist(spark, sf_dir), work_path(spark, "quotes-json"))
    return qs.latest_from_json(spark, path)


@register("history_lines", f"""
WITH {Q} SELECT concat_ws(' ', CAST(CAST(ts AS DATE) AS VARCHAR), symbol, CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR)) AS value FROM q""")
def history_lines(spark, sf_dir):
    return qs.render_lines3(_hist(spark, sf_dir))


GIVEN = ("2024-01-03 06:00:00", "2024-01-24 18:00:00")  # a plan from given times, not from the data
GIVEN_CHUNKS = f"""c AS (SELECT i AS chunk_no, TIMESTAMP '{GIVEN[0]}' + i * INTERVAL '7 days' AS fetch_start,
  least(TIMESTAMP '{GIVEN[0]}' + (i + 1) * INTERVAL '7 days' + INTERVAL '30 minutes', TIMESTAMP '{GIVEN[1]}') AS fetch_end
  FROM range(4) t(i) WHERE TIMESTAMP '{GIVEN[0]}' + i * INTERVAL '7 days' < TIMESTAMP '{GIVEN[1]}')"""


@register("backfill_range", f"""
WITH {Q}, {GIVEN_CHUNKS}
SELECT c.chunk_no, q.event_id, q.ts, q.symbol, q.price FROM q JOIN c ON q.ts >= c.fetch_start AND q.ts <= c.fetch_end""")
def backfill_range(spark, sf_dir):
    """The assembled backfill of given start and end times."""
    return hist.backfill_overlap(_hist(spark, sf_dir), STEP, OVERLAP, start=GIVEN[0], end=GIVEN[1])


@register("backfill_report", f"""
WITH {Q}, {GIVEN_CHUNKS}, r AS (
  SELECT c.chunk_no, count(*) AS n FROM q JOIN c ON q.ts >= c.fetch_start AND q.ts <= c.fetch_end WHERE c.chunk_no <> 1 GROUP BY 1)
SELECT chunk_no, fetch_start, fetch_end, coalesce(n, 0) AS n_rows, n IS NULL AS missing FROM c LEFT JOIN r USING (chunk_no)""")
def backfill_report(spark, sf_dir):
    """A plan of which chunk 1 was never fetched: rows per chunk, and which one is missing."""
    h = _hist(spark, sf_dir)
    plan = hist.backfill_chunks(h, STEP, OVERLAP, start=GIVEN[0], end=GIVEN[1])
    fetched = hist.backfill_overlap(h, STEP, OVERLAP, start=GIVEN[0], end=GIVEN[1]).filter("chunk_no <> 1")
    return hist.chunk_report(plan, fetched)


@register("backfill_tagged", f"""
WITH {Q} SELECT CAST(0 AS BIGINT) AS chunk_no, event_id, ts, symbol, price FROM q WHERE symbol = 'purchase'
UNION ALL SELECT CAST(1 AS BIGINT), event_id, ts, symbol, price FROM q WHERE symbol = 'view'
UNION ALL SELECT CAST(2 AS BIGINT), event_id, ts, symbol, price FROM q WHERE symbol = 'click'""")
def backfill_tagged(spark, sf_dir):
    """Inputs that carry no symbol of their own, one for each of three fetches, tagged as they are assembled."""
    h = _hist(spark, sf_dir)
    fetch = [h.filter(F.col("symbol") == s).drop("symbol") for s in ("purchase", "view", "click")]
    return hist.assemble_chunks([(i, s, rows) for i, (s, rows) in enumerate(zip(("purchase", "view", "click"), fetch))])


# Of the four planned chunks one was fetched whole, one never, one holds no quotes and one nothing but its header.
MANIFEST_SQL = f"""{Q}, {GIVEN_CHUNKS}, n AS (
  SELECT c.chunk_no, count(q.ts) AS n FROM c LEFT JOIN q ON q.ts >= c.fetch_start AND q.ts <= c.fetch_end GROUP BY 1)"""


def _damaged_chunks(spark, sf_dir):
    h = _hist(spark, sf_dir)
    plan = hist.backfill_chunks(h, STEP, OVERLAP, start=GIVEN[0], end=GIVEN[1])
    fetched = hist.backfill_overlap(h, STEP, OVERLAP, start=GIVEN[0], end=GIVEN[1])
    path = hist.land_chunk_files(fetched.filter("chunk_no = 0"), work_path(spark, "chunk-files"))
    fetched.filter("chunk_no = 2").select(F.concat(F.lit("<html>"), F.col("symbol")).alias("value")).write.text(f"{path}/chunk_no=2")
    spark.range(1).select(F.lit(hist.CHUNK_HEADER).alias("value")).coalesce(1).write.text(f"{path}/chunk_no=3")
    return path, plan


@register("backfill_manifest", f"""
WITH {MANIFEST_SQL}
SELECT chunk_no, CASE WHEN chunk_no = 1 THEN 'absent' WHEN chunk_no = 3 OR n = 0 THEN 'empty' WHEN chunk_no = 2 THEN 'failed' ELSE 'ok' END AS status,
       CASE WHEN chunk_no = 0 THEN n ELSE 0 END AS n_rows, CASE WHEN chunk_no = 2 THEN n ELSE 0 END AS n_bad FROM n""")
def backfill_manifest(spark, sf_dir):
    """What became of every planned chunk: a bad or missing file is a row of the report, not a failed job."""
    path, plan = _damaged_chunks(spark, sf_dir)
    return hist.manifest_report(spark, path, plan)


@register("backfill_from_files", f"""
WITH {MANIFEST_SQL}
SELECT c.chunk_no, q.ts, q.symbol, q.price FROM q JOIN c ON q.ts >= c.fetch_start AND q.ts <= c.fetch_end WHERE c.chunk_no = 0""")
def backfill_from_files(spark, sf_dir):
    """The rows of the chunks that could be read."""
    path, plan = _damaged_chunks(spark, sf_dir)
    return hist.read_chunk_files(spark, path, plan)
