"""Phase 6: streaming plans.  Each run lands a replay of the tables in a fresh folder
under the shared checkpoint folder, processes it with ``availableNow`` and a
checkpoint, and returns the sink read back as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import moving_average as ma
from ..session import work_path
from ..sources import documents as docs
from ..sources import quotes as qs
from ..sources.tables import read_documents, read_quotes
from ..streaming import batches
from ..streaming import bloom as sbloom
from ..streaming import crossover as sx
from ..streaming import io
from ..streaming import windows as sw
from . import quotes as pq
from .registry import QUERY_SQL
from . import text as pt
from . import windows as pw
from .registry import register

N_FILES = 4  # slices of a replay at least
N_DOC_SLICES = 4  # micro-batches of the document-line replays at least


def _state_partitions(spark):
    """State-store partitions of the replay queries: one per core of the cluster (the
    session default, 200, is sized for shuffles, and every micro-batch touches every
    state partition)."""
    return spark.sparkContext.defaultParallelism


# Closed-window accounting: the final watermark is (max event time in ms) - delay;
# append mode emits a coarse window once its end is at or before it.  Lines carry
# whole seconds, so the stream's event times are the table's, truncated.
WINDOW_STREAM_SQL = pw.WINDOW_JOIN_SQL.replace("SELECT event_id, ts,", "SELECT event_id, date_trunc('second', ts) AS ts,") + """
WHERE coarse_start + INTERVAL '40 minutes' <= (SELECT max(date_trunc('second', ts)) FROM events) - INTERVAL '10 minutes'"""

# A row is final once epoch_us(ts) <= (max event ms - delay ms) * 1000.
CROSSOVER_STREAM_SQL = pq.CROSSOVER_SQL + """
  AND epoch_us(ts) <= ((SELECT epoch_us(max(ts)) FROM events) // 1000 - 3600000) * 1000"""


def _land_lines(spark, sf_dir, symbol="event_type"):
    """Quote lines in event-time order, as N_FILES text files."""
    q = read_quotes(spark, sf_dir, symbol)
    rows = q.select("ts", qs.line4().alias("value"))
    return io.land_time_slices(rows, work_path(spark, "replay-lines"), io.slices_for(rows, N_FILES), "ts", fmt="text")


def _parsed_stream(spark, path):
    lines = io.line_source(spark, "text", path, max_files_per_trigger=1)
    return qs.accepted(qs.parse_lines4(lines))


def _land_document_lines(spark, sf_dir):
    """Document lines in slices with a file for each core, so that a micro-batch is scanned by all of them."""
    lines = docs.document_lines(read_documents(spark, sf_dir))
    files = spark.sparkContext.defaultParallelism
    slices = max(N_DOC_SLICES, lines.rdd.getNumPartitions() // files)
    return io.land_time_slices(lines, work_path(spark, "replay-doc-lines"), slices, "doc_id", files_per_slice=files), files


@register("tumbling_avg_stream", QUERY_SQL["tumbling_avg_10d"])
def tumbling_avg_stream(spark, sf_dir):
    """10-day mean of one symbol, complete mode (all windows re-emitted every trigger)."""
    path = _land_lines(spark, sf_dir)
    q = _parsed_stream(spark, path).filter(F.col("symbol") == "purchase")
    out = work_path(spark, "tumbling-out")
    io.run_available(sw.tumbling_avg_stream(q, "10 days", "1 day", (), "ma10d"), "tumbling_avg_stream",
                     "complete", foreach_batch=io.overwrite_into(out), state_partitions=_state_partitions(spark))
    r = spark.read.parquet(out)
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "ma10d", "n")


@register("window_ma_stream", WINDOW_STREAM_SQL)
def window_ma_stream(spark, sf_dir):
    """Fine and containing-coarse means in one pass; windows closed by the watermark."""
    path = _land_lines(spark, sf_dir)
    out = work_path(spark, "window-ma-out")
    io.run_available(sw.window_ma_stream(_parsed_stream(spark, path)), "window_ma_stream", "append", out,
                     state_partitions=_state_partitions(spark))
    r = spark.read.parquet(out)
    return r.select("symbol", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")],
                    "ma10m", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("coarse_start", "coarse_end")],
                    "ma40m")


@register("bloom_stream", QUERY_SQL["bloom_verdict"])
def bloom_stream(spark, sf_dir):
    """Token verdicts scored per micro-batch of a document-line stream."""
    landing, files = _land_document_lines(spark, sf_dir)
    bits = pt._bits(spark, sf_dir, pt.M, pt.K)
    out = work_path(spark, "bloom-stream-out")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files,
                         schema="doc_id bigint, line_no int, line string")
    io.run_available(src, "bloom_stream", foreach_batch=sbloom.verdict_writer(bits, out, pt.M, pt.K))
    return spark.read.parquet(out).select("doc_id", "line_no", "pos", "word", "verdict")


@register("crossover_stream", CROSSOVER_STREAM_SQL)
def crossover_stream(spark, sf_dir):
    """Keyed-state detector over a time-ordered replay (symbol = user_id, 1 h delay).  Every micro-batch visits the state of
    all symbols, so it takes a file for each core and their number follows the input's splits per core."""
    q = read_quotes(spark, sf_dir, "user_id")
    files = _state_partitions(spark)
    slices = max(N_FILES, q.rdd.getNumPartitions() // files)
    landing = io.land_time_slices(q, work_path(spark, "replay-quotes"), slices, "ts", files_per_slice=files)
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files,
                         schema="event_id bigint, ts timestamp_ntz, symbol bigint, price decimal(18,6), units bigint")
    out = work_path(spark, "crossover-out")
    io.run_available(sx.crossover_stream(src, "1 hour"), "crossover_stream", "append", out,
                     state_partitions=_state_partitions(spark))
    return sx.finish(spark.read.parquet(out))


@register("sentence_gate_stream", QUERY_SQL["sentence_gate"])
def sentence_gate_stream(spark, sf_dir):
    """Lines without a positive token, gated per micro-batch of a document-line stream."""
    landing, files = _land_document_lines(spark, sf_dir)
    bits = pt._bits(spark, sf_dir, pt.M, pt.K)
    out = work_path(spark, "sentence-gate-out")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files,
                         schema="doc_id bigint, line_no int, line string")
    io.run_available(src, "sentence_gate_stream", foreach_batch=sbloom.sentence_gate_writer(bits, out, pt.M, pt.K))
    return spark.read.parquet(out).select("doc_id", "line_no", "line")


GATED_LINES = 32  # lines of a document that pass together or not at all


@register("batch_gate_stream", f"""
WITH {pt.LEX}, {pt.BAD}, {pt.BITS(pt.M, pt.K)}, {pt.LINES}, {pt.TOKENS}, {pt.PROBE(pt.M, pt.K)},
bad_blocks AS (SELECT DISTINCT doc_id, line_no // {GATED_LINES} AS block FROM tokens t JOIN probe p ON p.word = t.word WHERE p.in_filter)
SELECT l.doc_id, l.line_no, l.line FROM lines l ANTI JOIN bad_blocks b ON b.doc_id = l.doc_id AND b.block = l.line_no // {GATED_LINES}""")
def batch_gate_stream(spark, sf_dir):
    """Blocks of a document's lines pass whole or not at all; a micro-batch holds many blocks, each whole."""
    block = F.concat_ws(":", F.col("doc_id"), F.floor(F.col("line_no") / GATED_LINES))
    lines = docs.document_lines(read_documents(spark, sf_dir)).withColumn("block", block)
    landing, files = io.land_whole(lines, work_path(spark, "replay-gate-batches"), "block", N_DOC_SLICES)
    bits = pt._bits(spark, sf_dir, pt.M, pt.K)
    out = work_path(spark, "batch-gate-out")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files,
                         schema="doc_id bigint, line_no int, line string, block string")
    io.run_available(src, "batch_gate_stream", foreach_batch=sbloom.batch_gate_writer(bits, out, pt.M, pt.K, by="block"))
    return spark.read.parquet(out).select("doc_id", "line_no", "line")


@register("first_token_stream", QUERY_SQL["first_token"])
def first_token_stream(spark, sf_dir):
    """The first token of every line of a document-line stream (stateless projection)."""
    landing, files = _land_document_lines(spark, sf_dir)
    out = work_path(spark, "first-token-out")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files, schema="doc_id bigint, line_no int, line string")
    io.run_available(docs.first_token(src), "first_token_stream", "append", out)
    return spark.read.parquet(out)


@register("batch_local_ma_stream", QUERY_SQL["batch_local_ma10"])
def batch_local_ma_stream(spark, sf_dir):
    """Rolling mean that restarts in every batch of 250 arrivals; a micro-batch holds many of them, each whole."""
    q = read_quotes(spark, sf_dir, "event_type").withColumn("b", F.floor(F.col("event_id") / 250).cast("bigint"))
    landing, files = io.land_whole(q, work_path(spark, "replay-arrivals"), "b", N_FILES)
    out = work_path(spark, "batch-local-out")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files,
                         schema="event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6), units bigint, b bigint")
    io.run_available(src, "batch_local_ma_stream", foreach_batch=io.append_by_batch(out, lambda batch, _: ma.batch_local_ma(batch, "b").withColumnRenamed(
        "batch_id", "arrivals")))
    return spark.read.parquet(out).select(F.col("arrivals").alias("batch_id"), "symbol", "ts", "event_id", "ma10")


@register("backfill_dedup_stream", QUERY_SQL["backfill_dedup"])
def backfill_dedup_stream(spark, sf_dir):
    """The assembled backfill (overlap copies included) replayed as a stream and
    de-duplicated within the watermark: every quote exactly once."""
    from ..sources import history as hist
    h = read_quotes(spark, sf_dir, "event_type").select("event_id", "ts", "symbol", "price")
    bf = hist.backfill_overlap(h, "7 days", "30 minutes")
    landing = io.land_time_slices(bf, work_path(spark, "replay-backfill"), io.slices_for(bf, N_FILES), "ts")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1,
                         schema="chunk_no bigint, event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6)")
    out = work_path(spark, "dedup-out")
    io.run_available(hist.dedup_stream(src, "1 hour"), "backfill_dedup_stream", "append", out,
                     state_partitions=_state_partitions(spark))
    r = spark.read.parquet(out)
    return r.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "symbol", "price")


# Arrivals for the late-row replays: an eighth of the events a micro-batch, every seventh event two micro-batches late.
LATE_DELAY = "1 hour"
ARRIVALS_SQL = f"""
a AS (SELECT event_id, ts, event_type AS symbol, CAST(value AS DECIMAL(18,6)) AS price, CAST(round(value * 100) AS BIGINT) AS cents,
             CAST(event_id * 8 // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS BIGINT) AS arrival FROM events),
m AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM a GROUP BY arrival),
j AS (SELECT a.*, coalesce(ts <= mark - INTERVAL '{LATE_DELAY}', false) AS late FROM a JOIN m USING (arrival))"""


def _land_arrivals(spark, sf_dir):
    """A folder for each micro-batch; the folder's number is its place in the replay."""
    q = read_quotes(spark, sf_dir, "event_type")
    events = (q.agg(F.max("event_id")).first()[0] or 0) + 1
    q = q.withColumn("arrival", F.expr(f"event_id * 8 div {events} + IF(event_id % 7 = 0, 2, 0)").cast("bigint"))
    landing = work_path(spark, "replay-late")
    q.repartitionByRange(_state_partitions(spark), "arrival").sortWithinPartitions("arrival").write.partitionBy("arrival").parquet(landing)
    io.order_folders(spark, landing)
    return io.line_source(spark, "parquet", landing, max_files_per_trigger=1,
                          schema="event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6), units bigint, arrival bigint")


@register("late_rows_stream", f"""WITH {ARRIVALS_SQL}
SELECT arrival, event_id, symbol, ts, price, CASE WHEN late THEN 'late' END AS reject FROM j""")
def late_rows_stream(spark, sf_dir):
    """Every arrival of a replay with stragglers, with the reason why it is late or none: both outputs of the split."""
    src = _land_arrivals(spark, sf_dir)
    on_time, late = work_path(spark, "on-time"), work_path(spark, "late")
    io.run_available(src, "late_rows_stream", foreach_batch=batches.late_split_writer(on_time, late, work_path(spark, "late-state"), LATE_DELAY))
    cols = ["arrival", "event_id", "symbol", "ts", "price"]
    kept = spark.read.parquet(on_time).select(*cols, F.lit(None).cast("string").alias("reject"))
    return kept.unionByName(spark.read.parquet(late).select(*cols, "reject"))


@register("crossover_late_stream", f"""
WITH {ARRIVALS_SQL}, q AS (SELECT * FROM j WHERE NOT late), {pq.ROLL}, {pq.CROSSED}
SELECT symbol, ts, event_id, side, price, CAST(10000000 // cents AS BIGINT) AS shares,
       CAST(s10 AS DOUBLE) / CAST(1000 AS DOUBLE) AS ma10, CAST(s40 AS DOUBLE) / CAST(4000 AS DOUBLE) AS ma40
FROM s WHERE side IS NOT NULL
  AND ts <= (SELECT max(ts) FROM q) - INTERVAL '{LATE_DELAY}'""")
def crossover_late_stream(spark, sf_dir):
    """Crossover signals of five hot symbols from the same replay: state in tables, each symbol split by time, late rows left out."""
    src = _land_arrivals(spark, sf_dir).drop("arrival")
    out = work_path(spark, "crossover-late")
    io.run_available(src, "crossover_late_stream", foreach_batch=batches.crossover_writer(out, work_path(spark, "late"), work_path(spark, "crossover-state"), LATE_DELAY))
    return spark.read.parquet(out).drop("units", "batch_id")


@register("latest_snapshot_stream", QUERY_SQL["latest_snapshot"])
def latest_snapshot_stream(spark, sf_dir):
    """Newest quotes as a running query: every trigger publishes a whole snapshot; the last one is read."""
    from ..sources import history as hist
    q = read_quotes(spark, sf_dir, "event_type").select("event_id", "ts", "symbol", "price")
    landing = io.land_time_slices(q, work_path(spark, "replay-latest"), io.slices_for(q, N_FILES), "ts")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1, schema="event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6)")
    path = work_path(spark, "snapshots")
    io.run_available(hist.latest_stream(src), "latest_snapshot_stream", "update", foreach_batch=hist.snapshot_writer(path), state_partitions=_state_partitions(spark))
    return hist.snapshot_lines(hist.read_snapshot(spark, path))


# Fine windows with a count that three doesn't divide, coarse ones with an even count: either side has windows without a partner.
OUTER_STREAM_SQL = f"""
WITH e AS (SELECT date_trunc('second', ts) AS ts, event_type AS symbol, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
f AS (SELECT symbol, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS s, sum(cents) AS sum_cents, count(*) AS n FROM e GROUP BY ALL HAVING count(*) % 3 > 0),
c AS (SELECT symbol, time_bucket(INTERVAL '40 minutes', ts, TIMESTAMP '1970-01-01') AS s, sum(cents) AS sum_cents, count(*) AS n FROM e GROUP BY ALL HAVING count(*) % 2 = 0),
g AS (SELECT *, time_bucket(INTERVAL '40 minutes', s, TIMESTAMP '1970-01-01') AS cs FROM f)
SELECT coalesce(g.symbol, c.symbol) AS symbol, g.s AS window_start, g.s + INTERVAL '10 minutes' AS window_end, {pw._mean('g.sum_cents', 'g.n')} AS ma10m,
       coalesce(g.cs, c.s) AS coarse_start, c.s + INTERVAL '40 minutes' AS coarse_end, {pw._mean('c.sum_cents', 'c.n')} AS ma40m
FROM g FULL OUTER JOIN c ON g.symbol = c.symbol AND g.cs = c.s
WHERE coalesce(g.cs, c.s) + INTERVAL '40 minutes' <= (SELECT max(ts) FROM e) - INTERVAL '10 minutes'"""


@register("window_ma_outer_stream", OUTER_STREAM_SQL)
def window_ma_outer_stream(spark, sf_dir):
    """Two streams of window means joined full outer; coarse windows that the watermark has closed."""
    path = _land_lines(spark, sf_dir)
    out = work_path(spark, "window-outer-out")
    joined = sw.window_ma_outer_stream(_parsed_stream(spark, path), _parsed_stream(spark, path), fine_filter=F.col("n") % 3 > 0, coarse_filter=F.col("n") % 2 == 0)
    io.run_available(joined, "window_ma_outer_stream", "append", out, state_partitions=_state_partitions(spark))
    times = ("window_start", "window_end", "coarse_start", "coarse_end")
    r = spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    # A fine window is emitted with its partner before the coarse window's end has passed the watermark, alone after it.
    edge = read_quotes(spark, sf_dir, "event_type").select(F.date_trunc("second", F.max("ts")).cast("timestamp_ntz")).scalar()
    return r.filter(F.col("coarse_start") + F.expr("INTERVAL 40 MINUTES") <= edge - F.expr("INTERVAL 10 MINUTES"))
