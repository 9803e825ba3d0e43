"""Price-history assembly: chunked overlapping backfill, union, dedup, latest quote.

The backfill plan covers ``[start, end)`` in ``step`` increments; each chunk's fetch
range is extended by ``overlap`` and clipped at ``end`` (both ends inclusive, so rows
in an overlap are fetched twice).  Membership of a row in chunks is arithmetic on
its timestamp - a row-local explode, no range join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import PRICE_TYPE, price_text
from ..functions.timefmt import SECOND_FMT

# Fixed values of the reference backfill: one-year steps, 30-minute overlap.
DEFAULT_STEP = "365 days"
DEFAULT_OVERLAP = "30 minutes"


def _interval(s: str) -> Column:
    return F.expr(f"INTERVAL {s}")


def _micros(s: str) -> int:
    n, unit = s.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(n) * mult[unit.rstrip("s")] * 1_000_000


def history_bounds(history: DataFrame, ts: str = "ts") -> tuple[Column, Column]:
    """Scalar-subquery bounds: first day of the data and the day after the last."""
    start = history.select(F.date_trunc("day", F.min(ts)).cast("timestamp_ntz")).scalar()
    end = history.select((F.date_trunc("day", F.max(ts)) + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")).scalar()
    return start, end


def _given(history: DataFrame, start: str | None, end: str | None, ts: str) -> tuple[Column, Column]:
    """The plan's bounds: as given, or those of the history."""
    low, high = (None, None) if start and end else history_bounds(history, ts)
    return (F.lit(start).cast("timestamp_ntz") if start else low), (F.lit(end).cast("timestamp_ntz") if end else high)


def backfill_chunks(history: DataFrame, step: str = DEFAULT_STEP, overlap: str = DEFAULT_OVERLAP,
                    ts: str = "ts", start: str | None = None, end: str | None = None) -> DataFrame:
    """``(chunk_no, fetch_start, fetch_end)`` covering ``[start, end)``, by default the history's days."""
    low, high = _given(history, start, end, ts)
    b = history.sparkSession.range(1).select(low.alias("s"), high.alias("e"))
    starts = b.select("e", F.posexplode(F.sequence("s", F.col("e") - F.expr("INTERVAL 1 MICROSECOND"),
                                                   _interval(step))).alias("chunk_no", "fetch_start"))
    return starts.select(F.col("chunk_no").cast("bigint").alias("chunk_no"), "fetch_start",
                         F.least(F.col("fetch_start") + _interval(step) + _interval(overlap), F.col("e"))
                         .alias("fetch_end"))


def backfill_overlap(history: DataFrame, step: str = DEFAULT_STEP, overlap: str = DEFAULT_OVERLAP,
                     ts: str = "ts", start: str | None = None, end: str | None = None) -> DataFrame:
    """Every row once per chunk whose inclusive fetch range holds it (the assembled
    backfill, duplicates in overlaps kept), tagged with ``chunk_no``.  With ``start`` and ``end``
    (times as text) the plan covers them and rows outside are left out."""
    step_us, ov_us = _micros(step), _micros(overlap)
    if ov_us >= step_us:
        raise ValueError("overlap must be shorter than the step")
    low, high = _given(history, start, end, ts)
    if start or end:
        history = history.filter((F.col(ts) >= low) & (F.col(ts) <= high))
    off = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(low.cast("timestamp"))
    c = F.call_function("div", off, F.lit(step_us).cast("bigint"))
    into_prev = (c >= 1) & (off - c * step_us <= ov_us)
    # A row at the very end lies in the chunk before it alone: no chunk starts there.
    begun = (F.col(ts) < high) if start or end else F.lit(True)
    chunks = F.when(into_prev & begun, F.array(c - 1, c)).when(into_prev, F.array(c - 1)).when(begun, F.array(c)).otherwise(F.array().cast("array<bigint>"))
    return history.select(F.explode(chunks).alias("chunk_no"), *history.columns)


def assemble_chunks(chunks: list[tuple[int, str, DataFrame]], spark: SparkSession | None = None, schema: str | None = None) -> DataFrame:
    """Chunks fetched one by one, as ``(chunk_no, symbol, rows)``: their union, each row tagged with its chunk and symbol; empty
    chunks add nothing.  No chunks give no rows, of ``schema`` (the fetched columns) with the tags."""
    if not chunks:
        if spark is None or schema is None:
            raise ValueError("no chunks: name the session and the schema of the empty result")
        return spark.createDataFrame([], schema).withColumns({"chunk_no": F.lit(None).cast("bigint"), "symbol": F.lit(None).cast("string")})
    parts = [rows.withColumns({"chunk_no": F.lit(no).cast("bigint"), "symbol": F.lit(symbol)}) for no, symbol, rows in chunks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CHUNK_HEADER = "datetime,stock,high"


def land_chunk_files(backfill: DataFrame, path: str) -> str:
    """An assembled backfill as fetched files: a folder ``chunk_no=<n>`` of header CSV for each chunk."""
    (backfill.select("chunk_no", F.date_format("ts", SECOND_FMT + ".SSSSSS").alias("datetime"), F.col("symbol").cast("string").alias("stock"), price_text(F.col("price")).alias("high"))
     .repartition("chunk_no").write.mode("append").option("header", True).partitionBy("chunk_no").csv(path))
    return path


def _chunk_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """``(chunk_no, ts, stock, high, ok)`` for every line but headers of the files under ``path``; None without any file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", _chunk_of(F.col("_metadata.file_path")).alias("chunk_no"))
    f = F.split("value", ",")
    ts = F.try_to_timestamp(F.get(f, F.lit(0)), F.lit(SECOND_FMT + ".SSSSSS")).cast("timestamp_ntz")
    high = F.get(f, F.lit(2)).try_cast(PRICE_TYPE)
    ok = (F.size(f) == 3) & ts.isNotNull() & high.isNotNull() & (F.get(f, F.lit(1)) != "")
    return lines.filter((F.col("value") != CHUNK_HEADER) & (F.col("value") != "")).select(
        "chunk_no", ts.alias("ts"), F.get(f, F.lit(1)).alias("stock"), high.alias("high"), F.coalesce(ok, F.lit(False)).alias("ok"))


def _chunk_of(file: Column) -> Column:
    return F.regexp_extract(file, "chunk_no=([0-9]+)", 1).try_cast("bigint")


def read_chunk_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``(chunk_no, ts, symbol, price)``: the good rows of the chunks that ``manifest`` (``chunk_no``) lists, whatever the state of
    the other files."""
    lines = _chunk_lines(spark, path)
    if lines is None:
        return spark.createDataFrame([], f"chunk_no bigint, ts timestamp_ntz, symbol string, price {PRICE_TYPE}")
    return (lines.filter("ok").join(F.broadcast(manifest.select("chunk_no")), "chunk_no", "left_semi")  # a row for each chunk planned
            .select("chunk_no", "ts", F.col("stock").alias("symbol"), F.col("high").alias("price")))


def manifest_report(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """``(chunk_no, status, n_rows, n_bad)`` for every planned chunk: ``absent`` (no file), ``empty`` (no lines), ``failed`` (no line is a
    quote), ``partial`` (some aren't) or ``ok``.  Two scans: the listing (no contents) and the lines."""
    lines = _chunk_lines(spark, path)
    if lines is None:
        return manifest.select("chunk_no", F.lit("absent").alias("status"), F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_bad"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(_chunk_of(F.col("path")).alias("chunk_no")).distinct()
    counts = lines.groupBy("chunk_no").agg(F.count_if("ok").alias("n_rows"), F.count_if(~F.col("ok")).alias("n_bad"))
    j = (manifest.select("chunk_no").join(files.withColumn("_there", F.lit(True)), "chunk_no", "left").join(counts, "chunk_no", "left")
         .withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_rows", "n_bad")}))
    status = (F.when(F.col("_there").isNull(), "absent").when((F.col("n_rows") == 0) & (F.col("n_bad") == 0), "empty")
              .when(F.col("n_rows") == 0, "failed").when(F.col("n_bad") > 0, "partial").otherwise("ok"))
    return j.select("chunk_no", status.alias("status"), "n_rows", "n_bad")


def chunk_report(plan: DataFrame, assembled: DataFrame) -> DataFrame:
    """``(chunk_no, fetch_start, fetch_end, n_rows, missing)`` for every planned chunk."""
    n = assembled.groupBy("chunk_no").agg(F.count("*").alias("n_rows"))
    return plan.join(n, "chunk_no", "left").select("chunk_no", "fetch_start", "fetch_end", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                                                   F.col("n_rows").isNull().alias("missing"))


def dedup_overlap(backfill: DataFrame, keys=("symbol", "event_id")) -> DataFrame:
    """Drop the overlap duplicates (shuffle on the full key, no skew on symbol)."""
    return backfill.drop("chunk_no").dropDuplicates(list(keys))


def dedup_stream(backfill: DataFrame, delay: str = "1 hour", keys=("symbol", "event_id"),
                 ts: str = "ts") -> DataFrame:
    """Streaming twin of ``dedup_overlap``: the first copy of a key passes at once, later
    copies within the watermark delay are dropped; state expires with the watermark."""
    d = backfill.drop("chunk_no") if "chunk_no" in backfill.columns else backfill
    return (d.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(list(keys)))


def union_sorted(*histories: DataFrame, ts: str = "ts") -> DataFrame:
    """Concatenate histories and sort globally by time (symbol, id break ties)."""
    out = histories[0]
    for h in histories[1:]:
        out = out.unionByName(h)
    return out.orderBy(ts, "symbol", "event_id")


def latest_per_symbol(quotes: DataFrame) -> DataFrame:
    """Newest quote of every symbol (partial aggregation; a hot symbol costs one row per task)."""
    m = F.max_by(F.struct("ts", "event_id", "price"), F.struct("ts", "event_id"))
    return (quotes.groupBy("symbol").agg(m.alias("m"))
            .select("symbol", F.col("m.ts").alias("ts"), F.col("m.event_id").alias("event_id"),
                    F.col("m.price").alias("price")))


def latest_stream(quotes: DataFrame) -> DataFrame:
    """Running newest quote of every symbol (update mode: a trigger emits the symbols that changed)."""
    good = quotes.filter("symbol IS NOT NULL AND ts IS NOT NULL AND price IS NOT NULL")
    return latest_per_symbol(good)


def _published(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder)) if fs.exists(folder) else []


def publish_snapshot(rows: DataFrame, path: str, version: int, keep: int = 2) -> str:
    """Write ``rows`` (symbol, price) as version ``version`` and publish it by an empty file that is created last.  Readers see
    the greatest published version, whole; the ``keep`` newest stay for those that are reading.  A version that is
    published already isn't touched."""
    spark = rows.sparkSession
    there = _published(spark, path)
    if version not in there:
        rows.select("symbol", "price").write.mode("overwrite").parquet(f"{path}/version-{version}")
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published/{version:012d}")
        fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.create(mark, True).close()
        there = sorted([*there, version])
        for old in there[:-keep]:  # unpublished first
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published/{old:012d}"), False)
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version-{old}"), True)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``(symbol, price)`` of the newest published version; no rows before the first."""
    there = _published(spark, path)
    schema = f"symbol string, price {PRICE_TYPE}"
    return spark.read.schema(schema).parquet(f"{path}/version-{there[-1]}") if there else spark.createDataFrame([], schema)


def snapshot_lines(snapshot: DataFrame) -> DataFrame:
    """``SYMBOL,price`` lines."""
    return snapshot.select(F.concat_ws(",", F.col("symbol"), price_text(F.col("price"))).alias("value"))


def snapshot_writer(path: str):
    """foreachBatch writer for ``latest_stream`` in update mode: the changed symbols over the version before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.select(F.col("symbol").cast("string").alias("symbol"), F.col("price").cast(PRICE_TYPE).alias("price"))
        before = [v for v in _published(spark, path) if v < batch_id]
        if before:
            old = spark.read.schema(f"symbol string, price {PRICE_TYPE}").parquet(f"{path}/version-{before[-1]}")
            changed = changed.unionByName(old.join(changed.select("symbol"), "symbol", "left_anti"))
        publish_snapshot(changed, path, batch_id)
    return write


def write_snapshot(latest: DataFrame, path: str) -> str:
    """Write ``SYMBOL,price`` lines over the snapshot at ``path`` (the old lines are gone first: readers that
    mustn't see a gap read a versioned path)."""
    (latest.select(F.concat_ws(",", F.col("symbol").cast("string"), price_text(F.col("price"))).alias("value"))
     .write.mode("overwrite").text(path))
    return path
