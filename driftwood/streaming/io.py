"""Stream sources, replay landing and sink helpers.

Production sources are ``socket`` (what the original jobs listened on) or a landing
folder of files; tests and replays use files because they are replayable and a
checkpointed query restarts from them after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sizing import discarding
from ..session import work_path

LINE_SCHEMA = "value string"


def line_source(spark: SparkSession, fmt: str = "text", path: str | None = None,
                host: str | None = None, port: int | None = None,
                max_files_per_trigger: int | None = None, schema: str | None = None) -> DataFrame:
    """A streaming DataFrame of lines (``value``) or of landed rows (parquet/json with ``schema``)."""
    r = spark.readStream
    if fmt == "socket":
        return r.format("socket").option("host", host).option("port", port).load()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return r.text(path)
    return r.schema(schema).format(fmt).load(path)


def slices_for(rows: DataFrame, least: int) -> int:
    """Slices of about one scan split each, so that the files' size doesn't grow with the table."""
    return max(least, rows.rdd.getNumPartitions())


def land_time_slices(rows: DataFrame, path: str, n_files: int, ts: str = "ts", fmt: str = "parquet",
                     files_per_slice: int = 1) -> str:
    """Land ``rows`` as ``n_files`` event-time slices of ``files_per_slice`` files, oldest first.

    One range-partitioned write: Spark samples the bounds, every row is shuffled once to its file, whatever the number of
    slices, and file k holds the k-th range of times, sorted.  The file source takes files in the order of
    their modification times, so those are set in the order of the file names (``order_files``); a replay reader sets
    ``maxFilesPerTrigger`` to ``files_per_slice``.  Rows without a time come first.
    """
    part = rows.repartitionByRange(n_files * files_per_slice, F.col(ts).asc_nulls_first()).sortWithinPartitions(F.col(ts).asc_nulls_first())
    if fmt == "text":
        part.select("value").write.mode("append").text(path)
    else:
        part.write.mode("append").format(fmt).save(path)
    order_files(rows.sparkSession, path)
    return path


def land_whole(rows: DataFrame, path: str, by: str, least: int) -> tuple[str, int]:
    """Land ``rows`` for a replay whose micro-batches hold every batch named by ``by`` whole, in the order of its values;
    returns the folder and the files of a micro-batch.

    All rows of one value are in one file, as the write is range-partitioned by it; a micro-batch has a file for each core, and their
    number (``least`` or more) follows the input's splits, not the number of batches."""
    files = rows.sparkSession.sparkContext.defaultParallelism
    return land_time_slices(rows, path, max(least, rows.rdd.getNumPartitions() // files), by, files_per_slice=files), files


def order_files(spark: SparkSession, path: str) -> int:
    """Give the data files of a landing folder modification times in the order of their names, a second apart and in
    the past; returns how many there are.  Touches no data (a call of the file system for each file)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    start = spark._jvm.java.lang.System.currentTimeMillis() - 1000 * (len(files) + 1)
    for i, f in enumerate(files):
        fs.setTimes(f, start + 1000 * i, -1)
    return len(files)


def order_folders(spark: SparkSession, path: str) -> int:
    """As ``order_files`` for a folder partitioned by one number (``name=7``): in the order of the numbers."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in fs.listStatus(folder) if "=" in f.getPath().getName()), key=lambda p: int(p.getName().split("=")[1]))
    start = spark._jvm.java.lang.System.currentTimeMillis() - 1000 * (len(parts) + 1)
    for i, part in enumerate(parts):
        for f in fs.listStatus(part):
            fs.setTimes(f.getPath(), start + 1000 * i, -1)
    return len(parts)


def _start_with(w, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start ``w``; with ``state_partitions``, the query's stateful operators get that many
    partitions.  A streaming query copies the session's settings when it starts (and a
    restart reads the count back from its checkpoint), so the session's own value is
    restored right after."""
    if not state_partitions:
        return w.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return w.start()
    finally:
        spark.conf.set(key, before)


def run_available(df: DataFrame, name: str, mode: str = "append", out: str | None = None,
                  foreach_batch=None, checkpoint: str | None = None,
                  fmt: str = "parquet", state_partitions: int | None = None, timeout: float | None = None) -> StreamingQuery:
    """Process everything available now, checkpointed, and wait for it; with ``timeout`` (seconds), a query that isn't done
    by then is stopped (its checkpoint stays, a later start goes on) and ``TimeoutError`` raised."""
    spark = df.sparkSession
    ck = checkpoint or work_path(spark, f"ckpt-{name}")
    w = df.writeStream.queryName(f"{name}_{ck.rsplit('-', 1)[-1]}").outputMode(mode) \
        .option("checkpointLocation", ck).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", out)
    q = _start_with(w, spark, state_partitions)
    if timeout is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"{name} was not done after {timeout} seconds")
    if q.exception() is not None:
        raise q.exception()
    return q


def overwrite_into(path: str):
    """foreachBatch writer for complete-mode results: each batch replaces the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)
    return write


def append_by_batch(path: str, transform=None):
    """foreachBatch writer that is idempotent on retry: batch ``b`` owns ``batch_id=b``.
    Empty micro-batches are skipped (nothing to score, nothing written); what a batch stages on the
    way is deleted when it is written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # scored in several passes
        try:
            if batch.isEmpty():
                return
            with discarding(batch.sparkSession):
                out = transform(batch, batch_id) if transform else batch
                out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def start(df: DataFrame, name: str, checkpoint: str, mode: str = "append", out: str | None = None,
          foreach_batch=None, fmt: str = "parquet", processing_time: str | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start a long-running query: fixed-interval micro-batches (``processing_time``,
    e.g. ``"15 seconds"``) or as fast as data arrives; always checkpointed, so a
    restarted driver resumes from the last committed batch."""
    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        return _start_with(w.foreachBatch(foreach_batch), df.sparkSession, state_partitions)
    return _start_with(w.format(fmt).option("path", out), df.sparkSession, state_partitions)


def console(df: DataFrame, mode: str = "append", processing_time: str | None = None,
            truncate: bool = False) -> StreamingQuery:
    """Console sink (interactive use only)."""
    w = df.writeStream.outputMode(mode).format("console").option("truncate", truncate)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
