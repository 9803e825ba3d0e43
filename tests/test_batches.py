"""Micro-batch state in tables: stream = batch with a hot symbol, late rows, repeated batches, concurrent streams."""

import datetime as dt
import threading

from pyspark.sql import functions as F

from driftwood.operators import moving_average as ma
from driftwood.operators.rolling import time_bucket
from driftwood.session import work_path
from driftwood.sources.tables import read_quotes
from driftwood.streaming import batches, io
from conftest import SF_MID, rows

COLS = ["symbol", "ts", "event_id", "side", "price", "shares", "ma10", "ma40"]
SCHEMA = "event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6), units bigint"


def hot_quotes(spark):
    """Nine of ten rows on one symbol."""
    return read_quotes(spark, SF_MID, "event_type").withColumn("symbol", F.when(F.col("event_id") % 10 > 0, "hot").otherwise(F.col("symbol")))


def run(spark, landing, name, late=None, out=None, state=None, checkpoint=None, bucket="1 day"):
    late, out, state = (x or work_path(spark, f"t-{name}") for x in (late, out, state))
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1, schema=SCHEMA)
    io.run_available(src, name, foreach_batch=batches.crossover_writer(out, late, state, "1 hour", bucket=bucket), checkpoint=checkpoint)
    return spark.read.parquet(out), spark.read.parquet(late)


def batch_answer(q):
    newest = q.agg(F.max("ts")).first()[0]
    return ma.crossover_signals(q).drop("units").filter(F.col("ts") <= F.lit(newest - dt.timedelta(hours=1)))


def test_hot_symbol_equals_batch_and_is_spread(spark):
    q = hot_quotes(spark)
    landing = io.land_time_slices(q, work_path(spark, "t-hot-land"), 3, "ts")
    got, late = run(spark, landing, "t_hot_batches")
    assert rows(got, COLS) == rows(batch_answer(q), COLS) and got.count() > 500
    assert late.count() == 0
    # A task's unit of work is a symbol's bucket.
    n = q.count()
    most = q.groupBy("symbol", time_bucket(F.col("ts"), "1 day")).count().agg(F.max("count")).first()[0]
    assert q.filter("symbol = 'hot'").count() > 0.85 * n and most < 0.05 * n


def test_stragglers_within_the_delay_and_late_ones(spark):
    q = hot_quotes(spark)
    landing = work_path(spark, "t-late-land")
    t = dt.datetime(2024, 1, 15)
    soon = q.filter((F.col("ts") >= t - dt.timedelta(minutes=50)) & (F.col("ts") < t) & (F.col("event_id") % 2 == 0))
    behind = q.filter((F.col("ts") < t - dt.timedelta(hours=3)) & (F.col("event_id") % 50 == 0))
    first = q.filter(F.col("ts") < t).join(soon.unionAll(behind).select("event_id"), "event_id", "left_anti").select(q.columns)
    odd = spark.createDataFrame([(-1, None, "hot", None, 5), (-2, t, None, None, 5), (-3, t, "hot", None, None), (-4, t, "hot", None, 10 ** 17)], SCHEMA)
    # The newest row of the first slice is within the hour of the stragglers that come with the second.
    for part in (first, q.filter(F.col("ts") >= t).unionByName(soon).unionByName(behind).unionByName(odd)):
        part.coalesce(1).write.mode("append").parquet(landing)
    got, late = run(spark, landing, "t_late_batches")
    in_time = q.join(behind.select("event_id"), "event_id", "left_anti").select(q.columns)
    assert rows(got, COLS) == rows(batch_answer(in_time), COLS)
    reasons = {r.event_id: r.reject for r in late.collect()}
    assert {i: r for i, r in reasons.items() if i < 0} == {-1: "null_time", -2: "null_symbol", -3: "null_price", -4: "out_of_range"}
    assert {i for i in reasons if i >= 0} == {r.event_id for r in behind.collect()} and behind.count() > 20


def test_a_batch_that_is_run_again_writes_the_same(spark):
    q = hot_quotes(spark)
    parts = [q.filter(F.pmod(F.floor(F.col("event_id") / 2000), F.lit(5)) == i) for i in range(5)]
    late, out, state = (work_path(spark, f"t-again-{x}") for x in ("late", "out", "state"))
    write = batches.crossover_writer(out, late, state, "1 hour")
    for i, part in enumerate(parts):
        write(part, i)
        write(part, i)
    assert rows(spark.read.parquet(out), COLS) == rows(batch_answer(q), COLS)


def test_split_is_the_whole_input(spark):
    q = hot_quotes(spark)
    on_time, late, state = (work_path(spark, f"t-split-{x}") for x in ("on", "late", "state"))
    write = batches.late_split_writer(on_time, late, state, "1 day")
    for i in (3, 1, 0, 4, 2):
        write(q.filter(F.floor(F.col("event_id") / 2000) == i), (3, 1, 0, 4, 2).index(i))
    a, b = spark.read.parquet(on_time), spark.read.parquet(late)
    assert rows(a.select(q.columns).unionByName(b.select(q.columns))) == rows(q)
    assert b.count() > 5000 and set(r.reject for r in b.select("reject").distinct().collect()) == {"late"}


def test_empty_batches(spark):
    q = hot_quotes(spark)
    late, out, state = (work_path(spark, f"t-none-{x}") for x in ("late", "out", "state"))
    write = batches.crossover_writer(out, late, state, "1 hour")
    write(q.limit(0), 0)
    write(q, 1)
    write(q.limit(0), 2)
    assert rows(spark.read.parquet(out), COLS) == rows(batch_answer(q), COLS)


def test_two_streams_and_a_batch_query_at_once(spark):
    """What one of them stages is never deleted by another."""
    from driftwood.operators.sizing import materialize
    q = hot_quotes(spark)
    landing = io.land_time_slices(q, work_path(spark, "t-two-land"), 3, "ts")
    got, failed = {}, []

    def stream(name):
        try:
            got[name] = rows(run(spark, landing, name)[0], COLS)
        except Exception as e:  # reported below
            failed.append(e)
    threads = [threading.Thread(target=stream, args=(f"t_two_{k}",)) for k in range(2)]
    for t in threads:
        t.start()
    staged = [materialize(spark.range(k + 1), "t-side") for k in range(12)]
    for t in threads:
        t.join()
    assert not failed and [s.count() for s in staged] == list(range(1, 13))
    want = rows(batch_answer(q), COLS)
    assert got == {"t_two_0": want, "t_two_1": want}


def test_landing_is_one_write_whatever_the_slices(spark):
    q = read_quotes(spark, SF_MID, "event_type")
    jobs, sc = {}, spark.sparkContext
    for n in (4, 40):
        path = work_path(spark, f"t-land-{n}")
        sc.setJobGroup(f"land-{n}", "landing")
        io.land_time_slices(q.unionByName(q.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz"))), path, n, "ts")
        sc.setLocalProperty("spark.jobGroup.id", None)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"land-{n}"))
        files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_modification_time").alias("m")).agg(
            F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).orderBy("m").collect()
        assert sum(f.n for f in files) == q.count() + 3 and n - 2 <= len(files) <= n
        assert all(x.b <= y.a for x, y in zip(files, files[1:])) and [f.f for f in files] == sorted(f.f for f in files)
    assert jobs[4] == jobs[40]


def test_waiting_ends_at_the_timeout(spark):
    import time

    import pytest
    landing = work_path(spark, "t-wait-land")
    spark.range(10).write.parquet(landing)

    def slow(batch, batch_id):
        time.sleep(8)
    src = spark.readStream.schema("id bigint").parquet(landing)
    with pytest.raises(TimeoutError):
        io.run_available(src, "t_wait", foreach_batch=slow, timeout=2)
