"""Stream = batch: the keyed-state detector over replays in 1 or 4 files, out of
order within the watermark delay, and restarted from its checkpoint midway."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftwood.operators import moving_average as ma
from driftwood.session import work_path
from driftwood.sources.tables import read_quotes
from driftwood.streaming import crossover as sx
from driftwood.streaming import io
from conftest import SF_SMALL, SF_MID, rows

SCHEMA = "event_id bigint, ts timestamp_ntz, symbol bigint, price decimal(18,6), units bigint"
DELAY_US = 3600 * 1_000_000
COLS = ["symbol", "ts", "event_id", "side", "price", "shares", "ma10", "ma40"]


def batch_final(q, max_ts):
    max_us = int((max_ts - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    cut_us = (max_us // 1000 - 3_600_000) * 1000
    cut = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=cut_us)
    return ma.crossover_signals(q).drop("units").filter(F.col("ts") <= F.lit(cut))


def run_stream(spark, landing, ck, out):
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1, schema=SCHEMA)
    io.run_available(sx.crossover_stream(src, "1 hour"), "t_crossover", "append", out, checkpoint=ck)
    return sx.finish(spark.read.parquet(out))


@pytest.mark.parametrize("n_files", [1, 4])
def test_stream_equals_batch(spark, n_files):
    q = read_quotes(spark, SF_SMALL, "user_id")
    landing = io.land_time_slices(q, work_path(spark, "t-land"), n_files, "ts")
    got = run_stream(spark, landing, work_path(spark, "t-ck"), work_path(spark, "t-out"))
    max_ts = q.agg(F.max("ts")).collect()[0][0]
    assert rows(got, COLS) == rows(batch_final(q, max_ts), COLS)
    assert got.count() > 0


def test_out_of_order_within_delay(spark):
    q = read_quotes(spark, SF_MID, "user_id")
    t1 = dt.datetime(2024, 1, 15)
    mid = (F.col("ts") >= F.lit(t1)) & (F.col("ts") < F.lit(t1 + dt.timedelta(minutes=20)))
    first = q.filter((F.col("ts") < F.lit(t1)) | (mid & (F.col("event_id") % 2 == 0)))
    second = q.subtract(first)
    landing = work_path(spark, "t-land-ooo")
    first.coalesce(1).write.mode("append").parquet(landing)
    second.orderBy(F.desc("ts")).coalesce(1).write.mode("append").parquet(landing)
    got = run_stream(spark, landing, work_path(spark, "t-ck"), work_path(spark, "t-out"))
    max_ts = q.agg(F.max("ts")).collect()[0][0]
    assert rows(got, COLS) == rows(batch_final(q, max_ts), COLS)


def test_restart_from_checkpoint(spark):
    q = read_quotes(spark, SF_SMALL, "user_id")
    t1 = dt.datetime(2024, 1, 16)
    landing, ck, out = work_path(spark, "t-land-rs"), work_path(spark, "t-ck"), work_path(spark, "t-out")
    q.filter(F.col("ts") < F.lit(t1)).coalesce(1).write.mode("append").parquet(landing)
    run_stream(spark, landing, ck, out)
    q.filter(F.col("ts") >= F.lit(t1)).coalesce(1).write.mode("append").parquet(landing)
    got = run_stream(spark, landing, ck, out)
    max_ts = q.agg(F.max("ts")).collect()[0][0]
    assert rows(got, COLS) == rows(batch_final(q, max_ts), COLS)


def test_hot_symbols_equal_batch(spark):
    """Five symbols, thousands of rows each per micro-batch (the vectorized path)."""
    q = read_quotes(spark, SF_MID, "event_type")
    landing = io.land_time_slices(q, work_path(spark, "t-land-hot"), 3, "ts")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1,
                         schema=SCHEMA.replace("symbol bigint", "symbol string"))
    out = work_path(spark, "t-out-hot")
    io.run_available(sx.crossover_stream(src, "1 hour", symbol_type="string"), "t_hot", "append", out,
                     checkpoint=work_path(spark, "t-ck-hot"))
    got = sx.finish(spark.read.parquet(out))
    max_ts = q.agg(F.max("ts")).collect()[0][0]
    want = batch_final(q, max_ts)
    assert got.count() > 100
    assert rows(got, COLS) == rows(want, COLS)


def test_micro_batches_leave_no_staged_tables(spark, tmp_path):
    import glob

    from driftwood.session import checkpoint_root, local_fs_path
    from driftwood.sources import lexicon as lx
    from driftwood.sources.tables import read_table
    from driftwood.operators import bloom
    from driftwood.streaming import bloom as sbloom
    bits = bloom.set_bits(bloom.build(lx.bad_words(lx.lexicon_from_texts(read_table(spark, SF_SMALL, "benchmark"))), 2000, 5)).cache()
    bits.count()
    landing, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(10):
        spark.createDataFrame([(i, 0, f"line {i} of words"), (i, 1, "")], "doc_id bigint, line_no int, line string").coalesce(1).write.mode("append").parquet(landing)
    side = f"{local_fs_path(checkpoint_root(spark))}/driftwood/side-*"
    before = set(glob.glob(side))
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1, schema="doc_id bigint, line_no int, line string")
    io.run_available(src, "t_side", foreach_batch=sbloom.sentence_gate_writer(bits, out, 2000, 5))
    assert set(glob.glob(side)) == before
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 10 and got.count() == 20
    bits.unpersist()


@pytest.mark.parametrize("by", [None, "block"])
def test_a_gated_batch_passes_whole_or_not_at_all(spark, tmp_path, by):
    """By default the micro-batch is gated; with a column, each of its values by itself, however many share a micro-batch."""
    from driftwood.operators import bloom
    from driftwood.streaming import bloom as sbloom
    bits = bloom.set_bits(bloom.build(spark.createDataFrame([("bad",)], "word string"), 2000, 5)).cache()
    lines = [(d, n, "a bad word" if (d, n) == (4, 3) else f"line {d}" if n else "", f"{d}:{n // 2}") for d in range(12) for n in range(5)]
    df = spark.createDataFrame(lines, "doc_id bigint, line_no int, line string, block string")
    landing, files = io.land_whole(df, f"{tmp_path}/in", "block", 3)
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=files, schema=df.schema.simpleString()[7:-1].replace(":", " "))
    io.run_available(src, "t_gate", foreach_batch=sbloom.batch_gate_writer(bits, f"{tmp_path}/out", 2000, 5, by=by))
    got = spark.read.parquet(f"{tmp_path}/out")
    kept = {(r.doc_id, r.line_no): r.batch_id for r in got.collect()}
    bits.unpersist()
    lost = {(d, n) for d, n, _, _ in lines} - set(kept)
    if by:
        assert lost == {(4, 2), (4, 3)} and len(set(kept.values())) <= 4
    else:
        assert (4, 3) in lost and len(kept) > 10 and not lost & {(0, 0), (9, 4)}
        assert {b for (d, n), b in kept.items()}.isdisjoint({kept.get((4, 2), -1)})
        for block in {b for *_, b in lines}:  # blocks are never split between micro-batches
            here = [(d, n) for d, n, _, b in lines if b == block]
            assert len({kept.get(x) for x in here}) == 1


def test_landed_batches_are_whole_and_few(spark, tmp_path):
    df = spark.range(5_000).selectExpr("id", "CAST(floor(id / 7) AS BIGINT) AS b")
    landing, files = io.land_whole(df, f"{tmp_path}/in", "b", 3)
    split = spark.read.parquet(landing).select("b", F.input_file_name().alias("file")).distinct().groupBy("b").agg(F.count("*").alias("n"))
    assert split.where("n > 1").count() == 0 and split.count() == 715
    assert spark.read.parquet(landing).select(F.input_file_name()).distinct().count() <= 3 * files
    empty = df.where("id < 0")
    assert spark.read.schema(df.schema).parquet(io.land_whole(empty, f"{tmp_path}/none", "b", 1)[0]).count() == 0


def test_state_is_kept_by_groups_of_symbols(spark):
    """Calls of the state function follow the groups, not the symbols; the signals are the same."""
    q = read_quotes(spark, SF_MID, "user_id")
    landing = io.land_time_slices(q, work_path(spark, "t-land-groups"), 3, "ts")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1, schema=SCHEMA)
    out = work_path(spark, "t-out-groups")
    run = io.run_available(sx.crossover_stream(src, "1 hour", groups=4), "t_groups", "append", out, checkpoint=work_path(spark, "t-ck-groups"))
    assert q.select("symbol").distinct().count() > 100
    assert run.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    max_ts = q.agg(F.max("ts")).collect()[0][0]
    assert rows(sx.finish(spark.read.parquet(out)), COLS) == rows(batch_final(q, max_ts), COLS)
