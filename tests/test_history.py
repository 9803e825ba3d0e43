"""Backfill planning and assembly."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftwood.sources import history as hist
from driftwood.sources.tables import read_quotes
from conftest import SF_MID, rows


def test_chunk_plan_reference_range(spark):
    h = spark.createDataFrame([(dt.datetime(2021, 1, 1, 12),), (dt.datetime(2024, 11, 30, 9),)], "ts timestamp_ntz")
    c = hist.backfill_chunks(h).orderBy("chunk_no").collect()
    assert len(c) == 4
    assert c[0]["fetch_start"] == dt.datetime(2021, 1, 1)
    assert c[0]["fetch_end"] == dt.datetime(2022, 1, 1, 0, 30)
    assert c[-1]["fetch_end"] == dt.datetime(2024, 12, 1)  # clipped at the end


@pytest.mark.parametrize("step", ["1 day", "3 days", "7 days", "365 days"])
def test_dedup_restores_history(spark, step):
    h = read_quotes(spark, SF_MID, "event_type").select("event_id", "ts", "symbol", "price")
    bf = hist.backfill_overlap(h, step, "30 minutes")
    assert rows(hist.dedup_overlap(bf)) == rows(h)
    # every duplicate sits in an overlap: within 30 minutes after a chunk start
    dup = bf.groupBy("event_id").count().filter("count > 1")
    assert dup.filter(F.col("count") > 2).count() == 0


def test_union_sorted_is_ordered(spark):
    h = read_quotes(spark, SF_MID, "event_type").select("event_id", "ts", "symbol", "price")
    u = hist.union_sorted(h.filter("symbol = 'view'"), h.filter("symbol = 'click'")).collect()
    keys = [(r["ts"], r["symbol"], r["event_id"]) for r in u]
    assert keys == sorted(keys)


def test_union_keeps_every_symbol(spark):
    h = read_quotes(spark, SF_MID, "event_type").select("event_id", "ts", "symbol", "price").withColumn(
        "symbol", F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 11 == 1, "sixth").otherwise(F.col("symbol")))
    group = F.pmod(F.xxhash64("symbol"), F.lit(2))
    assert rows(hist.union_sorted(h.filter(group == 0), h.filter(group == 1))) == rows(h)


def test_no_chunks_are_a_typed_empty_table(spark):
    out = hist.assemble_chunks([], spark, "event_id bigint, ts timestamp_ntz, price decimal(18,6)")
    assert out.columns == ["event_id", "ts", "price", "chunk_no", "symbol"] and out.collect() == []
    with pytest.raises(ValueError):
        hist.assemble_chunks([])


def test_manifest_of_good_and_bad_chunk_files(spark, tmp_path):
    path = f"{tmp_path}/chunks"
    for no, lines in {0: ["datetime,stock,high", "2024-01-02 09:30:00.000000,A,1.5", "2024-01-02 09:31:00.000000,A,2"], 2: ["datetime,stock,high"],
                      3: ["\x00\x01garbage", "<html>"], 4: ["datetime,stock,high", "2024-01-02 09:30:00.000000,A,1", "x,A,1", "2024-01-02 09:30:00.000000,A"],
                      5: [], 9: ["2024-01-02 09:30:00.000000,Z,1"]}.items():
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{path}/chunk_no={no}")
    manifest = spark.range(6).withColumnRenamed("id", "chunk_no")
    got = {r.chunk_no: (r.status, r.n_rows, r.n_bad) for r in hist.manifest_report(spark, path, manifest).collect()}
    assert {k: v for k, v in got.items() if k != 5} == {0: ("ok", 2, 0), 1: ("absent", 0, 0), 2: ("empty", 0, 0), 3: ("failed", 0, 2), 4: ("partial", 1, 2)}
    assert got[5][0] in ("absent", "empty")
    assert sorted((r.chunk_no, str(r.price)) for r in hist.read_chunk_files(spark, path, manifest).collect()) == [(0, "1.500000"), (0, "2.000000"), (4, "1.000000")]
    nowhere = f"{tmp_path}/nowhere"
    assert {r.status for r in hist.manifest_report(spark, nowhere, manifest).collect()} == {"absent"}
    assert hist.read_chunk_files(spark, nowhere, manifest).collect() == []


def test_a_reader_sees_one_whole_version(spark, tmp_path):
    path = f"{tmp_path}/snap"

    def version(n):
        return spark.range(50).selectExpr("concat('S', id) AS symbol", f"CAST({n} AS DECIMAL(18,6)) AS price")
    assert hist.read_snapshot(spark, path).collect() == []
    for n in range(4):
        hist.publish_snapshot(version(n), path, n)
        reader = hist.read_snapshot(spark, path)
        version(n + 100).write.parquet(f"{path}/version-{n + 1}")  # the next one, half done: written but not published
        assert {int(r.price) for r in hist.read_snapshot(spark, path).collect()} == {n}
        hist.publish_snapshot(version(n + 1), path, n + 1)  # done again and published
        assert {int(r.price) for r in hist.read_snapshot(spark, path).collect()} == {n + 1}
        got = reader.collect()  # opened before: still one whole version
        assert len(got) == 50 and {int(r.price) for r in got} == {n}


def test_running_snapshot_keeps_symbols_that_did_not_change(spark, tmp_path):
    path = f"{tmp_path}/snap"
    write = hist.snapshot_writer(path)
    schema = "symbol string, ts timestamp_ntz, event_id bigint, price decimal(18,6)"
    t = dt.datetime(2024, 1, 2)
    from decimal import Decimal
    write(spark.createDataFrame([("A", t, 1, Decimal(1)), ("B,x", t, 2, Decimal(2))], schema), 0)
    write(spark.createDataFrame([("A", t, 3, Decimal(3))], schema), 1)
    write(spark.createDataFrame([("A", t, 3, Decimal(4))], schema), 1)  # a batch that is run again
    assert sorted(r.value for r in hist.snapshot_lines(hist.read_snapshot(spark, path)).collect()) == ["A,3.00", "B,x,2.00"]
