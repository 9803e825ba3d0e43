"""Input spreading and replay landing: where rows go, not what they compute."""

import os

from pyspark.sql import functions as F

from driftwood.session import local_fs_path, ship_package, work_path
from driftwood.sources.tables import read_documents, read_quotes, read_table, spread
from driftwood.streaming import io
from conftest import SF_SMALL, rows


def test_spread_under_split_input(spark):
    raw = read_table(spark, SF_SMALL, "documents")
    assert raw.rdd.getNumPartitions() == 1  # one row group
    d = read_documents(spark, SF_SMALL)
    assert d.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert rows(d.select("doc_id", "text")) == rows(raw.select("doc_id", "text"))


def test_spread_leaves_split_input_alone(spark):
    df = spark.range(0, 1000, 1, 16)
    assert spread(df, "id", min_partitions=8) is df


def test_landing_slices_are_ordered_and_complete(spark):
    q = read_quotes(spark, SF_SMALL, "user_id")
    path = io.land_time_slices(q, work_path(spark, "t-slices"), 4, "ts")
    files = sorted((f for f in os.listdir(local_fs_path(path)) if f.endswith(".parquet")),
                   key=lambda f: os.path.getmtime(os.path.join(local_fs_path(path), f)))
    assert len(files) == 4
    spans = []
    for f in files:
        part = spark.read.parquet(os.path.join(path, f))
        spans.append(part.agg(F.min("ts"), F.max("ts")).collect()[0])
    # in modification-time order, each slice starts after the previous one ends
    for (_, prev_hi), (lo, _) in zip(spans, spans[1:]):
        assert prev_hi < lo
    landed = spark.read.parquet(path)
    assert rows(landed) == rows(q.select(*landed.columns))


def test_landing_bigint_key(spark):
    lines = spark.range(0, 1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("line"))
    path = io.land_time_slices(lines, work_path(spark, "t-slices-int"), 3, "doc_id")
    landed = spark.read.parquet(path)
    assert landed.count() == 1000 and landed.select("doc_id").distinct().count() == 1000


def test_landing_keeps_rows_without_a_time(spark):
    q = read_quotes(spark, SF_SMALL, "user_id")
    q = q.withColumn("ts", F.when(F.col("event_id") % 10 > 0, F.col("ts")))
    for n in (1, 4):
        landed = spark.read.parquet(io.land_time_slices(q, work_path(spark, "t-slices-null"), n, "ts"))
        assert rows(landed) == rows(q.select(*landed.columns))


def test_landing_scans_with_all_tasks(spark):
    wide = spark.range(0, 10_000, 1, 8).select(F.timestamp_seconds("id").alias("ts"), "id")
    assert io.slices_for(wide, 4) == 8
    landed = spark.read.parquet(io.land_time_slices(wide, work_path(spark, "t-slices-wide"), 8, "ts"))
    assert landed.count() == 10_000


def test_cluster_needs_a_shared_folder(spark):
    import pytest
    from driftwood import session

    class Context:
        master = "spark://host"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": None}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_ship_package_is_idempotent(spark):
    ship_package(spark)
    ship_package(spark)
    assert getattr(spark.sparkContext, "_driftwood_shipped", False)


def test_state_partitions_apply_to_the_query_only(spark):
    import glob
    import json
    q = read_quotes(spark, SF_SMALL, "event_type")
    landing = io.land_time_slices(q, work_path(spark, "t-sp-land"), 2, "ts")
    src = io.line_source(spark, "parquet", landing, max_files_per_trigger=1,
                         schema="event_id bigint, ts timestamp_ntz, symbol string, price decimal(18,6), units bigint")
    agg = (src.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
           .groupBy("symbol", F.window("ts", "1 day")).agg(F.sum("units").alias("s")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ck = work_path(spark, "t-sp-ck")
    io.run_available(agg, "t_sp", "append", work_path(spark, "t-sp-out"), checkpoint=ck, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    first = sorted(glob.glob(f"{local_fs_path(ck)}/offsets/*"))[0]
    meta = json.loads(open(first).read().splitlines()[1])
    assert meta["conf"]["spark.sql.shuffle.partitions"] == "3"
