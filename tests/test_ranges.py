"""Prices far out: one answer in batch and stream, sums that don't overflow."""

import datetime as dt

from pyspark.sql import functions as F

from driftwood.functions.money import MAX_PRICE, MAX_UNITS, units
from driftwood.operators import moving_average as ma
from driftwood.operators import windows as win
from driftwood.session import work_path
from driftwood.sources import quotes as qs
from driftwood.streaming import crossover as sx
from driftwood.streaming import io
from conftest import rows

COLS = ["symbol", "ts", "event_id", "side", "price", "shares", "ma10", "ma40"]
T0 = dt.datetime(2024, 1, 2)


def quotes(spark, prices):
    data = [(i, T0 + dt.timedelta(minutes=i), 1, str(p)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, symbol long, p string")
    return df.withColumn("price", F.col("p").cast("decimal(18,6)")).withColumn("units", units(F.col("price"))).drop("p")


def both(spark, q, fast=10, slow=40):
    landing, out = work_path(spark, "t-range"), work_path(spark, "t-range-out")
    end = q.limit(1).select(F.lit(10 ** 6).cast("bigint").alias("event_id"), F.lit(T0 + dt.timedelta(days=2)).cast("timestamp_ntz").alias("ts"), F.lit(2).cast("bigint").alias("symbol"),
                            F.lit(1).cast("decimal(18,6)").alias("price"), F.lit(10 ** 6).cast("bigint").alias("units"))
    q.unionByName(end).coalesce(1).write.parquet(landing)  # the last row moves the watermark
    src = spark.readStream.schema("event_id bigint, ts timestamp_ntz, symbol bigint, price decimal(18,6), units bigint").parquet(landing)
    io.run_available(sx.crossover_stream(src, "1 hour", fast, slow), "t_range", "append", out)
    cols = [c.replace("ma10", f"ma{fast}").replace("ma40", f"ma{slow}") for c in COLS]
    stream, batch = rows(sx.finish(spark.read.parquet(out), fast, slow), cols), rows(ma.crossover_signals(q, fast, slow), cols)
    assert stream == batch
    return batch


def test_prices_up_to_the_limit(spark):
    got = both(spark, quotes(spark, [1] * 40 + [MAX_PRICE]))
    assert [(r[2], r[3]) for r in got] == [(40, "buy")]
    assert both(spark, quotes(spark, [1] * 40 + [3 * 10 ** 11] + [1] * 5)) == []  # left out on both sides
    odd = qs.unusable(quotes(spark, [1, 3 * 10 ** 11, -MAX_PRICE, -MAX_PRICE - 1]))
    assert sorted((r.event_id, r.reject) for r in odd.collect()) == [(1, "out_of_range"), (3, "out_of_range")]


def test_wide_windows_compare_exactly(spark):
    # 150 x 300 times the largest units is beyond 64 bits.
    got = both(spark, quotes(spark, [MAX_PRICE - 1] * 300 + [MAX_PRICE] + [MAX_PRICE - 2] * 4), 150, 300)
    assert [(r[2], r[3]) for r in got] == [(300, "buy"), (302, "sell")]


def test_lines_beyond_the_limit_are_rejected(spark):
    lines = spark.createDataFrame([(f"2024-01-02 09:30:00 A {p}",) for p in ("1000000000", "1000000000.01", "300000000000", "-1e10", "9" * 40, "1.5")], "value string")
    assert [r.reject for r in qs.parse_lines4(lines).collect()] == [None, "bad_range", "bad_range", "bad_range", "bad_scale", None]  # 40 digits don't fit the type at all


def test_window_sums_of_many_large_prices(spark):
    n = 20_000  # times the largest units: beyond 64 bits
    q = spark.range(n).select("id", F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("symbol"), F.lit(MAX_UNITS).cast("bigint").alias("units"))
    got = win.tumbling_avg(q, "10 days").collect()
    assert [(r.avg_price, r.n) for r in got] == [(float(MAX_PRICE), n)]


def test_a_page_with_a_bad_newest_entry_counts_with_the_others(spark, tmp_path):
    path = f"{tmp_path}/pages"
    pages = ['{"symbol": "A", "values": [{"datetime": "nonsense", "close": "9", "id": 3}, {"datetime": "2024-01-02 09:30:00.000000", "close": "5.5", "id": 2}]}',
             '{"symbol": "B", "values": []}', '{"symbol": "C", "values": [{"datetime": "2024-01-02 09:30:00.000000", "close": "x", "id": 1}]}', '{"symbol": "D"}']
    spark.createDataFrame([(p,) for p in pages], "value string").coalesce(1).write.text(path)
    assert [(r.symbol, r.line) for r in qs.latest_from_json(spark, path).collect()] == [("A", "A,5.50")]
    assert sorted((r.symbol, r.reject) for r in qs.json_quotes(spark, path).filter("reject is not null").collect()) == [
        ("A", "bad_timestamp"), ("B", "no_values"), ("C", "bad_price"), ("D", "no_values")]
