"""The bucketed rolling sums equal one-window-per-key sums, for any bucket width."""

import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftwood.operators.rolling import rolling_sums, rolling_sums_plain
from driftwood.sources.tables import read_quotes
from conftest import SF_MID, rows

COLS = ["symbol", "event_id", "rn", "sum_10", "prev_sum_10", "sum_40", "prev_sum_40"]


@pytest.mark.parametrize("symbol", ["user_id", "event_type"])
@pytest.mark.parametrize("bucket", ["1 hour", "1 day", "30 days"])
def test_bucketed_equals_plain_on_events(spark, symbol, bucket):
    q = read_quotes(spark, SF_MID, symbol)
    a = rolling_sums(q, "symbol", ("ts", "event_id"), "units", (10, 40), bucket)
    b = rolling_sums_plain(q, "symbol", ("ts", "event_id"), "units", (10, 40))
    assert rows(a, COLS) == rows(b, COLS)


def test_sparse_buckets_and_ties(spark):
    # many empty buckets, buckets with 1 row, and equal timestamps broken by id
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data, eid = [], 0
    for day in range(120):
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5, 60])):
            ts = base + dt.timedelta(days=day, seconds=rnd.choice([0, 0, 30, 3600]))
            data.append((eid, ts, rnd.choice(["A", "B"]), rnd.randint(1, 10_000)))
            eid += 1
    q = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, symbol string, units long")
    a = rolling_sums(q, "symbol", ("ts", "event_id"), "units", (3, 10, 40), "1 day")
    b = rolling_sums_plain(q, "symbol", ("ts", "event_id"), "units", (3, 10, 40))
    cols = ["symbol", "event_id", "rn", "sum_3", "prev_sum_3", "sum_40", "prev_sum_40"]
    assert rows(a, cols) == rows(b, cols)


def test_event_windows_are_keyed_by_symbol_and_bucket(spark):
    """The only Window over events rows is partitioned by (symbol, bucket); the one
    partitioned by symbol alone runs over the per-bucket tail table."""
    q = read_quotes(spark, SF_MID, "user_id")
    plan = rolling_sums(q, "symbol", ("ts", "event_id"), "units")._jdf.queryExecution().optimizedPlan().toString()
    specs = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert any("_b#" in ln.split("windowspecdefinition(")[1].split(",")[1] for ln in specs)


def test_bucket_width_follows_the_hottest_key(spark):
    from driftwood.operators import moving_average as ma
    from driftwood.operators.rolling import bucket_for
    hot = spark.range(0, 20_000).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(1704067200 + id * 4) AS TIMESTAMP_NTZ) AS ts", "IF(id % 10 < 9, 'hot', 'cold') AS symbol",
        "CAST((id * 7919) % 1000 + 1 AS DECIMAL(18,6)) AS price", "((id * 7919) % 1000 + 1) * 1000000 AS units")
    assert bucket_for(hot, "symbol") == "1 day" and bucket_for(hot, "symbol", most_rows=1000) == "1 hour"
    assert bucket_for(hot, "symbol", most_rows=15) == "1 minute" and bucket_for(hot.limit(0), "symbol") == "1 day"
    want, got = (rows(ma.crossover_signals(hot, bucket=b)) for b in ("1 day", "1 hour"))
    assert want == got and want
    largest = hot.groupBy("symbol", F.window("ts", "1 hour")).count().agg(F.max("count")).first()[0]
    assert largest <= 0.05 * 20_000  # rows that a task must hold together
