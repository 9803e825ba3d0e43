"""Quote parsing, rendering and the crossover rule on hand-made inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from driftwood.functions.money import shares_for_budget, signal_message, units
from driftwood.operators import moving_average as ma
from driftwood.sources import quotes as qs


def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse4_rejects_without_failing(spark):
    p = qs.parse_lines4(_lines(spark, "bad", "2024-01-02 09:30:00 AAPL x", "2024-13-02 09:30:00 AAPL 1.0",
                               "2024-01-02 09:30:00 AAPL 185.5", ""))
    got = {r["line"]: r["reject"] for r in p.collect()}
    assert got["bad"] == "field_count"
    assert got["2024-01-02 09:30:00 AAPL x"] == "bad_price"
    assert got["2024-13-02 09:30:00 AAPL 1.0"] == "bad_timestamp"
    assert got[""] == "field_count"
    assert got["2024-01-02 09:30:00 AAPL 185.5"] is None
    ok = qs.accepted(p).collect()
    assert len(ok) == 1 and ok[0]["price"] == Decimal("185.50") and ok[0]["units"] == 185_500_000
    assert ok[0]["ts"] == dt.datetime(2024, 1, 2, 9, 30)


def test_parse3_rejects_four_tokens(spark):
    p = qs.parse_lines3(_lines(spark, "2024-01-02 09:30:00 AAPL 185.5", "2024-01-02 AAPL 185.5"))
    got = {r["line"]: r for r in p.collect()}
    assert got["2024-01-02 09:30:00 AAPL 185.5"]["reject"] == "field_count"
    good = got["2024-01-02 AAPL 185.5"]
    assert good["ok"] and good["symbol"] == "AAPL" and good["ts"] == dt.datetime(2024, 1, 2)


def test_render_parse_roundtrip(spark):
    q = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9, 30, 0), "AAPL", Decimal("185.50"))],
                              "ts timestamp_ntz, symbol string, price decimal(18,6)")
    line = qs.render_lines4(q).collect()[0]["value"]
    assert line == "2024-01-02 09:30:00 AAPL 185.50"
    back = qs.accepted(qs.parse_lines4(qs.render_lines4(q))).collect()[0]
    assert back["price"] == Decimal("185.50") and back["symbol"] == "AAPL"


def test_shares_and_message(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9, 30), "AAPL", 185.5)], "ts timestamp_ntz, s string, p double")
    r = df.select(shares_for_budget(units(F.col("p"))).alias("n"),
                  signal_message(F.col("ts"), F.lit("buy"), F.col("s"), shares_for_budget(units(F.col("p"))),
                                 units(F.col("p"))).alias("msg")).collect()[0]
    assert r["n"] == 539
    assert r["msg"] == "(2024-01-02 09:30:00 buy AAPL) - 539 shares at $185.50"


def _series(spark, prices):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(minutes=i), "S", Decimal(str(p)), int(round(p * 1_000_000))) for i, p in enumerate(prices)]
    return spark.createDataFrame(data, "event_id long, ts timestamp_ntz, symbol string, price decimal(18,6), units long")


def test_prices_are_never_rounded(spark):
    p = qs.parse_lines4(_lines(spark, *[f"2024-01-02 09:30:00 AAPL {x}" for x in ("185.50999", "0.004", "1.1234567", "1e3", "NaN", "123456789012345")]))
    got = {r["line"].split()[-1]: (r["price"], r["reject"]) for r in p.collect()}
    assert got["185.50999"] == (Decimal("185.509990"), None) and got["0.004"] == (Decimal("0.004000"), None)
    assert got["1e3"] == (Decimal("1000.000000"), None)
    assert [got[x][1] for x in ("1.1234567", "NaN", "123456789012345")] == ["bad_scale", "bad_price", "bad_scale"]
    assert [r["value"] for r in qs.render_lines3(qs.accepted(p)).collect()] == [f"2024-01-02 AAPL {x}" for x in ("185.50999", "0.004", "1000.00")]


def test_a_difference_below_a_cent_is_a_signal(spark):
    s = ma.crossover_signals(_series(spark, [10.001] * 40 + [10.004])).collect()
    assert [(r["side"], r["event_id"]) for r in s] == [("buy", 40)]


def test_null_prices_and_symbols_take_no_part(spark):
    rows = _series(spark, [10.0] * 9).unionByName(_series(spark, [10.0] * 41).selectExpr("event_id + 9 AS event_id", "ts", "symbol", "NULL AS price", "NULL AS units"))
    assert ma.rolling_ma(rows, 10).count() == 0 and ma.batch_local_ma(rows, F.lit(0)).count() == 0
    bad = {r["reject"]: r["n"] for r in qs.unusable(rows.union(rows.limit(2).selectExpr("event_id", "ts", "NULL", "price", "units"))).groupBy("reject").agg(
        F.count("*").alias("n")).collect()}
    assert bad == {"null_price": 41, "null_symbol": 2}
    from driftwood.operators import windows as win
    means = win.tumbling_avg(_series(spark, [1.0, 2.0]).unionByName(rows.filter("units IS NULL").limit(1)), "30 days").collect()
    assert [(r["avg_price"], r["n"]) for r in means] == [(1.5, 2)]


def test_warmup_no_signal_before_row_41(spark):
    # 40 rows, MA10 rises above MA40 at the end: still no signal (MAs of row i-1 missing)
    prices = [10.0] * 30 + [20.0] * 10
    assert ma.crossover_signals(_series(spark, prices)).count() == 0


def test_first_possible_signal_is_row_41(spark):
    # equal means at row 40 (flat prices), a rise at row 41 -> one buy at row 41
    prices = [10.0] * 40 + [11.0]
    s = ma.crossover_signals(_series(spark, prices)).collect()
    assert len(s) == 1 and s[0]["side"] == "buy" and s[0]["event_id"] == 40
    # and a drop right after equality gives a sell
    s = ma.crossover_signals(_series(spark, [10.0] * 40 + [9.0])).collect()
    assert len(s) == 1 and s[0]["side"] == "sell"


def test_cross_back_and_forth(spark):
    prices = [10.0] * 40 + [12.0] * 3 + [5.0] * 8
    sides = [r["side"] for r in ma.crossover_signals(_series(spark, prices)).orderBy("ts").collect()]
    assert sides == ["buy", "sell"]
