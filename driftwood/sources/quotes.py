"""Quote lines: rendering, tolerant parsing, CSV and JSON landing/scan.

Line formats (single spaces):
* 4 fields: ``yyyy-MM-dd HH:mm:ss SYMBOL PRICE``
* 3 fields: ``yyyy-MM-dd SYMBOL PRICE`` (date only; the time of day is dropped)

A price with more decimals than its type holds is rejected (``bad_scale``), not rounded.

Parsers never fail on malformed input: a bad line yields ``ok = false`` with a
``reject`` reason and null typed fields; ``accepted``/``rejected`` split the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import MAX_PRICE, MAX_UNITS, PRICE_TYPE, price_text, units
from ..functions.timefmt import SECOND_FMT


def line4() -> Column:
    """``date time symbol price`` from the quote columns ``ts, symbol, price``."""
    return F.concat_ws(" ", F.date_format("ts", SECOND_FMT), F.col("symbol").cast("string"),
                       price_text(F.col("price")))


def render_lines4(quotes: DataFrame) -> DataFrame:
    """``date time symbol price`` lines (feeder format of a CSV replay)."""
    return quotes.select(line4().alias("value"))


def render_lines3(quotes: DataFrame) -> DataFrame:
    """``date symbol price`` lines (history replay format: ``datetime.date()``, symbol, price)."""
    return quotes.select(
        F.concat_ws(" ", F.to_date("ts").cast("string"), F.col("symbol").cast("string"),
                    price_text(F.col("price"))).alias("value"))


def _tok(arr: Column, i: int) -> Column:
    return F.get(arr, F.lit(i))


def _scale_fits(token: Column) -> Column:
    """Whether the price type holds the written number exactly (it has to be a number)."""
    return F.coalesce(token.try_cast("decimal(38,18)") == token.try_cast(PRICE_TYPE), F.lit(False))


def _reject(fields: Column, ts: Column, symbol: Column, token: Column) -> Column:
    """Why a line is rejected; null if it isn't."""
    return (F.when(fields, F.lit("field_count"))
            .when(ts.isNull(), F.lit("bad_timestamp"))
            .when(symbol == "", F.lit("bad_symbol"))
            .when(token.try_cast("double").isNull() | token.rlike("^[+-]?[a-zA-Z]"), F.lit("bad_price"))
            .when(~_scale_fits(token), F.lit("bad_scale"))
            .when(F.abs(token.try_cast("double")) > MAX_PRICE, F.lit("bad_range")))


def usable(quotes: DataFrame, *, value: str = "units") -> DataFrame:
    """The quotes that batch and stream work on alike: those with a symbol, a time and a price in range."""
    return quotes.filter(F.col("symbol").isNotNull() & F.col("ts").isNotNull() & F.col(value).between(-MAX_UNITS, MAX_UNITS))


def unusable(quotes: DataFrame, *, value: str = "units") -> DataFrame:
    """The others, with the reason."""
    reason = (F.when(F.col("symbol").isNull(), F.lit("null_symbol")).when(F.col("ts").isNull(), F.lit("null_time"))
              .when(F.col(value).isNull(), F.lit("null_price")).when(~F.col(value).between(-MAX_UNITS, MAX_UNITS), F.lit("out_of_range")))
    return quotes.withColumn("reject", reason).filter(F.col("reject").isNotNull())


def parse_lines4(lines: DataFrame, col: str = "value") -> DataFrame:
    toks = F.split(F.col(col), " ")
    ts = F.try_to_timestamp(F.concat_ws(" ", _tok(toks, 0), _tok(toks, 1)), F.lit(SECOND_FMT))
    price = _tok(toks, 3).try_cast(PRICE_TYPE)
    reject = _reject(F.size(toks) != 4, ts, _tok(toks, 2), _tok(toks, 3))
    return lines.select(
        F.col(col).alias("line"),
        ts.cast("timestamp_ntz").alias("ts"),
        _tok(toks, 2).alias("symbol"),
        price.alias("price"),
        reject.alias("reject"),
    ).withColumn("ok", F.col("reject").isNull())


def parse_lines3(lines: DataFrame, col: str = "value") -> DataFrame:
    toks = F.split(F.col(col), " ")
    ts = F.try_to_timestamp(_tok(toks, 0), F.lit("yyyy-MM-dd"))
    price = _tok(toks, 2).try_cast(PRICE_TYPE)
    reject = _reject(F.size(toks) != 3, ts, _tok(toks, 1), _tok(toks, 2))
    return lines.select(
        F.col(col).alias("line"),
        ts.cast("timestamp_ntz").alias("ts"),
        _tok(toks, 1).alias("symbol"),
        price.alias("price"),
        reject.alias("reject"),
    ).withColumn("ok", F.col("reject").isNull())


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").select("ts", "symbol", "price", units(F.col("price")).alias("units"))


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("ok")).select("line", "reject")


# ---------------------------------------------------------------- CSV quotes

CSV_SCHEMA = "datetime string, stock string, close string"


def land_quote_csv(quotes: DataFrame, path: str) -> str:
    """Write quotes as header CSV ``datetime, stock, close`` (the feeder's input file)."""
    (quotes.select(F.date_format("ts", SECOND_FMT).alias("datetime"),
                   F.col("symbol").cast("string").alias("stock"),
                   price_text(F.col("price")).alias("close"))
     .write.mode("overwrite").option("header", True).csv(path))
    return path


def scan_quote_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV -> typed ``(datetime timestamp_ntz, stock, close decimal)``; bad rows -> nulls."""
    raw = spark.read.schema(CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return raw.select(
        F.try_to_timestamp(F.col("datetime"), F.lit(SECOND_FMT)).cast("timestamp_ntz").alias("datetime"),
        F.col("stock"),
        F.col("close").try_cast(PRICE_TYPE).alias("close"),
    )


# ---------------------------------------------------------------- JSON quotes

JSON_SCHEMA = "symbol string, values array<struct<datetime:string, close:string, id:bigint>>"


def land_quote_json(quotes: DataFrame, path: str, page_rows: int = 16) -> str:
    """Write API-style JSON pages ``{"symbol", "values": [newest first]}``.

    A page holds the quotes of one symbol whose ``event_id`` falls in one block of
    ``page_rows`` ids, so every collected list is bounded by ``page_rows``.
    """
    page = F.floor(F.col("event_id") / page_rows)
    (quotes.groupBy(F.col("symbol").cast("string").alias("symbol"), page.alias("page"))
     .agg(F.sort_array(F.collect_list(F.struct(
         F.col("ts").alias("k_ts"), F.col("event_id").alias("k_id"),
         F.date_format("ts", SECOND_FMT + ".SSSSSS").alias("datetime"),
         price_text(F.col("price")).alias("close"))), asc=False).alias("v"))
     .select("symbol", F.transform("v", lambda s: F.struct(s["datetime"].alias("datetime"),
                                                           s["close"].alias("close"), s["k_id"].alias("id"))).alias("values"))
     .write.mode("overwrite").json(path))
    return path


def json_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of every page: ``symbol, ts, close, id`` and ``reject`` (null, or why the entry is left out).  A page
    without entries is one row with ``no_values``."""
    pages = spark.read.schema(JSON_SCHEMA).json(path)
    rows = pages.select("symbol", F.explode_outer("values").alias("v"))
    ts = F.try_to_timestamp(F.col("v.datetime"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    close = F.col("v.close").try_cast(PRICE_TYPE)
    reject = (F.when(F.col("v").isNull(), F.lit("no_values")).when(ts.isNull(), F.lit("bad_timestamp"))
              .when(F.col("v.close").try_cast("double").isNull(), F.lit("bad_price"))
              .when(~_scale_fits(F.col("v.close")), F.lit("bad_scale"))
              .when(F.abs(F.col("v.close").try_cast("double")) > MAX_PRICE, F.lit("bad_range")))
    return rows.select("symbol", ts.alias("ts"), close.alias("close"), F.col("v.id").alias("id"), reject.alias("reject"))


def latest_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Newest quote per symbol over all entries of all pages; a page whose first entry is bad still counts
    with its others."""
    rows = json_quotes(spark, path).filter(F.col("reject").isNull())
    return (rows.groupBy("symbol")
            .agg(F.max_by(F.struct("ts", "close"), F.struct("ts", "id", "close")).alias("m"))
            .select("symbol", F.col("m.ts").alias("ts"), F.col("m.close").alias("close"),
                    F.concat_ws(",", "symbol", price_text(F.col("m.close"))).alias("line")))
