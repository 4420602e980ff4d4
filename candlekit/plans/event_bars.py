"""Bars derived from general-purpose event and order tables.

Used by the registered queries, the tests and the bench, whose input has no
table of bars.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlekit.functions import symbol
from candlekit.operators.upsert import number_rows
from candlekit.schema import BAR_COLUMNS


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _hour(timestamp):
    return F.to_date(timestamp).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(timestamp))


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars, one ticker per event type."""
    events = _table(spark, folder, "events").select(
        symbol(F.col("event_type")).alias("ticker"), "ts", _hour("ts").alias("timestamp"), "value"
    )
    return (
        events.groupBy("ticker", "timestamp")
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count("*").alias("volume"),
        )
        .select(*BAR_COLUMNS)
    )


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a one-price bar, one ticker per event type."""
    return _ticks(_table(spark, folder, "events"), symbol(F.col("event_type")))


def user_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a one-price bar, one ticker per user."""
    return _ticks(_table(spark, folder, "events"), F.concat(F.lit("U"), F.col("user_id")))


def _ticks(events: DataFrame, ticker) -> DataFrame:
    price = F.col("value")
    return events.select(
        ticker.alias("ticker"),
        F.col("ts").alias("timestamp"),
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.lit(1).cast("bigint").alias("volume"),
    )


def supplier_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of the unit price, one ticker per supplier."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    # Order, line and part as one number: no two lines of a supplier's day share it.
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)")
    line = line * F.lit(10**10) + F.col("l_partkey")
    return (
        _table(spark, folder, "lineitem")
        .groupBy(
            F.concat(F.lit("S"), F.col("l_suppkey")).alias("ticker"),
            F.col("l_shipdate").alias("timestamp"),
        )
        .agg(
            F.min_by(price, line).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, line).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(*BAR_COLUMNS)
    )


def event_tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Ticker metadata of the event bars: ticker_id, symbol, name, exchange."""
    names = _table(spark, folder, "events").select(symbol(F.col("event_type")).alias("symbol")).distinct()
    described = names.select("symbol", F.concat("symbol", F.lit(" events")).alias("name"), F.lit("EVENTS").alias("exchange"))
    return number_rows(described, "symbol", "ticker_id", 1).select("ticker_id", "symbol", "name", "exchange")


def defective_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a bar in text form, with one kind of defect per price band.

    Times are cut to the hour, so the events of an hour are duplicates.
    """
    value = F.col("value")

    def band(low: int, high: int, defect, otherwise):
        return F.when((value >= low) & (value < high), defect).otherwise(otherwise)

    text = value.cast("string")
    at = F.concat(F.col("ts").cast("string").substr(1, 13), F.lit(":00:00"))
    volume = F.concat(F.col("event_id").cast("string"), F.lit(".7"))
    return _table(spark, folder, "events").select(
        band(8, 9, F.lit("  "), F.concat(F.lit(" "), "event_type")).alias("ticker"),
        F.when(value < 1, "invalid_date").when(value < 2, None).otherwise(at).alias("timestamp"),
        band(2, 3, F.lit("abc"), text).alias("open"),
        band(3, 4, F.concat(F.lit("-"), text), text).alias("high"),
        band(4, 5, F.lit("NaN"), text).alias("low"),
        band(5, 6, F.lit("inf"), text).alias("close"),
        band(6, 7, F.lit("many"), band(7, 8, F.lit("-5"), volume)).alias("volume"),
    )
