"""Filters and grouped queries over canonical bars.

Each function takes a bars DataFrame and returns a lazy DataFrame, whichever
store the bars come from. First/last prices use min_by/max_by, which combine on
the map side: no sort and no self-join, and a ticker holding most of the rows
reaches the shuffle as one partial row per map task.
"""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.functions import monday_of, percent_return
from candlekit.schema import BAR_COLUMNS

Moment = str | date | datetime


def moment(value: Moment) -> Column:
    """A time literal; a date without a time of day means its midnight."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def for_ticker(bars: DataFrame, ticker: str | None) -> DataFrame:
    """Bars of one ticker, or all bars for None."""
    return bars if ticker is None else bars.filter(F.col("ticker") == ticker)


def in_range(bars: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Bars in the closed interval [start, end]."""
    return bars.filter(F.col("timestamp").between(moment(start), moment(end)))


def in_window(bars: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Bars in a closed interval that may be open to one or both sides."""
    if start is not None:
        bars = bars.filter(F.col("timestamp") >= moment(start))
    return bars if end is None else bars.filter(F.col("timestamp") <= moment(end))


def price_range(bars: DataFrame, ticker: str, start: Moment, end: Moment) -> DataFrame:
    return in_range(for_ticker(bars, ticker), start, end).select(*BAR_COLUMNS).orderBy("timestamp")


def avg_volume(bars: DataFrame, ticker: str) -> DataFrame:
    """One row: the average bar volume, 0.0 for a ticker without bars."""
    return for_ticker(bars, ticker).agg(F.coalesce(F.avg("volume"), F.lit(0.0)).alias("avg_volume"))


def avg_daily_volume(bars: DataFrame) -> DataFrame:
    """Mean of the daily volume over the days that have bars."""
    daily = bars.groupBy("ticker", F.to_date("timestamp").alias("date")).agg(F.sum("volume").alias("daily_volume"))
    return daily.groupBy("ticker").agg(F.avg("daily_volume").alias("avg_daily_volume")).orderBy("ticker")


def weekly_returns(bars: DataFrame, ticker: str | None = None) -> DataFrame:
    """Return per ISO week; week_start and week_end are the first and last bar."""
    weeks = (
        for_ticker(bars, ticker)
        .groupBy("ticker", monday_of(F.col("timestamp")).alias("monday"))
        .agg(
            F.min("timestamp").alias("week_start"),
            F.max("timestamp").alias("week_end"),
            F.min_by("open", "timestamp").alias("first_open"),
            F.max_by("close", "timestamp").alias("last_close"),
        )
    )
    return weeks.select(
        "ticker",
        "week_start",
        "week_end",
        "first_open",
        "last_close",
        percent_return(F.col("first_open"), F.col("last_close")).alias("weekly_return"),
    ).orderBy("ticker", "week_start")


def first_last_per_day(bars: DataFrame, ticker: str | None = None) -> DataFrame:
    """Open of the first and close of the last bar of each trading day."""
    return (
        for_ticker(bars, ticker)
        .groupBy("ticker", F.to_date("timestamp").alias("date"))
        .agg(
            F.min("timestamp").alias("first_timestamp"),
            F.min_by("open", "timestamp").alias("first_price"),
            F.max("timestamp").alias("last_timestamp"),
            F.max_by("close", "timestamp").alias("last_price"),
        )
        .orderBy("ticker", "date")
    )


def top_tickers_by_return(bars: DataFrame, start: Moment, end: Moment, limit: int = 3) -> DataFrame:
    """The `limit` best tickers by return from first open to last close."""
    if limit < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    ends = (
        in_range(bars, start, end)
        .groupBy("ticker")
        .agg(
            F.min_by("open", "timestamp").alias("first_open"),
            F.max_by("close", "timestamp").alias("last_close"),
        )
        .filter(F.col("first_open").isNotNull() & F.col("last_close").isNotNull())
    )
    returns = ends.select("ticker", percent_return(F.col("first_open"), F.col("last_close")).alias("return_pct"))
    return returns.orderBy(F.desc_nulls_last("return_pct"), "ticker").limit(limit)


def distinct_tickers(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").distinct()


def record_counts(bars: DataFrame) -> DataFrame:
    """Bars and covered time span per ticker."""
    return bars.groupBy("ticker").agg(
        F.count("*").alias("records"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )
