"""

The input has no table of bars; `candlekit.plans.event_bars` derives bars from
the events and lineitem tables. Every query covers the whole derived table.
Queries about stores write them to a new folder below spark.checkpoint.dir and
return what is read back.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from candlekit import QueryEngine, StarStore, WideStore, build_all_assets, load_and_validate  # noqa: E402
from candlekit.operators import integrity, prices, reconcile, rolling, upsert, validation  # noqa: E402
from candlekit.plans.event_bars import (  # noqa: E402
    defective_rows,
    event_bars,
    event_ticks,
    event_tickers,
    supplier_bars,
    user_ticks,
)
from candlekit.schema import ValidationError  # noqa: E402
from candlekit.session import staging_path  # noqa: E402
from candlekit.sources.files import write_text  # noqa: E402
from candlekit.sources.csv_bars import load_bars_csv, load_tickers_csv  # noqa: E402

# The training-data operators can be taken out together with their pipeline.
try:
    import corpus_pipeline
    from candlekit.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("candlekit.llm"):
        raise
    corpus_pipeline = llm = None

FOLDER = "/root/testdata/sf0.001"
START, END = "2024-01-05", "2024-01-25 12:00:00"
SPLIT = "2024-01-15"
SLOT = 6 * 3600
DIGITS = 6


def entry(spark: SparkSession) -> DataFrame:
    """Top tickers by return over the event bars."""
    return prices.top_tickers_by_return(event_bars(spark, FOLDER), START, END)


# --- queries ------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Standard deviations and means differ between engines in the last bits."""
    return df.withColumns({name: F.round(name, DIGITS) for name in columns})


def _on(source, query, *args, rounded=(), **kwargs) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _rounded(query(source(spark, folder), *args, **kwargs), *rounded)


def _star(spark: SparkSession, *batches: DataFrame) -> StarStore:
    store = StarStore(spark, staging_path(spark, "star"))
    for batch in batches:
        store.upsert(batch)
    return store


def _wide(spark: SparkSession, bars: DataFrame, partitioned: bool = True) -> WideStore:
    store = WideStore(spark, staging_path(spark, "wide"), partitioned)
    store.save(bars)
    return store


def _old_and_changed(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars up to a later day, and a batch that changes the volume from an earlier day on."""
    old = bars.filter(F.col("timestamp") < prices.moment("2024-01-20"))
    changed = bars.filter(F.col("timestamp") >= prices.moment(SPLIT)).withColumn("volume", F.col("volume") * 2)
    return old, changed


def merged_bars(spark, folder):
    return upsert.merge(*_old_and_changed(event_bars(spark, folder)), ["ticker", "timestamp"])


def star_upsert(spark, folder):
    return _star(spark, *_old_and_changed(event_bars(spark, folder))).bars()


def wide_upsert(spark, folder):
    old, changed = _old_and_changed(event_bars(spark, folder))
    store = _wide(spark, old)
    store.upsert(changed)
    return store.bars()


def dimension_upsert(spark, folder):
    """Users seen before a day are known; all others are new."""
    ticks = user_ticks(spark, folder)
    seen = ticks.filter(F.col("timestamp") < prices.moment("2024-01-03"))
    store = StarStore(spark, staging_path(spark, "star"))
    for batch in (seen, ticks):
        store.add_tickers(batch.select(F.col("ticker").alias("symbol")))
    return store.tickers().select("ticker_id", "symbol", "name", "exchange")


def dimension_metadata(spark, folder):
    """The ticker metadata file as dimension rows."""
    path = staging_path(spark, "tickers-csv")
    event_tickers(spark, folder).write.option("header", True).csv(path)
    return load_tickers_csv(spark, path)


def star_view(spark, folder):
    return _star(spark, supplier_bars(spark, folder)).bars()


def star_price_range(spark, folder):
    engine = QueryEngine(star=_star(spark, event_bars(spark, folder)))
    return engine.get_price_range("VIEW", START, END)


def wide_price_range(spark, folder):
    engine = QueryEngine(wide=_wide(spark, event_bars(spark, folder)))
    return engine.get_price_range("VIEW", START, END, source="wide")


def last_writes(spark, folder):
    """Of a user's events within an hour, the one with the largest id."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    rows = events.select(
        F.concat(F.lit("U"), F.col("user_id")).alias("ticker"),
        (F.to_date("ts").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour("ts"))).alias("timestamp"),
        F.col("value").alias("close"),
        F.col("event_id").alias("volume"),
    )
    return upsert.last_write(rows, ["ticker", "timestamp"], "volume")


def _first_signups(events: DataFrame) -> DataFrame:
    return events.filter((F.col("event_type") == "signup") & (F.col("ts") < prices.moment("2024-01-03")))


def star_audit(spark, folder):
    """Prices per second and user; the dimension has the first sign-ups."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    value = F.when(F.col("value") > 0.5, F.col("value"))
    facts = events.select(
        F.col("user_id").alias("ticker_id"),
        F.col("ts").cast("string").substr(1, 19).cast("timestamp_ntz").alias("timestamp"),
        F.col("value").alias("open"),
        F.col("value").alias("high"),
        value.alias("low"),
        F.col("value").alias("close"),
        F.col("event_id").alias("volume"),
    )
    tickers = _first_signups(events).select(
        F.col("user_id").alias("ticker_id"), F.concat(F.lit("U"), F.col("user_id")).alias("symbol")
    )
    return integrity.audit_star(facts, tickers)


def orphan_prices(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").withColumnRenamed("user_id", "ticker_id")
    return integrity.orphan_prices(events, _first_signups(events))


def partition_roundtrip(spark, folder):
    return _wide(spark, user_ticks(spark, folder)).bars()


def partition_scan(spark, folder):
    return _wide(spark, event_ticks(spark, folder)).bars("PURCHASE")


def flat_roundtrip(spark, folder):
    return _wide(spark, supplier_bars(spark, folder), partitioned=False).bars()


def appended_twice(spark, folder):
    store = _wide(spark, event_bars(spark, folder))
    store.save(event_bars(spark, folder))
    return prices.record_counts(store.bars())


def store_integrity(spark, folder):
    check = _wide(spark, user_ticks(spark, folder)).verify_integrity()
    return check.partitions.select("ticker", "records", "bad_files")


def store_summary(spark, folder):
    check = _wide(spark, user_ticks(spark, folder)).verify_integrity()
    return check.summary


def compare_sources(spark, folder):
    """The wide store got the later bars twice."""
    bars = event_bars(spark, folder)
    wide = _wide(spark, bars)
    wide.save(bars.filter(F.col("timestamp") >= prices.moment(SPLIT)))
    return reconcile.compare_bars(_star(spark, bars).bars("VIEW", START, END), wide.bars("VIEW"), "VIEW", START, END)


def compare_equal_sources(spark, folder):
    bars = event_bars(spark, folder)
    return reconcile.compare_bars(
        _star(spark, bars).bars("ERROR", START, END), _wide(spark, bars).bars("ERROR"), "ERROR", START, END
    )


def _csv_files(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Event bars and their tickers as CSV, with headers and tickers to normalize."""
    bars = event_bars(spark, folder).select(
        F.concat(F.lit(" "), F.lower("ticker")).alias("Ticker"),
        F.col("timestamp").cast("string").alias(" Timestamp "),
        F.col("open").alias("OPEN"),
        "high",
        "low",
        F.col("close").alias("Close"),
        F.col("volume").cast("double").alias("volume "),
    )
    paths = staging_path(spark, "bars-csv"), staging_path(spark, "tickers-csv")
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    bars.write.options(**options).csv(paths[0])
    event_tickers(spark, folder).write.options(**options).csv(paths[1])
    return paths


def csv_load(spark, folder):
    return load_bars_csv(spark, _csv_files(spark, folder)[0])


def csv_load_with_metadata(spark, folder):
    return load_and_validate(spark, *_csv_files(spark, folder))


def csv_timestamp_patterns(spark, folder):
    """Times before a day are written in another form, those of one hour in a third."""
    bars, at = event_bars(spark, folder), F.col("timestamp")
    text = (
        F.when(F.hour(at) == 3, F.date_format(at, "yyyyMMdd HH.mm"))
        .when(at < prices.moment(SPLIT), F.date_format(at, "dd/MM/yyyy HH:mm"))
        .otherwise(at.cast("string"))
    )
    path = staging_path(spark, "bars-csv")
    bars.withColumn("timestamp", text).write.option("header", True).csv(path)
    return load_bars_csv(spark, path, timestamp_format=["dd/MM/yyyy HH:mm", "yyyyMMdd HH.mm"])


def csv_extra_columns(spark, folder):
    """A column with a dot in its name goes through the file, the load and an upsert."""
    path = staging_path(spark, "bars-csv")
    event_bars(spark, folder).withColumn("Adj.Close", F.col("close")).write.option("header", True).csv(path)
    store = WideStore(spark, staging_path(spark, "wide"))
    for _ in range(2):
        store.upsert(load_bars_csv(spark, path), validated=True)
    bars = store.bars()
    return bars.toDF(*bars.columns[:-1], "adj_close").withColumn("adj_close", F.col("adj_close").cast("double"))


def csv_quoted_line_breaks(spark, folder):
    """Every third ticker, and a note, hold line breaks, commas and quotes."""
    bars, volume = event_bars(spark, folder), F.col("volume")
    note = F.when(volume % 3 == 0, F.concat(F.lit('first "'), "ticker", F.lit('"\n\n, second')))
    path = staging_path(spark, "bars-csv")
    ticker = F.concat(F.lit("\n"), "ticker", F.lit("\n "))
    rows = bars.withColumns({"ticker": F.when(volume % 3 == 1, ticker).otherwise(F.col("ticker")), "note": note})
    rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return load_bars_csv(spark, path)


def csv_inferred_format(spark, folder):
    """Nobody names the format of the times: day first, and minutes."""
    bars = event_bars(spark, folder)
    path = staging_path(spark, "bars-csv")
    bars.withColumn("timestamp", F.date_format("timestamp", "dd/MM/yyyy HH:mm")).write.option("header", True).csv(path)
    return load_bars_csv(spark, path)


def upsert_ordered_text_times(spark, folder):
    """Every bar comes twice, with its time in two spellings; the later one, with a volume more by one, counts."""
    bars = event_bars(spark, folder).withColumn("seq", F.lit(1))
    later = bars.withColumns({"seq": F.lit(2), "volume": F.col("volume") + 1})
    batch = bars.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).unionByName(
        later.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    stores = StarStore(spark, staging_path(spark, "star")), WideStore(spark, staging_path(spark, "wide"))
    for store in stores:
        store.upsert(batch, order="seq")
    sides = [store.bars().withColumn("source", F.lit(name)) for name, store in zip(("star", "wide"), stores)]
    return sides[0].unionByName(sides[1])


def wide_period_upsert(spark, folder):
    """A table with a folder per ticker and month, corrected in part."""
    old, changed = _old_and_changed(event_bars(spark, folder))
    store = WideStore(spark, staging_path(spark, "wide"), period="month")
    store.save(old)
    store.upsert(changed)
    return store.bars()


def wide_period_range(spark, folder):
    """A range that opens a few of the months of one ticker."""
    store = WideStore(spark, staging_path(spark, "wide"), period="month")
    bars = supplier_bars(spark, folder)
    store.save(bars.filter(F.col("ticker").isin("S1", "S7")))
    return QueryEngine(wide=store).get_price_range("S7", "1995-02-10", "1995-05-20", source="wide")


def top_tickers_null_prices(spark, folder):
    """The first open of some tickers is null: they have no return and are left out."""
    bars = event_bars(spark, folder)
    first = bars.filter(F.col("timestamp") >= prices.moment(START)).groupBy("ticker").agg(F.min("timestamp").alias("at"))
    hidden = first.filter("ticker < 'P'")
    holes = bars.join(hidden, "ticker", "left").withColumn("open", F.when(F.col("timestamp") == F.col("at"), None).otherwise(F.col("open")))
    return prices.top_tickers_by_return(holes.drop("at"), START, END, 10)


def damaged_store(spark, folder):
    """One file of each ticker is overwritten with what is not Parquet."""
    store = _wide(spark, event_bars(spark, folder))
    store.save(event_bars(spark, folder))
    first = integrity.list_files(spark, store.path).groupBy("ticker").agg(F.min("file").alias("file"))
    for row in first.filter("ticker < 'P'").collect():  # event types
        write_text(spark, row["file"], "not parquet")
    return store.verify_integrity().partitions.select("ticker", "files", "bad_files", "records")


def missing_columns(spark, folder):
    """What the check of required columns says about the raw test rows without some of them."""
    raw = defective_rows(spark, folder).drop("close", "volume")
    try:
        validation.require_columns(raw.columns)
        found = ""
    except ValidationError as error:
        found = str(error)
    return raw.agg(F.count("*").alias("records")).select("records", F.lit(found).alias("message"))


def dimension_created(spark, folder):
    """Every dimension row says when it was made: not before the load, not after it."""
    start = spark.range(1).select(F.current_timestamp()).first()[0]
    store = StarStore(spark, staging_path(spark, "star"))
    store.add_tickers(user_ticks(spark, folder).select(F.col("ticker").alias("symbol")))
    at = F.col("created_at")
    return store.tickers().agg(
        F.count("*").alias("records"), F.count_if((at >= F.lit(start)) & (at <= F.current_timestamp())).alias("in_time")
    )


def wide_upsert_extra_columns(spark, folder):
    """The second batch lacks a column that the stored rows keep."""
    old, changed = _old_and_changed(event_bars(spark, folder))
    store = _wide(spark, old.withColumn("sector", F.concat("ticker", F.lit("-1"))))
    store.upsert(changed)
    return store.bars()


def upsert_twice_same_rows(spark, folder):
    old, changed = _old_and_changed(event_bars(spark, folder))
    store = _wide(spark, old)
    for _ in range(2):
        store.upsert(changed)
    return store.bars()


def text_timestamps_saved(spark, folder):
    bars = event_bars(spark, folder)
    return _wide(spark, bars.withColumn("timestamp", F.col("timestamp").cast("string"))).bars()


def flat_replaced(spark, folder):
    store = _wide(spark, supplier_bars(spark, folder), partitioned=False)
    store.save(event_bars(spark, folder))
    return store.bars()


def build_all(spark, folder):
    built = build_all_assets(
        spark, *_csv_files(spark, folder), staging_path(spark, "star"), staging_path(spark, "wide")
    )
    sides = [built[name].bars().withColumn("source", F.lit(name)) for name in ("star", "wide")]
    return sides[0].unionByName(sides[1])


def _coerced(spark: SparkSession, folder: str) -> DataFrame:
    return validation.coerce(defective_rows(spark, folder))


def validation_report(spark, folder):
    expected = event_tickers(spark, folder).select("symbol")
    missing = expected.unionByName(expected.select(F.concat("symbol", F.lit("_2")).alias("symbol")))
    return validation.report(_coerced(spark, folder), missing)


def normalized_bars(spark, folder):
    return validation.typed_bars(_coerced(spark, folder))


def duplicate_bars(spark, folder):
    rows = _coerced(spark, folder).filter("timestamp is not null and ticker is not null")
    return validation.duplicate_bars(rows)


def missing_tickers(spark, folder):
    """Users expected from orders that have no event."""
    expected = spark.read.parquet(f"{folder}/orders.parquet").select(F.concat(F.lit(" u"), "o_custkey").alias("symbol"))
    return validation.missing_tickers(user_ticks(spark, folder), expected)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}
    return {
        **corpus,
        # filters and grouped queries
        "price_range": _on(event_bars, prices.price_range, "VIEW", START, END),
        "time_window": _on(event_bars, prices.in_range, START, END),
        "avg_volume": _on(event_bars, prices.avg_volume, "VIEW"),
        "avg_volume_unknown_ticker": _on(event_bars, prices.avg_volume, "NONE"),
        "avg_daily_volume": _on(event_bars, prices.avg_daily_volume),
        "supplier_avg_daily_volume": _on(supplier_bars, prices.avg_daily_volume),
        "weekly_returns": _on(event_bars, prices.weekly_returns, "VIEW"),
        "weekly_returns_all": _on(user_ticks, prices.weekly_returns),
        "supplier_weekly_returns": _on(supplier_bars, prices.weekly_returns),
        "first_last_per_day": _on(event_bars, prices.first_last_per_day),
        "user_first_last_per_day": _on(user_ticks, prices.first_last_per_day),
        "daily_first_last": _on(event_bars, prices.first_last_per_day, "PURCHASE"),
        "top_tickers_by_return": _on(event_bars, prices.top_tickers_by_return, START, END),
        "top_suppliers_by_return": _on(
            supplier_bars, prices.top_tickers_by_return, "1996-01-01", "1999-12-31", limit=10
        ),
        "distinct_tickers": _on(user_ticks, prices.distinct_tickers),
        "record_counts": _on(supplier_bars, prices.record_counts),
        # rolling windows
        "bar_returns": _on(event_bars, rolling.bar_returns),
        "volatility": _on(event_bars, rolling.volatility, "VIEW", rounded=["volatility"]),
        "volatility_all": _on(event_bars, rolling.volatility, rounded=["volatility"]),
        "user_volatility": _on(user_ticks, rolling.volatility, rounded=["volatility"]),
        "supplier_volatility": _on(supplier_bars, rolling.volatility, rounded=["volatility"]),
        "rolling_close_average": _on(event_bars, rolling.rolling_close_average, "VIEW", rounded=["rolling_close"]),
        "supplier_rolling_close": _on(
            supplier_bars, rolling.rolling_close_average, None, 20, rounded=["rolling_close"]
        ),
        # the same windows with a ticker's history split over tasks
        "bar_returns_split": _on(event_ticks, rolling.bar_returns, slot=SLOT),
        "volatility_split": _on(event_ticks, rolling.volatility, slot=SLOT, rounded=["volatility"]),
        "rolling_close_split": _on(
            event_ticks, rolling.rolling_close_average, None, 20, slot=SLOT, rounded=["rolling_close"]
        ),
        "volatility_ranges": _on(user_ticks, rolling.volatility, slot=rolling.RANGES, rounded=["volatility"]),
        # ingest
        "validation_report": validation_report,
        "normalized_bars": normalized_bars,
        "duplicate_bars": duplicate_bars,
        "missing_tickers": missing_tickers,
        "csv_load": csv_load,
        "csv_load_with_metadata": csv_load_with_metadata,
        "csv_timestamp_patterns": csv_timestamp_patterns,
        "csv_extra_columns": csv_extra_columns,
        "csv_quoted_line_breaks": csv_quoted_line_breaks,
        "csv_inferred_format": csv_inferred_format,
        "upsert_ordered_text_times": upsert_ordered_text_times,
        "wide_period_upsert": wide_period_upsert,
        "wide_period_range": wide_period_range,
        "top_tickers_null_prices": top_tickers_null_prices,
        "damaged_store": damaged_store,
        "dimension_created": dimension_created,
        "missing_columns": missing_columns,
        # star store
        "star_view": star_view,
        "star_price_range": star_price_range,
        "dim_metadata": dimension_metadata,
        "dim_upsert": dimension_upsert,
        "fact_upsert": star_upsert,
        "merged_bars": merged_bars,
        "last_writes": last_writes,
        "star_audit": star_audit,
        "orphan_prices": orphan_prices,
        # wide store
        "partition_roundtrip": partition_roundtrip,
        "partition_scan": partition_scan,
        "wide_price_range": wide_price_range,
        "flat_roundtrip": flat_roundtrip,
        "appended_twice": appended_twice,
        "wide_upsert": wide_upsert,
        "wide_upsert_extra_columns": wide_upsert_extra_columns,
        "upsert_twice_same_rows": upsert_twice_same_rows,
        "text_timestamps_saved": text_timestamps_saved,
        "flat_replaced": flat_replaced,
        "store_integrity": store_integrity,
        "store_summary": store_summary,
        # both stores
        "compare_sources": compare_sources,
        "compare_equal_sources": compare_equal_sources,
        "build_all": build_all,
    }


# --- the same in SQL ----------------------------------------------------

BARS = 'ticker, "timestamp", open, high, low, "close", volume'

SOURCES = {
    "event_bars": """
        SELECT upper(trim(event_type)) AS ticker, date_trunc('hour', ts) AS "timestamp",
               arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, ts) AS "close", count(*) AS volume
        FROM events GROUP BY 1, 2""",
    "event_ticks": """
        SELECT upper(trim(event_type)) AS ticker, ts AS "timestamp", value AS open, value AS high,
               value AS low, value AS "close", CAST(1 AS BIGINT) AS volume
        FROM events""",
    "user_ticks": """
        SELECT 'U' || user_id AS ticker, ts AS "timestamp", value AS open, value AS high,
               value AS low, value AS "close", CAST(1 AS BIGINT) AS volume
        FROM events""",
    "supplier_bars": """
        SELECT 'S' || l_suppkey AS ticker, l_shipdate AS "timestamp",
               arg_min(l_extendedprice / l_quantity,
                       CAST(l_orderkey * 8 + l_linenumber AS HUGEINT) * 10000000000 + l_partkey) AS open,
               max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
               arg_max(l_extendedprice / l_quantity,
                       CAST(l_orderkey * 8 + l_linenumber AS HUGEINT) * 10000000000 + l_partkey) AS "close",
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2""",
    "defective_rows": """
        SELECT CASE WHEN value >= 8 AND value < 9 THEN '  ' ELSE ' ' || event_type END AS ticker,
               CASE WHEN value < 1 THEN 'invalid_date' WHEN value < 2 THEN NULL
                    ELSE substr(CAST(ts AS VARCHAR), 1, 13) || ':00:00' END AS "timestamp",
               CASE WHEN value >= 2 AND value < 3 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS open,
               CASE WHEN value >= 3 AND value < 4 THEN '-' ELSE '' END || CAST(value AS VARCHAR) AS high,
               CASE WHEN value >= 4 AND value < 5 THEN 'NaN' ELSE CAST(value AS VARCHAR) END AS low,
               CASE WHEN value >= 5 AND value < 6 THEN 'inf' ELSE CAST(value AS VARCHAR) END AS "close",
               CASE WHEN value >= 6 AND value < 7 THEN 'many' WHEN value >= 7 AND value < 8 THEN '-5'
                    ELSE CAST(event_id AS VARCHAR) || '.7' END AS volume
        FROM events""",
    "coerced": """
        SELECT nullif(upper(trim(ticker)), '') AS ticker, try_cast("timestamp" AS TIMESTAMP) AS "timestamp",
               "timestamp" IS NULL AS no_timestamp,
               try_cast(open AS DOUBLE) AS open, try_cast(high AS DOUBLE) AS high,
               CASE WHEN NOT isnan(try_cast(low AS DOUBLE)) THEN try_cast(low AS DOUBLE) END AS low,
               try_cast("close" AS DOUBLE) AS "close",
               CAST(trunc(try_cast(volume AS DOUBLE)) AS BIGINT) AS volume
        FROM defective_rows""",
}


def _sql(source: str, body: str) -> str:
    """`body` after the CTE of a derived table."""
    names = ["defective_rows", "coerced"] if source == "coerced" else [source]
    ctes = ", ".join(f"{name} AS ({SOURCES[name]})" for name in names)
    return f"WITH {ctes} {body}"


def _range(start: str, end: str) -> str:
    return f"\"timestamp\" BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


def _weekly(source: str, where: str = "") -> str:
    return _sql(
        source,
        f"""SELECT ticker, week_start, week_end, first_open, last_close,
                   (last_close - first_open) / nullif(first_open, 0) * 100 AS weekly_return
            FROM (SELECT ticker, date_trunc('week', "timestamp") AS week, min("timestamp") AS week_start,
                         max("timestamp") AS week_end, arg_min(open, "timestamp") AS first_open,
                         arg_max("close", "timestamp") AS last_close
                  FROM {source} {where} GROUP BY 1, 2)""",
    )


def _first_last(source: str, where: str = "") -> str:
    return _sql(
        source,
        f"""SELECT ticker, CAST("timestamp" AS DATE) AS date, min("timestamp") AS first_timestamp,
                   arg_min(open, "timestamp") AS first_price, max("timestamp") AS last_timestamp,
                   arg_max("close", "timestamp") AS last_price
            FROM {source} {where} GROUP BY 1, 2""",
    )


def _top(source: str, start: str, end: str, limit: int) -> str:
    return _sql(
        source,
        f"""SELECT ticker, (last_close - first_open) / nullif(first_open, 0) * 100 AS return_pct
            FROM (SELECT ticker, arg_min(open, "timestamp") AS first_open, arg_max("close", "timestamp") AS last_close
                  FROM {source} WHERE {_range(start, end)} GROUP BY 1)
            ORDER BY return_pct DESC NULLS LAST, ticker LIMIT {limit}""",
    )


def _daily_volume(source: str) -> str:
    return _sql(
        source,
        f"""SELECT ticker, avg(daily_volume) AS avg_daily_volume
            FROM (SELECT ticker, CAST("timestamp" AS DATE) AS date, CAST(sum(volume) AS BIGINT) AS daily_volume
                  FROM {source} GROUP BY 1, 2) GROUP BY 1""",
    )


RETURN = '("close" - lag("close") OVER w) / nullif(lag("close") OVER w, 0)'
SERIES = 'WINDOW w AS (PARTITION BY ticker ORDER BY "timestamp")'


def _returns(source: str) -> str:
    return _sql(source, f'SELECT ticker, "timestamp", "close", {RETURN} AS daily_return FROM {source} {SERIES}')


def _frame(window: int) -> str:
    return f'WINDOW f AS (PARTITION BY ticker ORDER BY "timestamp" ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)'


def _volatility(source: str, where: str = "", window: int = 5) -> str:
    return _sql(
        source,
        f"""SELECT ticker, "timestamp", "close", daily_return,
                   round(CASE WHEN count(daily_return) OVER f = {window}
                              THEN stddev_samp(daily_return) OVER f END, {DIGITS}) AS volatility
            FROM (SELECT ticker, "timestamp", "close", {RETURN} AS daily_return FROM {source} {where} {SERIES})
            {_frame(window)}""",
    )


def _rolling_close(source: str, where: str = "", window: int = 5) -> str:
    return _sql(
        source,
        f"""SELECT ticker, "timestamp", "close",
                   round(CASE WHEN count("close") OVER f = {window} THEN avg("close") OVER f END, {DIGITS})
                       AS rolling_close
            FROM {source} {where} {_frame(window)}""",
    )


def _counts(source: str, times: int = 1) -> str:
    return _sql(
        source,
        f"""SELECT ticker, count(*) * {times} AS records, min("timestamp") AS first_timestamp,
                   max("timestamp") AS last_timestamp FROM {source} GROUP BY 1""",
    )


def _report() -> str:
    checks = {
        "malformed_row": "false",
        "unparseable_timestamp": '"timestamp" IS NULL AND NOT no_timestamp',
        "null_timestamp": "no_timestamp",
        "invalid_ohlc": 'low > open OR low > high OR low > "close" OR high < open OR high < "close"',
        "invalid_volume": "volume IS NULL",
        "negative_volume": "volume < 0",
        "null_ticker": "ticker IS NULL",
    }
    for name in ("open", "high", "low", "close"):
        checks[f"invalid_{name}"] = f'"{name}" IS NULL'
        checks[f"{name}_out_of_range"] = f'"{name}" < 0 OR "{name}" > 1000000'
    rows = [
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {condition}) AS violations FROM coerced"
        for name, condition in checks.items()
    ]
    rows.append(
        """SELECT 'duplicate_bars', CAST(coalesce(sum(n), 0) AS BIGINT)
           FROM (SELECT count(*) AS n FROM coerced WHERE "timestamp" IS NOT NULL
                 GROUP BY ticker, "timestamp" HAVING count(*) > 1)"""
    )
    rows.append("SELECT 'missing_ticker', count(DISTINCT event_type) FROM events")
    return _sql("coerced", " UNION ALL ".join(rows))


FIRST_SIGNUP = "event_type = 'signup' AND ts < TIMESTAMP '2024-01-03'"


def _audit() -> str:
    facts = f"""facts AS (SELECT user_id AS ticker_id, substr(CAST(ts AS VARCHAR), 1, 19) AS second, value, event_id
                         FROM events),
               tickers AS (SELECT user_id AS ticker_id FROM events WHERE {FIRST_SIGNUP})"""
    required = ["ticker_id", "timestamp", "open", "high", "close", "volume"]
    rows = [f"SELECT 'null_{name}' AS \"check\", CAST(0 AS BIGINT) AS violations" for name in required]
    rows += [
        "SELECT 'null_low', count(*) FILTER (WHERE NOT value > 0.5) FROM facts",
        "SELECT 'null_symbol', CAST(0 AS BIGINT)",
        """SELECT 'duplicate_ticker_id', CAST(coalesce(sum(n), 0) AS BIGINT)
           FROM (SELECT count(*) AS n FROM tickers GROUP BY ticker_id HAVING count(*) > 1)""",
        """SELECT 'duplicate_symbol', CAST(coalesce(sum(n), 0) AS BIGINT)
           FROM (SELECT count(*) AS n FROM tickers GROUP BY ticker_id HAVING count(*) > 1)""",
        """SELECT 'duplicate_price_key', CAST(coalesce(sum(n), 0) AS BIGINT)
           FROM (SELECT count(*) AS n FROM facts GROUP BY ticker_id, second HAVING count(*) > 1)""",
        "SELECT 'orphan_price', count(*) FROM facts WHERE ticker_id NOT IN (SELECT ticker_id FROM tickers)",
    ]
    return f"WITH {facts} " + " UNION ALL ".join(rows)


def _compare(ticker: str, extra: str) -> str:
    where = f"FROM event_bars WHERE ticker = '{ticker}' AND {_range(START, END)}"
    return _sql(
        "event_bars",
        f"""SELECT '{ticker}' AS ticker, star_count, star_count + more AS wide_count, more = 0 AS match
            FROM (SELECT count(*) AS star_count, count(*) FILTER (WHERE {extra}) AS more {where})""",
    )


def _select(source: str, where: str = "") -> str:
    return _sql(source, f"SELECT {BARS} FROM {source} {where}")


def oracle_sql() -> dict[str, str]:
    corpus = dict(llm.ORACLE_SQL) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    view = "WHERE ticker = 'VIEW'"
    view_range = f"{view} AND {_range(START, END)}"
    changed = _sql(
        "event_bars",
        f"""SELECT ticker, "timestamp", open, high, low, "close",
                   CASE WHEN "timestamp" >= TIMESTAMP '{SPLIT}' THEN volume * 2 ELSE volume END AS volume
            FROM event_bars""",
    )
    avg = 'SELECT coalesce(avg(volume), 0.0) AS avg_volume FROM event_bars WHERE ticker = '
    return {
        **corpus,
        "price_range": _select("event_bars", view_range),
        "time_window": _select("event_bars", f"WHERE {_range(START, END)}"),
        "avg_volume": _sql("event_bars", avg + "'VIEW'"),
        "avg_volume_unknown_ticker": _sql("event_bars", avg + "'NONE'"),
        "avg_daily_volume": _daily_volume("event_bars"),
        "supplier_avg_daily_volume": _daily_volume("supplier_bars"),
        "weekly_returns": _weekly("event_bars", view),
        "weekly_returns_all": _weekly("user_ticks"),
        "supplier_weekly_returns": _weekly("supplier_bars"),
        "first_last_per_day": _first_last("event_bars"),
        "user_first_last_per_day": _first_last("user_ticks"),
        "daily_first_last": _first_last("event_bars", "WHERE ticker = 'PURCHASE'"),
        "top_tickers_by_return": _top("event_bars", START, END, 3),
        "top_suppliers_by_return": _top("supplier_bars", "1996-01-01", "1999-12-31", 10),
        "distinct_tickers": _sql("user_ticks", "SELECT DISTINCT ticker FROM user_ticks"),
        "record_counts": _counts("supplier_bars"),
        "bar_returns": _returns("event_bars"),
        "volatility": _volatility("event_bars", view),
        "volatility_all": _volatility("event_bars"),
        "user_volatility": _volatility("user_ticks"),
        "supplier_volatility": _volatility("supplier_bars"),
        "rolling_close_average": _rolling_close("event_bars", view),
        "supplier_rolling_close": _rolling_close("supplier_bars", window=20),
        "bar_returns_split": _returns("event_ticks"),
        "volatility_split": _volatility("event_ticks"),
        "rolling_close_split": _rolling_close("event_ticks", window=20),
        "volatility_ranges": _volatility("user_ticks"),
        "validation_report": _report(),
        "normalized_bars": _select("coerced"),
        "duplicate_bars": _sql(
            "coerced",
            """SELECT ticker, "timestamp", count(*) AS records FROM coerced
               WHERE ticker IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
        ),
        "missing_tickers": """SELECT DISTINCT 'U' || o_custkey AS ticker FROM orders
                              WHERE o_custkey NOT IN (SELECT user_id FROM events)""",
        "csv_load": _select("event_bars"),
        "csv_load_with_metadata": _select("event_bars"),
        "csv_timestamp_patterns": _select("event_bars"),
        "csv_extra_columns": _sql("event_bars", f'SELECT {BARS}, "close" AS adj_close FROM event_bars'),
        "csv_quoted_line_breaks": _sql(
            "event_bars",
            f"""SELECT {BARS}, CASE WHEN volume % 3 = 0 THEN 'first "' || ticker || '"' || chr(10) || chr(10) || ', second' END
                       AS note FROM event_bars""",
        ),
        "csv_inferred_format": _select("event_bars"),
        "upsert_ordered_text_times": _sql(
            "event_bars",
            f"""SELECT ticker, "timestamp", open, high, low, "close", volume + 1 AS volume, source
                FROM event_bars CROSS JOIN (VALUES ('star'), ('wide')) AS stores(source)""",
        ),
        "wide_period_upsert": changed,
        "wide_period_range": _select(
            "supplier_bars", f"WHERE ticker = 'S7' AND {_range('1995-02-10', '1995-05-20')}"
        ),
        "top_tickers_null_prices": _sql(
            "event_bars",
            f"""SELECT ticker, (last_close - first_open) / nullif(first_open, 0) * 100 AS return_pct
                FROM (SELECT ticker, max(CASE WHEN first = 1 AND ticker >= 'P' THEN open END) AS first_open,
                             max(CASE WHEN last = 1 THEN "close" END) AS last_close
                      FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY "timestamp") AS first,
                                   row_number() OVER (PARTITION BY ticker ORDER BY "timestamp" DESC) AS last
                            FROM event_bars WHERE {_range(START, END)}) GROUP BY 1)
                WHERE first_open IS NOT NULL""",
        ),
        "damaged_store": _sql(
            "event_bars",
            """SELECT ticker, CAST(2 AS BIGINT) AS files, CAST(CASE WHEN ticker < 'P' THEN 1 ELSE 0 END AS BIGINT) AS bad_files,
                      CAST(CASE WHEN ticker < 'P' THEN 1 ELSE 2 END * count(*) AS BIGINT) AS records
               FROM event_bars GROUP BY ticker""",
        ),
        "dimension_created": """SELECT count(DISTINCT user_id) AS records, count(DISTINCT user_id) AS in_time FROM events""",
        "missing_columns": """SELECT count(*) AS records,
                                     'Missing required columns: [''close'', ''volume'']' AS message FROM events""",
        "star_view": _select("supplier_bars"),
        "star_price_range": _select("event_bars", view_range),
        "dim_metadata": """SELECT row_number() OVER (ORDER BY symbol) AS ticker_id, symbol,
                                  symbol || ' events' AS name, 'EVENTS' AS exchange
                           FROM (SELECT DISTINCT upper(trim(event_type)) AS symbol FROM events)""",
        "dim_upsert": """
            WITH users AS (SELECT 'U' || user_id AS symbol, min(ts) >= TIMESTAMP '2024-01-03' AS is_new
                           FROM events GROUP BY 1)
            SELECT row_number() OVER (ORDER BY is_new, symbol) AS ticker_id, symbol,
                   CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS exchange FROM users""",
        "fact_upsert": changed,
        "merged_bars": changed,
        "last_writes": """SELECT 'U' || user_id AS ticker, date_trunc('hour', ts) AS "timestamp",
                                 arg_max(value, event_id) AS "close", max(event_id) AS volume
                          FROM events GROUP BY 1, 2""",
        "star_audit": _audit(),
        "orphan_prices": f"""SELECT user_id AS ticker_id, count(*) AS records FROM events
                            GROUP BY 1 HAVING count(*) FILTER (WHERE {FIRST_SIGNUP}) = 0""",
        "partition_roundtrip": _select("user_ticks"),
        "partition_scan": _select("event_ticks", "WHERE ticker = 'PURCHASE'"),
        "wide_price_range": _select("event_bars", view_range),
        "flat_roundtrip": _select("supplier_bars"),
        "appended_twice": _counts("event_bars", 2),
        "wide_upsert": changed,
        "wide_upsert_extra_columns": f"""
            SELECT *, CASE WHEN "timestamp" < TIMESTAMP '2024-01-20' THEN ticker || '-1' END AS sector FROM ({changed})""",
        "upsert_twice_same_rows": changed,
        "text_timestamps_saved": _select("event_bars"),
        "flat_replaced": _select("event_bars"),
        "store_integrity": _sql(
            "user_ticks",
            "SELECT ticker, count(*) AS records, CAST(0 AS BIGINT) AS bad_files FROM user_ticks GROUP BY 1",
        ),
        "store_summary": _sql(
            "user_ticks",
            """SELECT true AS valid, count(*) AS total_records, count(DISTINCT ticker) AS partitions,
                      CAST(0 AS BIGINT) AS bad_files FROM user_ticks""",
        ),
        "compare_sources": _compare("VIEW", f"\"timestamp\" >= TIMESTAMP '{SPLIT}'"),
        "compare_equal_sources": _compare("ERROR", "false"),
        "build_all": _sql(
            "event_bars",
            f"""SELECT {BARS}, 'star' AS source FROM event_bars
                UNION ALL SELECT {BARS}, 'wide' AS source FROM event_bars""",
        ),
    }
