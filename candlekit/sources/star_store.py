"""Bars as a star: a ticker dimension and a price fact.

The fact is partitioned by month and sorted by ticker and time inside its
files, so a time range prunes partitions and a ticker prunes row groups.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlekit.operators.integrity import audit_star
from candlekit.operators.prices import Moment, moment
from candlekit.operators.upsert import last_write, new_dimension_rows, require_order, require_unique
from candlekit.schema import BAR_COLUMNS, BARS_SCHEMA, KEY_COLUMNS, PRICES_SCHEMA, TICKERS_SCHEMA
from candlekit.session import staged
from candlekit.sources.tables import conform, ordered, read_table, reporting, upsert_table

PRICE_KEY = ["ticker_id", "timestamp"]
STORED_PRICES = T.StructType([*PRICES_SCHEMA.fields, T.StructField("month", T.DateType())])


def month_of(timestamp):
    return F.trunc(F.to_date(timestamp), "month")


def star_view(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Canonical bars. Spark broadcasts the dimension if it is small; otherwise
    the skew join of adaptive execution splits a ticker with many rows."""
    return prices.join(tickers.select("ticker_id", F.col("symbol").alias("ticker")), "ticker_id").select(*BAR_COLUMNS)


def with_ticker_ids(bars: DataFrame, tickers: DataFrame) -> DataFrame:
    """Price rows: bars with the id in place of the symbol (null if unknown)."""
    ids = tickers.select("ticker_id", F.col("symbol").alias("ticker"))
    return bars.join(ids, "ticker", "left").select(*PRICES_SCHEMA.fieldNames())


class StarStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.tickers_path = f"{self.path}/tickers"
        self.prices_path = f"{self.path}/prices"

    def tickers(self) -> DataFrame:
        return read_table(self.spark, self.tickers_path, TICKERS_SCHEMA)

    def prices(self, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
        """The fact; with bounds, only the months of the closed interval are read."""
        stored = read_table(self.spark, self.prices_path, STORED_PRICES)
        if start is not None:
            stored = stored.filter(F.col("month") >= month_of(moment(start)))
            stored = stored.filter(F.col("timestamp") >= moment(start))
        if end is not None:
            stored = stored.filter(F.col("month") <= month_of(moment(end)))
            stored = stored.filter(F.col("timestamp") <= moment(end))
        return stored.select(*PRICES_SCHEMA.fieldNames())

    def ticker_id(self, symbol: str) -> int | None:
        row = self.tickers().filter(F.col("symbol") == symbol).select("ticker_id").first()
        return row and row["ticker_id"]

    def bars(self, ticker: str | None = None, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
        """Canonical bars. For one ticker its id is looked up first, so that the
        fact is filtered by a literal and needs no join."""
        prices = self.prices(start, end)
        if ticker is None:
            return star_view(prices, self.tickers())
        known = self.ticker_id(ticker)
        rows = prices.filter(F.col("ticker_id") == known) if known is not None else prices.filter(F.lit(False))
        return rows.withColumn("ticker", F.lit(ticker)).select(*BAR_COLUMNS)

    def add_tickers(self, symbols: DataFrame) -> int:
        """Add the symbols that are not in the dimension; returns how many."""
        new = new_dimension_rows(self.tickers(), symbols)
        rows = new.count()
        if rows:
            new.write.mode("append").parquet(self.tickers_path)
        return rows

    def add_ticker(self, symbol: str, name: str | None = None, exchange: str | None = None) -> int:
        """Id of a symbol, which is added if need be."""
        row = self.spark.createDataFrame([(symbol, name, exchange)], "symbol STRING, name STRING, exchange STRING")
        self.add_tickers(row)
        return self.ticker_id(symbol)

    def upsert(
        self,
        bars: DataFrame,
        metadata: DataFrame | None = None,
        order: str | None = None,
        validated: bool = False,
    ) -> int:
        """Insert or replace by (ticker, timestamp); returns the rows written.

        Unknown tickers are added, with name and exchange from `metadata`
        (symbol, name, exchange) if given. `order` and `validated` are as for
        the wide store.
        """
        with reporting():
            # The star has the bar columns only.
            known = bars.select(*[F.col(name) for name in bars.columns if name in BAR_COLUMNS or name == order])
            batch = conform(known, ordered(BARS_SCHEMA, bars, order), BAR_COLUMNS, [])
            if validated:
                return self._upsert(batch, metadata)
            with staged(batch, "batch") as batch:
                if not order:
                    require_unique(batch, KEY_COLUMNS)
                    return self._upsert(batch, metadata)
                require_order(batch, KEY_COLUMNS, order)
                with staged(last_write(batch, KEY_COLUMNS, order).select(*BAR_COLUMNS), "last") as last:
                    return self._upsert(last, metadata)

    def _upsert(self, batch: DataFrame, metadata: DataFrame | None) -> int:
        symbols = batch.select(F.col("ticker").alias("symbol")).distinct()
        if metadata is not None:
            symbols = symbols.join(metadata.select("symbol", "name", "exchange"), "symbol", "left")
        self.add_tickers(symbols)
        rows = with_ticker_ids(batch, self.tickers()).withColumn("month", month_of(F.col("timestamp")))
        return upsert_table(self.spark, self.prices_path, rows, PRICE_KEY, "timestamp", ["month"], PRICE_KEY)

    def audit(self) -> DataFrame:
        return audit_star(self.prices(), self.tickers())


