"""One query interface over both stores."""

from pyspark.sql import DataFrame

from candlekit.operators import prices, reconcile, rolling
from candlekit.operators.prices import Moment
from candlekit.schema import BAR_COLUMNS
from candlekit.sources.star_store import StarStore
from candlekit.sources.wide_store import WideStore

# Accepted names of the two sources.
STAR_NAMES = ["star", "sqlite"]
WIDE_NAMES = ["wide", "parquet"]


class QueryEngine:
    """Queries over a star store, a wide store or both.

    Every query runs the same plan on canonical bars, so both sources give the
    same answer; the source only decides what is scanned. Results are lazy
    DataFrames, except for the single number of get_avg_volume.
    """

    def __init__(self, star: StarStore | None = None, wide: WideStore | None = None):
        self.star = star
        self.wide = wide

    def bars(
        self, source: str, ticker: str | None = None, start: Moment | None = None, end: Moment | None = None
    ) -> DataFrame:
        if source in STAR_NAMES and self.star is not None:
            return self.star.bars(ticker, start, end)
        if source in WIDE_NAMES and self.wide is not None:
            return self.wide.bars(ticker, start, end)
        raise ValueError(f"Invalid or unavailable source: {source}")

    def get_price_range(self, ticker: str, start: Moment, end: Moment, source: str = "star") -> DataFrame:
        return prices.price_range(self.bars(source, ticker, start, end), ticker, start, end)

    def get_avg_volume(self, ticker: str, source: str = "star") -> float:
        return prices.avg_volume(self.bars(source, ticker), ticker).first()["avg_volume"]

    def get_avg_daily_volume(self, source: str = "star") -> DataFrame:
        return prices.avg_daily_volume(self.bars(source))

    def get_weekly_returns(self, ticker: str | None = None, source: str = "star") -> DataFrame:
        return prices.weekly_returns(self.bars(source, ticker), ticker)

    def get_daily_first_last_prices(self, ticker: str, source: str = "star") -> DataFrame:
        return prices.first_last_per_day(self.bars(source, ticker), ticker)

    def get_first_last_prices_per_day(self, ticker: str | None = None, source: str = "star") -> DataFrame:
        return prices.first_last_per_day(self.bars(source, ticker), ticker)

    def get_top_tickers_by_return(
        self, start: Moment, end: Moment, limit: int = 3, source: str = "star"
    ) -> DataFrame:
        return prices.top_tickers_by_return(self.bars(source, None, start, end), start, end, limit)

    def get_rolling_close_average(self, ticker: str | None, window: int = 5, source: str = "wide") -> DataFrame:
        rows = rolling.rolling_close_average(self.bars(source, ticker), ticker, window)
        return self._in_time_order(rows, ticker)

    def get_volatility(self, ticker: str | None = None, window: int = 5, source: str = "wide") -> DataFrame:
        rows = rolling.volatility(self.bars(source, ticker), ticker, window)
        return self._in_time_order(rows, ticker)

    @staticmethod
    def _in_time_order(rows: DataFrame, ticker: str | None) -> DataFrame:
        """Sorted by time for one ticker. Rows of all tickers stay where the
        window left them (by ticker in parts): a total order of every bar would
        be one more shuffle, which the caller can add."""
        return rows.drop("ticker").orderBy("timestamp") if ticker is not None else rows

    def compare_sources(self, ticker: str, start: Moment, end: Moment) -> dict:
        """Bar counts of both stores in a range, their columns, and whether they match."""
        star = self.star and self.star.bars(ticker, start, end)
        wide = self.wide and self.wide.bars(ticker, start, end)
        result = {"ticker": ticker, "date_range": (str(start), str(end)), "star": {}, "wide": {}, "match": False}
        if star is None and wide is None:
            return result
        row = reconcile.compare_bars(star, wide, ticker, start, end).first()
        for name, side in (("star", star), ("wide", wide)):
            if side is not None:
                result[name] = {"record_count": row[f"{name}_count"], "columns": list(BAR_COLUMNS)}
        return {**result, "match": row["match"]}
