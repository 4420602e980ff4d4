"""Column layouts shared by every module, and the error raised on bad input."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_COLUMNS = ["ticker", "timestamp"]
PRICE_COLUMNS = ["open", "high", "low", "close"]

BARS_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICE_COLUMNS],
        T.StructField("volume", T.LongType()),
    ]
)
BAR_COLUMNS = BARS_SCHEMA.fieldNames()

# The folder level below the ticker in a wide store, by period: the first day of a month or year.
PERIOD_COLUMNS = {"month": "bar_month", "year": "bar_year"}

TICKERS_SCHEMA = T.StructType(
    [
        T.StructField("ticker_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

TICKERS_CSV_COLUMNS = ["ticker_id", "symbol", "name", "exchange"]

PRICES_SCHEMA = T.StructType(
    [T.StructField("ticker_id", T.LongType()), *BARS_SCHEMA.fields[1:]]
)


def quoted(names: Iterable[str]) -> list[Column]:
    """The columns with these names, whatever characters a name has."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


class ValidationError(Exception):
    """The input cannot be loaded as valid bars. `missing` may hold a DataFrame of what is missing."""

    missing = None
