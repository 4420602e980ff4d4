"""Checks on coerced bars, and the rows behind them.

`coerce` turns text columns into typed ones and keeps, next to the values, what
the checks need to tell a missing field from an unreadable one. `report` counts
violations; `require_valid` raises on the first check that fails.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.functions import number, parse_timestamp, symbol, whole_number
from candlekit.functions.expressions import DEFAULT_PATTERN, is_missing
from candlekit.schema import BAR_COLUMNS, KEY_COLUMNS, PRICE_COLUMNS, ValidationError, quoted

MIN_PRICE = 0.0
MAX_PRICE = 1_000_000.0

# Helper columns that `coerce` adds and `typed_bars` removes.
MALFORMED = "_malformed"
NO_TIMESTAMP = "_no_timestamp"
VOLUME_NUMBER = "_volume_number"
HELPER_COLUMNS = [MALFORMED, NO_TIMESTAMP, VOLUME_NUMBER]


def require_columns(columns: list[str]) -> None:
    missing = sorted(set(BAR_COLUMNS) - set(columns))
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")


def coerce(raw: DataFrame, timestamp_format: str | Sequence[str] = DEFAULT_PATTERN) -> DataFrame:
    """Typed bars from text columns; what cannot be read becomes null."""
    require_columns(raw.columns)
    values = {
        "ticker": symbol(F.col("ticker")),
        "timestamp": parse_timestamp(F.col("timestamp"), timestamp_format),
        **{name: number(F.col(name)) for name in PRICE_COLUMNS},
        "volume": whole_number(F.col("volume")),
    }
    extra = [name for name in raw.columns if name not in values and name != MALFORMED]
    malformed = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(False)
    return raw.select(
        *[value.alias(name) for name, value in values.items()],
        *quoted(extra),
        malformed.alias(MALFORMED),
        is_missing(F.col("timestamp")).alias(NO_TIMESTAMP),
        number(F.col("volume")).alias(VOLUME_NUMBER),
    )


def typed_bars(coerced: DataFrame) -> DataFrame:
    return coerced.drop(*HELPER_COLUMNS)


def unreadable_timestamps(coerced: DataFrame) -> DataFrame:
    """Rows with a timestamp that could not be read."""
    return coerced.filter(F.col("timestamp").isNull() & ~F.col(NO_TIMESTAMP))


def _row_checks(min_price: float, max_price: float) -> dict[str, Column]:
    """Condition for a violating row, per check."""
    timestamp = F.col("timestamp")
    volume = F.col("volume")
    checks = {
        "malformed_row": F.col(MALFORMED),
        "unparseable_timestamp": timestamp.isNull() & ~F.col(NO_TIMESTAMP),
        "null_timestamp": timestamp.isNull() & F.col(NO_TIMESTAMP),
    }
    for name in PRICE_COLUMNS:
        price = F.col(name)
        checks[f"invalid_{name}"] = price.isNull()
        checks[f"{name}_out_of_range"] = ~price.between(F.lit(min_price), F.lit(max_price))
    checks["invalid_ohlc"] = (F.col("low") > F.least("open", "high", "close")) | (
        F.col("high") < F.greatest("open", "low", "close")
    )
    checks["invalid_volume"] = volume.isNull()
    checks["negative_volume"] = F.col(VOLUME_NUMBER) < 0
    checks["null_ticker"] = F.col("ticker").isNull()
    return checks


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return bars.groupBy(*KEY_COLUMNS).agg(F.count("*").alias("records")).filter("records > 1")


def missing_tickers(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tickers (first column of `expected`) without any bar."""
    wanted = expected.select(symbol(expected[expected.columns[0]]).alias("ticker")).filter("ticker is not null")
    return wanted.distinct().join(bars.select("ticker").distinct(), "ticker", "left_anti")


def _single(df: DataFrame, check: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check"), "violations"
    )


def report(
    coerced: DataFrame,
    expected: DataFrame | None = None,
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
) -> DataFrame:
    """One row (check, violations) per check.

    All row-level checks share one aggregation without a shuffle of the rows;
    duplicates and completeness are one small plan each.
    """
    checks = _row_checks(min_price, max_price)
    counts = coerced.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    row_level = counts.unpivot([], list(checks), "check", "violations")
    repeated = duplicate_bars(coerced.filter(F.col("timestamp").isNotNull()))
    result = row_level.unionByName(_single(repeated, "duplicate_bars", F.sum("records")))
    if expected is not None:
        result = result.unionByName(_single(missing_tickers(coerced, expected), "missing_ticker", F.count("*")))
    return result


def _messages(min_price: float, max_price: float) -> dict[str, str]:
    """Error text per check, in the order in which checks are reported. the
    beginnings of the texts, which callers match."""
    messages = {
        "malformed_row": "Failed to read CSV file: {n} rows have more fields than the header",
        "unparseable_timestamp": "Failed to parse timestamps: {n} values",
        "null_timestamp": "Found {n} records with invalid timestamps",
        "duplicate_bars": "Found {n} duplicate records (rows that share their ticker and time)",
    }
    for name in PRICE_COLUMNS:
        messages[f"invalid_{name}"] = f"Found {{n}} invalid {name} prices"
        messages[f"{name}_out_of_range"] = f"Found {{n}} {name} prices out of valid range [{min_price}, {max_price}]"
    messages["invalid_ohlc"] = "Found {n} records with invalid OHLC relationship (some price is below low or above high)"
    messages["invalid_volume"] = "Found {n} invalid volume values"
    messages["negative_volume"] = "Found {n} records with negative volume"
    messages["null_ticker"] = "Found {n} records without a ticker"
    messages["missing_ticker"] = "Missing expected tickers: {n}"
    return messages


def require_valid(
    coerced: DataFrame,
    expected: DataFrame | None = None,
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
) -> None:
    """Raise ValidationError for the first failing check.

    For missing tickers the error has them as the DataFrame `missing` (column ticker).
    """
    # One row per check.
    found = {row["check"]: row["violations"] for row in report(coerced, expected, min_price, max_price).collect()}
    for check, message in _messages(min_price, max_price).items():
        violations = found.get(check, 0)
        if not violations:
            continue
        text = message.format(n=violations)
        error = ValidationError(text)
        if check == "missing_ticker":
            # All of them, as a DataFrame: there may be any number.
            error.missing = missing_tickers(coerced, expected)
        raise error
