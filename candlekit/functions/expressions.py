"""Column expressions. All are built-ins, so they stay inside code generation.

Timestamps are TIMESTAMP_NTZ and none of these expressions depends on the
session time zone (a cast through TIMESTAMP would move times that fall into a
daylight-saving gap).
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as "no value" when a CSV field is read.
MISSING_TEXTS = ["", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None", "NaT", "#N/A", "<NA>"]

# The number syntax accepted in a CSV field. A bare try_cast also
# takes Java-only forms such as "1.5d" or "0x1p3".
DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
INFINITY_PATTERN = r"^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"

DEFAULT_PATTERN = "yyyy-MM-dd HH:mm:ss"

LONG_LIMIT = float(2**63)


def symbol(column: Column) -> Column:
    """Ticker text in its stored form: trimmed, upper case, blank as null."""
    return F.nullif(F.upper(F.trim(column.cast("string"), F.lit(" \t\r\n"))), F.lit(""))


def is_missing(column: Column) -> Column:
    return column.isNull() | F.trim(column).isin(MISSING_TEXTS)


def number(column: Column) -> Column:
    """Text to double; null when the text is not a number (NaN included)."""
    text = column.cast("string")
    accepted = text.rlike(DECIMAL_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(accepted, text.try_cast("double"))


def whole_number(column: Column) -> Column:
    """Text to bigint, cutting off any fraction; null when it does not fit.

    Integers are read directly so that large ones keep every digit. The pattern
    comes first because a failing cast is slow.
    """
    text = column.cast("string")
    as_double = number(column)
    fits = (as_double >= -LONG_LIMIT) & (as_double < LONG_LIMIT)
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint")).when(fits, as_double.cast("bigint"))


# A zone after a time of day: Z, or an offset.
ZONE_PATTERN = r":\d{2}(\.\d+)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$"


def _wall_clock(instant: Column) -> Column:
    """An instant as its UTC wall-clock time."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def parse_timestamp(column: Column, pattern: str | Sequence[str] = DEFAULT_PATTERN) -> Column:
    """Text to TIMESTAMP_NTZ: the given patterns in their order, ISO-like forms after them.

    A time with a zone offset (or Z) becomes the UTC wall-clock time of that instant.

    The default pattern is one of the ISO-like forms. Any other is read as UTC
    and turned back into a UTC wall-clock time, which keeps the time as written
    whatever the session zone is.
    """
    text = F.trim(column.cast("string"))
    instant = _wall_clock(text.try_cast("timestamp"))
    iso = F.when(text.rlike(ZONE_PATTERN), instant).otherwise(text.try_cast("timestamp_ntz"))

    def parsed(one: str) -> Column:
        if one == DEFAULT_PATTERN:
            return iso
        return _wall_clock(F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(one + " X")))

    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    return F.coalesce(*[parsed(one) for one in patterns if one != DEFAULT_PATTERN or len(patterns) > 1], iso)


def percent_return(first: Column, last: Column) -> Column:
    """Return in percent; null for a zero base price."""
    return F.try_divide(last - first, first) * 100


def monday_of(timestamp: Column) -> Column:
    """Monday of the ISO week; one value per (ISO year, ISO week)."""
    day = F.to_date(timestamp)
    return F.date_sub(day, F.weekday(day))


def seconds_since_epoch(timestamp: Column) -> Column:
    days = F.unix_date(F.to_date(timestamp)).cast("bigint")
    return days * 86400 + F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp)
