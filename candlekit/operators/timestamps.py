"""Which of the usual patterns a column of timestamps is written in."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlekit.functions.expressions import is_missing

# Patterns of the date and of the time after it, in the order in which they are preferred, with the shape of
# their texts. Where day and month can be told apart for no value, the month comes first.
DATES = {
    "M/d/yyyy": r"\d{1,2}/\d{1,2}/\d{4}",
    "d/M/yyyy": r"\d{1,2}/\d{1,2}/\d{4}",
    "M-d-yyyy": r"\d{1,2}-\d{1,2}-\d{4}",
    "d-M-yyyy": r"\d{1,2}-\d{1,2}-\d{4}",
    "M.d.yyyy": r"\d{1,2}\.\d{1,2}\.\d{4}",
    "d.M.yyyy": r"\d{1,2}\.\d{1,2}\.\d{4}",
    "yyyy/M/d": r"\d{4}/\d{1,2}/\d{1,2}",
    "yyyyMMdd": r"\d{8}",
    "d MMM yyyy": r"\d{1,2} [A-Z][a-z]{2} \d{4}",
    "MMM d, yyyy": r"[A-Z][a-z]{2} \d{1,2}, \d{4}",
}
TIMES = {
    " H:mm:ss": r" \d{1,2}:\d{2}:\d{2}",
    " H:mm": r" \d{1,2}:\d{2}",
    " h:mm:ss a": r" \d{1,2}:\d{2}:\d{2} [AaPp][Mm]",
    " h:mm a": r" \d{1,2}:\d{2} [AaPp][Mm]",
    "": "",
}
PATTERNS = [date + time for date in DATES for time in TIMES]


def fitting_patterns(column: Column) -> Column:
    """A number whose bit i says whether PATTERNS[i] reads the value. Only patterns of its shape are tried,
    as a pattern that fails is slow."""
    text = F.trim(column.cast("string"))
    none, found = F.lit(0).cast("bigint"), []
    for i, (date, shape) in enumerate(DATES.items()):
        bits = [
            F.when(
                text.rlike(f"[0-9]{rest}$") & F.try_to_timestamp(text, F.lit(date + time)).isNotNull(),
                F.lit(1 << (i * len(TIMES) + j)).cast("bigint"),
            ).otherwise(none)
            for j, (time, rest) in enumerate(TIMES.items())
        ]
        found.append(F.when(text.rlike(f"^{shape}( |$)"), reduce(Column.bitwiseOR, bits)).otherwise(none))
    return reduce(Column.bitwiseOR, found)


def inferred_pattern(rows: DataFrame, column: str) -> str | None:
    """The first of PATTERNS that reads every value of a text column that is not missing; None if there is none.

    One aggregation: the bits that all values have in common.
    """
    value = F.col(column)
    fitting = rows.filter(~is_missing(value)).select(fitting_patterns(value).alias("fitting"))
    common = fitting.agg(F.bit_and("fitting").alias("common")).first()["common"]
    return PATTERNS[(common & -common).bit_length() - 1] if common else None
