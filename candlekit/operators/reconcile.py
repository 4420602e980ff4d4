"""Comparison of the same bars in two stores."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlekit.operators.prices import Moment, for_ticker, in_range


def _bar_count(bars: DataFrame | None, ticker: str, start: Moment, end: Moment, side: str) -> DataFrame | None:
    if bars is None:
        return None
    selected = in_range(for_ticker(bars, ticker), start, end)
    return selected.agg(F.count("*").alias("records")).withColumn("side", F.lit(side))


def compare_bars(
    star: DataFrame | None, wide: DataFrame | None, ticker: str, start: Moment, end: Moment
) -> DataFrame:
    """One row: ticker, star_count, wide_count, match.

    Two empty sides match; a missing side (None) has a null count and never matches.
    """
    counts = [
        count
        for count in (
            _bar_count(star, ticker, start, end, "star"),
            _bar_count(wide, ticker, start, end, "wide"),
        )
        if count is not None
    ]
    if not counts:
        raise ValueError("No store to compare")
    both = counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])
    sides = both.agg(
        F.max(F.when(F.col("side") == "star", F.col("records"))).alias("star_count"),
        F.max(F.when(F.col("side") == "wide", F.col("records"))).alias("wide_count"),
    )
    match = F.coalesce(F.col("star_count") == F.col("wide_count"), F.lit(False))
    return sides.select(F.lit(ticker).alias("ticker"), "star_count", "wide_count", match.alias("match"))
