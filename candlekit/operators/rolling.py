"""Row-based rolling windows per ticker.

A window partitioned by ticker alone puts a ticker's whole history into one
task. Where one ticker is too long for that, its history is cut into slots:

1. every (ticker, slot) is a window partition of its own, and a bar with enough
   earlier bars in its slot gets its final value there;
2. the first and the last few bars of every slot (the edges) form a second, far
   smaller series per ticker. The bars before a slot's first bars are all in it,
   so the same expressions give their final values.

The result equals the plain window for any way of cutting; the slots only decide
how the work is spread. Slots of equal time need no extra shuffle. Where the bars
of a ticker are too unevenly spread over time for that, slots are sampled ranges
of (ticker, timestamp) with about equally many bars.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlekit.functions import seconds_since_epoch
from candlekit.operators.prices import for_ticker
from candlekit.session import stage

# Bars of one ticker that a single task may sort.
TASK_BARS = 1_000_000

# How far the fullest time slot may exceed the intended number of bars. Trading
# sessions alone make bars about five times as dense as on average.
UNEVENNESS = 16

# How far the edges of one ticker may exceed the same number. A ticker with few bars in a
# slot would have hardly anything but edges.
EDGES = 2

AUTO = "auto"
RANGES = "ranges"

# Seconds per time slot, None for no slots, RANGES, or AUTO.
Slot = int | str | None


def _largest(bars: DataFrame, *group: str) -> int:
    rows = bars.groupBy(*group).agg(F.count("*").alias("rows")).agg(F.max("rows")).first()[0]
    return rows or 0


def _fullest_and_edges(bars: DataFrame, slot: Column, reach: int) -> tuple[int, int]:
    """The most bars of a slot, and the most edges of a ticker."""
    slots = bars.groupBy("ticker", slot).agg(F.count("*").alias("rows"))
    edges = F.sum(F.least("rows", F.lit(2 * max(reach, 1))))
    tickers = slots.groupBy("ticker").agg(F.max("rows").alias("fullest"), edges.alias("edges"))
    worst = tickers.agg(F.max("fullest"), F.max("edges")).first()
    return worst[0] or 0, worst[1] or 0


def _time_slot(seconds: int) -> Column:
    return F.floor(seconds_since_epoch(F.col("timestamp")) / F.lit(seconds)).alias("_slot")


def choose_slot(bars: DataFrame, reach: int, task_bars: int = TASK_BARS) -> Slot:
    """How to cut the longest ticker, or None if no ticker needs it.

    Counts bars per ticker first, which for a store partitioned by ticker reads
    file footers only. Every aggregation here returns a single row.
    """
    longest = _largest(bars, "ticker")
    if longest <= task_bars:
        return None
    per_ticker = bars.groupBy("ticker").agg(
        F.count("*").alias("rows"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )
    span = seconds_since_epoch(F.col("last")) - seconds_since_epoch(F.col("first")) + 1
    densest = per_ticker.filter(F.col("rows") > task_bars).agg(F.min(span / F.col("rows"))).first()[0]
    # Wider slots leave fewer edges: keep both levels of the split about equal.
    bars_per_slot = max(task_bars, math.isqrt(2 * reach * longest))
    seconds = max(1, int(densest * bars_per_slot))
    fullest, edges = _fullest_and_edges(bars, _time_slot(seconds), reach)
    even = fullest <= UNEVENNESS * bars_per_slot and edges <= EDGES * bars_per_slot
    return seconds if even else RANGES


def _with_slots(bars: DataFrame, slot: int | str) -> DataFrame:
    if slot == RANGES:
        # Staged, since a second evaluation could cut the ranges elsewhere.
        ranges = bars.repartitionByRange("ticker", "timestamp")
        return stage(ranges.withColumn("_slot", F.spark_partition_id()), "slots")
    if slot < 1:
        raise ValueError(f"slot must be at least one second: {slot}")
    return bars.withColumn("_slot", _time_slot(slot))


def _series(*partition: str) -> WindowSpec:
    # close breaks ties, so that repeated (ticker, timestamp) rows give the same
    # result in every evaluation.
    return Window.partitionBy(*partition).orderBy("timestamp", "close")


def over_series(
    bars: DataFrame,
    reach: int,
    add_columns: Callable[[DataFrame, WindowSpec], DataFrame],
    slot: Slot = AUTO,
) -> DataFrame:
    """Apply `add_columns` over each ticker's bars in time order.

    `reach` is how many earlier bars a value depends on.
    """
    columns = bars.columns
    if slot == AUTO:
        slot = choose_slot(bars, reach)
    if slot is None:
        return add_columns(bars, _series("ticker"))

    reach = max(reach, 1)
    slotted = _with_slots(bars, slot)
    in_slot = _series("ticker", "_slot")
    local = add_columns(slotted, in_slot).withColumns(
        {
            "_head": F.lag("timestamp", reach).over(in_slot).isNull(),
            "_tail": F.lead("timestamp", reach).over(in_slot).isNull(),
        }
    )
    inner = local.filter(~F.col("_head")).drop("_slot", "_head", "_tail")
    edges = local.filter(F.col("_head") | F.col("_tail")).select(*columns, "_head")
    joined = add_columns(edges, _series("ticker")).filter("_head").drop("_head")
    return inner.unionByName(joined)


def _full_frame(value: Column, over: WindowSpec, window: int, aggregate: Column) -> Column:
    """`aggregate` over the last `window` rows, null unless all have a value."""
    frame = over.rowsBetween(1 - window, 0)
    return F.when(F.count(value).over(frame) == window, aggregate.over(frame))


def _return(over: WindowSpec) -> Column:
    previous = F.lag("close").over(over)
    return F.try_divide(F.col("close") - previous, previous)


def _check_window(window: int) -> None:
    if window < 1:
        raise ValueError(f"window must be at least 1: {window}")


def _closes(bars: DataFrame, ticker: str | None) -> DataFrame:
    return for_ticker(bars, ticker).select("ticker", "timestamp", "close")


def bar_returns(bars: DataFrame, ticker: str | None = None, slot: Slot = AUTO) -> DataFrame:
    """Return from bar to bar; null on a ticker's first bar and after a zero close."""
    return over_series(
        _closes(bars, ticker),
        1,
        lambda df, over: df.withColumn("daily_return", _return(over)),
        slot,
    )


def volatility(
    bars: DataFrame, ticker: str | None = None, window: int = 5, slot: Slot = AUTO
) -> DataFrame:
    """Sample standard deviation of the last `window` returns."""
    _check_window(window)

    def add(df: DataFrame, over: WindowSpec) -> DataFrame:
        value = F.col("daily_return")
        return df.withColumn("daily_return", _return(over)).withColumn(
            "volatility", _full_frame(value, over, window, F.stddev_samp(value))
        )

    # `window` returns need one more close.
    return over_series(_closes(bars, ticker), window, add, slot)


def rolling_close_average(
    bars: DataFrame, ticker: str | None = None, window: int = 5, slot: Slot = AUTO
) -> DataFrame:
    """Mean of the last `window` closes."""
    _check_window(window)
    value = F.col("close")
    return over_series(
        _closes(bars, ticker),
        window - 1,
        lambda df, over: df.withColumn("rolling_close", _full_frame(value, over, window, F.avg(value))),
        slot,
    )
