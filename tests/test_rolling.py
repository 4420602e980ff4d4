"""Rolling windows against a plain Python computation, for every split."""

import random
import statistics
from datetime import datetime, timedelta

import pytest

from candlekit.operators import rolling
from candlekit.schema import BARS_SCHEMA

START = datetime(2024, 1, 1, 9, 30)


def bars_of(spark, series):
    rows = [
        (ticker, at, close, close, close, close, 1) for ticker, points in series.items() for at, close in points
    ]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, BARS_SCHEMA)


def brute_force(points, window):
    """(timestamp, return, volatility, rolling close) per point."""
    points = sorted(points)
    closes = [close for _, close in points]
    returns = [None]
    for before, now in zip(closes, closes[1:]):
        returns.append(now / before - 1 if before else None)
    for i, (at, _) in enumerate(points):
        last = returns[max(0, i - window + 1) : i + 1]
        full = len(last) == window and None not in last and window > 1
        mean = sum(closes[i - window + 1 : i + 1]) / window if i + 1 >= window else None
        yield at, returns[i], statistics.stdev(last) if full else None, mean


def check(bars, series, window, slot):
    volatility = rolling.volatility(bars, None, window, slot).collect()
    averages = rolling.rolling_close_average(bars, None, window, slot).collect()
    returns = rolling.bar_returns(bars, None, slot).collect()
    found = {(row["ticker"], row["timestamp"]): [row["daily_return"], row["volatility"]] for row in volatility}
    assert len(volatility) == len(averages) == len(returns) == len(found) == bars.count()
    for row in averages:
        found[row["ticker"], row["timestamp"]].append(row["rolling_close"])
    for row in returns:
        assert found[row["ticker"], row["timestamp"]][0] == row["daily_return"]
    for ticker, points in series.items():
        for at, *expected in brute_force(points, window):
            assert found[ticker, at] == [
                value if value is None else pytest.approx(value, abs=1e-9) for value in expected
            ]


@pytest.fixture(scope="module")
def uneven():
    """One long ticker with gaps and bursts, and a few short ones."""
    rng = random.Random(3)
    at, points = START, []
    for _ in range(300):
        at += timedelta(seconds=rng.choice([1, 1, 2, 60, 3600, 86400 * 3]))
        points.append((at, round(rng.uniform(0, 20), 2) if rng.random() > 0.05 else 0.0))
    short = {f"T{n}": [(START + timedelta(days=i), 10.0 + i * n) for i in range(n)] for n in range(1, 8)}
    return {"LONG": points, **short}


@pytest.mark.parametrize("window, slot", [(5, None), (5, 1), (5, 60), (5, 86400), (5, 10**9), (2, 3600), (20, 86400)])
def test_any_slot_gives_the_same_values(spark, uneven, window, slot):
    check(bars_of(spark, uneven), uneven, window, slot)


@pytest.fixture
def many_ranges(spark):
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("window", [5, 20])
def test_range_slots_give_the_same_values(spark, uneven, many_ranges, window):
    bars = bars_of(spark, uneven)
    slots = rolling._with_slots(bars, rolling.RANGES).groupBy("_slot").count().collect()
    assert len(slots) == 7 and max(row["count"] for row in slots) < 100
    check(bars, uneven, window, rolling.RANGES)


def test_slot_follows_the_longest_ticker(spark):
    every_minute = [(START + timedelta(minutes=i), 1.0 + i % 7) for i in range(300)]
    series = {"LONG": every_minute, "SHORT": every_minute[:40]}
    bars = bars_of(spark, series)
    assert rolling.choose_slot(bars, 5) is None
    width = rolling.choose_slot(bars, 5, task_bars=50)
    assert 50 <= width / 60 <= 60  # room for isqrt(2 * 5 * 300) = 54 bars
    check(bars, series, 5, width)


def test_bars_crowded_in_time_are_cut_into_ranges(spark, many_ranges, monkeypatch):
    crowd = [(START + timedelta(microseconds=i), 1.0 + i % 11) for i in range(290)]
    series = {"LONG": crowd + [(START + timedelta(days=i + 1), 2.0 + i) for i in range(10)]}
    bars = bars_of(spark, series)
    assert rolling.choose_slot(bars, 5, task_bars=50) != rolling.RANGES
    monkeypatch.setattr(rolling, "UNEVENNESS", 4)
    assert rolling.choose_slot(bars, 5, task_bars=50) == rolling.RANGES
    monkeypatch.setattr(rolling.choose_slot, "__defaults__", (50,))
    check(bars, series, 5, rolling.AUTO)


def test_sparse_bars_do_not_all_become_edges(spark, many_ranges, monkeypatch):
    """Slots that suit a dense ticker would leave a sparse one with a bar each."""
    series = {
        "DENSE": [(START + timedelta(seconds=i), 1.0 + i % 7) for i in range(2000)],
        "SPARSE": [(START + timedelta(days=i), 1.0 + i % 5) for i in range(300)],
    }
    bars = bars_of(spark, series)
    assert rolling.choose_slot(bars.filter("ticker = 'DENSE'"), 5, task_bars=50) != rolling.RANGES
    assert rolling.choose_slot(bars, 5, task_bars=50) == rolling.RANGES
    monkeypatch.setattr(rolling.choose_slot, "__defaults__", (50,))
    check(bars, series, 5, rolling.AUTO)


def test_automatic_split(spark, uneven, monkeypatch):
    bars = bars_of(spark, uneven)
    monkeypatch.setattr(rolling.choose_slot, "__defaults__", (50,))
    plan = rolling.volatility(bars, None, 5)
    assert "_slot" in plan._jdf.queryExecution().toString()
    check(bars, uneven, 5, rolling.AUTO)


@pytest.mark.parametrize("window, slot", [(1, None), (3, None), (5, None), (1, 86400 * 4), (5, 86400 * 4)])
def test_zero_prices(spark, window, slot):
    closes = [10, 11, 0, 12, 13, 14, 15, 16, 0, 0, 3, 4, 5, 6]
    series = {"Z": [(START + timedelta(days=i), float(close)) for i, close in enumerate(closes)]}
    check(bars_of(spark, series), series, window, slot)


def test_linear_series(spark):
    series = {"AAPL": [(START + timedelta(days=i), 185.75 + i) for i in range(10)]}
    check(bars_of(spark, series), series, 5, None)


def test_single_bar_keeps_its_row(spark):
    bars = bars_of(spark, {"ONE": [(START, 5.0)]})
    assert [tuple(row) for row in rolling.volatility(bars, "ONE").collect()] == [("ONE", START, 5.0, None, None)]


def test_bad_arguments(spark, no_bars):
    with pytest.raises(ValueError):
        rolling.volatility(no_bars, window=0)
    with pytest.raises(ValueError):
        rolling.rolling_close_average(no_bars, window=0)
    with pytest.raises(ValueError):
        rolling.bar_returns(no_bars, slot=0)
    assert rolling.volatility(no_bars).count() == 0
