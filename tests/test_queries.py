"""Golden values on a ten-bar fixture, for both stores."""

from datetime import date, datetime

import pytest

from candlekit import QueryEngine, StarStore, WideStore

AAPL, GOOGL = "AAPL", "GOOGL"


@pytest.fixture(scope="module")
def engine(spark, main_bars, tmp_path_factory):
    root = tmp_path_factory.mktemp("stores")
    star = StarStore(spark, str(root / "star"))
    wide = WideStore(spark, str(root / "wide"))
    assert star.upsert(main_bars) == 10
    assert wide.save(main_bars) == str(root / "wide")
    return QueryEngine(star, wide)


@pytest.fixture(params=["star", "wide"])
def source(request):
    return request.param


def near(values):
    return [pytest.approx(value, abs=1e-10) if isinstance(value, float) else value for value in values]


def column(df, name):
    return [row[name] for row in df.collect()]


def test_price_range(engine, source):
    rows = engine.get_price_range(AAPL, datetime(2024, 1, 2), datetime(2024, 1, 3, 23, 59), source)
    assert rows.columns == ["ticker", "timestamp", "open", "high", "low", "close", "volume"]
    found = rows.collect()
    assert [row["timestamp"] for row in found] == [
        datetime(2024, 1, 2, 9, 30),
        datetime(2024, 1, 2, 10),
        datetime(2024, 1, 3, 9, 30),
        datetime(2024, 1, 3, 10),
    ]
    assert tuple(found[0])[2:] == (185.5, 186.0, 185.0, 185.75, 1000000)


def test_range_ends_at_the_given_instant(engine, source):
    assert engine.get_price_range(AAPL, "2024-01-02", date(2024, 1, 4), source).count() == 4
    assert engine.get_price_range(AAPL, "2024-01-02", "2024-01-04 09:30", source).count() == 5


def test_unknown_ticker(engine, source):
    empty = engine.get_price_range("NONE", "2024-01-01", "2024-12-31", source)
    assert empty.count() == 0
    assert dict(empty.dtypes)["timestamp"] == "timestamp_ntz"
    assert engine.get_avg_volume("NONE", source) == 0.0
    assert engine.get_weekly_returns("NONE", source).count() == 0
    assert engine.get_volatility("NONE", 5, source).count() == 0


def test_avg_volume(engine, source):
    assert engine.get_avg_volume(AAPL, source) == 1016000.0


def test_avg_daily_volume(engine, source):
    rows = [tuple(row) for row in engine.get_avg_daily_volume(source).collect()]
    assert rows == [
        (AAPL, pytest.approx(1693333.3333, abs=1e-4)),
        (GOOGL, pytest.approx(1336666.6667, abs=1e-4)),
    ]


def test_weekly_returns(engine, source):
    week = (datetime(2024, 1, 2, 9, 30), datetime(2024, 1, 4, 9, 30))
    rows = engine.get_weekly_returns(AAPL, source).collect()
    assert [tuple(row) for row in rows] == [(AAPL, *week, 185.5, 187.75, pytest.approx(1.2129380054))]
    rows = engine.get_weekly_returns(None, source).collect()
    assert [tuple(row) for row in rows][1] == (GOOGL, *week, 140.0, 141.75, pytest.approx(1.25))


def test_first_last_per_day(engine, source):
    rows = engine.get_first_last_prices_per_day(None, source).collect()
    assert [(row["ticker"], str(row["date"]), row["first_price"], row["last_price"]) for row in rows] == [
        (AAPL, "2024-01-02", 185.5, 186.0),
        (AAPL, "2024-01-03", 186.25, 187.0),
        (AAPL, "2024-01-04", 187.25, 187.75),
        (GOOGL, "2024-01-02", 140.0, 140.5),
        (GOOGL, "2024-01-03", 140.75, 141.25),
        (GOOGL, "2024-01-04", 141.5, 141.75),
    ]
    assert (rows[0]["first_timestamp"], rows[0]["last_timestamp"]) == (
        datetime(2024, 1, 2, 9, 30),
        datetime(2024, 1, 2, 10),
    )
    one = engine.get_daily_first_last_prices(GOOGL, source).collect()
    assert one == rows[3:]


def test_top_tickers(engine, source):
    def top(end, limit=2):
        rows = engine.get_top_tickers_by_return("2024-01-02", end, limit, source).collect()
        return [(row["ticker"], round(row["return_pct"], 10)) for row in rows]

    assert top("2024-01-04 23:59") == [(GOOGL, 1.25), (AAPL, 1.2129380054)]
    assert top("2024-01-04") == [(GOOGL, 0.8928571429), (AAPL, 0.8086253369)]
    assert top("2024-01-04", 1) == [(GOOGL, 0.8928571429)]
    assert top("2024-01-04", 0) == []
    assert top("2024-01-01") == []
    with pytest.raises(ValueError):
        top("2024-01-04", -1)


RETURNS = {
    AAPL: [None, 0.0013458950, 0.0040322581, 0.0013386881, 0.0040106952],
    GOOGL: [None, 0.0017825312, 0.0035587189, 0.0017730496, 0.0035398230],
}
VOLATILITY_3 = {
    AAPL: [None, None, None, 0.0015530571, 0.0015489462],
    GOOGL: [None, None, None, 0.0010282304, 0.0010255454],
}
ROLLING_3 = {
    AAPL: [None, None, 186.1666666667, 186.5833333333, 187.1666666667],
    GOOGL: [None, None, 140.5833333333, 140.9166666667, 141.3333333333],
}


@pytest.mark.parametrize("ticker", [AAPL, GOOGL])
def test_rolling_one_ticker(engine, source, ticker):
    rows = engine.get_volatility(ticker, 3, source)
    assert rows.columns == ["timestamp", "close", "daily_return", "volatility"]
    assert column(rows, "daily_return") == near(RETURNS[ticker])
    assert column(rows, "volatility") == near(VOLATILITY_3[ticker])
    rows = engine.get_rolling_close_average(ticker, 3, source)
    assert rows.columns == ["timestamp", "close", "rolling_close"]
    assert column(rows, "rolling_close") == near(ROLLING_3[ticker])


def test_rolling_all_tickers(engine, source):
    rows = engine.get_volatility(None, 3, source)
    assert rows.columns == ["ticker", "timestamp", "close", "daily_return", "volatility"]
    rows = rows.orderBy("ticker", "timestamp")
    assert column(rows, "volatility") == near(VOLATILITY_3[AAPL] + VOLATILITY_3[GOOGL])


def test_window_longer_than_the_series(engine, source):
    assert column(engine.get_volatility(AAPL, 5, source), "volatility") == [None] * 5


def test_compare_sources(engine):
    result = engine.compare_sources(AAPL, datetime(2024, 1, 2), datetime(2024, 1, 4))
    assert result["match"] is True
    assert result["star"]["record_count"] == result["wide"]["record_count"] == 4
    assert result["star"]["columns"] == result["wide"]["columns"]
    assert engine.compare_sources("NONE", "2024-01-02", "2024-01-04")["match"] is True
    one_sided = QueryEngine(star=engine.star).compare_sources(AAPL, "2024-01-02", "2024-01-04")
    assert one_sided["match"] is False and one_sided["wide"] == {}
    assert QueryEngine().compare_sources(AAPL, "2024-01-02", "2024-01-04")["match"] is False


CALLS = {
    "get_price_range": (AAPL, "2024-01-02", "2024-01-04"),
    "get_avg_volume": (AAPL,),
    "get_avg_daily_volume": (),
    "get_weekly_returns": (AAPL,),
    "get_daily_first_last_prices": (AAPL,),
    "get_first_last_prices_per_day": (),
    "get_top_tickers_by_return": ("2024-01-02", "2024-01-04"),
    "get_rolling_close_average": (AAPL,),
    "get_volatility": (AAPL,),
}


@pytest.mark.parametrize("name", CALLS)
def test_bad_source(engine, name):
    with pytest.raises(ValueError, match="Invalid or unavailable source: other"):
        getattr(engine, name)(*CALLS[name], source="other")
    with pytest.raises(ValueError, match="unavailable source"):
        getattr(QueryEngine(star=engine.star), name)(*CALLS[name], source="wide")
    with pytest.raises(ValueError, match="unavailable source"):
        getattr(QueryEngine(wide=engine.wide), name)(*CALLS[name], source="star")


def test_other_source_names(engine):
    assert engine.get_avg_volume(AAPL, "sqlite") == engine.get_avg_volume(AAPL, "parquet") == 1016000.0
