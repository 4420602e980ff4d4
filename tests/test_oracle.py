"""Every registered query against its SQL. ORACLE_SF_DIR selects the data."""

import os

import pytest

import __spark_entry__ as registry
from oracle import connect, spark_result, sql_result

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query(spark, database, name):
    columns, rows = spark_result(registry.queries()[name](spark, FOLDER))
    expected_columns, expected = sql_result(database, registry.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    differing = [(row, other) for row, other in zip(rows, expected) if repr(row) != repr(other)]
    assert not differing, f"{len(differing)} of {len(rows)} rows differ, first: {differing[0]}"
    assert rows, "no rows to compare"


# The columns by which the rows of a query come, in the order in which Spark delivers them.
DELIVERED = {
    "price_range": ["timestamp"],
    "star_price_range": ["timestamp"],
    "wide_price_range": ["timestamp"],
    "wide_period_range": ["timestamp"],
    "avg_daily_volume": ["ticker"],
    "supplier_avg_daily_volume": ["ticker"],
    "weekly_returns_all": ["ticker", "week_start"],
    "supplier_weekly_returns": ["ticker", "week_start"],
    "first_last_per_day": ["ticker", "date"],
    "user_first_last_per_day": ["ticker", "date"],
    "top_tickers_by_return": ["-return_pct", "ticker"],
    "top_suppliers_by_return": ["-return_pct", "ticker"],
    "top_tickers_null_prices": ["-return_pct", "ticker"],
}


def out_of_order(df, keys):
    """Pairs of neighbours in the wrong order: rows within a partition are compared there, and the last key of
    a partition with the first of the next one that has rows."""

    def ends(part, rows):
        first = last = None
        wrong = 0
        for row in rows:
            key = [-row[name[1:]] if name[0] == "-" else row[name] for name in keys]
            wrong += last is not None and key < last
            first, last = first or key, key
        yield part, first, last, wrong

    parts = [part for part in sorted(df.rdd.mapPartitionsWithIndex(ends).collect()) if part[1]]
    return sum(part[3] for part in parts) + sum(b[1] < a[2] for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("name", DELIVERED)
def test_rows_come_in_order(spark, name):
    rows = registry.queries()[name](spark, FOLDER)
    assert out_of_order(rows, DELIVERED[name]) == 0


def test_wrong_orders_are_noticed(spark):
    rows = spark.range(0, 100, 1, 4)
    assert out_of_order(rows, ["id"]) == 0
    assert out_of_order(rows, ["-id"]) == 99
    assert out_of_order(rows.orderBy((rows["id"] + 50) % 100), ["id"]) == 1


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["ticker", "return_pct"]
    assert result.count() == 3
