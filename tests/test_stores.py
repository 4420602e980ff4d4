import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlekit import QueryEngine, StarStore, ValidationError, WideStore, build_all_assets, build_wide_store
from candlekit.operators import integrity, upsert
from candlekit.schema import BARS_SCHEMA, PRICES_SCHEMA
from candlekit.sources import tables
from candlekit.sources.files import write_text
from conftest import bar_rows

CHANGED = """
AAPL 2024-01-02 09:30  1 2 1 2 7
AAPL 2024-02-01 09:30  3 4 3 4 8
MSFT 2024-01-02 09:30  5 6 5 6 9
"""


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(list(bar_rows(CHANGED)), BARS_SCHEMA)


@pytest.fixture
def star(spark, tmp_path):
    return StarStore(spark, str(tmp_path / "star"))


@pytest.fixture
def wide(spark, tmp_path):
    return WideStore(spark, str(tmp_path / "wide"))


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def after_upsert(old, new):
    rows = {row[:2]: row for row in rows_of(old)}
    rows.update({row[:2]: row for row in rows_of(new)})
    return sorted(rows.values())


def files_below(path):
    return set(glob.glob(path + "/**/*.parquet", recursive=True))


@pytest.mark.parametrize("store", ["star", "wide"])
def test_upsert(request, main_bars, changes, store):
    store = request.getfixturevalue(store)
    assert store.upsert(main_bars) == 10
    assert rows_of(store.bars()) == rows_of(main_bars)
    assert store.upsert(main_bars) == 10
    assert rows_of(store.bars()) == rows_of(main_bars)
    assert store.upsert(changes) == 3
    assert rows_of(store.bars()) == after_upsert(main_bars, changes)
    assert store.bars("AAPL").count() == 6


@pytest.mark.parametrize("store", ["star", "wide"])
def test_upsert_without_broadcast(request, spark, main_bars, changes, store):
    store = request.getfixturevalue(store)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        store.upsert(main_bars)
        store.upsert(changes)
    finally:
        spark.conf.set(key, old)
    assert rows_of(store.bars()) == after_upsert(main_bars, changes)


def test_upsert_leaves_other_partitions_alone(wide, main_bars, changes):
    wide.upsert(main_bars)
    before = files_below(wide.path)
    wide.upsert(changes.filter("ticker = 'MSFT' or timestamp >= '2024-02-01'"))
    assert before < files_below(wide.path)
    wide.upsert(changes)
    kept = before & files_below(wide.path)
    assert kept == {name for name in before if "ticker=GOOGL" in name}


def test_upsert_of_repeated_keys(spark, star, wide, main_bars):
    first = main_bars.filter("ticker = 'AAPL'").limit(1)
    batch = first.selectExpr("*", "1 as seq").union(
        first.selectExpr("ticker", "timestamp", "open", "high", "low", "close", "0L as volume", "2 as seq")
    )
    for store in (star, wide):
        store.upsert(batch, order="seq")
        assert [row["volume"] for row in store.bars().collect()] == [0]


@pytest.mark.parametrize("seqs, message", [((None, None), "Found 2 records without a value of seq"), ((1, 1), "Found 1 values of seq")])
def test_upsert_needs_an_order(spark, star, wide, main_bars, seqs, message):
    bar = main_bars.limit(1).collect()[0]
    batch = spark.createDataFrame([(*bar, seq) for seq in seqs], T.StructType([*BARS_SCHEMA.fields, T.StructField("seq", T.IntegerType())]))
    for store in (star, wide):
        store.upsert(spark.createDataFrame([bar], BARS_SCHEMA))
        with pytest.raises(ValidationError, match=message):
            store.upsert(batch, order="seq")
        assert [row["volume"] for row in store.bars().collect()] == [bar["volume"]]


def test_upsert_needs_a_ticker(spark, star, wide):
    nameless = spark.createDataFrame([(None, datetime(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1)], BARS_SCHEMA)
    for store in (star, wide):
        with pytest.raises(ValidationError, match="Found 1 records without a ticker"):
            store.upsert(nameless)
        assert store.bars().count() == 0


def in_two_files(store, main_bars):
    """The first day and the days after it, in files of their own."""
    first = main_bars.filter("timestamp < '2024-01-03'")
    store.upsert(first)
    early = files_below(store.path)
    store.upsert(main_bars.filter("timestamp >= '2024-01-03'"))
    return early, files_below(store.path) - early


def price_files(names):
    return {name for name in names if "/tickers/" not in name}


@pytest.mark.parametrize("store", ["star", "wide"])
def test_upsert_replaces_only_files_with_a_key_of_the_batch(request, spark, main_bars, store):
    store = request.getfixturevalue(store)
    early, late = in_two_files(store, main_bars)
    touched = {name: os.stat(name).st_mtime_ns for name in early | late}
    change = spark.createDataFrame([("AAPL", datetime(2024, 1, 3, 10), 1.0, 2.0, 1.0, 2.0, 7)], BARS_SCHEMA)
    store.upsert(change)
    assert rows_of(store.bars()) == after_upsert(main_bars, change)
    kept = files_below(store.path) & set(touched)
    assert early <= kept and all(os.stat(name).st_mtime_ns == touched[name] for name in kept)
    # The wide store has a file per ticker there, the star one for the month.
    assert len(price_files(late) - kept) == 1
    assert not glob.glob(store.path + "/**/_replace-*", recursive=True)


@pytest.mark.parametrize("store", ["star", "wide"])
def test_many_replaced_files_are_joined(request, main_bars, changes, monkeypatch, store):
    store = request.getfixturevalue(store)
    in_two_files(store, main_bars)
    monkeypatch.setattr(tables, "NAMED_FILES", 1)
    store.upsert(changes.union(main_bars.filter("ticker = 'GOOGL'")))
    assert rows_of(store.bars()) == after_upsert(main_bars, changes)


@pytest.mark.parametrize("store", ["star", "wide"])
@pytest.mark.parametrize("step", ["move", "delete"])
def test_the_next_write_finishes_an_interrupted_replacement(request, no_bars, main_bars, changes, monkeypatch, store, step):
    store = request.getfixturevalue(store)
    in_two_files(store, main_bars)
    original, calls = getattr(tables, step), []

    def fail(*args):
        calls.append(args)
        if len(calls) > 1:
            raise RuntimeError("lost")
        original(*args)

    monkeypatch.setattr(tables, step, fail)
    with pytest.raises(RuntimeError):
        store.upsert(changes)
    monkeypatch.undo()
    store.upsert(no_bars)
    assert rows_of(store.bars()) == after_upsert(main_bars, changes)
    assert not glob.glob(store.path + "/**/_replace-*", recursive=True)


@pytest.mark.parametrize("store", ["star", "wide"])
def test_a_replacement_that_was_not_complete_leaves_the_store_as_it_was(request, no_bars, main_bars, changes, monkeypatch, store):
    store = request.getfixturevalue(store)
    in_two_files(store, main_bars)

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "write_text", fail)
    with pytest.raises(RuntimeError):
        store.upsert(changes)
    monkeypatch.undo()
    assert rows_of(store.bars()) == rows_of(main_bars)
    store.upsert(changes)
    assert rows_of(store.bars()) == after_upsert(main_bars, changes)
    assert not glob.glob(store.path + "/**/_replace-*", recursive=True)


def test_upsert_of_a_key_that_was_saved_twice(wide, main_bars, changes):
    wide.save(main_bars)
    wide.save(main_bars.withColumn("sector", F.lit("tech")).drop("sector"))
    wide.upsert(main_bars)
    assert rows_of(wide.bars()) == rows_of(main_bars)


@pytest.mark.parametrize("store", ["star", "wide"])
def test_ordered_upsert_compares_stored_keys(request, spark, store):
    """Two spellings of one time are one key."""
    store = request.getfixturevalue(store)
    rows = [("A", "2024-01-02 09:30:00", 1), ("A", "2024-01-02T09:30:00", 2), ("A", "2024-01-02 09:30", 3), ("B", "2024-01-02", 4)]
    batch = spark.createDataFrame([(t, at, 1.0, 1.0, 1.0, 1.0, n, n) for t, at, n in rows],
                                  "ticker string, timestamp string, open double, high double, low double, close double,"
                                  " volume bigint, seq int")
    store.upsert(batch, order="seq")
    assert [(row["ticker"], row["volume"]) for row in store.bars().orderBy("ticker").collect()] == [("A", 3), ("B", 4)]
    assert store.bars().columns == BARS_SCHEMA.fieldNames()
    store.upsert(batch.filter("seq < 3").drop("seq"), order="volume")
    assert [row["volume"] for row in store.bars("A").collect()] == [2]
    with pytest.raises(ValidationError, match="Found 1 values of seq"):
        store.upsert(batch.withColumn("seq", F.least("seq", F.lit(2))), order="seq")
    if isinstance(store, StarStore):
        assert all(row["violations"] == 0 for row in store.audit().collect())


@pytest.mark.parametrize("store", ["star", "wide"])
def test_empty_store(request, spark, store):
    store = request.getfixturevalue(store)
    assert store.bars().count() == 0
    assert store.bars("AAPL").count() == 0
    assert store.bars().schema.simpleString() == BARS_SCHEMA.simpleString()
    engine = QueryEngine(star=store) if isinstance(store, StarStore) else QueryEngine(wide=store)
    source = "star" if isinstance(store, StarStore) else "wide"
    assert engine.get_avg_volume("AAPL", source) == 0.0
    assert engine.get_volatility(None, 5, source).count() == 0
    assert engine.get_top_tickers_by_return("2024-01-01", "2024-12-31", 3, source).count() == 0


@pytest.mark.parametrize("store", ["star", "wide"])
def test_upsert_of_nothing(request, no_bars, store):
    store = request.getfixturevalue(store)
    assert store.upsert(no_bars) == 0
    assert store.bars().count() == 0


# --- wide store ---------------------------------------------------------


def test_wide_layout_and_round_trip(spark, wide, main_bars):
    wide.save(main_bars)
    assert sorted(name for name in os.listdir(wide.path) if "=" in name) == ["ticker=AAPL", "ticker=GOOGL"]
    again = WideStore(spark, wide.path)
    assert again.bars().schema.simpleString() == BARS_SCHEMA.simpleString()
    assert rows_of(again.bars()) == rows_of(main_bars)
    assert rows_of(again.bars("GOOGL")) == rows_of(main_bars.filter("ticker = 'GOOGL'"))
    assert again.bars("NONE").count() == 0


def test_saving_twice_appends(wide, main_bars):
    wide.save(main_bars)
    wide.save(main_bars)
    assert wide.bars().count() == 20


def test_unpartitioned_store_is_replaced(spark, tmp_path, main_bars, changes):
    store = WideStore(spark, str(tmp_path / "flat"), partitioned=False)
    assert store.verify_integrity().valid
    store.save(main_bars)
    store.save(changes)
    assert rows_of(store.bars()) == rows_of(changes)
    assert store.bars("AAPL").count() == 2
    store.save(store.bars().filter("ticker = 'AAPL'"))  # reads the table it replaces
    assert store.bars().count() == 2
    check = store.verify_integrity()
    assert (check.valid, check.total_records) == (True, 2)
    assert rows_of(check.tickers) == [("AAPL",)]
    with pytest.raises(ValueError):
        store.upsert(changes)


def test_text_timestamps_are_converted(spark, wide):
    wide.save(spark.createDataFrame([("A", "2024-01-02T09:30:00", 1.0, 1.0, 1.0, 1.0, 1)],
                                    "ticker string, timestamp string, open double, high double, low double,"
                                    " close double, volume bigint"))
    assert wide.bars().first()["timestamp"] == datetime(2024, 1, 2, 9, 30)


def test_unusual_symbols(spark, wide, star):
    symbols = ["007", "1%", "A B", "BRK/B", "X+Y=Z"]
    rows = [(ticker, datetime(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1) for ticker in symbols]
    bars = spark.createDataFrame(rows, BARS_SCHEMA)
    wide.save(bars)
    star.upsert(bars)
    for store in (wide, star):
        assert sorted(row["ticker"] for row in store.bars().collect()) == symbols
    for ticker in symbols:
        assert [row["ticker"] for row in wide.bars(ticker).collect()] == [ticker]
    assert [row["ticker"] for row in star.bars("X+Y=Z").collect()] == ["X+Y=Z"]
    assert rows_of(wide.verify_integrity().tickers) == [(ticker,) for ticker in symbols]


def test_extra_columns_are_kept(spark, tmp_path, main_bars):
    bars = main_bars.selectExpr("*", "'tech' as sector")
    store = build_wide_store(spark, bars, str(tmp_path / "wide"))
    assert store.bars().columns == [*BARS_SCHEMA.fieldNames(), "sector"]
    assert {row["sector"] for row in store.bars().collect()} == {"tech"}
    assert WideStore(spark, store.path).bars().columns == [*BARS_SCHEMA.fieldNames(), "sector"]
    # A batch that does not have the column changes it for no row.
    store.upsert(main_bars.filter("ticker = 'AAPL'").limit(1).withColumn("volume", F.lit(7).cast("int")))
    assert [row["sector"] for row in store.bars().collect()] == ["tech"] * 10
    assert [row["sector"] for row in store.bars("AAPL").collect()] == ["tech"] * 5
    with pytest.raises(ValidationError, match="does not have"):
        WideStore(spark, store.path).upsert(main_bars.selectExpr("*", "1 as other"))


@pytest.mark.parametrize(
    "change",
    ["'' as ticker", "cast(null as string) as ticker", "'garbage' as timestamp", "1.5D as volume", "'x' as close"],
)
def test_rows_that_cannot_be_stored(spark, tmp_path, main_bars, change):
    name = change.split()[-1]
    bad = main_bars.withColumn(name, F.expr(change.rsplit(" as ", 1)[0]))
    for store in (WideStore(spark, str(tmp_path / "wide")), StarStore(spark, str(tmp_path / "star"))):
        with pytest.raises(ValidationError):
            store.upsert(bad)
        assert store.bars().count() == 0
    with pytest.raises(ValidationError):
        WideStore(spark, str(tmp_path / "wide")).save(bad)
    with pytest.raises(ValidationError, match="close"):
        WideStore(spark, str(tmp_path / "wide")).save(main_bars.drop("close"))


def test_other_types_are_cast(spark, tmp_path, main_bars):
    other = main_bars.selectExpr(
        "ticker", "cast(timestamp as string) as timestamp", "cast(open as decimal(10,2)) as open", "high", "low", "close",
        "cast(volume as double) as volume",
    )
    wide = WideStore(spark, str(tmp_path / "wide"))
    wide.save(other)
    wide.upsert(main_bars)
    wide.upsert(other)
    assert rows_of(wide.bars()) == rows_of(main_bars)


def test_repeated_keys_need_an_order(spark, tmp_path, main_bars):
    twice = main_bars.unionByName(main_bars.withColumn("open", F.lit(2.0)))
    for store in (WideStore(spark, str(tmp_path / "wide")), StarStore(spark, str(tmp_path / "star"))):
        with pytest.raises(ValidationError, match="10 keys"):
            store.upsert(twice)


def test_extra_columns_with_dots(spark, tmp_path, main_bars):
    store = WideStore(spark, str(tmp_path / "wide"))
    store.upsert(main_bars.withColumn("adj.close", F.lit(1.5)))
    store.upsert(main_bars.withColumn("adj.close", F.lit(2.5)).filter("ticker = 'AAPL'"))
    store.upsert(main_bars)
    rows = store.bars().select("ticker", "`adj.close`").distinct()
    assert rows_of(rows) == [("AAPL", 2.5), ("GOOGL", 1.5)]


def test_no_numbers_are_staged_for_known_tickers(spark, star, main_bars):
    star.upsert(main_bars)
    staging = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(staging + "/candlekit/*"))
    star.upsert(main_bars)
    assert set(glob.glob(staging + "/candlekit/*")) == before


def test_metadata_comes_from_one_row(spark, star):
    rows = [("A", "Alpha", "NYSE"), ("A", "Beta", "AMEX")]
    star.add_tickers(spark.createDataFrame(rows, "symbol STRING, name STRING, exchange STRING"))
    assert star.tickers().select("symbol", "name", "exchange").collect() == [rows[1]]


def test_integrity(wide, main_bars):
    wide.save(main_bars)
    check = wide.verify_integrity()
    assert (check.valid, check.total_records) == (True, 10)
    assert rows_of(check.tickers) == [("AAPL",), ("GOOGL",)]
    assert rows_of(check.partitions.select("ticker", "records", "bad_files")) == [("AAPL", 5, 0), ("GOOGL", 5, 0)]
    assert check.errors.count() == 0


def test_integrity_of_an_empty_store(spark, tmp_path):
    (tmp_path / "there").mkdir()
    for name in ("there", "absent"):
        check = WideStore(spark, str(tmp_path / name)).verify_integrity()
        assert (check.valid, check.total_records) == (True, 0)
        assert check.partitions.count() == 0


def test_integrity_names_bad_files(wide, main_bars):
    wide.save(main_bars)
    wide.save(main_bars)
    victim, other = sorted(glob.glob(wide.path + "/ticker=AAPL/*.parquet"))
    with open(victim, "wb") as file:
        file.write(b"not parquet")
    with open(other, "r+b") as file:  # sound footer, damaged data
        file.seek(4)
        file.write(b"\xff" * 60)
    os.remove(os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc"))
    os.remove(os.path.join(os.path.dirname(other), "." + os.path.basename(other) + ".crc"))
    check = wide.verify_integrity()
    assert not check.valid
    assert check.total_records == 10
    assert rows_of(check.partitions) == [("AAPL", 2, 0, 2), ("GOOGL", 2, 10, 0)]
    errors = check.errors.collect()
    assert {os.path.basename(row["file"]) for row in errors} == {os.path.basename(victim), os.path.basename(other)}
    assert all("Error reading" in row["error"] for row in errors)


def test_damage_in_one_row_group(spark, tmp_path, main_bars):
    """The groups before and after it are read, but the file does not count."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "wide" / "ticker=A"
    folder.mkdir(parents=True)
    table = pa.table({"close": [float(i) for i in range(4000)]})
    for name in ("sound", "damaged"):
        pq.write_table(table, folder / f"{name}.parquet", row_group_size=1000, compression="snappy")
    groups = pq.ParquetFile(folder / "damaged.parquet").metadata
    with open(folder / "damaged.parquet", "r+b") as file:
        file.seek(groups.row_group(2).column(0).data_page_offset)
        file.write(b"\xff" * 200)
    files = integrity.list_files(spark, str(tmp_path / "wide"))
    assert integrity.row_groups(files).count() == 8
    check = WideStore(spark, str(tmp_path / "wide")).verify_integrity()
    assert rows_of(check.partitions) == [("A", 2, 4000, 1)]
    (error,) = check.errors.collect()
    assert error["file"].endswith("damaged.parquet") and error["records"] == 0


# --- layout of the wide store -------------------------------------------


def test_periods(spark, tmp_path, main_bars, changes):
    for period, folders in (("month", {"2024-01-01", "2024-02-01"}), ("year", {"2024-01-01"})):
        store = WideStore(spark, str(tmp_path / period), period=period)
        store.save(main_bars)
        store.upsert(changes)
        expected = after_upsert(main_bars, changes)
        assert {name.split(f"bar_{period}=")[1][:10] for name in files_below(store.path)} == folders
        # A stored table keeps its layout, whatever is asked for, and also without its description.
        for again in (WideStore(spark, store.path), WideStore(spark, store.path, period="month")):
            assert rows_of(again.bars()) == expected
            assert again.bars().schema.simpleString() == BARS_SCHEMA.simpleString()
        os.remove(store.path + "/_table.json")
        assert rows_of(again.bars()) == expected
        again.upsert(changes)
        assert rows_of(again.bars()) == expected
        assert rows_of(again.bars("AAPL", "2024-01-03", "2024-01-31")) == [
            row for row in expected if row[0] == "AAPL" and datetime(2024, 1, 3) <= row[1] <= datetime(2024, 1, 31)
        ]
        assert rows_of(again.bars(start="2024-02-01")) == [row for row in expected if row[1] >= datetime(2024, 2, 1)]
        check = again.verify_integrity()
        assert (check.valid, check.total_records) == (True, len(expected))
        assert rows_of(check.tickers) == [("AAPL",), ("GOOGL",), ("MSFT",)]
    with pytest.raises(ValueError):
        WideStore(spark, "x", period="day")
    with pytest.raises(ValidationError, match="bar_year"):
        store.save(main_bars.withColumn("bar_year", F.lit(1)))


def test_bounds_are_the_same_for_all_layouts(spark, tmp_path, main_bars):
    for period in (None, "month", "year"):
        store = WideStore(spark, str(tmp_path / str(period)), period=period)
        store.save(main_bars)
        assert store.bars("AAPL", "2024-01-03", "2024-01-03 09:30").count() == 1
        assert store.bars(end="2024-01-02 09:30:00").count() == 2
        assert store.bars(start="2024-01-04 09:31:00").count() == 0


def test_tables_without_a_description_are_read(spark, tmp_path, main_bars):
    path = str(tmp_path / "old")
    main_bars.withColumn("sector", F.lit("tech")).write.partitionBy("ticker").parquet(path)
    store = WideStore(spark, path, period="month")
    assert store.bars().columns == [*BARS_SCHEMA.fieldNames(), "sector"]
    assert store.bars("AAPL").columns == [*BARS_SCHEMA.fieldNames(), "sector"]
    store.upsert(main_bars.withColumn("volume", F.lit(1)))
    assert {(row["sector"], row["volume"]) for row in store.bars().collect()} == {("tech", 1)}
    assert not glob.glob(path + "/**/bar_month=*", recursive=True)
    write_text(spark, path + "/_table.json", '{"columns":')  # cut off while it was written
    assert store.bars().count() == 10


def test_reading_needs_no_job_to_learn_the_columns(spark, wide, main_bars):
    wide.save(main_bars.withColumn("sector", F.lit("tech")))
    context = spark.sparkContext
    context.setJobGroup("columns", "columns")
    try:
        for rows in (WideStore(spark, wide.path).bars(), wide.bars("AAPL"), wide.bars("NONE")):
            assert rows.columns == [*BARS_SCHEMA.fieldNames(), "sector"]
        assert list(context.statusTracker().getJobIdsForGroup("columns")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


# --- star store ---------------------------------------------------------


def test_ticker_ids(spark, star):
    first = star.add_ticker("AAPL", "Apple Inc.", "NASDAQ")
    assert star.add_ticker("AAPL", "Other", "NYSE") == first
    assert star.add_ticker("MSFT") == first + 1
    known = [tuple(row)[:4] for row in star.tickers().orderBy("ticker_id").collect()]
    assert known == [(1, "AAPL", "Apple Inc.", "NASDAQ"), (2, "MSFT", None, None)]
    assert star.tickers().filter("created_at is null").count() == 0
    assert star.ticker_id("NONE") is None


def test_new_ids_follow_known_ones(spark, star, main_bars, changes):
    star.upsert(main_bars)
    ids = {row["symbol"]: row["ticker_id"] for row in star.tickers().collect()}
    assert ids == {"AAPL": 1, "GOOGL": 2}
    star.upsert(changes)
    ids = {row["symbol"]: row["ticker_id"] for row in star.tickers().collect()}
    assert ids == {"AAPL": 1, "GOOGL": 2, "MSFT": 3}


@pytest.mark.parametrize("partitions", ["1", "7", "30"])
def test_numbers_are_consecutive_and_ordered(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = spark.range(1000).selectExpr("concat('S', reverse(lpad(id, 4, '0'))) as symbol")
        rows = upsert.number_rows(names, "symbol", "number", 11).orderBy("number").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [row["number"] for row in rows] == list(range(11, 1011))
    assert [row["symbol"] for row in rows] == sorted(row["symbol"] for row in rows)


def test_metadata_fills_name_and_exchange(spark, star, main_bars):
    metadata = spark.createDataFrame(
        [(1, "AAPL", "Apple Inc.", "NASDAQ")], "ticker_id bigint, symbol string, name string, exchange string"
    )
    star.upsert(main_bars, metadata)
    rows = rows_of(star.tickers().select("symbol", "name", "exchange"))
    assert rows == [("AAPL", "Apple Inc.", "NASDAQ"), ("GOOGL", None, None)]


def test_price_columns(star, main_bars):
    star.upsert(main_bars)
    assert star.prices().schema.simpleString() == PRICES_SCHEMA.simpleString()
    assert star.prices("2024-01-03", "2024-01-03 09:30").count() == 2


def test_audit(spark, star, main_bars):
    assert all(row["violations"] == 0 for row in star.audit().collect())
    star.upsert(main_bars)
    assert all(row["violations"] == 0 for row in star.audit().collect())
    bad = star.prices().limit(1).selectExpr(
        "99L as ticker_id", "timestamp", "cast(null as double) as open", "high", "low", "close", "volume",
        "date'2024-01-01' as month",
    )
    bad.union(bad).write.mode("append").partitionBy("month").parquet(star.prices_path)
    star.tickers().limit(1).write.mode("append").parquet(star.tickers_path)
    found = {row["check"]: row["violations"] for row in star.audit().collect()}
    assert {check: n for check, n in found.items() if n} == {
        "null_open": 2,
        "duplicate_ticker_id": 2,
        "duplicate_symbol": 2,
        "duplicate_price_key": 2,
        "orphan_price": 2,
    }


# --- pipeline -----------------------------------------------------------


def test_build_all_assets(spark, tmp_path):
    bars = tmp_path / "bars.csv"
    lines = ["Ticker,Timestamp,Open,High,Low,Close,Volume"]
    for ticker in ("aapl", "TSLA"):
        for i in range(30):
            at = datetime(2024, 1, 20, 9, 30) + timedelta(days=i)
            lines.append(f"{ticker},{at},{10 + i},{12 + i},{9 + i},{11 + i},{100 + i}")
    bars.write_text("\n".join(lines) + "\n")
    tickers = tmp_path / "symbols.csv"
    tickers.write_text("ticker_id,symbol,name,exchange\n1,AAPL,Apple Inc.,NASDAQ\n2,TSLA,Tesla Inc.,NASDAQ\n")
    paths = [str(bars), str(tickers), str(tmp_path / "star"), str(tmp_path / "wide")]
    for _ in range(2):  # the second load changes nothing
        built = build_all_assets(spark, *paths)
        assert built["rows_written"] == built["bars"].count() == 60
        assert rows_of(built["star"].bars()) == rows_of(built["wide"].bars()) == rows_of(built["bars"])
    engine = QueryEngine(built["star"], built["wide"])
    assert engine.compare_sources("AAPL", "2024-01-01", "2024-12-31")["match"] is True
    assert rows_of(built["star"].tickers().select("symbol", "exchange")) == [("AAPL", "NASDAQ"), ("TSLA", "NASDAQ")]
