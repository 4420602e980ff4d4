import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlekit.functions import parse_timestamp
from candlekit.operators import validation
from candlekit.schema import BARS_SCHEMA, ValidationError
from candlekit.session import session_settings
from candlekit.sources.csv_bars import load_and_validate, load_bars_csv, load_tickers_csv, read_text_csv

# The header and rows of the fixture.
HEADER = "ticker,timestamp,open,high,low,close,volume\n"
ROWS = [
    "AAPL,2024-01-02 09:30:00,185.50,186.00,185.00,185.75,1000000",
    "AAPL,2024-01-02 10:00:00,185.75,186.25,185.50,186.00,950000",
    "GOOGL,2024-01-02 09:30:00,140.00,140.50,139.50,140.25,800000",
    "GOOGL,2024-01-02 10:00:00,140.25,140.75,140.00,140.50,750000",
]


@pytest.fixture
def csv(tmp_path):
    def write(rows, header=HEADER, name="bars.csv"):
        path = tmp_path / name
        path.write_text(header + "\n".join(rows) + "\n")
        return str(path)

    return write


def test_valid_file(spark, csv):
    bars = load_bars_csv(spark, csv(ROWS), ["AAPL", " googl "])
    assert bars.schema.simpleString() == BARS_SCHEMA.simpleString()
    rows = sorted(bars.collect())
    assert len(rows) == 4
    assert tuple(rows[0]) == ("AAPL", datetime(2024, 1, 2, 9, 30), 185.5, 186.0, 185.0, 185.75, 1000000)


def one_row(**changes):
    values = dict(
        ticker="AAPL", timestamp="2024-01-02 09:30:00", open="185.5", high="186", low="185", close="185.75", volume="10"
    )
    return ",".join({**values, **changes}.values())


DEFECTS = {
    "unparseable timestamp": (dict(timestamp="invalid_date"), "parse timestamps: 1"),
    "null timestamp": (dict(timestamp=""), "Found 1 records with invalid timestamps"),
    "NaN timestamp": (dict(timestamp="NaN"), "Found 1 records with invalid timestamps"),
    "negative price": (dict(open="-185.5"), "Found 1 open prices out of valid range"),
    "price above maximum": (dict(high="1000000.01"), "Found 1 high prices out of valid range"),
    "infinite price": (dict(high="inf"), "Found 1 high prices out of valid range"),
    "text price": (dict(close="abc"), "Found 1 invalid close prices"),
    "Java number": (dict(close="185.75d"), "Found 1 invalid close prices"),
    "NaN price": (dict(low="NaN"), "Found 1 invalid low prices"),
    "missing price": (dict(open=""), "Found 1 invalid open prices"),
    "high below low": (dict(high="180"), "Found 1 records with invalid OHLC relationship"),
    "close above high": (dict(close="186.5"), "Found 1 records with invalid OHLC relationship"),
    "open below low": (dict(open="184.5"), "Found 1 records with invalid OHLC relationship"),
    "negative volume": (dict(volume="-1000000"), "Found 1 records with negative volume"),
    "negative fraction": (dict(volume="-0.5"), "Found 1 records with negative volume"),
    "text volume": (dict(volume="many"), "Found 1 invalid volume values"),
    "infinite volume": (dict(volume="inf"), "Found 1 invalid volume values"),
    "blank ticker": (dict(ticker="  "), "Found 1 records without a ticker"),
}


@pytest.mark.parametrize("defect", DEFECTS)
def test_one_defect(spark, defect):
    changes, message = DEFECTS[defect]
    rows = [tuple(text or None for text in row.split(",")) for row in (one_row(**changes), ROWS[2])]
    raw = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in HEADER.strip().split(",")))
    with pytest.raises(ValidationError, match=message):
        validation.require_valid(validation.coerce(raw))


@pytest.mark.parametrize(
    "changes, message",
    [
        (dict(volume="10,11"), "Failed to read CSV file: 1 rows"),
        (dict(timestamp=""), "Found 1 records with invalid timestamps"),
        (dict(open="-185.5"), "Found 1 open prices out of valid range"),
    ],
)
def test_defect_in_a_file(spark, csv, changes, message):
    with pytest.raises(ValidationError, match=message):
        load_bars_csv(spark, csv([one_row(**changes), ROWS[2]]))


@pytest.mark.parametrize(
    "row, malformed",
    [
        (ROWS[0] + ",,junk", True),  # the last field of the header is empty
        (ROWS[0] + ",,", True),
        (ROWS[0] + ',"a,b",c', True),
        (ROWS[0] + ',"a,""b"",c"', False),
        (ROWS[0] + ",", False),
        (ROWS[0], False),
    ],
)
def test_rows_longer_than_the_header(spark, csv, row, malformed):
    path = csv([ROWS[2] + ",tech", row], HEADER.strip() + ",sector\n")
    found = {r["ticker"]: r["_malformed"] for r in read_text_csv(spark, path).collect()}
    assert found == {"AAPL": malformed, "GOOGL": False}


def test_extra_headers(spark, csv):
    bars = load_bars_csv(spark, csv([ROWS[0] + ",1,2"], HEADER.strip() + ",adj.close,a`b\n"))
    assert bars.columns[-2:] == ["adj.close", "a`b"]
    assert tuple(bars.first())[-2:] == ("1", "2")
    for names in ("note, Note", "note,note", "note,Note"):
        with pytest.raises(ValidationError):
            load_bars_csv(spark, csv([ROWS[0] + ",1,2"], f"{HEADER.strip()},{names}\n"))


def test_several_timestamp_patterns(spark, csv):
    texts = ["02/01/2024 09:30", "2024.01.02 09:31", "2024-01-02 09:32:00", "2024-01-02T09:33:00"]
    path = csv([one_row(timestamp=text) for text in texts])
    bars = load_bars_csv(spark, path, timestamp_format=["dd/MM/yyyy HH:mm", "yyyy.MM.dd HH:mm", "yyyy-MM-dd HH:mm:ss"])
    assert sorted(row["timestamp"].minute for row in bars.collect()) == [30, 31, 32, 33]


def test_failed_loads_leave_nothing_staged(spark, csv):
    staged = spark.conf.get("spark.checkpoint.dir") + "/candlekit/csv-bars-*"
    before = set(glob.glob(staged))
    with pytest.raises(ValidationError):
        load_bars_csv(spark, csv([one_row(open="-1")]))
    assert set(glob.glob(staged)) == before


def test_missing_file(spark, tmp_path):
    with pytest.raises(ValidationError, match="File not found"):
        load_bars_csv(spark, str(tmp_path / "none.csv"))


def test_missing_columns(spark, csv):
    path = csv(["AAPL,2024-01-02 09:30:00,1,2,1"], "ticker,timestamp,open,high,low\n")
    with pytest.raises(ValidationError, match=r"Missing required columns: \['close', 'volume'\]"):
        load_bars_csv(spark, path)


def test_headers_equal_after_normalization(spark, csv):
    path = csv(["AAPL,2024-01-02 09:30:00,1,1,2,1,1,1"], "ticker,timestamp,Open,open,high,low,close,volume\n")
    with pytest.raises(ValidationError, match=r"Missing required columns: \['open'\]"):
        load_bars_csv(spark, path)


def test_duplicates_count_every_row(spark, csv):
    with pytest.raises(ValidationError, match="Found 2 duplicate records"):
        load_bars_csv(spark, csv([ROWS[0], ROWS[0], ROWS[2]]))


def test_missing_ticker(spark, csv):
    with pytest.raises(ValidationError, match="Missing expected tickers: 1") as raised:
        load_bars_csv(spark, csv(ROWS[:2]), {"AAPL", "GOOGL"})
    assert [row["ticker"] for row in raised.value.missing.collect()] == ["GOOGL"]


def test_all_missing_tickers_are_told(spark, csv):
    with pytest.raises(ValidationError, match="Missing expected tickers: 250") as raised:
        load_bars_csv(spark, csv(ROWS), {"AAPL", *(f"T{i}" for i in range(250))})
    assert raised.value.missing.count() == 250


def test_zone_offsets_become_utc(spark):
    texts = ["2024-01-02 09:30:00+05:00", "2024-01-02T04:31:00Z", "2024-01-02 04:32:00", "2024-01-02 04:33:00 -0030"]
    parsed = spark.createDataFrame([(x,) for x in texts], "t STRING").select(parse_timestamp(F.col("t")).alias("t"))
    assert [row["t"] for row in parsed.collect()][:3] == [datetime(2024, 1, 2, 4, minute) for minute in (30, 31, 32)]


def test_shuffle_partitions_follow_the_input():
    assert session_settings(100 << 40)["spark.sql.shuffle.partitions"] == "819200"


def test_unexpected_ticker_is_allowed(spark, csv):
    assert load_bars_csv(spark, csv(ROWS), {"AAPL"}).count() == 4


def test_first_check_in_order_is_reported(spark, csv):
    rows = [one_row(timestamp="x", open="-1", volume="-1"), one_row(volume="-1", open="-1")]
    with pytest.raises(ValidationError, match="parse timestamps"):
        load_bars_csv(spark, csv(rows))
    with pytest.raises(ValidationError, match="open prices out of valid range"):
        load_bars_csv(spark, csv(rows[1:], name="second.csv"))


def test_headers_and_tickers_are_normalized(spark, csv):
    path = csv([one_row(ticker="\t aapl ")], "Ticker,  Timestamp  ,OPEN,High,LOW,close , Volume\n")
    rows = load_bars_csv(spark, path, ["AAPL"]).collect()
    assert [row["ticker"] for row in rows] == ["AAPL"]


def test_boundary_prices_and_fractional_volume(spark, csv):
    path = csv([one_row(open="0", low="0", high="1000000", close="1e6", volume="10.7")])
    row = load_bars_csv(spark, path).first()
    assert (row["open"], row["close"], row["volume"]) == (0.0, 1_000_000.0, 10)


def test_large_volume_keeps_every_digit(spark, csv):
    row = load_bars_csv(spark, csv([one_row(volume="9007199254740993")])).first()
    assert row["volume"] == 9007199254740993


def test_custom_bounds(spark, csv):
    with pytest.raises(ValidationError, match=r"open prices out of valid range \[0.0, 150.0\]"):
        load_bars_csv(spark, csv(ROWS), max_price=150.0)


@pytest.mark.parametrize(
    "text, pattern",
    [
        ("02/01/2024 09:30", "dd/MM/yyyy HH:mm"),
        ("2024-01-02T09:30:00", "yyyy-MM-dd HH:mm:ss"),
        ("2024-01-02 09:30", "yyyy-MM-dd HH:mm:ss"),
    ],
)
def test_timestamp_formats(spark, csv, text, pattern):
    row = load_bars_csv(spark, csv([one_row(timestamp=text)]), timestamp_format=pattern).first()
    assert row["timestamp"] == datetime(2024, 1, 2, 9, 30)


def test_timestamps_do_not_depend_on_the_session_zone(spark, csv):
    path = csv([one_row(timestamp="2024-03-10 02:30:00"), one_row(timestamp="2024-11-03 01:30:00")])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = sorted(row["timestamp"] for row in load_bars_csv(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert times == [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30)]


def test_extra_columns_survive(spark, csv):
    path = csv([ROWS[0] + ",tech", ROWS[2]], HEADER.strip() + ",Sector\n")
    bars = load_bars_csv(spark, path)
    assert bars.columns[-1] == "sector"
    assert sorted((r["ticker"], r["sector"]) for r in bars.collect()) == [("AAPL", "tech"), ("GOOGL", None)]


def test_folder_of_files(spark, csv, tmp_path):
    csv(ROWS[:2], name="a.csv")
    csv(ROWS[2:], name="b.csv")
    assert load_bars_csv(spark, str(tmp_path)).count() == 4


def test_unreadable_files(spark, csv, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValidationError, match="Failed to read CSV file: no header"):
        load_bars_csv(spark, str(tmp_path / "empty.csv"))
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + ROWS[0] + "\n")
    (folder / "b.csv").write_text("timestamp,ticker,open,high,low,close,volume\n" + ROWS[2] + "\n")
    with pytest.raises(ValidationError, match="Failed to read CSV file"):
        load_bars_csv(spark, str(folder))


def test_header_without_rows(spark, csv):
    assert load_bars_csv(spark, csv([])).count() == 0


def test_byte_order_mark_and_windows_line_ends(spark, tmp_path):
    path = tmp_path / "windows.csv"
    path.write_bytes(("\ufeff" + HEADER + ROWS[0] + "\n").replace("\n", "\r\n").encode())
    assert load_bars_csv(spark, str(path)).first()["volume"] == 1000000


def test_report_counts_all_checks(spark, csv):
    rows = [one_row(timestamp="x"), one_row(open="-1", low="-1"), one_row(open="-2", low="-2"), one_row(ticker="")]
    coerced = validation.coerce(read_text_csv(spark, csv(rows)))
    expected = spark.createDataFrame([("MSFT",)], "ticker string")
    found = {row["check"]: row["violations"] for row in validation.report(coerced, expected).collect()}
    assert {name: n for name, n in found.items() if n} == {
        "unparseable_timestamp": 1,
        "open_out_of_range": 2,
        "low_out_of_range": 2,
        "duplicate_bars": 2,
        "null_ticker": 1,
        "missing_ticker": 1,
    }
    assert len(found) == 17


def test_metadata_file(spark, csv):
    tickers = csv(
        ["1,aapl ,Apple Inc.,NASDAQ", "2,GOOGL,Alphabet Inc.,NASDAQ"], "ticker_id,symbol,name,exchange\n", "symbols.csv"
    )
    rows = load_tickers_csv(spark, tickers).collect()
    assert [tuple(row) for row in rows][0] == (1, "AAPL", "Apple Inc.", "NASDAQ")
    assert load_and_validate(spark, csv(ROWS), tickers).count() == 4
    with pytest.raises(ValidationError, match="Missing expected tickers"):
        load_and_validate(spark, csv(ROWS[:2], name="few.csv"), tickers)
