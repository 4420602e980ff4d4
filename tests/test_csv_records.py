"""Line breaks in quoted fields and timestamps in formats that nobody named."""

import csv as reference
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlekit.operators.timestamps import PATTERNS, fitting_patterns, inferred_pattern
from candlekit.schema import ValidationError
from candlekit.sources.csv_bars import load_bars_csv, load_tickers_csv, read_text_csv
from candlekit.sources.csv_records import _states, csv_records, has_broken_records

HEADER = "ticker,timestamp,open,high,low,close,volume"
ROW = "2024-01-02 09:30:00,185.50,186.00,185.00,185.75,1000000"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "400b", "spark.sql.files.openCostInBytes": "0b", "spark.sql.files.minPartitionNum": "1"}
    old = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def notes(seed, rows):
    generator = random.Random(seed)
    words = ["plain", "two\nlines", "", 'a "quote"', "comma, here", "\n", "x" * 150 + "\n" + "y" * 150, '5" pipe', "é\n\n\nè", '"', "\n,\n"]
    return [[str(i), generator.choice(words), generator.choice(words)] for i in range(rows)]


def text_of(rows, terminator="\n"):
    out = io.StringIO()
    writer = reference.writer(out, lineterminator=terminator)
    writer.writerow(["id", "note", "Other Note"])
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_records_across_splits(spark, tmp_path, small_splits, terminator):
    expected = {}
    for name in "ab":
        rows = notes(name, 60)
        expected.update({(name, *row[:1]): [x or None for x in row[1:]] for row in rows})
        (tmp_path / f"{name}.csv").write_bytes(text_of(rows, terminator).encode())
    assert has_broken_records(spark, str(tmp_path))
    records = csv_records(spark, str(tmp_path))
    assert records.filter("header").count() == 2 and records.count() == 122
    read = read_text_csv(spark, str(tmp_path))
    assert read.columns == ["id", "note", "other note", "_malformed"]
    assert read.filter("_malformed").count() == 0
    for name in "ab":
        rows = read_text_csv(spark, str(tmp_path / f"{name}.csv")).collect()
        assert len(rows) == 60
        for row in rows:
            assert [row[1], row[2]] == expected[name, row[0]]
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_blank_lines_and_crossing_headers(spark, tmp_path, small_splits):
    header = '"id' + "\n" * 3 + '","' + "long name " * 20 + '\n"'
    (tmp_path / "x.csv").write_text("\n \n" + header + '\n\n1,"a\nb"\n\n2,c\n')
    records = csv_records(spark, str(tmp_path / "x.csv")).collect()
    assert sorted((row["value"], row["header"]) for row in records) == sorted([(header, True), ('1,"a\nb"', False), ("2,c", False)])


def test_files_without_line_breaks_go_the_short_way(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,note\n1,"a ""b"" c"\n2,5" pipe\n3,"x, y"\n')
    assert not has_broken_records(spark, str(tmp_path / "x.csv"))
    assert sorted(row["note"] for row in read_text_csv(spark, str(tmp_path / "x.csv")).collect()) == ['5" pipe', 'a "b" c', "x, y"]


def test_fields_that_are_not_closed(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,note\n1,"open\n2,never\n')
    with pytest.raises(ValidationError, match="not closed"):
        read_text_csv(spark, str(tmp_path / "x.csv"))


def test_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"a\nb"\n')
    (tmp_path / "b.csv").write_text('note,id\n"a\nb",1\n')
    with pytest.raises(ValidationError, match="several headers"):
        read_text_csv(spark, str(tmp_path))


def test_states_are_the_sequential_ones():
    generator = np.random.default_rng(1)
    for _ in range(200):
        outside, inside = generator.random((2, 9)) < [[0.3], [0.7]]
        for start in (False, True):
            state, expected = start, []
            for a, b in zip(outside, inside):
                state = bool(b if state else a)
                expected.append(state)
            assert _states(outside, inside, start).tolist() == expected


def test_bars_and_tickers_with_line_breaks(spark, tmp_path):
    bars = tmp_path / "bars.csv"
    bars.write_text(f'{HEADER},note\n AAPL,{ROW},"two\nlines"\n"MS\nFT",{ROW},\nGOOGL,{ROW},x\nA,{ROW},y,too long\n')
    with pytest.raises(ValidationError, match="1 rows have more fields"):
        load_bars_csv(spark, str(bars))
    bars.write_text(f'{HEADER},note\n AAPL,{ROW},"two\nlines"\n"MS\nFT",{ROW},\nGOOGL,{ROW},x\n')
    rows = load_bars_csv(spark, str(bars)).collect()
    assert {row["ticker"]: row["note"] for row in rows} == {"AAPL": "two\nlines", "MS\nFT": None, "GOOGL": "x"}
    tickers = tmp_path / "tickers.csv"
    tickers.write_text('ticker_id,symbol,name,exchange\n1,aapl,"Apple\nInc.",NASDAQ\n')
    assert tuple(load_tickers_csv(spark, str(tickers)).first()) == (1, "AAPL", "Apple\nInc.", "NASDAQ")


# --- timestamp formats --------------------------------------------------


@pytest.mark.parametrize(
    "values, pattern",
    [
        (["01/02/2024 09:30", "12/11/2024 9:31"], "M/d/yyyy H:mm"),
        (["01/02/2024 09:30", "13/02/2024 09:30", None, "", "NaN"], "d/M/yyyy H:mm"),
        (["01/02/2024 09:30", "02/13/2024 09:30"], "M/d/yyyy H:mm"),
        (["13/02/2024 09:30", "02/13/2024 09:30"], None),
        (["01/02/2024 09:30", "01/02/2024"], None),
        (["31.12.2024"], "d.M.yyyy"),
        (["2024/12/31 23:59:59"], "yyyy/M/d H:mm:ss"),
        (["20241231 23:59"], "yyyyMMdd H:mm"),
        (["5 Jan 2024 09:30:00"], "d MMM yyyy H:mm:ss"),
        (["Jan 5, 2024 9:30 PM"], "MMM d, yyyy h:mm a"),
        (["30/02/2024"], None),
        (["nonsense"], None),
        ([None], None),
    ],
)
def test_inferred_pattern(spark, values, pattern):
    rows = spark.createDataFrame([(value,) for value in values], "at STRING").repartition(2)
    assert inferred_pattern(rows, "at") == pattern


def test_all_patterns_have_a_bit(spark):
    assert len(PATTERNS) == len(set(PATTERNS)) < 63
    at = F.lit("2024-11-25 13:14:15").cast("timestamp")
    for i in range(0, len(PATTERNS), 7):
        bits = spark.range(1).select(fitting_patterns(F.date_format(at, PATTERNS[i]))).first()[0]
        assert bits >> i & 1, PATTERNS[i]


def test_loads_infer_the_format(spark, tmp_path):
    path = tmp_path / "bars.csv"
    prices = "1,2,1,2,7"
    path.write_text(f"{HEADER}\nA,13/02/2024 09:30,{prices}\nA,01/02/2024 09:30,{prices}\n")
    assert sorted(str(row["timestamp"]) for row in load_bars_csv(spark, str(path)).collect()) == ["2024-02-01 09:30:00", "2024-02-13 09:30:00"]
    path.write_text(f"{HEADER}\nA,13/02/2024 09:30,{prices}\nA,02/13/2024 09:30,{prices}\nA,,{prices}\n")
    with pytest.raises(ValidationError, match="parse timestamps: 2 values"):
        load_bars_csv(spark, str(path))
