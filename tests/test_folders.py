"""Tables with a folder per ticker, written by the tasks themselves."""

import datetime
import glob
import os
import struct
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candlekit import WideStore
from candlekit.schema import BAR_COLUMNS, ValidationError
from candlekit.sources import tables
from candlekit.sources.folders import write_folders


def ticks(spark, users, each):
    at = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % each)
    price = F.col("id").cast("double")
    return spark.range(users * each).select(
        F.concat(F.lit("U"), (F.col("id") / each).cast("int").cast("string")).alias("ticker"),
        at.alias("timestamp"),
        *[price.alias(name) for name in ("open", "high", "low", "close")],
        F.col("id").alias("volume"),
    )


def rows(df):
    return sorted(tuple(row) for row in df.select(*BAR_COLUMNS).collect())


def test_many_tickers_are_not_written_by_hadoop(spark, tmp_path):
    """Hadoop would start three processes for each of them."""
    bars = ticks(spark, 300, 4)
    store = WideStore(spark, str(tmp_path / "wide"))
    store.save(bars)
    files = glob.glob(store.path + "/ticker=*/*.parquet")
    assert len(files) == 300
    assert all(pq.ParquetFile(file).metadata.created_by.startswith("parquet-cpp") for file in files)
    assert [name for name in os.listdir(store.path) if name.startswith(tables.PENDING)] == []
    assert rows(store.bars()) == rows(bars)
    assert rows(store.bars("U7")) == rows(bars.filter("ticker = 'U7'"))
    assert store.verify_integrity().summary.first().asDict() == {
        "valid": True, "total_records": 1200, "partitions": 300, "bad_files": 0
    }
    store.save(bars)
    assert rows(store.bars()) == sorted(2 * rows(bars))


def test_folders_are_named_as_by_spark(spark, tmp_path, main_bars):
    names = ["BRK/B", "^GSPC", "A B", "X%2F", "é", "".join(map(chr, range(1, 128)))]
    bars = main_bars.filter("ticker = 'AAPL'").crossJoin(spark.createDataFrame([(n,) for n in names], "name STRING"))
    bars = bars.withColumn("ticker", F.col("name")).drop("name").unionByName(main_bars.withColumn("ticker", F.lit(None).cast("string")))
    write_folders(bars.sortWithinPartitions("ticker"), str(tmp_path / "own"), ["ticker"], "snappy", str(tmp_path / "own" / "_work"))
    bars.write.partitionBy("ticker").parquet(str(tmp_path / "spark"))

    def folders(name):
        return sorted(x for x in os.listdir(tmp_path / name) if "=" in x)

    assert folders("own") == folders("spark")
    read = tables.read_table(spark, str(tmp_path / "own"), main_bars.schema)
    key = [F.coalesce("ticker", F.lit("")), "timestamp", "open"]
    assert read.orderBy(*key).collect() == bars.select(*BAR_COLUMNS).orderBy(*key).collect()


def test_row_groups_checksums_and_periods(spark, tmp_path):
    bars = ticks(spark, 2, 30000).withColumn("month", F.lit("a=b"))
    path = str(tmp_path / "own")
    ready = bars.coalesce(1).sortWithinPartitions("ticker", "timestamp")
    write_folders(ready, path, ["ticker", "month"], "zstd", path + "/_work", 1 << 18)
    for ticker in ("U0", "U1"):
        (file,) = glob.glob(f"{path}/ticker={ticker}/month=a%3Db/*.parquet")
        assert pq.ParquetFile(file).metadata.num_rows == 30000
        assert pq.ParquetFile(file).metadata.num_row_groups > 1
        with open(file, "rb") as content, open(f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc", "rb") as sums:
            blocks = content.read()
            expected = [zlib.crc32(blocks[i : i + 512]) for i in range(0, len(blocks), 512)]
            assert sums.read() == b"crc\0" + struct.pack(f">i{len(expected)}I", 512, *expected)
    assert rows(spark.read.parquet(path)) == rows(bars)
    with open(file, "r+b") as content:
        content.seek(1000)
        content.write(b"\x00" * 40)
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.parquet(path).select("close", "timestamp").agg(F.sum("close"), F.max("timestamp")).collect()


def test_a_failed_write_leaves_nothing(spark, tmp_path, main_bars):
    store = WideStore(spark, str(tmp_path / "wide"))
    bad = main_bars.withColumn("close", F.when(F.col("ticker") == "GOOGL", "x").otherwise("1"))
    with pytest.raises(ValidationError, match="close"):
        store.save(bad)
    assert [name for name in os.listdir(store.path) if "=" in name or name.startswith(tables.PENDING)] == []
    store.save(main_bars)
    assert rows(store.bars()) == rows(main_bars)


def test_files_of_other_attempts_are_not_taken(spark, tmp_path):
    path, bars = str(tmp_path / "own"), ticks(spark, 3, 2)
    os.makedirs(path + "/_work/lost/ticker=U0")
    with open(path + "/_work/lost/ticker=U0/part-00000-lost.parquet", "wb"):
        pass
    write_folders(bars.coalesce(1).sortWithinPartitions("ticker"), path, ["ticker"], "snappy", path + "/_work")
    assert not glob.glob(path + "/**/*lost*", recursive=True)
    assert rows(spark.read.parquet(path)) == rows(bars)


def test_columns_with_a_calendar_stay_with_spark(spark, tmp_path, main_bars):
    old = main_bars.withColumns({"listed": F.lit("0001-02-03").cast("date"), "names": F.array(F.lit("a"))})
    store = WideStore(spark, str(tmp_path / "wide"))
    store.save(old)
    assert sorted(store.bars().collect()) == sorted(old.collect())
    files = glob.glob(store.path + "/ticker=*/*.parquet")
    assert files and not any(pq.ParquetFile(file).metadata.created_by.startswith("parquet-cpp") for file in files)
