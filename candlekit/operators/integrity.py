"""Readability of stored files, and the constraints of the star."""

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlekit.schema import PERIOD_COLUMNS
from candlekit.session import stage

FILE_SCHEMA = "file STRING, ticker STRING, records BIGINT, error STRING"


def _stored_ticker(path):
    """Ticker in a path such as .../ticker=BRK%2FB/part-0.parquet, with or without a folder for the
    period in between, or null."""
    value = F.regexp_extract(path, f"/ticker=([^/]*)/(?:(?:{'|'.join(PERIOD_COLUMNS.values())})=[^/]*/)?[^/]*$", 1)
    decoded = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value != "", decoded)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files below `path` with the ticker of their partition."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "file STRING, ticker STRING")
        raise
    return files.select(F.col("path").alias("file"), _stored_ticker(F.col("path")).alias("ticker"))


def _opened(file: str):
    """A Parquet file as pyarrow reads it, and what has to be closed."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    uri = file.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:") :].lstrip("/")
    system, name = fs.FileSystem.from_uri(uri)
    source = system.open_input_file(name)
    try:
        return pq.ParquetFile(source), source
    except BaseException:
        source.close()
        raise


def _fault(file: str, error: Exception) -> str:
    return f"Error reading {file}: {error}"


def row_groups(files: DataFrame) -> DataFrame:
    """A row per row group of every file: file, ticker, row_group, error. A file whose footer cannot be
    read has one row without a row group, a file without row groups too, but no error."""

    def read(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            rows = []
            for file, ticker in zip(frame["file"], frame["ticker"]):
                try:
                    parquet, source = _opened(file)
                    with source:
                        groups = parquet.metadata.num_row_groups
                    rows += [(file, ticker, group, None) for group in range(groups)] or [(file, ticker, None, None)]
                except Exception as error:
                    rows.append((file, ticker, None, _fault(file, error)))
            found = pd.DataFrame(rows, columns=["file", "ticker", "row_group", "error"])
            yield found.astype({"row_group": "Int32"})

    return files.mapInPandas(read, "file STRING, ticker STRING, row_group INT, error STRING")


def check_files(files: DataFrame) -> DataFrame:
    """Read every file to its end: (file, ticker, records, error).

    A plain scan stops at the first bad file, and skipping corrupt files hides
    them; so every row group is read on its own, one batch of rows at a time. Row groups are
    dealt out evenly, so a large file is read by many tasks. A bad file has no records; its error is
    that of its first bad row group.
    """

    def read(frames: Iterator) -> Iterator:
        import pandas as pd

        def outcome(file: str, group) -> tuple[int, str | None]:
            records = 0
            try:
                parquet, source = _opened(file)
                with source:
                    for batch in parquet.iter_batches(row_groups=[int(group)]):
                        records += batch.num_rows
            except Exception as error:
                return 0, _fault(file, error)
            return records, None

        for frame in frames:
            known = frame["row_group"].isna()
            outcomes = [(0, e) if k else outcome(f, g) for f, g, e, k in zip(frame["file"], frame["row_group"], frame["error"], known)]
            yield pd.DataFrame(
                {
                    "file": frame["file"],
                    "ticker": frame["ticker"],
                    "row_group": frame["row_group"].astype("Int32"),
                    "records": [records for records, _ in outcomes],
                    "error": [error for _, error in outcomes],
                }
            )

    # The number of tasks is that of the session, or less where there is little to do.
    dealt = row_groups(files).repartition("file", "row_group")
    checked = dealt.mapInPandas(read, "file STRING, ticker STRING, row_group INT, records BIGINT, error STRING")
    bad = F.count("error") > 0
    return checked.groupBy("file", "ticker").agg(
        F.when(bad, F.lit(0)).otherwise(F.sum("records")).cast("bigint").alias("records"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.coalesce("row_group", F.lit(-1)))).alias("error"),
    )


@dataclass
class StoreIntegrity:
    """Result of an integrity check; every part is a DataFrame."""

    files: DataFrame
    partitions: DataFrame
    tickers: DataFrame
    errors: DataFrame
    summary: DataFrame

    @property
    def valid(self) -> bool:
        return self.summary.first()["valid"]

    @property
    def total_records(self) -> int:
        return self.summary.first()["total_records"]


def partition_integrity(files: DataFrame) -> DataFrame:
    return files.groupBy("ticker").agg(
        F.count("*").alias("files"),
        F.sum("records").alias("records"),
        F.count("error").alias("bad_files"),
    )


def check_store(spark: SparkSession, path: str, partitioned: bool = True) -> StoreIntegrity:
    """Check all files of a store. An empty store is valid with 0 records."""
    # One small row per file; every part below is derived from it.
    files = stage(check_files(list_files(spark, path)), "integrity")
    errors = files.filter(F.col("error").isNotNull())
    partitions = partition_integrity(files)
    if partitioned:
        tickers = partitions.select("ticker")
    else:
        readable = spark.read.schema("ticker STRING").option("ignoreCorruptFiles", True)
        present = not files.isEmpty()
        tickers = readable.parquet(path).distinct() if present else partitions.select("ticker")
    summary = files.agg(
        (F.count("error") == 0).alias("valid"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count_distinct("ticker").alias("partitions"),
        F.count("error").alias("bad_files"),
    )
    return StoreIntegrity(files, partitions, tickers, errors, summary)


def _count(df: DataFrame, check: str, violations) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check"), "violations"
    )


def orphan_prices(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Ticker ids without a dimension row, with their number of price rows.

    Counting before the join shrinks the fact to one row per id.
    """
    per_id = prices.groupBy("ticker_id").agg(F.count("*").alias("records"))
    return per_id.join(tickers.select("ticker_id"), "ticker_id", "left_anti")


def audit_star(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Violations (check, violations) of the constraints of the star."""
    required = ["ticker_id", "timestamp", "open", "high", "low", "close", "volume"]
    nulls = prices.agg(*[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in required])
    ids = tickers.groupBy("ticker_id").count().filter("count > 1")
    symbols = tickers.filter("symbol is not null").groupBy("symbol").count().filter("count > 1")
    keys = prices.groupBy("ticker_id", "timestamp").count().filter("count > 1")
    parts = [
        nulls.unpivot([], nulls.columns, "check", "violations"),
        _count(tickers, "null_symbol", F.count_if(F.col("symbol").isNull())),
        _count(ids, "duplicate_ticker_id", F.sum("count")),
        _count(symbols, "duplicate_symbol", F.sum("count")),
        _count(keys, "duplicate_price_key", F.sum("count")),
        _count(orphan_prices(prices, tickers), "orphan_price", F.sum("records")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
