"""CSV sources: bars and ticker metadata."""

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlekit.functions import symbol, whole_number
from candlekit.functions.expressions import DEFAULT_PATTERN
from candlekit.operators.timestamps import inferred_pattern
from candlekit.operators.validation import (
    MALFORMED,
    MAX_PRICE,
    MIN_PRICE,
    coerce,
    require_columns,
    require_valid,
    typed_bars,
    unreadable_timestamps,
)
from candlekit.schema import TICKERS_CSV_COLUMNS, ValidationError, quoted
from candlekit.session import discard, stage, stage_at, staging_path
from candlekit.sources.csv_records import csv_records, has_broken_records

_CORRUPT = "_corrupt_row"

# A field in quotes, in which a quote is doubled.
_QUOTED_FIELD = r'(?<=^|,)"[^"]*+(?:""[^"]*+)*+"'


def _header(spark: SparkSession, path: str) -> list[str]:
    try:
        return spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValidationError(f"File not found: {path}") from error
        raise ValidationError(f"Failed to read CSV file: {error}") from error


def _parsed_records(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """The records of files whose quoted fields hold line breaks, as columns of text."""
    records = csv_records(spark, path)
    headers = records.filter("header").select("value").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValidationError(f"Failed to read CSV file: several headers in {path}")
    options = {"escape": '"', "columnNameOfCorruptRecord": _CORRUPT}
    return records.filter("not header").select(F.from_csv("value", fields, options).alias("row")).select("row.*")


def read_text_csv(
    spark: SparkSession, path: str, required: Iterable[str] = (), line_breaks: bool | None = None
) -> DataFrame:
    """All columns as text under trimmed, lower-case names.

    Quoted fields may hold line breaks. Without `line_breaks` the text is first read to see whether any do;
    False says that none do and saves that.

    A row with more fields than the header is marked in the `_malformed` column. Names that
    are equal when trimmed and in lower case raise ValidationError.
    Every file of a folder must have the same header.
    """
    header = _header(spark, path)
    if not header:
        raise ValidationError(f"Failed to read CSV file: no header in {path}")
    names = [name.strip().lower() for name in header]
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValidationError(f"Repeated columns: {repeated}")
    fields = ", ".join("`" + name.replace("`", "``") + "` STRING" for name in [*header, _CORRUPT])
    if has_broken_records(spark, path) if line_breaks is None else line_breaks:
        raw = _parsed_records(spark, path, fields)
    else:
        raw = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", _CORRUPT)
            .schema(fields)
            .csv(path)
        )
    # Short rows are marked too: their last column is null and they have fewer separators.
    separators = F.regexp_count(F.regexp_replace(_CORRUPT, _QUOTED_FIELD, ""), F.lit(","))
    last = quoted(names)[-1]
    too_long = F.col(_CORRUPT).isNotNull() & (last.isNotNull() | (separators >= len(names)))
    return raw.toDF(*names, _CORRUPT).withColumn(MALFORMED, too_long).drop(_CORRUPT)


def load_tickers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ticker metadata: ticker_id, symbol (normalized), name, exchange."""
    raw = read_text_csv(spark, path, ["symbol"])
    columns = {
        "ticker_id": whole_number(F.col("ticker_id")) if "ticker_id" in raw.columns else F.lit(None).cast("bigint"),
        "symbol": symbol(F.col("symbol")),
        "name": F.col("name") if "name" in raw.columns else F.lit(None).cast("string"),
        "exchange": F.col("exchange") if "exchange" in raw.columns else F.lit(None).cast("string"),
    }
    return raw.select(*[columns[name].alias(name) for name in TICKERS_CSV_COLUMNS])


def _expected_frame(spark: SparkSession, expected: DataFrame | Iterable[str] | None) -> DataFrame | None:
    if expected is None or isinstance(expected, DataFrame):
        return expected
    names = [(str(name),) for name in expected]
    return spark.createDataFrame(names, "ticker STRING") if names else None


def load_bars_csv(
    spark: SparkSession,
    path: str,
    expected_tickers: DataFrame | Iterable[str] | None = None,
    timestamp_format: str | Sequence[str] = DEFAULT_PATTERN,
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
    line_breaks: bool | None = None,
) -> DataFrame:
    """Validated bars, with any extra columns of the file.

    The text is parsed once, into a staged Parquet table; validation and every
    later use read that table; it is deleted if a check fails. `timestamp_format` is a Spark
    datetime pattern, or several, of which the first that fits a value is taken. If values remain
    that neither they nor an ISO-like form fit, the text is parsed a second time with the first of the usual
    patterns that fits all values (see `inferred_pattern`), if there is one.
    `line_breaks` is as for `read_text_csv`.
    `expected_tickers` is a list of symbols or a DataFrame with them in its
    first column.
    """
    raw = read_text_csv(spark, path, line_breaks=line_breaks)
    require_columns(raw.columns)
    folder = staging_path(spark, "csv-bars")
    try:
        coerced = stage_at(coerce(raw, timestamp_format), folder)
        if not unreadable_timestamps(coerced).isEmpty():
            pattern = inferred_pattern(raw, "timestamp")
            if pattern:
                discard(spark, folder)
                coerced = stage_at(coerce(raw, pattern), folder)
        require_valid(coerced, _expected_frame(spark, expected_tickers), min_price, max_price)
    except ValidationError as error:
        if error.missing is not None:
            error.missing = stage(error.missing, "missing-tickers")
        discard(spark, folder)
        raise
    except (PySparkException, Py4JJavaError) as error:
        discard(spark, folder)
        if "FAILED_READ_FILE" in str(error):
            raise ValidationError(f"Failed to read CSV file: {error}") from error
        raise
    return typed_bars(coerced)


def load_and_validate(spark: SparkSession, csv_path: str, tickers_path: str) -> DataFrame:
    """Validated bars that must cover every ticker of the metadata file."""
    return load_bars_csv(spark, csv_path, load_tickers_csv(spark, tickers_path).select("symbol"))
