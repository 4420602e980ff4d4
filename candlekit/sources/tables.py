"""Reading and rewriting partitioned Parquet tables.

Plain Parquet has no transactions: one writer per store at a time. An upsert replaces
single files. What it writes and which files that replaces is complete, in a folder of the
store that readers skip, before the first file is moved. A replacement that was interrupted
is finished by the next write; until then readers may see both versions of some rows.
"""

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlekit.functions import parse_timestamp
from candlekit.operators.prices import moment
from candlekit.operators.upsert import merge
from candlekit.schema import KEY_COLUMNS, ValidationError, quoted
from candlekit.session import staged
from candlekit.sources.files import delete, files_below, local_path, move, read_text, subfolders, write_text
from candlekit.sources.folders import codec_for, write_folders

#: Names of columns that reading adds, and of folders that readers skip.
FILE = "_stored_file"
PENDING = "_replace-"
READY = "ready"

#: Up to so many files are named in the plan, so that Spark opens no other; more are joined.
NAMED_FILES = 1000

FAULT = "candlekit cannot store"


def conform(df: DataFrame, schema: T.StructType, required: list[str], keys: list[str]) -> DataFrame:
    """`df` with the columns of `schema`, in its order and types.

    Columns that are not `required` may be absent and are null then. A required column that
    is absent, a column that `schema` does not have, and (when the rows are read) a value that
    its column cannot hold or one of `keys` that is null raise ValidationError; reading goes
    through `reporting`. A blank ticker is a null one.
    """
    absent = [name for name in required if name not in df.columns]
    if absent:
        raise ValidationError(f"Missing required columns: {sorted(absent)}")
    unknown = [name for name in df.columns if name not in schema.fieldNames()]
    if unknown:
        raise ValidationError(f"Columns that the store does not have: {sorted(unknown)}")
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType
        value, wrong = given, F.lit(False)
        if kind != field.dataType:
            if isinstance(field.dataType, T.TimestampNTZType) and isinstance(kind, T.StringType):
                value, same = parse_timestamp(given), F.lit(True)
            else:
                value = given.try_cast(field.dataType)
                # Text need not be written as Spark would write it.
                same = F.lit(True) if isinstance(kind, T.StringType) else value.try_cast(kind).eqNullSafe(given)
            wrong = given.isNotNull() & (value.isNull() | ~same)
        if field.name == "ticker":
            value = F.when(F.trim(value) != "", value)
        if field.name in keys:
            wrong = wrong | value.isNull()
        fault = F.raise_error(F.lit(f"{FAULT} {field.name}")).cast(field.dataType)
        columns.append(F.when(F.coalesce(wrong, F.lit(True)), fault).otherwise(value).alias(field.name))
    return df.select(*columns)


def ordered(schema: T.StructType, bars: DataFrame, order: str | None) -> T.StructType:
    """`schema` with the column of `bars` that orders the rows of a key, as it is there."""
    if not order or order in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, bars.schema[order]])


@contextmanager
def reporting() -> Iterator[None]:
    """Turn what `conform` finds while rows are read into a ValidationError."""
    try:
        yield
    except Exception as error:
        found = re.search(rf"{FAULT} (\w+)", str(error))
        if not found:
            raise
        if found[1] in KEY_COLUMNS:
            raise ValidationError("Found records without a ticker or timestamp that can be stored") from error
        raise ValidationError(f"Found records whose {found[1]} cannot be stored") from error


def stored_fields(spark: SparkSession, path: str, folder: str | None = None) -> list[T.StructField]:
    """The columns of the table at `path`, or of one folder of it; none if it is absent or empty."""
    try:
        return list(spark.read.option("basePath", path).parquet(f"{path}/{folder}" if folder else path).schema.fields)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, folder: str | None = None, with_file: bool = False
) -> DataFrame:
    """The table at `path`, or only one partition folder of it; empty if absent. `with_file` adds
    the path of each row's file.

    The schema is always given, since inference would turn a partition value
    such as 007 into a number.
    """
    reader = spark.read.schema(schema).option("basePath", path)
    file = [F.col("_metadata.file_path").alias(FILE)] if with_file else []
    try:
        # A scan puts partition columns last; keep the given order.
        return reader.parquet(f"{path}/{folder}" if folder else path).select(*quoted(schema.fieldNames()), *file)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            added = [T.StructField(FILE, T.StringType())] if with_file else []
            return spark.createDataFrame([], T.StructType([*schema.fields, *added]))
        raise


def write_table(df: DataFrame, path: str, partitions: list[str], sort: list[str]) -> None:
    """Add rows as new files.

    The rebalance hint brings the rows of a partition together, which avoids a
    file per task and partition, merges small partitions into one task and, by
    adaptive execution, splits a partition that holds many of the rows over
    several tasks. Files are sorted, so that a time filter skips pages.

    A folder per ticker on a mounted file system is written by the tasks themselves, if they
    can write all of the columns as Spark would.
    """
    ready = df.hint("rebalance", *[F.col(name) for name in partitions]).sortWithinPartitions(*partitions, *sort)
    local = local_path(df.sparkSession, path) if "ticker" in partitions else None
    codec = codec_for(df, partitions) if local else None
    if codec:
        write_folders(ready, local, partitions, codec, f"{local}/{PENDING}{uuid.uuid4().hex}")
    else:
        ready.write.mode("append").partitionBy(*partitions).parquet(path)


def replace_files(
    spark: SparkSession, path: str, content: DataFrame, files: DataFrame, partitions: list[str], sort: list[str]
) -> None:
    """Put the rows of `content` in the place of the stored `files` (column FILE)."""
    work = f"{path}/{PENDING}{uuid.uuid4().hex}"
    write_table(content, f"{work}/new", partitions, sort)
    files.write.parquet(f"{work}/old")
    write_text(spark, f"{work}/{READY}", "")
    _finish(spark, path, work)


def _finish(spark: SparkSession, path: str, work: str) -> None:
    """Move the new files in, then delete the replaced ones. Can be repeated at any point."""
    for name in list(files_below(spark, f"{work}/new", ".parquet")):
        move(spark, f"{work}/new/{name}", f"{path}/{name}")
    for row in spark.read.schema(f"{FILE} STRING").parquet(f"{work}/old").toLocalIterator():
        delete(spark, row[FILE])
    delete(spark, work)


def finish_replacements(spark: SparkSession, path: str) -> int:
    """Finish the replacements that were interrupted, and remove what is left of those that had not
    begun to move files; returns how many were finished."""
    finished = 0
    for work in subfolders(spark, path, PENDING):
        if read_text(spark, f"{work}/{READY}") is None:
            delete(spark, work)
        else:
            _finish(spark, path, work)
            finished += 1
    return finished


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    time: str,
    partitions: list[str],
    sort: list[str],
    lacking: list[str] = (),
) -> int:
    """Insert or replace rows by key; returns the number of rows written.

    Only partitions between the first and the last of the batch are read, to find the files
    that hold a key of it. Only these files are replaced: by their other rows, and the batch.
    Without such a file the batch is appended, so loading new days rewrites nothing. Replaced
    rows keep their values in the columns named `lacking`, which the batch does not know.

    `batch` must be unique in `keys` and cheap to read several times, that is
    come from a stored table other than this one.
    """
    finish_replacements(spark, path)
    no_key = [F.col(name).isNull() for name in keys]
    span = batch.agg(
        F.count("*").alias("rows"),
        F.count_if(reduce(Column.__or__, no_key)).alias("without_key"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
        *[F.min(name).alias(f"low_{name}") for name in partitions],
        *[F.max(name).alias(f"high_{name}") for name in partitions],
    ).first()
    if span["without_key"]:
        raise ValidationError(f"Found {span['without_key']} records without a ticker or timestamp")
    if not span["rows"]:
        return 0

    existing = read_table(spark, path, batch.schema, with_file=True)
    for name in partitions:
        existing = existing.filter(F.col(name).between(F.lit(span[f"low_{name}"]), F.lit(span[f"high_{name}"])))
    nearby = existing.filter(F.col(time).between(moment(span["first"]), moment(span["last"])))
    hits = nearby.join(batch.select(*keys), keys, "left_semi").select(FILE).distinct()
    with staged(hits, "hits") as hits:
        names = [row[FILE] for row in hits.limit(NAMED_FILES + 1).collect()]
        if not names:
            write_table(batch, path, partitions, sort)
            return span["rows"]
        if len(names) <= NAMED_FILES:
            touched = existing.filter(F.col(FILE).isin(names))
        else:
            touched = existing.join(hits, FILE, "left_semi")
        new = batch
        if lacking:
            # A key that was saved several times counts once.
            old = touched.select(*keys, *quoted(lacking)).dropDuplicates(keys)
            new = batch.drop(*lacking).join(old, keys, "left").select(*quoted(batch.columns))
        replace_files(spark, path, merge(touched.drop(FILE), new, keys), hits, partitions, sort)
    return span["rows"]
