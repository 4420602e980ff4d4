"""Session settings and the shared staging folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MIB = 1 << 20


def session_settings(input_bytes: int | None = None, cores: int | None = None) -> dict[str, str]:
    """Spark settings for a job over `input_bytes` of (uncompressed) bars.

    The shuffle starts with about one partition per 128 MiB of input, which
    adaptive execution then merges where the data turns out smaller; skewed
    join partitions are split at run time.
    """
    partitions = max(cores or 1, -(-(input_bytes or 0) // (128 * MIB)))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.files.maxPartitionBytes": str(128 * MIB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    if cores:
        # More listing tasks than a few per core only cost scheduling time.
        settings["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(4 * cores)
    return settings


def build_session(
    app_name: str,
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_settings(input_bytes, cores), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Where it is unset, a checkpoint folder set on the context is taken; only a
    local-mode session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="candlekit-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the staging folder."""
    return f"{staging_root(spark)}/candlekit/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the staging folder and read it back.

    This cuts the lineage with a table that outlives lost executors, and lets a
    store be rewritten from data that no longer depends on the store's files.
    The caller decides when the table is no longer needed (see `staged`).
    """
    return stage_at(df, staging_path(df.sparkSession, label))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """Like `stage`, at a path that the caller can `discard`."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like `stage`, for the time of a `with` block.

    After a failure the table stays, so that its rows can be recovered.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    yield stage_at(df, path)
    discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
