"""Partition folders of Parquet files on a mounted file system, written by the tasks themselves.

Without its native library, Hadoop starts a `chmod` process for each folder, file and checksum that it makes
on a `file:` path. A table with a folder per ticker has so many of them that its write did little else.
"""

import os
import shutil
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlekit.schema import quoted

#: Types that mean the same in a file whoever writes it. Dates and times with a zone do not: Spark marks their calendar.
PLAIN_TYPES = (
    T.StringType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.TimestampNTZType,
    T.BinaryType,
)

#: Names of compression codecs in Spark's settings and in pyarrow.
CODECS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "none": "none", "uncompressed": "none"}

#: Bytes of rows in memory that make a row group.
ROW_GROUP = 64 << 20


def codec_for(df: DataFrame, partitions: list[str]) -> str | None:
    """The codec by which `write_folders` can write `df`; None if Spark has to."""
    codec = CODECS.get(df.sparkSession.conf.get("spark.sql.parquet.compression.codec").lower())
    plain = all(type(field.dataType) in PLAIN_TYPES for field in df.schema.fields if field.name not in partitions)
    return codec if plain and len(df.columns) > len(partitions) else None


def write_folders(
    df: DataFrame, path: str, partitions: list[str], codec: str, work: str, row_group: int = ROW_GROUP
) -> None:
    """Add the rows of `df` as new files below the local `path`, in folders named as by Spark.

    Tasks hold the rows of a folder one after another. Each attempt of a task writes into a folder of its own below `work`,
    which readers of `path` skip. Once all tasks are done, the files of the attempts that Spark took are moved.
    """
    data = [name for name in df.columns if name not in partitions]
    columns = [*quoted(data), *[F.col(name).cast("string") for name in partitions]]
    # Numbered, as mapInArrow takes no names with dots.
    numbered = df.select(*[column.alias(f"c{i}") for i, column in enumerate(columns)])
    os.makedirs(work, exist_ok=True)
    try:
        attempts = numbered.mapInArrow(_task(work, data, partitions, codec, row_group), "attempt STRING").collect()
        for row in attempts:
            _move_into(f"{work}/{row['attempt']}", path)
        with open(f"{path}/_SUCCESS", "wb"):
            pass
    finally:
        shutil.rmtree(work, ignore_errors=True)


def _move_into(source: str, target: str) -> None:
    """Move what is in a folder. Folders that the target does not have are moved whole."""
    for entry in list(os.scandir(source)):
        place = f"{target}/{entry.name}"
        if entry.is_dir() and os.path.isdir(place):
            _move_into(entry.path, place)
        else:
            os.rename(entry.path, place)


def _task(
    work: str, data: list[str], partitions: list[str], codec: str, row_group: int
) -> Callable[[Iterator], Iterator]:
    # All that tasks need is in here, so that they need no module of this package.
    def write(batches: Iterator) -> Iterator:
        import os
        import struct
        import uuid
        import zlib
        from itertools import groupby

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        special = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"}

        def named(value: str | None) -> str:
            escaped = "".join(f"%{ord(c):02X}" if c in special else c for c in value or "")
            return escaped or "__HIVE_DEFAULT_PARTITION__"

        def runs() -> Iterator:
            """Rows that follow each other in a batch and belong to one folder."""
            for batch in batches:
                keys = batch.columns[len(data) :]
                rows = batch.select(list(range(len(data)))).rename_columns(data)
                ends = sorted({end for key in keys for end in pc.run_end_encode(key).run_ends.to_pylist()})
                for start, end in zip([0, *ends], ends):
                    yield [key[start].as_py() for key in keys], rows.slice(start, end - start)

        def write_rows(file: str, parts: Iterator) -> None:
            held, size = [next(parts)], 0
            schema = held[0].schema
            with pq.ParquetWriter(file, schema, compression=codec, store_schema=False, write_page_checksum=True) as out:
                for rows in parts:
                    size += held[-1].nbytes
                    if size >= row_group:
                        out.write_table(pa.Table.from_batches(held))
                        held, size = [], 0
                    held.append(rows)
                out.write_table(pa.Table.from_batches(held))

        def write_checksums(file: str, sums: str) -> None:
            """As Hadoop's local file system has them: one for 512 bytes."""
            with open(file, "rb") as content, open(sums, "wb") as out:
                out.write(b"crc\0" + struct.pack(">i", 512))
                while block := content.read(512):
                    out.write(struct.pack(">I", zlib.crc32(block)))

        attempt = uuid.uuid4().hex
        number = -1
        for number, (values, parts) in enumerate(groupby(runs(), lambda run: run[0])):
            names = [f"{name}={named(value)}" for name, value in zip(partitions, values)]
            folder = "/".join([work, attempt, *names])
            os.makedirs(folder, exist_ok=True)
            name = f"part-{number:05d}-{attempt}.parquet"
            write_rows(f"{folder}/{name}", (rows for _, rows in parts))
            write_checksums(f"{folder}/{name}", f"{folder}/.{name}.crc")
        if number >= 0:
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    return write
