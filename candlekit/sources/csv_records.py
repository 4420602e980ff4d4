"""Records of CSV files whose quoted fields hold line breaks, read from splits in parallel.

Whether a line break ends a record depends on all the text before it, but only through one bit:
is the line's start inside a quoted field? A line turns either state at its start into a
state at its end. So a split is summed up by two bits, whatever its start turns out to be, and
these sums are composed over the splits of a file, one small row per split. Then every
split is read again, with its start known, and its lines are put together to records. Only a
record that goes over the end of a split has to be shuffled.

A quote opens a field only at the field's start; elsewhere it is an ordinary character.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlekit.schema import ValidationError

# A line from the start of a field on: whole fields, then one that is left open. Possessive, so
# that no line is tried in several ways.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
_LEFT_OPEN = rf'^(?:{_FIELD},)*+"{_INSIDE}$'
# The rest of a quoted field that the line started in, with what stands before the next comma.
_CLOSING = rf'^{_INSIDE}"[^,]*+'

_PIECE = "file STRING, opened LONG, split LONG, value STRING, whole BOOLEAN, header BOOLEAN"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of their split: file, split (its offset), value, and whether the line ends
    inside a quoted field if it starts outside and if it starts inside."""
    text = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    quoted = value.contains('"')
    rest = F.regexp_replace(value, _CLOSING, "")
    goes_on: Column = ~value.rlike(_CLOSING)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        "value",
        F.when(quoted, value.rlike(_LEFT_OPEN)).otherwise(F.lit(False)).alias("outside"),
        # After the closing quote comes the end of the line, or a comma and the next field.
        F.when(quoted, goes_on | F.substring(rest, 2, 1 << 30).rlike(_LEFT_OPEN)).otherwise(F.lit(True)).alias("inside"),
    )


def has_broken_records(spark: SparkSession, path: str) -> bool:
    """Whether some quoted field holds a line break. No line ends inside a field if none does
    that starts outside."""
    return not _lines(spark, path).filter("outside").limit(1).isEmpty()


def _states(outside: np.ndarray, inside: np.ndarray, start: bool) -> np.ndarray:
    """Whether each line ends inside a field, if the first line starts inside (`start`) or not."""
    changing = outside | ~inside
    fixed = changing & (outside == inside)
    flips = np.cumsum(changing & ~fixed)
    at = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    base = np.where(at >= 0, outside[at], start)
    since = flips - np.where(at >= 0, flips[at], 0)
    return base ^ (since % 2 == 1)


def _flags(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The lines of one split at a time."""
    if not batch.num_rows:
        return
    splits = batch.column("split").to_numpy(zero_copy_only=False)
    files = batch.column("file")
    codes = pc.dictionary_encode(files).indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((splits[1:] != splits[:-1]) | (codes[1:] != codes[:-1])) + 1
    for first, last in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield files[int(first)].as_py(), int(splits[first]), batch.slice(int(first), int(last - first))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two rows per split, for either state at its start: the state at its end, and whether a record
    starts in it."""
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("start", pa.bool_()), ("end", pa.bool_()), ("opens", pa.bool_())])

    def finished(here, ends, opens):
        rows = [(*here, bool(start), ends[start], opens[start]) for start in (0, 1)]
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)

    here, ends, opens = None, [False, True], [False, False]
    for batch in batches:
        for file, split, lines in _runs(batch):
            if (file, split) != here:
                if here:
                    yield finished(here, ends, opens)
                here, ends, opens = (file, split), [False, True], [False, False]
            outside, inside = _flags(lines, "outside"), _flags(lines, "inside")
            after = [_states(outside, inside, start) for start in (False, True)]
            for start in (0, 1):
                states = after[ends[start]]
                opens[start] |= not ends[start] or bool((~states[:-1]).any())
                ends[start] = bool(states[-1])
    if here:
        yield finished(here, ends, opens)


def _continued_splits(lines: DataFrame) -> dict[tuple[str, int], int]:
    """The splits that start inside a quoted field, with the split in which that record starts. Raises
    ValidationError if a file ends inside a field.

    Splits of one file are composed in one task: a row per split, as many as Spark's own list of
    splits has. The result holds only those that a record crosses into.
    """
    parts = lines.mapInArrow(_ends, "file STRING, split LONG, start BOOLEAN, end BOOLEAN, opens BOOLEAN")

    def compose(table: pa.Table) -> pa.Table:
        by_split = {(row["split"], row["start"]): row for row in table.to_pylist()}
        state, opened, found = False, 0, []
        for split in sorted({split for split, _ in by_split}):
            row = by_split[split, state]
            if state:
                found.append((row["file"], split, opened))
            if row["opens"]:
                opened = split
            state = row["end"]
        if state:
            found.append((row["file"], -1, opened))
        names = ("file", "split", "opened")
        schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("opened", pa.int64())])
        return pa.Table.from_pylist([dict(zip(names, row)) for row in found], schema)

    composed = parts.groupBy("file").applyInArrow(compose, "file STRING, split LONG, opened LONG")
    found = {(row["file"], row["split"]): row["opened"] for row in composed.toLocalIterator()}
    unclosed = sorted(file for file, split in found if split < 0)
    if unclosed:
        raise ValidationError(f"Failed to read CSV file: a quoted field is not closed in {unclosed[0]}")
    return found


def _assembled(continued: dict[tuple[str, int], int]):
    """A function from the lines of splits to their records, and to the pieces of records that go
    over the end of a split."""
    schema = pa.schema(
        [
            ("file", pa.string()),
            ("opened", pa.int64()),
            ("split", pa.int64()),
            ("value", pa.string()),
            ("whole", pa.bool_()),
            ("header", pa.bool_()),
        ]
    )

    def made(here, opened: int, values: pa.Array, whole: bool, header) -> pa.RecordBatch:
        file, split = here
        columns = [[file] * len(values), [opened] * len(values), [split] * len(values), values, [whole] * len(values), header]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, first = None, False, False
        # The record that is not complete yet: its lines, the split where it began, whether it is a header.
        lines_open, opened, header_open = [], 0, False
        for batch in batches:
            for file, split, lines in _runs(batch):
                if (file, split) != here:
                    if lines_open:
                        yield made(here, opened, ["\n".join(lines_open)], False, [header_open])
                    here, lines_open = (file, split), []
                    state, opened = here in continued, continued.get(here, split)
                    # The first line of a file that is not blank begins the header.
                    first, header_open = split == 0, False
                ends = _states(_flags(lines, "outside"), _flags(lines, "inside"), state)
                starts = np.concatenate([[state], ends[:-1]])
                state, values = bool(ends[-1]), lines.column("value")
                header = np.zeros(len(ends), bool)
                for i in range(len(ends) if first else 0):
                    if values[i].as_py().strip():
                        header[i], first = True, False
                        break
                alone = ~starts & ~ends
                yield made(here, split, values.filter(pa.array(alone)), True, header[alone])
                for i in np.flatnonzero(~alone):
                    if not starts[i]:
                        lines_open, opened, header_open = [], split, bool(header[i])
                    lines_open.append(values[int(i)].as_py())
                    if not ends[i]:
                        yield made(here, opened, ["\n".join(lines_open)], opened == split, [header_open])
                        lines_open = []
        if lines_open:
            yield made(here, opened, ["\n".join(lines_open)], False, [header_open])

    return run


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, value, header: the records of the CSV files at `path` as text, in any order, without blank
    ones. `header` marks the first of a file."""
    lines = _lines(spark, path)
    pieces = lines.mapInArrow(_assembled(_continued_splits(lines)), _PIECE)
    # A record that begins in a split has one piece there that no other split follows up: the
    # last. Its other pieces name the split in which it began.
    crossing = pieces.filter("not whole").groupBy("file", "opened").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "value"))), lambda x: x["value"]), "\n").alias("value"),
        F.max("header").alias("header"),
    )
    records = pieces.filter("whole").select("file", "value", "header").unionByName(crossing.select("file", "value", "header"))
    value = F.regexp_replace("value", "\r$", "")
    return records.withColumn("value", value).filter(F.trim("value") != "")
