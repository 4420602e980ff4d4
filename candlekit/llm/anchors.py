"""Anchors of windows, and merged count-min sketches that tell which are repeated.

The anchor of a window is the smallest hash of the short runs inside it. Equal windows
have equal anchors at equal places, so an anchor occurs at least as often as any window
around it, and neighbouring windows mostly share one.

Every task sketches the anchors of its rows; the partial sketches are merged bucket by
bucket into sketches with `ROWS` rows of `CELLS` cells, of which one bit per cell is kept:
hit twice or more. A count is never too low, so no repeated window is lost. The number of
buckets follows the number of anchors, so sketches don't fill up as the table grows.

Where the merged sketch is too large to be sent to the executors, `told` sends the anchors to
the sketch instead, 12 bytes each, and those that are estimated to be repeated back to their rows.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlekit.llm.textbytes import Chunk, chunks, mix
from candlekit.session import stage

ROWS = 2
CELLS = 1 << 18
BUCKET_BYTES = ROWS * CELLS // 8
#: Anchors per cell that a bucket is sized for.
LOAD = 0.25
#: Largest merged sketch that is sent to the executors.
SKETCH_BYTES = 64 << 20
#: Anchors or windows that a task combines before it hands rows on.
BUFFER = 1 << 20
#: Neighbouring buckets whose sketches `told` makes in one call.
GROUP = 4
#: Pairs known to be repeated that `told` hands on in one row.
PAIRS = 1 << 16
ASKED = np.dtype([("anchor", "<u8"), ("key", "<i4")])
LOW = np.uint64(0xFFFFFFFF)
#: What stands for a null doc_id where rows are joined.
NO_ID = -(1 << 63)

Find = Callable[[Chunk], tuple[np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """doc (doc_id, or NO_ID for null), mark (hash of the text) and text (null: empty).

    Rows equal in doc and mark are one document to the operators on substrings.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    text = F.coalesce("text", F.lit(""))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))


def doc_id() -> F.Column:
    return F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")


def _cells(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bucket of every anchor, and its cell in every row of the bucket's sketch."""
    bucket = (anchors % np.uint64(buckets)).astype(np.int64)
    cells = [(mix(anchors ^ np.uint64(0xA5A5 + i)) % np.uint64(CELLS)).astype(np.int64) + i * CELLS for i in range(ROWS)]
    return bucket, cells


def _partial_sketches(find: Find, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, cells): cells that a buffer's anchors hit; those hit more than once stand twice."""
    held, size = [], 0

    def flush():
        bucket, cells = _cells(np.concatenate(held), buckets)
        hits, counts = np.unique(np.concatenate([bucket * (ROWS * CELLS) + cell for cell in cells]), return_counts=True)
        hits = np.repeat(hits, np.minimum(counts, 2))
        names, first = np.unique(hits // (ROWS * CELLS), return_index=True)
        local = (hits % (ROWS * CELLS)).astype(np.uint32)
        ends = np.append(first[1:], len(hits))
        packed = [local[a:b].tobytes() for a, b in zip(first, ends)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "cells"])

    for batch in batches:
        for chunk in chunks(batch.column("text")):
            anchors, places = find(chunk)
            if len(anchors):
                # An anchor counts once where it stands, not once per window around it.
                new = np.ones(len(places), bool)
                new[1:] = places[1:] != places[:-1]
                held.append(anchors[new])
                size += len(held[-1])
            if size >= BUFFER:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(ROWS * CELLS, np.uint8)
    for packed in group["cells"]:
        cells, hits = np.unique(np.frombuffer(packed, np.uint32), return_counts=True)
        counts[cells] = np.minimum(counts[cells] + hits, 2)
    return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "bits": [np.packbits(counts > 1).tobytes()]})


class Estimate:
    """Is an anchor estimated to be repeated?"""

    def __init__(self, buckets: int, bits: np.ndarray):
        self.buckets = buckets
        self.bits = bits

    def __call__(self, anchors: np.ndarray) -> np.ndarray:
        bucket, cells = _cells(anchors, self.buckets)
        found = np.ones(len(anchors), bool)
        for cell in cells:
            at = bucket * (ROWS * CELLS) + cell
            found &= ((self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
        return found


def bucket_count(rows: DataFrame, bytes_per_anchor: int) -> int:
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, int(size / bytes_per_anchor / (LOAD * CELLS)) + 1)


def sketch(rows: DataFrame, find: Find, bytes_per_anchor: int) -> tuple[int, DataFrame]:
    """Number of buckets, and the merged sketch: (bucket, bits) for buckets with anchors."""
    buckets = bucket_count(rows, bytes_per_anchor)
    return buckets, merged_sketch(rows, find, buckets)


def merged_sketch(rows: DataFrame, find: Find, buckets: int) -> DataFrame:
    partial = rows.select("text").mapInArrow(
        lambda batches: _partial_sketches(find, buckets, batches), "bucket BIGINT, cells BINARY"
    )
    return stage(partial.groupBy("bucket").applyInPandas(_merge, "bucket BIGINT, bits BINARY"), "sketch")


def fits(buckets: int, limit: int = SKETCH_BYTES) -> bool:
    return buckets * BUCKET_BYTES <= limit


def estimate(buckets: int, merged: DataFrame, limit: int = SKETCH_BYTES) -> Estimate | None:
    """The merged sketch as a function, if it is no larger than `limit`; else None."""
    if not fits(buckets, limit):
        return None
    bits = np.zeros(buckets * BUCKET_BYTES, np.uint8)
    for row in merged.toLocalIterator():
        bits[row["bucket"] * BUCKET_BYTES : (row["bucket"] + 1) * BUCKET_BYTES] = np.frombuffer(row["bits"], np.uint8)
    return Estimate(buckets, bits)


def keep_estimated(rows: DataFrame, buckets: int, merged: DataFrame) -> DataFrame:
    """The rows (with columns bucket and anchor) whose anchor is estimated to be repeated, without
    sending the sketch anywhere: rows and sketch meet bucket by bucket."""
    schema = rows.schema

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return left.slice(0, 0)
        bits = np.frombuffer(right.column("bits")[0].as_py(), np.uint8)
        anchors = left.column("anchor").to_numpy().view(np.uint64)
        _, cells = _cells(anchors, buckets)
        found = np.ones(len(anchors), bool)
        for cell in cells:
            found &= ((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1).astype(bool)
        return left.filter(pa.array(found))

    return rows.groupBy("bucket").cogroup(merged.groupBy("bucket")).applyInArrow(meet, schema)


def pairs(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """A number for each row (or key) and the lower half of the anchor."""
    return (rows.astype(np.int64).view(np.uint64) << np.uint64(32) | anchors.view(np.uint64) & LOW).view(np.int64)


def _asked(find: Callable, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, asked, known): a buffer's anchors with the keys of their rows, packed by group of
    buckets. Of an anchor two at most are sent there, which tells that it is repeated; the
    others are known to be, and go anywhere as pairs."""
    held, size = [], 0
    groups = -(-buckets // GROUP)

    def flush():
        anchors, keys = (np.concatenate(part) for part in zip(*held))
        order = np.argsort(anchors)
        anchors, keys = anchors[order], keys[order]
        more = np.zeros(len(anchors), bool)
        more[2:] = anchors[2:] == anchors[:-2]
        asked = np.empty(int((~more).sum()), ASKED)
        asked["anchor"], asked["key"] = anchors[~more], keys[~more]
        part = (asked["anchor"] % np.uint64(buckets)).astype(np.int64) // GROUP
        order = np.argsort(part, kind="stable")
        names, first = np.unique(part[order], return_index=True)
        asked, ends = asked[order], np.append(first[1:], len(order))
        known = np.unique(pairs(keys[more], anchors[more]))
        known = [known[i : i + PAIRS] for i in range(0, len(known), PAIRS)]
        away = [int(mix(x[:1].view(np.uint64))[0] % np.uint64(groups)) for x in known]
        columns = [
            pa.array([*names.tolist(), *away], pa.int64()),
            pa.array([*(asked[a:b].tobytes() for a, b in zip(first, ends)), *[None] * len(known)], pa.binary()),
            pa.array([*[None] * len(names), *(x.tobytes() for x in known)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["part", "asked", "known"])

    for batch in batches:
        keys = batch.column("key").to_numpy()
        for chunk in chunks(batch.column("text")):
            anchors, row = find(chunk)
            held.append((anchors, keys[chunk.first + row]))
            size += len(anchors)
            if size >= BUFFER:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _told(buckets: int, table: pa.Table) -> pa.Table:
    """(key, anchor) of those anchors of a group of buckets whose cells are all hit twice or more."""
    asked = [np.frombuffer(x, ASKED) for x in table.column("asked").to_pylist() if x is not None]
    asked = np.concatenate(asked) if asked else np.zeros(0, ASKED)
    anchors = np.ascontiguousarray(asked["anchor"])
    bucket, cells = _cells(anchors, buckets)
    found = np.ones(len(anchors), bool)
    for i, cell in enumerate(cells):
        at = bucket % GROUP * CELLS + cell - i * CELLS
        found &= (np.bincount(at, minlength=1) > 1)[at]
    known = [np.frombuffer(x, np.int64) for x in table.column("known").to_pylist() if x is not None]
    every = np.unique(np.concatenate([pairs(asked["key"][found], anchors[found]), *known]))
    columns = [pa.array((every >> 32).astype(np.int32)), pa.array(every.astype(np.uint32).view(np.int32))]
    return pa.table(columns, names=["key", "anchor"])


def told(rows: DataFrame, find: Callable, buckets: int) -> DataFrame:
    """(key, anchors): per key the lower halves of the anchors of its texts that are estimated to be repeated.

    `rows` has key (INT) and text; `find` gives a chunk's anchors, once where each stands, and their rows.
    Another anchor of the text may have the same lower half, so this tells too many at most.
    """
    asked = rows.select("key", "text").mapInArrow(
        lambda batches: _asked(find, buckets, batches), "part BIGINT, asked BINARY, known BINARY"
    )
    found = asked.groupBy("part").applyInArrow(lambda table: _told(buckets, table), "key INT, anchor INT")
    return found.groupBy("key").agg(F.collect_list("anchor").alias("anchors"))
