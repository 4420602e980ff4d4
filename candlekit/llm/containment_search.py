"""Short test items inside long documents: size-partitioned MinHash containment search.

Items are partitioned by their number of shingles; each size class is searched
with windows of a document that are little longer than its items, so an item
inside a window has a Jaccard similarity that does not shrink with the length of
the document. A window is a run of cells of `CELL` shingles; the MinHash
signature of a cell is computed once and the signature of a window is the minimum
over its cells. An item is a candidate if its signature agrees with that of a
window in at least one of `SEEDS` hash functions. Candidates are verified by the
exact share of the item's shingles that occur in the whole document.

With the default settings a window that holds four fifths of an item's shingles has
a Jaccard similarity of at least 0.3, so it is missed with a probability below
(1 - 0.3) ** 64, or 1e-9.

The items are the stated query set: they are collected in blocks whose size is
bounded by `BLOCK_BYTES` of text, and all documents are searched for every block.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlekit.llm.textbytes import chunks, mix, shingle_hashes, sliding_minimum

WORDS = 5
THRESHOLD = 0.8
SEEDS = 64
CELL = 4
BLOCK_BYTES = 16 << 20
#: Sizes of a class differ by at most this factor.
GROWTH = 1.25


@dataclass
class Items:
    """A block of items: sorted distinct shingles of each, and signatures by class."""

    ids: np.ndarray
    sets: list[np.ndarray]
    width: np.ndarray
    signatures: np.ndarray
    known: list[np.ndarray]


def _seed(j: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & ((1 << 64) - 1))


def _window_cells(shingles: int) -> int:
    """Cells of a window that holds any run of as many shingles as the largest item of the class."""
    low = 1
    while low < shingles:
        low = max(low + 1, int(low * GROWTH))
    return -(-(low + CELL - 1) // CELL)


def index_items(ids: list, texts: list, words: int = WORDS) -> Items:
    """Index of the items that have a shingle; the others are in no document."""
    kept, sets = [], []
    for chunk in chunks(pa.array(texts, pa.string())):
        rows, hashes = shingle_hashes(chunk, words)
        for i in range(chunk.rows):
            own = np.unique(hashes[slice(*np.searchsorted(rows, [i, i + 1]))])
            if len(own):
                kept.append(ids[chunk.first + i])
                sets.append(own)
    width = np.array([_window_cells(len(own)) for own in sets], dtype=np.int64)
    signatures = np.zeros((SEEDS, len(sets)), np.uint64)
    known = []
    for j in range(SEEDS):
        signatures[j] = [mix(own ^ _seed(j)).min() for own in sets]
        bits = np.zeros(1 << 20, bool)
        bits[(signatures[j] >> np.uint64(44)).astype(np.int64)] = True
        known.append(np.packbits(bits))
    return Items(np.array(kept, dtype=np.int64), sets, width, signatures, known)


def _cells(rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and text of every cell; a cell lies within one text."""
    first = np.searchsorted(rows, np.arange(count + 1))
    lengths = np.diff(first)
    per_row = -(-lengths // CELL)
    row = np.repeat(np.arange(count), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return first[row] + number * CELL, row


def _candidates(items: Items, rows: np.ndarray, hashes: np.ndarray, count: int) -> set[tuple[int, int]]:
    """(text, item) pairs with equal signatures of a window and the item."""
    starts, cell_row = _cells(rows, count)
    found: set[tuple[int, int]] = set()
    row_ends = np.searchsorted(cell_row, np.arange(count), "right")
    for j in range(SEEDS):
        minima = np.minimum.reduceat(mix(hashes ^ _seed(j)), starts)
        slot = (minima >> np.uint64(44)).astype(np.int64)
        maybe = np.flatnonzero((items.known[j][slot >> 3] >> (7 - (slot & 7))) & 1)
        if not len(maybe):
            continue
        order = np.argsort(items.signatures[j], kind="stable")
        sorted_signatures = items.signatures[j][order]
        low = np.searchsorted(sorted_signatures, minima[maybe], "left")
        high = np.searchsorted(sorted_signatures, minima[maybe], "right")
        for cell, a, b in zip(maybe[high > low], low[high > low], high[high > low]):
            row = int(cell_row[cell])
            for item in order[a:b]:
                if (row, int(item)) in found:
                    continue
                # Is this cell's minimum that of a window of the item's class?
                width = int(items.width[item])
                begin = max(int(cell) - width + 1, int(row_ends[row - 1]) if row else 0)
                around = minima[begin : min(int(cell) + width, int(row_ends[row]))]
                windows, _ = sliding_minimum(around, min(width, len(around)))
                if (windows == minima[cell]).any():
                    found.add((row, int(item)))
    return found


def _search(items: Items, threshold: float, words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for chunk in chunks(batch.column("text")):
            rows, hashes = shingle_hashes(chunk, words)
            if not len(hashes) or not len(items.ids):
                continue
            hits = []
            for row, item in sorted(_candidates(items, rows, hashes, chunk.rows)):
                own = hashes[slice(*np.searchsorted(rows, [row, row + 1]))]
                wanted = items.sets[item]
                shared = int(np.isin(wanted, own).sum())
                if shared >= threshold * len(wanted):
                    hits.append((ids[chunk.first + row].as_py(), int(items.ids[item]), shared, len(wanted)))
            if hits:
                doc, item, shared, size = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(shared, pa.int64()), pa.array(size, pa.int64())],
                    names=["doc_id", "item_id", "n_shared", "n_item"],
                )


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The different items in blocks of about `block_bytes`, one block in memory at a time."""
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 64
    numbered = benchmark.filter("item_id is not null").select("item_id", "text").distinct().withColumn("_size", size)
    total = numbered.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    count = max(1, -(-2 * total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for number in range(count):
        rows = numbered.filter(block == number).select("item_id", "text").orderBy("item_id", "text").collect()
        yield [row["item_id"] for row in rows], [row["text"] for row in rows]


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for every document and item of which it holds
    at least `threshold` of the shingles.

    `docs` has doc_id and text, `benchmark` item_id and text; other columns are not
    read. Shingles are runs of `words` words, A-Z lower-cased; a text with fewer words
    is one shingle, a text without words (or null) has none and is in no result.
    Rows without item_id are left out; a null doc_id is reported as null. Repeated rows
    are reported once. Empty tables give an empty result.
    """
    result = _matches(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, threshold, words, block_bytes)
    # Items that share an id count as one; the best match stands.
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc(F.col("n_shared") / F.col("n_item")), F.desc("n_item"))
    return result.withColumn("_place", F.row_number().over(best)).filter("_place = 1").drop("_place")


def _matches(texts: DataFrame, benchmark: DataFrame, threshold: float, words: int, block_bytes: int) -> DataFrame:
    """A row like those of `contained_items` for every match of a row of `texts` and an item."""
    spark = texts.sparkSession
    schema = "doc_id BIGINT, item_id BIGINT, n_shared BIGINT, n_item BIGINT"
    result = spark.createDataFrame([], schema)
    for ids, items in _blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(index_items(ids, items, words))

        def search(batches, shared=shared):
            return _search(shared.value, threshold, words, batches)

        result = result.unionByName(texts.mapInArrow(search, schema))
    return result


def without_contained(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of `docs` that hold no item, whether or not the item has an item_id. Every row
    is judged by its own text, whatever its doc_id."""
    # A text is known by its hash.
    benchmark = benchmark.select(F.xxhash64("text").alias("item_id"), "text")
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    matches = _matches(texts, benchmark, threshold, words, block_bytes)
    found = matches.select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == found["_found"], "left_anti")
