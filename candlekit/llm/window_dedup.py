"""Substring deduplication of word windows with a count-min prefilter.

A window is `WINDOW` consecutive words of one document.

Pass 1 merges the partition sketches of all window anchors (see `anchors`), which
overestimates how often a window occurs.
Pass 2 groups exactly, by 128 bits of hash, only the windows that are estimated to be
repeated. A task first combines its own windows, so a passage that stands in a third
of all rows sends one window per buffer, not one per row.

The merged sketch is sent to the executors while it is smaller than `SKETCH_BYTES`; beyond
that the anchors are sent to the buckets of the sketch, and the repeated ones back to their
texts (`anchors.told`). Texts are then shuffled once, by `key`, for all steps that read them, and
texts that also stand under a smaller doc_id send nothing: all their windows are repeated. The
key is made of the smallest hash of a text's runs, so near copies mostly meet in one task, which
sends their common windows once. The result is the same.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlekit.llm import anchors as A
from candlekit.llm.textbytes import Chunk, chunks, gram_hashes, mix, sliding_minimum, text_arrays, word_hashes, words
from candlekit.session import stage

WINDOW = 20
RUN = 8
#: About the bytes of text per anchor: six per word, an anchor per seven words.
BYTES_PER_ANCHOR = 42
#: No text with fewer bytes has a window.
LEAST_BYTES = 2 * WINDOW - 1
#: Length of a run that goes on to the end of its text.
WHOLE = (1 << 31) - 1
#: Words of the runs that tell near copies: the fewer, the more edits they stand.
NEAR_RUN = 4
#: Texts that about share a key, and the most groups of more texts that are told to the executors.
TOGETHER = 16
LARGE_GROUPS = 1 << 20
ROWS = "h1 BIGINT, h2 BIGINT, key INT, doc BIGINT, mark BIGINT, start BIGINT, n BIGINT"
ABOUT = "near BIGINT, doc BIGINT, mark BIGINT, a BIGINT, b BIGINT"
COPIES = "key INT, doc BIGINT, mark BIGINT"
KEYED = "key INT, doc BIGINT, mark BIGINT, text STRING"


def _whole_windows(chunk: Chunk):
    """Words, word hashes, and of every window the first word, text, anchor, anchor's place."""
    spans = words(chunk)
    hashes = word_hashes(chunk.data, spans)
    values, places = sliding_minimum(gram_hashes(hashes, RUN), WINDOW - RUN + 1)
    rows = spans.rows()
    begins = np.flatnonzero(rows[: len(values)] == rows[WINDOW - 1 : WINDOW - 1 + len(values)])
    return spans, hashes, begins, rows[begins], values[begins], places[begins]


def _anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    *_, values, places = _whole_windows(chunk)
    return values, places


def _placed_anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The anchors, once where each stands, and their rows in the chunk."""
    *_, rows, values, places = _whole_windows(chunk)
    new = np.ones(len(places), bool)
    new[1:] = places[1:] != places[:-1]
    return values[new], rows[new]


def _by_list(batch: pa.RecordBatch) -> Callable:
    """Which anchors are in the list (`anchors`) of their row."""
    lists = batch.column("anchors")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    listed = np.unique(A.pairs(owner, lists.flatten().to_numpy().astype(np.int64)))

    def repeated(rows, values):
        asked = A.pairs(rows, values)
        at = np.minimum(np.searchsorted(listed, asked), max(len(listed) - 1, 0))
        return listed[at] == asked if len(listed) else np.zeros(len(asked), bool)

    return repeated


def _batch(schema: str, *columns) -> pa.RecordBatch:
    columns = [x if isinstance(x, pa.Array) else pa.array(x) for x in columns]
    return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in schema.split(", ")])


def _near(batch: pa.RecordBatch) -> np.ndarray:
    """Per row the smallest hash of its runs, which near copies mostly share; without a window its mark."""
    near = batch.column("mark").to_numpy().astype(np.int64)
    for chunk in chunks(batch.column("text")):
        spans = words(chunk)
        long = np.flatnonzero(np.diff(spans.first) >= WINDOW)
        if len(long):
            runs = np.append(gram_hashes(word_hashes(chunk.data, spans), NEAR_RUN), np.uint64(0))
            within = np.stack([spans.first[long], spans.first[long + 1] - NEAR_RUN + 1], axis=1).ravel()
            near[chunk.first + long] = np.minimum.reduceat(runs, within)[::2].view(np.int64)
    return near


def _keys(groups: tuple[np.ndarray, np.ndarray], near: np.ndarray, docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """A key for each row, from `near`; `groups` has the values that too many rows share, and their parts."""
    names, parts = groups
    part = np.zeros(len(near), np.uint64)
    if len(names):
        at = np.minimum(np.searchsorted(names, near), len(names) - 1)
        row = mix(docs.view(np.uint64) ^ mix(marks.view(np.uint64)))
        part = np.where(names[at] == near, row % parts[at] + np.uint64(1), part)
    return (mix(near.view(np.uint64) ^ mix(part)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _about(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _batch(ABOUT, _near(batch), *(batch.column(name) for name in ("doc", "mark", "a", "b")))


def _with_keys(groups: tuple[np.ndarray, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their key. They have `near`, or the text that it is made of."""
    for batch in batches:
        docs, marks = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
        whole = "text" in batch.schema.names
        keys = _keys(groups, _near(batch) if whole else batch.column("near").to_numpy(), docs, marks)
        yield _batch(KEYED, keys, docs, marks, batch.column("text")) if whole else _batch(COPIES, keys, docs, marks)


def _candidates(judge: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with a repeated anchor, which `judge(batch)` tells by row and anchor. Of equal
    windows of a buffer the first, with n = 0; the others are known to be repeated: they go on
    as runs of n windows from `start`, in no group."""
    held, size = [], 0

    def flush():
        h1, h2, key, doc, mark, start = (np.concatenate(part) for part in zip(*held))
        order = np.lexsort((start, mark, doc, h2, h1))
        h1, h2, key, doc, mark, start = (x[order] for x in (h1, h2, key, doc, mark, start))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (doc != doc[head]) | (mark != mark[head]) | (start != start[head])
        yield _batch(ROWS, h1[new], h2[new], key[new], doc[new], mark[new], start[new], np.zeros(int(new.sum()), np.int64))
        if later.any():
            key, doc, mark, start = key[later], doc[later], mark[later], start[later]
            order = np.lexsort((start, mark, doc))
            key, doc, mark, start = key[order], doc[order], mark[order], start[order]
            begin = np.ones(len(doc), bool)
            begin[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] > start[:-1] + 1)
            at = np.flatnonzero(begin)
            last = np.append(at[1:], len(doc)) - 1
            spread = mix(start[at].astype(np.uint64) ^ mark[at].view(np.uint64)).view(np.int64)
            yield _batch(ROWS, spread, doc[at], key[at], doc[at], mark[at], start[at], start[last] - start[at] + 1)

    for batch in batches:
        keys, docs, marks = (batch.column(name).to_numpy() for name in ("key", "doc", "mark"))
        repeated = judge(batch)
        for chunk in chunks(batch.column("text")):
            spans, hashes, begins, rows, values, _ = _whole_windows(chunk)
            keep = repeated(chunk.first + rows, values)
            if not keep.any():
                continue
            begins, rows = begins[keep], rows[keep]
            h1 = gram_hashes(hashes, WINDOW)[begins].view(np.int64)
            h2 = gram_hashes(mix(hashes ^ np.uint64(0x5BD1E995)), WINDOW)[begins].view(np.int64)
            row = rows + chunk.first
            held.append((h1, h2, keys[row], docs[row], marks[row], begins - spans.first[rows]))
            size += len(begins)
            if size >= A.BUFFER:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()


def _later(found: DataFrame) -> DataFrame:
    """(key, doc, mark, start, n): runs of n windows, from word `start`, that also start earlier."""
    # Runs have n > 0 and are in groups of their own.
    first = Window.partitionBy("h1", "h2", "n").orderBy("doc", "mark", "start")
    later = found.withColumn("place", F.rank().over(first)).filter("place > 1 or n > 0")
    return later.select("key", "doc", "mark", "start", F.greatest("n", F.lit(1)).alias("n"))


def _with_runs(rows: DataFrame, buckets: int) -> DataFrame:
    """(doc, text, runs), the windows being compared with a sketch that is sent to the executors."""
    merged = A.merged_sketch(rows, _anchors, buckets)
    shared = rows.sparkSession.sparkContext.broadcast(A.estimate(buckets, merged, buckets * A.BUCKET_BYTES))
    found = rows.withColumn("key", F.lit(0)).mapInArrow(
        lambda batches: _candidates(lambda batch: lambda row, values: shared.value(values), batches), ROWS
    )
    runs = _later(found).groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return rows.join(runs, ["doc", "mark"], "left").select("doc", "text", "runs")


def _large_groups(about: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Values of `near` that too many rows share, in order, and the parts to cut these rows into."""
    together = max(TOGETHER, about.count() // LARGE_GROUPS)
    large = about.groupBy("near").count().filter(F.col("count") > together).orderBy("near").toArrow()
    return large.column("near").to_numpy(), -(-large.column("count").to_numpy() // together).astype(np.uint64)


def _of_many_texts(about: DataFrame, keyed: Callable) -> DataFrame:
    """(key, docs): per key its documents whose doc_id stands on several texts."""
    names = about.groupBy("doc").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low < high")
    rows = about.join(stage(names.select("doc"), "several-texts"), "doc").select("near", "doc", "mark").distinct()
    return rows.mapInArrow(keyed, COPIES).groupBy("key").agg(F.collect_set("doc").alias("docs"))


def _later_copies(about: DataFrame, keyed: Callable) -> DataFrame:
    """(key, doc, mark) of the rows whose text also stands under a smaller doc_id."""
    texts = about.filter("a is not null").groupBy("a", "b")
    texts = texts.agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copies = about.join(stage(texts.filter("first < last"), "repeated-texts"), ["a", "b"]).filter("doc > first")
    return stage(copies.select("near", "doc", "mark").distinct().mapInArrow(keyed, COPIES), "later-copies")


def _with_runs_by_key(rows: DataFrame, buckets: int) -> DataFrame:
    """(doc, text, runs), without sending the sketch anywhere.

    Other documents may have the same key, so what is joined by it names its document, or may
    hold too much. All joins of the rows are by key and of all their columns, so that one exchange
    of them serves all.
    """
    digest = F.when(F.octet_length("text") >= LEAST_BYTES, F.sha2("text", 256))
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "a"), (16, "b"))]
    about = stage(rows.select("*", *halves).mapInArrow(_about, ABOUT), "about-texts")
    shared = rows.sparkSession.sparkContext.broadcast(_large_groups(about))

    def keyed(batches):
        return _with_keys(shared.value, batches)

    copies = _later_copies(about, keyed)
    # A key that may be null would be filtered before some joins only, by an exchange of its own.
    rows = rows.mapInArrow(keyed, KEYED).withColumn("key", F.coalesce("key", F.lit(0)))
    by_key = copies.groupBy("key").agg(F.collect_list(F.struct("doc", "mark")).alias("copies"))
    is_copy = F.coalesce(F.array_contains("copies", F.struct("doc", "mark")), F.lit(False))
    # Not a broadcast join: its tasks would make keys and ask anchors at once, with twice the Python workers.
    first = rows.join(by_key.hint("merge"), "key", "left").filter(~is_copy)
    told = A.told(first, _placed_anchors, buckets)
    told = told.join(by_key, "key", "left").join(_of_many_texts(about, keyed), "key", "left")
    asked = rows.join(told, "key", "left").filter("anchors is not null").filter(~is_copy)
    # Marks are 8 bytes a window. Where a doc_id has one text, 0 stands for its mark.
    mark = F.when(F.array_contains("docs", F.col("doc")), F.col("mark")).otherwise(F.lit(0))
    asked = asked.select("key", "doc", mark.alias("mark"), "text", "anchors")
    found = asked.mapInArrow(lambda batches: _candidates(_by_list, batches), ROWS)
    whole = copies.select("*", F.lit(0).cast("long").alias("start"), F.lit(WHOLE).cast("long").alias("n"))
    runs = F.collect_list(F.struct("doc", "mark", "start", "n"))
    runs = _later(found).unionByName(whole).groupBy("key").agg(runs.alias("all"))
    own = F.filter("all", lambda run: (run["doc"] == F.col("doc")) & run["mark"].isin(F.lit(0), F.col("mark")))
    return rows.join(runs, "key", "left").select("doc", "text", own.alias("runs"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their runs, joined by one space."""
    for batch in batches:
        data, bounds = text_arrays(batch.column("text"))
        runs = batch.column("runs")
        total, removed, kept = [], [], []
        for i in range(batch.num_rows):
            # bytes.split() cuts at 0x20 and 0x09 to 0x0D, the separators of `words`.
            parts = data[bounds[i] : bounds[i + 1]].tobytes().split()
            total.append(len(parts))
            if runs[i].is_valid and len(parts) >= WINDOW:
                drop = np.zeros(len(parts), bool)
                for run in runs[i].as_py():
                    drop[run["start"] : run["start"] + run["n"] + WINDOW - 1] = True
                parts = [parts[j] for j in np.flatnonzero(~drop)]
            removed.append(total[-1] - len(parts))
            kept.append(b" ".join(parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc", "n_words", "n_removed", "kept"],
        )


def without_repeated_windows(docs: DataFrame, sketch_bytes: int = A.SKETCH_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of `docs`.

    Every word is removed that lies in a window whose words also start earlier: in a document
    with a smaller doc_id, or earlier in the same one. `kept` has the other words, unchanged,
    joined by one space. Windows are judged on the input. A null text is empty; a null doc_id is
    smaller than any other. Rows that repeat a doc_id with another text are ordered by a hash
    of the text; rows that repeat both are one document and give the same result each. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = A.keyed(docs)
    buckets = A.bucket_count(rows, BYTES_PER_ANCHOR)
    joined = (_with_runs if A.fits(buckets, sketch_bytes) else _with_runs_by_key)(rows, buckets)
    cut = joined.mapInArrow(_cut, "doc BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING")
    return cut.select(A.doc_id(), "n_words", "n_removed", "kept")
