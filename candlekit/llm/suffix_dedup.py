"""Suffix-array deduplication of byte strings, one bucket of suffixes at a time.

Every string of `LENGTH` bytes that occurs twice is found by sorting suffixes. The
suffixes are dealt out by the anchor of the string they begin with (see `anchors`):
equal strings have equal anchors, so they meet in one bucket. Suffixes whose anchor
does not occur twice need no bucket; that is what the merged sketch tells.

A bucket holds the text segments around its anchors. Blocks of at most
`BLOCK_BYTES` of segments are sorted in turn:

1. The positions of the block that fall on a difference cover modulo `PERIOD` are the
   sample. Their suffixes are ranked by the first PERIOD bytes, then by doubling the
   depth until it exceeds LENGTH; sample positions stay sample positions when PERIOD is
   added, so only the sample needs ranks.
2. The suffixes to be sorted are grouped by their first PERIOD bytes.
3. Ties go on by the ranks: for any two suffixes the cover has a shift below PERIOD that
   takes both to sample positions, whose ranks decide. That needs no byte of the
   strings, however long the tie.
4. Those of a group with LENGTH bytes in common are repeated.

Memory is bounded by the block: ranks for the sample, a fraction of the positions.
A bucket of one anchor that is larger than a block would not fit; its strings go on
as 128-bit hashes, which Spark groups.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlekit.llm import anchors as A
from candlekit.llm.textbytes import BYTE_BASE, WORD_BASE, Chunk, chunks, mix, prefix_sums, sliding_minimum, span_hashes, text_arrays
from candlekit.session import stage

LENGTH = 200
RUN = 68
PERIOD = 32
BLOCK_BYTES = 4 << 20
#: Segments of a task that are compared before they are handed on.
BUFFER_BYTES = 24 << 20
BYTES_PER_ANCHOR = (LENGTH - RUN + 2) // 2
SEGMENTS = "bucket BIGINT, anchor BIGINT, segment BINARY, doc BIGINT, mark BIGINT, start BIGINT, n BIGINT"
FOUND = "h1 BIGINT, h2 BIGINT, doc BIGINT, mark BIGINT, start BIGINT, n BIGINT"


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every residue is a difference of two of them; greedily small."""
    cover, differences = [0], {0}
    while len(differences) < period:
        gains = [len({(x - c) % period for c in cover} | {(c - x) % period for c in cover} | differences) for x in range(period)]
        cover.append(int(np.argmax(gains)))
        differences |= {(a - b) % period for a in cover for b in cover}
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _shifts() -> np.ndarray:
    """[a, b]: the smallest shift that takes the residues a and b into the cover."""
    shift = np.arange(PERIOD)
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            both = _IN_COVER[(a + shift) % PERIOD] & _IN_COVER[(b + shift) % PERIOD]
            table[a, b] = np.flatnonzero(both)[0]
    return table


SHIFTS = _shifts()
#: Odd factors, one for each eight bytes of PERIOD.
MARKS = [np.uint64(pow(WORD_BASE, i, 1 << 64)) for i in range(1, PERIOD // 8 + 1)]


def _pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by two numbers, below or equal to the number of rows, and where new pairs begin in it."""
    size = len(first)
    bits = np.uint64(size.bit_length())
    held = (first.astype(np.uint64) << bits) | second.astype(np.uint64)
    if 3 * int(bits) <= 64:
        # The position fits beside the pair: plain numbers sort faster than positions.
        held = np.sort((held << bits) | np.arange(size, dtype=np.uint64))
        order, held = (held & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), held >> bits
    else:
        order = np.argsort(held)
        held = held[order]
    return order, _begins(held)


def _begins(held: np.ndarray) -> np.ndarray:
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    return new


def _ranks(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, the first one counting most, and where new values begin in it. A key is
    looked at for rows only that are equal in those before."""
    order = np.argsort(keys[0])
    new = _begins(keys[0][order])
    for key in keys[1:]:
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        rows = order[tied]
        values = key[rows]
        by_value = np.argsort(values)
        arranged, begins = _pairs(np.cumsum(new[tied]) - 1, _ranks(by_value, _begins(values[by_value])))
        order[tied] = rows[arranged]
        new[tied] = begins
    return order, new


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a number that sorts like them."""
    out = text
    for kind, width in ((np.uint16, 1), (np.uint32, 2), (np.uint64, 4)):
        out = (out[:-width].astype(kind) << kind(8 * width)) | out[width:]
    return out


def _classes(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions with equal keys side by side, in no special order otherwise, and where each class
    begins there. One sort, of a sum over the keys; where two classes have the same sum, the
    keys are sorted."""
    mark = sum(key * odd for key, odd in zip(keys, MARKS))
    order = np.argsort(mark)
    new = _begins(mark[order])
    for key in keys:
        held = key[order]
        if np.any((held[1:] != held[:-1]) & ~new[1:]):
            return _ranked(keys)
    return order, new


def _prefix_ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks by the keys; of equal rows one is sorted."""
    order, new = _classes(keys)
    one = order[new]
    return _ranks(*_ranked([key[one] for key in keys]))[_ranks(order, new)]


def sample_ranks(eights: np.ndarray, size: int) -> np.ndarray:
    """Rank, for every cover position below `size`, of its suffix to a depth above LENGTH."""
    at = np.flatnonzero(_IN_COVER[np.arange(size) % PERIOD])
    rank = _prefix_ranks([eights[at + i] for i in range(0, PERIOD, 8)])
    ranks = np.full(size + PERIOD, -1, np.int64)
    depth = PERIOD
    while depth < LENGTH + PERIOD and len(at) and rank.max() + 1 < len(at):
        ranks[at] = rank
        beyond = ranks[np.minimum(at + depth, size + PERIOD - 1)]
        rank = _ranks(*_pairs(rank, beyond + 1))
        depth *= 2
    ranks[at] = rank
    return ranks


def repeated_starts(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes from each start also begin at another start."""
    size = len(text) + PERIOD
    padded = np.zeros(len(text) + 2 * PERIOD + LENGTH + 8, np.uint8)
    padded[: len(text)] = text
    eights = _eights(padded)
    ranks = sample_ranks(eights, size)
    repeated = np.zeros(len(starts), bool)

    items, new = _classes([eights[starts + i] for i in range(0, PERIOD, 8)])
    group = np.cumsum(new) - 1
    # Three-way partitioning of all tied groups at once, around a pivot per group.
    while True:
        first = np.ones(len(items), bool)
        first[1:] = group[1:] != group[:-1]
        head = np.flatnonzero(first)
        sizes = np.diff(np.append(head, len(items)))
        tied = np.repeat(sizes > 1, sizes)
        items, group = items[tied], group[tied]
        if not len(items):
            break
        first = np.ones(len(items), bool)
        first[1:] = group[1:] != group[:-1]
        head = np.flatnonzero(first)
        sizes = np.diff(np.append(head, len(items)))
        pivot = np.repeat(items[head + sizes // 2], sizes)
        own, other = starts[items], starts[pivot]
        shift = SHIFTS[own % PERIOD, other % PERIOD]
        side = np.sign(ranks[own + shift] - ranks[other + shift])
        # Equal to the pivot in LENGTH bytes: by rank, or by the bytes themselves, of which a group
        # has the first PERIOD in common.
        equal = side == 0
        unsure = np.flatnonzero(~equal)
        for i in reversed(range(PERIOD, LENGTH, 8)):
            unsure = unsure[eights[own[unsure] + i] == eights[other[unsure] + i]]
        equal[unsure] = True
        several = equal & (items != pivot)
        repeated[items[several]] = True
        repeated[pivot[several]] = True
        # What equals the pivot is settled; the rest goes on on its side.
        rest = ~equal
        items, key = items[rest], group[rest] * 2 + (side[rest] > 0)
        arranged = np.argsort(key)
        items, group = items[arranged], key[arranged]
        group = np.cumsum(np.append(False, group[1:] != group[:-1])[: len(group)])
    return repeated


def _windows(chunk: Chunk):
    """First byte of every whole window, its text, anchor and the anchor's place."""
    sums = prefix_sums(chunk.data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    at = np.arange(max(0, len(chunk.data) - RUN + 1))
    runs = mix(span_hashes(sums, at, at + RUN, BYTE_BASE))
    values, places = sliding_minimum(runs, LENGTH - RUN + 1)
    lengths = np.maximum(np.diff(chunk.bounds) - LENGTH + 1, 0)
    rows = np.repeat(np.arange(chunk.rows), lengths)
    begins = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + chunk.bounds[rows]
    return begins, rows, values[begins], places[begins]


def _anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    _, _, values, places = _windows(chunk)
    return values, places


def _segments(repeated, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments: n windows from byte `start` that share an anchor. Of equal segments of a buffer
    the first goes on with its bytes; equal ones are known to be repeated, all of them, and
    go on without (n windows from `start`)."""
    held: dict[bytes, list] = {}
    size = 0

    def flush():
        first = [(anchor, segment, *places[0]) for segment, (anchor, places) in held.items()]
        known = [
            (anchor, *place) for anchor, places in held.values() if any(x != places[0] for x in places) for place in places
        ]
        columns = list(zip(*first))
        if known:
            # Neighbouring segments of a document make one run.
            anchor, doc, mark, start, n = (np.array(x, np.int64) for x in zip(*known))
            order = np.lexsort((start, mark, doc))
            anchor, doc, mark, start, n = (x[order] for x in (anchor, doc, mark, start, n))
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] > start[:-1] + n[:-1])
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(doc)) - 1
            runs = (anchor[at], [None] * len(at), doc[at], mark[at], start[at], start[last] + n[last] - start[at])
            columns = [[*x, *y] for x, y in zip(columns, runs)]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
        bucket = (np.array(columns[0], np.int64).view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(bucket), *arrays], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    for batch in batches:
        docs, marks = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
        for chunk in chunks(batch.column("text")):
            begins, rows, values, places = _windows(chunk)
            keep = repeated(values)
            if not keep.any():
                continue
            begins, rows, values, places = begins[keep], rows[keep], values[keep], places[keep]
            new = np.ones(len(begins), bool)
            new[1:] = (begins[1:] != begins[:-1] + 1) | (places[1:] != places[:-1]) | (rows[1:] != rows[:-1])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(begins)))
            data = chunk.data.tobytes()
            own = rows[at] + chunk.first
            begins, values = begins[at], values[at].view(np.int64)
            starts = begins - chunk.bounds[rows[at]]
            for anchor, begin, n, doc, mark, start in zip(
                values.tolist(), begins.tolist(), counts.tolist(), docs[own].tolist(), marks[own].tolist(), starts.tolist()
            ):
                segment = data[begin : begin + n + LENGTH - 1]
                entry = held.get(segment)
                if entry is None:
                    held[segment] = (anchor, [(doc, mark, start, n)])
                    size += len(segment) + 200
                else:
                    entry[1].append((doc, mark, start, n))
                    size += 64
            if size >= BUFFER_BYTES:
                yield flush()
                held, size = {}, 0
    if held:
        yield flush()


def _found(h1, h2, doc, mark, start, n) -> pa.RecordBatch:
    columns = [pa.array(x, pa.int64()) for x in (h1, h2, doc, mark, start, n)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in FOUND.split(", ")])


def _runs(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray):
    """Runs of flagged windows of a segment: segment, first offset, length."""
    owner, offset = owner[flags], offset[flags]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
    at = np.flatnonzero(new)
    return owner[at], offset[at], np.diff(np.append(at, len(owner)))


def _spread(data: np.ndarray, bounds: np.ndarray):
    """Of every window of the segments: segment, offset in it, position in `data`."""
    counts = np.diff(bounds) - LENGTH + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, offset, bounds[owner] + offset


def _hashed(part: pa.Table) -> pa.RecordBatch:
    """Every window of the segments, with its hash."""
    data, bounds = text_arrays(part.column("segment").chunk(0))
    owner, offset, at = _spread(data, bounds)
    doc, mark, start = (part.column(name).to_numpy() for name in ("doc", "mark", "start"))
    numbers = data.astype(np.uint64) + np.uint64(1)
    h1, h2 = (
        mix(span_hashes(prefix_sums(numbers, base), at, at + LENGTH, base)).view(np.int64) for base in (BYTE_BASE, WORD_BASE)
    )
    return _found(h1, h2, doc[owner], mark[owner], start[owner] + offset, np.zeros(len(owner), np.int64))


def _sorted_block(part: pa.Table) -> pa.RecordBatch:
    """Runs of repeated windows of the segments."""
    doc, mark, start = (part.column(name).to_numpy() for name in ("doc", "mark", "start"))
    # A place that came twice (from repeated rows) is no repetition.
    _, first = np.unique(np.stack([doc, mark, start]), axis=1, return_index=True)
    part = part.take(pa.array(np.sort(first)))
    # A segment that is alone with its anchor has no string that stands elsewhere.
    anchor = part.column("anchor").to_numpy()
    with_next = np.append(anchor[1:] == anchor[:-1], False)
    part = part.filter(pa.array(with_next | np.append(False, with_next[:-1]))).combine_chunks()
    if not part.num_rows:
        return _found(*[np.zeros(0, np.int64)] * 6)
    doc, mark, start = (part.column(name).to_numpy() for name in ("doc", "mark", "start"))
    data, bounds = text_arrays(part.column("segment").chunk(0))
    owner, offset, at = _spread(data, bounds)
    owner, offset, n = _runs(repeated_starts(data, at), owner, offset)
    none = np.zeros(len(owner), np.int64)
    return _found(none, none, doc[owner], mark[owner], start[owner] + offset, n)


def _resolve(block_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of segments that arrive sorted by anchor: as runs (n > 0), or for an
    anchor with more than a block every window with its hash (n = 0)."""
    held: list[pa.RecordBatch] = []
    hot = None

    def joined(parts: list) -> pa.Table:
        return pa.Table.from_batches(parts).combine_chunks()

    for batch in batches:
        whole = batch.filter(batch.column("segment").is_null())
        if whole.num_rows:
            none = np.zeros(whole.num_rows, np.int64)
            yield _found(none, none, *(whole.column(x).to_numpy() for x in ("doc", "mark", "start", "n")))
        batch = batch.filter(batch.column("segment").is_valid())
        if hot is not None and batch.num_rows:
            more = int(np.searchsorted(batch.column("anchor").to_numpy() != hot, True))
            if more:
                yield _hashed(joined([batch.slice(0, more)]))
            if more < batch.num_rows:
                hot = None
            batch = batch.slice(more)
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.column("segment").nbytes for x in held) < block_bytes:
            continue
        table = joined(held)
        anchors = table.column("anchor").to_numpy()
        tail = int(np.searchsorted(anchors, anchors[-1]))
        if tail:
            yield _sorted_block(table.slice(0, tail).combine_chunks())
        rest = table.slice(tail).combine_chunks()
        if rest.nbytes >= block_bytes:
            yield _hashed(rest)
            held, hot = [], anchors[-1]
        else:
            held = rest.to_batches()
    if held:
        yield _sorted_block(joined(held))


def repeated_strings(docs: DataFrame, sketch_bytes: int = A.SKETCH_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc, mark, start, n): n strings of LENGTH bytes, from byte `start` on, that also start elsewhere."""
    rows = A.keyed(docs)
    buckets, merged = A.sketch(rows, _anchors, BYTES_PER_ANCHOR)
    known = A.estimate(buckets, merged, sketch_bytes)
    if known:
        shared = docs.sparkSession.sparkContext.broadcast(known)
        segments = rows.mapInArrow(lambda batches: _segments(shared.value, buckets, batches), SEGMENTS)
    else:
        every = rows.mapInArrow(lambda batches: _segments(lambda a: np.ones(len(a), bool), buckets, batches), SEGMENTS)
        segments = A.keep_estimated(every, buckets, merged)
    # Runs that are known already go anywhere.
    dealt = segments.drop("bucket").withColumn(
        "deal", F.when(F.col("segment").isNull(), F.xxhash64("doc", "start")).otherwise(F.col("anchor"))
    )
    dealt = dealt.repartition("deal").drop("deal").sortWithinPartitions("anchor")
    found = stage(dealt.mapInArrow(lambda batches: _resolve(block_bytes, batches), FOUND), "repeated-strings")
    places = ["doc", "mark", "start"]
    single = found.filter("n = 0")
    # Of the hashed windows, those whose hash stands at two places.
    twice = single.groupBy("h1", "h2").agg(F.min(F.struct(*places)).alias("a"), F.max(F.struct(*places)).alias("b"))
    more = single.join(twice.filter("a != b").select("h1", "h2"), ["h1", "h2"], "left_semi")
    return found.filter("n > 0").select(*places, "n").unionByName(more.select(*places, F.lit(1).cast("long").alias("n")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their runs."""
    for batch in batches:
        data, bounds = text_arrays(batch.column("text"))
        runs = batch.column("runs")
        removed, spans, kept = [], [], []
        for i in range(batch.num_rows):
            text = data[bounds[i] : bounds[i + 1]].tobytes()
            parts, at, count, gone = [], 0, 0, 0
            if runs[i].is_valid:
                end = 0
                for run in sorted(runs[i].as_py(), key=lambda run: run["start"]):
                    start, stop = run["start"], run["start"] + run["n"] + LENGTH - 1
                    if start > end or not count:
                        parts.append(text[at:start])
                        count += 1
                        end = start
                    gone += max(0, stop - end)
                    end = at = max(end, stop)
            parts.append(text[at:])
            removed.append(gone)
            spans.append(count)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeated_strings(
    docs: DataFrame, sketch_bytes: int = A.SKETCH_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of `docs`.

    Every byte of the UTF-8 text is removed that lies in a string of LENGTH bytes which also
    starts anywhere else, in the same document or another, the first occurrence included.
    n_spans is the number of maximal removed runs, `kept` the other bytes (which need not be
    valid UTF-8). Strings are judged on the input and never cross documents. A null text is
    empty. Rows that repeat both doc_id and text are one document, not a repetition, and give
    the same result each; rows that share a doc_id only are different documents. Other
    columns are not read. An empty table gives an empty result.
    """
    runs = repeated_strings(docs, sketch_bytes, block_bytes).groupBy("doc", "mark")
    runs = runs.agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = A.keyed(docs).join(runs, ["doc", "mark"], "left").select("doc", "text", "runs")
    cut = joined.mapInArrow(_cut, "doc BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")
    return cut.select(A.doc_id(), "n_bytes", "n_removed", "n_spans", "kept")
