"""Size-aware heavy-light Jaccard join over word n-grams.

Two sets link if their Jaccard similarity is at least `PERCENT` / 100. In any fixed
order of all shingles, linked sets share at least two of their first
``size - ceil(0.8 * size) + 2`` shingles, their heads. So

* light sets (few shingles) list all 2-subsets of their head; two light sets that
  link share one of them;
* heavy sets are found by scanning the inverted lists of the single shingles of
  their head; light sets large enough to link with a heavy one are in these lists.

The boundary between light and heavy is the size at which the sum of both costs is
smallest, from the measured sizes and the measured mean length of a list.

The order puts frequent shingles last. Which shingles count as frequent only
affects the cost: any choice gives the same links.

Equal sets are one class with a representative; only representatives are joined.
Within a list not all pairs are made: all members are compared with one pivot and
the components of the links are formed; lists whose members are in one component
are done. After `STAR_ROUNDS` rounds with different pivots, the members outside the largest
component of a list that remains are compared with all of it, by their sketches first, so that
no link is lost. That is the product of both numbers at worst.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlekit.llm.components import components
from candlekit.llm.textbytes import chunks, mix, shingle_hashes
from candlekit.session import stage, staged

WORDS = 5
PERCENT = 80
#: A shingle is frequent if that many sets have it, counting those of buffers in which
#: SEEN sets or more have it; at most FREQUENT of them are sent to the executors (8 bytes each).
COMMON = 32
SEEN = 3
FREQUENT = 1 << 20
BUFFER = 1 << 19
#: Sets of that size or more are heavy at any cost.
HEAVY = 512
SKETCH_WORDS = 16
#: Sets whose sketches are made at once, with 8 KB each.
SKETCHED = 512
#: A larger set has a wide sketch too, of about a bit per shingle, up to WIDE bits; beyond
#: that it only excludes fewer pairs.
WIDE = 1 << 20
#: Rounds in which lists are compared with one pivot only, before what remains is compared in full.
STAR_ROUNDS = 2
#: Cost of a member of a scanned list, in listed subsets.
SCAN_COST = 2.0


def _head(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, size - -(-PERCENT * size // 100) + 2)


def _distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted by text and hash."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _within_head(rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets, position of every shingle in its set, whether it is in the head."""
    first = np.searchsorted(rows, np.arange(count + 1))
    sizes = np.diff(first)
    place = np.arange(len(rows)) - first[rows]
    return sizes, place, place < _head(sizes)[rows]


def _measure(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, value, n). Kind 0: shingles, of whole sets, that n >= SEEN texts of a buffer
    have. Those outside the heads count too: they move up when frequent ones are put last.
    Kind 1: sizes of the sets, up to HEAVY, that n texts have. Kind 2: members and lists of
    the buffer's heads, in order of hash."""
    held, heads, size = [], [], 0
    sizes = np.zeros(HEAVY + 1, np.int64)

    def rows(kind, values, counts):
        columns = [pa.array(np.full(len(values), kind, np.int32)), pa.array(values, pa.int64()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "value", "n"])

    def flush():
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        common = counts >= SEEN
        yield rows(0, tokens[common].view(np.int64), counts[common])
        listed = np.concatenate(heads)
        yield rows(2, [0, 1], [len(listed), len(np.unique(listed))])

    for batch in batches:
        for chunk in chunks(batch.column("text")):
            shingles, hashes = _distinct(*shingle_hashes(chunk, words))
            own, _, inside = _within_head(shingles, chunk.rows)
            sizes += np.bincount(np.minimum(own, HEAVY), minlength=HEAVY + 1)
            held.append(hashes)
            heads.append(hashes[inside])
            size += len(hashes)
            if size >= BUFFER:
                yield from flush()
                held, heads, size = [], [], 0
    if size:
        yield from flush()
    found = np.flatnonzero(sizes)
    yield rows(1, found, sizes[found])


def _sketches(rows: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """Bit b of a set's sketch is the parity of its shingles whose hash falls on b. The
    bits in which two sketches differ are at most as many as the differing shingles."""
    bits = 64 * SKETCH_WORDS
    packed = np.zeros((count, bits // 8), np.uint8)
    for low in range(0, count, SKETCHED):
        high = min(low + SKETCHED, count)
        part = slice(*np.searchsorted(rows, [low, high]))
        places = (rows[part] - low) * bits + (hashes[part] >> np.uint64(54)).astype(np.int64) % bits
        odd = (np.bincount(places, minlength=(high - low) * bits) & 1).astype(bool)
        packed[low:high] = np.packbits(odd.reshape(high - low, bits), axis=1, bitorder="little")
    return packed.view("<i8")


def _wide_sketches(first: np.ndarray, mixed: np.ndarray) -> pa.ListArray:
    """Sketches like those of `_sketches`, as wide as the set's size, rounded up to a power of
    two; empty for sets that have no more shingles than a plain sketch has bits. The two
    halves of a sketch, combined by xor, are the sketch of half the width."""
    sizes = np.diff(first)
    exponent = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    bits = np.where(sizes > 64 * SKETCH_WORDS, np.minimum(np.int64(1) << exponent, WIDE), 0)
    starts = np.concatenate([[0], np.cumsum(bits)])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    large = bits[rows] > 0
    rows = rows[large]
    places = starts[rows] + (mixed[large] & (bits[rows] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(places, minlength=starts[-1]) & 1).astype(bool)
    packed = np.packbits(odd, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(starts // 64, pa.int32()), pa.array(packed, pa.int64()))


def _digests(first: np.ndarray, mixed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over the shingles of every set; with the size, they identify it."""
    sums = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(mixed, out=sums[0, 1:])
    np.cumsum(mix(hashes ^ np.uint64(2)), out=sums[1, 1:])
    return (sums[:, first[1:]] - sums[:, first[:-1]]).view(np.int64)


def _describe(words: int, frequent: np.ndarray, light: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: its set's size, digest, sketches and the keys under which it is listed."""
    reach = PERCENT * light // 100
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            rows, hashes = _distinct(*shingle_hashes(chunk, words))
            count = chunk.rows
            first = np.searchsorted(rows, np.arange(count + 1))
            mixed = mix(hashes ^ np.uint64(1))
            digest = _digests(first, mixed, hashes)
            sketch = _sketches(rows, hashes, count)
            wide = _wide_sketches(first, mixed)

            late = np.zeros(len(hashes), bool)
            if len(frequent) and len(hashes):
                at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
                late = frequent[at] == hashes
                order = np.lexsort((hashes, late, rows))
                hashes, late = hashes[order], late[order]
            sizes, _, inside = _within_head(rows, count)
            # Single shingles for heavy sets and for light sets that can link with them.
            single = inside & (sizes[rows] >= min(reach, light + 1))
            key_rows, keys = [rows[single]], [hashes[single]]
            # 2-subsets for light sets; a set of one shingle has that alone.
            small = inside & (sizes[rows] <= light)
            small_rows, small_hashes = rows[small], hashes[small]
            ends = np.searchsorted(small_rows, small_rows, "right")
            alone = sizes[small_rows] == 1
            key_rows.append(small_rows[alone])
            keys.append(mix(small_hashes[alone] ^ np.uint64(3)))
            longest = int((_head(sizes[sizes <= light]).max(initial=0)))
            for step in range(1, longest):
                left = np.flatnonzero(np.arange(len(small_rows)) + step < ends)
                a, b = small_hashes[left], small_hashes[left + step]
                key_rows.append(small_rows[left])
                keys.append(mix(np.minimum(a, b) ^ mix(np.maximum(a, b))))
            key_rows, keys = np.concatenate(key_rows), np.concatenate(keys)
            # The lowest bit tells the keys that are frequent shingles.
            keys = (keys & ~np.uint64(1)) | np.append(late[single], np.zeros(len(keys) - int(single.sum()), bool)).astype(np.uint64)
            rare = np.bincount(rows[single & ~late & (sizes[rows] > light)], minlength=count)
            order = np.argsort(key_rows, kind="stable")
            key_first = np.searchsorted(key_rows[order], np.arange(count + 1))
            lists = pa.ListArray.from_arrays(pa.array(key_first, pa.int32()), pa.array(keys[order].view(np.int64)))
            sketches = pa.ListArray.from_arrays(
                pa.array(np.arange(count + 1) * SKETCH_WORDS, pa.int32()), pa.array(sketch.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(chunk.first, count),
                    batch.column("mark").slice(chunk.first, count),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(digest[0]),
                    pa.array(digest[1]),
                    pa.array(rare.astype(np.int64)),
                    sketches,
                    wide,
                    lists,
                ],
                names=["doc_id", "mark", "size", "d1", "d2", "rare", "sketch", "wide", "keys"],
            )


def _sets(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            rows, hashes = _distinct(*shingle_hashes(chunk, words))
            first = np.searchsorted(rows, np.arange(chunk.rows + 1))
            digest = _digests(first, mix(hashes ^ np.uint64(1)), hashes)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(first).astype(np.int64)), pa.array(digest[0]), pa.array(digest[1]), lists],
                names=["size", "d1", "d2", "shingles"],
            )


def light_boundary(sizes: list[tuple[int, int]], mean_list: float) -> int:
    """The largest light size: the one with the smallest sum of both costs.

    `sizes` has (size, number of sets). A light set costs its 2-subsets, a heavy one the
    members of the lists of its head.
    """
    best, cost, boundary = None, 0.0, 0
    heads = [(size, count, int(_head(np.array([size]))[0])) for size, count in sorted(sizes)]
    heavy = sum(count * head * (1 + SCAN_COST * mean_list) for _, count, head in heads)
    light = 0.0
    best = heavy
    for size, count, head in heads:
        light += count * head * (head - 1) / 2
        heavy -= count * head * (1 + SCAN_COST * mean_list)
        cost = light + heavy
        if cost < best:
            best, boundary = cost, size
    return boundary


def _apart(a: Column, b: Column) -> Column:
    """The number of bits in which two sketches differ."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, SKETCH_WORDS)), F.bit_count(a[0].bitwiseXOR(b[0])))


def _may_link(a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Necessary: the differing shingles are at most a ninth (for 80 %) of both sizes."""
    return (
        (100 * F.least(size_a, size_b) >= PERCENT * F.greatest(size_a, size_b))
        & (_apart(a, b) * (100 + PERCENT) <= (100 - PERCENT) * (size_a + size_b))
    )


def _may_link_wide(a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Like `_may_link`, by the wide sketches, which two large sets of similar size have; the
    widths differ by one halving at most."""
    width = F.least(F.size(a), F.size(b))

    def narrow(x: Column) -> Column:
        halves = F.zip_with(F.slice(x, F.lit(1), width), F.slice(x, width + 1, width), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > width, halves).otherwise(x)

    apart = F.zip_with(narrow(a), narrow(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(apart, F.lit(0), lambda sum_, bits: sum_ + bits)
    return (width == 0) | (differ * (100 + PERCENT) <= (100 - PERCENT) * (size_a + size_b))


def _likely(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link."""
    for sketch, may_link in (("sketch", _may_link), ("wide", _may_link_wide)):
        described = about.select("id", "size", sketch)
        left, right = described.toDF("a", "size_a", "sketch_a"), described.toDF("b", "size_b", "sketch_b")
        may = may_link(F.col("sketch_a"), F.col("sketch_b"), F.col("size_a"), F.col("size_b"))
        pairs = pairs.join(left, "a").join(right, "b").filter(may).select("a", "b")
    return pairs


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    # Sets of earlier turns that no pair names are not shuffled. Both sides read the same
    # rows, renamed after the join, so those are shuffled once.
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = sets.join(ids, "id", "left_semi")
    both = pairs.join(named.alias("of_a"), F.col("a") == F.col("of_a.id")).join(named.alias("of_b"), F.col("b") == F.col("of_b.id"))
    both = both.select("a", "b", F.col("of_a.shingles").alias("set_a"), F.col("of_b.shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= PERCENT * union).select("a", "b")


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) for every row of `docs`.

    n_shingles is the number of distinct shingles of `words` words of the whole text,
    A-Z lower-cased; a text with fewer words is one shingle, a text without words (or
    null) has none and links with nothing, not even its like. component_id is the smallest
    doc_id that can be reached by links, its own included. class_id is the smallest
    doc_id with the same set. Repeated rows give the same result each. A row without
    doc_id links like the others but names none: class_id is null if no row with a
    doc_id has its set, component_id if none with a doc_id can be reached. Rows that share a doc_id but not the set are told apart: each has
    the links of its own text. Other columns are not read. An empty table gives an empty result.
    """
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return linked_sets(docs, words, nameless=True).select(
        "doc_id", "n_shingles", *[F.coalesce(own, name).alias(name) for name in ("component_id", "class_id")]
    )


def row_mark() -> Column:
    """With the doc_id, what a row is known by: rows equal in both have the same text."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def linked_sets(docs: DataFrame, words: int = WORDS, nameless: bool = False) -> DataFrame:
    """(doc_id, mark, n_shingles, class, component, class_id, component_id) for every row of `docs`.

    `mark` is the row's `row_mark`. Rows with the same set have the same class, classes linked
    directly or not the same component; both are numbers of no other meaning, null for a
    row without shingles. The ids are the smallest doc_ids of class and component. Sets that
    only rows without doc_id have are joined if `nameless`; else they link with nothing and
    all four are null.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_mark().alias("mark"), "text")
    measured = texts.select("text").mapInArrow(lambda batches: _measure(words, batches), "kind INT, value BIGINT, n BIGINT")
    measures = stage(measured.groupBy("kind", "value").agg(F.sum("n").alias("n")), "set-measures")
    top = measures.filter((F.col("kind") == 0) & (F.col("n") >= COMMON)).orderBy(F.desc("n"), "value").limit(FREQUENT)
    frequent = np.sort(top.select("value").toPandas()["value"].to_numpy(np.int64).view(np.uint64))
    histogram = [(row["value"], row["n"]) for row in measures.filter("kind = 1 and value > 0").collect()]
    members, lists = (dict(measures.filter("kind = 2").select("value", "n").collect()).get(i, 1) for i in (0, 1))
    light = light_boundary(histogram, members / lists)

    # FREQUENT bounds what is broadcast: 8 MB.
    shared = spark.sparkContext.broadcast(frequent)
    described = texts.mapInArrow(
        lambda batches: _describe(words, shared.value, light, batches),
        "doc_id BIGINT, mark BIGINT, size BIGINT, d1 BIGINT, d2 BIGINT, rare BIGINT, sketch ARRAY<BIGINT>, wide ARRAY<BIGINT>, keys ARRAY<BIGINT>",
    )
    same = ["size", "d1", "d2"]
    # The number of a row stands for its set from here on: a doc_id can be on several texts.
    with staged(described.withColumn("id", F.monotonically_increasing_id()), "shingle-sets") as described:
        members = stage(described.select("doc_id", "mark", "id", *same), "set-members")
        joining = members.filter("size > 0" if nameless else "size > 0 and doc_id is not null")
        classes = joining.groupBy(*same).agg(
            F.min("id").alias("id"), F.min_by("mark", "id").alias("mark"), F.min("doc_id").alias("class_id")
        )
        classes = stage(classes, "set-classes")
        # Equal sets have equal keys: those of the representative's row are taken.
        own = described.join(classes.select("id"), "id", "left_semi")
        lists = stage(_lists(own.select("id", "size", "rare", "keys")), "lists")
        listed = lists.select("id").distinct()
        about = described.join(listed, "id", "left_semi").select("id", "size", "rare", "sketch", "wide")
        rare_keys = lists.filter("key % 2 = 0").select("id", "key").distinct().groupBy("id").agg(F.count("*").alias("met"))
        # Rare shingles of the head that no other set of similar size has in its head.
        alone = F.greatest(F.col("rare") - F.coalesce("met", F.lit(0)), F.lit(0)).alias("alone")
        about = stage(about.join(rare_keys, "id", "left").select("id", "size", alone, "sketch", "wide"), "set-sketches")
    found = _link_lists(texts, words, lists, about, classes)
    smallest = found.join(classes.select("id", "class_id"), "id").groupBy("component").agg(F.min("class_id").alias("component_id"))
    table = classes.join(found.join(smallest, "component"), "id", "left").select(
        *same,
        F.col("id").alias("class"),
        F.coalesce("component", "id").alias("component"),
        "class_id",
        F.coalesce("component_id", "class_id").alias("component_id"),
    )
    return members.join(table, same, "left").select(
        "doc_id", "mark", F.col("size").alias("n_shingles"), "class", "component", "class_id", "component_id"
    )


def _lists(sets: DataFrame) -> DataFrame:
    """(key, band, id, pivot, members): the lists of two members or more.

    A list has sets of similar size only: every set is in the band of its size and in the
    next, so that sets of which one is at most 1.25 times the other meet. Lists whose members
    all come from the band below are left out, as that band's list has the same members. The
    pivot is the set with the fewest rare shingles: among edited copies of a text, the one
    closest to it.
    The rows are shuffled once, by key; size and rare shingles go as one number.
    """
    both = F.shiftleft("size", 32).bitwiseOR(F.col("rare")).alias("both")
    entries = sets.select("id", both, F.explode("keys").alias("key"))
    entries = entries.withColumn("members", F.count("*").over(Window.partitionBy("key"))).filter("members > 1")
    entries = entries.withColumns({"size": F.shiftright("both", 32), "rare": F.col("both").bitwiseAND(F.lit((1 << 32) - 1))})
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / PERCENT)) + 1e-9)
    banded = entries.select("key", "id", "rare", band.alias("own"), F.explode(F.array(band, band + 1)).alias("band"))
    one_list = Window.partitionBy("key", "band")
    counted = banded.withColumns(
        {
            "members": F.count("*").over(one_list),
            "pivot": F.min(F.struct("rare", "id")).over(one_list)["id"],
            "highest": F.max("own").over(one_list),
        }
    )
    return counted.filter("members > 1 and highest = band").select("key", "band", "id", "pivot", "members")


def _link_lists(texts: DataFrame, words: int, lists: DataFrame, about: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, component) of the representatives that have a link."""
    group = ["key", "band"]
    # Of a list of two, the pivot's pair is all.
    longer = lists.filter("members > 2").select(*group, "id").join(about.select("id", "size", "alone"), "id")
    # In the list of a frequent shingle a set links with sets up to a size (see _can_meet). Of two
    # that link, at least one reaches its own size; the other must reach a set that does.
    reach = F.floor((F.col("size") - F.col("alone")) * ((100 + PERCENT) / PERCENT) + 1e-9) - F.col("size")
    strong = F.col("reach") >= F.col("size")
    longer = longer.withColumn("reach", reach)
    smallest = longer.groupBy(*group).agg(F.min(F.when(strong, F.col("size"))).alias("smallest"))
    longer = longer.join(smallest, group).filter((F.col("key") % 2 == 0) | strong | (F.col("reach") >= F.col("smallest")))
    longer = stage(longer.select(*group, "id", "size", "alone"), "longer-lists")
    # Known to be empty, so they leave the plans.
    linked = classes.filter("false").select("id", F.col("id").alias("component"))
    sets = classes.filter("false").select("id", F.array("id").alias("shingles"))
    turn = 0
    while True:
        last = turn == STAR_ROUNDS
        if not turn:
            pairs = lists.filter("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
        else:
            members = longer.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
            own = ["id", "size", "alone", "component"]
            open_lists = members.groupBy(*group).agg(
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("rank"), *own)).alias("pivot"),
            )
            open_lists = open_lists.filter("low != high").select(*group, "pivot")
            if last:
                pairs = _rest_of_lists(members.join(open_lists.select(*group), group), about)
            else:
                others = open_lists.select(*group, *[F.col(f"pivot.{name}").alias(f"{name}_other") for name in own])
                pairs = members.join(others, group).filter("component != component_other").filter(_can_meet())
                pairs = _ordered(pairs)
        pairs = stage(_likely(pairs.distinct(), about), "likely-pairs")
        sets = sets.unionByName(_missing_sets(texts, words, pairs, sets, classes))
        new = stage(_links(pairs, sets), "jaccard-links")
        if not new.isEmpty():
            # The components so far, a link per id, stand for the links they are made of.
            known = linked.select(F.col("id").alias("a"), F.col("component").alias("b"))
            linked = stage(components(known.unionByName(new)), "jaccard-components")
        if last:
            break
        turn += 1
    return linked


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "id_other").alias("a"), F.greatest("id", "id_other").alias("b"))


def _rest_of_lists(members: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components of the lists (key, band) that may link.

    Of every list the members outside its largest component are compared with all members, by
    their sketches and within the join: only pairs that may link leave it.
    """
    group, own = ["key", "band"], ["id", "size", "alone", "component", "sketch"]
    rows = stage(members.join(about.select("id", "sketch"), "id").select(*group, *own), "open-lists").filter("component is not null")
    parts = rows.groupBy(*group, "component").agg(F.count("*").alias("members"))
    largest = parts.groupBy(*group).agg(F.max(F.struct("members", "component"))["component"].alias("main"))
    outside = rows.join(largest, group).filter("component != main")
    # Both sides read the same columns, renamed after the join, so the rows are shuffled once.
    same = [F.col(f"outside.{name}") == F.col(f"others.{name}") for name in group]
    met = outside.alias("outside").join(rows.alias("others"), same).select(
        "outside.key", "main", *[F.col(f"outside.{name}") for name in own], *[F.col(f"others.{name}").alias(f"{name}_other") for name in own]
    )
    # Two that are both outside meet twice; one of the two is enough.
    once = (F.col("component_other") == F.col("main")) | (F.col("component") < F.col("component_other"))
    may = _may_link(F.col("sketch"), F.col("sketch_other"), F.col("size"), F.col("size_other"))
    return _ordered(met.filter(once & _can_meet() & may))


def _can_meet() -> Column:
    """Necessary for a pair of a list: the shared shingles, of which the `alone` ones are none, can
    be enough. Sets in the list of a frequent shingle have all their rare ones in the head, so
    there `alone` shingles are in no other set of the list."""
    least = (F.col("size") + F.col("size_other")) * PERCENT
    enough = [(F.col(f"size{x}") - F.col(f"alone{x}")) * (100 + PERCENT) >= least for x in ("", "_other")]
    return (F.col("key") % 2 == 0) | (enough[0] & enough[1])


def _missing_sets(texts: DataFrame, words: int, pairs: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """The sets of the pairs' ids that are not among `sets`, made from the representatives' texts."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    missing = stage(classes.join(ids.join(sets.select("id"), "id", "left_anti"), "id", "left_semi"), "set-ids")
    # A row of the same mark can have another text, as marks are hashes: the set decides.
    chosen = texts.join(missing.select("mark"), "mark", "left_semi").select("text")
    made = chosen.mapInArrow(lambda batches: _sets(words, batches), "size BIGINT, d1 BIGINT, d2 BIGINT, shingles ARRAY<BIGINT>")
    named = made.join(missing.select("id", "size", "d1", "d2"), ["size", "d1", "d2"]).select("id", "shingles")
    return stage(named.dropDuplicates(["id"]), "shingle-sets-of-pairs")
