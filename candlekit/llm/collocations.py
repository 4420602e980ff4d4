"""Phrase collocations, mined by joining relations of occurrences (SETM).

Relation k holds the occurrences of phrases of k words, sorted by position within blocks
of text. Positions run on within a piece and leave a gap between pieces, so "the next word
of the same piece" is the next position. From one length to the next:

1. occurrences are counted per block, and these counts per phrase over all blocks: phrases are dealt to
   buckets, packed, as most of what is shuffled are phrases that turn out to be rare;
2. blocks keep the occurrences of frequent phrases only (semi-join);
3. two kept occurrences at adjacent positions join to one of the next length.

A frequent phrase has only frequent parts, so nothing is lost. Blocks are counted before
anything is shuffled: a phrase has at most one row per block, however often it occurs.
A phrase is known by two numbers, its first and last k - 1 words, and gets as its own number the
place of its first count row. So counts and joins are exact; no hashes are involved.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlekit.session import discard, stage, stage_at, staging_path

#: Text that the open blocks of a task hold; a longer text goes on in the next block. The larger
#: a block, the fewer count rows does a phrase have.
BLOCK_BYTES = 16 << 20
#: Text that is split into words at once.
SLICE_BYTES = 1 << 20
LONGEST = 4

# A place is a block's number times the phrases that a block can hold.
LOCAL_BITS = 24
COUNTER_BITS = 15

# Fixed by the definition of pieces and words.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(_UPPER + b"\t" + _PIECE_ENDS, _UPPER.lower() + b" " + b"." * len(_PIECE_ENDS))

_GAP = -1

#: Phrases of a block are counted in rows of so many, so that no row gets large.
ROW_PHRASES = 1 << 15
#: So many count rows of a task are dealt to the buckets at once, and a bucket gets about so many in all.
DEAL_PHRASES = 1 << 20
BUCKET_PHRASES = 1 << 18

# A block has one row with ids, its occurrences by position (packed), and rows with the counts of its phrases from number
# `base` on. Occurrences from `starts` on belong to the next block.
_BLOCK = "block long, lang string, ids binary, starts int, base int, words array<string>, counts array<long>"
_RELATION = "block long, ids binary, starts int, base int, firsts array<long>, lasts array<long>, counts array<long>"


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in slices, with b"." where a piece ends. Only the last slice may have
    less than LONGEST - 1 of them."""
    start, found = 0, []
    while start < len(text):
        end = start + SLICE_BYTES
        if end < len(text):
            # A word is never cut: go on to the next space or end of a piece.
            while end < len(text) and text[end] not in b" \t" and text[end] not in _PIECE_ENDS:
                end += 1
        found += text[start:end].translate(_FOLD).replace(b".", b" . ").split()
        start = end
        if len(found) >= LONGEST - 1:
            yield found
            found = []
    if found:
        yield found


class _Words(dict):
    """Numbers words in the order in which they come; the end of a piece is _GAP."""

    def __init__(self):
        super().__init__()
        self[b"."] = _GAP

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


class _Block:
    """The words of consecutive texts of one language, gaps between pieces and texts included."""

    def __init__(self):
        self.words = _Words()
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, tokens: list[bytes], size: int) -> None:
        self.parts.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
        self.bytes += size

    def gap(self) -> None:
        self.parts.append(np.array([_GAP], np.int32))


_ARROW = {
    "block": pa.int64(),
    "lang": pa.string(),
    "ids": pa.binary(),
    "starts": pa.int32(),
    "base": pa.int32(),
    "words": pa.list_(pa.string()),
    "firsts": pa.list_(pa.int64()),
    "lasts": pa.list_(pa.int64()),
    "counts": pa.list_(pa.int64()),
}


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers of one type, compressed with the bytes of equal weight side by side."""
    stacked = np.stack(columns)
    return _squeezed(stacked.view(np.uint8).reshape(len(columns), -1, stacked.itemsize).transpose(0, 2, 1).tobytes())


def _unpacked(data: bytes, columns: int, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(data), np.uint8).reshape(columns, np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind).reshape(columns, -1)


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(field.split()[0], _ARROW[field.split()[0]]) for field in ddl.split(", ")])


def _rows(schema: pa.Schema, same: dict, ids: np.ndarray, starts: int, phrases: dict) -> Iterator[pa.RecordBatch]:
    """The rows of one block; `same` are the values of columns that are the same in all of them."""
    last = len(phrases["counts"])
    parts = [{**same, "ids": _packed([ids - _GAP]), "starts": starts}]
    for base in range(0, last, ROW_PHRASES):
        parts.append({**same, "base": base, **{name: x[base : base + ROW_PHRASES] for name, x in phrases.items()}})
    for part in parts:
        yield pa.RecordBatch.from_arrays([pa.array([part.get(f.name)], f.type) for f in schema], schema=schema)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(_BLOCK)
    task, made = TaskContext.get().partitionId(), 0
    open_blocks: dict[str, _Block] = {}
    held = 0

    def finished(lang: str, block: _Block, ahead: int = 0) -> Iterator[pa.RecordBatch]:
        """The rows of a block. The last `ahead` words start in the next one."""
        nonlocal made
        if made >> COUNTER_BITS:
            raise OverflowError("A task makes too many blocks; read the table in more partitions")
        ids = np.concatenate(block.parts)
        starts = len(ids) - ahead
        texts = [word.decode() for word in list(block.words)[1:]]
        counts = np.bincount(ids[:starts][ids[:starts] >= 0], minlength=len(texts))
        same = {"block": (task << COUNTER_BITS) + made, "lang": lang}
        made += 1
        return _rows(schema, same, ids, starts, {"words": texts, "counts": counts})

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            block = open_blocks.setdefault(lang, _Block())
            for tokens in _tokens(text.as_py() or b""):
                if block.bytes >= BLOCK_BYTES:
                    # The text goes on: phrases that start here may end in the next slice.
                    ahead = tokens[: LONGEST - 1]
                    block.add(ahead, 0)
                    yield from finished(lang, block, len(ahead))
                    held -= block.bytes
                    block = open_blocks[lang] = _Block()
                size = sum(map(len, tokens)) + len(tokens)
                block.add(tokens, size)
                held += size
            block.gap()
            while held >= BLOCK_BYTES:
                largest = max(open_blocks, key=lambda name: open_blocks[name].bytes)
                full = open_blocks.pop(largest)
                held -= full.bytes
                yield from finished(largest, full)
    for name, last in open_blocks.items():
        yield from finished(name, last)


def _longer(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """The relation of the next length of one block: occurrences of frequent phrases, each joined
    to the one at the next position."""
    schema = _schema(_RELATION)
    if not relation.num_rows or not frequent.num_rows:
        return schema.empty_table()
    ids = _unpacked(relation.column("ids")[0].as_py(), 1, np.int32)[0] + np.int32(_GAP)
    starts = relation.column("starts")[0].as_py()
    lists = [_unpacked(data, 2) for data in frequent.column("found").to_pylist()]
    local, phrase = np.concatenate([np.cumsum(part[0]) for part in lists]), np.concatenate([part[1] for part in lists])
    # The last entry stands for the gaps.
    phrases = np.full(max(int(local.max()), int(ids.max())) + 2, -1, np.int64)
    phrases[local] = phrase
    kept = phrases[ids] >= 0
    at = np.flatnonzero(kept[:-1] & kept[1:])
    if not len(at):
        return schema.empty_table()
    pairs, numbers = np.unique(ids[at].astype(np.int64) << LOCAL_BITS | ids[at + 1], return_inverse=True)
    joined = np.full(len(ids), _GAP, np.int32)
    joined[at] = numbers
    found = {
        "firsts": phrases[pairs >> LOCAL_BITS],
        "lasts": phrases[pairs & ((1 << LOCAL_BITS) - 1)],
        "counts": np.bincount(numbers[at < starts], minlength=len(pairs)),
    }
    same = {"block": relation.column("block")[0].as_py()}
    return pa.Table.from_batches(list(_rows(schema, same, joined, starts, found)), schema)


def _bucket_of(numbers: np.ndarray, buckets: int) -> np.ndarray:
    """Where phrases are counted; numbers that are alike are spread."""
    mixed = numbers.astype(np.uint64)
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(factor)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _dealt(arrays: list[str], buckets: int):
    """A function that deals the counted phrases of blocks to buckets: one row per bucket for DEAL_PHRASES of them."""
    single = arrays == ["words"]
    schema = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("numbers", pa.binary()), ("words", pa.binary())])

    def rows(lang: str | None, parts: list) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(column) for column in zip(*parts)]
        names = columns.pop() if single else None
        if single:
            bucket = _bucket_of(np.fromiter((zlib.crc32(x) for x in names), np.uint32, len(names)), buckets)
        else:
            firsts, lasts = columns[2:]
            bucket = _bucket_of(_bucket_of(firsts, 1 << 32) << 31 ^ lasts, buckets)
        order = np.argsort(bucket, kind="stable")
        found, at = np.unique(bucket[order], return_index=True)
        packed = []
        for picked in np.split(order, at[1:]):
            # Places ascend, so they are near each other.
            numbers = [np.diff(columns[0][picked], prepend=0), *[column[picked] for column in columns[1:]]]
            packed.append((_packed(numbers), _squeezed(b"\n".join(names[picked])) if single else None))
        values = [found, [lang] * len(found), *zip(*packed)]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(values, schema)], schema=schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, lang = [], 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                now = row["lang"].as_py() if single else None
                if parts and (held >= DEAL_PHRASES or now != lang):
                    yield from rows(lang, parts)
                    parts, held = [], 0
                lang = now
                counts = row["counts"].values.to_numpy()
                places = (row["block"].as_py() << LOCAL_BITS) + row["base"].as_py() + np.arange(len(counts))
                if single:
                    others = [np.array([x.encode() for x in row["words"].values.to_pylist()], object)]
                else:
                    others = [row[name].values.to_numpy() for name in arrays]
                parts.append((places, counts, *others))
                held += len(counts)
        if parts:
            yield from rows(lang, parts)

    return deal


def _counted(key: list[str], least: int):
    """A function that counts the phrases of one bucket over all blocks, exactly. It returns a row for each frequent
    phrase, and a row for each block that has some."""
    single = key == ["lang", "word"]

    def count(bucket: pa.Table) -> pa.Table:
        parts = [_unpacked(data, 2 if single else 4) for data in bucket.column("numbers").to_pylist()]
        places = np.concatenate([np.cumsum(part[0]) for part in parts])
        counts = np.concatenate([part[1] for part in parts])
        if single:
            words = [_unsqueezed(data).split(b"\n") for data in bucket.column("words").to_pylist()]
            langs = np.repeat(np.array(bucket.column("lang").to_pylist(), object), [len(part) for part in words])
            values = [pa.array(langs, pa.string()), pa.array([x.decode() for part in words for x in part], pa.string())]
            codes = [column.dictionary_encode().indices.to_numpy() for column in values]
        else:
            codes = values = [np.concatenate([part[i] for part in parts]) for i in (2, 3)]
        order = np.lexsort(codes)
        first, second = (code[order] for code in codes)
        starts = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        sizes = np.diff(np.r_[starts, len(order)])
        f = np.repeat(np.add.reduceat(counts[order], starts), sizes)
        phrase = np.repeat(np.minimum.reduceat(places[order], starts), sizes)
        kept = f >= least
        rows, phrase, f = order[kept], phrase[kept], f[kept]
        own = places[rows] == phrase
        found = {"phrase": phrase[own], "f": f[own]}
        for name, value in zip(key, values):
            found[name] = value.take(pa.array(rows[own])) if single else value[rows[own]]

        by_place = np.argsort(places[rows])
        place, phrase = places[rows][by_place], phrase[by_place]
        blocks, at = np.unique(place >> LOCAL_BITS, return_index=True)
        local = place & ((1 << LOCAL_BITS) - 1)
        packed = [
            _packed([np.diff(part, prepend=0), numbers]) for part, numbers in zip(np.split(local, at[1:]), np.split(phrase, at[1:]))
        ]
        lists = pa.table({"block": blocks, "found": pa.array(packed[: len(blocks)], pa.binary())})
        return pa.concat_tables([pa.table(found), lists], promote_options="default")

    return count


def _frequent(relation: DataFrame, key: list[str], arrays: list[str], least: int) -> DataFrame:
    """The phrases that occur at least `least` times: rows with phrase (its number everywhere: the place
    of its first count row, that is block and number there), f and the key; and rows with a block and the packed
    numbers that such phrases have in it and everywhere.

    Phrases meet in buckets, whose number follows that of all count rows. A phrase has at most one
    row per block, so no bucket is much larger than the others."""
    counted = relation.filter("base is not null").select("block", "base", "counts", *arrays, *[c for c in key if c == "lang"])
    total = counted.agg(F.sum(F.size("counts"))).first()[0] or 0
    types = "lang string, word string" if "lang" in key else "first long, last long"
    dealt = counted.mapInArrow(
        _dealt(arrays, total // BUCKET_PHRASES + 1), "bucket long, lang string, numbers binary, words binary"
    )
    return dealt.groupBy("bucket").applyInArrow(_counted(key, least), f"phrase long, f long, {types}, block long, found binary")


def frequent_phrases(docs: DataFrame, least: int = 30) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and the phrases of 1 to 4 words that occur `least` times
    in pieces of a language's texts: phrase (a number), f, and lang, word for single words, or
    the numbers `first` and `last` of the first and the last words but one.

    Upper-case A-Z are lowered. A null lang is `und`, a null text empty; rows are counted as they
    come, so null and repeated ids and repeated rows need no care. A language without words is
    absent from n. Other columns are not read. An empty table gives empty results.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    spark = docs.sparkSession
    path = staging_path(spark, "setm-words")
    relation = stage_at(texts.mapInArrow(_block_rows, _BLOCK), path)
    words = relation.filter("base is not null").select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "setm-totals")

    key, arrays, found = ["lang", "word"], ["words"], []
    for length in range(1, LONGEST + 1):
        rows = stage(_frequent(relation, key, arrays, least), f"setm-frequent-{length}")
        found.append(rows.filter("phrase is not null").select("phrase", "f", *key))
        if length == LONGEST:
            discard(spark, path)
            return totals, found
        occurrences = relation.filter("ids is not null").select("block", "ids", "starts").groupBy("block")
        frequent = rows.filter("block is not null").select("block", "found").groupBy("block")
        read, path = path, staging_path(spark, f"setm-relation-{length + 1}")
        relation = stage_at(occurrences.cogroup(frequent).applyInArrow(_longer, _RELATION), path)
        # A relation is deleted once the next one is complete.
        discard(spark, read)
        key, arrays = ["first", "last"], ["firsts", "lasts"]


def _described(phrases: list[DataFrame]) -> list[DataFrame]:
    """For phrases of 2 and more words: phrase, f, lang, words, and in arrays how often their first
    1, 2, ... words and their last 1, 2, ... words occur."""
    none = F.array().cast("array<long>")
    known = phrases[0].select(
        "phrase", "f", "lang", F.col("word").alias("words"), F.col("word").alias("end"), none.alias("heads"), none.alias("tails")
    )
    found = []
    for longer in phrases[1:]:
        a, b = known.alias("a"), known.alias("b")
        known = (
            longer.alias("x")
            .join(a, F.col("x.first") == F.col("a.phrase"))
            .join(b, F.col("x.last") == F.col("b.phrase"))
            .select(
                "x.phrase",
                "x.f",
                "a.lang",
                F.concat_ws(" ", "a.words", "b.end").alias("words"),
                "b.end",
                F.concat("a.heads", F.array("a.f")).alias("heads"),
                F.concat("b.tails", F.array("b.f")).alias("tails"),
            )
        )
        known = stage(known, "setm-described")
        found.append(known)
    return found


def mine_collocations(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """The `top` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to 4 words. a is how often a phrase occurs, l and r how often the two parts of its
    worst cut do, score floor(2000000 a / (l + r)) there; of equal cuts the first counts. A phrase
    inside a longer one that occurs at least 0.8 times as often is left out. Ranked by
    score, then a, both descending, then phrase. For nulls and empty tables see `frequent_phrases`.
    """
    totals, phrases = frequent_phrases(docs, least)
    candidates = []
    for length, rows in enumerate(_described(phrases), 2):
        if length < LONGEST:
            # Whatever holds a phrase holds one word more; that one occurs at least as often.
            longer = phrases[length]
            inside = longer.select(F.col("first").alias("phrase"), F.col("f").alias("outer")).unionByName(
                longer.select(F.col("last").alias("phrase"), F.col("f").alias("outer"))
            )
            outer = inside.groupBy("phrase").agg(F.max("outer").alias("outer"))
            rows = rows.join(outer, "phrase", "left").filter(
                F.coalesce(100 * F.col("outer").cast("decimal(20)") < 80 * F.col("f").cast("decimal(20)"), F.lit(True))
            )
        # Decimals, as the product of a count may pass 64 bits; div gives a long.
        cuts = F.expr(
            f"""transform(sequence(1, {length - 1}), k -> named_struct(
                'score', (cast(f AS decimal(20)) * 2000000)
                    div (cast(heads[k - 1] AS decimal(20)) + cast(tails[{length - 1} - k] AS decimal(20))),
                'k', k, 'l', heads[k - 1], 'r', tails[{length - 1} - k]))"""
        )
        candidates.append(rows.select("lang", F.col("words").alias("phrase"), F.col("f").alias("a"), F.array_min(cuts).alias("cut")))
    ranking = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = candidates[0].unionByName(candidates[1]).unionByName(candidates[2]).select("lang", "phrase", "a", "cut.*")
    ranked = scored.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
