"""Language identification by bit-sliced Bloom filters over n-grams.

Training takes, for every language, the n-grams that are more frequent in it than
on average over all languages. All languages share one Bloom filter whose cells
are bit masks, a bit per language: adding an n-gram sets the language's bit in
its cells, and the AND of an n-gram's cells gives all languages that contain it.
A text is judged by the number of its n-grams per language (the popcount of each
bit), less what the filter's false positives alone would give.

N-grams are `GRAM` bytes of UTF-8 text with A-Z in lower case, in which every run
of bytes other than letters counts as one space; n-grams with a space inside
(not at an end) are left out, so they lie within a word or touch its border.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlekit.llm.textbytes import Chunk, chunks, mix

GRAM = 4
HASHES = 3
#: Different training texts per language (about), n-grams kept per language, cells per n-gram kept.
SAMPLE_ROWS = 4000
PROFILE = 1 << 14
CELLS_PER_GRAM = 16
#: Relative error of the number of different texts of a language; the rate of the sample
#: allows for three times that, so that a language with fewer texts is used whole.
TEXTS_ERROR = 0.02
UNKNOWN = "und"
#: Largest filter that is sent to the executors; with many languages it has fewer cells, so each
#: language has more false positives, which the scores allow for.
MODEL_BYTES = 64 << 20


def grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text and code of every n-gram of the chunk."""
    data = chunk.data
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    letter = ((lower >= 97) & (lower <= 122)) | (lower >= 128)
    # Every text begins with a space of its own, which also ends the text before.
    rows = chunk.rows
    whole = np.zeros(len(data) + rows + 1, np.uint8)
    places = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(chunk.bounds)) + 1
    whole[:] = 32
    whole[places] = np.where(letter, lower, 32)
    keep = np.ones(len(whole), bool)
    keep[1:] = (whole[1:] != 32) | (whole[:-1] != 32)
    starts = chunk.bounds[:-1] + np.arange(rows)
    keep[starts] = True
    text = whole[keep]
    text_starts = np.cumsum(keep)[starts] - 1
    if len(text) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = len(text) - GRAM + 1
    code = np.zeros(size, np.uint64)
    inner = np.ones(size, bool)
    for i in range(GRAM):
        part = text[i : i + size]
        code = (code << np.uint64(8)) | part
        if 0 < i < GRAM - 1:
            inner &= part != 32
    row = np.searchsorted(text_starts, np.flatnonzero(inner), "right") - 1
    return row, code[inner]


@dataclass
class LanguageModel:
    """`masks[cell]` holds the languages as bits, 64 to a word; `fill` is the rate of
    false positives of each language."""

    languages: list[str]
    prior: list[int]
    masks: np.ndarray
    fill: np.ndarray

    def cells(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        size = np.uint64(len(self.masks))
        for seed in range(HASHES):
            yield (mix(codes ^ np.uint64(0x51ED270B * (seed + 1))) % size).astype(np.int64)

    def scores(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and its corrected share per language."""
        row, codes = grams(chunk)
        total = np.bincount(row, minlength=chunk.rows)
        shares = np.zeros((chunk.rows, len(self.languages)))
        cells = list(self.cells(codes))
        for i in range(len(self.languages)):
            if i % 64 == 0:
                # One word of the masks at a time, however many languages there are.
                found = np.bitwise_and.reduce([self.masks[cell, i // 64] for cell in cells])
            bit = (found >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(row, weights=bit, minlength=chunk.rows)
            by_chance = self.fill[i] * total
            shares[:, i] = (hits - by_chance) / np.maximum(total - by_chance, 1e-9)
        return total, np.clip(shares, 0.0, 1.0)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) with one row per language and n-gram of a batch's chunk."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for chunk in chunks(batch.column("text")):
            row, codes = grams(chunk)
            names, index = np.unique(langs[chunk.first : chunk.first + chunk.rows].astype(str), return_inverse=True)
            key = (index[row].astype(np.uint64) << np.uint64(8 * GRAM)) | codes
            keys, counts = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(names[(keys >> np.uint64(8 * GRAM)).astype(int)], pa.string()),
                    "gram": pa.array((keys & np.uint64((1 << 8 * GRAM) - 1)).astype(np.int64)),
                    "n": pa.array(counts.astype(np.int64)),
                }
            )


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, profile: int = PROFILE) -> LanguageModel:
    """Model of the languages of `docs` (text, lang); null texts and langs are left out.

    Of each language about `sample_rows` different texts are used, whole: those with
    the smallest hash, all if there are fewer. What reaches the driver is
    `profile` n-grams per language at most.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts = F.approx_count_distinct("text", TEXTS_ERROR)
    sizes = sorted(tuple(row) for row in known.groupBy("lang").agg(F.count("*"), texts).collect())
    languages = [(name, count) for name, count, _ in sizes]
    if not languages:
        return LanguageModel([], [], np.zeros((1, 1), np.uint64), np.zeros(0))
    width = -(-len(languages) // 64)
    cells = min(CELLS_PER_GRAM * profile * len(languages), MODEL_BYTES // (8 * width))
    # Texts are drawn by their hash, at a rate that gives about `sample_rows` different ones.
    least = {name: max(1, int(found * (1 - 3 * TEXTS_ERROR))) for name, _, found in sizes}
    limits = {name: min(1 << 30, (sample_rows << 30) // found) for name, found in least.items()}
    limit = F.coalesce(*[F.when(F.col("lang") == name, F.lit(most)) for name, most in limits.items()])
    # A text counts once, however often it is copied.
    drawn = known.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < limit).select("lang", "text").distinct()
    counts = drawn.mapInArrow(_count_grams, "lang STRING, gram BIGINT, n BIGINT").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    of_gram = Window.partitionBy("gram")
    typical = (
        counts.withColumn("share", share)
        .withColumn("mean", F.sum("share").over(of_gram) / len(languages))
        .filter((F.col("n") > 2) & ((F.col("share") > F.col("mean")) | F.lit(len(languages) == 1)))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("share"), "gram")
    rows = typical.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= profile)
    chosen = rows.select("lang", "gram").toPandas()

    names = [name for name, _ in languages]
    model = LanguageModel(names, [n for _, n in languages], np.zeros((cells, width), np.uint64), np.zeros(len(names)))
    for i, name in enumerate(names):
        codes = chosen.loc[chosen["lang"] == name, "gram"].to_numpy(np.uint64)
        word, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
        for cell in model.cells(codes):
            model.masks[cell, word] |= bit
        model.fill[i] = np.mean((model.masks[:, word] & bit) != 0) ** HASHES
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with lang_pred and score (0 to 1): the corrected share of the text's
    n-grams that the predicted language contains.

    The prediction is `und`, with score 0, for a text that is null or has no letter,
    and for all texts if the model has no language. Equal scores go to the language
    with more training rows, then to the smaller name; that also decides texts too
    short for an n-gram. Texts are read whole; other columns are carried along, and
    columns of the result's names are replaced.
    """
    # Its size was checked in training: MODEL_BYTES at most.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [field for field in docs.schema.fields if field.name not in ("lang_pred", "score")]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kept = docs.select(*[F.col(f"`{field.name}`") for field in carried], letters.alias("score"))
    at = next(i for i, field in enumerate(carried) if field.name == "text")
    schema = kept.select(*[F.col(f"`{field.name}`") for field in carried], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        # Later entries lose ties: by training rows, then by name.
        order = sorted(range(len(model.languages)), key=lambda i: (-model.prior[i], model.languages[i]))
        names = np.array([model.languages[i] for i in order] + [UNKNOWN], dtype=object)
        for batch in batches:
            valid = batch.column(len(carried)).to_numpy(zero_copy_only=False).astype(bool)
            best = np.full(batch.num_rows, len(names) - 1)
            score = np.zeros(batch.num_rows)
            if order:
                for chunk in chunks(batch.column(at)):
                    _, shares = model.scores(chunk)
                    shares = shares[:, order]
                    part = slice(chunk.first, chunk.first + chunk.rows)
                    best[part] = np.argmax(shares, axis=1)
                    score[part] = shares.max(axis=1)
                best[~valid] = len(names) - 1
                score[~valid] = 0.0
            columns = [batch.column(i) for i in range(len(carried))]
            columns += [pa.array(names[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in schema.fields])

    return kept.mapInArrow(judge, schema)
