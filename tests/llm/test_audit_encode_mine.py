"""The filter audit, the piece encoding and the collocations against brute-force versions, on
small tables with nulls, repeats, ties, long texts, no rows and columns of clashing names."""

import hashlib
import pathlib
import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from pyspark.sql import functions as F

from candlekit.llm import collocations as C
from candlekit.llm import filter_audit as A
from candlekit.llm import piece_encoding as P
from candlekit.llm import queries
from candlekit.session import staging_path

MODEL = f"{queries.TOKENIZERS}/{queries.PIECE_MODEL}"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- filter audit -------------------------------------------------------

LONG = " ".join(f"word{i}" for i in range(250))
DOCS = "doc_id BIGINT, text STRING, source STRING, part STRING, failed INT, rows STRING, good STRING"
AUDITED = [
    (1, LONG, "a"),
    (2, LONG, "b"),
    (3, LONG + " #", "a"),
    (4, "SHOUTING", "a"),
    (4, "SHOUTING", "a"),
    (5, "SHOUTING", None),
    (6, None, ""),
    (7, "", "b"),
    (8, "the the the the", "a"),
    (8, LONG, "b"),
    (None, LONG, "c"),
    (None, None, "c"),
    (None, "only here", "c"),
    (9, "é" * 49 + "A", "c"),
    (10, "é" * 48 + "AB", "c"),
    (11, " ".join(["x"] * 400), "c"),
    (12, "a b 50%", "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (4, 0, 1), (4, 1, None), (8, None, 1), (None, 1, 1), (12, 1, 0), (99, 1, 1)]


def failed(row):
    number, text, _ = row
    body = text or ""
    words = WORD.findall(body)
    earlier = [n for n, other, _ in AUDITED if (other or "") == body and n is not None]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", body)) > 2 * len(body),
        "D": bool(re.search("[#$%&*|]", body)),
        "E": any(number is None or n < number for n in earlier),
    }


def audited():
    """Every order applied to the rows, one filter after the other."""
    quality = {n for n, q, _ in LABELS if q == 1 and n is not None}
    toxic = {n for n, _, t in LABELS if t == 1 and n is not None}
    found = {}
    for part in {row[2] or "" for row in AUDITED}:
        rows = [(row[0], failed(row)) for row in AUDITED if (row[2] or "") == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if row[1][letter]]
                left = [row for row in left if not row[1][letter]]
                total[letter] += len(gone)
                found[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(fails[letter] for _, fails in rows) - len(gone),
                    sum(fails[letter] and sum(fails.values()) == 1 for _, fails in rows),
                    sum(number in quality for number, _ in gone),
                    sum(number in toxic for number, _ in gone),
                ]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(total[order[step - 1]])
    return found


@pytest.fixture(scope="module")
def audit_docs(spark):
    return spark.createDataFrame([(*row, "x", 3, "x", "x") for row in AUDITED], DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id BIGINT, quality INT, toxic INT").withColumn("part", F.lit("x"))


def test_audit_is_every_order_applied(audit_docs, labels):
    rows = A.audit_filters(audit_docs, labels).collect()
    found = {tuple(row[:3]): list(row[3:]) for row in rows}
    assert len(found) == len(rows)
    assert found == audited()


def test_audit_of_empty_tables(spark, audit_docs, labels):
    assert A.audit_filters(audit_docs.limit(0), labels).count() == 0
    unlabelled = A.audit_filters(audit_docs, labels.limit(0))
    assert unlabelled.count() == 600 * 4
    assert unlabelled.filter("good_lost + toxic_lost != 0").count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 5])
def test_weights_give_the_shapley_value(count):
    generator = random.Random(count)
    values = [0] + [generator.randrange(100) for _ in range((1 << count) - 1)]
    gains = [Fraction(0)] * count
    orders = list(permutations(range(count)))
    for order in orders:
        inside = 0
        for player in order:
            gains[player] += values[inside | 1 << player] - values[inside]
            inside |= 1 << player
    weights = A.shapley_weights(count)
    assert [sum(w * v for w, v in zip(row, values)) for row in weights] == [gain / len(orders) for gain in gains]


def test_audit_takes_other_filters(spark):
    counts = spark.createDataFrame([("", 0, 5, 1, 0), ("", 3, 2, 1, 1)], "part STRING, failed INT, documents LONG, good LONG, toxic LONG")
    rows = A.audit_steps(A.coalition_removals(counts, 2), "XY").orderBy("filter_order", "step").collect()
    assert [tuple(row)[1:] for row in rows] == [
        ("XY", 1, 5, 2, 0, 0, 1, 1, 2),
        ("XY", 2, 5, 0, 2, 0, 0, 0, 2),
        ("YX", 1, 5, 2, 0, 0, 1, 1, 2),
        ("YX", 2, 5, 0, 2, 0, 0, 0, 2),
    ]
    with pytest.raises(ValueError):
        A.audit_steps(counts, "XX")


# --- piece encoding -----------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return P.read_model(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def awkward_texts():
    yield from ["", " ", "  two  spaces ", "▁ mark", "<s> </s> <unk> <0x0A>", "\x00\t\n\r", "日本語 🦜 ñandú", "é"]
    yield from ["a" * 5000, "ab" * 3000, " " * 3000, "=-" * 2000, "word " * 3000]
    generator = random.Random(12)
    for _ in range(300):
        yield "".join(generator.choice("ab \n.é日") for _ in range(generator.randrange(60)))
        yield "".join(chr(generator.randrange(1, 0x3000)) for _ in range(generator.randrange(40)))


def test_encoder_equals_the_library(model, library):
    encoder = P.PieceEncoder(model)
    generator = random.Random(13)
    pieces = sorted(encoder.ids)
    mixtures = ["".join(generator.choice(pieces) for _ in range(generator.randrange(20))) for _ in range(2000)]
    for text in [*awkward_texts(), *mixtures]:
        assert encoder.encode(text) == library.encode(text), text


def test_encoder_forgets_without_changing_results(model, library, monkeypatch):
    monkeypatch.setattr(P, "KNOWN_WORDS", 3)
    monkeypatch.setattr(P, "KNOWN_PAIRS", 3)
    encoder = P.PieceEncoder(model)
    for text in ["one two three four one two", "thirty-three trees", "one two three"]:
        assert encoder.encode(text) == library.encode(text)


def test_backtracking_goes_back_where_it_has_to(model):
    encoder = P.PieceEncoder(model)
    # The longest piece first is not what merging gives.
    words = [word for word in encoder.ids if len(word) > 3][:4000]
    greedy = [word for a, b in zip(words, words[7:]) if len((word := a + b)) and encoder.backtrack(word)[0] != a]
    assert greedy


def test_texts_are_encoded_and_decoded(spark, model, library, monkeypatch):
    monkeypatch.setattr(P, "BATCH_SIZE", 2000)
    texts = [None, *awkward_texts()]
    schema = "doc_id BIGINT, text STRING, row STRING, piece STRING"
    docs = spark.createDataFrame([(i % 9 or None, text, "r", "p") for i, text in enumerate(texts)], schema)
    encoded = P.encode_texts(docs, model)
    assert encoded.columns == ["doc_id", "text", "row", "piece", "tokens"]
    rows = P.decode_tokens(encoded, model).collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        assert row["text"] == text and (row["row"], row["piece"]) == ("r", "p")
        assert row["tokens"] == library.encode(text or "")
        assert row["decoded"] == (library.decode(row["tokens"]) if text else "")
    assert P.decode_tokens(P.encode_texts(docs.limit(0), model), model).count() == 0
    other = P.encode_texts(docs.withColumn("tokens", F.lit("mine")), model, tokens="ids")
    assert {row["tokens"] for row in other.select("tokens").collect()} == {"mine"}


def test_models_that_encode_otherwise_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(MODEL, "rb") as file:
        original = file.read()
    for change in (
        lambda spec: setattr(spec.trainer_spec, "model_type", spec.trainer_spec.UNIGRAM),
        lambda spec: setattr(spec.trainer_spec, "byte_fallback", False),
        lambda spec: setattr(spec.normalizer_spec, "remove_extra_whitespaces", True),
        lambda spec: setattr(spec.pieces[500], "type", 4),
        lambda spec: setattr(spec.pieces[500], "piece", "a▁b"),
    ):
        spec = sentencepiece_model_pb2.ModelProto.FromString(original)
        change(spec)
        path = tmp_path / "model"
        path.write_bytes(spec.SerializeToString())
        with pytest.raises(ValueError):
            P.read_model(str(path))


def test_encoding_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.piece_encoding(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# --- collocations -------------------------------------------------------


def mined(rows, least, top):
    """lang, rank, phrase, a, l, r, n, score by counting all phrases of all pieces."""
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for phrase, a in candidates.items():
            inside = any(
                len(other) > len(phrase)
                and 100 * b >= 80 * a
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for other, b in candidates.items()
            )
            if not inside:
                cuts = [(2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def collocation_rows():
    generator = random.Random(14)
    vocabulary = ["the", "Of", "new", "york", "city", "été", "ß", " ", "a b", "x" * 50]
    rows = []
    for i in range(120):
        words = [generator.choice(vocabulary) for _ in range(generator.randrange(40))]
        joints = [generator.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for _ in words]
        text = "".join(word + joint for word, joint in zip(words, joints))
        rows.append((i % 50 or None, text + " New York city new york", generator.choice(["en", "fr", None]), "w", 1))
    rows += [(3, None, "en", "w", 1), (3, "", "es", "w", 1), (4, "...", "und", "w", 1), (4, "...", "und", "w", 1)]
    # A long text in one piece, and ties in score and count.
    rows.append((5, " ".join(generator.choice(["p", "q", "r"]) for _ in range(3000)), "en", "w", 1))
    rows += [(6, "tie one. tie two. tie three", "fr", "w", 1)] * 8
    return rows


@pytest.fixture(scope="module")
def texts(spark):
    schema = "doc_id BIGINT, text STRING, lang STRING, word STRING, block INT"
    return spark.createDataFrame(collocation_rows(), schema).repartition(3)


def collected(df):
    return sorted(tuple(row) for row in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations(texts):
    assert collected(C.mine_collocations(texts, 6, 2000)) == mined(collocation_rows(), 6, 2000)
    assert collected(C.mine_collocations(texts, 6, 5)) == mined(collocation_rows(), 6, 5)


def test_blocks_and_slices_do_not_change_collocations(texts):
    expected = mined(collocation_rows(), 6, 2000)
    for block, piece in ((1, 1), (64, 20), (5000, 100)):
        assert collected(_with_limits(texts, block, piece)) == expected


def test_relations_are_deleted(spark, texts):
    folder = pathlib.Path(staging_path(spark, "x").removeprefix("file:")).parent
    before = set(folder.glob("setm-*"))
    C.mine_collocations(texts, 6, 5)
    left = {path.name[:9] for path in set(folder.glob("setm-*")) - before}
    assert left == {"setm-tota", "setm-freq", "setm-desc"}


def test_buckets_do_not_change_collocations(texts, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_PHRASES", 7)
    assert collected(C.mine_collocations(texts, 6, 2000)) == mined(collocation_rows(), 6, 2000)


def test_numbers_and_phrases_are_packed_and_dealt_whole(monkeypatch):
    generator = np.random.default_rng(3)
    columns = [generator.integers(-(2**62), 2**62, 50), np.arange(50), np.zeros(50, np.int64)]
    assert np.array_equal(C._unpacked(C._packed(columns), 3), np.stack(columns))
    small = np.array([0, 1, 2**31 - 1], np.int32)
    assert np.array_equal(C._unpacked(C._packed([small]), 1, np.int32)[0], small)
    monkeypatch.setattr(C, "DEAL_PHRASES", 5)
    firsts = generator.integers(0, 9, 64)
    lists = {"firsts": firsts.reshape(8, 8), "lasts": firsts.reshape(8, 8) + 1}
    lists["counts"] = np.full((8, 8), 2)
    batch = pa.RecordBatch.from_pydict(
        {"block": list(range(8)), "base": pa.array([0] * 8, pa.int32()), **{k: [list(x) for x in v] for k, v in lists.items()}}
    )
    dealt = pa.Table.from_batches(list(C._dealt(["firsts", "lasts"], 3)([batch])))
    found, places = {}, {}
    for bucket in set(dealt.column("bucket").to_pylist()):
        rows = C._counted(["first", "last"], 2)(dealt.filter(pc.equal(dealt.column("bucket"), bucket))).to_pylist()
        for row in rows:
            if row["phrase"] is None:
                local, phrases = C._unpacked(row["found"], 2)
                for number, phrase in zip(np.cumsum(local), phrases):
                    places.setdefault(int(phrase), []).append((row["block"] << C.LOCAL_BITS) + int(number))
            else:
                assert row["block"] is None and row["last"] == row["first"] + 1 and row["first"] not in found
                found[row["first"]] = row["phrase"], row["f"]
    assert set(found) == set(firsts.tolist()) and len(places) == len(found)
    for first, (phrase, f) in found.items():
        at = np.flatnonzero(firsts == first)
        assert sorted(places[phrase]) == [(int(i) // 8 << C.LOCAL_BITS) + int(i) % 8 for i in at]
        assert (f, phrase) == (2 * len(at), min(places[phrase]))


def _with_limits(docs, block, piece):
    """The operator with other sizes of blocks and slices, which the tasks read from the module."""
    original = C._block_rows

    def limited(batches):
        from candlekit.llm import collocations

        before = collocations.BLOCK_BYTES, collocations.SLICE_BYTES
        collocations.BLOCK_BYTES, collocations.SLICE_BYTES = block, piece
        try:
            yield from original(batches)
        finally:
            collocations.BLOCK_BYTES, collocations.SLICE_BYTES = before

    C._block_rows = limited
    try:
        return C.mine_collocations(docs, 6, 2000)
    finally:
        C._block_rows = original


def test_tokens_are_the_same_for_all_slices(monkeypatch):
    text = "One,two\tthree " + "y" * 200 + " four;FIVE é\x0bsix  " * 20
    whole = [token for part in C._tokens(text.encode()) for token in part]
    for size in (1, 7, 64):
        monkeypatch.setattr(C, "SLICE_BYTES", size)
        parts = list(C._tokens(text.encode()))
        assert [token for part in parts for token in part] == whole
        assert all(len(part) >= 3 for part in parts[:-1])


def test_collocations_of_an_empty_table(texts):
    assert C.mine_collocations(texts.limit(0)).count() == 0
    assert C.mine_collocations(texts.filter("text is null")).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    huge = 2**61
    phrases = [
        spark.createDataFrame([(1, huge, "en", "a"), (2, huge + 1, "en", "b")], "phrase LONG, f LONG, lang STRING, word STRING"),
        spark.createDataFrame([(3, huge, 1, 2)], "phrase LONG, f LONG, first LONG, last LONG"),
        *[spark.createDataFrame([], "phrase LONG, f LONG, first LONG, last LONG")] * 2,
    ]
    totals = spark.createDataFrame([("en", 2 * huge)], "lang STRING, n LONG")
    monkeypatch.setattr(C, "frequent_phrases", lambda docs, least: (totals, phrases))
    assert collected(C.mine_collocations(None)) == [("en", 1, "a b", huge, huge, huge + 1, 2 * huge, 999999)]
