"""Every operator against a brute-force version on a small corpus with the awkward cases:
null and empty texts, null and repeated doc_ids, repeated rows, copies, a long text and
extra columns with the names that the operators use inside."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlekit.llm import bloom_cascade as B
from candlekit.llm import components as C
from candlekit.llm import jaccard_join as J
from candlekit.llm import merkle_fixity as M
from candlekit.llm import queries
from candlekit.llm import suffix_dedup as S
from candlekit.llm.bounded_ring import even_capacities, ring_points, shard_rows, walk
from candlekit.llm.components import components
from candlekit.llm.containment_search import _blocks, contained_items, without_contained
from candlekit.llm.curriculum_mix import mix_sources, training_order
from candlekit.llm.exact_dedup import exact_dedup
from candlekit.llm.jaccard_join import _wide_sketches as wide_sketches
from candlekit.llm.jaccard_join import jaccard_components, linked_sets, row_mark
from candlekit.llm.language_masks import identify, train
from candlekit.llm.window_dedup import without_repeated_windows
from candlekit.session import stage

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, _key STRING, row STRING"


def phrase(seed, length):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(length))


BASE, SHARED = phrase(1, 120), phrase(2, 60)
TEXTS = [
    (0, BASE, "x", "a"),
    (1, BASE, "x", "a"),
    (2, BASE.replace(" ", "  ", 3) + " tail", "x", "b"),
    (3, " ".join(w if i != 60 else "Other" for i, w in enumerate(BASE.split())), "x", "b"),
    (4, phrase(3, 50) + " " + SHARED + " " + phrase(4, 50), "x", None),
    (5, phrase(5, 70) + "\n" + SHARED + "\t" + phrase(6, 30), "y", "c"),
    (6, None, "y", "c"),
    (7, "", None, "c"),
    (8, "three short words", "y", "a"),
    (9, "Three  short words", "y", "a"),
    (10, " \t\n ", "y", "a"),
    (11, "é" * 500 + " " + "ab" * 400, "z", "d"),
    (12, phrase(7, 4000) + " " + SHARED, "z", "d"),
    (None, phrase(8, 40), "z", "d"),
    (None, None, "z", "d"),
    (13, "0123 456 !!", "z", "d"),
    (13, "0123 456 !!", "z", "d"),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(*row, "extra", "extra") for row in TEXTS]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = words(lower)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_exact(docs, none):
    for digest in ({}, {"digest": lambda c: F.substring(F.sha2(c, 256), 1, 1)}):
        found = exact_dedup(docs, **digest).collect()
        assert len(found) == len(TEXTS)
        sizes = Counter(text or "" for _, text, *_ in TEXTS)
        assert sum(row["kept"] for row in found) == len(sizes)
        assert Counter(row["group_size"] for row in found) == Counter(sizes[text or ""] for _, text, *_ in TEXTS)
    by_id = {row["doc_id"]: row["keep_id"] for row in found}
    assert (by_id[0], by_id[1], by_id[6], by_id[7]) == (1, 1, 7, 7)
    assert exact_dedup(none).count() == 0


def test_ring(docs, none, spark):
    many = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("shard"))
    for table in (docs, many):
        for shards in (1, 3, 8):
            rows = shard_rows(table, shards).select("shard", "slot").collect()
            assert len(rows) == table.count()
            counts = Counter(row["shard"] for row in rows)
            assert max(counts.values()) - min(counts.get(i, 0) for i in range(shards)) <= 1
            assert {(row["shard"], row["slot"]) for row in rows} == {(s, i) for s in counts for i in range(counts[s])}
    old = dict(shard_rows(many, 8).select("doc_id", "shard").collect())
    new = dict(shard_rows(many, 9).select("doc_id", "shard").collect())
    assert sum(old[i] != new[i] for i in old) < 0.25 * len(old)
    assert shard_rows(none).count() == 0


def test_ring_walk_is_the_sequential_one():
    owners = [owner for _, owner in ring_points(4, 8)]
    counts = [(i * 7) % 5 for i in range(len(owners))]
    room = even_capacities(sum(counts), 4)
    expected, used = [], [0] * 4
    for arc, count in enumerate(counts):
        for rank in range(count):
            at = arc
            while used[owners[at % len(owners)]] == room[owners[at % len(owners)]]:
                at += 1
            shard = owners[at % len(owners)]
            expected.append((arc, rank, shard, used[shard]))
            used[shard] += 1
    segments = walk(owners, counts, room)
    assert [(a, r, s, slot + r - x) for a, x, y, s, slot in segments for r in range(x, y)] == expected


def targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, goal, open_sources = 1.5 * sum(sizes.values()), {}, set(order)
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if level * weight[s] > 2 * sizes[s]}
        for s in full or open_sources:
            goal[s] = 2.0 * sizes[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(goal[s] for s in full)
        open_sources -= full
    return goal


def test_mix(docs, none):
    rows = mix_sources(docs).collect()
    sizes = Counter()
    for _, text, _, source, in TEXTS:
        sizes[source] += len(words(text))
    goal = targets(sizes)
    taken = Counter()
    for row in rows:
        assert row["size"] == len(words(row["text"])) and row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(goal[row["source"]])
        assert 0 <= row["taken"] <= 2 * row["size"]
        assert all(0 < t <= 1 for t in row["positions"])
        taken[row["source"]] += row["taken"]
    assert len(rows) == len(TEXTS) and all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    again = {(row["doc_id"], row["text"]): row["taken"] for row in mix_sources(docs.repartition(5)).collect()}
    assert again == {(row["doc_id"], row["text"]): row["taken"] for row in rows}
    times = [row["position"] for row in training_order(mix_sources(docs)).collect()]
    assert times == sorted(times) and len(times) >= len(rows) - 6
    assert mix_sources(none).count() == 0


def test_mix_query_is_range_sorted(spark):
    firsts = [min(row["positions"], default=2) for row in queries.curriculum_mix(spark, FOLDER).select("positions").collect()]
    assert firsts == sorted(firsts) and len(set(firsts)) > 100


@pytest.mark.parametrize("limit", [B.CASCADE_BYTES, 0])
def test_cascade(spark, limit):
    keys = [f"k{i}" for i in range(3000)]
    rows = spark.createDataFrame([(k,) for k in [*keys, *keys[:10], None, ""]], "key STRING")
    listed = spark.createDataFrame([(k,) for k in [*keys[::7], "elsewhere", keys[0], None]], "key STRING")
    found = B.with_membership(rows, listed, "key", limit=limit).collect()
    assert len(found) == 3012
    assert all(row["listed"] == (row["key"] in set(keys[::7])) for row in found)
    empty = spark.createDataFrame([], "key STRING")
    assert B.with_membership(rows, empty, "key", limit=limit).filter("listed").count() == 0
    assert B.with_membership(empty, listed, "key", limit=limit).count() == 0


def test_rules(spark):
    urls = [
        ("http://A.Example.org/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://x.org/", "x.org", "/", "org/", "allow"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", "com/de/", "block"),
        ("http://b.net/p?ref=x", "b.net", "/p", None, "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(u[0], "mine") for u in urls], "url STRING, _address STRING")
    listed = spark.createDataFrame([("b.net/p",)], "address STRING")
    rows = B.judge_urls(pages.drop("_address"), listed).select("url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, urls))


def test_fixity(spark):
    columns = "archive BIGINT, offset BIGINT, length BIGINT, digest STRING, record_id BIGINT"
    rows = [(i % 3, 1000 * i, 900, f"d{i}", i) for i in range(400)] + [(None, None, None, None, None)]
    changed = [(a, o, n, "bad" if i == 7 else d, i) for a, o, n, d, i in rows if i != 11] + [(0, 5, 1, "new", 999), rows[20]]
    left, right = spark.createDataFrame(rows, columns), spark.createDataFrame(changed, columns)
    found = {(r["record_id"], r["kind"]) for r in M.audit_replicas(left, right, 4096, 4).collect()}
    assert found == {(7, "altered"), (11, "missing"), (999, "extra"), (20, "altered")}
    assert M.audit_replicas(left, left, 4096, 4).count() == 0
    empty = spark.createDataFrame([], columns)
    assert M.audit_replicas(empty, empty).count() == 0
    assert M.audit_replicas(left, empty).count() == 401


def test_containment(spark, docs, none):
    items = [(1, SHARED), (2, phrase(99, 30)), (3, "three short words"), (4, None), (5, ""), (None, BASE), (6, BASE), (6, BASE)]
    benchmark = spark.createDataFrame([(*x, 0) for x in items], "item_id BIGINT, text STRING, doc_id INT")
    expected = set()
    for doc, text, *_ in TEXTS:
        for item, passage in items:
            wanted = shingles(passage)
            if item and wanted and 10 * len(wanted & shingles(text)) >= 8 * len(wanted):
                expected.add((doc, item, len(wanted & shingles(text)), len(wanted)))
    for block in (16 << 20, 200):
        assert {tuple(row) for row in contained_items(docs, benchmark, block_bytes=block).collect()} == expected
    kept = [row["doc_id"] for row in without_contained(docs, benchmark).collect()]
    assert sorted(map(str, kept)) == sorted(str(d) for d, *_ in TEXTS if d not in {e[0] for e in expected})
    assert contained_items(none, benchmark).count() == 0 and contained_items(docs, benchmark.limit(0)).count() == 0


def test_items_without_item_id_and_with_a_shared_one(spark):
    items = [(None, ITEM), *[(7, phrase(70 + i, 20)) for i in range(40)], (7, phrase(70, 20))]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows = [(1, phrase(50, 30) + " " + ITEM), (2, phrase(51, 30)), (None, phrase(52, 30)), (3, phrase(71, 20))]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert rows_of(without_contained(table, benchmark, block_bytes=1000)) == Counter(rows[1:3])
    blocks = [sum(len(text) + 64 for text in texts) for _, texts in _blocks(benchmark, 1000)]
    assert max(blocks) <= 2000 and len(blocks) >= 14
    assert [tuple(row)[:2] for row in contained_items(table, benchmark, block_bytes=1000).collect()] == [(3, 7)]


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (50, 7)]
    found = dict(components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect())
    assert found == {**{i: 0 for i in range(21)}, 50: 0, 30: 30, 31: 30}


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(C, "stage", lambda df, label: written.append(label) or stage(df, label))
    links = [(i, 0) for i in range(1, 6)] + [(8, 7), (7, 8), (9, 9)]
    found = dict(components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect())
    assert found == {**{i: 0 for i in range(6)}, 7: 7, 8: 7}
    assert written == ["links"]


def jaccard_roots(sets):
    root = {doc: doc for doc in sets}
    for _ in sets:
        before = dict(root)
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def test_jaccard(docs, none):
    sets = {doc: shingles(text) for doc, text, *_ in TEXTS if doc is not None}
    root = jaccard_roots(sets)
    rows = jaccard_components(docs).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        if row["doc_id"] is not None:
            assert (row["n_shingles"], row["component_id"]) == (len(sets[row["doc_id"]]), root[row["doc_id"]])
    assert jaccard_components(none).count() == 0


def edited(text, seed, edits):
    found = text.split()
    rng = np.random.default_rng(seed)
    for place in rng.choice(len(found), edits, replace=False):
        found[place] = f"new{seed}x{place}"
    return " ".join(found)


@pytest.mark.parametrize("length, edits, copies", [(120, (0, 5), 70), (2060, (8, 60), 14), (1030, (4, 30), 14)])
def test_jaccard_near_the_threshold(spark, length, edits, copies):
    """Copies just above and just below the threshold: with frequent shingles, and with sets
    of different sketch widths."""
    base = phrase(20, length)
    texts = {i: edited(base, i, int(np.linspace(*edits, copies)[i])) for i in range(copies)}
    texts |= {copies + i: " ".join(edited(base, 500 + i, edits[1]).split()[: length * (9 - i) // 9]) for i in range(3)}
    sets = {doc: shingles(text) for doc, text in texts.items()}
    root = jaccard_roots(sets)
    assert 1 < len(set(root.values())) < len(root)
    found = jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == root


def test_jaccard_tells_texts_of_one_doc_id_apart(spark):
    """Two texts under doc_id 1, each the smallest of its class and linked with others."""
    first, second = phrase(30, 120), phrase(31, 120)
    texts = [(1, first), (1, second), (2, edited(first, 1, 2)), (3, edited(second, 2, 2)), (4, second), (5, phrase(32, 60))]
    texts += [(1, phrase(33, 60)), (6, phrase(34, 60)), (6, edited(phrase(32, 60), 3, 1)), (None, first)]
    root = jaccard_roots({i: shingles(text) for i, (_, text) in enumerate(texts)})
    named = [(i, doc) for i, (doc, _) in enumerate(texts) if doc]
    expected = Counter()
    for i, (doc, text) in enumerate(texts):
        same = min(d for j, d in named if shingles(texts[j][1]) == shingles(text))
        expected[doc, len(shingles(text)), min(d for j, d in named if root[j] == root[i]), same] += 1
    rows = linked_sets(spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(3))
    rows = rows.select("doc_id", "n_shingles", "component_id", "class_id", "component").collect()
    assert Counter(tuple(row)[:4] for row in rows) == expected
    assert len({row["component"] for row in rows}) == len(set(root.values()))
    found = jaccard_components(spark.createDataFrame(texts, "doc_id BIGINT, text STRING")).collect()
    assert Counter(map(tuple, found)) == expected


def test_jaccard_links_through_a_row_without_doc_id(spark):
    """The row in the middle has no doc_id; the ends link with it only."""
    base = phrase(35, 120)
    near, far = edited(base, 1, 2), edited(edited(base, 1, 2), 2, 2)
    sets = {i: shingles(text) for i, text in enumerate((base, near, far))}
    assert set(jaccard_roots(sets).values()) == {0} and set(jaccard_roots({0: sets[0], 2: sets[2]}).values()) == {0, 2}
    texts = [(5, base), (None, near), (7, far), (None, phrase(36, 60))]
    rows = jaccard_components(spark.createDataFrame(texts, "doc_id BIGINT, text STRING")).collect()
    found = Counter((row["doc_id"], row["component_id"], row["class_id"]) for row in rows)
    assert found == Counter([(5, 5, 5), (None, 5, None), (7, 5, 7), (None, None, None)])


def test_wide_sketches_fold_and_bound_the_difference():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    own = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    sets = [shared, np.concatenate([shared, own]), own]
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    plain, larger, none = (np.array(x, np.int64) for x in wide_sketches(first, np.concatenate(sets)).to_pylist())
    assert (len(plain), len(larger), len(none)) == (2048 // 64, 4096 // 64, 0)
    apart = plain ^ larger[: len(plain)] ^ larger[len(plain) :]
    assert 350 < sum(int(x).bit_count() for x in apart.view(np.uint64)) <= len(own)


@pytest.mark.parametrize("sketch_bytes", [64 << 20, 0])
def test_windows(docs, none, sketch_bytes):
    seen, expected = set(), {}
    for doc, text in sorted({(d if d is not None else -1, t or "") for d, t, *_ in TEXTS}):
        found = words(text)
        gone = set()
        for i in range(len(found) - 19):
            if tuple(found[i : i + 20]) in seen:
                gone |= set(range(i, i + 20))
            seen.add(tuple(found[i : i + 20]))
        expected[doc, len(found)] = (len(gone), " ".join(w for i, w in enumerate(found) if i not in gone))
    rows = without_repeated_windows(docs, sketch_bytes).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        doc = -1 if row["doc_id"] is None else row["doc_id"]
        assert (row["n_removed"], row["kept"]) == expected[doc, row["n_words"]]
    assert without_repeated_windows(none, sketch_bytes).count() == 0


@pytest.mark.parametrize("sketch_bytes, block_bytes", [(64 << 20, 4 << 20), (0, 1 << 10)])
def test_strings(docs, none, sketch_bytes, block_bytes):
    places = {(d if d is not None else -1, (t or "").encode()) for d, t, *_ in TEXTS}
    counts = Counter(t[i : i + 200] for _, t in places for i in range(len(t) - 199))
    expected = {}
    for doc, text in places:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - 199):
            if counts[text[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int(np.sum(gone[:-1] & ~np.append(False, gone[:-1])[:-1])) if text else 0
        expected[doc, len(text)] = (int(gone.sum()), spans, bytes(b for b, g in zip(text, gone) if not g))
    rows = S.without_repeated_strings(docs, sketch_bytes, block_bytes).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        doc = -1 if row["doc_id"] is None else row["doc_id"]
        assert (row["n_removed"], row["n_spans"], bytes(row["kept"])) == expected[doc, row["n_bytes"]]
    assert S.without_repeated_strings(none, sketch_bytes, block_bytes).count() == 0


def test_difference_cover():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


@pytest.mark.parametrize("seed", range(5))
def test_sorted_block(seed):
    rng = np.random.default_rng(seed)
    part = rng.integers(97, 99, 700).astype(np.uint8)
    text = np.concatenate([part, rng.integers(97, 123, 300).astype(np.uint8), part[100:500], np.full(260, 97, np.uint8)])
    starts = np.sort(rng.choice(len(text) - S.LENGTH + 1, 900, replace=False))
    strings = [text[i : i + S.LENGTH].tobytes() for i in starts]
    counts = Counter(strings)
    assert S.repeated_starts(text, starts).tolist() == [counts[x] > 1 for x in strings]


def test_open_lists_are_shuffled_once(spark):
    """Both sides of the last join of open lists read one exchange of their rows."""
    rows = [(key, 1, i, 10, 0, i % 3) for key in (2, 3) for i in range(8)]
    members = spark.createDataFrame(rows, "key BIGINT, band BIGINT, id BIGINT, size BIGINT, alone BIGINT, component BIGINT")
    about = spark.createDataFrame([(i, [0] * J.SKETCH_WORDS) for i in range(8)], "id BIGINT, sketch ARRAY<BIGINT>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = J._rest_of_lists(members, about)
        found = {tuple(row) for row in pairs.collect()}
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {(a, b) for a in range(8) for b in range(a + 1, 8) if a % 3 != b % 3}
    assert "ReusedExchange" in plan


def test_equal_rows_are_ranked_once(monkeypatch):
    rng = np.random.default_rng(0)
    distinct = [rng.integers(0, 4, 50).astype(np.uint64) for _ in range(4)]
    keys = [np.tile(key, 20) for key in distinct]
    ranked, sizes = S._ranked, []
    monkeypatch.setattr(S, "_ranked", lambda keys: sizes.append(len(keys[0])) or ranked(keys))
    rows = list(zip(*(key.tolist() for key in keys)))
    places = {row: i for i, row in enumerate(sorted(set(rows)))}
    assert S._prefix_ranks(keys).tolist() == [places[row] for row in rows]
    assert sizes == [len(places)]


def test_classes_with_the_same_sum():
    zero = np.uint64(0)
    # Two different rows, several times, with one sum.
    rows = np.array([(S.MARKS[1], zero, zero, zero), (zero, S.MARKS[0], zero, zero)] * 3, np.uint64)
    order, new = S._classes(list(rows.T))
    assert new.tolist() == [True, False, False] * 2
    assert [set(order[:3].tolist()), set(order[3:].tolist())] == [{1, 3, 5}, {0, 2, 4}]


@pytest.mark.parametrize("size", [0, 1, 5, 1000, 1 << 21])
def test_pairs(size):
    rng = np.random.default_rng(size)
    first, second = (rng.integers(0, size + 1, size) for _ in range(2))
    order, new = S._pairs(first, second)
    expected = np.lexsort([second, first])
    assert (first[order] == first[expected]).all() and (second[order] == second[expected]).all()
    assert new.sum() == len(np.unique(first * (size + 1) + second))


def test_language(spark, docs, none):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = train(documents.filter(part != 2))
    held = identify(documents.filter(part == 2), model)
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = identify(docs, model).collect()
    assert len(rows) == len(TEXTS) and "_key" in rows[0].asDict()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and 0 <= row["score"] <= 1
    empty = train(none)
    assert {row["lang_pred"] for row in identify(docs, empty).collect()} == {"und"}


def test_language_of_few_texts_with_many_copies(spark):
    """Rows are mostly copies; all different texts are used, as there are fewer than the sample."""
    rows = [(" ".join(f"{w}{lang}" for w in phrase(60 + i, 40).split()), lang) for lang in ("pqp", "xyx") for i in range(30)]
    copied = spark.createDataFrame([row for row in rows for _ in range(200 if row[1] == "pqp" else 1)], "text STRING, lang STRING")
    model = train(copied, sample_rows=40)
    whole = train(spark.createDataFrame(rows, "text STRING, lang STRING"), sample_rows=40)
    assert np.array_equal(model.masks, whole.masks) and model.fill.min() > 0
    found = identify(copied.distinct(), model).collect()
    assert len(found) == 60 and all(row["lang_pred"] == row["lang"] and row["score"] > 0.2 for row in found)


def test_two_hundred_languages(spark, monkeypatch):
    """More languages than bits in a word, also where the filter's bound leaves them few cells."""
    rows = [(" ".join(f"{w}{i:03d}".translate(str.maketrans("0123456789", "ghijklmnop")) for w in phrase(70 + i, 30).split()), f"l{i:03d}") for i in range(200)]
    docs = spark.createDataFrame([row for row in rows for _ in range(3)], "text STRING, lang STRING")
    roomy = train(docs, profile=256)
    monkeypatch.setattr("candlekit.llm.language_masks.MODEL_BYTES", 1 << 17)
    tight = train(docs, profile=256)
    assert roomy.masks.shape[1] == 4 and tight.masks.nbytes <= 1 << 17 < roomy.masks.nbytes
    for model in (roomy, tight):
        found = identify(docs.distinct(), model).collect()
        assert len(found) == 200 and np.mean([row["lang"] == row["lang_pred"] for row in found]) > 0.95


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = queries.QUERIES[name](spark, FOLDER)
    cursor = connection.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert sorted(map(repr, map(tuple, result.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_pipeline(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    table = documents
    for name, step in corpus_pipeline.STAGES:
        table = queries.stage(step(spark, table, FOLDER), f"test-{name}")
        if name != "sharding":
            assert table.columns == documents.columns, name
        if name == "jaccard":
            assert jaccard_components(table).filter("doc_id != component_id").count() == 0
        if name == "decontamination":
            assert contained_items(table, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
    counts = Counter(row["shard"] for row in table.select("shard").collect())
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 8


def rows_of(table):
    return Counter((row["doc_id"], row["text"]) for row in table.collect())


#: Rows without doc_id, repeats, and one doc_id on several texts.
ITEM = phrase(48, 20)
ROWS = [
    (1, phrase(40, 60)),
    (None, phrase(40, 60)),
    (None, edited(phrase(40, 60), 1, 1)),
    (None, phrase(41, 60)),
    (None, phrase(42, 60)),
    (None, edited(phrase(42, 60), 2, 1)),
    (None, phrase(43, 60) + " " + ITEM),
    (None, ""),
    (None, None),
    (2, phrase(44, 60)),
    (2, edited(phrase(40, 60), 3, 1)),
    (2, phrase(45, 60) + " " + ITEM),
    (3, phrase(46, 60)),
    (3, phrase(46, 60)),
    (3, edited(phrase(46, 60), 4, 1)),
    (4, " "),
]


def test_pipeline_drops_rows_one_by_one(spark):
    table = spark.createDataFrame(ROWS, "doc_id BIGINT, text STRING").repartition(3)
    marks = table.select("doc_id", "text", row_mark().alias("mark")).collect()
    rank = {(row["doc_id"], row["text"]): (row["doc_id"] is None, row["doc_id"] or 0, row["mark"]) for row in marks}
    root = jaccard_roots({i: shingles(text) for i, (_, text) in enumerate(ROWS)})
    stays = {}
    for i, row in enumerate(ROWS):
        stays[root[i]] = min(stays.get(root[i], row), row, key=rank.get)
    expected = Counter(row for i, row in enumerate(ROWS) if not shingles(row[1]) or stays[root[i]] == row)
    kept = queries.stage(corpus_pipeline.one_of_each_group(spark, table, ""), "test-rows")
    assert rows_of(kept) == expected
    items = spark.createDataFrame([(1, ITEM), (2, phrase(49, 20))], "item_id BIGINT, text STRING")
    clean = Counter({row: n for row, n in expected.items() if ITEM not in (row[1] or "")})
    assert sum(clean.values()) < sum(expected.values())
    assert rows_of(without_contained(kept, items)) == clean
    none = table.limit(0)
    assert corpus_pipeline.one_of_each_group(spark, none, "").count() == without_contained(none, items).count() == 0


def test_pipeline_keeps_columns_of_its_own_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    own = ["score", "LANG_pred", "size", "source_size", "target", "taken", "positions", "position"]
    more = docs.withColumns({name: F.concat(F.lit(name), F.crc32(F.col("text").cast("binary"))) for name in own})
    for name in ("language", "mixing"):
        step = dict(corpus_pipeline.STAGES)[name]
        result = step(spark, more, FOLDER)
        assert result.columns == more.columns
        rows = result.collect()
        assert rows and all(row[name] == f"{name}{zlib.crc32(row['text'].encode())}" for row in rows for name in own if row["text"] is not None)


def test_sha_of_the_kept_words(spark):
    row = queries.window_dedup(spark, FOLDER).filter("n_removed = 0").join(
        spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id"
    ).first()
    assert row["kept_sha256"] == hashlib.sha256(" ".join(words(row["text"])).encode()).hexdigest()
