"""Word windows of inputs whose sketch is too large to be sent to the executors."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlekit.llm import anchors as A
from candlekit.llm import window_dedup as W
from candlekit.llm.textbytes import chunks
from candlekit.llm.window_dedup import _placed_anchors, without_repeated_windows

SCHEMA = "doc_id BIGINT, text STRING"


def phrase(seed, n):
    rng = random.Random(seed)
    return [f"{rng.randrange(10**6):06d}" for _ in range(n)]


def plain(texts, rank=str):
    """Counts of (doc_id, n_words, n_removed, kept), by the definition; `rank` orders the texts of one doc_id."""
    seen, expected = set(), {}
    for doc, text in sorted({(-1 if d is None else d, t) for d, t in texts}, key=lambda row: (row[0], rank(row[1]))):
        found, gone = text.split(), set()
        for i in range(len(found) - 19):
            if tuple(found[i : i + 20]) in seen:
                gone |= set(range(i, i + 20))
            seen.add(tuple(found[i : i + 20]))
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        expected[doc, text] = (None if doc < 0 else doc, len(found), len(gone), kept)
    return Counter(expected[-1 if d is None else d, t] for d, t in texts)


def cut(spark, texts, sketch_bytes=0):
    docs = spark.createDataFrame(texts, SCHEMA).repartition(3)
    return Counter(map(tuple, without_repeated_windows(docs, sketch_bytes).collect()))


def shuffled_bytes(frame):
    """Bytes that the exchanges of a frame's plan wrote when it was collected."""
    total, open_plans = 0, [frame._jdf.queryExecution().executedPlan()]
    while open_plans:
        plan = open_plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            open_plans.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                total += plan.metrics().apply("shuffleBytesWritten").value()
            open_plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


def test_windows_without_repetition_are_not_shuffled(spark):
    texts = [(i, " ".join(phrase(i, 400))) for i in range(300)] + [(300, " ".join(phrase(7, 400)))]
    frame = without_repeated_windows(spark.createDataFrame(texts, SCHEMA), 0)
    assert Counter(map(tuple, frame.collect())) == plain(texts)
    # The texts themselves, and 12 bytes an anchor; the hashes of the windows alone are over twice the text.
    assert 0 < shuffled_bytes(frame) < 1.6 * sum(len(text) for _, text in texts)


@pytest.mark.parametrize("sketch_bytes", [0, 64 << 20])
def test_copies_of_a_text(spark, sketch_bytes):
    """Copies of one text, short ones, texts that share a part, and rows that come twice."""
    whole, part, short = phrase(1, 90), phrase(2, 30), phrase(3, 19)
    texts = [(i, " ".join(whole)) for i in (9, 4, 4, 6)] + [(5, " ".join(whole[:40] + part)), (5, " ".join(whole))]
    texts += [(None, " ".join(part)), (None, " ".join(part)), (3, " ".join(part)), (2, " ".join(whole[30:80] + part))]
    texts += [(i, " ".join(short)) for i in (10, 11)] + [(12, ""), (13, ""), (14, " ".join(short + whole[50:]))]
    texts += [(15, " ".join(part + part)), (16, " ".join(part * 3))]
    assert cut(spark, texts, sketch_bytes) == plain(texts)


def test_near_copies_on_few_doc_ids(spark):
    """More near copies than go together; doc_ids stand on several texts, or are missing, beside plain ones."""
    base, texts = phrase(4, 90), []
    for i in range(70):
        text = " ".join(base[: i % 60] + phrase(200 + i, 1) + base[i % 60 + 1 :])
        texts.append(((None, i % 5, 100 + i)[i % 3], text))
    texts += [(i % 4, text) for i, (_, text) in enumerate(texts[:20])] + [(0, " ".join(phrase(5, 25)))] * 2
    marks = spark.createDataFrame([(text,) for _, text in texts], "text STRING").select("text", F.xxhash64("text"))
    assert cut(spark, texts) == plain(texts, dict(map(tuple, marks.collect())).get)


def near(texts):
    marks = pa.array(np.arange(len(texts), dtype=np.int64))
    return W._near(pa.RecordBatch.from_arrays([marks, pa.array(texts)], names=["mark", "text"]))


def test_documents_with_one_key(spark):
    """What is joined by a key goes to its own document only."""
    one = phrase(4, 60)
    texts = [" ".join(phrase(400 + i, 10 + i % 3 * 30) + one + phrase(500 + i, 40)) for i in range(60)] + [" ".join(one)]
    values = near(texts)
    texts = [text for text, value in zip(texts, values) if value == values[-1]]
    assert 4 <= len(texts)
    texts = [(i, text) for i, text in enumerate(texts[-12:])] + [(20, " ".join(phrase(8, 50)))]
    assert cut(spark, texts) == plain(texts)


def test_near_copies_share_a_key():
    """Texts whose smallest run is the same; large groups are cut into parts, the same for equal rows."""
    base = phrase(9, 200)
    texts = [" ".join(base[:150] + phrase(300 + i, 1) + base[151:]) for i in range(40)] + [" ".join(phrase(10, 200)), "few words"]
    marks = np.arange(len(texts), dtype=np.int64)
    values = near(texts)
    shared, count = Counter(values.tolist()).most_common(1)[0]
    assert count >= 35 and values[40] != shared and values[41] == 41
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys = W._keys(none, values, marks, marks)
    assert len(set(keys[values == shared].tolist())) == 1 and keys[40] != keys[0]
    groups = np.array([shared]), np.array([3], np.uint64)
    parts = W._keys(groups, values, marks, marks)
    assert len(set(parts[values == shared].tolist())) == 3 and (parts[values != shared] == keys[values != shared]).all()
    assert (W._keys(groups, values[::-1], marks[::-1], marks[::-1]) == parts[::-1]).all()


def test_an_anchor_is_asked_twice_at_most():
    """The others of a buffer are told without being asked, wherever they stand."""
    texts = [" ".join(phrase(6, 30) + phrase(i, 30)) for i in range(100, 140)]
    keys = np.arange(len(texts), dtype=np.int32) - 20
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts)], names=["key", "text"])
    buckets = 64
    table = pa.Table.from_batches(list(A._asked(_placed_anchors, buckets, iter([batch]))))
    asked = np.concatenate([np.frombuffer(x, A.ASKED) for x in table.column("asked").to_pylist() if x])
    assert max(Counter(asked["anchor"].tolist()).values()) == 2
    told = set()
    for part in set(table.column("part").to_pylist()):
        answer = A._told(buckets, table.filter(pa.array([x == part for x in table.column("part").to_pylist()])))
        told |= set(zip(answer.column("key").to_pylist(), answer.column("anchor").to_pylist()))
    (chunk,) = chunks(batch.column("text"))
    anchors, rows = _placed_anchors(chunk)
    often = Counter(anchors.tolist())
    low = anchors.astype(np.uint32).view(np.int32).tolist()
    repeated = {(int(keys[r]), b) for a, b, r in zip(anchors.tolist(), low, rows) if often[a] > 1}
    assert len(repeated) >= 3 * len(texts) and repeated <= told
    assert len(told) < len(repeated) + 10
