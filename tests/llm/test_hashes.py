"""Word hashes: the same wherever a word stands, and different for words that polynomials confuse."""

import numpy as np
import pyarrow as pa

from candlekit.llm import textbytes as B


def hashes(texts, limit=1 << 20):
    found = []
    for chunk in B.chunks(pa.array(texts), limit):
        spans = B.words(chunk)
        values = B.word_hashes(B.lowered(chunk.data), spans)
        found += [values[a:b].tolist() for a, b in zip(spans.first, spans.first[1:])]
    return found


def confused(size):
    """Two words over a and b that any polynomial modulo 2 ** 64 gives one value if they are long."""
    bits = [i.bit_count() & 1 for i in range(size)]
    return "".join("ab"[bit] for bit in bits), "".join("ba"[bit] for bit in bits)


def test_words_that_polynomials_confuse():
    one, other = confused(4096)
    (first,), (second,) = hashes([one, other])
    assert first != second
    assert B.span_hashes(B.prefix_sums(np.frombuffer(one.encode(), np.uint8).astype(np.uint64), B.BYTE_BASE), np.array([0]), np.array([4096]), B.BYTE_BASE) == B.span_hashes(
        B.prefix_sums(np.frombuffer(other.encode(), np.uint8).astype(np.uint64), B.BYTE_BASE), np.array([0]), np.array([4096]), B.BYTE_BASE
    )


def test_hashes_do_not_depend_on_the_place():
    texts = ["a bb ccc", "", "ccc  bb\ta", "   ", None, "Bb", "é ccc", "x" * 3000 + " a"]
    expected = {}
    for limit in (1, 7, 1 << 20):
        for text, values in zip(texts, hashes(texts, limit)):
            words = (text or "").lower().split()
            assert len(words) == len(values)
            for word, value in zip(words, values):
                assert expected.setdefault(word, value) == value
    assert len(set(expected.values())) == len(expected)


def test_confused_words_are_not_linked_and_not_removed(spark):
    from candlekit.llm.jaccard_join import jaccard_components
    from candlekit.llm.window_dedup import without_repeated_windows

    one, other = confused(4096)
    docs = spark.createDataFrame([(1, one), (2, other)], "doc_id BIGINT, text STRING")
    assert [row["component_id"] for row in jaccard_components(docs).orderBy("doc_id").collect()] == [1, 2]
    shared = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{shared} {one}"), (2, f"{shared} {other}")], "doc_id BIGINT, text STRING")
    assert [row["n_removed"] for row in without_repeated_windows(docs).collect()] == [0, 0]
