"""Words and hashes of Arrow text columns, vectorised over UTF-8 bytes.

Texts are handled whole. A record batch is cut between documents, so that the
arrays of one step stay near `CHUNK_BYTES`; a longer document is a chunk alone.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base & MASK, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0 .. base ** (size - 1), modulo 2 ** 64."""
    return _powers(base, 1 << max(16, (size - 1).bit_length()))[:size]


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Sums of values[i] * base ** i, one more than values."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, max(1, len(values)))[: len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each span's content, the same wherever the span stands."""
    inverse = powers(pow(base, -1, 1 << 64), len(sums))
    return (sums[ends] - sums[starts]) * inverse[starts]


@dataclass
class Chunk:
    """Consecutive documents: `bounds[i]:bounds[i + 1]` of `data` is the i-th text."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, bounds = text_arrays(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        part = bounds[first : last + 1]
        yield Chunk(first, data[part[0] : part[-1]], part - part[0])
        first = last


@dataclass
class Words:
    """Byte spans of the words of a chunk; the i-th text has words `first[i]:first[i + 1]`."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(chunk: Chunk) -> Words:
    """Maximal runs of bytes other than 0x20 and 0x09 to 0x0D."""
    size = len(chunk.data)
    inside = np.zeros(size + 2, dtype=bool)
    inside[1:-1] = (chunk.data != 32) & ((chunk.data < 9) | (chunk.data > 13))
    inner = chunk.bounds[1:-1]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    # A text ends a word, also where the next text goes on without a separator.
    cut = inner[inner < size]
    begins[cut] = inside[1:-1][cut]
    cut = inner[inner > 0] - 1
    stops[cut] = inside[1:-1][cut]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, chunk.bounds))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(data: np.ndarray, spans: Words) -> np.ndarray:
    """Per word the sum of a mixed number for each of its bytes and their places in the word.

    Not a polynomial: modulo a power of two, those give some pairs of words the same value for
    any base.
    """
    lengths = spans.ends - spans.starts
    if not len(lengths):
        return np.zeros(0, np.uint64)
    firsts = np.cumsum(lengths) - lengths
    places = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    content = data[np.repeat(spans.starts, lengths) + places].astype(np.uint64)
    content += places.astype(np.uint64) << np.uint64(8)
    return mix(np.add.reduceat(mix(content + np.uint64(BYTE_BASE)), firsts) + lengths.astype(np.uint64))


def gram_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every `length` consecutive words of the chunk, over text ends too."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(hashes, WORD_BASE)
    starts = np.arange(len(hashes) - length + 1)
    return mix(span_hashes(sums, starts, starts + length, WORD_BASE))


def shingle_hashes(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle of `length` words, A-Z lower-cased.

    A text with fewer words has its whole word sequence as one shingle; a text
    without words has none.
    """
    spans = words(chunk)
    hashes = word_hashes(lowered(chunk.data), spans)
    counts = np.diff(spans.first)
    rows = spans.rows()
    grams = gram_hashes(hashes, length)
    begins = np.arange(len(grams))
    whole = begins + length <= spans.first[rows[begins] + 1] if len(grams) else np.zeros(0, bool)
    rows, grams = rows[begins][whole], grams[whole]
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        sums = prefix_sums(hashes, WORD_BASE)
        few = span_hashes(sums, spans.first[short], spans.first[short + 1], WORD_BASE)
        rows = np.concatenate([rows, short])
        grams = np.concatenate([grams, mix(few + counts[short].astype(np.uint64))])
        order = np.argsort(rows, kind="stable")
        rows, grams = rows[order], grams[order]
    return rows, grams


def sliding_minimum(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every `width` consecutive values the one that is smallest by its upper half,
    the first of equals, and where it stands."""
    if len(values) < width:
        return values[:0], np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    packed = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        packed = np.minimum(packed[step:], packed[: len(packed) - step])
        span += step
    places = (packed & low).astype(np.int64)
    return values[places], places
