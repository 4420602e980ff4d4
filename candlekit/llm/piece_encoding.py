"""Encoding with the merges of a SentencePiece BPE model, by backtracking.

A merge encoder joins the best adjacent pair until no pair is a piece. Its result is the
only sequence of pieces in which every piece alone, and every two neighbours together,
merge back into themselves. So the sequence can be found from left to right: take the
longest piece that starts here (an Aho-Corasick scan gives it for every position), go to
shorter ones while the neighbour on the left does not fit, and go back one piece if none
fits. A prefix has one encoding, so a position that failed fails for good: one bit each.
The work is linear in the text, however long a word is.

No piece has a space mark after another character (checked when a model is read), so
merges stay inside a word with its spaces, and they never join two characters that no
piece holds side by side. Such parts are encoded one at a time, and repeated ones are
looked up.
"""

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

#: Encoded words and judged neighbours that a worker remembers; both only save time. The
#: words of the last two generations are there.
KNOWN_WORDS = 1 << 18
KNOWN_PAIRS = 1 << 18
#: Longer words are not remembered.
KNOWN_LENGTH = 32
#: Texts or tokens that one Arrow batch of results is made from, in bytes or ids.
BATCH_SIZE = 1 << 20
#: A model goes to the executors with the task, so its size is checked.
MODEL_BYTES = 64 << 20

_NONE: dict[str, bool] = {}

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class PieceEncoder:
    """Encodes as the model does, without begin and end ids."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(library.vocab_size())
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in ids]
        self.library = library
        # Ids are kept as 32-bit numbers in bytes, which are short and quickly joined.
        self.bytes = [array("i", [library.piece_to_id(f"<0x{value:02X}>")]).tobytes() for value in range(256)]
        self.ids = {library.id_to_piece(i): i for i in ids if not special[i]}
        self.scores = {piece: library.get_score(i) for piece, i in self.ids.items()}
        self.alphabet = set(chain.from_iterable(self.ids))
        #: Characters that stand side by side in a piece; no merge joins others.
        self.side_by_side = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.scan = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in self.ids:
            if len(piece) > 1:
                self.scan.add_word(piece)
        self.scan.make_automaton()
        # The longest piece that is a proper prefix of a piece.
        self.shorter = {piece: self._prefix(piece) for piece in self.alphabet.union(self.ids)}
        self.merges: dict[str, list[tuple[float, str, str]] | None] = {}
        self.followers: dict[str, dict[str, bool]] = {}
        self.judged = 0
        self.packed = {piece: array("i", [i]).tobytes() for piece, i in self.ids.items()}
        for character in self.alphabet.difference(self.ids):
            self.packed[character] = b"".join([self.bytes[value] for value in character.encode()])
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}

    def _prefix(self, piece: str) -> str:
        for end in range(len(piece) - 1, 1, -1):
            if piece[:end] in self.ids:
                return piece[:end]
        return piece[:1] if len(piece) > 1 else ""

    def _merges(self, piece: str) -> list[tuple[float, str, str]] | None:
        """How `piece` is merged from its characters: the best score first, then the leftmost. Of
        each merge its score, and the first and last symbol after it. None if something else results."""
        if piece not in self.merges:
            parts, scores, steps = list(piece), self.scores, []
            while True:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    score = scores.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.merges[piece] = steps if len(parts) == 1 else None
        return self.merges[piece]

    def fits(self, left: str, piece: str) -> bool:
        """Whether both pieces come out if their characters are merged side by side (or `piece`
        alone, if `left` is empty): the two merge as they do alone, in the order of their
        scores, until the symbols that touch are the better pair."""
        rights = self._merges(piece)
        if rights is None or not left:
            return rights is not None
        lefts = self._merges(left)
        last, first, i, j = left[-1], piece[0], 0, 0
        crossing = self.scores.get(last + first)
        while i < len(lefts) or j < len(rights):
            # Of equal scores the leftmost pair is merged.
            if j == len(rights) or (i < len(lefts) and lefts[i][0] >= rights[j][0]):
                if crossing is not None and crossing > lefts[i][0]:
                    return False
                symbol, first_symbol, i = lefts[i][2], first, i + 1
            else:
                if crossing is not None and crossing >= rights[j][0]:
                    return False
                symbol, first_symbol, j = last, rights[j][1], j + 1
            if symbol is not last or first_symbol is not first:
                last, first = symbol, first_symbol
                crossing = self.scores.get(last + first)
        return crossing is None

    def _judge(self, left: str, piece: str) -> bool:
        if self.judged >= KNOWN_PAIRS:
            self.followers, self.judged = {}, 0
        self.judged += 1
        fits = self.followers.setdefault(left, {})[piece] = self.fits(left, piece)
        return fits

    def backtrack(self, word: str) -> list[str]:
        """The pieces of `word`, all of whose characters occur in pieces."""
        size = len(word)
        ends = list(range(1, size + 1))
        for last, length in self.scan.iter(word):
            # Matches come by ascending ends, so the last one noted for a start is the longest.
            ends[last - length + 1] = last + 1
        failed = None
        path: list[str] = []
        at, left, piece = 0, "", word[: ends[0]]
        shorter = self.shorter
        while True:
            judged = self.followers.get(left, _NONE)
            while piece:
                fits = judged.get(piece)
                if fits is None:
                    fits = self._judge(left, piece)
                if fits:
                    end = at + len(piece)
                    if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                        break
                piece = shorter[piece]
            if piece:
                path.append(piece)
                if end == size:
                    return path
                at, left, piece = end, piece, word[end : ends[end]]
            else:
                if failed is None:
                    failed = bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = path.pop()
                at -= len(piece)
                left = path[-1] if path else ""

    def _part_ids(self, part: str) -> bytes:
        """The ids of a part of a word in which all neighbours stand side by side in pieces."""
        if part[0] not in self.alphabet:
            # A character that no piece holds is a part alone: its bytes stand for it.
            return b"".join([self.bytes[value] for value in part.encode()])
        packed = self.packed
        return b"".join([packed[piece] for piece in self.backtrack(part)])

    def _remembered(self, text: str, make) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            ids = self.known_before.get(text)
            if ids is None:
                ids = make(text)
            if len(text) <= KNOWN_LENGTH:
                if len(self.known) >= KNOWN_WORDS:
                    self.known, self.known_before = {}, self.known
                self.known[text] = ids
        return ids

    def _word_ids(self, word: str) -> bytes:
        if word.lstrip(SPACE).isalpha() and self.alphabet.issuperset(word):
            return self._part_ids(word)
        pairs = self.side_by_side
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in pairs]
        if not cuts:
            return self._part_ids(word)
        return b"".join(
            [self._remembered(word[start:end], self._part_ids) for start, end in zip([0, *cuts], [*cuts, len(word)])]
        )

    def encode_packed(self, text: str) -> bytes:
        """The ids of `text` as 32-bit numbers."""
        if not text:
            return b""
        words = WORD.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(self.known.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self._remembered(words[i], self._word_ids)
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_packed(text)).tolist()


@lru_cache(maxsize=1)
def encoder(model: bytes) -> PieceEncoder:
    return PieceEncoder(model)


def read_model(path: str) -> bytes:
    """The model file, if this module encodes as the library does with it.

    That holds for BPE models with byte fallback that leave texts as they are but for a
    space mark before the text and in place of each space, and have no user-defined nor unused
    pieces. Others raise ValueError.
    """
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        model = file.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"The model is larger than {MODEL_BYTES} bytes")
    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    text, training = spec.normalizer_spec, spec.trainer_spec
    wanted = {
        "a BPE model": training.model_type == training.BPE,
        "byte fallback": training.byte_fallback,
        "no character map": not text.precompiled_charsmap,
        "a space mark before the text": text.add_dummy_prefix and not training.treat_whitespace_as_suffix,
        "all spaces kept and marked": text.escape_whitespaces and not text.remove_extra_whitespaces,
        "no user-defined or unused pieces": {piece.type for piece in spec.pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE},
        "space marks only at the front of pieces": not any(
            SPACE in piece.piece.lstrip(SPACE) for piece in spec.pieces if piece.type == NORMAL
        ),
    }
    for name, met in wanted.items():
        if not met:
            raise ValueError(f"The model needs {name}")
    return model


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose sizes sum up to BATCH_SIZE at most, or single rows."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > BATCH_SIZE:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _with_column(df: DataFrame, name: str, kind: str, make) -> DataFrame:
    """`df` with a column that `make` computes from an Arrow batch, row by row."""
    at = df.columns.index(name) if name in df.columns else len(df.columns)
    names = [*df.columns[:at], name, *df.columns[at + 1 :]]
    fields = [f"`{n.replace('`', '``')}` {kind if n == name else df.schema[n].dataType.simpleString()}" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, made in make(batch):
                arrays = [made if n == name else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, ", ".join(fields))


def encode_texts(docs: DataFrame, model: bytes, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """`docs` with the ids of each whole text in the array column `tokens`.

    A null or empty text has no ids. Other columns are carried; a column that is already named
    `tokens` is replaced, so choose another name to keep it. Rows are handled one by one: repeated
    rows and null ids need no care, and an empty table gives an empty one.
    """

    def make(batch):
        encode = encoder(model).encode_packed
        column = batch.column(text)
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        for first, last in _slices(sizes):
            part = batch.slice(first, last - first)
            found = [encode(value or "") for value in part.column(text).to_pylist()]
            ends = np.cumsum([0, *[len(ids) // 4 for ids in found]], dtype=np.int32)
            ids = np.frombuffer(b"".join(found), np.int32)
            yield part, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))

    return _with_column(docs, tokens, "array<int>", make)


def decode_tokens(rows: DataFrame, model: bytes, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """`rows` with the text that the library decodes from `tokens`, in the column `text`.

    A null or empty array is an empty text. Other columns are carried; a column that is
    already named `text` is replaced.
    """

    def make(batch):
        decode = encoder(model).library.decode
        sizes = pc.list_value_length(batch.column(tokens)).fill_null(0).to_pylist()
        for first, last in _slices(sizes):
            part = batch.slice(first, last - first)
            lists = part.column(tokens)
            ids, ends = lists.flatten().to_numpy(), np.cumsum([0, *sizes[first:last]])
            found = [decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(ends, ends[1:])]
            yield part, pa.array(found, pa.string())

    return _with_column(rows, text, "string", make)
