"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda.

A text gets a space in front, spaces are word marks, and every character is a symbol. All adjacent pairs of symbols that
form a piece wait in an agenda, the best score first and of equal scores the leftmost; the first pair is merged and makes
new pairs with its neighbours, until none is left. Symbols outside the vocabulary become one id per byte.

No merge crosses a place whose two neighbouring bytes stand next to each other in no piece. Texts are cut at these places
in Arrow batches, and the agenda runs once for each distinct stretch that a Python worker meets (a memory of bounded size).
The work is one pass without a shuffle. The library checks it in the same batches: the stretches that are new to the
worker, each behind a character that joins with nothing, or whole texts, which costs as much again. A difference fails the
query; it never passes as a result.

The model is a parameter, read on the driver and shipped with the tasks; its size is fixed by its file. Only models that
leave texts as they are (no normalization, spaces kept, a space put in front, byte fallback) are taken.

Defined results: NULL and empty texts have the end id only and decode to an empty text; the word mark itself in a text
counts as a space, as in the library; repeated rows are encoded alike; an empty table gives an empty result; texts of any
length are one text. All input columns are carried; one named like a result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ordermill.llm.chunks import extended, pieces, text_buffer

RESULT = ["n_tokens", "ids", "decoded"]
MARK = "▁"
# A worker forgets its stretches when they hold this many bytes together with their ids.
MEMORY_BYTES = 64 << 20
# Texts of so many bytes are worked on at once; a longer text is a batch of its own.
PIECE_BYTES = 2 << 20
# Up to so many symbols a plain list is the faster agenda.
LONG = 48
NO_PIECE = float("-inf")
CHECKS = ("texts", "stretches", "none")


class Vocabulary:
    """Pieces, scores and cutting places of a model, and the agenda over them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size, lib = self.library.GetPieceSize(), self.library
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [-1] * 256
        self.spelled: list[bytes] = []
        for i in range(size):
            piece = lib.IdToPiece(i)
            if lib.IsByte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                self.spelled.append(bytes([value]))
            elif lib.IsControl(i) or lib.IsUnknown(i):
                self.spelled.append(b"")
            else:
                piece = piece.replace(MARK, " ")
                self.id[piece] = i
                self.score[piece] = lib.GetScore(i)
                self.spelled.append(piece.encode())
        self.decimal = pa.array([b"%d" % i for i in range(size)], pa.binary())
        self.bytes_of = pa.array(self.spelled, pa.binary())
        self.end = lib.eos_id()
        if self.end < 0 or min(self.byte_id) < 0 or any(lib.IsUnused(i) for i in range(size)):
            raise ValueError("the model has no end id, no byte fallback, or pieces that are not used")
        probe = " ﬁ  Å\t"
        if lib.normalize(probe) != MARK + probe.replace(" ", MARK) or lib.normalize(""):
            raise ValueError("the model changes texts before it encodes them")
        self.joins = np.zeros((256, 256), bool)  # bytes that stand next to each other in some piece
        for piece in self.id:
            raw = np.frombuffer(piece.encode(), np.uint8)
            self.joins[raw[:-1], raw[1:]] = True
        used = set("".join(self.id))
        self.lone = next(c for c in map(chr, range(1, 0x2000)) if c not in used)  # a character that no piece holds

    def agenda(self, text: str) -> list[int]:
        """Ids of a stretch of text, in which marks are spaces."""
        symbols = self._merged_by_heap(text) if len(text) > LONG else self._merged(text)
        ids: list[int] = []
        for s in symbols:
            known = self.id.get(s)
            if known is None:
                ids.extend(self.byte_id[b] for b in s.encode())
            else:
                ids.append(known)
        return ids

    def _merged(self, text: str) -> list[str]:
        """Symbols of a short stretch; the agenda is the list of scores by place, from which the first best is taken."""
        symbols, score = list(text), self.score.get
        agenda = [score(a + b, NO_PIECE) for a, b in zip(text, text[1:])]
        while agenda:
            best = max(agenda)
            if best == NO_PIECE:
                break
            i = agenda.index(best)
            merged = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(merged + symbols[i + 1], NO_PIECE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + merged, NO_PIECE)
        return symbols

    def _merged_by_heap(self, text: str) -> list[str]:
        """The same for a stretch of any length: the agenda is a heap, entries that are out of date are passed over."""
        symbols, score = list(text), self.score
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = [(-score[a + b], i, i + 1, 2) for i, (a, b) in enumerate(zip(text, text[1:])) if a + b in score]
        heapify(agenda)
        while agenda:
            _, i, j, size = heappop(agenda)
            left, right = symbols[i], symbols[j]
            if not left or not right or len(left) + len(right) != size:
                continue  # one of the two was merged meanwhile
            merged = symbols[i] = left + right
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = merged + symbols[k]
                if pair in score:
                    heappush(agenda, (-score[pair], i, k, len(pair)))
            k = before[i]
            if k >= 0:
                pair = symbols[k] + merged
                if pair in score:
                    heappush(agenda, (-score[pair], k, i, len(pair)))
        return [s for s in symbols if s]

    def decode(self, ids: list[int]) -> str:
        """Text of ids. A first space is the one that was put in front."""
        return b"".join(self.spelled[i] for i in ids).decode(errors="replace").removeprefix(" ")


class _Stretches:
    """Ids of the stretches that a worker has met. When they fill half the memory, the older half is forgotten."""

    def __init__(self, vocabulary: Vocabulary, check: bool):
        self.vocabulary, self.check = vocabulary, check
        self.known: dict[bytes, list[int]] = {}
        self.older: dict[bytes, list[int]] = {}
        self.size = 0

    def of(self, stretches: list[bytes]) -> list[list[int]]:
        if self.size > MEMORY_BYTES // 2:
            self.known, self.older, self.size = {}, self.known, 0
        found, new = [], []
        for s in stretches:
            ids = self.known.get(s)
            if ids is None:
                ids = self.older.get(s)
                if ids is None:
                    ids = self.vocabulary.agenda(s.decode())
                    new.append(s)
                self.known[s] = ids
                self.size += 200 + len(s) + 8 * len(ids)
            found.append(ids)
        if self.check and new:
            library, lone = self.vocabulary.library, self.vocabulary.lone
            head = len(library.encode(lone))
            for s, ids in zip(new, library.encode([lone + s.decode() for s in new], num_threads=1)):
                if ids[head:] != self.known[s]:
                    raise RuntimeError(f"the library encodes {s[:200]!r} otherwise")
        return found


@lru_cache(maxsize=2)
def _vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


@lru_cache(maxsize=2)
def _stretches(model: bytes, check: bool) -> _Stretches:
    return _Stretches(_vocabulary(model), check)


def _marked(batch: pa.RecordBatch, text: int) -> pa.Table:
    """The texts with a space in front and marks as spaces; empty ones stay empty."""
    column = pc.fill_null(batch.column(text), "")
    column = pc.replace_substring(column, MARK, " ")
    return pa.table({"text": pc.if_else(pc.equal(column, ""), "", pc.binary_join_element_wise(" ", column, ""))})


def cuts(data: np.ndarray, offsets: np.ndarray, joins: np.ndarray) -> np.ndarray:
    """Where stretches begin: at texts, and at characters that no piece joins to the one before."""
    if not len(data):
        return np.zeros(0, np.int64)
    begins = np.ones(len(data), bool)
    begins[1:] = ~joins[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(begins)


def _encoded(batch: pa.RecordBatch, text: int, model: bytes, check: str, digests: bool) -> pa.RecordBatch:
    vocabulary = _vocabulary(model)
    marked = _marked(batch, text)
    data, offsets = text_buffer(marked, 0)
    starts = cuts(data, offsets, vocabulary.joins)
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    entries = _stretches(model, check == "stretches").of(found.dictionary.to_pylist())
    place = np.asarray(found.indices).astype(np.int64)
    sizes = np.array([len(ids) for ids in entries], np.int64)
    table = np.fromiter(chain.from_iterable(entries), np.int32, int(sizes.sum()))
    by_text = np.searchsorted(starts, offsets)  # first stretch of each text
    sums = np.concatenate([[0], np.cumsum(sizes[place])])
    borders = sums[by_text]
    counts = np.diff(borders) + 1
    flat = np.zeros(0, np.int32)
    if check == "texts" or not digests:
        flat = table[np.repeat((np.cumsum(sizes) - sizes)[place] - sums[:-1], sizes[place]) + np.arange(int(sums[-1]))]
    if check == "texts":
        _compare(vocabulary, batch.column(text), flat, borders)
    if digests:
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        decimal = pc.binary_join(pa.ListArray.from_arrays(ends, vocabulary.decimal.take(pa.array(table))), b" ")
        spelled = pc.binary_join(pa.ListArray.from_arrays(ends, vocabulary.bytes_of.take(pa.array(table))), b"")
        ids = _digests(decimal, place, by_text, b" ", b"%d" % vocabulary.end, 0)
        decoded = _digests(spelled, place, by_text, b"", b"", 1)
    else:
        ends = np.cumsum(counts)
        with_end = np.full(int(counts.sum()), vocabulary.end, np.int32)
        inside = np.ones(len(with_end), bool)
        inside[ends - 1] = False
        with_end[inside] = flat
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(with_end))
        decoded = pa.array([vocabulary.decode(flat[a:b].tolist()) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())], pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64()), ids, decoded], names=[*batch.schema.names, *RESULT])


def _digests(spelled: pa.Array, place: np.ndarray, by_text: np.ndarray, between: bytes, last: bytes, dropped: int) -> pa.Array:
    """SHA-256 of each text's stretches, joined, with ``last`` behind and the first ``dropped`` bytes left out."""
    out = []
    for a, b in zip(by_text[:-1].tolist(), by_text[1:].tolist()):
        digest = hashlib.sha256()
        if b > a:
            own = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), spelled.take(pa.array(place[a:b])))
            digest.update(memoryview(pc.binary_join(own, between)[0].as_buffer())[dropped:])
            digest.update(between)
        digest.update(last)
        out.append(digest.hexdigest())
    return pa.array(out, pa.string())


def _compare(vocabulary: Vocabulary, texts: pa.Array, flat: np.ndarray, borders: np.ndarray) -> None:
    """Whole texts, encoded by the library, against the ids of the agenda."""
    found = vocabulary.library.encode(pc.fill_null(texts, "").to_pylist(), num_threads=1)
    for row, (ids, a, b) in enumerate(zip(found, borders[:-1].tolist(), borders[1:].tolist())):
        if len(ids) != b - a or not np.array_equal(np.array(ids, np.int32), flat[a:b]):
            raise RuntimeError(f"the library encodes row {row} of a batch otherwise: {texts[row].as_py()[:200]!r}")


def encode(docs: DataFrame, model: bytes, text: str = "text", check: str = "stretches", digests: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` (the end id included), ``ids`` (array<int>) and ``decoded``.

    ``model`` is the content of a model file. ``check`` says what the library encodes too: whole ``texts``, the
    ``stretches`` that are new to a worker, or ``none``. With ``digests`` the two last columns are SHA-256 hex digests
    instead: of the decimal ids joined by one space, and of the decoded text.
    """
    if check not in CHECKS:
        raise ValueError(f"no check {check!r}, only {', '.join(CHECKS)}")
    Vocabulary(model)  # refuses a model of another kind before any task runs
    docs = docs.drop(*[c for c in RESULT if c != text])
    if text in RESULT:
        raise ValueError(f"the text column may not be named {text!r}")
    column = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a model file: of fixed size
    schema = extended(docs.schema, f"n_tokens long, ids {'string' if digests else 'array<int>'}, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column, PIECE_BYTES):
                yield _encoded(piece, column, shared.value, check, digests)

    return docs.mapInArrow(run, schema)
