"""BPE encoding and decoding over a table of distinct words.

Texts are split into words at white space of ASCII, at which the tokenizer's own patterns always split too. Chunks of
texts send their distinct words to parts of a hashed word space (see ``chunks``); there each distinct word is encoded once
for the whole corpus and its ids go back to the chunks, which join them by position. Ids are decoded by a join with the
table of pieces; that table is the tokenizer's vocabulary, whose size is fixed by its file.

The vocabulary file is a parameter. It is read on the driver and shipped with the tasks.

Defined results: NULL and empty texts have no ids and decode to an empty text; repeated rows are encoded alike; an empty
table gives an empty result; a word of any length is one word. All input columns are carried; an input column named
like a result column is replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.anchors import hash_spans, words
from ordermill.llm.chunks import (
    CHUNK_BYTES, ask, extended, finish, n_parts, pack, pack_arrays, part_of, text_buffer, unpack_arrays, with_answers,
)

RESULT = ["n_tokens", "ids", "decoded"]
PART_BYTES = 12 << 20


@lru_cache(maxsize=2)
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check_definition(definition: str) -> None:
    """Words may be encoded one by one only if nothing in the tokenizer looks beyond white space."""
    parts = json.loads(definition)
    if parts.get("post_processor") or parts.get("decoder"):
        raise ValueError("a tokenizer with a post-processor or decoder needs whole texts")
    for token in parts.get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or any(c.isspace() for c in token["content"]):
            raise ValueError("an added token reaches beyond its word")
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [parts.get("pre_tokenizer") or {}]
    if not any(s.get("type") == "Split" and s.get("behavior") == "Removed" for s in steps):
        raise ValueError("the tokenizer keeps white space")


class _Words:
    """Words of a chunk: the distinct ones in order, and which of them stands where."""

    def __init__(self, rows: pa.Table, text: int):
        data, offsets = text_buffer(rows, text)
        starts, ends = words(data, offsets)
        self.texts = np.searchsorted(starts, offsets)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        packed = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)] if len(data) else data
        borders = np.concatenate([[0], np.cumsum(ends - starts)])
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(packed))]
        )
        found = column.dictionary_encode()
        distinct = found.dictionary
        cuts = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
        body = np.frombuffer(distinct.buffers()[2], np.uint8)[: cuts[-1]] if cuts[-1] else np.zeros(0, np.uint8)
        # in order of the words, in which neighbours are alike and messages compress
        by = pc.sort_indices(distinct)
        self.distinct = distinct.take(by)
        self.hashes = hash_spans(body, cuts[:-1], cuts[1:])[np.asarray(by)]
        rank = np.empty(len(by), np.int64)
        rank[np.asarray(by)] = np.arange(len(by))
        self.place = rank[np.asarray(found.indices)] if len(starts) else np.zeros(0, np.int64)

    def by_part(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words in the order of their parts, and their parts."""
        part = part_of(self.hashes, parts)
        by = np.argsort(part, kind="stable")
        return by, part[by]


def _question(rows: pa.Table, text: int, parts: int) -> list[tuple[int, bytes]]:
    own = _Words(rows, text)
    by, part = own.by_part(parts)
    words_by_part = own.distinct.take(pa.array(by)).to_pylist()
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    return [
        (int(part[a]), pack_arrays(np.array([len(w) for w in words_by_part[a:b]], np.uint32), np.frombuffer(b"".join(words_by_part[a:b]), np.uint8)))
        for a, b in zip(cuts, [*cuts[1:], len(part)])
    ]


def _answer(bodies: list[bytes], definition: str) -> list[bytes]:
    """Ids of each word that a chunk asked for; each distinct word is encoded once."""
    asked, numbers = [], {}
    for body in bodies:
        lengths, data = unpack_arrays(body, np.uint32, np.uint8)
        raw, cuts = data.tobytes(), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
        asked.append([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(cuts[:-1], cuts[1:])])
    tokenizer, table = _tokenizer(definition), list(numbers)
    counts, found = [], []
    for first in range(0, len(table), 5_000):
        batch = [w.decode() for w in table[first : first + 5_000]]
        ids = [e.ids for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        counts.append(np.array([len(i) for i in ids], np.int64))
        found.append(np.fromiter((i for own in ids for i in own), np.uint32))
    none = np.zeros(0, np.int64)
    sizes, flat = np.concatenate([none, *counts]), np.concatenate([none.astype(np.uint32), *found])
    firsts = np.cumsum(sizes) - sizes
    return [_ids_of(np.array(ks, np.int64), sizes, firsts, flat) for ks in asked]


def _ids_of(chosen: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, flat: np.ndarray) -> bytes:
    own = sizes[chosen]
    at = np.repeat(firsts[chosen] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    return pack_arrays(own.astype(np.uint32), flat[at])


@lru_cache(maxsize=2)
def _pieces(definition: str) -> pa.Array:
    """Piece of each id."""
    tokenizer = _tokenizer(definition)
    return pa.array([tokenizer.id_to_token(i) or "" for i in range(max(tokenizer.get_vocab().values(), default=-1) + 1)], pa.string())


def encode(
    docs: DataFrame, definition: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES, stable: bool = False, digests: bool = False
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (array<int>) and ``decoded`` (pieces joined by one space).

    ``definition`` is the content of a tokenizer file. With ``digests`` the two last columns are SHA-256 hex digests
    instead: of the decimal ids joined by one space, and of the decoded text.
    """
    check_definition(definition)
    docs = docs.drop(*[c for c in RESULT if c != text])
    column = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # a vocabulary file: of fixed size
    chunks = pack(docs, text, "bpe-chunks", chunk_bytes, stable)
    parts = n_parts(docs_bytes(docs, text) if stable else chunks, PART_BYTES)
    answers = ask(chunks, lambda n, rows, _: _question(rows, column, parts), lambda b: _answer(b, shared.value))
    schema = extended(docs.schema, f"n_tokens long, ids {'string' if digests else 'array<int>'}, decoded string")

    def result(number: int, rows: pa.Table, answered: dict[int, bytes]) -> pa.Table:
        own = _Words(rows, column)
        replies = [unpack_arrays(answered[p], np.uint32, np.uint32) for p in sorted(answered)]
        counts = np.concatenate([np.zeros(0, np.uint32)] + [c for c, _ in replies]).astype(np.int64)
        if len(counts) != len(own.hashes):
            raise RuntimeError("the rows of a chunk are not those that asked: read the input from a stable source")
        table = np.concatenate([np.zeros(0, np.uint32)] + [i for _, i in replies])
        by, _ = own.by_part(parts)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        own.place = rank[own.place]
        return _with_ids(rows, own, counts, table, _pieces(shared.value), digests)

    return finish(with_answers(chunks, answers), result, schema)


def docs_bytes(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.octet_length(text).alias("n_bytes"))


def _with_ids(rows: pa.Table, own: _Words, counts: np.ndarray, table: np.ndarray, pieces: pa.Array, digests: bool) -> pa.Table:
    firsts = np.cumsum(counts) - counts
    per_word = counts[own.place]
    sums = np.concatenate([[0], np.cumsum(per_word)])
    by_text = sums[own.texts]
    rows = rows.append_column("n_tokens", pa.array(np.diff(by_text), pa.int64()))
    if not digests:
        at = np.repeat(firsts[own.place] - sums[:-1], per_word) + np.arange(int(sums[-1]))
        ids = table[at].astype(np.int32)
        rows = rows.append_column("ids", pa.ListArray.from_arrays(pa.array(by_text, pa.int32()), pa.array(ids)))
        spelled = pa.ListArray.from_arrays(pa.array(by_text, pa.int32()), pieces.take(pa.array(ids)))
        return rows.append_column("decoded", pc.binary_join(spelled, " ").cast(pa.string()))
    # spell each distinct word once, then join the words of each text; words without ids take no place
    cuts = pa.array(np.append(firsts, counts.sum()), pa.int32())
    left = np.flatnonzero(per_word > 0)
    borders = np.searchsorted(left, own.texts)
    for name, items in (("ids", pc.cast(pa.array(table), pa.string())), ("decoded", pieces.take(pa.array(table)))):
        spelled = pc.binary_join(pa.ListArray.from_arrays(cuts, items), " ")
        out = []
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            words_of_text = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), spelled.take(pa.array(own.place[left[a:b]])))
            out.append(hashlib.sha256(pc.binary_join(words_of_text, " ")[0].as_buffer()).hexdigest())
        rows = rows.append_column(name, pa.array(out, pa.string()))
    return rows
