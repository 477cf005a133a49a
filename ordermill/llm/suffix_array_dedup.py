"""Dedup of byte strings of ``length`` bytes. The dealt suffix array and longest previous factors are not built; see the README.

Texts are bytes. A place whose next ``length`` bytes stand at an earlier place too is a later copy, i.e. its longest
previous factor would reach ``length``, and the earlier place is an earlier one. Hashes of the ``length`` bytes tell that. Bytes of later copies are removed while the first one stays (``keep_first``), or both sides
(``keep_first=False``). Strings are judged on the input, matches never cross documents, overlaps count.

Windows reach the parts that compare them by the routes of ``repeats``: only places whose anchor occurs twice, split by
prefixes.

Defined results: NULL and empty texts have zero bytes; shorter texts than ``length`` lose nothing; repeated rows are
occurrences of their own; an empty table gives an empty result. All input columns are carried; an input column named
like a result column is replaced. "First" is by ``order`` (an integer column, NULL last), then by input order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import repeats
from ordermill.llm.anchors import Units
from ordermill.llm.chunks import CHUNK_BYTES, columns_of, extended, finish, pack, row_of, text_buffer, with_answers

RESULT = ["n_bytes", "n_removed", "removed", "kept"]
LENGTH = 400
GRAM = 64


def previous_factors(names: np.ndarray, checks: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that share a factor of full length with another place, and those of them without an earlier one.

    ``names`` are hashes in order of position, so after a stable sort the earlier one of equal windows is the neighbour
    before and the later one the neighbour behind. ``times`` counts places that hold the same context.
    """
    by = np.argsort(names, kind="stable")
    same = (names[by][1:] == names[by][:-1]) & (checks[by][1:] == checks[by][:-1])
    border = np.zeros(min(1, len(by)), bool)
    earlier, later = np.concatenate([border, same]), np.concatenate([same, border])
    repeated, first = np.zeros(len(by), bool), np.zeros(len(by), bool)
    repeated[by] = earlier | later | (times[by] > 1)
    first[by] = ~earlier
    return repeated, first


def dedup(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    order: str | None = None,
    keep_first: bool = True,
    whole_characters: bool = False,
    group_rows: int = repeats.GROUP_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``removed`` (first and end byte of each run) and ``kept`` (binary).

    With ``whole_characters`` a character of which some bytes stay, stays whole, so that ``kept`` is valid UTF-8.
    """
    docs = docs.drop(*[c for c in RESULT if c not in (text, order)])
    column = docs.columns.index(text)
    task = repeats.Task(
        column, docs.columns.index(order) if order else -1, Units.of_bytes, False, length, min(gram, length), keep_first, group_rows
    )
    chunks = pack(docs, text, "suffix-chunks", chunk_bytes)
    answered = with_answers(chunks, repeats.repeated_windows(chunks, task, previous_factors))
    schema = extended(docs.schema, f"n_bytes long, n_removed long, removed {repeats.SPANS}, kept binary")

    def result(number: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        data, texts = text_buffer(rows, column)
        gone = repeats.removed_units(answers, length, Units.of_bytes(data, texts))
        if whole_characters:
            gone = _whole(data, gone)
        sums = np.concatenate([[0], np.cumsum(gone)])
        left = texts - sums[texts]
        for name, values in (
            ("n_bytes", pa.array(np.diff(texts), pa.int64())),
            ("n_removed", pa.array(np.diff(sums[texts]), pa.int64())),
            ("removed", repeats.spans_column(*repeats.spans_by_text(gone, texts))),
            ("kept", pa.BinaryArray.from_buffers(pa.binary(), len(texts) - 1, [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[~gone]))])),
        ):
            rows = rows.append_column(name, values)
        return rows

    return finish(answered, result, schema)


def _whole(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Removed bytes without those of characters that keep a byte."""
    if not len(data):
        return gone
    number = np.cumsum((data & 0xC0) != 0x80)
    kept = np.zeros(int(number[-1]) + 1, bool)
    kept[number[~gone]] = True
    return gone & ~kept[number]


def without_later_copies(docs: DataFrame, text: str = "text", order: str = "doc_id", **options) -> DataFrame:
    """The columns of ``docs`` with later copies cut out of the texts; documents of which nothing is left go."""
    inner = docs.select(row_of(docs, text), F.col(text).alias("text"), F.col(order).alias("order"))
    done = dedup(inner, "text", order="order", keep_first=True, whole_characters=True, **options)
    done = done.where((F.col("n_removed") == 0) | (F.length(F.trim(F.decode("kept", "UTF-8"))) > 0))
    cut = F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    return columns_of(done, docs, text, cut)
