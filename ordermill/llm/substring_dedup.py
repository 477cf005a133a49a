"""Substring dedup by prefix-partitioned windows. The dealt suffix tree is not built; see the README.

The suffixes of all texts (of words, from sampled places, see ``anchors``) are split into groups by prefixes of variable
length: the words of the anchor's gram, or for prefixes too frequent for one group the words of a whole window. Groups
are dealt to parts of bounded memory. A part orders the hashes of its windows: equal neighbours are what would be
leaves under a node at the depth of a whole window, i.e. repeated windows. ``removed`` lists their runs by document.

Every word covered by a window that starts anywhere else too is removed, first occurrence included, judged on the
input (``keep_first=True`` leaves the first occurrence by ``order``, then input order).

Defined results: NULL and empty texts have zero words and an empty ``kept``; texts shorter than a window lose nothing;
repeated rows are occurrences of their own, so each loses what it shares; an empty table gives an empty result. All
input columns are carried; an input column named like a result column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm import repeats
from ordermill.llm.anchors import Units
from ordermill.llm.chunks import CHUNK_BYTES, extended, finish, pack, text_buffer, with_answers

RESULT = ["n_words", "n_removed", "removed", "kept"]
WINDOW = 35
GRAM = 8


def deep_leaves(names: np.ndarray, checks: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that stand elsewhere too, and the first of each group of equal ones, by their hashes.

    A group is what would be the leaves below a node at the depth of a window; no tree is built. ``times`` counts the
    suffixes that a window stands for.
    """
    by = np.argsort(names, kind="stable")
    deep = (names[by][1:] == names[by][:-1]) & (checks[by][1:] == checks[by][:-1])
    node = np.concatenate([[0], np.cumsum(~deep)]) if len(by) else np.zeros(0, np.int64)
    leaves = np.bincount(node, weights=times[by]) if len(by) else np.zeros(0)
    repeated, first = np.zeros(len(by), bool), np.zeros(len(by), bool)
    repeated[by] = leaves[node] >= 2
    first[by] = np.concatenate([[True], ~deep]) if len(by) else False
    return repeated, first


def dedup(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    order: str | None = None,
    keep_first: bool = False,
    group_rows: int = repeats.GROUP_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``removed`` (first and end word of each run) and ``kept`` (text)."""
    docs = docs.drop(*[c for c in RESULT if c not in (text, order)])
    column = docs.columns.index(text)
    task = repeats.Task(
        column, docs.columns.index(order) if order else -1, Units.of_words, True, window, min(gram, window), keep_first, group_rows
    )
    chunks = pack(docs, text, "substring-chunks", chunk_bytes)
    answered = with_answers(chunks, repeats.repeated_windows(chunks, task, deep_leaves))
    schema = extended(docs.schema, f"n_words long, n_removed long, removed {repeats.SPANS}, kept string")

    def result(number: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        units = Units.of_words(*text_buffer(rows, column))
        gone = repeats.removed_units(answers, window, units)
        sums = np.concatenate([[0], np.cumsum(gone)])
        for name, values in (
            ("n_words", pa.array(np.diff(units.texts), pa.int64())),
            ("n_removed", pa.array(np.diff(sums[units.texts]), pa.int64())),
            ("removed", repeats.spans_column(*repeats.spans_by_text(gone, units.texts))),
            ("kept", kept_words(units, gone)),
        ):
            rows = rows.append_column(name, values)
        return rows

    return finish(answered, result, schema)


def kept_words(units: Units, gone: np.ndarray) -> pa.Array:
    """The words that are left of each text, joined by one space."""
    left = np.flatnonzero(~gone)
    ends_text = np.searchsorted(left, units.texts)
    sizes = units.ends[left] - units.starts[left] + 1
    last = np.zeros(len(left), bool)
    full = ends_text[1:] > ends_text[:-1]
    last[ends_text[1:][full] - 1] = True
    sums = np.concatenate([[0], np.cumsum(sizes - last)])
    mask = np.repeat(~gone, units.ends - units.starts + 1)
    mask[units.ends[left[last]]] = False
    data = units.data[mask]
    return pa.StringArray.from_buffers(
        len(units.texts) - 1, pa.py_buffer(sums[ends_text].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
