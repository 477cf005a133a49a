"""Windows that occur more than once in a corpus: the two rounds that substring and suffix-array dedup share.

Round one counts the anchors' grams over all chunks. An anchor whose gram occurs once ends here, with all its windows.
Round two sends each repeated anchor's context, the stretch of text that holds its windows, to the part of its gram: the
gram is the prefix by which suffixes are split into groups. Equal contexts of a chunk travel once, with the places
where they stand. A prefix with more than ``group_rows`` occurrences would make too large a group; its windows are
split by the longest prefix there is, the whole window, of which two 64-bit hashes are sent, once for each chunk with the
number of its occurrences and the first of them; the chunk applies the answer to all of its own. So one key, source or
group of copies never fills a group, and nothing is left out.

What a part does with the windows it holds is the caller's method: ``judge`` gets the windows' names in the order of
their first occurrence and tells which have another occurrence, and which of these is the first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from ordermill.llm import anchors
from ordermill.llm.anchors import Units, hash_spans
from ordermill.llm.chunks import (
    ask, expand, n_parts, pack_arrays, pack_sorted, part_of, slices_by_part, squeeze, text_buffer, unpack_arrays,
    unpack_sorted, with_answers,
)

ANCHORS_PART_BYTES = 64 << 20
CONTEXTS_PART_BYTES = 4 << 20
GROUP_ROWS = 50_000
_WINDOWS = 1 << 18  # that are hashed at once
LAST = np.int64(2**63 - 1)


@dataclass(frozen=True)
class Task:
    """``text`` and ``order`` are column numbers; ``units`` cuts texts; windows have ``length`` units."""

    text: int
    order: int
    units: Callable[[np.ndarray, np.ndarray], Units]
    words: bool
    length: int
    gram: int
    keep_first: bool
    group_rows: int = GROUP_ROWS


# (names, second names) of windows in order of first occurrence, and how often each one's context occurs
# -> mask of windows that occur elsewhere too, mask of those that are the first occurrence
Judge = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def repeated_windows(chunks: DataFrame, task: Task, judge: Judge) -> DataFrame:
    """Answers by chunk: first units of the windows to remove, as runs."""
    few, many = n_parts(chunks, ANCHORS_PART_BYTES), n_parts(chunks, CONTEXTS_PART_BYTES)
    counted = ask(chunks, lambda n, rows, _: _count_question(rows, task, few), _count_answer)
    asked = with_answers(chunks, counted)
    return ask(asked, lambda n, rows, a: _context_question(rows, a, task, many), lambda b: _context_answer(b, task, judge))


def _units(rows: pa.Table, task: Task) -> tuple[Units, anchors.Anchors]:
    units = task.units(*text_buffer(rows, task.text))
    return units, anchors.find(units, task.length, task.gram)


def _count_question(rows: pa.Table, task: Task, parts: int) -> list[tuple[int, bytes]]:
    keys, counts = np.unique(_units(rows, task)[1].keys, return_counts=True)
    return [
        (part, pack_arrays(pack_sorted(keys[a:b]), counts[a:b].astype(np.uint32)))
        for part, a, b in slices_by_part(keys, parts)
    ]


def _count_answer(bodies: list[bytes]) -> list[bytes]:
    pairs = [unpack_arrays(b, np.uint64, np.uint32) for b in bodies]
    keys = [unpack_sorted(steps) for steps, _ in pairs]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, weights=np.concatenate([c for _, c in pairs]))
    found = np.minimum(totals[place], 2**32 - 1).astype(np.uint32)
    return [pack_arrays(x) for x in np.split(found, np.cumsum([len(k) for k in keys])[:-1])]


def _order(rows: pa.Table, task: Task) -> np.ndarray:
    if task.order < 0 or not pa.types.is_integer(rows.schema.field(task.order).type):
        return np.zeros(rows.num_rows, np.int64)
    column = rows.column(task.order).cast(pa.int64())
    return np.asarray(pa.compute.fill_null(column, int(LAST))).astype(np.int64)


def _context_question(rows: pa.Table, answers: dict[int, bytes], task: Task, parts: int) -> list[tuple[int, bytes]]:
    units, found = _units(rows, task)
    _, place = np.unique(found.keys, return_inverse=True)
    if not answers:
        return []
    counts = np.concatenate([unpack_arrays(answers[p], np.uint32)[0] for p in sorted(answers)])[place]
    text = np.searchsorted(units.texts, found.first, side="right") - 1
    order = _order(rows, task)[text]
    out: dict[int, list[np.ndarray | bytes]] = {}

    plain = np.flatnonzero((counts >= 2) & (counts <= task.group_rows))
    plain = plain[np.argsort(found.keys[plain], kind="stable")]
    data = units.data.tobytes()
    begin = units.starts[found.first[plain]].tolist()
    end = units.ends[found.last[plain] + task.length - 1].tolist()
    for part, a, b in slices_by_part(found.keys[plain], parts):
        places: dict[bytes, list[int]] = {}
        for k in range(a, b):
            places.setdefault(data[begin[k] : end[k]], []).append(k)
        here = plain[[k for ks in places.values() for k in ks]]
        out[part] = [
            np.array([len(c) for c in places], np.uint32),
            np.array([len(ks) for ks in places.values()], np.uint32),
            found.first[here], order[here], np.frombuffer(b"".join(places), np.uint8),
        ]

    hot = np.flatnonzero(counts > task.group_rows)
    sizes = found.last[hot] - found.first[hot] + 1
    at = np.repeat(found.first[hot] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    first, second = (hash_spans(units.data, units.starts[at], units.ends[at + task.length - 1], k) for k in (0, 1))
    hot_order = np.repeat(order[hot], sizes)
    by = np.lexsort((at, hot_order, second, first))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (first[by][1:] != first[by][:-1]) | (second[by][1:] != second[by][:-1])
    times = np.diff(np.append(np.flatnonzero(fresh), len(by)))
    by = by[fresh]
    at, first, second, hot_order = at[by], first[by], second[by], hot_order[by]
    empty = [np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)]
    none = [np.zeros(0, kind) for kind in _KINDS[5:]]
    for part in out:
        out[part] += none
    for part, a, b in slices_by_part(first, parts):
        out[part] = out.get(part, [*empty, *none])[:5] + [pack_sorted(first[a:b]), second[a:b], at[a:b], hot_order[a:b], times[a:b]]
    return [(part, pack_arrays(*arrays)) for part, arrays in out.items()]


_KINDS = (np.uint32, np.uint32, np.int64, np.int64, np.uint8, np.uint64, np.uint64, np.int64, np.int64, np.int64)


def _context_answer(bodies: list[bytes], task: Task, judge: Judge) -> list[bytes]:
    """For each chunk, (first window, number of windows) of the runs to remove, and hashes of windows to remove all over the
    chunk but at one place, if it is not negative."""
    messages = [unpack_arrays(b, *_KINDS) for b in bodies]
    removed: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in bodies]
    wide = [[np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)] for _ in bodies]

    # contexts, equal ones of different chunks as one; occurrences (message, first window, order)
    numbers: dict[bytes, int] = {}
    owner = []
    for lengths, _, _, _, data, *_ in messages:
        raw, cuts = data.tobytes(), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).tolist()
        owner.append([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(cuts[:-1], cuts[1:])])
    if numbers:
        context = np.concatenate([np.repeat(np.array(o, np.int64), m[1]) for o, m in zip(owner, messages)])
        sender = np.repeat(np.arange(len(messages)), [len(m[2]) for m in messages])
        start = np.concatenate([m[2] for m in messages])
        order = np.concatenate([m[3] for m in messages])
        by = np.lexsort((start, sender, order, context))
        context, sender, start, order = context[by], sender[by], start[by], order[by]
        is_first = np.concatenate([[True], context[1:] != context[:-1]])
        times = np.bincount(context)
        heads = np.flatnonzero(is_first)
        ranked = np.lexsort((start[heads], sender[heads], order[heads]))  # contexts by first occurrence
        texts = list(numbers)
        data = np.frombuffer(b"".join(texts[c] for c in ranked), np.uint8)
        sizes = np.array([len(texts[c]) for c in ranked], np.int64)
        borders = np.concatenate([[0], np.cumsum(sizes)])
        if task.words:
            starts, ends = anchors.words(data, borders)
        else:
            starts = np.arange(len(data), dtype=np.int32)
            ends = starts + 1
        texts_at = np.searchsorted(starts, borders)
        begin = anchors.windows(texts_at, task.length)
        of = np.searchsorted(texts_at, begin, side="right") - 1
        spans = starts[begin], ends[begin + task.length - 1]
        names, checks = (hash_spans(data, *spans, k) for k in (0, 1))
        repeated, first = judge(names, checks, times[ranked][of])
        # the first occurrence of a context may hold first occurrences of windows, the others hold none
        place = np.empty(len(ranked), np.int64)
        place[ranked] = np.arange(len(ranked))
        for chosen, mask in ((~is_first, repeated), (is_first, repeated & ~first if task.keep_first else repeated)):
            run_of, run_at, run_size = _runs(mask, of, begin - texts_at[of])
            low = np.searchsorted(run_of, place[context[chosen]])
            high = np.searchsorted(run_of, place[context[chosen]], side="right")
            count = high - low
            pick = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            whose = np.repeat(sender[chosen], count)
            at = np.repeat(start[chosen], count) + run_at[pick]
            for k in np.unique(whose):
                removed[k].append((at[whose == k], run_size[pick][whose == k]))

    whose = np.repeat(np.arange(len(messages)), [len(m[5]) for m in messages])
    if len(whose):
        names = np.concatenate([unpack_sorted(m[5]) for m in messages])
        checks, at, order, times = (np.concatenate([m[k] for m in messages]) for k in (6, 7, 8, 9))
        by = np.lexsort((at, whose, order))
        repeated, first = np.zeros(len(by), bool), np.zeros(len(by), bool)
        repeated[by], first[by] = judge(names[by], checks[by], times[by])
        stays = np.where(first & task.keep_first, at, -1)
        gone = repeated & ((stays < 0) | (times > 1))
        for k in np.unique(whose[gone]):
            mine = gone & (whose == k)
            wide[k] = [names[mine], checks[mine], stays[mine]]

    return [
        pack_arrays(
            np.concatenate([a for a, _ in runs]) if runs else np.zeros(0, np.int64),
            np.concatenate([n for _, n in runs]).astype(np.uint32) if runs else np.zeros(0, np.uint32),
            pack_sorted(names), checks, stays,
        )
        for runs, (names, checks, stays) in zip(removed, wide)
    ]


def _runs(mask: np.ndarray, of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first window in it, number of windows) of each run of windows in ``mask``."""
    hit = np.flatnonzero(mask)
    if not len(hit):
        return (np.zeros(0, np.int64),) * 3
    fresh = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(hit)))
    return of[hit[heads]], at[hit[heads]], sizes


def removed_units(answers: dict[int, bytes], length: int, units: Units) -> np.ndarray:
    """Mask of the units of a chunk that the windows in ``answers`` cover."""
    change = np.zeros(len(units.starts) + 1, np.int64)
    wide = []
    for body in answers.values():
        at, count, *found = unpack_arrays(body, np.int64, np.uint32, np.uint64, np.uint64, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + count.astype(np.int64) + length - 1, -1)
        if len(found[0]):
            wide.append((unpack_sorted(found[0]), *found[1:]))
    if wide:
        at = _occurrences(units, length, *(np.concatenate(x) for x in zip(*wide)))
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def _occurrences(units: Units, length: int, names: np.ndarray, checks: np.ndarray, stays: np.ndarray) -> np.ndarray:
    """First units of the windows with these hashes, without the places that stay."""
    by = np.lexsort((checks, names))
    names, checks, stays = names[by], checks[by], stays[by]
    every, found = anchors.windows(units.texts, length), [np.zeros(0, np.int64)]
    for low in range(0, len(every), _WINDOWS):
        at = every[low : low + _WINDOWS]
        hashed = hash_spans(units.data, units.starts[at], units.ends[at + length - 1], 0)
        place = np.searchsorted(names, hashed)
        hit = np.flatnonzero(names[np.minimum(place, len(names) - 1)] == hashed)
        at, hashed, place = at[hit], hashed[hit], place[hit]
        check = hash_spans(units.data, units.starts[at], units.ends[at + length - 1], 1)
        while len(at):  # a second time only if names are equal and checks are not
            same = checks[place] == check
            found.append(at[same & (stays[place] != at)])
            on = ~same & (place + 1 < len(names)) & (names[np.minimum(place + 1, len(names) - 1)] == hashed)
            at, hashed, place, check = at[on], hashed[on], place[on] + 1, check[on]
    return np.concatenate(found)


def spans_by_text(mask: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal removed runs within each text: offsets by text, and first and end unit within the text."""
    border = np.zeros(len(mask) + 1, bool)
    border[texts] = True
    before = np.concatenate([[False], mask[:-1]]) & ~border[:-1] if len(mask) else mask
    after = np.concatenate([mask[1:], [False]]) & ~border[1:] if len(mask) else mask
    first, end = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    offsets = np.searchsorted(first, texts)
    shift = np.repeat(texts[:-1], np.diff(offsets))
    return offsets, first - shift, end - shift


def spans_column(offsets: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    items = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(end, pa.int64())], ["first", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


SPANS = "array<struct<first:bigint,end:bigint>>"

__all__ = ["Task", "Units", "expand", "part_of", "repeated_windows", "removed_units", "spans_by_text", "spans_column", "squeeze"]
