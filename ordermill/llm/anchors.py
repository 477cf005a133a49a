"""Windows of a text, the anchors that stand for them, and names by which windows compare.

A text is a sequence of units (words or bytes) in one array of bytes. Two windows of ``length`` units are equal if their
bytes are. Among the ``length - gram + 1`` grams inside a window the one with the smallest hash, the leftmost of equal
ones, is its anchor. The choice depends on the window's content alone: equal windows have equal anchors at equal offsets,
wherever they stand. Consecutive windows mostly share an anchor, so a text has far fewer anchors than windows, and an
anchor whose gram occurs nowhere else proves that none of its windows is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@lru_cache(maxsize=2)
def _letters(which: int) -> np.ndarray:
    return np.random.default_rng(0x5EED + which).integers(1, 1 << 63, 256, dtype=np.uint64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size, base = max(n, 1 << 16), int(_ODD[which])
        inverse = pow(base, -1, 1 << 64)
        both = []
        for x in (base, inverse):
            factors = np.full(size, np.uint64(x))
            factors[0] = 1
            both.append(np.cumprod(factors, dtype=np.uint64))
        _powers[which] = (both[0], both[1])
    return _powers[which][0][:n], _powers[which][1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BLOCK = 1 << 19


class _Hashes:
    """Hash of any stretch of ``data``, in constant time."""

    def __init__(self, data: np.ndarray, which: int):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        powers, self.inverse = _power(which, len(data) + 1)
        np.cumsum(_letters(which)[data] * powers[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each stretch of ``data``; starts and ends in order. Works in blocks, so memory stays small."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), _BLOCK)), [0, len(starts)]))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        low, high = int(starts[i]), int(ends[j - 1])
        out[i:j] = _Hashes(data[low:high], which).of(starts[i:j] - low, ends[i:j] - low)
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of texts begin and end; ``offsets`` are the texts' first bytes and the last one's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_GAP[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~border[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~border[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other with one space behind each, and where they begin and end there."""
    sizes = ends - starts + 1
    new_ends = np.cumsum(sizes) - 1
    new_starts = new_ends - sizes + 1
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[new_ends] = False
    out[inside] = data[_covered(starts, ends, len(data))]
    return out, new_starts, new_ends


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).astype(bool)


@dataclass
class Units:
    """Units of a chunk's texts in ``data``: first and end byte of each, and the first unit of each text (and the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    texts: np.ndarray

    @staticmethod
    def of_words(data: np.ndarray, offsets: np.ndarray) -> Units:
        starts, ends = words(data, offsets)
        texts = np.searchsorted(starts, offsets)
        return Units(*joined(data, starts, ends), texts)

    @staticmethod
    def of_bytes(data: np.ndarray, offsets: np.ndarray) -> Units:
        at = np.arange(len(data) + 1, dtype=np.int32)
        return Units(data, at[:-1], at[1:], offsets)


@dataclass
class Anchors:
    """Anchors of a chunk in order: gram hash, unit at which the gram begins, first and last window that it stands for."""

    keys: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def find(units: Units, length: int, gram: int) -> Anchors:
    blocks = [_find(units, length, gram, low) for low in range(0, len(units.starts), _BLOCK)]
    blocks = [x for x in blocks if x is not None]
    if not blocks:
        none = np.zeros(0, np.int64)
        return Anchors(np.zeros(0, np.uint64), none, none, none)
    return Anchors(*[np.concatenate([b[k] for b in blocks]) for k in range(4)])


def _find(units: Units, length: int, gram: int, low: int) -> tuple[np.ndarray, ...] | None:
    """Anchors of the windows that begin in the block of units at ``low``."""
    high = min(low + _BLOCK, len(units.starts))
    first_text, last_text = np.searchsorted(units.texts, [low, high - 1], side="right") - 1
    borders = np.clip(units.texts[first_text : last_text + 2], low, high)
    room = np.repeat(units.texts[first_text + 1 : last_text + 2], np.diff(borders))
    begin = np.flatnonzero(np.arange(low, high) + length <= room)
    if not len(begin):
        return None
    n = min(high + length - 1, len(units.starts)) - low
    width = length - gram + 1
    grams = hash_spans(units.data, units.starts[low : low + n - gram + 1], units.ends[low + gram - 1 : low + n])
    mask = np.uint64(0xFFFFFFFF)  # the same for every chunk: the choice must not depend on a chunk's size
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: -(width - span)], least[width - span :])
    at = (least[begin] & mask).astype(np.int64)
    fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1)])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(begin)) - 1
    # the smallest hashes crowd at the low end: mixed again, keys are even over their range
    return mix(grams[at[first]]), at[first] + low, begin[first] + low, begin[last] + low


def windows(texts: np.ndarray, length: int) -> np.ndarray:
    """First units of all windows that lie within one text."""
    counts = np.maximum(np.diff(texts) - length + 1, 0)
    skip = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(texts[:-1] - skip, counts)


def spans_of(windows: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of the units inside windows that begin at ``windows``."""
    change = np.zeros(n + 1, np.int32)
    change[windows] += 1
    change[windows + length] -= 1
    return np.cumsum(change[:-1]) > 0
