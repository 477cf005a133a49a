"""Interaction of filters, from count-weighted decision diagrams of failure masks.

Every document has a mask: which filters it fails. Documents are counted by part and mask, and each part's counts become a
decision diagram with one level per filter; a branch says pass or fail, and leaves hold counts. Equal branches are one node.
The diagram is made once, in one order of the filters, and then goes through all orders by swaps of neighbouring levels,
one swap from each order to the next. In the order that the levels have, the path on which all filters pass shows every
step: the weight of the failing branch is what the step removes, that of the passing branch what is left.

The filters of ``text_filters``: A too few words, B too few different words, C too many capital letters, D a symbol of
markup, E a copy of the text of a smaller id anywhere in the table.

Whole texts are read in one pass, which leaves a digest and a mask; copies are found on the digests (SHA-256). The first
of a group of copies is found with partial minima, so a text that fills a third of the table moves one row per task.

Defined results: NULL text is empty, NULL part is ''; rows of one id and the same text are no copies of each other; a NULL
id is smaller than none and has no smaller one, and has no labels; an id with several labels has those that any of them
gives; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.anchors import words
from ordermill.llm.chunks import pieces, text_buffer
from ordermill.session import keep

FILTERS = "ABCDE"
MIN_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

Counts = tuple[int, ...]


class Diagram:
    """Counts by mask as a diagram. A node is a number; ``ZERO`` stands for any branch without documents.

    ``levels`` is the order of the variables from the root. ``leaf[node]`` are a leaf's counts, ``branch[node]`` the level's
    variable with the passing and the failing branch. Nodes of equal content are one node, and a node never changes, so a
    swap makes what is new on two levels and leaves everything below.
    """

    ZERO = 0

    def __init__(self, variables: str, counts: dict[int, Counts]):
        """``counts`` by mask; bit i of a mask stands for a failure of ``variables[i]``."""
        self.levels = list(variables)
        self.width = len(next(iter(counts.values()), (0,)))
        self.leaf: dict[int, Counts] = {}
        self.branch: dict[int, tuple[str, int, int]] = {}
        self._numbers: dict[tuple, int] = {}
        self._weights: dict[int, Counts] = {self.ZERO: (0,) * self.width}
        self.root = self._built(0, 0, counts)

    def _built(self, level: int, mask: int, counts: dict[int, Counts]) -> int:
        if level == len(self.levels):
            found = counts.get(mask)
            return self._number(found) if found and any(found) else self.ZERO
        passed = self._built(level + 1, mask, counts)
        return self._node(self.levels[level], passed, self._built(level + 1, mask | 1 << level, counts))

    def _number(self, content: tuple) -> int:
        number = self._numbers.setdefault(content, len(self._numbers) + 1)
        (self.branch if isinstance(content[0], str) else self.leaf)[number] = content
        return number

    def _node(self, variable: str, passed: int, failed: int) -> int:
        return self._number((variable, passed, failed)) if passed or failed else self.ZERO

    def weight(self, node: int) -> Counts:
        """Counts of all documents below a node."""
        if node not in self._weights:
            if node in self.leaf:
                self._weights[node] = self.leaf[node]
            else:
                _, passed, failed = self.branch[node]
                self._weights[node] = tuple(a + b for a, b in zip(self.weight(passed), self.weight(failed)))
        return self._weights[node]

    def branches(self, node: int) -> tuple[int, int]:
        return self.branch[node][1:] if node else (self.ZERO, self.ZERO)

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and the next one."""
        upper, lower = self.levels[level : level + 2]
        made: dict[int, int] = {}

        def turned(node: int) -> int:
            (pp, pf), (fp, ff) = (self.branches(n) for n in self.branches(node))
            return self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))

        def rebuilt(node: int, depth: int) -> int:
            if not node:
                return self.ZERO
            if node not in made:
                if depth == level:
                    made[node] = turned(node)
                else:
                    variable, passed, failed = self.branch[node]
                    made[node] = self._node(variable, rebuilt(passed, depth + 1), rebuilt(failed, depth + 1))
            return made[node]

        self.root = rebuilt(self.root, 0)
        self.levels[level], self.levels[level + 1] = lower, upper

    def steps(self) -> list[tuple[str, Counts, Counts]]:
        """(variable, kept, removed) along the path on which everything passes, in the order of the levels."""
        found, node = [], self.root
        for variable in self.levels:
            node, failed = self.branches(node)
            found.append((variable, self.weight(node), self.weight(failed)))
        return found

    def failing(self, variable: str, only: bool = False) -> Counts:
        """Counts of all that fail ``variable``; with ``only``, of those that pass all others."""
        seen: dict[tuple[int, int], Counts] = {}

        def below(node: int, depth: int) -> Counts:
            if not node or depth == len(self.levels):
                return self.weight(node)
            if (node, depth) not in seen:
                passed, failed = self.branches(node)
                here = self.levels[depth] == variable
                ways = [failed] if here else [passed] if only else [passed, failed]
                seen[node, depth] = tuple(map(sum, zip(*(below(n, depth + 1) for n in ways))))
            return seen[node, depth]

        return below(self.root, 0)


def swaps(n: int) -> Iterator[int]:
    """Places of neighbours to exchange so that n things go through all their orders (plain changes)."""
    if n < 2:
        return
    inner = list(swaps(n - 1))
    for turn in range(len(inner) + 1):
        down = turn % 2 == 0  # the last thing walks from its end to the other
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if turn < len(inner):
            yield inner[turn] + down


def order_steps(filters: str, counts: dict[int, Counts]) -> list[dict]:
    """One row per order and step. Each entry of ``counts`` is (documents, good ones, toxic ones)."""
    diagram = Diagram(filters, counts)
    rows = []
    total = {f: diagram.failing(f)[0] for f in filters}
    unique = {f: diagram.failing(f, only=True)[0] for f in filters}
    shapley: dict[str, int] = defaultdict(int)

    def read() -> None:
        order = "".join(diagram.levels)
        for step, (f, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[f] += removed[0]
            rows.append(
                {
                    "filter_order": order, "step": step, "kept": kept[0], "removed": removed[0],
                    "redundant": total[f] - removed[0], "unique_fails": unique[f], "good_lost": removed[1], "toxic_lost": removed[2],
                }
            )

    read()
    for level in swaps(len(filters)):
        diagram.swap(level)
        read()
    for row in rows:
        row["shapley"] = shapley[row["filter_order"][row["step"] - 1]]
    return rows


def _judged(batch: pa.RecordBatch, text: int) -> pa.RecordBatch:
    """Digest of each text, and its mask of the filters A to D."""
    rows = pa.Table.from_batches([batch])
    data, offsets = text_buffer(rows, text)
    starts, ends = words(data, offsets)
    by_text = np.searchsorted(starts, offsets)
    n_words = np.diff(by_text)
    # different words: equal words of a text stand together once they are sorted by text and number
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = np.ascontiguousarray(data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]) if len(data) else data
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)]).dictionary_encode()
    key = np.repeat(np.arange(len(n_words)), n_words) * max(1, len(coded.dictionary)) + np.asarray(coded.indices).astype(np.int64)
    key.sort()
    firsts = np.concatenate([[0], np.cumsum(np.diff(key, prepend=-1) != 0)])
    n_distinct = np.diff(firsts[by_text])

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])[offsets])

    n_chars = np.diff(np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])[offsets])
    fails = [n_words < MIN_WORDS, 100 * n_distinct < LEAST_DISTINCT * n_words, 100 * count(_CAPITAL) > MOST_CAPITALS * n_chars, count(_SYMBOL) > 0]
    mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
    digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    kept = [i for i in range(batch.num_columns) if i != text]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in kept), pa.array(digests, pa.binary()), pa.array(mask, pa.int32())],
        names=[*(batch.schema.names[i] for i in kept), "digest", "mask"],
    )


def text_filters(docs: DataFrame, text: Column, doc_id: Column, part: Column) -> DataFrame:
    """(doc_id, part, digest, mask): the filters A to D of each row, which look at one text only."""
    chosen = docs.select(doc_id.cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), text.cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                if piece.num_rows:
                    yield _judged(piece, 2)

    return chosen.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask of all five filters, ``E`` in the highest bit."""
    judged = text_filters(docs, F.col(text), F.col(doc_id), F.col(part))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    both = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    rows = keep(judged.join(marks, "doc_id", "left").select("doc_id", "part", "digest", "mask", *both), "judged")
    # rows of one id and text, which are no copies of each other, by what they count for
    same = rows.groupBy("digest", "doc_id", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    of_id = same.filter("doc_id IS NOT NULL").groupBy("digest", "doc_id").agg(F.collect_list(F.struct("part", "mask", "good", "toxic", "n")).alias("rows"))
    first = of_id.groupBy("digest").agg(F.min(F.struct("doc_id", "rows")).alias("first"))
    keys = ["part", "mask", "good", "toxic"]
    no_copy = first.select(F.inline("first.rows")).unionByName(same.filter("doc_id IS NULL").select(*keys, "n"))
    all_rows = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    copy = F.lit(1 << 4)
    signed = [
        no_copy.groupBy(*keys).agg(F.sum("n").alias("n")),
        all_rows.withColumn("mask", F.col("mask").bitwiseOR(copy)),
        no_copy.groupBy(*keys).agg((-F.sum("n")).alias("n")).withColumn("mask", F.col("mask").bitwiseOR(copy)),
    ]
    counted = signed[0].unionByName(signed[1]).unionByName(signed[2])
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """Every order of the five filters and every step of it, for each part: what is kept, removed and lost."""
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

    def steps(table: pa.Table) -> pa.Table:
        counts = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in table.to_pylist()}
        name = table["part"][0].as_py()
        rows = [{"part": name, **row} for row in order_steps(FILTERS, counts)]
        kinds = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in list(rows[0])[3:])])
        return pa.Table.from_pylist(rows, kinds)

    # at most 32 masks a part
    return mask_counts(docs, labels, text, doc_id, part).groupBy("part").applyInArrow(steps, schema)
