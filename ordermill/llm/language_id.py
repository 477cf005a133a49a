"""Language identification with interpolated Kneser-Ney character models.

Each language has a model of its words: a word is its letters, lower-cased, with borders; the chance of each letter and of
the closing border given the ``ORDER - 1`` symbols before it comes from an n-gram model with absolute discounts, whose
lower orders count in how many contexts a symbol goes on. Models are sorted arrays of n-gram hashes with one column of
log probabilities per language, looked up by binary search; a miss backs off to the next order. A text belongs to the
language with the lowest cross-entropy per symbol.

Calibration on labelled texts that the models have not seen fixes two things: the sharpness with which entropies turn into
a score between 0 and 1, and the entropy above which ``rejected`` says that the text is in none of the languages.

The models are learned from a sample of labelled rows: for each language at most ``SAMPLE_ROWS`` distinct rows, those with
the smallest hash. Its words are counted by Spark; what reaches the driver, and each task, is bounded by that sample.
Prediction reads whole texts and only them; it is one pass without a shuffle, and each distinct word of a batch is
looked up once.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every text if nothing could be
learned; NULL languages teach nothing; ties go to the first language in alphabetical order; repeated rows are judged
alike. All input columns are carried; an input column named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.anchors import mix
from ordermill.llm.chunks import extended, pieces
from ordermill.session import keep

RESULT = ["lang_pred", "score", "rejected"]
ORDER = 5
SAMPLE_ROWS = 1_500
RANGES, RANGE_ROWS = 1024, 50_000  # ranges of hashes in which the end of a sample is looked for: at least so many, of about so many rows
CALIBRATION_PART = 5  # one in so many sampled rows calibrates
REJECT_SHARE = 0.001
UNKNOWN = "und"
_BITS = np.uint64(12)
_SYMBOLS = 1 << 12
_BORDER = 1
_SLICE = 1 << 20


def _symbols(text: str) -> np.ndarray:
    """A number for each character: 0 unless it is a letter, else a hash of its small form."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    used, place = np.unique(points, return_inverse=True)
    table = np.zeros(len(used), np.uint16)
    for i, point in enumerate(used.tolist()):
        char = chr(point)
        if char.isalpha():
            table[i] = 2 + (ord(char.lower()[0]) * 0x9E3779B1 >> 7) % (_SYMBOLS - 2)
    return table[place]


@dataclass
class Words:
    """Distinct words of some texts, as symbols, and how often each stands in which text."""

    symbols: np.ndarray
    borders: np.ndarray
    text: np.ndarray
    word: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Words:
        texts = pc.fill_null(texts, "")
        sizes = np.asarray(pc.utf8_length(texts)).astype(np.int64) + 1
        symbols = _symbols("\n".join(texts.to_pylist()) + "\n")
        letter = symbols != 0
        before = np.concatenate([[False], letter[:-1]])
        starts = np.flatnonzero(letter & ~before)
        ends = np.flatnonzero(~letter & before)
        ends_text = np.cumsum(sizes)
        borders = np.concatenate([[0], np.cumsum(ends - starts)])
        packed = np.ascontiguousarray(symbols[letter]).view(np.uint8)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer((borders * 2).astype(np.int64)), pa.py_buffer(packed)]
        )
        found = column.dictionary_encode()
        distinct = pa.concat_arrays([found.dictionary]) if len(found.dictionary) else found.dictionary
        if not len(distinct):
            none = np.zeros(0, np.int64)
            return Words(np.zeros(0, np.uint16), np.zeros(1, np.int64), none, none)
        cuts = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
        body = np.frombuffer(distinct.buffers()[2], np.uint8)[: cuts[-1]].view(np.uint16)
        return Words(body, cuts // 2, np.searchsorted(ends_text, starts, side="right"), np.asarray(found.indices).astype(np.int64))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Packed n-grams of highest order, one for each letter and closing border, and the word of each."""
        sizes = np.diff(self.borders)
        pad = ORDER - 1
        first = np.arange(len(sizes)) * (pad + 1) + self.borders[:-1] + pad
        line = np.full(len(self.symbols) + len(sizes) * (pad + 1), _BORDER, np.uint64)
        word = np.repeat(np.arange(len(sizes)), sizes)
        line[np.arange(len(self.symbols)) + (word + 1) * (pad + 1) - 1] = self.symbols
        count = sizes + 1
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        packed = np.zeros(len(at), np.uint64)
        for back in range(pad, -1, -1):
            packed = (packed << _BITS) | line[at - back]
        return packed, np.repeat(np.arange(len(sizes)), count)


def _lower(packed: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` symbols."""
    return packed & np.uint64((1 << (12 * order)) - 1)


@dataclass
class Model:
    """By order, hashes of n-grams with log probabilities by language, and of contexts with log back-off weights."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    sharpness: float = 10.0
    limit: float = float("inf")

    def log_probability(self, packed: np.ndarray) -> np.ndarray:
        """A row by n-gram, a column by language."""
        out = np.empty((len(packed), len(self.languages)), np.float32)
        for first in range(0, len(packed), _SLICE):
            part = packed[first : first + _SLICE]
            out[first : first + _SLICE] = self._look_up(part)
        return out

    def _look_up(self, packed: np.ndarray) -> np.ndarray:
        out = np.zeros((len(packed), len(self.languages)), np.float32)
        left = np.arange(len(packed))
        for order in range(ORDER, 0, -1):
            keys, values = self.grams[order]
            place, hit = _find(keys, mix(_lower(packed[left], order)))
            out[left[hit]] += values[place[hit]]
            left = left[~hit]
            if not len(left):
                return out
            keys, weights = self.contexts[order]
            place, hit = _find(keys, mix(_lower(packed[left], order) >> _BITS))
            out[left[hit]] += weights[place[hit]]
        out[left] += self.floor
        return out

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text by language, and its number of symbols."""
        words = Words.of(texts)
        packed, word = words.grams()
        each = self.log_probability(packed)
        n_words, n = len(words.borders) - 1, len(texts)
        sizes = np.bincount(words.text, weights=(np.diff(words.borders) + 1)[words.word], minlength=n)
        total = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            by_word = np.bincount(word, weights=each[:, k], minlength=n_words)
            total[:, k] = np.bincount(words.text, weights=by_word[words.word], minlength=n)
        return -total / np.maximum(sizes, 1)[:, None], sizes


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return place, keys[place] == asked


def train(languages: list[str], packed: np.ndarray, language: np.ndarray, count: np.ndarray) -> Model:
    """Models from n-grams of highest order with their language and count."""
    n = len(languages)
    counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    keys, place = np.unique(packed, return_inverse=True)
    table = np.zeros((len(keys), n))
    np.add.at(table, (place, language), count)
    counts[ORDER] = keys, table
    for order in range(ORDER - 1, 0, -1):  # in how many contexts does the shorter n-gram go on?
        upper, above = counts[order + 1]
        keys, place = np.unique(_lower(upper, order), return_inverse=True)
        table = np.zeros((len(keys), n))
        np.add.at(table, place, above > 0)
        counts[order] = keys, table
    alphabet = len(counts[1][0]) + 1
    below = (np.zeros(1, np.uint64), np.full((1, n), 1.0 / alphabet))
    grams: list = [None]
    contexts: list = [None]
    for order in range(1, ORDER + 1):
        keys, table = counts[order]
        ones, twos = (table == 1).sum(axis=0), (table == 2).sum(axis=0)
        discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        context, place = np.unique(keys >> _BITS, return_inverse=True)
        total, kinds = np.zeros((len(context), n)), np.zeros((len(context), n))
        np.add.at(total, place, table)
        np.add.at(kinds, place, table > 0)
        seen = total > 0
        weight = np.where(seen, discount * kinds / np.maximum(total, 1), 1.0)
        lower = below[1][np.searchsorted(below[0], _lower(keys, order - 1))] if order > 1 else np.repeat(below[1], len(keys), axis=0)
        share = np.where(seen[place], np.maximum(table - discount, 0) / np.maximum(total, 1)[place], 0.0)
        chance = share + weight[place] * lower
        below = (keys, chance)
        for out, k, v in ((grams, keys, chance), (contexts, context, weight)):
            hashed = mix(k)
            by = np.argsort(hashed)
            out.append((hashed[by], np.log(np.maximum(v[by], 1e-12)).astype(np.float32)))
    return Model(languages, grams, contexts, np.full(n, -np.log(alphabet), np.float32))


def _candidates(hashes: DataFrame, sample_rows: int) -> DataFrame:
    """Of the distinct (lang, h), those in the range of hashes where a language's sample ends, and how many are ``before``."""
    ranges = max(RANGES, hashes.count() // RANGE_ROWS)
    number = F.shiftright((F.shiftright("h", 32) + F.lit(1 << 31)) * F.lit(ranges), 32)
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = hashes.groupBy("lang", number.alias("range")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < sample_rows)
    last = counts.groupBy("lang").agg(F.max("range").alias("range"), F.max("before").alias("before"))  # one row a language
    return hashes.withColumn("range", number).join(F.broadcast(last), ["lang", "range"])


def _tops(hashes: DataFrame, sample_rows: int) -> dict[str, int]:
    """The largest hash of each language's sample."""
    rank = F.col("before") + F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    limits = _candidates(hashes, sample_rows).withColumn("n", rank).where(F.col("n") <= sample_rows)
    return {r["lang"]: r["top"] for r in limits.groupBy("lang").agg(F.max("h").alias("top")).collect()}  # one row a language


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Models of the languages of ``labelled``; None if there is none."""
    body = F.col(f"`{text}`")
    rows = labelled.select(
        body.alias("text"), F.col(f"`{lang}`").alias("lang"), F.xxhash64(F.lit(11), F.col(f"`{id}`"), body).alias("h")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    tops = _tops(keep(rows.select("lang", "h").distinct(), "language-hashes"), sample_rows)
    if not tops:
        return None
    languages = sorted(tops)
    chosen = F.lit(False)
    for name in languages:
        chosen = chosen | ((F.col("lang") == name) & (F.col("h") <= tops[name]))
    sample = rows.where(chosen).withColumn("part", F.pmod(F.xxhash64("h"), F.lit(CALIBRATION_PART)))
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words.of(batch.column(0))
            tongue = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            packed, word = words.grams()
            pairs = np.bincount(tongue[words.text] + len(languages) * words.word, minlength=len(languages) * (len(words.borders) - 1))
            each = pairs.reshape(-1, len(languages))[word]
            for k in range(len(languages)):
                keys, place = np.unique(packed[each[:, k] > 0], return_inverse=True)
                times = np.bincount(place, weights=each[each[:, k] > 0, k], minlength=len(keys))
                yield pa.RecordBatch.from_pydict({
                    "gram": pa.array(keys.view(np.int64)), "lang": pa.array(np.full(len(keys), k, np.int32)), "n": pa.array(times.astype(np.int64)),
                })

    taught = sample.where("part != 0").select("text", "lang").mapInArrow(count, "gram long, lang int, n long")
    table = taught.groupBy("gram", "lang").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return None
    gram, tongue, n = (np.asarray(table.column(c).combine_chunks()) for c in ("gram", "lang", "n"))
    model = train(languages, gram.view(np.uint64), tongue, n)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropy, sizes = model.entropies(batch.column(0))
            tongue = pa.array([number[x] for x in batch.column(1).to_pylist()], pa.int32())
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(tongue) + 1) * len(languages), pa.int32()), pa.array(entropy.reshape(-1)))
            yield pa.RecordBatch.from_pydict({"lang": tongue, "entropy": found, "size": pa.array(sizes)})

    apart = sample.where("part = 0").dropDuplicates(["lang", "h"]).select("text", "lang")
    seen = apart.mapInArrow(measure, "lang int, entropy array<double>, size double").where("size > 0").toArrow()
    if seen.num_rows:
        _calibrate(model, np.asarray(seen.column("lang")), np.array(seen.column("entropy").to_pylist()))
    return model


def _calibrate(model: Model, tongue: np.ndarray, entropy: np.ndarray) -> None:
    own = entropy[np.arange(len(tongue)), tongue]
    model.limit = float(np.quantile(own, 1 - REJECT_SHARE))
    best, grid = -np.inf, np.geomspace(0.5, 200, 60)
    for sharpness in grid:
        gain = -sharpness * entropy
        fit = float((gain[np.arange(len(tongue)), tongue] - _log_sum(gain)).mean())
        if fit > best + 1e-9:
            best, model.sharpness = fit, float(sharpness)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    docs = docs.drop(*[c for c in RESULT if c != text])
    column = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                yield _judge(piece, column, shared.value)

    return docs.mapInArrow(run, extended(docs.schema, "lang_pred string, score double, rejected boolean"))


def _judge(batch: pa.RecordBatch, column: int, model: Model | None) -> pa.RecordBatch:
    n = batch.num_rows
    names, score, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
    if model is not None:
        entropy, sizes = model.entropies(batch.column(column))
        best = entropy.argmin(axis=1)
        gain = -model.sharpness * entropy
        sure = np.exp(gain[np.arange(n), best] - _log_sum(gain))
        known = sizes > 0
        names = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
        score = np.where(known, np.clip(sure, 0.0, 1.0), 0.0)
        rejected = ~known | (entropy[np.arange(n), best] > model.limit)
    for name, values in (("lang_pred", pa.array(names, pa.string())), ("score", pa.array(score)), ("rejected", pa.array(rejected))):
        batch = batch.append_column(name, values)
    return batch
