"""Scores of a language model by deleted interpolation.

The model mixes three estimates of a token's probability: its maximum-likelihood share after the token before it, its
maximum-likelihood share among all tokens, and the uniform share that also covers a token never seen. The weights depend
on how often the context was seen (buckets by powers of two) and are learned by expectation-maximisation on held-out
counts: tokens of texts that were set aside (fold ``WEIGHTS``), judged by counts without them. The final counts hold both
parts. A text is its words, lower-cased in A-Z, and one end token.

Counts of all word pairs live in parts of a hashed key space, never in one place: each chunk of texts sends its
distinct keys with their counts, each part adds up and answers (see ``chunks``). Only the weights, and sums by bucket and
quarter octaves of both shares for learning them, reach the driver; their number does not depend on the corpus.

Keys are 64-bit hashes of words and 56-bit hashes of pairs. Defined results: NULL and empty texts are one end token;
repeated rows count and score each; with no text to learn from, only the uniform share is left; an empty table gives an
empty result. All columns of the input are carried, columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.anchors import Units, hash_spans, mix
from ordermill.llm.chunks import (
    CHUNK_BYTES, ask, extended, finish, n_parts, pack, pack_arrays, pack_sorted, slices_by_part, text_buffer,
    unpack_arrays, unpack_sorted, with_answers,
)
from ordermill.session import keep

LEARN, WEIGHTS, HELD_OUT = 0, 1, 2
RESULT = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
PART_BYTES = 16 << 20
BUCKETS = 48
STEPS = 4  # of an octave
LOW = -256  # shares below 2^-64 fall into the last step
ROUNDS = 60

_END = np.uint64(0x5851F42D4C957F2D)
_BEGIN = np.uint64(0x14057B7EF767814F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Tokens:
    """Tokens of a chunk: text of each, its key, its context's key and the key of the pair."""

    def __init__(self, rows: pa.Table, text: int):
        data, offsets = text_buffer(rows, text)
        units = Units.of_words(_LOWER[data], offsets)
        words = np.diff(units.texts)
        self.counts = words + 1
        ends = np.cumsum(self.counts) - 1
        n = int(self.counts.sum())
        self.key = np.full(n, _END)
        inside = np.ones(n, bool)
        inside[ends] = False
        self.key[inside] = hash_spans(units.data, units.starts, units.ends)
        self.text = np.repeat(np.arange(len(words)), self.counts)
        self.context = np.concatenate([[_BEGIN], self.key[:-1]]) if n else self.key
        self.context[ends - words] = _BEGIN
        self.pair = mix(self.context * np.uint64(0x9E3779B97F4A7C15) + self.key) >> np.uint64(8)


def _asked(tokens: _Tokens, fold: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(distinct keys, their counts in LEARN texts, in WEIGHTS texts) for single tokens and for pairs."""
    found = []
    for keys in (tokens.key, tokens.pair):
        distinct, place = np.unique(keys, return_inverse=True)
        both = [np.bincount(place, weights=fold[tokens.text] == f, minlength=len(distinct)) for f in (LEARN, WEIGHTS)]
        found.append((distinct, *(b.astype(np.uint32) for b in both)))
    return found


def _question(rows: pa.Table, text: int, fold: int, parts: int) -> list[tuple[int, bytes]]:
    tokens = _Tokens(rows, text)
    out: dict[int, list[np.ndarray]] = {}
    none = [np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)]
    for kind, (keys, first, second) in enumerate(_asked(tokens, np.asarray(rows.column(fold)))):
        spread = keys << np.uint64(8) if kind else keys
        for part, a, b in slices_by_part(spread, parts):
            arrays = out.setdefault(part, [*none, *none])
            arrays[3 * kind : 3 * kind + 3] = [pack_sorted(keys[a:b]), first[a:b], second[a:b]]
    return [(part, pack_arrays(*arrays)) for part, arrays in out.items()]


_MESSAGE = (np.uint64, np.uint32, np.uint32) * 2


def _answer(bodies: list[bytes]) -> list[bytes]:
    messages = [unpack_arrays(b, *_MESSAGE) for b in bodies]
    replies: list[list[np.ndarray]] = [[] for _ in bodies]
    totals = np.zeros(0)
    for kind in (0, 3):
        keys = [unpack_sorted(m[kind]) for m in messages]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = [
            np.bincount(place, weights=np.concatenate([m[kind + k] for m in messages]), minlength=len(distinct)).astype(np.uint64)
            for k in (1, 2)
        ]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        for k, s in enumerate(sums):
            for reply, own in zip(replies, np.split(s[place], cuts)):
                reply.append(own)
        if kind == 0:
            both = sums[0] + sums[1]
            totals = np.array([sums[0].sum(), (sums[0] > 0).sum(), both.sum(), (both > 0).sum()], np.uint64)
    # the last reply carries the totals of the part
    return [pack_arrays(*r, totals if i == len(replies) - 1 else totals[:0]) for i, r in enumerate(replies)]


_REPLY = (np.uint64,) * 5


def _totals(answers: DataFrame) -> tuple[int, int, int, int]:
    """Tokens and distinct tokens, of LEARN texts and of all that are learned from."""

    def read(batches):
        for batch in batches:
            for given in batch.column(0):
                found = [unpack_arrays(x["body"], *_REPLY)[4] for x in given.as_py() or []]
                total = sum((t for t in found if len(t)), np.zeros(4, np.uint64))
                yield pa.RecordBatch.from_pydict({f"t{k}": pa.array([int(total[k])], pa.int64()) for k in range(4)})

    sums = answers.select("answers").mapInArrow(read, "t0 long, t1 long, t2 long, t3 long").agg(*[F.sum(f"t{k}") for k in range(4)])
    return tuple(int(x or 0) for x in sums.first())


class _Shares:
    """The three shares of each token of a chunk, the bucket of its context, and whether it was ever seen."""

    def __init__(self, tokens: _Tokens, answers: dict[int, bytes], totals: tuple[int, int, int, int], final: bool):
        n_tokens, n_distinct = totals[2:] if final else totals[:2]
        replies = [unpack_arrays(answers[p], *_REPLY) for p in sorted(answers)]
        counts = []
        for kind, keys in ((0, tokens.key), (2, tokens.pair)):
            distinct, place = np.unique(keys, return_inverse=True)
            known = np.concatenate([r[kind] + r[kind + 1] if final else r[kind] for r in replies])
            if len(known) != len(distinct):
                raise RuntimeError("the rows of a chunk are not those that asked: read the input from a stable source")
            counts.append(known[place].astype(np.float64))
            if kind == 0:
                end = known[np.searchsorted(distinct, _END)]
        self.token, pair = counts
        context = np.concatenate([[0.0], self.token[:-1]])
        context[tokens.context == _BEGIN] = float(end)  # as many texts begin as end
        self.context = context
        self.bigram = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
        self.unigram = self.token / n_tokens if n_tokens else np.zeros(len(pair))
        self.uniform = 1.0 / (n_distinct + 1)
        self.base = (self.token + 1.0) / (n_tokens + n_distinct + 1.0)
        self.bucket = np.minimum(np.log2(context + 1.0).astype(np.int64), BUCKETS - 1)


def _step(share: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(share > 0, np.maximum(np.floor(np.log2(share) * STEPS), LOW), LOW - 1).astype(np.int64)


def _learn_weights(asked: DataFrame, text: int, fold: int, totals: tuple[int, int, int, int]) -> np.ndarray:
    """Weights by bucket of (pair, token, uniform) shares."""
    span = -LOW + 2

    def count(number: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        tokens = _Tokens(rows, text)
        shares = _Shares(tokens, answers, totals, final=False)
        mine = np.asarray(rows.column(fold))[tokens.text] == WEIGHTS
        two, one = shares.bigram[mine], shares.unigram[mine]
        cell = (shares.bucket[mine] * span + _step(two) - LOW + 1) * span + _step(one) - LOW + 1
        distinct, place = np.unique(cell, return_inverse=True)
        return pa.table({
            "cell": pa.array(distinct, pa.int64()), "n": pa.array(np.bincount(place, minlength=len(distinct)), pa.int64()),
            "two": pa.array(np.bincount(place, weights=two, minlength=len(distinct)), pa.float64()),
            "one": pa.array(np.bincount(place, weights=one, minlength=len(distinct)), pa.float64()),
        })

    cells = finish(asked, count, "cell long, n long, two double, one double")
    # integers add up alike in any order; shares are added as such after rounding
    rows = cells.groupBy("cell").agg(
        F.sum("n"), F.sum((F.col("two") * 2**40).cast("decimal(38,0)")), F.sum((F.col("one") * 2**40).cast("decimal(38,0)"))
    ).orderBy("cell").collect()
    weights = np.tile(np.array([0.5, 0.4, 0.1]), (BUCKETS, 1))
    if not rows:
        return weights
    cell, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    share = np.array([[float(r[2]), float(r[3])] for r in rows]) / 2**40 / n[:, None]
    share = np.column_stack([share, np.full(len(n), 1.0 / (totals[1] + 1))])
    bucket = cell // (span * span)
    for _ in range(ROUNDS):
        mixed = share * weights[bucket]
        belongs = mixed / mixed.sum(axis=1, keepdims=True) * n[:, None]
        for b in np.unique(bucket):
            # one imagined token of each kind keeps every weight above zero
            mass = belongs[bucket == b].sum(axis=0) + 1.0
            weights[b] = mass / mass.sum()
    return weights


def score(docs: DataFrame, fold: Column, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` with the counts and log10 scores of each text. ``fold``: LEARN, WEIGHTS or HELD_OUT (NULL: LEARN)."""
    docs = docs.drop(*[c for c in RESULT if c != text])
    folded = docs.withColumn("__fold", F.coalesce(fold, F.lit(LEARN)).cast("int"))
    column, place = docs.columns.index(text), len(docs.columns)
    # texts for learning the weights in chunks of their own, so that learning reads no others
    chunks = pack(folded.where(F.col("__fold") == WEIGHTS), text, "lm-weights", chunk_bytes, base=1 << 60)
    others = pack(folded.where(F.col("__fold") != WEIGHTS), text, "lm-chunks", chunk_bytes)
    both = chunks.unionByName(others)
    parts = n_parts(both, PART_BYTES)
    answers = keep(ask(both, lambda n, rows, _: _question(rows, column, place, parts), _answer), "lm-answers")
    totals = _totals(answers)
    weights = _learn_weights(chunks.join(answers, "chunk"), column, place, totals)

    def result(number: int, rows: pa.Table, answered: dict[int, bytes]) -> pa.Table:
        tokens = _Tokens(rows, column)
        shares = _Shares(tokens, answered, totals, final=True)
        w = weights[shares.bucket]
        mixed = w[:, 0] * shares.bigram + w[:, 1] * shares.unigram + w[:, 2] * shares.uniform
        # where a share is impossible (context never seen, nothing learned), its weight goes to the others
        possible = w[:, 0] * (shares.context > 0) + w[:, 1] * (totals[2] > 0) + w[:, 2]
        model = np.log10(mixed / possible)
        n = rows.num_rows
        by_text = lambda x: np.bincount(tokens.text, weights=x, minlength=n)
        rows = rows.drop_columns(["__fold"])
        for name, values in (
            ("n_tokens", pa.array(tokens.counts, pa.int64())),
            ("n_known", pa.array(by_text(shares.token > 0).astype(np.int64))),
            ("train_tokens", pa.array(np.full(n, totals[2]), pa.int64())),
            ("base_score", pa.array(by_text(np.log10(shares.base)))),
            ("score", pa.array(by_text(model))),
        ):
            rows = rows.append_column(name, values)
        return rows

    schema = extended(docs.schema, "n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return finish(with_answers(both, answers), result, schema)


__all__ = ["HELD_OUT", "LEARN", "WEIGHTS", "score"]
