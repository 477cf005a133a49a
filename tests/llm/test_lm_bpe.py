from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import bpe, lm_scoring, registry

SF = "/root/testdata/sf0.001"
GAP = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (None, None), (1, ""), (2, " \t\n\x0b"), (3, "It's we'LL 12 34<|endoftext|>x  ÉÉ é ok z \x85y"),
    (3, "It's we'LL 12 34<|endoftext|>x  ÉÉ é ok z \x85y"), (4, "ΑΣ ΣΑΣ. İstanbul ß ﬁ 日本語 😀"), (None, "x" * 50_000), (5, "\x00 ­ a\u0000b"),
]


@pytest.mark.parametrize("stable", [False, True])
def test_bpe_equals_the_library(spark, tmp_path, stable):
    text = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(text)
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(ODD + real, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for digests in (False, True):
        got = bpe.encode(docs, text, chunk_bytes=20_000, stable=stable, digests=digests).collect()
        assert len(got) == len(ODD) + len(real)
        for r in got:
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            assert r["n_tokens"] == len(ids)
            if digests:
                assert r["ids"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                assert r["decoded"] == hashlib.sha256(decoded.encode()).hexdigest()
            else:
                assert list(r["ids"]) == ids and r["decoded"] == decoded
    assert bpe.encode(docs.limit(0), text).count() == 0


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in GAP.findall(text or "")] + ["</end>"]


def test_lm_counts_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [r for r in ODD if len(r[1] or "") < 1000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    found = lm_scoring.score(docs, registry.lm_fold(F.col("doc_id")), chunk_bytes=30_000)
    got = found.collect()
    assert len(got) == len(rows)
    kind = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 7
    learned = Counter(t for d, text in rows if kind(d) != 2 for t in tokens(text))
    n, v = sum(learned.values()), len(learned)
    gain = 0.0
    for r in got:
        own = tokens(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(t in learned for t in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((learned[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
        if kind(r["doc_id"]) == 2:
            gain += r["score"] - r["base_score"]
    assert gain > 0
    empty = lm_scoring.score(docs.limit(0), F.lit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_lm_is_a_distribution(spark):
    """Over all continuations of a context, and one unknown word, probabilities add up to one."""
    learn = [(i, "a b a c") for i in range(0, 40, 2)] + [(i, "b b a") for i in range(1, 40, 2)]
    ask = [(100, ""), (101, "a"), (102, "b"), (103, "c"), (104, "q")]
    fold = F.when(F.col("k") >= 100, lm_scoring.HELD_OUT).when(F.col("k") % 5 == 3, lm_scoring.WEIGHTS).otherwise(lm_scoring.LEARN)
    docs = spark.createDataFrame(learn + ask, "k long, text string")
    score = {r["k"]: r["score"] for r in lm_scoring.score(docs, fold).collect()}
    first = {w: score[k] for w, k in zip(["</end>", "a", "b", "c", "q"], range(100, 105))}
    # the end after "a", "b", "c", "q" is learned apart: P(w) = P(w, end) / P(end | w), checked through texts of two words
    more = [(200 + 5 * i + j, f"{w} {x}".strip()) for i, w in enumerate("abcq") for j, x in enumerate(["", "a", "b", "c", "q"])]
    both = {r["text"]: 10 ** r["score"] for r in lm_scoring.score(spark.createDataFrame(learn + more, "k long, text string"), fold).collect()}
    assert first["</end>"] < 0
    total = 10 ** first["</end>"]
    for w in "abcq":
        end = both[w]
        # P(w) * [P(end|w) + sum_x P(x|w) P(end|x)] with P(end|x) = both["x"] / P(x)
        follow = sum(both[f"{w} {x}"] / (both[x] / start) for x, start in _starts(both).items())
        total += end + follow
    assert math.isclose(total, 1.0, rel_tol=1e-6)


def _starts(both):
    """P(x) as the first word, from P("x x") = P(x) P(x|x) P(end|x) and the sums of the model: solved by iteration."""
    # texts "x": P(x) e(x); texts "w x": P(w) p(x|w) e(x); unknown P: use that P(x) p(x|w) = both["x"] both["w x"] ratios
    words = "abcq"
    start = dict.fromkeys(words, 0.2)
    for _ in range(2000):
        end = {x: both[x] / start[x] for x in words}
        # for each w: e(w) + sum_x p(x|w) = 1 with p(x|w) = both["w x"] / (start[w] e(x))
        start = {w: both[w] + sum(both[f"{w} {x}"] / end[x] for x in words) for w in words}
    return start


def test_registered_queries(spark):
    for name in ("op3_lm_scoring", "op9_bpe"):
        assert registry.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert os.path.exists(public_tokenizers.path("word_bpe_49k.json"))
