from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordermill.llm import language_id, registry
from ordermill.llm.anchors import mix

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = registry.QUERIES["op4_language_id"](spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    judged = [r for r in found if r["held_out"] and len(r["text"]) >= 20]
    right = sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged)
    assert right >= 0.98, right
    assert all(0 <= r["score"] <= 1 for r in found) and {r["lang_pred"] for r in found} <= {"en", "fr", "de", "es"}


def test_defined_cases_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    odd = [(1, None), (2, ""), (3, "123 !? \n"), (4, "日本語日本語日本語"), (None, "the"), (6, "the"), (7, "the and of " * 100_000)]
    asked = spark.createDataFrame(odd, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = language_id.predict(asked, model).collect()
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and all(by[k]["score"] == 0 for k in (1, 2, 3))
    assert by[4]["rejected"] and not by[7]["rejected"]
    assert by[7]["lang_pred"] == by[6]["lang_pred"] == by[None]["lang_pred"] == "en"
    assert language_id.predict(asked.limit(0), model).count() == 0
    assert language_id.fit(docs.where("lang = 'xx'")) is None
    assert {r["lang_pred"] for r in language_id.predict(asked, None).collect()} == {"und"}


def test_sample_ends_are_ranked_within_one_range_of_hashes(spark):
    one = spark.range(20_000).select(F.lit("en").alias("lang"), F.xxhash64("id").alias("h"))
    few = spark.range(50).select(F.lit("fr").alias("lang"), F.xxhash64("id").alias("h"))
    hashes = one.union(few)
    every = {name: sorted(r["h"] for r in hashes.collect() if r["lang"] == name) for name in ("en", "fr")}
    for n in (1, 100, 1500, 19_999, 30_000):
        assert language_id._tops(hashes, n) == {name: h[min(n, len(h)) - 1] for name, h in every.items()}
        assert language_id._candidates(hashes, n).count() <= 100
    assert language_id._tops(hashes.limit(0), 10) == {}


def test_chances_add_up():
    """For any context, seen or not, the symbols and one unknown have probabilities that add up to one."""
    texts = pa.array(["abba cab", "bac abc abba", "cc b"])
    words = language_id.Words.of(texts)
    packed, word = words.grams()
    count = np.bincount(words.word, minlength=len(words.borders) - 1)[word]
    half = np.arange(len(packed)) % 2
    model = language_id.train(["x", "y"], np.concatenate([packed, packed[half == 0]]), np.concatenate([np.zeros(len(packed), int), np.ones(int((half == 0).sum()), int)]), np.concatenate([count, count[half == 0]]))
    symbols = np.unique(packed & np.uint64(0xFFF))
    contexts = np.unique(np.concatenate([packed >> np.uint64(12), np.array([0x777_777_777_777], np.uint64)]))
    for context in contexts:
        asked = (context << np.uint64(12)) | np.append(symbols, np.uint64(0xFFE))
        total = np.exp(model.log_probability(asked).astype(float)).sum(axis=0)
        assert np.allclose(total, 1.0, atol=1e-4), (hex(int(context)), total)
    assert len(np.unique(mix(packed))) == len(np.unique(packed))


def test_result_does_not_depend_on_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    model = language_id.fit(docs)
    alone = {r["doc_id"]: r["score"] for r in language_id.predict(docs.repartition(20), model).collect()}
    together = {r["doc_id"]: r["score"] for r in language_id.predict(docs.coalesce(1), model).collect()}
    assert all(abs(alone[k] - together[k]) < 1e-9 for k in alone)
