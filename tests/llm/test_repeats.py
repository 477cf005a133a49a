from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ordermill.llm import chunks, repeats, simhash, substring_dedup, suffix_array_dedup
from ordermill.llm.anchors import Units
from ordermill.llm.chunks import pack_arrays, unpack_arrays

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int, n: int = 60) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    vocabulary = ["a", "b", "cc", "dé", "e", "ff", "日本", "h"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 30))) for _ in range(6)]
    rows: list[tuple[int | None, str | None]] = [(None, None), (1, ""), (2, " \n\t "), (3, "a"), (3, "a")]
    for i in range(n):
        pieces = []
        for _ in range(rng.randint(1, 5)):
            pieces.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 20))))
        rows.append((rng.choice([i, i, 7, None]), rng.choice([" ", "\n", "  "]).join(pieces)))
    rows += [(100 + i, rows[9][1]) for i in range(15)]
    rows.append((200, "a " * 300))
    return rows


def brute(texts: list[list], length: int, keep_first: bool) -> list[list[bool]]:
    """Mask of removed units; ``texts`` are in the order that decides what comes first."""
    places = defaultdict(list)
    for d, units in enumerate(texts):
        for i in range(len(units) - length + 1):
            places[tuple(units[i : i + length])].append((d, i))
    gone = [[False] * len(units) for units in texts]
    for at in places.values():
        for d, i in at[1:] if keep_first else at if len(at) > 1 else []:
            gone[d][i : i + length] = [True] * length
    return gone


@pytest.mark.parametrize("seed,group_rows,chunk_bytes", [(1, 50_000, 300), (2, 3, 300), (3, 1, 100_000), (4, 10, 2_000)])
def test_words_against_brute_force(spark, seed, group_rows, chunk_bytes):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, d, t, 7) for i, (d, t) in enumerate(rows)], "key long, doc_id long, text string, n_words int")
    found = substring_dedup.dedup(docs.repartition(3), window=12, gram=4, group_rows=group_rows, chunk_bytes=chunk_bytes)
    words = [GAP.findall(t or "") for _, t in rows]
    expect = brute(words, 12, False)
    got = {r["key"]: r for r in found.collect()}
    assert len(got) == len(rows) == found.count()
    for i, gone in enumerate(expect):
        r = got[i]
        assert (r["doc_id"], r["text"]) == rows[i]
        assert (r["n_words"], r["n_removed"]) == (len(words[i]), sum(gone))
        assert r["kept"] == " ".join(w for w, g in zip(words[i], gone) if not g)
        mask = [False] * len(gone)
        for s in r["removed"]:
            mask[s["first"] : s["end"]] = [True] * (s["end"] - s["first"])
        assert mask == gone


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("seed,group_rows,chunk_bytes", [(1, 50_000, 300), (2, 3, 300), (3, 1, 100_000), (4, 10, 2_000)])
def test_bytes_against_brute_force(spark, seed, group_rows, chunk_bytes, keep_first):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "key long, doc_id long, text string")
    found = suffix_array_dedup.dedup(
        docs.repartition(3), length=20, gram=7, order="key", keep_first=keep_first, group_rows=group_rows, chunk_bytes=chunk_bytes
    )
    raw = [list((t or "").encode()) for _, t in rows]
    expect = brute(raw, 20, keep_first)
    got = {r["key"]: r for r in found.collect()}
    for i, gone in enumerate(expect):
        assert (got[i]["n_bytes"], got[i]["n_removed"]) == (len(raw[i]), sum(gone))
        assert bytes(got[i]["kept"]) == bytes(b for b, g in zip(raw[i], gone) if not g)


def test_frequent_windows_travel_once_a_chunk():
    text = "one passage that very many documents of this chunk hold as it is"
    rows = pa.table({"text": [text] * 500})
    task = repeats.Task(0, -1, Units.of_words, True, 12, 4, False, group_rows=1)
    keys = np.unique(repeats._units(rows, task)[1].keys)
    answers = {0: pack_arrays(np.full(len(keys), 500, np.uint32))}
    [(_, body)] = repeats._context_question(rows, answers, task, 1)
    assert len(unpack_arrays(body, *repeats._KINDS)[5]) == len(text.split()) - 11
    [answer] = repeats._context_answer([body], task, substring_dedup.deep_leaves)
    units = repeats._units(rows, task)[0]
    assert repeats.removed_units({0: answer}, 12, units).all()


def test_empty_and_characters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup(empty).count() == 0 and suffix_array_dedup.dedup(empty).count() == 0
    text = "日本語テキスト" * 3 + "xyz"
    docs = spark.createDataFrame([(1, text), (2, "é" + text + "ü"), (None, None), (None, "q"), (3, text)], "doc_id long, text string")
    left = suffix_array_dedup.without_later_copies(docs, length=20, gram=5, chunk_bytes=64)
    assert left.columns == ["doc_id", "text"]
    rows = {r["doc_id"]: r["text"] for r in left.collect() if r["doc_id"]}
    assert 3 not in rows and rows[1].startswith("日本語テ") and rows[2].startswith("é") and rows[2].endswith("ü")
    assert left.where("doc_id is null").count() == 2


def test_chunks_are_cut_from_small_batches(spark, monkeypatch):
    """10,000 rows at once, as Spark sends by itself, took an executor's memory outside the heap."""
    docs = spark.range(3_000, numPartitions=1).selectExpr("id", "repeat(string(id % 10), 10000) AS text")
    name, really, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", chunks.keep, []

    def measure(batches):
        yield from (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)

    def keep(df, kept_as):
        sizes.extend(r["n"] for r in docs.mapInArrow(measure, "n long").collect())
        return really(df, kept_as)

    monkeypatch.setattr(chunks, "keep", keep)
    before = spark.conf.get(name)
    packed = chunks.pack(docs, "text", "small-batches")
    assert len(sizes) > 5 and max(sizes) < 2 * chunks.BATCH_BYTES
    assert spark.conf.get(name) == before
    assert packed.selectExpr("sum(n_bytes)").first()[0] == 3_000 * 10_001


@pytest.mark.parametrize("module,run", [
    (simhash, simhash.one_of_each), (suffix_array_dedup, suffix_array_dedup.without_later_copies),
])
def test_texts_travel_once(spark, monkeypatch, module, run):
    packed, really = [], module.pack
    monkeypatch.setattr(module, "pack", lambda docs, *rest: packed.append(docs) or really(docs, *rest))
    rows = [(1, "a b c d", "x", 5), (2, None, None, None), (3, "e f g é h", "y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, order int")
    got = run(docs)
    assert got.columns == docs.columns and {(r["doc_id"], r["text"], r["row"], r["order"]) for r in got.collect()} >= {rows[0], rows[2]}
    assert "a b c d" not in [value for r in packed[0].collect() for value in r["row"]]
