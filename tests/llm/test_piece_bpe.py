"""SentencePiece encoding by agenda, against the library."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ordermill.llm import piece_bpe, registry

SF = "/root/testdata/sf0.001"
ODD = [
    (None, None), (1, ""), (2, " "), (3, "  a   b  "), (3, "  a   b  "), (4, "a▁b▁▁ ▁"), (5, "日本語 😀 x\x00y"), (None, "<s></s> <unk><0x0A>"),
    (6, "\n\n\t\r\x0b"), (7, "ﬁ é İstanbul ﬀ ́"), (8, "x" * 20_000), (9, "na" * 9_000 + " " * 700), (10, "�﻿ z"), (11, "aaaaaaaaa bbbbb"),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=registry.model_file())


@pytest.mark.parametrize("check", piece_bpe.CHECKS)
@pytest.mark.parametrize("digests", [False, True])
def test_equals_the_library(spark, library, check, digests):
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(ODD + real, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("extra", F.lit(1))
    found = piece_bpe.encode(docs, registry.model_file(), check=check, digests=digests)
    assert found.columns == ["doc_id", "text", "extra", "n_tokens", "ids", "decoded"]
    got = found.collect()
    assert len(got) == len(ODD) + len(real)
    for r in got:
        ids = library.encode(r["text"] or "", add_eos=True)
        decoded = library.decode(ids)
        assert r["n_tokens"] == len(ids)
        if digests:
            assert r["ids"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded"] == hashlib.sha256(decoded.encode()).hexdigest()
        else:
            assert list(r["ids"]) == ids and r["decoded"] == decoded
    assert piece_bpe.encode(docs.limit(0), registry.model_file(), check=check, digests=digests).count() == 0


def test_both_agendas_agree_and_memory_is_bounded(monkeypatch, library):
    vocabulary = piece_bpe.Vocabulary(registry.model_file())
    words = [f" wording{i}s of-the_{i * i}" for i in range(400)] + [" " * n for n in range(1, 40)] + ["aaa" * n for n in range(1, 30)]
    for w in words:
        by_list, by_heap = vocabulary._merged(w), vocabulary._merged_by_heap(w)
        assert by_list == by_heap
        assert vocabulary.agenda(w) == library.encode(w[1:]) or not w.startswith(" ") or w == " "
    monkeypatch.setattr(piece_bpe, "MEMORY_BYTES", 4_000)
    memory = piece_bpe._Stretches(vocabulary, True)
    for w in words * 2:
        assert memory.of([w.encode()]) == [vocabulary.agenda(w)]
        assert len(memory.known) + len(memory.older) < 40


def test_no_merge_crosses_a_cut(library):
    vocabulary = piece_bpe.Vocabulary(registry.model_file())
    for _, text in ODD:
        if not text or len(text) > 1000:
            continue
        marked = " " + text.replace("▁", " ")
        batch = pa.record_batch({"text": [text]})
        data, offsets = piece_bpe.text_buffer(piece_bpe._marked(batch, 0), 0)
        begins = [*piece_bpe.cuts(data, offsets, vocabulary.joins).tolist(), len(data)]
        stretches = [bytes(data[a:b]).decode() for a, b in zip(begins, begins[1:])]
        assert "".join(stretches) == marked
        assert [i for s in stretches for i in vocabulary.agenda(s)] == vocabulary.agenda(marked) == library.encode(text)


def test_a_difference_fails_the_query(spark):
    batch = pa.record_batch({"text": ["one two", "three"]})
    vocabulary = piece_bpe.Vocabulary(registry.model_file())
    ids = [vocabulary.agenda(" one two"), vocabulary.agenda(" three")]
    flat = piece_bpe.np.array(ids[0] + ids[1], piece_bpe.np.int32)
    borders = piece_bpe.np.array([0, len(ids[0]), len(flat)])
    piece_bpe._compare(vocabulary, batch.column(0), flat, borders)
    flat[-1] += 1
    with pytest.raises(RuntimeError, match="row 1"):
        piece_bpe._compare(vocabulary, batch.column(0), flat, borders)
    with pytest.raises(ValueError, match="no check"):
        piece_bpe.encode(spark.createDataFrame([("a",)], "text string"), registry.model_file(), check="some")
    with pytest.raises(ValueError, match="may not be named"):
        piece_bpe.encode(spark.createDataFrame([("a",)], "ids string"), registry.model_file(), text="ids")
