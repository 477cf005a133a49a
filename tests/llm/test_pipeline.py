from __future__ import annotations

import random
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ordermill.llm import quality_rules as q
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_repeats import brute as brute_repeats
from tests.llm.test_simhash import brute_print, brute_roots

SF = "/root/testdata/sf0.001"
GAP = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(text: str | None) -> dict:
    text = text or ""
    words = GAP.findall(text)
    lines = [line for line in text.split("\n") if GAP.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    stops = {w for own in q.STOP_WORDS.values() for w in own}
    m = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in q.SYMBOLS),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_stop_words": sum(w.lower() in stops for w in words),
    }
    m["base_failed"] = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    broken = []
    for rule in q.RULES:
        above, below = rule.measure.split(" / ")
        value = m[above] / m[below] if m[below] else 0.0
        if (rule.low is not None and value < rule.low) or (rule.high is not None and value > rule.high):
            broken.append(rule.name)
    return m | {"broken_rules": broken, "kept": not m["base_failed"] and not broken}


def odd_texts() -> list[str | None]:
    rng = random.Random(1)
    prose = "the cat and a dog in the house was of no use to me with it"
    return [
        None, "", " \n\t\x0b", "a", "\n".join([prose] * 3), "\n".join([prose, " ", prose, "", prose + "!"]), "x " * 500, "# $ % & | < > *" * 9,
        " ".join(rng.choices("abcdefgh", k=400)), "é " * 8 + "ü " * 8 + "é " * 8, "one two\n" * 2 + "three", prose + " " + "w" * 100_000,
        " ".join(rng.choices("ab", k=30)), "\n".join(" ".join(rng.choices(prose.split(), k=30)) for _ in range(4)),
    ]


def test_quality_against_brute_force(spark):
    texts = odd_texts() + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    judged = q.judge(docs)
    for r in judged.collect():
        expect = brute_quality(texts[r["doc_id"]])
        assert {k: r[k] for k in expect} == expect, texts[r["doc_id"]]
    good = q.keep_good(docs)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {i for i, t in enumerate(texts) if brute_quality(t)["kept"]}
    assert q.judge(docs.limit(0)).count() == 0
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def brute_pipeline(rows: list[dict], items: list[tuple]) -> list[dict]:
    rows = [r for r in rows if brute_quality(r["text"])["kept"]]
    prints = [brute_print(r["text"]) for r in rows]
    roots = brute_roots(prints, 3)
    first: dict = {}
    for r, p in sorted(zip(rows, prints), key=lambda x: (x[0]["doc_id"] is None, x[0]["doc_id"] or 0)):
        first.setdefault(roots[p], r)
    rows = sorted(first.values(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    gone = brute_repeats([list(r["text"].encode()) for r in rows], 400, True)
    left = []
    for r, mask in zip(rows, gone):
        if any(mask):
            out, at = [], 0
            for c in r["text"]:
                n = len(c.encode())
                if not all(mask[at : at + n]):
                    out.append(c)
                at += n
            r = r | {"text": "".join(out)}
        if not any(mask) or r["text"].strip(" "):
            left.append(r | {"n_chars": len(r["text"])})
    hits = brute_hits([r["text"] for r in left], items, 10)
    return [r for r, h in zip(left, hits) if not h[3]]


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    long = max((r["text"] for r in rows), key=len)
    for k, text in enumerate(odd_texts()):
        rows.append({"doc_id": 90_000 + k, "text": text, "lang": None, "source": None, "n_chars": None})
    for k in range(30):  # planted: near copies, shared passages, benchmark passages
        r = dict(rng.choice(rows[:200]), doc_id=80_000 + k)
        cut = (r["text"] or "").split(" ")
        if k % 3 == 0:
            cut[rng.randrange(len(cut))] = "changed"
        elif k % 3 == 1:
            cut.insert(len(cut) // 2, long[100:900])
        else:
            cut.insert(len(cut) // 2, rng.choice(items)[1])
        rows.append(r | {"text": " ".join(cut)})
    rows.append(dict(rows[5]))
    spark.createDataFrame(rows, docs.schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    expect = brute_pipeline(rows, items)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(by) and sorted(by) == sorted(r["doc_id"] for r in expect)
    assert 50 < len(expect) < len(rows) - 30
    for r in expect:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert list(by[r["doc_id"]]["ids"]) == ids and by[r["doc_id"]]["n_tokens"] == len(ids)
        assert by[r["doc_id"]]["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert by[r["doc_id"]]["n_chars"] == r["n_chars"] and by[r["doc_id"]]["source"] == r["source"]


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
