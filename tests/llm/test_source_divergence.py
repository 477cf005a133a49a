"""Divergences of sources against a count in plain Python with whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordermill.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, item int"


def brute(rows, min_docs=3, ranks=200):
    docs = []
    for _, text, lang, source, _ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs.append((lang or "", source or "", Counter(TERM.findall(low))))
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = [t for t, n in df.items() if n >= min_docs]
        v = len(kept)
        counts = defaultdict(Counter)
        for _, source, c in own:
            counts[source].update({t: c[t] for t in kept if t in c})
        whole = sum(counts.values(), Counter())

        def p(c):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (total + v) for t in kept}

        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s, ps in shares.items():
            pairs = [(o, sum((ps[t] - po[t]) ** 2 // po[t] for t in kept)) for o, po in shares.items() if o != s]
            leading = [(t, (ps[t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] > 0 and ps[t] > q[t]]
            for part, found in (("pair", pairs), ("term", leading)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(found, 1) if part == "pair" or i <= ranks]
    return sorted(out)


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{''.join(rng.choices('abcdeé', k=rng.randint(1, 4)))}" for _ in range(80)] + ["Été", "ΑΒΓ", "日本"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["hot", "hot", "hot", "a", "b", None, "", "Ω"])
        words = rng.choices(vocabulary, k=rng.choice([0, 1, 5, 60]))
        rows.append((rng.choice([i, None, 7]), rng.choice([" ", "-1,", "\n"]).join(words) if rng.random() > 0.05 else None, lang, source, i))
    return rows + [(1, "12 34 --", "xx", "only", 0), (2, "one One ONE", "yy", "s1", 0), (2, "one One ONE", "yy", "s2", 0), (2, "one, two", "yy", "s1", 0)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_counts(spark, monkeypatch, small):
    if small:
        for name, value in (("TABLE_ENTRIES", 40), ("WAITING_ENTRIES", 10), ("BIN_ENTRIES", 5), ("BLOCK_CELLS", 16)):
            monkeypatch.setattr(sd, name, value)
    rows = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    ranks = 9 if small else 200
    got = sorted(tuple(r) for r in sd.audit(docs, ranks=ranks).collect())
    assert got == brute(rows, ranks=ranks)
    assert {r[2] for r in got if r[0] == "xx"} == set() and [r[4] for r in got if r[0] == "yy" and r[2] == "pair"]


def test_language_without_terms_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "1 2", "en", "a", 0), (2, None, "en", "b", 0), (3, "x", "en", "c", 0)], SCHEMA)
    got = sorted(tuple(r) for r in sd.audit(docs).collect())
    assert got == sorted(("en", s, "pair", o, 0, i) for s in "abc" for i, o in enumerate([x for x in "abc" if x != s], 1))
    assert sd.audit(docs.limit(0)).collect() == []


def test_a_long_text_and_one_that_repeats(spark):
    rows = [(1, "alpha beta " * 300_000 + "gamma", "en", "long", 0), *[(i, "alpha gamma", "en", "copies", 0) for i in range(2, 40)], (50, "beta delta", "en", "rest", 0)]
    assert sorted(tuple(r) for r in sd.audit(spark.createDataFrame(rows, SCHEMA)).collect()) == brute(rows)


def test_shares_are_exact():
    rng = np.random.default_rng(5)
    whole = rng.integers(1, sd.MOST, 2000)
    n = np.array([int(rng.integers(1, w + 1)) for w in whole])
    assert sd.share(n, whole).tolist() == [1 + 10**9 * a // b for a, b in zip(n.tolist(), whole.tolist())]
    assert sd.share(np.array([sd.MOST]), sd.MOST).tolist() == [1 + 10**9]
    with pytest.raises(OverflowError):
        sd.share(np.array([1]), sd.MOST + 1)


def test_spilled_tables_and_merge_keep_every_entry(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sd, "TABLE_ENTRIES", 3)
    monkeypatch.setattr(sd, "WAITING_ENTRIES", 1)
    batches = [pa.record_batch({"text": [f"a b{'xyz'[i % 3]} c", "a"], "lang": ["l", "m"], "source": [f"s{i % 2}", "t"]}) for i in range(9)]
    spilled = pa.Table.from_batches(list(sd.fold(iter(batches))))
    assert spilled.num_rows > 12
    ordered = spilled.sort_by([("lang", "ascending"), ("term", "ascending")]).combine_chunks().to_batches()[0]
    for size in (1, 2, 7, 100):
        cut = [ordered.slice(i, size) for i in range(0, ordered.num_rows, size)]
        merged = {(r["lang"], r["term"]): r for b in sd.merge(iter(cut)) for r in b.to_pylist()}
        assert merged[("l", "a")] == {"lang": "l", "term": "a", "df": 9, "stripe": [{"source": "s0", "n": 5}, {"source": "s1", "n": 4}]}
        assert merged[("m", "a")]["df"] == 9 and merged[("l", "by")]["df"] == 3 and merged[("l", "")]["df"] == 0
        assert len(merged) == 8
