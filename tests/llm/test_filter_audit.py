"""Orders of filters against a plain simulation."""

from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import pytest

from ordermill.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS, LABELS = "doc_id long, text string, lang string, part string, mask int", "doc_id long, quality int, toxic int, extra string"


def failures(rows):
    """Letters that each row fails."""
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        w = WORD.findall(t)
        tests = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and least[t] < doc_id,
        }
        out.append({f for f, bad in tests.items() if bad})
    return out


def brute(rows, labels):
    good = {d for d, q, _, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, _ in labels if t == 1 and d is not None}
    failed = failures(rows)
    out = []
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed) if (r[2] or "") == part]
        shapley, found = defaultdict(int), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                redundant = sum(f in x[1] for x in own) - len(gone)
                unique = sum(x[1] == {f} for x in own)
                found.append([part, order, step, len(left), len(gone), redundant, unique, sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)])
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def table(n, seed=4):
    rng = random.Random(seed)
    texts = [None, "", " \t", "a", "A# B", "one TWO three", "x " * 120, " ".join(f"w{i}" for i in range(110)), " ".join(f"W{i}" for i in range(110)),
             " ".join(f"w{i}" for i in range(99)) + " é|", "é" * 50 + " A", "ÀÉ " * 101]
    rows = []
    for i in range(n):
        text = rng.choice(texts) if rng.random() < 0.7 else f"own {i} " + " ".join(rng.choices("abcdefghij#", k=rng.randint(1, 150)))
        rows.append((rng.choice([i, i, i, i - 3, None]), text, rng.choice(["en", "fr", None, ""]), "clash", 5))
    labels = [(rng.choice([i, i, i - 1, None]), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, n, 2)]
    return rows, labels


def test_equals_plain_simulation(spark):
    rows, labels = table(160)
    got = fa.audit(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, labels)
    assert len(got) == 3 * 600


def test_long_text_group_of_copies_and_empty_tables(spark):
    rows = [(i, "same text", "en", "", 0) for i in range(400, 100, -1)] + [(1, "word " * 400_000 + "end", "en", "", 0)]
    labels = [(i, 1, 0, "") for i in range(100, 400, 7)]
    got = fa.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, labels)
    none = fa.audit(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS))
    assert none.collect() == []
    unlabelled = fa.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).collect()
    assert sorted(tuple(r) for r in unlabelled) == brute(rows, [])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_swaps_go_through_all_orders(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for i in fa.swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n)))) == 1 + len(list(fa.swaps(n)))


def test_diagram_shares_branches_and_swaps_keep_counts():
    rng = random.Random(8)
    counts = {m: (rng.randint(0, 3), rng.randint(0, 2), 0) for m in rng.sample(range(32), 20)}
    diagram = fa.Diagram("ABCDE", counts)
    whole = tuple(map(sum, zip(*counts.values())))
    for level in fa.swaps(5):
        diagram.swap(level)
        assert diagram.weight(diagram.root) == whole
        fresh = {sum(1 << diagram.levels.index(f) for i, f in enumerate("ABCDE") if m >> i & 1): c for m, c in counts.items()}
        assert fa.Diagram("".join(diagram.levels), fresh).steps() == diagram.steps()
    same = fa.Diagram("ABCDE", {m: (2, 1, 0) for m in range(32)})
    assert len(same.branch) == 5 and len(same.leaf) == 1  # one node a level
    assert fa.Diagram("ABCDE", {}).steps() == [(f, (0,), (0,)) for f in "ABCDE"]
