from __future__ import annotations

import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ordermill.llm import simhash
from ordermill.llm.components import components

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, shingle=3):
    words = GAP.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(shingle, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + k]).encode(), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(set(prints), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_masks_cover_every_pair():
    for radius in (1, 2, 3):
        kept = simhash.masks(radius)
        rng = random.Random(radius)
        for _ in range(3000):
            bits = sum(1 << i for i in rng.sample(range(64), radius))
            assert any(bits & m == 0 for m in kept)


@pytest.mark.parametrize("bucket_rows", [20_000, 3])
def test_against_brute_force(spark, bucket_rows):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "日本"]
    rows = [(None, None), (9, ""), (8, " \n"), (7, "one"), (7, "one"), (6, "Two Words"), (5, "two words")]
    for i in range(25):
        base = rng.choices(vocabulary, k=rng.randint(1, 120))
        for j in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((rng.choice([100 + 20 * i + j, None]) if j else 100 + 20 * i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).withColumn("root", F.lit("r"))
    got = simhash.near_duplicates(docs.repartition(3), bucket_rows=bucket_rows).collect()
    prints = [brute_print(t) for _, t in rows]
    roots = brute_roots(prints, 3)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[roots[p]] = min(d, least.get(roots[p], d))
    expect = sorted((str(d), f"{p:016x}", str(least.get(roots[p]))) for (d, _), p in zip(rows, prints))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == expect
    assert len(set(roots.values())) < len(set(prints)) < len(rows)

    left = simhash.one_of_each(docs, bucket_rows=bucket_rows)
    assert left.columns == docs.columns
    kept = left.collect()
    assert len(kept) == len(set(roots.values()))
    assert {str(r["doc_id"]) for r in kept} >= {str(d) for d in least.values()}


def test_random_fingerprints(spark):
    """Links at distances around the radius, with crowded buckets."""
    rng = random.Random(11)
    prints = set()
    for _ in range(30):
        p = rng.getrandbits(64)
        for _ in range(12):
            prints.add(p)
            for i in rng.sample(range(64), rng.randint(1, 4)):
                p ^= 1 << i
    prints = sorted(simhash._signed(p) for p in prints)
    frame = spark.createDataFrame([(p,) for p in prints], "p long")
    for bucket_rows in (1000, 4, 2):
        found = components(simhash._links(frame, 3, bucket_rows)).collect()
        roots = brute_roots([p & (2**64 - 1) for p in prints], 3)
        groups = {}
        for p in prints:
            groups.setdefault(roots[p & (2**64 - 1)], set()).add(p)
        got = {}
        for r in found:
            got.setdefault(r["root"], set()).add(r["vertex"])
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1301)}}


def test_rounds_end_with_the_first_look_at_stars(spark, monkeypatch):
    """Stars need no round at all, others no round that moves nothing; a round is four tables."""
    from ordermill.llm import components as module

    written, keep = [], module.keep
    monkeypatch.setattr(module, "keep", lambda df, name: written.append(name) or keep(df, name))

    def found(edges):
        written.clear()
        rows = module.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert len(rows) == len({r["vertex"] for r in rows})
        return {r["vertex"]: r["root"] for r in rows}

    stars = [(i, 0) for i in range(1, 50)] + [(0, 7), (100, 101), (3, None), (4, 4), (2, 0)]
    assert found(stars) == {**{i: 0 for i in range(50)}, 100: 100, 101: 100}
    assert written == ["edges", "least"]
    assert found([(9, 5), (9, 3), (5, 1)]) == {1: 1, 3: 1, 5: 1, 9: 1}
    rounds, last = divmod(len(written) - 2, 4)
    assert last == 0 and 1 <= rounds <= 2


def test_links_of_a_part_are_stars(spark):
    """One group of near copies: the cells of a part share fingerprints, so its links leave every print next to one root."""
    rng = random.Random(3)
    chain = [rng.getrandbits(63)]
    for _ in range(400):
        p = chain[-1]
        for i in rng.sample(range(63), 2):
            p ^= 1 << i
        chain.append(p)
    prints = sorted(set(chain))
    links = simhash._links(spark.createDataFrame([(p,) for p in prints], "p long"), 3, 1000).collect()  # one part
    root = brute_roots(prints, 3)
    assert {r["a"]: r["b"] for r in links} == {p: q for p, q in root.items() if p != q} and len(links) == len({r["a"] for r in links})


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_a_hub_of_a_third_of_all_edges_is_split(spark):
    """The plan that ran has a skewed join: a grouped side would have kept Spark from splitting the hub."""
    from ordermill.llm import components

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = 200_000
        hub = spark.range(1, n // 3).selectExpr("id + 1000000 AS a", "0L AS b")
        rest = spark.range(n).selectExpr("id * 3 + 5000000 AS a", "id * 3 + 5000001 AS b")
        edges = components._ordered(hub.union(rest).union(spark.createDataFrame([(None, 3), (7, 7)], "a long, b long")))
        star = components._large_star(components.keep(edges.repartition(8), "edges"))
        star.write.format("noop").mode("overwrite").save()
        star.collect()
        assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()
        found = components.components(hub.union(rest))
        assert found.where("root = 0").count() == n // 3 and found.groupBy("root").count().where("count = 2").count() == n
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
