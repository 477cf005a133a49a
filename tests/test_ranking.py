"""Distributed NTILE and RANK against Spark's own windows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import ranking
from ordermill.session import keep

SCHEMA = "id string, g string, days int, n bigint, amount decimal(38,2)"


def table(spark, rows):
    return keep(spark.createDataFrame(rows, SCHEMA).repartition(5), "ranking")


def random_rows(n, seed, ties):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < ties
        days = None if rng.random() < 0.05 else (7 if hot else rng.randrange(400))
        amount = None if rng.random() < 0.05 else (Decimal("0.00") if hot else Decimal(rng.randrange(10**6)) / 100)
        g = None if rng.random() < 0.02 else ("hot" if rng.random() < 0.4 else f"g{rng.randrange(12)}")
        rows.append((f"c{rng.randrange(10**9)}-{i}é", g, days, 1 if hot else rng.randrange(9), amount))
    return rows


def check_ntiles(df, rows_per_bucket):
    scores = {"r": ("days", True), "f": ("n", False), "m": ("amount", False)}
    got = ranking.add_ntiles(df, "id", scores, 5, rows_per_bucket)

    def own(order):
        return F.ntile(5).over(Window.orderBy(order, "id"))

    want = df.select(
        "*",
        own(F.col("days").desc_nulls_first()).alias("r"),
        own(F.col("n").asc_nulls_last()).alias("f"),
        own(F.col("amount").asc_nulls_last()).alias("m"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def check_ranks(df, rows_per_bucket):
    got = ranking.add_ranks(df, {"a": ("amount", None), "b": ("n", None), "c": ("amount", "g")}, rows_per_bucket)
    by_amount, by_n = F.col("amount").desc_nulls_first(), F.col("n").desc_nulls_first()
    want = df.select(
        "*",
        F.rank().over(Window.orderBy(by_amount)).cast("bigint").alias("a"),
        F.rank().over(Window.orderBy(by_n)).cast("bigint").alias("b"),
        F.rank().over(Window.partitionBy("g").orderBy(by_amount)).cast("bigint").alias("c"),
    )
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("ties", [0.0, 0.4, 0.98, 1.0])
@pytest.mark.parametrize("rows_per_bucket", [40, 10**6])
def test_against_windows(spark, ties, rows_per_bucket):
    df = table(spark, random_rows(2003, seed=int(ties * 100), ties=ties))
    check_ntiles(df, rows_per_bucket)
    check_ranks(df, rows_per_bucket)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23])
def test_few_rows(spark, n):
    df = table(spark, random_rows(n, seed=n, ties=0.5))
    for rows_per_bucket in (2, 10**6):
        check_ntiles(df, rows_per_bucket)
        check_ranks(df, rows_per_bucket)


def test_copies_of_one_row(spark):
    df = table(spark, [("same", "hot", 1, 1, Decimal("5.00"))] * 300 + random_rows(200, seed=1, ties=0.3))
    check_ranks(df, 10)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 3), st.integers(-2, 2)), min_size=1, max_size=40
    ),
    st.integers(1, 6),
)
def test_any_small_table(spark, rows, rows_per_bucket):
    df = table(spark, [(str(i), g, d, d, Decimal(a)) for i, (g, d, a) in enumerate(rows)])
    check_ntiles(df, rows_per_bucket)
    check_ranks(df, rows_per_bucket)


def test_tile_ends():
    assert ranking.tile_ends(7, 5) == [2, 4, 5, 6]
    assert ranking.tile_ends(3, 5) == [1, 2, 3, 3]
    assert ranking.tile_ends(10, 5) == [2, 4, 6, 8]
