"""Joins that stay balanced when one key holds a large share of the rows.

The right sides met here are grouped by the join key, so they have one row per key; the left side may hold any number of
rows per key. A plain shuffle join sends a hot key to a single task, and the adaptive planner cannot split it, because
the grouped side brings its own partitioning. ``salted_join`` deals the rows of a hot key over as many salts as it has
portions of ``HOT_ROWS`` rows, and copies the one right row once per salt. The size of a table decides nothing; whether a
key is hot does, and there may be any number of them. A left side that has one row per key itself needs none of this and is joined plainly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import keep

# A key is hot with more rows than this.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Keys of ``df`` with more than ``limit`` rows and the number of their ``salts``, written to the scratch folder.

    There are at most rows / limit of them. Rows are counted per key and task before they are shuffled.
    """
    limit = HOT_ROWS if limit is None else limit
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    salts = F.call_function("div", F.col("n_rows") - 1, F.lit(limit)) + 1
    return keep(counted.filter(F.col("n_rows") > limit).select(key, salts.cast("int").alias("salts")), "hot_keys")


def salted_join(left: DataFrame, right: DataFrame, key: str, by: str, sums: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``key``: columns key, ``salt``, ``by``, ``sums`` and those of ``right``.

    ``right`` has one row per key. ``left`` has the columns key, by and sums, and stands for its sums per key and by. Rows of
    hot keys are added up by key and by, which takes care of a pair that very many rows share, and dealt over the salts of
    their key by a hash of ``by``; so all rows of a pair have the same salt. All other rows go through one by one, salt 0.

    The list of hot keys is stored, so its size is known: Spark joins it by broadcast while it is below its threshold and
    by a shuffle beyond, where nothing keeps the adaptive planner from splitting a hot key. Where no key is hot, at any
    number of rows, nothing is to be dealt, and the join can use the layout of stored tables. ``hot`` is the list for
    callers that have it; it may name more keys than are hot.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if hot.isEmpty():
        return left.select(key, F.lit(0).alias("salt"), by, *sums).join(right, key)
    most = left.join(hot, key, "left_anti").select(key, F.lit(0).alias("salt"), by, *sums)
    # one expression instead of three columns, so that a shuffle by the key alone does not count as good enough
    pair = F.struct(key, by, "salts").alias("pair")
    added = left.join(hot, key).groupBy(pair).agg(*[F.sum(c).alias(c) for c in sums])
    salt = F.pmod(F.xxhash64(f"pair.{by}"), F.col("pair.salts")).cast("int").alias("salt")
    few = added.select(f"pair.{key}", salt, f"pair.{by}", *sums)
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    copies = right.join(hot, key, "left").select(*right.columns, F.explode(salts).alias("salt"))
    return most.unionByName(few).join(copies, [key, "salt"])


def left_lookup(left: DataFrame, rights: Sequence[DataFrame], key: str) -> DataFrame:
    """``left``, which has one row per key like the right sides, with their columns, NULL where the key is missing."""
    for side in rights:
        left = left.join(side, key, "left")
    return left
