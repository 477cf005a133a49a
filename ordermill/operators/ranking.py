"""Exact NTILE and RANK over a whole table, or over groups that may be huge.

A window without partitions, or with one huge partition, runs in a single task. Here keys from one sample cut each order into
buckets, one count per bucket tells how many rows lie before it, and no task orders more than one bucket. A bucket is a pure
function of the row, so nothing needs to be stored in between, and there is one plan for all sizes: a count, a sample, the
counts per bucket, and the result. Any cuts give the exact result; they only decide how even the buckets are.

A key that a cut hits is a bucket of its own. A value that many rows share is hit for sure, and its rows need no order.

NTILE takes the row with which a tile ends from the bucket that holds it; then every row compares its key with these few.
The table is neither shuffled nor sorted.

RANK is worked out in place, with one shuffle by buckets for each order and no join: rows before the bucket, plus the rank
within the bucket. For ranks within groups the keys begin with the group, and only the group that a bucket begins with can
have rows before it.

Both operators read their input several times, so callers pass a stored table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# About so many rows to a bucket. Ranks have no fewer buckets of an order than these, so that several tasks share the work.
# The last is a limit for the sample and the list of cuts; from 4 G rows on buckets grow with the table.
ROWS_PER_BUCKET = 250_000
FEWEST_BUCKETS = 8
MOST_BUCKETS = 16_384
SAMPLES_PER_CUT = 16
FEW_CUTS = 32

_VALUE = "decimal(38,2)"
# In the order of the fields: the group, whether the value comes after NULL or before it, the value, and the id.
_KEY = f"struct<g:string,after:int,value:{_VALUE},id:string>"


def _literal(value, kind: str) -> Column:
    """Column holding a nested constant."""
    return F.from_json(F.lit(json.dumps(value, default=str)), kind)


def _key(group: str | None, value: str, descending: bool, nulls_first: bool, id_column: str | None) -> Column:
    """Sort key, ascending: a descending value is negated."""
    number = F.col(value).cast(_VALUE)
    text = lambda c: F.lit(None).cast("string") if c is None else F.col(c).cast("string")
    return F.struct(
        text(group).alias("g"),
        F.when(F.col(value).isNull(), 0 if nulls_first else 2).otherwise(1).alias("after"),
        (-number if descending else number).cast(_VALUE).alias("value"),
        text(id_column).alias("id"),
    )


def _order(key: tuple) -> tuple:
    """Sorts keys as Spark does: NULL first, text by code points."""
    g, after, value, row_id = key
    return (g is not None, g or "", after, Decimal(0) if value is None else value, row_id or "")


def _placed(rows: DataFrame, cuts: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """``rows`` with ``__bucket<x>`` and ``__behind<x>``, the group of the next cut, for each ``__key<x>``.

    ``cuts`` has by x the sorted cuts, absent ones NULL, and their number. Few cuts are compared one by one. Among many the
    range is halved, in one projection per step: that is compiled, while a lambda would be interpreted. Filters on the
    bucket would multiply these steps; filter by keys instead.
    """
    most = max(n for _, n in cuts.values())
    if most <= FEW_CUTS:
        below = {
            f"__below{x}": sum((F.when(F.get(own, F.lit(i)) < F.col(f"__key{x}"), 1).otherwise(0) for i in range(n)), F.lit(0))
            for x, (own, n) in cuts.items()
        }
        rows = rows.withColumns(below)
    else:
        rows = rows.withColumns({f"__below{x}": F.lit(0) for x in cuts})
        for step in [1 << i for i in reversed(range(most.bit_length()))]:
            found = {x: F.col(f"__below{x}") for x in cuts}
            rows = rows.withColumns(
                {f"__below{x}": found[x] + F.when(F.get(own, found[x] + step - 1) < F.col(f"__key{x}"), step).otherwise(0) for x, (own, _) in cuts.items()}
            )
    added = {}
    for x, (own, _) in cuts.items():
        behind = F.get(own, F.col(f"__below{x}"))
        # where a cut is not below the key and the key is not below the cut, they are equal
        on_cut = F.coalesce(~(F.col(f"__key{x}") < behind), F.lit(False))
        added |= {f"__bucket{x}": F.col(f"__below{x}") * 2 + on_cut.cast("int"), f"__behind{x}": behind["g"]}
    return rows.withColumns(added)


class _Buckets:
    """Buckets of one order: 2 * i before cut i, 2 * i + 1 for the key that is cut i."""

    def __init__(self, cuts: list[tuple], n_rows: int = 0) -> None:
        self.cuts = cuts
        self.size = [n_rows] + [0] * (2 * len(cuts))
        # rows of a bucket that belong to the group of the cut behind it
        self.of_next_group = [0] * (2 * len(cuts) + 1)

    def listed(self, length: int) -> list[dict | None]:
        return [_as_json(c) for c in self.cuts] + [None] * (length - len(self.cuts))

    def group_before(self) -> list[tuple[str | None, int]]:
        """For each bucket the group it begins with, and how many rows of it lie before."""
        found: list[tuple[str | None, int]] = [(None, 0)]
        for b in range(1, len(self.size)):
            g = self.cuts[(b - 1) // 2][0]
            if b % 2 == 0:
                found.append((g, found[-1][1] + self.size[b - 1]))
            else:
                earlier = found[-1][1] if b > 1 and found[-1][0] == g else 0
                found.append((g, earlier + self.of_next_group[b - 1]))
        return found


def _as_json(key: tuple) -> dict:
    return dict(zip(("g", "after", "value", "id"), key))


def _tall(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row ``order``, ``__key`` per order and input row, so that one job serves all orders."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("order"), k.alias("__key")) for i, k in enumerate(keys)])))


def _bucketed(df: DataFrame, keys: list[Column], n_rows: int, rows_per_bucket: int | None, fewest: int) -> list[_Buckets]:
    """Buckets of each order, counted."""
    n_buckets = min(MOST_BUCKETS, max(fewest, -(-n_rows // (rows_per_bucket or ROWS_PER_BUCKET))))
    if n_buckets == 1:
        return [_Buckets([], n_rows) for _ in keys]
    share = min(1.0, SAMPLES_PER_CUT * n_buckets / max(1, n_rows))
    sample = df.sample(share, seed=17).select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).collect()
    found = []
    for i in range(len(keys)):
        ordered = sorted((tuple(r[i]) for r in sample), key=_order)
        cuts = {ordered[j * len(ordered) // n_buckets] for j in range(1, n_buckets)} if ordered else set()
        found.append(_Buckets(sorted(cuts, key=_order)))
    most = max(len(o.cuts) for o in found)
    cuts = F.get(_literal([o.listed(most) for o in found], f"array<array<{_KEY}>>"), F.col("order"))
    same = F.col("__behind").eqNullSafe(F.col("__key.g"))
    counted = _placed(_tall(df, keys), {"": (cuts, most)}).groupBy("order", "__bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("next"))
    for r in counted.collect():
        found[r["order"]].size[r["__bucket"]] = r["n"]
        found[r["order"]].of_next_group[r["__bucket"]] = r["next"]
    return found


# --- NTILE -------------------------------------------------------------------------------------


def tile_ends(n_rows: int, tiles: int) -> list[int]:
    """Row number on which each tile but the last ends; the first tiles take the remainder."""
    size, extra = divmod(n_rows, tiles)
    return [t * size + min(t, extra) for t in range(1, tiles)]


def add_ntiles(
    df: DataFrame,
    id_column: str,
    scores: Mapping[str, tuple[str, bool]],
    tiles: int = 5,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add an integer NTILE column for each entry ``name: (value column, descending)`` of ``scores``.

    NULL sorts last going up and first going down; ties are ordered by ``id_column``, which must be unique.
    """
    n_rows = df.count()
    keys = [_key(None, value, descending, descending, id_column) for value, descending in scores.values()]
    orders = _bucketed(df, keys, n_rows, rows_per_bucket, 1)
    ends: list[list[tuple]] = [[] for _ in orders]
    wanted: list[tuple[int, int, int]] = []  # order, bucket, row within the bucket
    for i, order in enumerate(orders):
        for end in sorted({e for e in tile_ends(n_rows, tiles) if e > 0}):
            bucket = 0
            while end > order.size[bucket]:
                end -= order.size[bucket]
                bucket += 1
            if bucket % 2:
                ends[i].append(order.cuts[bucket // 2])
            else:
                wanted.append((i, bucket, end))
    for i, key in _rows_at(df, keys, orders, wanted):
        ends[i].append(key)
    added = []
    for name, key, own in zip(scores, keys, ends):
        # a row lies one tile further for every tile end below it
        passed = [(_literal(_as_json(end), _KEY) < key).cast("int") for end in own]
        added.append(sum(passed, F.lit(1)).cast("int").alias(name))
    return df.select("*", *added)


def _rows_at(df: DataFrame, keys: list[Column], orders: list[_Buckets], wanted: list[tuple[int, int, int]]) -> list[tuple[int, tuple]]:
    """(order, key) of the wanted rows; only the buckets that hold them are sorted."""
    if not wanted:
        return []
    spans = sorted({w[:2] for w in wanted})
    number = F.lit(None).cast("int")
    for n, (i, bucket) in enumerate(spans):
        inside = F.col("order") == i
        if bucket:
            inside &= F.col("__key") > _literal(_as_json(orders[i].cuts[bucket // 2 - 1]), _KEY)
        if bucket < 2 * len(orders[i].cuts):
            inside &= F.col("__key") < _literal(_as_json(orders[i].cuts[bucket // 2]), _KEY)
        number = F.when(inside, n).otherwise(number)
    at = reduce(or_, [(F.col("span") == spans.index(w[:2])) & (F.col("row") == w[2]) for w in wanted])
    rows = _tall(df, keys).withColumn("span", number).filter(F.col("span").isNotNull())
    rows = rows.withColumn("row", F.row_number().over(Window.partitionBy("span").orderBy("__key"))).filter(at).collect()
    return [(r["order"], tuple(r["__key"])) for r in rows]


# --- RANK --------------------------------------------------------------------------------------


def add_ranks(
    df: DataFrame,
    ranks: Mapping[str, tuple[str, str | None]],
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add a bigint RANK column for each entry ``name: (value column, group column or None)``.

    The order is descending with NULL first; the group column is text.
    """
    keys = [_key(group, value, True, True, None) for value, group in ranks.values()]
    limit = rows_per_bucket or ROWS_PER_BUCKET
    orders = _bucketed(df, keys, df.count(), rows_per_bucket, FEWEST_BUCKETS)
    cuts = {str(i): (_literal(o.listed(len(o.cuts)), f"array<{_KEY}>"), len(o.cuts)) for i, o in enumerate(orders)}
    rows = _placed(df.withColumns({f"__key{i}": key for i, key in enumerate(keys)}), cuts)
    salts, found = {}, []
    for i, (name, order) in enumerate(zip(ranks, orders)):
        bucket, group = F.col(f"__bucket{i}"), F.col(f"__key{i}.g")
        before = order.group_before()
        # rows of one key all have the same rank, so they may be ranked anywhere
        dealt = _literal([-(-n // limit) if b % 2 else 1 for b, n in enumerate(order.size)], "array<bigint>")
        salts[f"__salt{i}"] = F.monotonically_increasing_id() % F.greatest(F.lit(1), F.get(dealt, bucket))
        within = Window.partitionBy(bucket, f"__salt{i}", group).orderBy(f"__key{i}.after", f"__key{i}.value")
        first = F.get(_literal([g for g, _ in before], "array<string>"), bucket)
        earlier = F.when(first.eqNullSafe(group), F.get(_literal([n for _, n in before], "array<bigint>"), bucket))
        found.append((F.rank().over(within) + F.coalesce(earlier, F.lit(0))).cast("bigint").alias(name))
    return rows.withColumns(salts).select(*df.columns, *found)
