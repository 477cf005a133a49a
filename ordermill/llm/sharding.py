"""Sharding by a k-d tree over metadata, in DataFrame functions only. Law ``bytes``: shards hold nearly equal bytes.

All rows start in one node. A node is split along its widest metadata dimension at the weighted median of its bytes, and
so on until each leaf is one shard, i.e. holds the target bytes. Medians are found without sorting: sums of bytes by
bins of the dimension's key, then by finer bins inside the bin that holds the median, until what the bin holds is
negligible. Only these sums reach the driver (at most ``CELLS`` numbers a round).

Equal texts are a group and stay together. Groups above ``HEAVY`` of a shard (there are few, by arithmetic) are placed
first, largest first, each into the emptiest shard, and the tree splits the rest so as to fill up what they leave; so a
large group does not tip a median. A group stays whole if it fits a shard. Only where whole groups would overfill one,
those above the next smaller of the ``OVERSIZE`` shares are dealt out in portions, as the law on sizes comes first.

A text's coordinate is its position among the column's distinct texts, so texts that begin alike are told apart.

A row's size is its text's UTF-8 bytes plus one, so a NULL or empty text counts one. NULL metadata sorts first. Repeated
rows are a group like any equal texts, and each gets a slot of its own. Slots of a shard run from 0 without gaps. An
empty table gives an empty result. All input columns but the text are carried; an input column named like a result
column is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ordermill.session import keep

RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
HEAVY = 0.005  # of a shard's bytes
OVERSIZE = (1.0, 0.5, 0.25, 0.05)  # of a shard's bytes
OVERFILL = 0.01
PORTION = 0.02
CELLS = 1 << 16
NEGLIGIBLE = 1e-4  # of a shard's bytes
SLOT_ROWS = 50_000
ORDER_ROWS = 250_000  # distinct texts that one task orders
BROADCAST_BYTES = 8 << 20
_COORDINATE_BITS, _HASH_BITS = 30, 32
_KEY_BITS = _COORDINATE_BITS + _HASH_BITS


def _coordinate(docs: DataFrame, name: str) -> Column:
    """A metadata value that is a number, or a text whose position is still to be found."""
    column = F.col(f"`{name}`")
    return column.cast("double" if isinstance(docs.schema[name].dataType, NumericType) else "string")


def _positions(docs: DataFrame, name: str) -> DataFrame:
    """(value, position): the distinct texts of a column and their places in order, as doubles; no task orders them all."""
    values = keep(docs.select(_coordinate(docs, name).alias("value")).where("value IS NOT NULL").distinct(), "shard-values")
    size = values.agg(F.count("*").alias("rows"), F.sum(F.octet_length("value") + 16).alias("bytes")).first()
    ranged = values.repartitionByRange(max(1, -(-size["rows"] // ORDER_ROWS)), "value").withColumn("part", F.spark_partition_id())
    ranged = keep(ranged, "shard-ranges")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    found = ranged.withColumn("rank", rank).join(F.broadcast(before), "part")
    found = found.select("value", (F.col("before") + F.col("rank")).cast("double").alias("position"))
    return F.broadcast(found) if (size["bytes"] or 0) <= BROADCAST_BYTES else found


def _inline(spark, rows: list[dict], schema: str) -> DataFrame:
    """A small table of values worked out on the driver."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _place_heavy(heavy: list, room: list[float]) -> list[dict]:
    placed = []
    for row in sorted(heavy, key=lambda r: (-r["bytes"], r["k1"], r["k2"], r["portion"])):
        shard = max(range(len(room)), key=lambda s: (room[s], -s))
        room[shard] -= row["bytes"]
        placed.append({"k1": row["k1"], "k2": row["k2"], "portion": row["portion"], "shard": shard})
    return placed


def _oversize(heavy: list[int], capacity: float, shards: int) -> float:
    """The largest share of a shard up to which groups can stay whole without overfilling a shard."""
    for share in OVERSIZE:
        room = [capacity] * shards
        for size in sorted((b for b in heavy if b <= share * capacity), reverse=True):
            room[room.index(max(room))] -= size
        if min(room) >= -OVERFILL * capacity:
            return share
    return OVERSIZE[-1]


def _cuts(units: DataFrame, dims: int, nodes: dict[int, tuple[int, int]], room: list[float], slack: float) -> list[dict]:
    """For each node of more than one shard, the dimension, the key up to which rows go left, and the children."""
    ranges = [(F.max(F.col("keys")[d]) - F.min(F.col("keys")[d])).alias(f"s{d}") for d in range(dims)]
    wide = units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *ranges).collect()
    wanted = {}
    for row in wide:
        first, count = nodes[row["node"]]
        if count == 1:
            continue
        left = count // 2
        rest = [max(r, 0.0) for r in room[first : first + count]]
        total = sum(rest)
        share = sum(rest[:left]) / total if total > 0 else left / count
        dimension = max(range(dims), key=lambda d: (row[f"s{d}"], -d))
        wanted[row["node"]] = {"dimension": dimension, "target": share * row["bytes"], "below": 0, "low": 0, "bits": _KEY_BITS, "left": left}
    open_nodes = dict(wanted)
    while open_nodes:
        bits = max(1, (CELLS // len(open_nodes)).bit_length() - 1)
        table = [
            {"node": n, "dimension": w["dimension"], "low": w["low"], "shift": max(0, w["bits"] - bits), "high": w["low"] + (1 << w["bits"])}
            for n, w in open_nodes.items()
        ]
        state = F.broadcast(_inline(units.sparkSession, table, "node int, dimension int, low bigint, shift int, high bigint"))
        key = F.expr("keys[dimension]")
        inside = units.join(state, "node").withColumn("key", key).where("key >= low AND key < high")
        bins = inside.groupBy("node", F.expr("shiftright(key - low, shift)").alias("bin")).agg(F.sum("bytes").alias("bytes"))
        sums: dict[int, list] = {n: [] for n in open_nodes}
        for row in bins.collect():
            sums[row["node"]].append((row["bin"], row["bytes"]))
        for node, w in list(open_nodes.items()):
            shift = max(0, w["bits"] - bits)
            at, below, held = 0, w["below"], 0
            for number, held in sorted(sums[node]):
                at = number
                if below + held >= w["target"]:
                    break
                below += held
            low = w["low"] + (at << shift)
            if held <= slack or shift == 0:
                # the bin goes to the side that it leaves closer to the target
                takes = w["target"] - below > below + held - w["target"]
                w["cut"] = low + (1 << shift) - 1 if takes else low - 1
                del open_nodes[node]
            else:
                w |= {"low": low, "below": below, "bits": shift}
    return [{"node": n, "dimension": w["dimension"], "cut": w["cut"], "left": w["left"]} for n, w in wanted.items()]


def shard(
    docs: DataFrame, metadata: Sequence[str], text: str = "text", shards: int | None = None, target_bytes: int = 512 << 20
) -> DataFrame:
    """``docs`` without the text, with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    ``shards`` fixes their number, else it follows from ``target_bytes``.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in RESULT if c != text and c not in metadata])
    carried = [c for c in docs.columns if c != text and c not in RESULT]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("crc"),
        F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"),
        *[_coordinate(docs, m).alias(f"at{d}") for d, m in enumerate(metadata)],
        F.monotonically_increasing_id().alias("number"),
    )
    dims = range(len(metadata))
    for d in dims:
        if not isinstance(docs.schema[metadata[d]].dataType, NumericType):
            found = _positions(docs, metadata[d]).withColumnsRenamed({"value": f"at{d}", "position": f"place{d}"})
            rows = rows.join(found, f"at{d}", "left").drop(f"at{d}").withColumnRenamed(f"place{d}", f"at{d}")
    rows = rows.select("row", "size", "crc", "k1", "k2", F.array(*[F.col(f"at{d}") for d in dims]).alias("at"), "number")
    rows = keep(rows, "shard-rows")
    groups = keep(
        rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"), *[F.min(F.col("at")[d]).alias(f"x{d}") for d in dims]), "groups"
    )
    facts = groups.agg(
        F.sum("bytes").alias("bytes"), *[f(f"x{d}").alias(f"{f.__name__}{d}") for d in dims for f in (F.min, F.max)]
    ).first()
    total = facts["bytes"] or 0
    n = shards or max(1, -(-total // target_bytes))
    capacity = total / n

    # groups too large for one shard, in portions
    heavy_groups = groups.where(F.col("bytes") > HEAVY * capacity).select("bytes")  # fewer than shards / HEAVY rows
    share = _oversize([r["bytes"] for r in heavy_groups.collect()], capacity, n)
    large = groups.where(F.col("bytes") > share * capacity).select(
        "k1", "k2", F.ceil(F.col("bytes") / F.lit(max(PORTION * capacity, 1.0))).alias("portions")
    )
    large = F.broadcast(large)  # fewer than shards / min(OVERSIZE) rows
    rows = rows.join(large, ["k1", "k2"], "left").withColumn(
        "portion", F.coalesce(F.pmod(F.xxhash64("number"), F.col("portions")), F.lit(0)).cast("int")
    )
    whole = groups.join(large, ["k1", "k2"], "left_anti").withColumn("portion", F.lit(0))
    cut_up = (
        rows.where("portions IS NOT NULL").groupBy("k1", "k2", "portion").agg(F.sum("size").alias("part_bytes"))
        .join(groups.drop("bytes"), ["k1", "k2"]).withColumnRenamed("part_bytes", "bytes")
    )
    keys = []
    for d in dims:
        low, high = facts[f"min{d}"], facts[f"max{d}"]
        scale = ((1 << _COORDINATE_BITS) - 1) / (high - low) if low is not None and high > low else 0.0
        place = F.coalesce(F.floor((F.col(f"x{d}") - F.lit(low or 0.0)) * scale), F.lit(0)).cast("long")
        keys.append(F.shiftleft(place, _HASH_BITS) + F.col("tie"))
    units = whole.unionByName(cut_up).withColumn("tie", F.xxhash64("k1", "k2", "portion").bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))
    units = keep(units.select("k1", "k2", "portion", "bytes", F.array(*keys).alias("keys"), F.lit(1).alias("node")), "shard-units")

    room = [capacity] * n
    heavy = units.where(F.col("bytes") > HEAVY * capacity)  # fewer than shards / HEAVY rows
    placed = _place_heavy(heavy.select("k1", "k2", "portion", "bytes").collect(), room)
    units = units.where(F.col("bytes") <= HEAVY * capacity)
    nodes = {1: (0, n)}
    while any(count > 1 for _, count in nodes.values()):
        cuts = _cuts(units, len(metadata), nodes, room, NEGLIGIBLE * capacity)
        children = {}
        for c in cuts:
            first, count = nodes[c["node"]]
            children[2 * c["node"]] = (first, c["left"])
            children[2 * c["node"] + 1] = (first + c["left"], count - c["left"])
        leaves = {node: span for node, span in nodes.items() if span[1] == 1}
        if not children:
            break
        nodes = leaves | children
        table = F.broadcast(_inline(spark, cuts, "node int, dimension int, cut bigint"))  # a row for each split node
        child = F.expr("CASE WHEN dimension IS NULL THEN node WHEN keys[dimension] <= cut THEN 2 * node ELSE 2 * node + 1 END")
        units = keep(units.join(table, "node", "left").withColumn("node", child).drop("dimension", "cut"), "shard-units")
    leaf = F.broadcast(_inline(spark, [{"node": k, "shard": span[0]} for k, span in nodes.items()], "node int, shard int"))
    homes = units.join(leaf, "node").select("k1", "k2", "portion", "shard").unionByName(
        _inline(spark, placed, "k1 bigint, k2 bigint, portion int, shard int")
    )
    homed = keep(
        rows.join(homes, ["k1", "k2", "portion"]).select("row", "size", "crc", "number", "shard"), "sharded"
    )
    return _with_slots(homed, carried)


def _with_slots(homed: DataFrame, carried: list[str]) -> DataFrame:
    """Slots without gaps: rows are numbered inside small bins of a shard, after the rows of the bins before."""
    bins = max(1, homed.count() // SLOT_ROWS)
    homed = homed.withColumn("bin", F.pmod(F.xxhash64("number"), F.lit(bins)))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = homed.groupBy("shard", "bin").agg(F.count("*").alias("rows")).select(
        "shard", "bin", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "bin").orderBy("number")
    numbered = homed.withColumn("rank", F.row_number().over(within)).join(offsets, ["shard", "bin"])
    return numbered.select(
        *[F.col(f"row.`{c}`") for c in carried], "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
