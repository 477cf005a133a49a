"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every window of an item (``window`` consecutive words, or the whole of a shorter item) is a set of word shingles with
their offsets. A document that contains the window holds all of these shingles, so one of them, the prefix, is enough to
find every candidate; ordered by rarity in the corpus, the rarest costs the least. The steps are:

1. shingles of the documents that occur in any item, with their position and the words around (one pass over the texts),
2. how often each occurs; windows of which a shingle does not occur at all are out,
3. documents' shingles joined with the windows' prefix; the window must begin and end inside the document,
4. exact comparison of the candidate's words with the window's.

The items' shingles are broadcast while there are at most ``BROADCAST_ROWS`` of them, which is counted first; beyond
that Spark joins by shuffles, in which positions travel without their texts. Results are by text, identified by two 64-bit hashes, and joined to
the documents' other columns.

Defined results: NULL and empty texts have no words and no hits; NULL item ids count as the empty id; repeated rows are
judged alike; equal item ids are one item; an empty table of items hits nothing. All input columns but the text are
carried by ``mark``; an input column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import keep

RESULT = ["n_words", "n_hit", "items", "contaminated"]
WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 1_000_000
# Fixed value: what separates words, all of ASCII but digits and small letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    small = F.when(F.octet_length(body) == F.char_length(body), F.lower(body)).otherwise(
        F.translate(body, _CAPITALS, _CAPITALS.lower())
    )
    return F.array_remove(F.split(small, GAP, -1), "")


def shingles(of: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order."""
    single = F.transform(of, lambda w: F.xxhash64(w))
    found = single
    for k in range(1, size):
        left = F.greatest(F.size(of) - k, F.lit(0))
        found = F.zip_with(F.slice(found, 1, left), F.slice(single, 1 + k, left), lambda a, b: F.xxhash64(a, b))
    return found


def _shared(read: DataFrame, known: DataFrame, size: int, whole: bool) -> DataFrame:
    """Rows of ``read`` (__k1, __k2, w, row) by position: ``pos`` and ``h`` of each shingle that is ``known``.

    With ``whole`` every text has a row of its own besides, at position -1. Shingles are hashed word by word as the words are
    listed, which Spark compiles. If the known ones are too many to be broadcast, positions and hashes travel alone, and the
    texts are joined once with the positions that they have.
    """
    lone = F.lit(_NO_SHINGLE).cast("long")
    listed = F.concat(F.array(F.lit("")), "w") if whole else F.col("w")
    spread = read.select("__k1", "__k2", "w", "row", F.posexplode(listed).alias("pos", "word"))
    spread = spread.withColumn("pos", F.col("pos") - F.lit(int(whole)))
    hashed = F.xxhash64("word")
    for k in range(1, size):
        hashed = F.xxhash64(hashed, F.xxhash64(F.get("w", F.col("pos") + k)))
    inside = F.col("pos") + size <= F.size("w")
    if known.count() <= BROADCAST_ROWS:
        if whole:
            known = known.unionByName(known.sparkSession.range(1).select(lone.alias("h")))
        spread = spread.withColumn("h", F.when(F.col("pos") < 0, lone).when(inside, hashed)).drop("word")
        return spread.join(F.broadcast(known), "h")
    narrow = spread.where((F.col("pos") >= 0) & inside).select("__k1", "__k2", "pos", hashed.alias("h")).join(known, "h")
    places = F.sort_array(F.collect_set(F.struct("pos", "h"))).alias("places")
    held = keep(narrow.groupBy("__k1", "__k2").agg(places), "shared-places")
    places = F.col("places")
    if whole:
        itself = F.array(F.struct(F.lit(-1).alias("pos"), lone.alias("h")))
        places = F.concat(itself, F.coalesce(places, F.slice(itself, 1, 0)))
    return read.join(held, ["__k1", "__k2"], "left" if whole else "inner").select("__k1", "__k2", "w", "row", F.inline(places))


def _bounded(table: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its counted rows are few enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: words, shingle size, and the ids of the items that have it."""
    cut = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(0), F.col("size") - F.col("length")))
    cut = cut.withColumn("size", F.size("w")).withColumn("at", starts)
    cut = cut.select("item", "length", F.expr("slice(w, at + 1, length)").alias("words"))
    return cut.groupBy("words", "length").agg(F.collect_set("item").alias("items")).withColumn(
        "id", F.xxhash64("words", "length")
    )


def _keys(text: Column) -> list[Column]:
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(body).alias("__k1"), F.xxhash64(F.lit(1), body).alias("__k2")]


_NO_SHINGLE = 0x5EED  # stands first in each text's shingles, and for the text as a whole


def _matches(
    texts: DataFrame, text: str, carried: list[str], items: DataFrame, item_id: str, item_text: str, window: int, shingle: int
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The items' windows, verified occurrences (__k1, __k2, begin, length, id), and all rows (__k1, __k2, n, row)."""
    windows = keep(_item_windows(items, item_id, item_text, window), "item-windows")
    sizes = sorted(r[0] for r in windows.select(F.least("length", F.lit(shingle)).alias("s")).distinct().collect())
    parts, grams = [], []
    row = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.struct(F.lit(1).alias("none"))
    read = texts.select(*_keys(F.col(text)), words(F.col(text)).alias("w"), row.alias("row"))
    for size in sizes:
        mine = windows.where(F.least("length", F.lit(shingle)) == size)
        grams.append(mine.select("id", F.posexplode(shingles(F.col("words"), size)).alias("offset", "h")))
        known = keep(grams[-1].select("h").distinct(), "item-shingles")
        # the first pass gives every text a row too
        spread = _shared(read, known, size, size == sizes[0])
        low = F.greatest(F.col("pos") - F.lit(window - size), F.lit(0))
        parts.append(
            spread.select(
                "__k1", "__k2", "pos", "h", F.lit(size).alias("size"), F.size("w").alias("n"), low.alias("low"),
                F.when(F.col("pos") >= 0, F.slice("w", low + 1, F.lit(2 * window))).alias("near"),
                F.when(F.col("pos") < 0, F.col("row")).alias("row"),
            )
        )
    if not parts:
        return windows, None, None
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = keep(found, "shared-shingles")
    whole = found.where("pos < 0").select("__k1", "__k2", "n", "row")
    found = found.where("pos >= 0").drop("row")
    order = found.groupBy("size", "h").agg(F.count("*").alias("times"))
    all_grams = grams[0].withColumn("size", F.lit(sizes[0]))
    for size, more in zip(sizes[1:], grams[1:]):
        all_grams = all_grams.unionByName(more.withColumn("size", F.lit(size)))
    prefix = (
        all_grams.join(order, ["size", "h"], "left")
        .groupBy("id")
        .agg(F.min(F.struct("times", "h", "offset", "size")).alias("p"), F.count_if(F.col("times").isNull()).alias("absent"))
        .where("absent = 0")
        .select("id", "p.h", "p.offset", "p.size")
        .join(windows.select("id", "words", "length"), "id")
    )
    prefix = _bounded(keep(prefix, "item-prefixes"))
    begin = F.col("pos") - F.col("offset")
    tried = found.join(prefix, ["size", "h"]).withColumn("begin", begin)
    tried = tried.where("begin >= 0 AND begin + length <= n AND slice(near, begin - low + 1, length) = words")
    return windows, tried.select("__k1", "__k2", "begin", "length", "id").distinct(), whole


def _hits(windows: DataFrame, matches: DataFrame) -> DataFrame:
    """(__k1, __k2, n_hit, items) of every text that has a hit."""
    matches = keep(matches, "matches")
    spans = matches.groupBy("__k1", "__k2").agg(
        F.sort_array(F.collect_set(F.struct("begin", (F.col("begin") + F.col("length")).alias("end")))).alias("spans")
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'reach', 0), (a, s) -> named_struct("
        "'n', a.n + greatest(0, s.end - greatest(s.begin, a.reach)), 'reach', greatest(a.reach, s.end)), a -> a.n)"
    )
    named = (
        matches.select("__k1", "__k2", "id").distinct().join(windows.select("id", F.explode("items").alias("item")), "id")
        .groupBy("__k1", "__k2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return spans.select("__k1", "__k2", covered.alias("n_hit")).join(named, ["__k1", "__k2"])


def mark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``n_hit``, ``items`` (ids, sorted) and ``contaminated``."""
    docs = docs.drop(*[c for c in RESULT if c != text])
    carried = [c for c in docs.columns if c != text]
    windows, matches, whole = _matches(docs, text, carried, items, item_id, item_text, window, shingle)
    if matches is None:
        light = docs.select(*[F.col(f"`{c}`") for c in carried], F.size(words(F.col(text))).cast("long").alias("n_words"))
        marked = light.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    else:
        light = whole.select("__k1", "__k2", *[F.col(f"row.`{c}`") for c in carried], F.col("n").cast("long").alias("n_words"))
        marked = light.join(_hits(windows, matches), ["__k1", "__k2"], "left")
    return marked.select(
        *[F.col(f"`{c}`") for c in carried], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """The documents without a hit, with the columns of ``docs``."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    windows, matches, _ = _matches(inner, "text", [], items, item_id, item_text, window, shingle)
    if matches is None:
        return docs
    hits = matches.select("__k1", "__k2").distinct()
    keyed = inner.select("row", *_keys(F.col("text")))
    return keyed.join(hits, ["__k1", "__k2"], "left_anti").select("row.*")
