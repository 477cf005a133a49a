"""SimHash near-dedup by covering locality-sensitive hashing.

A text's fingerprint has 64 bits; a bit is set if it is set in more than half of the 64-bit hashes of the text's word
shingles. Texts link where fingerprints differ in at most ``radius`` bits. Every bit place gets a vector of radius + 1
bits, and every nonzero vector v a table whose mask keeps the places with an odd product with v. The places in which a
pair within the radius differs are at most ``radius`` vectors, so some nonzero v has an even product with all of them:
under the mask of v the pair is equal. 2^(radius + 1) - 1 tables thus find every link, and each candidate pair is
checked by counting its differing bits.

Only distinct fingerprints enter the tables; copies share theirs. A bucket of more than ``bucket_rows`` fingerprints is
dealt out in blocks, and each pair of blocks is a cell of its own, so no bucket is cut short and none fills a task.
A cell gives a spanning forest of its links, never all of them; the forests of the cells of one part, which hold the same
fingerprints under several masks, become stars there, and ``components`` joins the stars of all parts.

Defined results: a text without words, an empty and a NULL text have fingerprint 0 and link like any other; fewer
words than a shingle make one shingle; repeated rows belong together; ids may be NULL and repeated (``component_id`` is
the smallest id that is not NULL, or NULL). All input columns are carried; an input column named like a result column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.llm.anchors import Units
from ordermill.llm.chunks import columns_of, extended, finish, pack, pieces, row_of, text_buffer, unpack
from ordermill.llm.components import components
from ordermill.session import keep

RESULT = ["fingerprint", "component_id"]
SHINGLE = 3
RADIUS = 3
BUCKET_ROWS = 20_000
PART_ROWS = 100_000
SEED = 42
_SLICE = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def masks(radius: int) -> list[int]:
    """The kept bit places of each table."""
    vectors = (1 << (radius + 1)) - 1
    place = [1 + i % vectors for i in range(64)]
    return [sum(1 << i for i in range(64) if (place[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def fingerprint(hashes: Iterator[int], n: int) -> int:
    """Bits that are set in more than half of ``n`` hashes."""
    counts = np.zeros(64, np.int64)
    done = 0
    while done < n:
        part = np.fromiter(hashes, np.uint64, min(_SLICE, n - done))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        done += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def prints_of(rows: pa.Table, text: int, shingle: int) -> pa.Array:
    """The fingerprint of each text, as a signed number."""
    data, offsets = text_buffer(rows, text)
    units = Units.of_words(_LOWER[data], offsets)
    body = units.data.tobytes()
    hashed = xxhash.xxh64_intdigest
    found = []
    for a, b in zip(units.texts[:-1].tolist(), units.texts[1:].tolist()):
        width = min(shingle, b - a)
        n = b - a - width + 1 if width else 0
        if n:
            begin, end = units.starts[a : a + n].tolist(), units.ends[a + width - 1 : b].tolist()
            found.append(fingerprint((hashed(body[s:e], SEED) for s, e in zip(begin, end)), n))
        else:
            found.append(0)
    return pa.array(found, pa.int64())


def fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` without the text, with ``__print``, the fingerprint as a long."""
    column = docs.columns.index(text)
    schema = extended(StructType([f for f in docs.schema.fields if f.name != text]), "__print long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                found = prints_of(pa.Table.from_batches([piece]), column, shingle)
                yield piece.drop_columns([text]).append_column("__print", found)

    return docs.mapInArrow(run, schema)


def _links(prints: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """Edges (a, b) that join all fingerprints within the radius, as stars of parts."""
    tables = [F.struct(F.lit(t).alias("t"), F.col("p").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks(radius))]
    members = prints.select("p", F.explode(F.array(*tables)).alias("x")).select("p", "x.t", "x.key")
    sizes = members.groupBy("t", "key").count().where(F.col("count") > bucket_rows)
    hot = keep(sizes.select("t", "key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("blocks")), "buckets")
    if not hot.isEmpty():
        dealt = members.join(hot, ["t", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("p", F.lit(1)), F.col("blocks").cast("long")).cast("int")
        other = F.explode(F.expr("IF(blocks = 1, array(0), filter(sequence(0, blocks - 1), j -> j != own))"))
        members = dealt.withColumn("own", own).withColumn("other", other)
        members = members.select("p", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    else:
        members = members.select("p", "t", "key", F.lit(0).alias("i"), F.lit(0).alias("j"))
    parts = max(1, -(-prints.count() * len(tables) // PART_ROWS))
    cells = members.select("p", F.xxhash64("t", "key", "i", "j").alias("cell"))

    def link(table: pa.Table) -> pa.Table:
        a, b = _stars(*_forest(np.asarray(table.column("p")), np.asarray(table.column("cell")), radius))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    part = F.pmod(F.col("cell"), F.lit(parts)).alias("part")
    return cells.select("p", "cell", part).groupBy("part").applyInArrow(link, "a long, b long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _forest(prints: np.ndarray, cells: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each cell, fewer than its members, that connect all its pairs within the radius.

    Members of a cell are compared with those 1, 2, ... places further on. Pairs that are connected already are left out.
    """
    by = np.lexsort((prints, cells))
    prints, cells = prints[by], cells[by]
    root = np.arange(len(prints))
    left = np.flatnonzero(cells[1:] == cells[:-1])
    step = 1
    while len(left):
        apart = left[root[left] != root[left + step]]
        near = apart[np.bitwise_count((prints[apart] ^ prints[apart + step]).view(np.uint64)) <= radius]
        root = _united(root, near, near + step)
        step += 1
        left = left[left + step < len(cells)]
        left = left[cells[left] == cells[left + step]]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return prints[moved], prints[root[moved]]


def _united(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root``, the smallest member of the group of each, after the groups of each x and y became one."""
    while len(x):
        high, low = np.maximum(root[x], root[y]), np.minimum(root[x], root[y])
        np.minimum.at(root, high, low)
        while True:
            flat = root[root]
            if np.array_equal(flat, root):
                break
            root = flat
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return root


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a part with the same groups, each print next to the smallest of its group: cells of a part share prints."""
    prints, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = _united(np.arange(len(prints)), at[: len(a)], at[len(a) :])
    moved = np.flatnonzero(root != np.arange(len(root)))
    return prints[moved], prints[root[moved]]


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``docs`` with ``fingerprint`` (16 hex digits) and ``component_id``."""
    docs = docs.drop(*[c for c in RESULT if c not in (id, text)])
    read = keep(fingerprints(docs, text, shingle), "fingerprints")
    grouped = _component_ids(read, id, radius, bucket_rows)
    hexed = F.lower(F.lpad(F.hex("__print"), 16, "0")).alias("fingerprint")
    # texts do not travel: the fingerprints are joined to the other columns
    return read.join(grouped.select("__print", "component_id"), "__print").select(
        *[F.col(f"`{c}`") for c in read.columns if c != "__print"], hexed, "component_id"
    )


def _component_ids(read: DataFrame, id: str, radius: int, bucket_rows: int) -> DataFrame:
    """(__print, root, component_id) of each distinct fingerprint."""
    prints = keep(read.groupBy(F.col("__print").alias("p")).agg(F.min(F.col(f"`{id}`")).alias("least")), "prints")
    roots = components(_links(prints, radius, bucket_rows))
    rooted = prints.join(roots, prints["p"] == roots["vertex"], "left").select(
        "p", "least", F.coalesce("root", "p").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return keep(rooted.join(named, "root").select(F.col("p").alias("__print"), "root", "component_id"), "component-ids")


def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """The document with the smallest id (NULL last) of each component, with the columns of ``docs``."""
    inner = docs.select(row_of(docs, text), F.col(id).alias("id"), F.col(text).alias("text"))
    chunks = pack(inner, "text", "simhash-chunks")

    def read(number: int, rows: pa.Table, _: dict) -> pa.Table:
        n = rows.num_rows
        return pa.table({
            "chunk": pa.array(np.full(n, number)), "place": pa.array(np.arange(n)), "id": rows.column("id"),
            "__print": prints_of(rows, 2, shingle),
        })

    schema = StructType.fromDDL("chunk long, place long").add("id", inner.schema["id"].dataType)
    light = keep(finish(chunks, read, extended(schema, "__print long")), "fingerprints")
    grouped = _component_ids(light, "id", radius, bucket_rows)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "chunk", "place")).alias("first")
    chosen = light.join(grouped, "__print").groupBy("root").agg(first).select("first.chunk", "first.place")
    chosen = chosen.groupBy("chunk").agg(F.collect_list("place").alias("places"))  # at most the rows of a chunk

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, places in zip(batch.column(0), batch.column(1)):
                kept = unpack(rows.as_py()).take(pa.array(sorted(places.as_py()), pa.int64()))
                yield from kept.select(["row", "text"]).to_batches()

    kept = chunks.join(chosen, "chunk").select("rows", "places").mapInArrow(left, inner.select("row", "text").schema)
    return columns_of(kept, docs, text, F.col("text"))


__all__ = ["fingerprint", "masks", "near_duplicates", "one_of_each"]
