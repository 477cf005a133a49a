"""Divergence between the vocabularies of sources, from in-mapper stripes.

A stripe is one term of one language with its document frequency and its count in each source. Partitions fold whole
documents into a hash table of stripes; a table that grows too large is spilled and a new one begun. Spark's sort shuffle
brings the stripes of a term together, and one pass over the sorted rows merges them. Merged stripes are dealt into bins of
bounded size by language and term, beside the totals of that language's sources, and give the divergences directly: sums for
all pairs of sources, and each source's own leading terms.

With counts n of a source over the V kept terms of a language and N their sum, p = 1 + floor(scale * (n + 1) / (N + V)).
The divergence of p from q is floor((p - q)^2 / q), added up over all kept terms for two sources; for a term it is taken
against the language as a whole. All of it is whole numbers, exact for up to ``MOST`` counted words a language.

A key has at most one row per table of stripes, so a word of a third of all tokens weighs as much as any other.
The pairs of a language's sources are its result, so their number grows with the square of the number of sources; the rows of one
source are worked out at a time.

Defined results: NULL text, language and source are ''; repeated rows count each time; a text without terms still makes
its source occur; a language without kept terms has pairs of value 0 and no terms; an empty table gives an empty result;
texts may have any length; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.chunks import pieces, text_buffer
from ordermill.session import keep

# A table of stripes is spilled when it holds more (term, source) entries.
TABLE_ENTRIES = 400_000
# Folded batches wait until they hold so many entries before they join the table.
WAITING_ENTRIES = 400_000
# Entries of a bin, about.
BIN_ENTRIES = 100_000
# Cells of a block of terms by sources.
BLOCK_CELLS = 1 << 18
SCALE = 10**9
MOST = 9 * 10**15
_STRIPE = "lang string, term string, df long, stripe array<struct<source:string,n:long>>"
_STRIPE_TYPE = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
_RESULT = "lang string, source string, part string, item string, value long"

_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of texts, lower case, and how many each text has: runs of letters and of characters beyond ASCII."""
    data, offsets = text_buffer(pa.table({"text": column}), 0)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(column), np.int64)
    inside = _TERM[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | border[1:-1]
    starts = np.flatnonzero(begins)
    # a term's letters follow each other once the gaps are taken out
    cuts = np.append(np.cumsum(inside)[starts] - 1, inside.sum()).astype(np.int64)
    letters = _LOWER[data[inside]]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
    return found, np.diff(np.searchsorted(starts, offsets))


def _folded(batch: pa.RecordBatch) -> pa.Table:
    """Entries (lang, source, term, df, n) of a batch of documents, one for each; term '' for each source that occurs."""
    found, per_text = terms(batch.column("text"))
    groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
    own = groups.group_by(["lang", "source"], use_threads=False).aggregate([])
    # number of the group of each document
    numbered = own.append_column("g", pa.array(np.arange(own.num_rows)))
    seat = groups.append_column("row", pa.array(np.arange(groups.num_rows)))
    joined = seat.join(numbered, ["lang", "source"], use_threads=False).sort_by("row")
    group = np.asarray(joined.column("g").combine_chunks()).astype(np.int64)

    coded = found.dictionary_encode()
    n_terms, n_docs = max(1, len(coded.dictionary)), max(1, batch.num_rows)
    doc = np.repeat(np.arange(batch.num_rows), per_text)
    key = (group[doc] * n_terms + np.asarray(coded.indices).astype(np.int64)) * n_docs + doc
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))  # a term in a document
    in_doc = np.diff(np.append(first, len(key)))
    entry = key[first] // n_docs
    at = np.flatnonzero(np.diff(entry, prepend=-1))  # a term in a group
    g, term = entry[at] // n_terms, entry[at] % n_terms
    entries = pa.table(
        {
            "lang": own.column("lang").take(pa.array(g)),
            "source": own.column("source").take(pa.array(g)),
            "term": coded.dictionary.take(pa.array(term)).cast(pa.large_string()).cast(pa.string()),
            "df": pa.array(np.diff(np.append(at, len(entry))), pa.int64()),
            "n": pa.array(np.add.reduceat(in_doc, at) if len(at) else in_doc, pa.int64()),
        }
    )
    zeros = pa.array(np.zeros(own.num_rows, np.int64))
    occur = own.append_column("term", pa.array([""] * own.num_rows, pa.string())).append_column("df", zeros).append_column("n", zeros)
    return pa.concat_tables([entries, occur.select(entries.column_names)])


def _added(tables: list[pa.Table]) -> pa.Table:
    """Entries of the same language, source and term in one."""
    both = pa.concat_tables(tables)
    summed = both.group_by(["lang", "source", "term"], use_threads=False).aggregate([("df", "sum"), ("n", "sum")])
    return summed.rename_columns(["lang", "source", "term", "df", "n"])


def _stripes(entries: pa.Table) -> pa.Table:
    """One stripe for each (lang, term), in order; the document frequency is summed over the sources."""
    by = entries.sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).combine_chunks()
    n = by.num_rows
    new = np.ones(n, bool)
    for name in ("lang", "term"):
        column = by.column(name).combine_chunks()
        same = np.asarray(pc.equal(column.slice(1), column.slice(0, n - 1))) if n > 1 else np.zeros(0, bool)
        new[1:] = new[1:] & same if name == "lang" else ~(new[1:] & same)
    at = np.flatnonzero(new)
    sources = pa.StructArray.from_arrays([_whole(by.column("source")), _whole(by.column("n"))], ["source", "n"])
    stripe = pa.ListArray.from_arrays(pa.array(np.append(at, n), pa.int32()), sources)
    df = np.asarray(by.column("df"))
    heads = by.select(["lang", "term"]).take(pa.array(at))
    return heads.append_column("df", pa.array(np.add.reduceat(df, at) if n else df, pa.int64())).append_column("stripe", stripe)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition's documents (columns text, lang, source)."""
    held: list[pa.Table] = []
    table_rows = waiting = 0
    for batch in batches:
        text = batch.schema.names.index("text")
        for piece in pieces(batch, text):
            if not piece.num_rows:
                continue
            held.append(_folded(piece))
            waiting += held[-1].num_rows
            if waiting > WAITING_ENTRIES:
                held = [_added(held)]
                table_rows, waiting = held[0].num_rows, 0
            if table_rows > TABLE_ENTRIES:
                yield from _stripes(held[0]).to_batches()
                held, table_rows = [], 0
    if held:
        yield from _stripes(_added(held)).to_batches()


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition sorted by (lang, term), those of the same key added up."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = (batch.column("lang")[-1].as_py(), batch.column("term")[-1].as_py())
        rows = pa.Table.from_batches([batch])
        ends = pc.and_(pc.equal(rows["lang"], last[0]), pc.equal(rows["term"], last[1]))
        done = rows.filter(pc.invert(ends))
        if done.num_rows:  # the last key may go on in the next batch
            yield from _merged([*held, done]).to_batches()
            held = []
        elif held and (held[0]["lang"][0].as_py(), held[0]["term"][0].as_py()) != last:
            yield from _merged(held).to_batches()
            held = []
        held.append(rows.filter(ends))
        if len(held) > 64:
            held = [_merged(held)]
    if held:
        yield from _merged(held).to_batches()


def _merged(tables: list[pa.Table]) -> pa.Table:
    rows = pa.concat_tables(tables).combine_chunks()
    stripe = _whole(rows.column("stripe"))
    sizes = np.asarray(pc.list_value_length(stripe)).astype(np.int64)
    inner = stripe.flatten()
    at = pa.array(np.repeat(np.arange(rows.num_rows), sizes))
    # a stripe's document frequency is counted with its first entry
    df = np.zeros(int(sizes.sum()), np.int64)
    df[(np.cumsum(sizes) - sizes)[sizes > 0]] = np.asarray(rows.column("df"))[sizes > 0]
    entries = pa.table(
        {
            "lang": rows.column("lang").take(at),
            "source": inner.field("source"),
            "term": rows.column("term").take(at),
            "df": pa.array(df),
            "n": inner.field("n"),
        }
    )
    return _stripes(_added([entries]))


def share(n: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * n / whole) for n <= whole <= MOST, by long division in steps of a thousand."""
    whole = np.asarray(whole, np.int64)
    if whole.size and int(whole.max()) > MOST:
        raise OverflowError(f"more than {MOST} counted words in a language")
    rest, found = np.asarray(n, np.int64), np.zeros(np.broadcast(n, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        digit = rest // whole
        found = found * 1000 + digit
        rest = rest - digit * whole
    return found + 1


def _divergences(stripes: pa.Table, groups: pa.Table, ranks: int) -> pa.Table:
    """Of one bin: what its terms add to each pair of sources, and its leading terms of each source.

    ``groups`` has every source of the language with its count ``n``, the language's count ``all_n`` and kept terms ``v``.
    """
    lang = groups["lang"][0].as_py()
    groups = groups.sort_by("source").combine_chunks()
    sources, n_sources = _whole(groups["source"]), groups.num_rows
    v = groups["v"][0].as_py()
    whole = np.asarray(groups["n"]).astype(np.int64) + v
    all_whole = groups["all_n"][0].as_py() + v
    sums = np.zeros((n_sources, n_sources), np.int64)
    leading: list[pa.Table] = []
    stripe = _whole(stripes["stripe"]) if stripes.num_rows else pa.array([], _STRIPE_TYPE)
    sizes = np.asarray(pc.list_value_length(stripe)).astype(np.int64)
    names = _whole(stripes["term"]) if stripes.num_rows else pa.array([], pa.string())
    block = max(1, BLOCK_CELLS // n_sources)
    for first in range(0, stripes.num_rows, block):
        rows = min(block, stripes.num_rows - first)
        inner = stripe.slice(first, rows).flatten()
        row = np.repeat(np.arange(rows), sizes[first : first + rows])
        column = np.asarray(pc.index_in(inner.field("source"), sources)).astype(np.int64)
        n = np.asarray(inner.field("n")).astype(np.int64)
        counts = np.zeros((rows, n_sources), np.int64)
        counts[row, column] = n
        p = share(counts + 1, whole)
        for s in range(n_sources):
            off = p[:, s : s + 1] - p
            sums[s] += (off * off // p).sum(axis=0)
        q = share(counts.sum(axis=1) + 1, all_whole)[row]
        own = p[row, column]
        lead = np.flatnonzero((n > 0) & (own > q))
        off = own[lead] - q[lead]
        leading.append(
            pa.table({"source": pa.array(column[lead]), "item": names.slice(first, rows).take(pa.array(row[lead])), "value": off * off // q[lead]})
        )
        leading = [_first(pa.concat_tables(leading), ranks)]
    lead = leading[0] if leading else pa.table({"source": pa.array([], pa.int64()), "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    one, other = (x.ravel() for x in np.indices(sums.shape))
    apart = one != other
    parts = [
        ("pair", sources.take(pa.array(one[apart])), sources.take(pa.array(other[apart])), pa.array(sums.ravel()[apart])),
        ("term", sources.take(_whole(lead["source"])), _whole(lead["item"]), _whole(lead["value"])),
    ]
    return pa.concat_tables(
        [
            pa.table({"lang": pa.array([lang] * len(value), pa.string()), "source": source, "part": pa.array([part] * len(value), pa.string()), "item": item, "value": value})
            for part, source, item, value in parts
        ]
    )


def _first(rows: pa.Table, ranks: int) -> pa.Table:
    """The ``ranks`` first rows of each source, by value from the top and item."""
    rows = rows.sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")]).combine_chunks()
    source = np.asarray(rows["source"])
    begin = np.searchsorted(source, source)
    return rows.filter(pa.array(np.arange(len(source)) - begin < ranks))


def stripes(docs: DataFrame, text: Column, lang: Column, source: Column, name: str = "stripes") -> DataFrame:
    """Merged stripes (lang, term, df, stripe), stored. The term '' has every source of a language with a count of 0."""
    empty = F.lit("")
    whole = docs.select(F.coalesce(text, empty).alias("text"), F.coalesce(lang, empty).alias("lang"), F.coalesce(source, empty).alias("source"))
    folded = whole.mapInArrow(fold, _STRIPE).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return keep(folded.mapInArrow(merge, _STRIPE), name)


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 3,
    ranks: int = 200,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair``: each source of a language against each other one (``item``), all ranks. Part ``term``: the terms that a
    source has and favours over its language, up to rank ``ranks``. Ranks go by value from the top, then by item. Terms of
    fewer than ``min_docs`` documents of their language are left out.
    """
    found = stripes(docs, F.col(text).cast("string"), F.col(lang).cast("string"), F.col(source).cast("string"))
    kept = found.filter((F.col("df") >= min_docs) & (F.col("term") != ""))
    entries = found.filter((F.col("df") >= min_docs) | (F.col("term") == "")).select("lang", "term", F.inline("stripe"))
    by_source = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.size("stripe")).alias("entries"))
    in_lang = Window.partitionBy("lang")
    groups = by_source.join(by_lang, "lang", "left").select(
        "lang", "source", "n", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("entries", F.lit(0)).alias("entries"),
        F.sum("n").over(in_lang).alias("all_n"), F.count(F.lit(1)).over(in_lang).alias("sources"),
    )
    # bins of a language: by its entries, and so many that a bin's terms weigh more than its pairs of sources
    bins = F.greatest(F.lit(1), F.least(F.col("entries") / BIN_ENTRIES, F.col("v") / F.col("sources"))).cast("int")
    groups = keep(groups.withColumn("bins", bins), "source_totals")
    dealt_groups = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    dealt = kept.join(groups.select("lang", "bins").distinct(), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("bins")).cast("int").alias("bin"), "term", "stripe"
    )
    work = dealt.groupBy("lang", "bin").cogroup(dealt_groups.groupBy("lang", "bin"))
    emitted = keep(work.applyInArrow(lambda left, right: _divergences(left, right, ranks), _RESULT), "divergences")
    pairs = emitted.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [
        pairs.withColumn("rank", F.row_number().over(best)),
        emitted.filter("part = 'term'").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks),
    ]
    return reduce(DataFrame.unionByName, ranked)
