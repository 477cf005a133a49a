"""Read CSV files whose quoted fields hold line breaks, in parallel.

Spark reads such a file in one task, because a task that starts in the middle cannot tell whether it stands inside a
quoted field. Here every line is asked what it does to that state. A quote opens a field only where a field begins;
elsewhere in an unquoted field it is text. So a line either ends in a state that does not depend on where it began, or it
keeps the state, or turns it round. A file block is cut into stretches of consecutive lines. The effects of the lines of
a stretch, and then of the stretches of a file, are chained with window functions of bounded groups: the lines of a
stretch, the stretches of a file. Then every stretch knows its records, and the lines with which a stretch begins in the
middle of a record go to the last record that began before. Stretches and records are dealt over the tasks of a shuffle,
so what a task holds does not follow the size of a file block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_STRETCH = ["file", "block", "stretch"]
_STRETCH_BITS = 10  # of a line's number: 1,024 lines
# A line that begins outside quotes and ends inside: whole fields with their commas, then a quoted field without end.
# After a closing quote the rest of a field is text up to the comma.
_OPEN = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
EXTRA = "__extra_field"


def ends_inside_quotes(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted field."""
    return line.contains('"') & line.rlike(_OPEN)


def _state_before(begin: Column, window: Window) -> Column:
    """State before each row of ``window``'s order, if the group begins in state ``begin`` (0 outside, 1 inside).

    Rows have ``fixed``, the state after them if it does not depend on the one before, and ``turns`` (0 or 1).
    """
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turns").over(earlier), F.lit(0))
    known = F.when(
        F.col("fixed").isNotNull(),
        F.struct(F.col("fixed").alias("state"), F.sum("turns").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("turned")),
    )
    last = F.last(known, ignorenulls=True).over(earlier)
    return F.when(last.isNull(), (begin + turned) % 2).otherwise((last["state"] + turned - last["turned"]) % 2)


def read_split_csv(spark: SparkSession, path: str, columns: list[str], files: Column | None = None) -> DataFrame:
    """All columns as text and ``EXTRA``, what a record has beyond them (NULL if nothing).

    A record with fewer fields has NULL for the rest. The first record of each file is its header and must name ``columns``
    in this order. ``files`` is a condition on ``_metadata`` that chooses files of a folder.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    inside = F.concat(F.lit('"'), "value").rlike(_OPEN).cast("int")
    outside = F.col("value").rlike(_OPEN).cast("int")
    # "\n" alone, so that "\r\n" inside a field stays as it is
    lines = (text if files is None else text.filter(files)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.when(outside == inside, outside).alias("fixed"),
        F.when((outside == 1) & (inside == 0), 1).otherwise(0).alias("turns"),
    ).withColumn("stretch", F.shiftright("line", _STRETCH_BITS))
    # what a whole stretch does to the state, and how many records begin in it if it begins outside or inside: one row each
    in_stretch = Window.partitionBy(*_STRETCH).orderBy("line")
    so_far = in_stretch.rowsBetween(Window.unboundedPreceding, 0)
    last_fixed = F.max(F.when(F.col("fixed").isNotNull(), F.struct("line", "fixed", "so_far")))
    stretches = (
        lines.withColumn("so_far", F.sum("turns").over(so_far))
        .withColumn("starts_0", (_state_before(F.lit(0), in_stretch) == 0).cast("int"))
        .withColumn("starts_1", (_state_before(F.lit(1), in_stretch) == 0).cast("int"))
        .groupBy(*_STRETCH)
        .agg(last_fixed.alias("last"), F.sum("turns").alias("all_turns"), F.sum("starts_0").alias("n_0"), F.sum("starts_1").alias("n_1"))
        .select(
            *_STRETCH, "n_0", "n_1",
            ((F.col("last.fixed") + F.col("all_turns") - F.col("last.so_far")) % 2).alias("fixed"),
            F.when(F.col("last").isNull(), F.col("all_turns") % 2).otherwise(0).alias("turns"),
        )
    )
    in_file = Window.partitionBy("file").orderBy("block", "stretch")
    stretches = stretches.select(
        *_STRETCH, "n_0", "n_1", _state_before(F.lit(0), in_file).alias("begins"), (F.row_number().over(in_file) == 1).alias("is_first")
    ).withColumn("n", F.when(F.col("begins") == 0, F.col("n_0")).otherwise(F.col("n_1")))
    endless = (F.sum("n").over(Window.partitionBy("file", "block")) == 0) & (F.col("block") < F.max("block").over(Window.partitionBy("file")))
    # the last record that began in an earlier stretch
    begun = F.when(F.col("n") > 0, F.struct("block", "stretch", F.col("n").alias("number"), "is_first"))
    begun = F.last(begun, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    refused = F.raise_error(F.concat(F.lit("a quoted field spans a whole block of "), F.col("file")))
    stretches = stretches.select(*_STRETCH, "begins", "is_first", F.when(endless, refused).otherwise(begun).alias("begun"))

    number = F.sum(F.col("starts").cast("int")).over(so_far)
    own = F.struct("block", "stretch", "number", "is_first")
    records = (
        lines.join(stretches, _STRETCH)
        .withColumn("starts", _state_before(F.col("begins"), in_stretch) == 0)
        .withColumn("number", number)
        .select("file", F.when(F.col("number") > 0, own).otherwise(F.col("begun")).alias("record"), "block", "line", "value")
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
    )
    names = [*columns, EXTRA]
    schema = ", ".join(f"`{c}` string" for c in names)
    # PERMISSIVE fills up short records; what is too long shows in EXTRA
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    records = (
        records.select(
            "file",
            (F.col("record.is_first") & (F.col("record.number") == 1)).alias("is_header"),
            F.rtrim(F.array_join(F.transform("lines", lambda x: x["value"]), "\n"), F.lit("\r")).alias("text"),
        )
        .filter(F.col("text") != "")
        .select("file", "is_header", F.from_csv("text", F.lit(schema), options).alias("r"))
    )
    named = F.array(*[F.col("r")[c] for c in names]).eqNullSafe(F.array(*[F.lit(c) for c in columns], F.lit(None)))
    refused = F.raise_error(F.concat(F.lit(f"header other than {','.join(columns)} in "), F.col("file")))
    is_record = F.when(~F.col("is_header"), True).when(named, False).otherwise(refused.cast("boolean"))
    return records.filter(is_record).select("r.*")
