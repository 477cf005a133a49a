"""Load the eight raw tables from CSV files.

One rule holds for every table and every size of file. A quote opens a quoted field only where a field begins. A
record with fewer fields than columns has NULL for the rest; one with more fields fails the load, unless the extra
ones are empty. A quoted field may hold line breaks. All files of a folder must have the same header; columns are bound by
its names.

How a file is read is decided by what it holds. One pass over the lines finds the files in which a line ends inside
quotes; these are read in blocks, all others line by line.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.plans import files
from ordermill.plans.lake import Lake
from ordermill.schemas import OTHER_SPELLINGS, RAW_COLUMNS, raw_schema
from ordermill.session import at_the_same_time
from ordermill.sources.copying import load_report
from ordermill.sources.split_csv import EXTRA, ends_inside_quotes, read_split_csv

# File name of each table, without prefix and ending.
FILE_STEMS = {
    "orders": "orders_dataset",
    "order_items": "order_items_dataset",
    "customers": "customers_dataset",
    "products": "products_dataset",
    "sellers": "sellers_dataset",
    "payments": "order_payments_dataset",
    "reviews": "order_reviews_dataset",
    "category_translation": "product_category_name_translation",
}
# The translation file goes without the prefix that the others share.
UNPREFIXED = ("category_translation",)
# More files of one folder with line breaks in fields than this are not named one by one: all its files are read in blocks.
NAMED_FILES = 1_000
# Texts that mean a missing value.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def file_of(csv_root: str, table: str, stem_prefix: str = "") -> str:
    prefix = "" if table in UNPREFIXED else stem_prefix
    return f"{csv_root.rstrip('/')}/{prefix}{FILE_STEMS[table]}.csv"


def source_state(spark: SparkSession, csv_root: str, stem_prefix: str = "") -> dict[str, list]:
    """Length and time of change of every file of every table, to tell whether sources changed."""
    found = {}
    for table in RAW_COLUMNS:
        system, path = files.hadoop_path(spark, file_of(csv_root, table, stem_prefix))
        found[table] = []
        listed = system.listFiles(path, True) if system.exists(path) else None
        while listed is not None and listed.hasNext():
            status = listed.next()
            found[table].append([status.getPath().getName(), status.getLen(), status.getModificationTime()])
        found[table].sort()
    return found


def _typed(text: Column, kind: T.DataType) -> Column:
    value = F.when(~text.isin(*MISSING_MARKERS), text)
    if isinstance(kind, T.IntegerType):
        # whole numbers may be written with decimals, as in "3.0"
        return value.cast("decimal(20,4)").cast("int")
    return value.cast(kind)


def split_files(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path`` in which a record goes over the end of a line.

    Lines end where Spark's CSV reader ends them. Up to the first such record every line begins outside quotes, so one
    that ends inside them gives its file away. At most ``NAMED_FILES`` + 1 are looked for.
    """
    lines = spark.read.text(path).filter(ends_inside_quotes(F.col("value")))
    named = lines.select(F.col("_metadata.file_path").alias("file")).distinct().limit(NAMED_FILES + 1)
    return [r["file"] for r in named.collect()]


def _read_lines(reader: DataFrameReader, path: str, found: list[str], chosen: Column | None) -> DataFrame:
    """Records of one line each, with ``EXTRA``. Spark compares the header of every file with ``found``."""
    kept = "__whole_record"
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*found, kept]])
    rows = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", kept).schema(fields).csv(path)
    rows = rows if chosen is None else rows.filter(chosen)
    # Spark keeps the text of records that are too short or too long; read once more, the long ones have a field too many
    schema = ", ".join(f"`{c}` string" for c in [*found, EXTRA])
    again = F.from_csv(F.col(kept), F.lit(schema), {"quote": '"', "escape": '"'})
    return rows.select(*[F.col(f"`{c}`") for c in found], again[EXTRA].alias(EXTRA))


def _records(spark: SparkSession, reader: DataFrameReader, path: str, found: list[str]) -> DataFrame:
    split = split_files(spark, path)
    if not split:
        return _read_lines(reader, path, found, None)
    if len(split) > NAMED_FILES:
        return read_split_csv(spark, path, found)
    in_blocks = F.col("_metadata.file_path").isin(split)
    return _read_lines(reader, path, found, ~in_blocks).unionByName(read_split_csv(spark, path, found, in_blocks))


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table from a CSV file or a folder of them, bound by column name and typed.

    A value that does not fit its type fails the load. Text keeps leading zeros.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    found = reader.csv(path).columns
    source = _records(spark, reader, path, found)
    too_long = F.raise_error(F.concat(F.lit(f"{path}: a record has more than {len(found)} fields: "), F.concat_ws(",", found[0], EXTRA)))
    source = source.filter(F.when(F.col(EXTRA).isNull(), True).otherwise(too_long.cast("boolean")))
    columns = []
    for name, kind in RAW_COLUMNS[table].items():
        given = name if name in found else OTHER_SPELLINGS.get(name, name)
        if given not in found:
            raise ValueError(f"{path} has no column {name}")
        columns.append(_typed(F.col(given), kind).alias(name))
    return source.select(*columns)


def load_raw(
    spark: SparkSession, csv_root: str, lake: Lake, stem_prefix: str = "", tables: Iterable[str] = tuple(RAW_COLUMNS)
) -> DataFrame:
    """Replace every raw table, or those of ``tables``, whose file is there; report table_name, status, n_rows.

    A missing file is reported as skipped and leaves its table as it is. A table that was never loaded is made without
    rows, so that everything that reads it still runs.
    """

    def load(table: str) -> DataFrame | None:
        path = file_of(csv_root, table, stem_prefix)
        if not files.exists(spark, path):
            if not lake.exists("raw", table):
                lake.write("raw", table, spark.createDataFrame([], raw_schema(table)))
            return None
        rows = read_csv(spark, path, table).withColumn("ingested_at", F.localtimestamp())
        return lake.write("raw", table, rows)

    tables = list(tables)
    if not any(files.exists(spark, file_of(csv_root, table, stem_prefix)) for table in tables):
        raise FileNotFoundError(f"no source files below {csv_root}")
    return load_report(at_the_same_time(load, tables))
