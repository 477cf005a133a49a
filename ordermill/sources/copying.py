"""Copy tables from one store to another, and report what a load or a copy did."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.plans.lake import Lake
from ordermill.schemas import TEXT_WIDTHS
from ordermill.session import at_the_same_time

REPORT = "table_name string, status string, n_rows bigint"


def load_report(tables: Mapping[str, DataFrame | int | None], done: str = "loaded") -> DataFrame:
    """table_name, status, n_rows: one row per table, given as rows or as their number; None was skipped."""
    spark = SparkSession.active()

    def row(name: str, table: DataFrame | int | None) -> DataFrame:
        if isinstance(table, DataFrame):
            counted = table.agg(F.count(F.lit(1)).alias("n_rows"))
            return counted.select(F.lit(name).alias("table_name"), F.lit(done).alias("status"), "n_rows")
        return spark.createDataFrame([(name, "skipped" if table is None else done, table)], REPORT)

    parts = [row(name, table) for name, table in tables.items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], REPORT)


def copy_tables(tables: Mapping[str, DataFrame | None], target: str) -> DataFrame:
    """Replace ``<target>/<name>`` by each table, skipping those that are None.

    The executors read and write; the report counts the rows that arrived.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        path = f"{target.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return _copy(tables, write)


def copy_lake(source: Lake, target: Lake) -> DataFrame:
    """Copy every table that ``source`` has; the report names those that it has not as skipped."""
    tables = {f"{layer}/{t}": source.read(layer, t) if source.exists(layer, t) else None for layer, t in source.tables()}

    def write(name: str, df: DataFrame) -> DataFrame:
        # rows that lie in as many buckets arrive dealt by the key
        return target.write(*name.split("/"), df, in_order=0 < source.buckets_of(*name.split("/")) == target.buckets)

    return _copy(tables, write)


def jdbc_column_types(schema: StructType) -> str:
    """Column types for making a target table, as Spark's JDBC writer takes them.

    Text columns that have a declared width become VARCHAR of it; free text is left to the database's own text type.
    """
    kinds = []
    for field in schema.fields:
        kind = field.dataType.simpleString().upper()
        if kind == "STRING":
            if field.name not in TEXT_WIDTHS:
                continue
            kind = f"VARCHAR({TEXT_WIDTHS[field.name]})"
        kinds.append(f"`{field.name}` {kind.replace('_NTZ', '')}")
    return ", ".join(kinds)


def copy_tables_jdbc(
    tables: Mapping[str, DataFrame | None],
    url: str,
    properties: Mapping[str, str],
    schema: str = "raw",
    batch_rows: int = 2000,
) -> DataFrame:
    """As ``copy_tables``, into tables ``<schema>.<name>`` of a database.

    Existing tables are truncated, not dropped; new ones get the declared column types of ``jdbc_column_types``. The caller
    gives the driver and the credentials in ``properties``.
    """

    def write(name: str, df: DataFrame) -> int:
        table = f"{schema}.{name}"
        writer = df.write.option("truncate", True).option("batchsize", batch_rows)
        writer = writer.option("createTableColumnTypes", jdbc_column_types(df.schema))
        writer.jdbc(url, table, mode="overwrite", properties=dict(properties))
        # the database counts; the rows do not come back
        counted = f"(SELECT count(*) AS n_rows FROM {table}) counted"
        return df.sparkSession.read.jdbc(url, counted, properties=dict(properties)).first()[0]

    return _copy(tables, write)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split_column: str,
    bounds: tuple[str, str],
    n_parts: int,
) -> DataFrame:
    """A database table, read in ``n_parts`` ranges of a number, date or timestamp column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    reader = reader.options(partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1])
    return reader.option("numPartitions", n_parts).load()


def _copy(
    tables: Mapping[str, DataFrame | None], write: Callable[[str, DataFrame], DataFrame | int]
) -> DataFrame:
    seconds: dict[str, float] = {}

    def copy(name: str) -> DataFrame | int | None:
        start = time.monotonic()
        df = tables[name]
        copied = None if df is None else write(name, df)
        seconds[name] = time.monotonic() - start
        return copied

    copied = at_the_same_time(copy, tables)
    report = load_report(copied, "copied")
    took = F.create_map(*[F.lit(x) for pair in seconds.items() for x in pair])
    return report.withColumn("seconds", took[F.col("table_name")])
