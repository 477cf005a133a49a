"""The stored tables of one run, parquet: versions, buckets, and the pointers that name what counts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordermill.functions import skew
from ordermill.operators import bronze, silver
from ordermill.plans import files
from ordermill.schemas import BRONZE_TABLES, GOLD_TABLES, MARTS, RAW_TABLES, SILVER_TABLES
from ordermill.session import at_the_same_time

CURRENT = "_current"
# Tables in buckets, and the key.
BUCKETED = {**{("raw", t): "order_id" for t in ("orders", "order_items", "payments", "reviews")}, ("silver", "silver_orders"): "order_id"}


def _catalog_name(folder: str) -> str:
    return f"ordermill_{hashlib.md5(folder.encode()).hexdigest()}"


def bronze_frame(table: str, raw: Callable[[str], DataFrame]) -> DataFrame:
    """One bronze table over ``raw(table)``. Nothing is stored: it is computed where it is read."""
    if table == "bronze_orders":
        return bronze.bronze_orders(raw("orders"))
    if table == "bronze_order_items":
        return bronze.bronze_order_items(raw("order_items"))
    if table == "bronze_customers":
        return bronze.bronze_customers(raw("customers"))
    if table == "bronze_products":
        return bronze.bronze_products(raw("products"), raw("category_translation"))
    if table == "bronze_payments":
        return bronze.bronze_payments(raw("payments"))
    if table == "bronze_reviews":
        return bronze.bronze_reviews(raw("reviews"))
    raise KeyError(f"no table {table!r}, only {', '.join(BRONZE_TABLES)}")


class Lake:
    """Tables as versions: ``<root>/<layer>/<table>/v-<id>`` holds the rows, and the file ``_current`` beside it names the
    version that counts. It is written last, so a reader sees the old rows or the new ones, and a write that fails changes
    nothing. The version before stays for readers that have opened it. Marts are one version together.

    Tables that are joined by order are stored in buckets by order id, unless an order has very many rows; joins and sums
    by order then read them without a shuffle. Spark knows buckets from its catalog, so such a version is entered there as
    an external table under a name of its own.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        # by default as many as a shuffle would make; 0 stores all tables plain
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets

    def path(self, layer: str, table: str = "") -> str:
        return f"{self.root}/{layer}/{table}".rstrip("/")

    def _current(self, layer: str, table: str = "") -> dict | None:
        text = files.read_text(self.spark, f"{self.path(layer, table)}/{CURRENT}")
        return None if text is None else json.loads(text)

    def _found(self, layer: str, table: str) -> dict | None:
        """Folder and schema of a finished table, as one of its own or of a set of tables."""
        own = self._current(layer, table)
        if own is None and (together := self._current(layer)) and table in together["tables"]:
            return {"folder": f"{self.path(layer)}/{together['version']}/{table}", "schema": together["tables"][table]}
        return own and {**own, "folder": f"{self.path(layer, table)}/{own['version']}"}

    def version(self, layer: str, table: str) -> str | None:
        """Name of the version of a table that counts; None without the table."""
        found = self._found(layer, table)
        return found and found["folder"][len(self.path(layer)) + 1 :]

    def buckets_of(self, layer: str, table: str) -> int:
        """Number of buckets that a table is stored in, 0 if it is not."""
        found = self._found(layer, table)
        return (found or {}).get("buckets", 0)

    def exists(self, layer: str, table: str) -> bool:
        """Whether a finished table is there."""
        return self._found(layer, table) is not None

    def drop(self, layer: str, table: str = "") -> None:
        """Drop a table, or the set of tables of a layer. The pointer goes first."""
        files.delete(self.spark, f"{self.path(layer, table)}/{CURRENT}")
        self._clear(layer, table, ())

    def _clear(self, layer: str, table: str, kept: Iterable[str]) -> None:
        root = self.path(layer, table)
        for name in files.folders(self.spark, root):
            if name.startswith("v-") and name not in kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(f'{root}/{name}')}")
                files.delete(self.spark, f"{root}/{name}")

    def _publish(self, layer: str, table: str, version: str, found: dict) -> None:
        before = self._current(layer, table)
        files.replace_text(self.spark, f"{self.path(layer, table)}/{CURRENT}", json.dumps({"version": version, **found}))
        self._clear(layer, table, (version, before["version"]) if before else (version,))

    def tables(self) -> list[tuple[str, str]]:
        """(layer, table) of every table that a lake can hold."""
        by_layer = {"raw": RAW_TABLES, "silver": SILVER_TABLES, "gold": GOLD_TABLES, "marts": MARTS}
        return [(layer, table) for layer, tables in by_layer.items() for table in tables]

    def read(self, layer: str, table: str) -> DataFrame:
        found = self._found(layer, table)
        if found is None:
            raise FileNotFoundError(f"no table {table} in {self.path(layer)}")
        schema = T.StructType.fromJson(json.loads(found["schema"]))
        if not found.get("buckets"):
            return self.spark.read.schema(schema).parquet(found["folder"])
        name = _catalog_name(found["folder"])
        if not self.spark.catalog.tableExists(name):
            columns = self.spark._jvm.org.apache.spark.sql.types.DataType.fromJson(found["schema"]).toDDL()
            by = f"CLUSTERED BY ({found['key']}) INTO {found['buckets']} BUCKETS"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} LOCATION '{found['folder']}'")
        return self.spark.table(name)

    def write(self, layer: str, table: str, df: DataFrame, in_order: bool = False, plain: bool = False) -> DataFrame:
        """Replace the table and read it back.

        ``in_order``: the rows come dealt by the key of the table's buckets already. ``plain``: no buckets, as some key has
        very many rows.
        """
        version = f"v-{uuid.uuid4().hex}"
        folder, key = f"{self.path(layer, table)}/{version}", BUCKETED.get((layer, table)) if self.buckets and not plain else None
        found = {"schema": df.schema.json()}
        if key is None:
            df.write.parquet(folder)
        elif in_order:
            found |= self._in_buckets(df, key, folder)
        else:
            # written once as it comes, so that its hot keys can be counted, then dealt
            df.write.parquet(f"{folder}-0")
            rows = self.spark.read.schema(df.schema).parquet(f"{folder}-0")
            hot = skew.hot_keys(rows, key, silver.WIDE_ORDER if table == "reviews" else skew.HOT_ROWS)
            if found_hot := not hot.isEmpty():
                version = f"{version}-0"
                hot.write.parquet(f"{folder}-0/_hot")
            else:
                found |= self._in_buckets(rows.repartition(self.buckets, key), key, folder)
            found["hot"] = found_hot
        self._publish(layer, table, version, found)
        return self.read(layer, table)

    def _in_buckets(self, df: DataFrame, key: str, folder: str) -> dict:
        writer = df.write.format("parquet").bucketBy(self.buckets, key).option("path", folder)
        writer.saveAsTable(_catalog_name(folder))
        return {"key": key, "buckets": self.buckets}

    def write_set(self, layer: str, tables: Mapping[str, Callable[[], DataFrame]]) -> None:
        """Replace all tables of a layer together: readers see those of one write only."""
        version = f"v-{uuid.uuid4().hex}"

        def write(name: str) -> str:
            df = tables[name]()
            df.write.parquet(f"{self.path(layer)}/{version}/{name}")
            return df.schema.json()

        self._publish(layer, "", version, {"tables": at_the_same_time(write, tables)})

    def hot_orders(self, table: str) -> DataFrame | None:
        """Orders with very many rows in a raw table, as counted when it was written; None if they were not."""
        hot = (found := self._found("raw", table)) and found.get("hot")
        if hot is None:
            return None
        return self.spark.read.parquet(f"{found['folder']}/_hot") if hot else self.spark.createDataFrame([], "order_id string, salts int")

    def raw(self, table: str) -> DataFrame:
        return self.read("raw", table)

    def bronze(self, table: str) -> DataFrame:
        return bronze_frame(table, self.raw)

    def silver(self, table: str) -> DataFrame:
        return self.read("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self.read("gold", table)

    def register_views(self) -> list[str]:
        """Temporary views for SQL: ``raw_<table>`` and every bronze, silver, gold table and mart by its name."""
        views = {f"raw_{t}": self.raw(t) for t in RAW_TABLES if self.exists("raw", t)}
        if len(views) == len(RAW_TABLES):
            views |= {t: self.bronze(t) for t in BRONZE_TABLES}
        for layer, tables in (("silver", SILVER_TABLES), ("gold", GOLD_TABLES), ("marts", MARTS)):
            views |= {t: self.read(layer, t) for t in tables if self.exists(layer, t)}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)
