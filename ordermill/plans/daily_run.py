"""The daily run: load, build the layers, refresh the marts, check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import gold, marts, quality, silver
from ordermill.plans.journal import Journal, Table
from ordermill.plans.lake import Lake
from ordermill.schemas import BRONZE_TABLES, MARTS, RAW_TABLES
from ordermill.session import WRITERS, at_the_same_time, keep
from ordermill.sources import csv_files

LAYERS = ("bronze", "silver", "gold")
# Fewest reviews of a category in the stored mart.
MIN_COUNT = 100


def _write_all(lake: Lake, layer: str, tables: Mapping[str, Callable[[], DataFrame]]) -> None:
    at_the_same_time(lambda name: lake.write(layer, name, tables[name]()), tables)


def build_bronze(lake: Lake) -> None:
    """Make the bronze tables available as views; they hold no data."""
    for table in BRONZE_TABLES:
        lake.bronze(table).createOrReplaceTempView(table)


def _build_orders(lake: Lake) -> DataFrame:
    wide = lake.hot_orders("reviews")
    rows = silver.silver_orders(
        lake.bronze("bronze_orders"),
        lake.bronze("bronze_order_items"),
        lake.bronze("bronze_payments"),
        lake.bronze("bronze_reviews"),
        wide,
    )
    return lake.write("silver", "silver_orders", rows, in_order=True, plain=wide is not None and not wide.isEmpty())


def _build_customers(lake: Lake, orders: DataFrame, as_of: str | datetime | None) -> DataFrame:
    rows = silver.silver_customers(lake.bronze("bronze_customers"), orders, as_of)
    return lake.write("silver", "silver_customers", rows)


def _build_products(lake: Lake, orders: DataFrame) -> DataFrame:
    rows = silver.silver_products(
        lake.bronze("bronze_products"),
        lake.bronze("bronze_order_items"),
        orders,
        lake.bronze("bronze_reviews"),
        lake.hot_orders("order_items"),
    )
    return lake.write("silver", "silver_products", rows)


def build_silver(lake: Lake, as_of: str | datetime | None = None) -> None:
    """Enriched orders first, then customers and products, which read them."""
    orders = _build_orders(lake)
    steps = {"customers": lambda: _build_customers(lake, orders, as_of), "products": lambda: _build_products(lake, orders)}
    at_the_same_time(lambda name: steps[name](), steps)


def build_models(lake: Lake, as_of: str | datetime | None = None, journal: Journal | None = None) -> None:
    """All layers, each table as soon as those that it reads are there. With a journal, tables that are done stay."""
    _drop_marts(lake)
    build_bronze(lake)

    def table(layer: str, name: str, reads: Iterable[Table], build: Callable[[], DataFrame]) -> DataFrame:
        return build() if journal is None else journal.table((layer, name), reads, build)

    orders_of = [("raw", t) for t in ("orders", "order_items", "payments", "reviews")]
    silver_orders, customers_of, products_of = ("silver", "silver_orders"), ("silver", "silver_customers"), ("silver", "silver_products")
    orders = table(*silver_orders, orders_of, lambda: _build_orders(lake))

    def products() -> None:
        reads = [silver_orders, ("raw", "products"), ("raw", "category_translation"), ("raw", "order_items"), ("raw", "reviews")]
        found = table(*products_of, reads, lambda: _build_products(lake, orders))
        write = lambda: lake.write("gold", "gold_product_performance", gold.gold_product_performance(found))
        table("gold", "gold_product_performance", [products_of], write)

    def daily() -> None:
        table("gold", "gold_revenue_daily", [silver_orders], lambda: lake.write("gold", "gold_revenue_daily", gold.gold_revenue_daily(orders)))

    def customers() -> DataFrame:
        return table(*customers_of, [silver_orders, ("raw", "customers")], lambda: _build_customers(lake, orders, as_of))

    def segments(found: Future, scores: Future) -> DataFrame:
        rows = gold.gold_customer_rfm(orders, found.result(), as_of, scores=scores.result())
        return lake.write("gold", "gold_customer_rfm", rows)

    with ThreadPoolExecutor(WRITERS + 1) as pool:
        found = pool.submit(customers)
        running = [found, pool.submit(products), pool.submit(daily)]
        # the scores are not stored, so they are worked out when they are asked for
        scores = pool.submit(lambda: keep(gold.rfm_scores(gold.rfm_base(orders, as_of)), "rfm_scores")) if journal is None else None

        def rfm() -> DataFrame:
            own = scores or pool.submit(lambda: keep(gold.rfm_scores(gold.rfm_base(orders, as_of)), "rfm_scores"))
            return segments(found, own)

        if journal is None:
            rfm()
        else:
            found.result()
            journal.table(("gold", "gold_customer_rfm"), [silver_orders, customers_of], rfm)
        for step in running:
            step.result()


def _drop_marts(lake: Lake) -> None:
    """Marts of the tables before would be out of date."""
    lake.drop("marts")
    for mart in MARTS:  # copied ones are tables of their own
        if lake.exists("marts", mart):
            lake.drop("marts", mart)


def build_gold(lake: Lake, as_of: str | datetime | None = None) -> None:
    orders = lake.silver("silver_orders")
    _write_all(
        lake,
        "gold",
        {
            "gold_customer_rfm": lambda: gold.gold_customer_rfm(orders, lake.silver("silver_customers"), as_of),
            "gold_revenue_daily": lambda: gold.gold_revenue_daily(orders),
            "gold_product_performance": lambda: gold.gold_product_performance(lake.silver("silver_products")),
        },
    )


def run_layer(lake: Lake, layer: str, as_of: str | datetime | None = None) -> None:
    """Build one layer from the stored layers below it."""
    if layer != "bronze":
        _drop_marts(lake)
    if layer == "bronze":
        build_bronze(lake)
    elif layer == "silver":
        build_silver(lake, as_of)
    elif layer == "gold":
        build_gold(lake, as_of)
    else:
        raise ValueError(f"no layer {layer!r}, only {', '.join(LAYERS)}")


def live_mart(lake: Lake, key: str, min_count: int = MIN_COUNT) -> DataFrame:
    """A mart computed from the stored silver and gold tables."""
    if key == "kpi_overview":
        return marts.kpi_overview(lake.silver("silver_orders"))
    if key == "revenue_monthly":
        return marts.revenue_monthly(lake.silver("silver_orders"))
    if key == "orders_by_status":
        return marts.orders_by_status(lake.silver("silver_orders"))
    if key == "revenue_daily":
        return marts.revenue_daily(lake.gold("gold_revenue_daily"))
    if key == "rfm_segments":
        return marts.rfm_segments(lake.gold("gold_customer_rfm"))
    if key == "customers_by_state":
        return marts.customers_by_state(lake.silver("silver_customers"))
    if key == "product_performance":
        return marts.product_performance(lake.gold("gold_product_performance"))
    if key == "reviews_dist":
        return marts.reviews_dist(lake.bronze("bronze_reviews"))
    if key == "reviews_by_category":
        return marts.reviews_by_category(
            lake.bronze("bronze_reviews"),
            lake.silver("silver_orders"),
            lake.bronze("bronze_order_items"),
            lake.bronze("bronze_products"),
            min_count,
            hot=lake.hot_orders("order_items"),
        )
    raise KeyError(f"no mart {key!r}, only {', '.join(MARTS)}")


def export_marts(lake: Lake) -> None:
    """Store all nine marts as one set. Each is a small report, so it is written as one file."""
    lake.write_set("marts", {k: lambda k=k: live_mart(lake, k).coalesce(1) for k in MARTS})


def get_mart(lake: Lake, key: str, min_count: int = MIN_COUNT) -> DataFrame:
    """The stored mart if there is one, else the live query. Errors are raised, never turned into empty results.

    Marts are stored for ``MIN_COUNT``; any other limit is computed.
    """
    if key not in MARTS:
        raise KeyError(f"no mart {key!r}, only {', '.join(MARTS)}")
    stored = lake.exists("marts", key) and (min_count == MIN_COUNT or key != "reviews_by_category")
    return lake.read("marts", key) if stored else live_mart(lake, key, min_count)


def run_all(
    spark: SparkSession,
    csv_root: str,
    lake_root: str,
    as_of: str | datetime | None = None,
    stem_prefix: str = "",
    min_orders: int = quality.MIN_ORDERS,
) -> DataFrame:
    """Load, build all layers, check the raw tables, store the marts; returns the check report or raises QualityError.

    "Now" is read once, so that all layers see the same. A failed check leaves the lake without stored marts. A run that
    failed and is called again in the same way goes on from its journal: files that have not changed are not loaded again,
    and tables whose inputs are still the same are not built again.
    """
    lake = Lake(spark, lake_root)
    settings = {"csv_root": csv_root, "stem_prefix": stem_prefix, "as_of": None if as_of is None else str(as_of)}
    journal = Journal(lake, settings)
    now = journal.setting("as_of", lambda: str(spark.range(1).select(F.localtimestamp()).first()[0]))
    raw = [("raw", t) for t in RAW_TABLES]
    source = csv_files.source_state(spark, csv_root, stem_prefix)
    journal.step("load", source, raw, lambda: csv_files.load_raw(spark, csv_root, lake, stem_prefix).collect())
    build_models(lake, now, journal)
    checked = quality.quality_report(
        {t: lake.raw(t) for t in ("orders", "order_items", "customers", "products", "payments", "reviews")},
        min_orders,
    )
    report = spark.createDataFrame(checked.collect(), checked.schema)  # twelve rows
    quality.enforce(report)
    export_marts(lake)
    journal.finish()
    return report
