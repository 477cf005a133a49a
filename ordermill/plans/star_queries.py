"""Every operator as a query over star-schema tables, with a fixed "now".

Nothing is stored between queries. A query that reads an intermediate table more than once keeps it
in the scratch folder first, as the daily run stores it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import gold, marts, quality, silver
from ordermill.plans.lake import Lake, bronze_frame
from ordermill.schemas import RAW_TABLES
from ordermill.session import keep, scratch_dir
from ordermill.sources import csv_files
from ordermill.sources.copying import copy_lake, load_report
from ordermill.sources.star import StarRaw, csv_source

AS_OF = "2001-08-02 00:00:00"
MIN_ORDERS = 90_000
MIN_REVIEW_ROWS = 100


class StarModels:
    """The tables of each layer over one folder of star tables, planned on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.raw = StarRaw(spark, sf_dir)

    def bronze(self, table: str) -> DataFrame:
        return bronze_frame(table, self.raw.__getitem__)

    def orders(self, items: bool = True, payments: bool = True) -> DataFrame:
        """Silver orders, without the item or payment columns where a query reads none."""
        return silver.silver_orders(
            self.bronze("bronze_orders"),
            self.bronze("bronze_order_items") if items else None,
            self.bronze("bronze_payments") if payments else None,
            self.bronze("bronze_reviews"),
        )

    @cached_property
    def sold_orders(self) -> DataFrame:
        return self.orders(payments=False)

    def customers(self, orders: DataFrame | None = None) -> DataFrame:
        return silver.silver_customers(self.bronze("bronze_customers"), orders or self.sold_orders, AS_OF)

    def sales(self) -> DataFrame:
        status = self.orders(items=False, payments=False)
        return silver.product_sales(self.bronze("bronze_order_items"), status, self.bronze("bronze_reviews"))

    def products(self) -> DataFrame:
        status = self.orders(items=False, payments=False)
        return silver.silver_products(
            self.bronze("bronze_products"), self.bronze("bronze_order_items"), status, self.bronze("bronze_reviews")
        )

    def daily(self) -> DataFrame:
        buyers = self.bronze("bronze_orders").selectExpr("to_date(order_purchase_timestamp) AS order_date", "customer_id")
        return gold.gold_revenue_daily(self.sold_orders, buyers)

    def rfm(self) -> DataFrame:
        wanted = ["customer_id", "order_status", "order_date", "order_purchase_timestamp", "total_revenue"]
        wanted += ["review_score", "is_delivered", "is_canceled"]
        orders = keep(self.sold_orders.select(*wanted), "silver_orders")
        return gold.gold_customer_rfm(orders, self.customers(orders), AS_OF)

    def segments(self) -> DataFrame:
        return marts.rfm_segments(self.rfm())

    def categories(self) -> DataFrame:
        return marts.product_performance(self.products())

    def review_scores(self) -> DataFrame:
        return marts.reviews_by_category(
            self.bronze("bronze_reviews"),
            self.orders(items=False, payments=False),
            self.bronze("bronze_order_items"),
            self.bronze("bronze_products"),
            MIN_REVIEW_ROWS,
        )

    def scratch_lake(self, name: str) -> Lake:
        return Lake(self.spark, f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex[:8]}", buckets=0)

    def copied(self) -> DataFrame:
        """A lake that has its raw tables but one, copied to another."""
        source = self.scratch_lake("copy-source")
        for table in RAW_TABLES:
            if table != "category_translation":
                source.write("raw", table, self.raw[table])
        report = copy_lake(source, self.scratch_lake("copy-target")).filter("table_name LIKE 'raw/%'")
        return report.withColumn("table_name", F.expr("substring(table_name, 5)")).drop("seconds")

    def csv_load(self, *tables: str, load: Iterable[str] = RAW_TABLES) -> tuple[Lake, DataFrame]:
        """Star ``tables`` written as CSV files, those of ``load`` loaded into a lake, and the report."""
        root = f"{scratch_dir(self.spark)}/csv-{uuid.uuid4().hex[:8]}"
        for table in tables:
            rows = csv_source(table, self.raw.star, self.spark, self.raw.sf_dir)
            options = {"header": True, "escape": '"', "quoteAll": table == "reviews"}
            options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            rows.write.options(**options).csv(csv_files.file_of(root, table))
        lake = self.scratch_lake("csv-lake")
        return lake, csv_files.load_raw(self.spark, root, lake, tables=load)

    def from_csv(self, table: str) -> DataFrame:
        return self.csv_load(table, load=[table])[0].raw(table).drop("ingested_at")

    def csv_report(self) -> DataFrame:
        """Report of a load with three files there and five missing."""
        return self.csv_load("payments", "sellers", "reviews")[1]


Query = Callable[[StarModels], DataFrame]

QUERIES: dict[str, Query] = {
    **{f"raw_{t}": lambda m, t=t: m.raw[t] for t in RAW_TABLES},
    "csv_payments": lambda m: m.from_csv("payments"),
    "csv_sellers": lambda m: m.from_csv("sellers"),
    "csv_reviews": lambda m: m.from_csv("reviews"),
    "csv_load_report": StarModels.csv_report,
    "raw_load_report": lambda m: load_report(m.raw),
    "copy_table_report": StarModels.copied,
    # bronze
    "bronze_orders": lambda m: m.bronze("bronze_orders"),
    "bronze_order_items": lambda m: m.bronze("bronze_order_items"),
    "bronze_customers": lambda m: m.bronze("bronze_customers"),
    "bronze_products": lambda m: m.bronze("bronze_products"),
    "bronze_payments": lambda m: m.bronze("bronze_payments"),
    "bronze_reviews": lambda m: m.bronze("bronze_reviews"),
    # silver
    "payments_by_order": lambda m: silver.payments_by_order(m.bronze("bronze_payments")),
    "items_by_order": lambda m: silver.items_by_order(m.bronze("bronze_order_items")),
    "silver_orders": lambda m: m.orders(),
    "customer_order_stats": lambda m: silver.customer_order_stats(m.sold_orders),
    "silver_customers": lambda m: m.customers(),
    "product_sales": StarModels.sales,
    "silver_products": StarModels.products,
    # gold
    "gold_revenue_daily": StarModels.daily,
    "rfm_base": lambda m: gold.rfm_base(m.sold_orders, AS_OF),
    "rfm_scores": lambda m: gold.rfm_scores(gold.rfm_base(m.sold_orders, AS_OF)),
    "gold_customer_rfm": StarModels.rfm,
    "gold_product_performance": lambda m: gold.gold_product_performance(keep(m.products(), "silver_products")),
    # marts
    "kpi_overview": lambda m: marts.kpi_overview(m.sold_orders, m.orders(items=False, payments=False)),
    "revenue_monthly": lambda m: marts.revenue_monthly(m.sold_orders),
    "orders_by_status": lambda m: marts.orders_by_status(m.orders(items=False, payments=False)),
    "revenue_daily": lambda m: marts.revenue_daily(m.daily()),
    "rfm_segments": StarModels.segments,
    "customers_by_state": lambda m: marts.customers_by_state(m.customers()),
    "product_performance": StarModels.categories,
    "reviews_dist": lambda m: marts.reviews_dist(m.bronze("bronze_reviews")),
    "reviews_by_category": StarModels.review_scores,
    # derived from the marts
    "overview_cards": lambda m: marts.overview_cards(
        marts.kpi_overview(m.sold_orders, m.orders(items=False, payments=False))
    ),
    "revenue_headline": lambda m: marts.revenue_headline(m.daily()),
    "revenue_by_dow": lambda m: marts.revenue_by_dow(m.daily()),
    "revenue_by_calendar_month": lambda m: marts.revenue_by_calendar_month(m.daily()),
    "rfm_headline": lambda m: marts.rfm_headline(m.segments()),
    "category_headline": lambda m: marts.category_headline(m.categories()),
    "category_scatter": lambda m: marts.category_scatter(keep(m.categories(), "categories")),
    "review_sentiment_share": lambda m: marts.review_sentiment_share(
        marts.reviews_dist(m.bronze("bronze_reviews"))
    ),
    "category_review_flag": lambda m: marts.category_review_flag(m.review_scores()),
    "money_label": lambda m: marts.money_labels(m.daily()),
    # checks
    "quality_report": lambda m: quality.quality_report(m.raw, MIN_ORDERS),
}


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](StarModels(spark, sf_dir))
