"""Gold: daily revenue, customer segments and product rankings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import skew
from ordermill.functions.expressions import as_of_column, cents, exact_avg, percent, ratio_rounded
from ordermill.operators import ranking
from ordermill.schemas import TOTAL_MONEY
from ordermill.session import keep


def gold_revenue_daily(orders: DataFrame, buyers: DataFrame | None = None) -> DataFrame:
    """Key figures per purchase day.

    The late share sets late orders of any status against delivered ones, so it may pass 100; it is
    NULL on a day without a delivered order.

    Next to a distinct count Spark would shuffle every sum once per day and customer. So customers are counted apart: the
    sums are shuffled once per day and task, and the distinct count reads and moves nothing but its two columns. ``buyers``
    are rows with the same days and customers, for callers that have them at less cost; ``orders`` is a stored table else.
    """
    delivered, canceled = F.sum("is_delivered"), F.sum("is_canceled")
    sums = [
        F.count("order_id").alias("n_orders"),
        F.sum("total_revenue").cast(TOTAL_MONEY).alias("gross_revenue"),
        F.sum("freight_revenue").cast(TOTAL_MONEY).alias("freight_revenue"),
        exact_avg(F.col("total_revenue")).alias("avg_order_value"),
        F.sum("n_items").alias("total_items"),
        exact_avg(F.col("review_score")).alias("avg_review_score"),
        delivered.alias("delivered_orders"),
        canceled.alias("canceled_orders"),
        percent(canceled, F.count(F.lit(1))).alias("cancel_rate_pct"),
        percent(F.count_if("is_late_delivery"), delivered).alias("late_delivery_pct"),
    ]
    dated = F.col("order_date").isNotNull()
    daily = orders.filter(dated).groupBy(*_DAY).agg(*sums)
    customers = (orders if buyers is None else buyers).filter(dated).groupBy("order_date")
    daily = daily.join(customers.agg(F.countDistinct("customer_id").alias("n_customers")), "order_date")
    return daily.select(*_DAY, "n_orders", "n_customers", *_DAILY_FIGURES).orderBy("order_date")


_DAY = ["order_date", "order_year", "order_month_num", "order_dow"]
_DAILY_FIGURES = [
    "gross_revenue",
    "freight_revenue",
    "avg_order_value",
    "total_items",
    "avg_review_score",
    "delivered_orders",
    "canceled_orders",
    "cancel_rate_pct",
    "late_delivery_pct",
]


def rfm_base(orders: DataFrame, as_of: str | datetime | None = None) -> DataFrame:
    """Per customer over delivered rows: days since the last order, number of rows, amount."""
    today = F.to_date(as_of_column(as_of))
    return (
        orders.filter(F.col("order_status") == "delivered")
        .groupBy("customer_id")
        .agg(
            F.datediff(today, F.max("order_date")).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("total_revenue").cast(TOTAL_MONEY).alias("monetary"),
        )
    )


def rfm_scores(base: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Quintile scores of ``rfm_base``, 5 best. Equal values are ordered by customer id."""
    scores = {
        "r_score": ("recency_days", True),
        "f_score": ("frequency", False),
        "m_score": ("monetary", False),
    }
    return ranking.add_ntiles(keep(base, "rfm_base"), "customer_id", scores, 5, rows_per_bucket)


def gold_customer_rfm(
    orders: DataFrame,
    customers: DataFrame,
    as_of: str | datetime | None = None,
    rows_per_bucket: int | None = None,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Silver customers with scores and segment. The first matching rule names the segment; customers
    without a delivered order match none and need attention. ``scores`` are those of ``orders``, if they are there."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r >= 3) & (m >= 4), "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Needs Attention")
    )
    base = customers.select("customer_id", "customer_state", "customer_status", "total_spent", "avg_review_score")
    if scores is None:
        scores = rfm_scores(rfm_base(orders, as_of), rows_per_bucket)
    total = (r + f + m).cast("bigint")
    return skew.left_lookup(base, [scores], "customer_id").select(
        *base.columns,
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        ratio_rounded(total, F.lit(3).cast("bigint"), 2).alias("rfm_score"),
        segment.alias("rfm_segment"),
    )


def gold_product_performance(
    products: DataFrame, rows_per_bucket: int | None = None
) -> DataFrame:
    """Stored ``silver_products`` with ranks by revenue and orders, rank within category, and revenue share.

    Sorted by revenue; the product id as second key keeps products that never sold from landing in one task.
    """
    base = products.select(
        "product_id",
        "category_english",
        "avg_price",
        "total_orders",
        "total_revenue",
        "total_freight",
        "avg_review_score",
    )
    ranked = ranking.add_ranks(
        base,
        {
            "revenue_rank": ("total_revenue", None),
            "orders_rank": ("total_orders", None),
            "category_rank": ("total_revenue", "category_english"),
        },
        rows_per_bucket,
    )
    grand_total = cents(base.agg(F.sum("total_revenue")).scalar())
    share = ratio_rounded(cents(F.col("total_revenue")), grand_total, 3, factor=100)
    return ranked.withColumn("revenue_share_pct", share).orderBy(
        F.col("total_revenue").desc_nulls_first(), "product_id"
    )
