"""Reporting marts: the nine result sets that reports read, and what the report pages derive from them.

Ties at a limit go to the name that sorts first. Means of means are rounded to six places, so that
they do not depend on the order in which Spark adds floating-point numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import skew
from ordermill.functions.expressions import (
    DAY_LABELS,
    MONTH_LABELS,
    exact_avg,
    fixed_digits,
    label_of,
    money_label,
    percent,
    thousands,
)
from ordermill.operators.silver import SCORE_SUM, reviews_by_order
from ordermill.schemas import TOTAL_MONEY


def _count() -> Column:
    return F.count(F.lit(1))


def _money(name: str) -> Column:
    return F.sum(name).cast(TOTAL_MONEY)


# --- The nine marts ----------------------------------------------------------------------------


def kpi_overview(orders: DataFrame, buyers: DataFrame | None = None) -> DataFrame:
    """One row over all rows that are not canceled, so the cancel rate is 0; a missing status is left out too.

    ``buyers`` are rows with the same orders and customers, for callers that have them at less cost. Sums are taken per
    order first, which counts the orders as well; next to two distinct counts Spark would copy every row three times.
    """
    per_order = (
        orders.filter(F.col("order_status") != "canceled")
        .groupBy("order_id")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.count("total_revenue").alias("n_revenue"),
            F.sum("review_score").alias("scores"),
            F.count("review_score").alias("n_scores"),
            F.sum("is_canceled").alias("canceled"),
            _count().alias("n_rows"),
        )
    )
    sums = per_order.agg(
        F.count("order_id").alias("n_orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("n_revenue").alias("n_revenue"),
        F.sum("scores").alias("scores"),
        F.sum("n_scores").alias("n_scores"),
        F.sum("canceled").alias("canceled"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    customers = (orders if buyers is None else buyers).filter(F.col("order_status") != "canceled")
    n_customers = customers.filter(F.col("customer_id").isNotNull()).select("customer_id").distinct().agg(_count()).scalar()
    return sums.select(
        "n_orders",
        n_customers.alias("n_customers"),
        F.col("revenue").cast(TOTAL_MONEY).alias("total_revenue"),
        (F.col("revenue").cast("double") / F.nullif("n_revenue", F.lit(0))).alias("avg_order_value"),
        (F.col("scores").cast("double") / F.nullif("n_scores", F.lit(0))).alias("avg_review"),
        percent(F.col("canceled"), F.col("n_rows")).alias("cancel_rate"),
    )


def revenue_monthly(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("order_status") == "delivered")
        .groupBy(F.col("order_month").alias("month"))
        .agg(_money("total_revenue").alias("revenue"), _count().alias("orders"))
        .orderBy(F.col("month").asc_nulls_last())
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("order_status")
        .agg(_count().alias("n"))
        .orderBy(F.desc("n"), F.col("order_status").asc_nulls_last())
    )


def revenue_daily(daily: DataFrame) -> DataFrame:
    return daily.orderBy("order_date")


def rfm_segments(rfm: DataFrame) -> DataFrame:
    return (
        rfm.filter(F.col("rfm_segment").isNotNull())
        .groupBy("rfm_segment")
        .agg(
            _count().alias("n"),
            exact_avg(F.col("monetary")).alias("avg_spent"),
            exact_avg(F.col("frequency")).alias("avg_orders"),
            exact_avg(F.col("recency_days")).alias("avg_recency"),
        )
        .orderBy(F.desc("n"), "rfm_segment")
    )


def customers_by_state(customers: DataFrame, top: int = 10) -> DataFrame:
    return (
        customers.groupBy("customer_state")
        .agg(_count().alias("n_customers"), _money("total_spent").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("customer_state").asc_nulls_last())
        .limit(top)
    )


def product_performance(products: DataFrame, top: int = 15) -> DataFrame:
    """Categories by revenue. Needs only columns that silver products and gold product rankings share."""
    return (
        products.filter(F.col("category_english").isNotNull())
        .groupBy("category_english")
        .agg(
            _count().alias("n_products"),
            F.sum("total_orders").alias("total_orders"),
            _money("total_revenue").alias("total_revenue"),
            F.round(F.avg("avg_review_score"), 6).alias("avg_review"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "category_english")
        .limit(top)
    )


def reviews_dist(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_score", "sentiment").agg(_count().alias("n")).orderBy("review_score")


def reviews_by_category(
    reviews: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    min_count: int = 100,
    top: int = 12,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Mean review score of categories with more than ``min_count`` rows, best first.

    A row is a review with a row of ``silver_orders`` of its order and an item of its order. Reviews
    and order rows are counted per order first, so these rows are never formed. ``hot`` lists the orders with very many
    items, if that list is there.
    """
    order_rows = orders.groupBy("order_id").agg(_count().alias("n_rows"))
    weights = order_rows.join(reviews_by_order(reviews), "order_id").selectExpr(
        "order_id", "n_rows * n_reviews AS n", f"n_rows * ({SCORE_SUM}) AS score_sum"
    )
    items = order_items.selectExpr("order_id", "product_id", "1L AS n_items")
    weighed = skew.salted_join(items, weights, "order_id", "product_id", ["n_items"], hot)
    by_product = weighed.groupBy("product_id").agg(
        F.sum(F.col("n_items") * F.col("n")).alias("n"), F.sum(F.col("n_items") * F.col("score_sum")).alias("score_sum")
    )
    return (
        products.select("product_id", "category_english")
        .filter(F.col("category_english").isNotNull())
        .join(by_product, "product_id")
        .groupBy("category_english")
        .agg(
            (F.sum("score_sum").cast("double") / F.sum("n")).alias("avg_score"),
            F.sum("n").alias("n"),
        )
        .filter(F.col("n") > min_count)
        .orderBy(F.col("avg_score").desc_nulls_first(), "category_english")
        .limit(top)
    )


# --- Derived from the marts --------------------------------------------------------------------


def overview_cards(kpi: DataFrame) -> DataFrame:
    """The five figures of the overview as text."""
    cards = {
        # The titles of the cards.
        "Total Orders": thousands(F.col("n_orders")),
        "Total Revenue": money_label(F.col("total_revenue")),
        "Avg Order Value": money_label(F.col("avg_order_value")),
        "Avg Review": F.concat(fixed_digits(F.col("avg_review"), 2), F.lit(" / 5")),
        "Cancel Rate": F.concat(fixed_digits(F.col("cancel_rate"), 1), F.lit("%")),
    }
    rows = [F.struct(F.lit(name).alias("card"), text.alias("text")) for name, text in cards.items()]
    return kpi.select(F.inline(F.array(*rows)))


def revenue_headline(daily: DataFrame) -> DataFrame:
    """Totals over all days, and unweighted means of the daily order value and the daily late share."""
    return daily.agg(
        _money("gross_revenue").alias("total_revenue"),
        F.sum("n_orders").alias("total_orders"),
        F.round(F.avg("avg_order_value"), 6).alias("mean_daily_aov"),
        F.round(F.avg("late_delivery_pct"), 6).alias("mean_daily_late_pct"),
    )


def revenue_by_dow(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("order_dow")
        .agg(_money("gross_revenue").alias("gross_revenue"))
        .withColumn("day", label_of(F.col("order_dow"), DAY_LABELS))
        .orderBy("order_dow")
    )


def revenue_by_calendar_month(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("order_month_num")
        .agg(_money("gross_revenue").alias("gross_revenue"))
        .withColumn("month", label_of(F.col("order_month_num"), MONTH_LABELS))
        .orderBy("order_month_num")
    )


def _n_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def rfm_headline(segments: DataFrame) -> DataFrame:
    segment = F.col("rfm_segment")
    return segments.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_customers"),
        _n_where(segment == "Champions").alias("champions"),
        _n_where(segment == "At Risk").alias("at_risk"),
    )


def category_headline(categories: DataFrame) -> DataFrame:
    """Number of listed categories, the one with most revenue, the best rated; ties go to the earlier in the list."""
    name, place = F.col("category_english"), [-F.col("total_revenue"), F.col("category_english")]
    return categories.agg(
        _count().alias("n_categories"),
        F.min_by(name, F.struct(*place)).alias("top_category"),
        F.min_by(name, F.struct(-F.col("avg_review"), *place)).alias("best_rated_category"),
        F.max("avg_review").alias("best_rated_score"),
    )


def category_scatter(categories: DataFrame) -> DataFrame:
    """Points of the orders-against-score chart: short label, marker size by share of the largest revenue."""
    largest = categories.agg(F.max("total_revenue")).scalar().cast("double")
    revenue = F.col("total_revenue").cast("double")
    return categories.select(
        "category_english",
        F.substring("category_english", 1, 12).alias("label"),
        "total_orders",
        "avg_review",
        (revenue / F.nullif(largest, F.lit(0.0)) * 30 + 8).alias("marker_size"),
    )


def review_sentiment_share(distribution: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("n"), F.lit(0))
    columns = [total.alias("total_reviews")]
    for mood in ("positive", "neutral", "negative"):
        n = _n_where(F.col("sentiment") == mood)
        columns += [n.alias(f"n_{mood}"), (n.cast("double") / F.nullif(total, F.lit(0)) * 100).alias(f"{mood}_pct")]
    return distribution.agg(*columns)


def category_review_flag(category_scores: DataFrame) -> DataFrame:
    """Whether a category reaches a mean score of 4."""
    return category_scores.select("category_english", "avg_score", (F.col("avg_score") >= 4).alias("is_good"))


def money_labels(daily: DataFrame) -> DataFrame:
    """Short money text for every day's revenue and mean order value."""
    return daily.select(
        "order_date",
        money_label(F.col("gross_revenue")).alias("gross_revenue_label"),
        money_label(F.col("avg_order_value")).alias("avg_order_value_label"),
    )
