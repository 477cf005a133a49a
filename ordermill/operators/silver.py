"""Silver: enriched orders, customers and products.

Reviews are not reduced to one per order. An order with k valid reviews gives k rows in
``silver_orders``, so sums over that table count such an order k times, and ``product_sales``, which
meets the reviews once more, counts its items k * k times. That is the meaning of these tables and
is kept. It is computed from one row per order with a weight, never by joining the copies.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import skew
from ordermill.functions.expressions import DAY_OF_WEEK, as_of_column, distinct_list, exact_avg, sum_in_order, sum_of_cents
from ordermill.operators.bronze import SENTIMENT
from ordermill.schemas import ORDER_MONEY, TOTAL_MONEY

SCORES = (1, 2, 3, 4, 5)
# An order with more reviews than this is spread over several tasks. At most reviews / WIDE_ORDER
# orders can be that wide.
WIDE_ORDER = 1_000_000


def payments_by_order(payments: DataFrame) -> DataFrame:
    """Per order: amount paid, most installments, distinct payment types in order, joined by ", "."""
    return payments.groupBy("order_id").agg(
        F.expr(f"{sum_in_order('payment_value')} AS total_payment"),
        F.max("payment_installments").alias("max_installments"),
        distinct_list(F.col("payment_type")).alias("payment_types"),
    )


def items_by_order(order_items: DataFrame) -> DataFrame:
    """Per order: number of items, sums of price, freight and item value."""
    return order_items.groupBy("order_id").agg(
        F.expr("count(1) AS n_items"),
        F.expr(f"{sum_in_order('price')} AS items_revenue"),
        F.expr(f"{sum_in_order('freight_value')} AS freight_revenue"),
        F.expr(f"{sum_in_order('total_item_value')} AS total_revenue"),
    )


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """Per order: number of reviews, and how many of them gave each score."""
    by_score = [F.expr(f"count_if(review_score = {s}) AS n_score_{s}") for s in SCORES]
    return (
        reviews.filter("order_id IS NOT NULL").groupBy("order_id").agg(F.expr("count(1) AS n_reviews"), *by_score)
    )


# Of the output of reviews_by_order: sum of the scores of an order.
SCORE_SUM = " + ".join(f"{s} * n_score_{s}" for s in SCORES)


def _one_row_per_review(rows: DataFrame) -> DataFrame:
    """Repeat every order once per review and give the copy its score; an order without reviews stays."""
    copies = ", ".join(f"array_repeat({s}, int(coalesce(n_score_{s}, 0)))" for s in SCORES)
    kept = [c for c in rows.columns if c not in _REVIEW_COUNTS]
    return rows.selectExpr(*kept, f"explode_outer(flatten(array({copies}))) AS review_score")


_REVIEW_COUNTS = ["n_reviews", *[f"n_score_{s}" for s in SCORES]]


def _one_row_per_review_wide(rows: DataFrame) -> DataFrame:
    """As above for orders with very many reviews: the copies are cut into portions and spread first."""
    by_score = ", ".join(f"struct({s} AS review_score, n_score_{s} AS n)" for s in SCORES)
    kept = [c for c in rows.columns if c not in _REVIEW_COUNTS]
    portions = (
        rows.selectExpr(*kept, f"inline(filter(array({by_score}), c -> c.n > 0))")
        .selectExpr("*", f"explode(sequence(0L, (n - 1) div {WIDE_ORDER})) AS portion")
        .repartition("order_id", "review_score", "portion")
    )
    size = f"int(least({WIDE_ORDER}, n - portion * {WIDE_ORDER}))"
    return portions.selectExpr(*kept, "review_score", f"explode(array_repeat(1, {size})) AS copy").drop("copy")


def silver_orders(
    orders: DataFrame,
    order_items: DataFrame | None,
    payments: DataFrame | None,
    reviews: DataFrame,
    wide: DataFrame | None = None,
) -> DataFrame:
    """Bronze orders with item, payment and review measures, date parts and status flags.

    ``wide`` lists at least the orders with more than ``WIDE_ORDER`` reviews, for callers that have that list.

    A query that needs no item or no payment columns passes None for them and gets the same rows
    without these columns: Spark cannot know that such a join keeps the rows as they are.
    """
    items = [] if order_items is None else [items_by_order(order_items)]
    pays = [] if payments is None else [payments_by_order(payments)]
    scores = reviews_by_order(reviews)
    base = orders.selectExpr(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "to_date(order_purchase_timestamp) AS order_date",
        "trunc(to_date(order_purchase_timestamp), 'week') AS order_week",
        "trunc(to_date(order_purchase_timestamp), 'month') AS order_month",
        "year(order_purchase_timestamp) AS order_year",
        "month(order_purchase_timestamp) AS order_month_num",
        f"{DAY_OF_WEEK.format('order_purchase_timestamp')} AS order_dow",
        "is_late_delivery",
    )
    sides = [*items, *pays]
    joined = skew.left_lookup(base, [*sides, scores], "order_id")
    wide = skew.hot_keys(reviews, "order_id", WIDE_ORDER) if wide is None else wide
    if wide.isEmpty():
        rows = _one_row_per_review(joined)
    else:
        # both branches read the same shuffles
        most = joined.filter(F.coalesce("n_reviews", F.lit(0)) <= WIDE_ORDER)
        few = skew.left_lookup(base.join(scores.filter(F.col("n_reviews") > WIDE_ORDER), "order_id"), sides, "order_id")
        rows = _one_row_per_review(most).unionByName(_one_row_per_review_wide(few))

    columns = list(base.columns)
    if items:
        columns.append("coalesce(n_items, 0L) AS n_items")
        columns += [_or_zero(c, ORDER_MONEY) for c in ("items_revenue", "freight_revenue", "total_revenue")]
    if pays:
        columns += [_or_zero("total_payment", ORDER_MONEY), "payment_types", "max_installments"]
    return rows.selectExpr(
        *columns,
        "review_score",
        f"{SENTIMENT} AS sentiment",
        "if(order_status <=> 'delivered', 1, 0) AS is_delivered",
        "if(order_status <=> 'canceled', 1, 0) AS is_canceled",
    )


def _or_zero(name: str, kind: str) -> str:
    return f"CAST(coalesce({name}, 0) AS {kind}) AS {name}"


def customer_order_stats(orders: DataFrame) -> DataFrame:
    """Per customer over the rows of ``silver_orders``: counts, spending, first and last order, mean score."""
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_revenue").cast(TOTAL_MONEY).alias("total_spent"),
        exact_avg(F.col("total_revenue")).alias("avg_order_value"),
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        exact_avg(F.col("review_score")).alias("avg_review_score"),
        F.sum("is_delivered").alias("delivered_orders"),
        F.sum("is_canceled").alias("canceled_orders"),
    )


def silver_customers(customers: DataFrame, orders: DataFrame, as_of: str | datetime | None = None) -> DataFrame:
    """Customers with their order statistics and how recently they bought, seen from ``as_of`` (default now)."""
    now = as_of_column(as_of)
    last = F.col("last_order_date")
    status = (
        F.when(F.col("total_orders").isNull(), "never_purchased")
        .when(last >= now - F.expr("INTERVAL '180' DAY"), "active")
        .when(last >= now - F.expr("INTERVAL '365' DAY"), "at_risk")
        .otherwise("churned")
    )
    base = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    rows = skew.left_lookup(base, [customer_order_stats(orders)], "customer_id")
    return rows.withColumn("customer_status", status).selectExpr(
        *base.columns,
        "coalesce(total_orders, 0L) AS total_orders",
        _or_zero("total_spent", TOTAL_MONEY),
        _or_zero("avg_order_value", "double"),
        "first_order_date",
        "last_order_date",
        _or_zero("avg_review_score", "double"),
        "coalesce(delivered_orders, 0L) AS delivered_orders",
        "coalesce(canceled_orders, 0L) AS canceled_orders",
        "customer_status",
    )


def product_sales(order_items: DataFrame, orders: DataFrame, reviews: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Per product over delivered orders: number of orders, revenue, mean price, freight, mean score.

    ``orders`` are the rows of ``silver_orders``. An item counts once for every pair of a delivered
    row of its order and a review of its order. ``hot`` lists the orders with very many items, if that list is there.
    """
    delivered = (
        orders.filter("order_status = 'delivered'").groupBy("order_id").agg(F.expr("count(1) AS n_rows"))
    )
    weights = delivered.join(reviews_by_order(reviews), "order_id", "left").selectExpr(
        "order_id",
        "n_rows * greatest(coalesce(n_reviews, 0L), 1L) AS weight",
        "n_rows * coalesce(n_reviews, 0L) AS score_weight",
        f"n_rows * coalesce({SCORE_SUM}, 0L) AS score_sum",
    )
    items = order_items.selectExpr(
        "order_id", "product_id", "bigint(price * 100) AS price", "bigint(freight_value * 100) AS freight", "1L AS n"
    )
    rows = skew.salted_join(items, weights, "order_id", "product_id", ["price", "freight", "n"], hot)
    # rows arrive partitioned by order_id and salt, so this grouping needs no shuffle of its own
    by_pair = rows.groupBy("order_id", "salt", "product_id", "weight", "score_weight", "score_sum").agg(
        F.expr(f"{sum_of_cents('price')} AS price"), F.expr(f"{sum_of_cents('freight')} AS freight"), F.sum("n").alias("n")
    )
    pairs = by_pair.selectExpr(
        "product_id",
        "price * weight AS revenue",
        "freight * weight AS freight",
        "n * weight AS n",
        "n * score_sum AS score_sum",
        "n * score_weight AS score_n",
    )
    return pairs.groupBy("product_id").agg(
        # one row per order and product by now
        F.expr("count(1) AS total_orders"),
        F.expr(f"CAST(sum(revenue) AS {TOTAL_MONEY}) AS total_revenue"),
        F.expr("CAST(sum(revenue) AS double) / sum(n) AS avg_price"),
        F.expr(f"CAST(sum(freight) AS {TOTAL_MONEY}) AS total_freight"),
        F.expr("CAST(sum(score_sum) AS double) / nullif(sum(score_n), 0L) AS avg_review_score"),
    )


def silver_products(
    products: DataFrame, order_items: DataFrame, orders: DataFrame, reviews: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Products with their sales measures, zero where a product was never delivered."""
    base = products.select(
        "product_id", "category_english", "category_portuguese", "product_photos_qty", "product_weight_g"
    )
    sales = product_sales(order_items, orders, reviews, hot)
    return skew.left_lookup(base, [sales], "product_id").selectExpr(
        *base.columns,
        "coalesce(total_orders, 0L) AS total_orders",
        _or_zero("total_revenue", TOTAL_MONEY),
        _or_zero("avg_price", "double"),
        _or_zero("total_freight", TOTAL_MONEY),
        _or_zero("avg_review_score", "double"),
    )
