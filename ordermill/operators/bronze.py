"""Bronze: clean and type the raw tables. Projections and filters only, so all of it runs in the scan stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.expressions import clean_lower, clean_upper, title_case

SENTIMENT = (
    "CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral' "
    "WHEN review_score IS NOT NULL THEN 'negative' END"
)


def bronze_orders(orders: DataFrame) -> DataFrame:
    """Orders with both ids, status in lower case, and whether delivery was later than estimated."""
    delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz")
    estimated = F.col("order_estimated_delivery_date").cast("timestamp_ntz")
    return orders.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()).select(
        "order_id",
        "customer_id",
        clean_lower(F.col("order_status")).alias("order_status"),
        F.col("order_purchase_timestamp").cast("timestamp_ntz"),
        F.col("order_approved_at").cast("timestamp_ntz"),
        F.col("order_delivered_carrier_date").cast("timestamp_ntz"),
        delivered.alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
        # a comparison with NULL is NULL: unknown unless both dates are there
        (delivered > estimated).alias("is_late_delivery"),
        "ingested_at",
    )


def bronze_order_items(order_items: DataFrame) -> DataFrame:
    """Items with an order id and a price of at least zero; item value is NULL when freight is."""
    total = F.col("price") + F.col("freight_value")
    return order_items.filter(F.col("order_id").isNotNull() & (F.col("price") >= 0)).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp_ntz"),
        F.col("price").cast("decimal(10,2)"),
        F.col("freight_value").cast("decimal(10,2)"),
        total.cast("decimal(10,2)").alias("total_item_value"),
        "ingested_at",
    )


def bronze_customers(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        title_case(F.trim("customer_city")).alias("customer_city"),
        clean_upper(F.col("customer_state")).alias("customer_state"),
        "ingested_at",
    )


def bronze_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category: translated, else as given, else 'unknown'.

    No broadcast hint: Spark broadcasts the translation when its size allows, and otherwise
    shuffles, where the adaptive planner splits a hot or missing category.
    """
    words = translation.select("product_category_name", "product_category_name_english")
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    return (
        products.filter(F.col("product_id").isNotNull())
        .join(words, "product_category_name", "left")
        .select(
            "product_id",
            category.alias("category_english"),
            F.col("product_category_name").alias("category_portuguese"),
            "product_photos_qty",
            "product_weight_g",
            "ingested_at",
        )
    )


def bronze_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("order_id").isNotNull() & (F.col("payment_value") >= 0)).select(
        "order_id",
        "payment_sequential",
        clean_lower(F.col("payment_type")).alias("payment_type"),
        "payment_installments",
        F.col("payment_value").cast("decimal(10,2)"),
        "ingested_at",
    )


def bronze_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with an id and a score of 1 to 5, and the sentiment that follows from the score."""
    return reviews.filter(F.col("review_id").isNotNull() & F.col("review_score").between(1, 5)).select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int"),
        F.expr(SENTIMENT).alias("sentiment"),
        F.col("review_creation_date").cast("timestamp_ntz"),
        F.col("review_answer_timestamp").cast("timestamp_ntz"),
        "ingested_at",
    )
