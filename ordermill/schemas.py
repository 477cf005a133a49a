"""Column names and types of the eight raw tables, and the table names of each layer."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
AMOUNT = T.DecimalType(10, 2)
MOMENT = T.TimestampNTZType()

# Sums within one order, and sums over any number of orders.
ORDER_MONEY = "decimal(18,2)"
TOTAL_MONEY = "decimal(38,2)"

# The raw columns the source files carry.
RAW_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "orders": {
        "order_id": TEXT,
        "customer_id": TEXT,
        "order_status": TEXT,
        "order_purchase_timestamp": MOMENT,
        "order_approved_at": MOMENT,
        "order_delivered_carrier_date": MOMENT,
        "order_delivered_customer_date": MOMENT,
        "order_estimated_delivery_date": MOMENT,
    },
    "order_items": {
        "order_id": TEXT,
        "order_item_id": INT,
        "product_id": TEXT,
        "seller_id": TEXT,
        "shipping_limit_date": MOMENT,
        "price": AMOUNT,
        "freight_value": AMOUNT,
    },
    "customers": {
        "customer_id": TEXT,
        "customer_unique_id": TEXT,
        "customer_zip_code_prefix": TEXT,
        "customer_city": TEXT,
        "customer_state": TEXT,
    },
    "products": {
        "product_id": TEXT,
        "product_category_name": TEXT,
        "product_name_lenght": INT,
        "product_description_lenght": INT,
        "product_photos_qty": INT,
        "product_weight_g": AMOUNT,
        "product_length_cm": AMOUNT,
        "product_height_cm": AMOUNT,
        "product_width_cm": AMOUNT,
    },
    "sellers": {
        "seller_id": TEXT,
        "seller_zip_code_prefix": TEXT,
        "seller_city": TEXT,
        "seller_state": TEXT,
    },
    "payments": {
        "order_id": TEXT,
        "payment_sequential": INT,
        "payment_type": TEXT,
        "payment_installments": INT,
        "payment_value": AMOUNT,
    },
    "reviews": {
        "review_id": TEXT,
        "order_id": TEXT,
        "review_score": INT,
        "review_comment_title": TEXT,
        "review_comment_message": TEXT,
        "review_creation_date": MOMENT,
        "review_answer_timestamp": MOMENT,
    },
    "category_translation": {
        "product_category_name": TEXT,
        "product_category_name_english": TEXT,
    },
}

# Widths of the text columns in a database. The text of reviews has none.
TEXT_WIDTHS = {
    "order_id": 50,
    "customer_id": 50,
    "order_status": 20,
    "product_id": 50,
    "seller_id": 50,
    "customer_unique_id": 50,
    "customer_zip_code_prefix": 10,
    "customer_city": 100,
    "customer_state": 5,
    "product_category_name": 100,
    "seller_zip_code_prefix": 10,
    "seller_city": 100,
    "seller_state": 5,
    "payment_type": 30,
    "review_id": 50,
    "product_category_name_english": 100,
}

# The source data misspells two names; files that spell them right are accepted too.
OTHER_SPELLINGS = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

RAW_TABLES = tuple(RAW_COLUMNS)
BRONZE_TABLES = (
    "bronze_orders",
    "bronze_order_items",
    "bronze_customers",
    "bronze_products",
    "bronze_payments",
    "bronze_reviews",
)
SILVER_TABLES = ("silver_orders", "silver_customers", "silver_products")
GOLD_TABLES = ("gold_revenue_daily", "gold_customer_rfm", "gold_product_performance")
MARTS = (
    "kpi_overview",
    "revenue_monthly",
    "orders_by_status",
    "revenue_daily",
    "rfm_segments",
    "customers_by_state",
    "product_performance",
    "reviews_dist",
    "reviews_by_category",
)


def raw_schema(table: str) -> T.StructType:
    """Schema of a stored raw table, with the load time as last column."""
    fields = [T.StructField(name, kind) for name, kind in RAW_COLUMNS[table].items()]
    return T.StructType([*fields, T.StructField("ingested_at", MOMENT)])
