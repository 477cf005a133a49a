"""The registered queries as plain SQL over the star tables, for checking with another engine.

Written from the meaning of each table, with every join in full, and not from the Spark operators.
"""

from __future__ import annotations

from ordermill.plans.star_queries import AS_OF, MIN_ORDERS, MIN_REVIEW_ROWS
from ordermill.schemas import RAW_TABLES
from ordermill.sources.star import LOADED_AT, STAR_SQL, STAR_TABLES

_NAMES = {name: name for name in STAR_TABLES}

_RAW = {
    f"raw_{t}": f"SELECT *, TIMESTAMP '{LOADED_AT}' AS ingested_at FROM ({STAR_SQL[t].format(**_NAMES)}) AS source"
    for t in RAW_TABLES
}

_TITLE = (
    r"array_to_string(list_transform(regexp_extract_all(lower(trim(customer_city)),"
    r" '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda w: upper(w[1]) || w[2:]), '')"
)

_BRONZE = {
    "bronze_orders": """
SELECT order_id, customer_id, lower(trim(order_status)) AS order_status, order_purchase_timestamp, order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
            THEN order_delivered_customer_date > order_estimated_delivery_date END AS is_late_delivery,
       ingested_at
FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "bronze_order_items": """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
       CAST(price + freight_value AS DECIMAL(10,2)) AS total_item_value, ingested_at
FROM raw_order_items WHERE order_id IS NOT NULL AND price >= 0""",
    "bronze_customers": f"""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, {_TITLE} AS customer_city,
       upper(trim(customer_state)) AS customer_state, ingested_at
FROM raw_customers WHERE customer_id IS NOT NULL""",
    "bronze_products": """
SELECT p.product_id, coalesce(t.product_category_name_english, p.product_category_name, 'unknown') AS category_english,
       p.product_category_name AS category_portuguese, p.product_photos_qty, p.product_weight_g, p.ingested_at
FROM raw_products p LEFT JOIN raw_category_translation t ON p.product_category_name = t.product_category_name
WHERE p.product_id IS NOT NULL""",
    "bronze_payments": """
SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type, payment_installments, payment_value,
       ingested_at
FROM raw_payments WHERE order_id IS NOT NULL AND payment_value >= 0""",
    "bronze_reviews": """
SELECT review_id, order_id, review_score,
       CASE WHEN review_score >= 4 THEN 'positive' WHEN review_score = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
       review_creation_date, review_answer_timestamp, ingested_at
FROM raw_reviews WHERE review_id IS NOT NULL AND review_score BETWEEN 1 AND 5""",
}

_SILVER = {
    "payments_by_order": """
SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS total_payment,
       max(payment_installments) AS max_installments,
       string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types
FROM bronze_payments GROUP BY order_id""",
    "items_by_order": """
SELECT order_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(18,2)) AS items_revenue,
       CAST(sum(freight_value) AS DECIMAL(18,2)) AS freight_revenue,
       CAST(sum(total_item_value) AS DECIMAL(18,2)) AS total_revenue
FROM bronze_order_items GROUP BY order_id""",
    "silver_orders": """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       CAST(date_trunc('day', o.order_purchase_timestamp) AS DATE) AS order_date,
       CAST(date_trunc('week', o.order_purchase_timestamp) AS DATE) AS order_week,
       CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS order_month,
       CAST(extract(year FROM o.order_purchase_timestamp) AS INT) AS order_year,
       CAST(extract(month FROM o.order_purchase_timestamp) AS INT) AS order_month_num,
       CAST(extract(dow FROM o.order_purchase_timestamp) AS INT) AS order_dow,
       o.is_late_delivery,
       coalesce(i.n_items, 0) AS n_items,
       CAST(coalesce(i.items_revenue, 0) AS DECIMAL(18,2)) AS items_revenue,
       CAST(coalesce(i.freight_revenue, 0) AS DECIMAL(18,2)) AS freight_revenue,
       CAST(coalesce(i.total_revenue, 0) AS DECIMAL(18,2)) AS total_revenue,
       CAST(coalesce(p.total_payment, 0) AS DECIMAL(18,2)) AS total_payment,
       p.payment_types, p.max_installments, r.review_score, r.sentiment,
       CASE WHEN o.order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
       CASE WHEN o.order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled
FROM bronze_orders o
LEFT JOIN items_by_order i ON o.order_id = i.order_id
LEFT JOIN payments_by_order p ON o.order_id = p.order_id
LEFT JOIN bronze_reviews r ON o.order_id = r.order_id""",
    "customer_order_stats": """
SELECT customer_id, count(*) AS total_orders, CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_spent,
       CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_order_value,
       min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date,
       CASE WHEN count(review_score) > 0 THEN CAST(sum(review_score) AS DOUBLE) / count(review_score) END AS avg_review_score,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_orders, CAST(sum(is_canceled) AS BIGINT) AS canceled_orders
FROM silver_orders GROUP BY customer_id""",
    "silver_customers": f"""
SELECT c.customer_id, c.customer_unique_id, c.customer_city, c.customer_state,
       coalesce(s.total_orders, 0) AS total_orders,
       CAST(coalesce(s.total_spent, 0) AS DECIMAL(38,2)) AS total_spent,
       CAST(coalesce(s.avg_order_value, 0) AS DOUBLE) AS avg_order_value,
       s.first_order_date, s.last_order_date,
       CAST(coalesce(s.avg_review_score, 0) AS DOUBLE) AS avg_review_score,
       coalesce(s.delivered_orders, 0) AS delivered_orders, coalesce(s.canceled_orders, 0) AS canceled_orders,
       CASE WHEN s.total_orders IS NULL THEN 'never_purchased'
            WHEN s.last_order_date >= TIMESTAMP '{AS_OF}' - INTERVAL '180' DAY THEN 'active'
            WHEN s.last_order_date >= TIMESTAMP '{AS_OF}' - INTERVAL '365' DAY THEN 'at_risk'
            ELSE 'churned' END AS customer_status
FROM bronze_customers c LEFT JOIN customer_order_stats s ON c.customer_id = s.customer_id""",
    "product_sales": """
SELECT oi.product_id, count(DISTINCT oi.order_id) AS total_orders,
       CAST(sum(oi.price) AS DECIMAL(38,2)) AS total_revenue,
       CAST(sum(oi.price) AS DOUBLE) / count(oi.price) AS avg_price,
       CAST(sum(oi.freight_value) AS DECIMAL(38,2)) AS total_freight,
       CASE WHEN count(r.review_score) > 0 THEN CAST(sum(r.review_score) AS DOUBLE) / count(r.review_score) END AS avg_review_score
FROM bronze_order_items oi
LEFT JOIN silver_orders o ON oi.order_id = o.order_id
LEFT JOIN bronze_reviews r ON oi.order_id = r.order_id
WHERE o.order_status = 'delivered'
GROUP BY oi.product_id""",
    "silver_products": """
SELECT p.product_id, p.category_english, p.category_portuguese, p.product_photos_qty, p.product_weight_g,
       coalesce(s.total_orders, 0) AS total_orders,
       CAST(coalesce(s.total_revenue, 0) AS DECIMAL(38,2)) AS total_revenue,
       CAST(coalesce(s.avg_price, 0) AS DOUBLE) AS avg_price,
       CAST(coalesce(s.total_freight, 0) AS DECIMAL(38,2)) AS total_freight,
       CAST(coalesce(s.avg_review_score, 0) AS DOUBLE) AS avg_review_score
FROM bronze_products p LEFT JOIN product_sales s ON p.product_id = s.product_id""",
}

_GOLD = {
    "gold_revenue_daily": """
SELECT order_date, order_year, order_month_num, order_dow, count(order_id) AS n_orders,
       count(DISTINCT customer_id) AS n_customers,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS gross_revenue,
       CAST(sum(freight_revenue) AS DECIMAL(38,2)) AS freight_revenue,
       CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_order_value,
       CAST(sum(n_items) AS BIGINT) AS total_items,
       CASE WHEN count(review_score) > 0 THEN CAST(sum(review_score) AS DOUBLE) / count(review_score) END AS avg_review_score,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_orders, CAST(sum(is_canceled) AS BIGINT) AS canceled_orders,
       CAST((2 * sum(is_canceled) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS cancel_rate_pct,
       CASE WHEN sum(is_delivered) > 0
            THEN CAST((2 * sum(CASE WHEN is_late_delivery THEN 1 ELSE 0 END) * 10000 + sum(is_delivered))
                      // (2 * sum(is_delivered)) AS DOUBLE) / 100.0 END AS late_delivery_pct
FROM silver_orders WHERE order_date IS NOT NULL
GROUP BY order_date, order_year, order_month_num, order_dow""",
    "rfm_base": f"""
SELECT customer_id, CAST(date_diff('day', max(order_date), DATE '{AS_OF[:10]}') AS INT) AS recency_days,
       count(*) AS frequency, CAST(sum(total_revenue) AS DECIMAL(38,2)) AS monetary
FROM silver_orders WHERE order_status = 'delivered' GROUP BY customer_id""",
    "rfm_scores": """
SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS FIRST, customer_id) AS INT) AS r_score,
       CAST(ntile(5) OVER (ORDER BY frequency NULLS LAST, customer_id) AS INT) AS f_score,
       CAST(ntile(5) OVER (ORDER BY monetary NULLS LAST, customer_id) AS INT) AS m_score
FROM rfm_base""",
    "gold_customer_rfm": """
SELECT c.customer_id, c.customer_state, c.customer_status, c.total_spent, c.avg_review_score,
       s.recency_days, s.frequency, s.monetary, s.r_score, s.f_score, s.m_score,
       CAST((2 * (s.r_score + s.f_score + s.m_score) * 100 + 3) // 6 AS DOUBLE) / 100.0 AS rfm_score,
       CASE WHEN s.r_score >= 4 AND s.f_score >= 4 THEN 'Champions'
            WHEN s.r_score >= 3 AND s.f_score >= 3 THEN 'Loyal'
            WHEN s.r_score >= 4 AND s.f_score <= 2 THEN 'New Customers'
            WHEN s.r_score >= 3 AND s.m_score >= 4 THEN 'Potential Loyalists'
            WHEN s.r_score <= 2 AND s.f_score >= 3 THEN 'At Risk'
            WHEN s.r_score <= 2 AND s.f_score <= 2 THEN 'Lost'
            ELSE 'Needs Attention' END AS rfm_segment
FROM silver_customers c LEFT JOIN rfm_scores s ON c.customer_id = s.customer_id""",
    "gold_product_performance": """
SELECT product_id, category_english, avg_price, total_orders, total_revenue, total_freight, avg_review_score,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS BIGINT) AS revenue_rank,
       CAST(rank() OVER (ORDER BY total_orders DESC NULLS FIRST) AS BIGINT) AS orders_rank,
       CAST(rank() OVER (PARTITION BY category_english ORDER BY total_revenue DESC NULLS FIRST) AS BIGINT) AS category_rank,
       CASE WHEN grand > 0 THEN CAST((2 * mine * 100000 + grand) // (2 * grand) AS DOUBLE) / 1000.0 END AS revenue_share_pct
FROM (SELECT *, CAST(total_revenue * 100 AS HUGEINT) AS mine,
             CAST(sum(total_revenue) OVER () * 100 AS HUGEINT) AS grand FROM silver_products) AS p""",
}

_MARTS = {
    "kpi_overview": """
SELECT count(DISTINCT order_id) AS n_orders, count(DISTINCT customer_id) AS n_customers,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue,
       CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_order_value,
       CAST(sum(review_score) AS DOUBLE) / count(review_score) AS avg_review,
       CAST((2 * sum(is_canceled) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS cancel_rate
FROM silver_orders WHERE order_status <> 'canceled'""",
    "revenue_monthly": """
SELECT order_month AS month, CAST(sum(total_revenue) AS DECIMAL(38,2)) AS revenue, count(*) AS orders
FROM silver_orders WHERE order_status = 'delivered' GROUP BY order_month ORDER BY month NULLS LAST""",
    "orders_by_status": """
SELECT order_status, count(*) AS n FROM silver_orders GROUP BY order_status ORDER BY n DESC, order_status NULLS LAST""",
    "revenue_daily": "SELECT * FROM gold_revenue_daily ORDER BY order_date",
    "rfm_segments": """
SELECT rfm_segment, count(*) AS n,
       CASE WHEN count(monetary) > 0 THEN CAST(sum(monetary) AS DOUBLE) / count(monetary) END AS avg_spent,
       CASE WHEN count(frequency) > 0 THEN CAST(sum(frequency) AS DOUBLE) / count(frequency) END AS avg_orders,
       CASE WHEN count(recency_days) > 0 THEN CAST(sum(recency_days) AS DOUBLE) / count(recency_days) END AS avg_recency
FROM gold_customer_rfm WHERE rfm_segment IS NOT NULL GROUP BY rfm_segment""",
    "customers_by_state": """
SELECT customer_state, count(*) AS n_customers, CAST(sum(total_spent) AS DECIMAL(38,2)) AS total_revenue
FROM silver_customers GROUP BY customer_state
ORDER BY total_revenue DESC NULLS FIRST, customer_state NULLS LAST LIMIT 10""",
    "product_performance": """
SELECT category_english, count(*) AS n_products, CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(total_revenue) AS DECIMAL(38,2)) AS total_revenue, round(avg(avg_review_score), 6) AS avg_review
FROM silver_products WHERE category_english IS NOT NULL GROUP BY category_english
ORDER BY total_revenue DESC NULLS FIRST, category_english LIMIT 15""",
    "reviews_dist": """
SELECT review_score, sentiment, count(*) AS n FROM bronze_reviews GROUP BY review_score, sentiment""",
    "reviews_by_category": f"""
SELECT p.category_english, CAST(sum(r.review_score) AS DOUBLE) / count(r.review_score) AS avg_score, count(*) AS n
FROM bronze_reviews r
JOIN silver_orders o ON r.order_id = o.order_id
JOIN bronze_order_items oi ON r.order_id = oi.order_id
JOIN bronze_products p ON oi.product_id = p.product_id
WHERE p.category_english IS NOT NULL
GROUP BY p.category_english HAVING count(*) > {MIN_REVIEW_ROWS}
ORDER BY avg_score DESC NULLS FIRST, category_english LIMIT 12""",
}


def _money_label(value: str) -> str:
    v = f"CAST({value} AS DOUBLE)"
    return (
        f"CASE WHEN {v} >= 1000000 THEN printf('R$%.2fM', {v} / 1000000) "
        f"WHEN {v} >= 1000 THEN printf('R$%.0fK', {v} / 1000) ELSE printf('R$%.0f', {v}) END"
    )


_DERIVED = {
    "overview_cards": f"""
SELECT 'Total Orders' AS card, format('{{:,}}', n_orders) AS text FROM kpi_overview
UNION ALL SELECT 'Total Revenue', {_money_label('total_revenue')} FROM kpi_overview
UNION ALL SELECT 'Avg Order Value', {_money_label('avg_order_value')} FROM kpi_overview
UNION ALL SELECT 'Avg Review', printf('%.2f / 5', avg_review) FROM kpi_overview
UNION ALL SELECT 'Cancel Rate', printf('%.1f', cancel_rate) || '%' FROM kpi_overview""",
    "revenue_headline": """
SELECT CAST(sum(gross_revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(n_orders) AS BIGINT) AS total_orders,
       round(avg(avg_order_value), 6) AS mean_daily_aov, round(avg(late_delivery_pct), 6) AS mean_daily_late_pct
FROM gold_revenue_daily""",
    "revenue_by_dow": """
SELECT order_dow, CAST(sum(gross_revenue) AS DECIMAL(38,2)) AS gross_revenue,
       ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][order_dow + 1] AS day
FROM gold_revenue_daily GROUP BY order_dow""",
    "revenue_by_calendar_month": """
SELECT order_month_num, CAST(sum(gross_revenue) AS DECIMAL(38,2)) AS gross_revenue,
       ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][order_month_num] AS month
FROM gold_revenue_daily GROUP BY order_month_num""",
    "rfm_headline": """
SELECT CAST(sum(n) AS BIGINT) AS total_customers,
       CAST(coalesce(sum(n) FILTER (WHERE rfm_segment = 'Champions'), 0) AS BIGINT) AS champions,
       CAST(coalesce(sum(n) FILTER (WHERE rfm_segment = 'At Risk'), 0) AS BIGINT) AS at_risk
FROM rfm_segments""",
    "category_headline": """
SELECT count(*) AS n_categories,
       (SELECT category_english FROM product_performance
        ORDER BY total_revenue DESC NULLS FIRST, category_english LIMIT 1) AS top_category,
       (SELECT category_english FROM product_performance
        ORDER BY avg_review DESC NULLS LAST, total_revenue DESC, category_english LIMIT 1) AS best_rated_category,
       max(avg_review) AS best_rated_score
FROM product_performance""",
    "category_scatter": """
SELECT category_english, substring(category_english, 1, 12) AS label, total_orders, avg_review,
       CAST(total_revenue AS DOUBLE) / CAST(max(total_revenue) OVER () AS DOUBLE) * 30 + 8 AS marker_size
FROM product_performance""",
    "review_sentiment_share": """
SELECT CAST(sum(n) AS BIGINT) AS total_reviews,
       CAST(sum(n) FILTER (WHERE sentiment = 'positive') AS BIGINT) AS n_positive,
       CAST(sum(n) FILTER (WHERE sentiment = 'positive') AS DOUBLE) / sum(n) * 100 AS positive_pct,
       CAST(sum(n) FILTER (WHERE sentiment = 'neutral') AS BIGINT) AS n_neutral,
       CAST(sum(n) FILTER (WHERE sentiment = 'neutral') AS DOUBLE) / sum(n) * 100 AS neutral_pct,
       CAST(sum(n) FILTER (WHERE sentiment = 'negative') AS BIGINT) AS n_negative,
       CAST(sum(n) FILTER (WHERE sentiment = 'negative') AS DOUBLE) / sum(n) * 100 AS negative_pct
FROM reviews_dist""",
    "category_review_flag": """
SELECT category_english, avg_score, avg_score >= 4 AS is_good FROM reviews_by_category""",
    "money_label": f"""
SELECT order_date, {_money_label('gross_revenue')} AS gross_revenue_label,
       {_money_label('avg_order_value')} AS avg_order_value_label
FROM gold_revenue_daily""",
}


def _report(done: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{done}' AS status, count(*) AS n_rows FROM raw_{t}" for t in RAW_TABLES
    )


def _check(name: str, observed: str, op: str = "==", expected: int = 0) -> str:
    sign = "=" if op == "==" else op
    return (
        f"SELECT '{name}' AS name, observed, '{op}' AS op, CAST({expected} AS BIGINT) AS expected,"
        f" observed {sign} {expected} AS passed FROM (SELECT CAST(count(*) AS BIGINT) AS observed FROM {observed}) AS q"
    )


_STATUSES = "'delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'created', 'approved', 'unavailable'"
_TYPES = "'credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined'"

_CHECKS = {
    "raw_load_report": _report("loaded"),
    "copy_table_report": "SELECT table_name, CASE WHEN table_name = 'category_translation' THEN 'skipped' ELSE status END AS status,"
    " CASE WHEN table_name = 'category_translation' THEN NULL ELSE n_rows END AS n_rows FROM"
    f" ({_report('copied')}) AS counted",
    # written from the star tables, apart from the statements that make the files
    "csv_payments": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS payment_sequential,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS payment_type,
       CAST(o_orderkey % 12 AS INTEGER) AS payment_installments, CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
FROM orders""",
    "csv_sellers": """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, printf('%05d', s_suppkey) AS seller_zip_code_prefix,
       s_name || CASE WHEN s_suppkey % 4 = 1 THEN ',' || chr(10) || '"east", ' ELSE ', ' END || CAST(s_nationkey AS VARCHAR) AS seller_city,
       CASE WHEN s_nationkey <> 7 THEN CAST(s_nationkey AS VARCHAR) END AS seller_state
FROM supplier""",
    "csv_reviews": """
SELECT CAST(doc_id AS VARCHAR) AS review_id, 'o' || CAST(doc_id AS VARCHAR) AS order_id, CAST(doc_id % 5 + 1 AS INTEGER) AS review_score,
       '"' || source || '" says, ' || lang AS review_comment_title, nullif(text, '') AS review_comment_message,
       TIMESTAMP '2018-01-01 00:00:00' + (doc_id % 1000) * INTERVAL '1' DAY AS review_creation_date,
       TIMESTAMP '2021-01-01 10:11:12' AS review_answer_timestamp
FROM documents""",
    "csv_load_report": """
SELECT 'payments' AS table_name, 'loaded' AS status, count(*) AS n_rows FROM orders
UNION ALL SELECT 'sellers', 'loaded', count(*) FROM supplier
UNION ALL SELECT 'reviews', 'loaded', count(*) FROM documents
UNION ALL SELECT name, 'skipped', NULL
          FROM (VALUES ('orders'), ('order_items'), ('customers'), ('products'), ('category_translation')) AS absent(name)""",
    "quality_report": " UNION ALL ".join(
        [
            _check("orders — no null order_id", "raw_orders WHERE order_id IS NULL"),
            _check("orders — no null customer_id", "raw_orders WHERE customer_id IS NULL"),
            _check("orders — valid status", f"raw_orders WHERE order_status NOT IN ({_STATUSES})"),
            _check("orders — minimum rows", "raw_orders", ">=", MIN_ORDERS),
            _check("customers — no null customer_id", "raw_customers WHERE customer_id IS NULL"),
            _check("customers — no null state", "raw_customers WHERE customer_state IS NULL"),
            _check("products — no null product_id", "raw_products WHERE product_id IS NULL"),
            _check("payments — positive values", "raw_payments WHERE payment_value < 0"),
            _check("payments — valid types", f"raw_payments WHERE payment_type NOT IN ({_TYPES})"),
            _check("reviews — score between 1 and 5", "raw_reviews WHERE review_score NOT BETWEEN 1 AND 5"),
            _check(
                "order_items — valid order_id",
                "raw_order_items i LEFT JOIN raw_orders o ON i.order_id = o.order_id WHERE o.order_id IS NULL",
            ),
            _check(
                "payments — valid order_id",
                "raw_payments p LEFT JOIN raw_orders o ON p.order_id = o.order_id WHERE o.order_id IS NULL",
            ),
        ]
    ),
}

# Each statement may use all that stand before it.
STATEMENTS = {**_RAW, **_BRONZE, **_SILVER, **_GOLD, **_MARTS, **_DERIVED, **_CHECKS}


def oracle_statement(name: str) -> str:
    """Self-contained SQL: the tables that the statement needs as common table expressions, then itself."""
    needed: list[str] = []

    def add(text: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for other in STATEMENTS:
            if other in words and other not in needed and other != name:
                add(STATEMENTS[other])
                needed.append(other)

    add(STATEMENTS[name])
    ctes = ", ".join(f"{n} AS MATERIALIZED ({STATEMENTS[n].strip()})" for n in needed)
    return f"WITH {ctes} {STATEMENTS[name].strip()}" if ctes else STATEMENTS[name].strip()
