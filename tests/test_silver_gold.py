"""Literal rows for what the test tables do not reach."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.functions import skew
from ordermill.operators import bronze, gold, marts, silver
from ordermill.plans.star_queries import StarModels
from ordermill.session import keep

AS_OF = "2018-09-01 00:00:00"


@pytest.fixture
def shop(raw):
    """Bronze tables. Order a has two items and three reviews, b none of either, c is canceled, d has no time."""

    def order(i, customer, status="delivered", at="2018-03-04 10:00:00", **more):
        return {"order_id": i, "customer_id": customer, "order_status": status, "order_purchase_timestamp": at, **more}

    late = {"order_delivered_customer_date": "2018-05-02", "order_estimated_delivery_date": "2018-05-01"}
    t = {
        "orders": raw(
            "orders",
            order("a", "c1", **late),
            order("b", "c1", at="2018-03-05"),
            order("c", "c2", "canceled", **late),
            order("d", "c3", at=None),
            order("e", "c4", None),
        ),
        "order_items": raw(
            "order_items",
            {"order_id": "a", "product_id": "p1", "price": 10, "freight_value": 2},
            {"order_id": "a", "product_id": "p1", "price": 30, "freight_value": None},
            {"order_id": "c", "product_id": "p2", "price": 7, "freight_value": 1},
            {"order_id": "lost", "product_id": "p2", "price": 9, "freight_value": 1},
        ),
        "payments": raw(
            "payments",
            {"order_id": "a", "payment_type": "voucher", "payment_installments": 1, "payment_value": 5},
            {"order_id": "a", "payment_type": "BOLETO ", "payment_installments": 3, "payment_value": 6},
            {"order_id": "b", "payment_type": None, "payment_installments": None, "payment_value": 1},
        ),
        "reviews": raw(
            "reviews",
            *[{"review_id": f"r{s}", "order_id": "a", "review_score": s} for s in (5, 5, 2)],
            {"review_id": "bad", "order_id": "b", "review_score": 9},
            {"review_id": "loose", "order_id": None, "review_score": 1},
        ),
        "customers": raw("customers", *[{"customer_id": f"c{i}", "customer_state": "sp"} for i in range(1, 6)]),
        "products": raw("products", {"product_id": "p1", "product_category_name": "toys"}, {"product_id": "p2"}, {"product_id": "p3"}),
        "category_translation": raw("category_translation"),
    }
    return {
        "orders": bronze.bronze_orders(t["orders"]),
        "items": bronze.bronze_order_items(t["order_items"]),
        "payments": bronze.bronze_payments(t["payments"]),
        "reviews": bronze.bronze_reviews(t["reviews"]),
        "customers": bronze.bronze_customers(t["customers"]),
        "products": bronze.bronze_products(t["products"], t["category_translation"]),
    }


@pytest.fixture(params=["small", "large"])
def limits(request, monkeypatch):
    """The plain branches, and those for hot keys and wide orders."""
    if request.param == "large":
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
        monkeypatch.setattr(silver, "WIDE_ORDER", 2)


@pytest.fixture
def orders(shop, limits):
    return keep(silver.silver_orders(shop["orders"], shop["items"], shop["payments"], shop["reviews"]), "orders")


def test_silver_orders(orders):
    rows = orders.orderBy("order_id", "review_score").collect()
    assert [(r["order_id"], r["review_score"], r["sentiment"]) for r in rows] == [
        ("a", 2, "negative"),
        ("a", 5, "positive"),
        ("a", 5, "positive"),
        ("b", None, None),
        ("c", None, None),
        ("d", None, None),
        ("e", None, None),
    ]
    a, b = rows[0], rows[3]
    # freight is missing for one item: its item value is missing from the total, its price is not
    assert (a["n_items"], a["items_revenue"], a["freight_revenue"], a["total_revenue"]) == (2, 40, 2, 12)
    assert (a["total_payment"], a["payment_types"], a["max_installments"]) == (11, "boleto, voucher", 3)
    assert (b["n_items"], b["total_revenue"], b["total_payment"], b["payment_types"]) == (0, 0, 1, None)
    # 2018-03-04 was a Sunday
    assert [str(a[c]) for c in ("order_date", "order_week", "order_month", "order_dow")] == [
        "2018-03-04",
        "2018-02-26",
        "2018-03-01",
        "0",
    ]
    assert rows[5]["order_date"] is None and rows[6]["is_delivered"] == 0 and rows[4]["is_canceled"] == 1


def test_orders_without_unused_measures(shop, orders):
    narrow = silver.silver_orders(shop["orders"], None, None, shop["reviews"])
    assert sorted(map(str, narrow.collect())) == sorted(map(str, orders.select(*narrow.columns).collect()))


def test_customers(shop, orders):
    rows = {r["customer_id"]: r for r in silver.silver_customers(shop["customers"], orders, AS_OF).collect()}
    # three rows of order a and one of order b
    assert (rows["c1"]["total_orders"], rows["c1"]["total_spent"], rows["c1"]["avg_order_value"]) == (4, 36, 9.0)
    assert rows["c1"]["avg_review_score"] == 4.0 and rows["c1"]["delivered_orders"] == 4
    assert rows["c2"]["avg_review_score"] == 0.0 and rows["c2"]["canceled_orders"] == 1
    assert rows["c3"]["customer_status"] == "churned" and rows["c5"]["customer_status"] == "never_purchased"
    assert (rows["c5"]["total_orders"], rows["c5"]["total_spent"], rows["c5"]["first_order_date"]) == (0, 0, None)


@pytest.mark.parametrize(
    ("at", "status"),
    [
        ("2018-03-05 00:00:00", "active"),
        ("2018-03-04 23:59:59", "at_risk"),
        ("2017-09-01 00:00:00", "at_risk"),
        ("2017-08-31 23:59:59", "churned"),
    ],
)
def test_status_boundaries(raw, at, status):
    orders = bronze.bronze_orders(
        raw("orders", {"order_id": "a", "customer_id": "c", "order_status": "created", "order_purchase_timestamp": at})
    )
    rows = silver.silver_orders(orders, bronze.bronze_order_items(raw("order_items")), None, bronze.bronze_reviews(raw("reviews")))
    customers = bronze.bronze_customers(raw("customers", {"customer_id": "c"}))
    # 180 and 365 days before the first of September
    assert silver.silver_customers(customers, rows, AS_OF).first()["customer_status"] == status


def test_products_count_reviews_twice(shop, orders):
    (sale,) = silver.product_sales(shop["items"], orders, shop["reviews"]).collect()
    assert sale["product_id"] == "p1" and sale["total_orders"] == 1
    # each item nine times: three order rows with three reviews
    assert (sale["total_revenue"], sale["avg_price"], sale["total_freight"]) == (360, 20.0, 18)
    assert sale["avg_review_score"] == 4.0
    products = {
        r["product_id"]: r
        for r in silver.silver_products(shop["products"], shop["items"], orders, shop["reviews"]).collect()
    }
    assert products["p1"]["total_revenue"] == 360
    assert products["p3"]["total_orders"] == 0 and products["p3"]["avg_review_score"] == 0.0


def test_daily(orders):
    days = {str(r["order_date"]): r for r in gold.gold_revenue_daily(orders).collect()}
    assert set(days) == {"2018-03-04", "2018-03-05"}
    day = days["2018-03-04"]
    # order a three times, c and e once; four rows are late, three delivered
    assert (day["n_orders"], day["n_customers"], day["gross_revenue"]) == (5, 3, 12 * 3 + 8)
    assert (day["cancel_rate_pct"], day["late_delivery_pct"]) == (20.0, 133.33)


def test_late_share_without_delivery(orders):
    only_canceled = orders.filter(F.col("order_status") == "canceled")
    assert gold.gold_revenue_daily(only_canceled).first()["late_delivery_pct"] is None


def test_rfm(shop, orders):
    customers = keep(silver.silver_customers(shop["customers"], orders, AS_OF), "customers")
    rows = {r["customer_id"]: r for r in gold.gold_customer_rfm(orders, customers, AS_OF).collect()}
    assert len(rows) == 5
    # c3 has no purchase time, so its recency is unknown and sorts first
    assert rows["c3"]["recency_days"] is None and rows["c3"]["r_score"] == 1
    assert (rows["c1"]["recency_days"], rows["c1"]["frequency"], rows["c1"]["monetary"]) == (180, 4, 36)
    assert rows["c1"]["r_score"] == 2 and rows["c1"]["rfm_score"] == 2.0
    assert rows["c2"]["rfm_score"] is None and rows["c2"]["rfm_segment"] == "Needs Attention"


SEGMENTS = [
    (4, 4, 1, "Champions"),
    (5, 3, 1, "Loyal"),
    (3, 5, 1, "Loyal"),
    (4, 2, 5, "New Customers"),
    (3, 2, 4, "Potential Loyalists"),
    (2, 3, 5, "At Risk"),
    (1, 2, 5, "Lost"),
    (3, 1, 3, "Needs Attention"),
]


def test_segments(spark, monkeypatch):
    scores = spark.createDataFrame(
        [(str(i), 1, 1, Decimal(1), r, f, m) for i, (r, f, m, _) in enumerate(SEGMENTS)],
        "customer_id string, recency_days int, frequency bigint, monetary decimal(38,2), r_score int, f_score int, m_score int",
    )
    monkeypatch.setattr(gold, "rfm_base", lambda *_: None)
    monkeypatch.setattr(gold, "rfm_scores", lambda *_: scores)
    customers = scores.select(
        "customer_id",
        F.lit("SP").alias("customer_state"),
        F.lit("active").alias("customer_status"),
        F.lit(1).alias("total_spent"),
        F.lit(1.0).alias("avg_review_score"),
    )
    rows = {r["customer_id"]: r for r in gold.gold_customer_rfm(None, customers).collect()}
    for i, (r, f, m, name) in enumerate(SEGMENTS):
        assert rows[str(i)]["rfm_segment"] == name
        assert rows[str(i)]["rfm_score"] == round((r + f + m) / 3, 2)


PRODUCT = (
    "product_id string, category_english string, avg_price double, total_orders bigint, "
    "total_revenue decimal(38,2), total_freight decimal(38,2), avg_review_score double"
)


def test_product_ranks_and_order(spark):
    rows = [("a", "x", 5), ("b", "x", 9), ("c", "y", 9), ("d", "y", 0), ("e", "x", 0)]
    products = spark.createDataFrame([(i, c, 1.0, n, Decimal(n), Decimal(0), 0.0) for i, c, n in rows], PRODUCT)
    got = gold.gold_product_performance(keep(products, "products")).collect()
    assert [r["product_id"] for r in got] == ["b", "c", "a", "d", "e"]
    assert [r["revenue_rank"] for r in got] == [1, 1, 3, 4, 4]
    assert [r["category_rank"] for r in got] == [1, 1, 2, 2, 3]
    assert [r["revenue_share_pct"] for r in got] == [39.13, 39.13, 21.739, 0.0, 0.0]


def test_share_of_nothing(spark):
    products = spark.createDataFrame([("a", "x", 0.0, 0, Decimal(0), Decimal(0), 0.0)], PRODUCT)
    assert gold.gold_product_performance(keep(products, "products")).first()["revenue_share_pct"] is None


def test_overview_leaves_out_canceled_and_unknown(orders):
    row = marts.kpi_overview(orders).first()
    assert (row["n_orders"], row["n_customers"], row["cancel_rate"]) == (3, 2, 0.0)
    statuses = [(r["order_status"], r["n"]) for r in marts.orders_by_status(orders).collect()]
    assert statuses == [("delivered", 5), ("canceled", 1), (None, 1)]


def test_monthly_keeps_unknown_month_last(orders):
    assert [(str(r["month"]), r["revenue"], r["orders"]) for r in marts.revenue_monthly(orders).collect()] == [
        ("2018-03-01", 36, 4),
        ("None", 0, 1),
    ]


def test_reviews_by_category(shop, orders):
    args = (shop["reviews"], orders, shop["items"], shop["products"])
    # two items, three reviews, three order rows
    assert [tuple(r) for r in marts.reviews_by_category(*args, min_count=17).collect()] == [("toys", 4.0, 18)]
    assert marts.reviews_by_category(*args, min_count=18).collect() == []


def test_top_lists_are_sorted_and_limited(spark):
    customers = spark.createDataFrame([(f"s{i:02d}", Decimal(i // 2)) for i in range(30)], "customer_state string, total_spent decimal(38,2)")
    got = [r["customer_state"] for r in marts.customers_by_state(customers).collect()]
    assert got == ["s28", "s29", "s26", "s27", "s24", "s25", "s22", "s23", "s20", "s21"]


def test_headline_ties_and_missing_segments(spark):
    categories = spark.createDataFrame(
        [("b", 1, 1, Decimal(5), 4.5), ("a", 1, 1, Decimal(5), 4.5), ("c", 1, 1, Decimal(1), 4.5), ("long category name", 1, 1, Decimal(0), 1.0)],
        "category_english string, n_products bigint, total_orders bigint, total_revenue decimal(38,2), avg_review double",
    )
    row = marts.category_headline(categories).first()
    assert tuple(row) == (4, "a", "a", 4.5)
    points = {r["category_english"]: r for r in marts.category_scatter(categories).collect()}
    assert points["a"]["marker_size"] == 38.0 and points["long category name"]["marker_size"] == 8.0
    assert points["long category name"]["label"] == "long categor"
    segments = spark.createDataFrame([("Lost", 3)], "rfm_segment string, n bigint")
    assert tuple(marts.rfm_headline(segments).first()) == (3, 0, 0)


def test_sentiment_share(spark):
    reviews = spark.createDataFrame([(5, "positive", 3), (1, "negative", 1)], "review_score int, sentiment string, n bigint")
    row = marts.review_sentiment_share(reviews).first()
    assert (row["total_reviews"], row["positive_pct"], row["n_neutral"], row["negative_pct"]) == (4, 75.0, 0, 25.0)


def test_overview_cards(spark):
    kpi = spark.createDataFrame(
        [(98816, 98000, Decimal("15810000"), 159.4, 4.1, 0.0)],
        "n_orders bigint, n_customers bigint, total_revenue decimal(38,2), avg_order_value double, avg_review double, cancel_rate double",
    )
    cards = {r["card"]: r["text"] for r in marts.overview_cards(kpi).collect()}
    assert cards == {
        "Total Orders": "98,816",
        "Total Revenue": "R$15.81M",
        "Avg Order Value": "R$159",
        "Avg Review": "4.10 / 5",
        "Cancel Rate": "0.0%",
    }


def test_wall_clock_is_the_default(raw):
    now = datetime.now().replace(microsecond=0)
    orders = bronze.bronze_orders(
        raw("orders", {"order_id": "a", "customer_id": "c", "order_status": "delivered", "order_purchase_timestamp": now})
    )
    rows = silver.silver_orders(orders, bronze.bronze_order_items(raw("order_items")), None, bronze.bronze_reviews(raw("reviews")))
    customers = bronze.bronze_customers(raw("customers", {"customer_id": "c"}))
    assert silver.silver_customers(customers, rows).first()["customer_status"] == "active"
    assert abs(gold.rfm_base(rows).first()["recency_days"]) <= 1


def test_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 300)
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    # a third hot, a third unknown, the rest single rows
    assert [tuple(r) for r in skew.hot_keys(df, "k").collect()] == [("hot", 2)]
    assert skew.hot_keys(df.filter(F.col("k") != "hot"), "k").count() == 0
    assert skew.hot_keys(df.filter(F.col("k").isNull()), "k").count() == 0


def test_a_key_with_a_small_share_is_hot_too(spark, monkeypatch):
    """More rows than the limit, but less than a thousandth of all rows."""
    monkeypatch.setattr(skew, "HOT_ROWS", 40)
    df = spark.range(100_000).select(F.when(F.col("id") % 1990 == 7, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [tuple(r) for r in skew.hot_keys(df, "k").collect()] == [("hot", 2)]


def _skewed(spark, n):
    """A third of the rows has one key and a value each, a ninth one key and one value; the rest are keys of five rows."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9 == 1, "pair").when(F.col("id") % 9 == 2, F.lit(None)).otherwise((F.col("id") / 5).cast("int").cast("string"))
    left = spark.range(n).select(k.alias("k"), F.when(k == "pair", "p").otherwise(F.concat(F.lit("v"), "id")).alias("v"), F.col("id").alias("a"), F.lit(1).cast("long").alias("n"))
    right = left.select("k").distinct().filter("k <> '7'").withColumn("w", F.length("k")).withColumn("x", F.lit("y"))
    return left, right.union(spark.createDataFrame([("absent", 1, "y")], right.schema))


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("limit", [1, 100, 10**6])
def test_salted_join_equals_a_plain_one(spark, monkeypatch, limit, broadcast):
    monkeypatch.setattr(skew, "HOT_ROWS", limit)
    left, right = _skewed(spark, 3_000)
    sums = [F.sum("a").alias("a"), F.sum("n").alias("n")]
    want = left.join(right, "k").groupBy("k", "v", "w", "x").agg(*sums)
    with _broadcast(spark, broadcast):
        got = skew.salted_join(left, right, "k", "v", ["a", "n"]).groupBy("k", "v", "w", "x").agg(*sums)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_join_deals_hot_keys_and_keeps_pairs_together(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    left, right = _skewed(spark, 9_000)
    rows = skew.salted_join(left, right, "k", "v", ["a", "n"])
    by_salt = {(r["k"], r["salt"]): r["count"] for r in rows.filter("k IN ('hot', 'pair')").groupBy("k", "salt").count().collect()}
    hot = [n for (k, _), n in by_salt.items() if k == "hot"]
    assert len(hot) == 30 and max(hot) < 200 and sum(hot) == 3_000
    assert [n for (k, _), n in by_salt.items() if k == "pair"] == [1]  # added up before the join
    assert rows.filter("k NOT IN ('hot', 'pair')").agg(F.max("salt")).first()[0] == 0


def test_very_many_hot_keys_are_all_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    left = spark.range(600_000).select((F.col("id") % 200_000).cast("string").alias("k"), F.col("id").cast("string").alias("v"), F.lit(1).cast("long").alias("n"))
    right = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("w"))
    hot = skew.hot_keys(left, "k")
    assert hot.count() == 200_000 and hot.agg(F.min("salts"), F.max("salts")).first()[:] == (2, 2)
    rows = skew.salted_join(left, right, "k", "v", ["n"], hot)
    split = rows.groupBy("k").agg(F.countDistinct("salt").alias("salts"), F.sum("n").alias("n"))
    found = split.agg(F.count(F.lit(1)), F.min("n"), F.max("n"), F.sum((F.col("salts") == 2).cast("int"))).first()
    # of three rows, all fall on one of two salts in a quarter of the cases
    assert tuple(found)[:3] == (200_000, 3, 3) and 145_000 < found[3] < 155_000


def test_the_plan_is_one_for_all_sizes_and_needs_no_hint(spark):
    left, right = _skewed(spark, 1_000)
    plan = skew.salted_join(left, right, "k", "v", ["a", "n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "hint" not in plan.lower()


def test_wide_orders_read_the_shuffles_of_the_others(spark, monkeypatch):
    monkeypatch.setattr(silver, "WIDE_ORDER", 1)
    with _broadcast(spark, False):
        df = StarModels(spark, "/root/testdata/sf0.001").orders()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    exchanges = [line for line in final.splitlines() if re.search(r"\bExchange hashpartitioning\(order_id#\d+, \d+\)", line)]
    assert len([line for line in exchanges if "Reused" not in line]) == 4  # orders, items, payments, reviews
    assert len(exchanges) == 8


@contextmanager
def _broadcast(spark, allowed):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "10m" if allowed else "-1")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
