"""A whole run from CSV files, the marts, and the shape of the plans."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from ordermill.operators import gold, marts, quality
from ordermill.plans import daily_run
from ordermill.plans.lake import Lake
from ordermill.plans.star_queries import AS_OF, StarModels
from ordermill.schemas import BRONZE_TABLES, GOLD_TABLES, MARTS, RAW_COLUMNS, SILVER_TABLES
from ordermill.sources.copying import copy_lake
from ordermill.sources.csv_files import FILE_STEMS
from ordermill.sources.star import StarRaw

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A finished run over CSV files made from the star tables; its bad values are repaired for the gate."""
    root = tmp_path_factory.mktemp("run")
    raw = StarRaw(spark, SF_DIR)
    for table, stem in FILE_STEMS.items():
        df = raw[table].drop("ingested_at")
        if table == "orders":
            df = df.withColumn("order_status", F.lower(F.trim("order_status")))
        if table == "payments":
            df = df.withColumn("payment_type", F.lower(F.trim("payment_type")))
        if table == "reviews":
            df = df.filter("review_score <= 5")
        df = df.select([F.col(c).cast("string") for c in RAW_COLUMNS[table]])
        df.write.option("header", True).csv(f"{root}/csv/{stem}.csv")
    report = daily_run.run_all(spark, f"{root}/csv", f"{root}/lake", AS_OF, min_orders=100)
    assert report.filter(~F.col("passed")).count() == 0
    return Lake(spark, f"{root}/lake")


def rows(df, *drop):
    df = df.drop(*drop)
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_stored_tables_equal_direct_queries(spark, lake):
    models = StarModels(spark, SF_DIR)
    assert rows(lake.bronze("bronze_orders"), "ingested_at") == rows(models.bronze("bronze_orders"), "ingested_at")
    assert rows(lake.silver("silver_orders")) == rows(models.orders())
    assert rows(lake.silver("silver_customers")) == rows(models.customers())
    assert rows(lake.silver("silver_products")) == rows(models.products())
    assert rows(lake.gold("gold_revenue_daily")) == rows(models.daily())
    assert rows(lake.gold("gold_customer_rfm")) == rows(models.rfm())


def test_gold_products_are_stored_by_revenue(lake):
    files = sorted(lake.gold("gold_product_performance").inputFiles())
    ranks = [r[0] for f in files for r in lake.spark.read.parquet(f).select("revenue_rank").collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1


def test_marts(lake):
    live = {k: daily_run.live_mart(lake, k) for k in MARTS}
    live = {k: (df.columns, df.collect()) for k, df in live.items()}
    few, many = (daily_run.get_mart(lake, "reviews_by_category", n).count() for n in (100, 1))
    assert few < many
    for key, (columns, found) in live.items():
        assert lake.exists("marts", key)
        stored = daily_run.get_mart(lake, key)
        assert (stored.columns, stored.collect()) == (columns, found), key
        assert len(stored.inputFiles()) == 1
    with pytest.raises(KeyError):
        daily_run.get_mart(lake, "nothing")


def test_totals_agree(lake):
    daily = lake.gold("gold_revenue_daily")
    head = marts.revenue_headline(daily).first()
    by_day = marts.revenue_by_dow(daily).agg(F.sum("gross_revenue")).first()[0]
    by_month = marts.revenue_by_calendar_month(daily).agg(F.sum("gross_revenue")).first()[0]
    assert head["total_revenue"] == by_day == by_month
    rfm = lake.gold("gold_customer_rfm")
    assert marts.rfm_headline(marts.rfm_segments(rfm)).first()["total_customers"] == rfm.count()
    shares = lake.gold("gold_product_performance").agg(F.sum("revenue_share_pct")).first()[0]
    assert abs(shares - 100) < 0.5
    for table, raw in {"bronze_order_items": "order_items", "bronze_reviews": "reviews"}.items():
        assert lake.bronze(table).count() <= lake.raw(raw).count()


def test_views(spark, lake):
    views = lake.register_views()
    assert {*BRONZE_TABLES, *SILVER_TABLES, *GOLD_TABLES} <= set(views)
    sql = "SELECT order_status, count(*) AS n FROM silver_orders GROUP BY 1"
    assert rows(spark.sql(sql)) == rows(marts.orders_by_status(lake.silver("silver_orders")))


def test_one_layer(lake):
    daily_run.run_layer(lake, "gold", AS_OF)
    assert lake.exists("gold", "gold_customer_rfm")
    with pytest.raises(ValueError, match="platinum"):
        daily_run.run_layer(lake, "platinum")


def test_gate_stops_a_run(spark, tmp_path):
    os.makedirs(tmp_path / "csv")
    for table, stem in FILE_STEMS.items():
        (tmp_path / "csv" / f"{stem}.csv").write_text(",".join(RAW_COLUMNS[table]) + "\n")
    with pytest.raises(quality.QualityError, match="minimum rows"):
        daily_run.run_all(spark, str(tmp_path / "csv"), str(tmp_path / "lake"), AS_OF)


# --- Plans -------------------------------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_scans_read_only_what_is_used(lake):
    plan = plan_of(marts.revenue_monthly(lake.silver("silver_orders")))
    assert "ReadSchema: struct<order_status:string,order_month:date,total_revenue:decimal(18,2)>" in plan
    assert "EqualTo(order_status,delivered)" in plan


def test_translation_is_broadcast_by_size(lake):
    assert "BroadcastHashJoin" in plan_of(lake.bronze("bronze_products"))


def test_one_shuffle_per_input_of_silver_orders(spark, no_broadcast):
    plan = plan_of(StarModels(spark, SF_DIR).orders())
    # orders, items, payments and reviews, each once, by order_id
    assert plan.count("Exchange hashpartitioning(order_id") == 4
    assert plan.count("Exchange") == 4


def test_product_sales_shuffles_items_twice(spark, lake, no_broadcast):
    plan = plan_of(StarModels(spark, SF_DIR).sales())
    # grouping by order and product uses the shuffle of the join
    assert not re.search(r"hashpartitioning\(order_id#\d+, product_id", plan)
    assert plan.count("Exchange hashpartitioning(product_id") == 1
    assert "Exchange SinglePartition" not in plan


def test_large_rankings_use_no_single_task(spark, lake):
    products = lake.silver("silver_products")
    plan = plan_of(gold.gold_product_performance(products, rows_per_bucket=20))
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    # one window for each order, by buckets of bounded size; nothing is joined back
    assert len(windows) == 3 and all(re.search(r"\[__bucket\d#\d+, __salt\d#\d+L?, \w+#\d+\]", line) for line in windows)
    assert "Join" not in plan
    scores = gold.rfm_scores(gold.rfm_base(lake.silver("silver_orders"), AS_OF), rows_per_bucket=20)
    # quintiles are found beforehand: what is left neither sorts nor shuffles
    assert "Window" not in plan_of(scores) and "Exchange" not in plan_of(scores)


def test_no_join_forms_all_pairs(spark):
    models = StarModels(spark, SF_DIR)
    for df in (models.products(), models.review_scores(), models.customers()):
        assert "CartesianProduct" not in plan_of(df) and "BroadcastNestedLoopJoin" not in plan_of(df)


def test_a_run_goes_on_without_a_file_and_refreshes_the_marts(spark, tmp_path):
    raw = StarRaw(spark, SF_DIR)

    def write(rate):
        for table, stem in FILE_STEMS.items():
            if table in ("category_translation", "sellers"):
                continue
            df = raw[table].drop("ingested_at")
            if table == "orders":
                df = df.withColumn("order_status", F.lower(F.trim("order_status"))).filter(f"order_id % {rate} = 0")
            if table in ("order_items", "payments", "reviews"):
                df = df.filter(f"order_id % {rate} = 0")
            if table == "payments":
                df = df.withColumn("payment_type", F.lower(F.trim("payment_type")))
            if table == "reviews":
                df = df.filter("review_score <= 5")
            df = df.select([F.col(c).cast("string") for c in RAW_COLUMNS[table]])
            df.write.mode("overwrite").option("header", True).csv(f"{tmp_path}/csv/{stem}.csv")

    lake = Lake(spark, f"{tmp_path}/lake")
    counts = []
    for rate in (2, 5):
        write(rate)
        report = daily_run.run_all(spark, f"{tmp_path}/csv", f"{tmp_path}/lake", min_orders=10)
        assert report.count() == 12
        assert lake.exists("marts", "kpi_overview")
        counts.append(daily_run.get_mart(lake, "kpi_overview").first()["n_orders"])
        expect = raw["orders"].filter(f"order_id % {rate} = 0 AND lower(trim(order_status)) <> 'canceled'").count()
        assert counts[-1] == expect
    assert lake.raw("category_translation").count() == 0
    # a rebuilt layer leaves no marts of the tables before
    daily_run.run_layer(lake, "gold", AS_OF)
    assert not any(lake.exists("marts", k) for k in MARTS)

    other = Lake(spark, f"{tmp_path}/other")
    copied = {r["table_name"]: r["status"] for r in copy_lake(lake, other).collect()}
    assert copied["raw/orders"] == copied["gold/gold_customer_rfm"] == "copied" and copied["marts/kpi_overview"] == "skipped"
    assert other.raw("orders").count() == lake.raw("orders").count()
    none = copy_lake(Lake(spark, f"{tmp_path}/nothing"), other).collect()
    assert {r["status"] for r in none} == {"skipped"}


def test_no_expand_in_the_overview(spark):
    plan = StarModels(spark, SF_DIR)
    frame = marts.kpi_overview(plan.sold_orders, plan.orders(items=False, payments=False))
    assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()
