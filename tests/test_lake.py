"""Versions, buckets and journal of the lake."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.functions import skew
from ordermill.operators import gold, quality, silver
from ordermill.plans import daily_run, files
from ordermill.plans.journal import Journal
from ordermill.plans.lake import Lake
from ordermill.schemas import MARTS, RAW_COLUMNS, RAW_TABLES, TEXT_WIDTHS, raw_schema
from ordermill.sources.copying import copy_lake, jdbc_column_types
from ordermill.sources.csv_files import FILE_STEMS
from ordermill.sources.star import StarRaw

SF_DIR = "/root/testdata/sf0.001"
AS_OF = "2001-08-02 00:00:00"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def filled(spark, root) -> Lake:
    lake, raw = Lake(spark, str(root)), StarRaw(spark, SF_DIR)
    for table in RAW_TABLES:
        lake.write("raw", table, raw[table])
    return lake


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = filled(spark, tmp_path_factory.mktemp("lake"))
    daily_run.build_models(lake, AS_OF)
    return lake


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write("gold", "t", spark.range(3).toDF("x"))
    before = lake.read("gold", "t")
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).cast("long").alias("x"))
    with pytest.raises(Exception, match="broken"):
        lake.write("gold", "t", broken)
    assert lake.read("gold", "t").count() == before.count() == 3
    lake.write("gold", "t", spark.range(5).toDF("x"))
    assert lake.read("gold", "t").count() == 5
    assert before.count() == 3  # opened before the change, still whole
    lake.write("gold", "t", spark.range(7).toDF("x"))
    assert len([n for n in files.folders(spark, lake.path("gold", "t")) if n.startswith("v-")]) == 2
    lake.drop("gold", "t")
    assert not lake.exists("gold", "t") and files.folders(spark, lake.path("gold", "t")) == []
    with pytest.raises(FileNotFoundError):
        lake.read("gold", "t")


def test_marts_are_of_one_write(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    one = lambda n, k: spark.createDataFrame([(n, k)], "run int, mart string")
    lake.write_set("marts", {k: lambda k=k: one(1, k) for k in MARTS})
    broken = {k: lambda k=k: one(2, k) for k in MARTS}
    broken[MARTS[-1]] = lambda: one(2, "x").select(F.raise_error(F.lit("broken")).alias("run"))
    with pytest.raises(Exception, match="broken"):
        lake.write_set("marts", broken)
    assert {lake.read("marts", k).first()["run"] for k in MARTS} == {1}
    lake.write_set("marts", {k: lambda k=k: one(3, k) for k in MARTS})
    assert {tuple(lake.read("marts", k).first()) for k in MARTS} == {(3, k) for k in MARTS}
    lake.drop("marts")
    assert not any(lake.exists("marts", k) for k in MARTS)


def test_stored_tables_join_by_order_without_a_shuffle(lake, spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        items, orders, reviews = lake.bronze("bronze_order_items"), lake.silver("silver_orders"), lake.bronze("bronze_reviews")
        plans = [
            silver.silver_orders(lake.bronze("bronze_orders"), items, lake.bronze("bronze_payments"), reviews, lake.hot_orders("reviews")),
            silver.product_sales(items, orders, reviews, lake.hot_orders("order_items")),
            daily_run.live_mart(lake, "reviews_by_category"),
            quality._orphans(lake.raw("order_items"), lake.raw("orders"), "items"),
            quality._orphans(lake.raw("payments"), lake.raw("orders"), "payments"),
        ]
        for df in plans:
            assert "Exchange hashpartitioning(order_id" not in plan_of(df)
    finally:
        spark.conf.set(name, before)


def test_another_session_reads_the_buckets(lake, spark):
    table = "ordermill_" + lake.read("raw", "orders")._jdf.queryExecution().analyzed().toString().split("ordermill_")[1][:32]
    spark.sql(f"DROP TABLE {table}")  # the catalog of another application does not know it
    again = Lake(spark, lake.root)
    assert rows(again.raw("orders").drop("ingested_at")) == rows(StarRaw(spark, SF_DIR)["orders"].drop("ingested_at"))
    assert again.raw("orders").schema == raw_schema("orders")
    assert "Exchange" not in plan_of(again.raw("orders").groupBy("order_id").count())


def test_orders_with_very_many_rows_are_not_stored_in_buckets(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(silver, "WIDE_ORDER", 1)
    hot = filled(spark, tmp_path)
    assert hot.buckets_of("raw", "order_items") == hot.buckets_of("raw", "reviews") == 0 < hot.buckets_of("raw", "orders")
    assert hot.hot_orders("order_items").count() > 0 and hot.hot_orders("reviews").count() > 0
    assert lake.hot_orders("order_items").count() == 0
    daily_run.build_models(hot, AS_OF)
    assert hot.buckets_of("silver", "silver_orders") == 0 < lake.buckets_of("silver", "silver_orders")
    for layer, table in (("silver", "silver_orders"), ("silver", "silver_products"), ("gold", "gold_revenue_daily")):
        assert rows(hot.read(layer, table)) == rows(lake.read(layer, table))
    assert rows(daily_run.live_mart(hot, "reviews_by_category", 1)) == rows(daily_run.live_mart(lake, "reviews_by_category", 1))


def test_a_copy_keeps_the_buckets(spark, lake, tmp_path):
    other = Lake(spark, str(tmp_path))
    copy_lake(lake, other).collect()
    assert other.buckets_of("raw", "order_items") == lake.buckets_of("raw", "order_items") > 0
    assert rows(other.raw("order_items")) == rows(lake.raw("order_items"))
    assert "Exchange" not in plan_of(other.raw("order_items").groupBy("order_id").count())


def test_a_plain_lake_gives_the_same_tables(spark, lake, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 4)
    plain = Lake(spark, str(tmp_path), buckets=0)
    copy_lake(lake, plain).collect()
    assert plain.buckets_of("raw", "order_items") == 0 and plain.hot_orders("order_items") is None
    daily_run.build_models(plain, AS_OF)
    for layer, table in (("silver", "silver_orders"), ("silver", "silver_products"), ("gold", "gold_customer_rfm")):
        assert rows(plain.read(layer, table)) == rows(lake.read(layer, table))
    assert rows(daily_run.live_mart(plain, "reviews_by_category", 1)) == rows(daily_run.live_mart(lake, "reviews_by_category", 1))


def _csv(spark, root):
    raw = StarRaw(spark, SF_DIR)
    for table, stem in FILE_STEMS.items():
        df = raw[table].drop("ingested_at")
        if table == "orders":
            df = df.withColumn("order_status", F.lower(F.trim("order_status")))
        if table == "payments":
            df = df.withColumn("payment_type", F.lower(F.trim("payment_type")))
        if table == "reviews":
            df = df.filter("review_score <= 5")
        df.select([F.col(c).cast("string") for c in RAW_COLUMNS[table]]).write.mode("overwrite").option("header", True).csv(f"{root}/{stem}.csv")


def test_a_failed_run_goes_on_where_it_failed(spark, tmp_path, monkeypatch):
    _csv(spark, tmp_path / "csv")
    lake = Lake(spark, f"{tmp_path}/lake")
    run = lambda: daily_run.run_all(spark, f"{tmp_path}/csv", lake.root, min_orders=100)
    whole = gold.gold_customer_rfm

    def broken(*args, **kwargs):
        raise RuntimeError("gold broke")

    monkeypatch.setattr(gold, "gold_customer_rfm", broken)
    with pytest.raises(RuntimeError, match="gold broke"):
        run()
    monkeypatch.setattr(gold, "gold_customer_rfm", whole)
    done = [("raw", t) for t in RAW_TABLES] + [("silver", "silver_orders"), ("silver", "silver_customers")]
    before = {t: lake.version(*t) for t in done}
    state = json.loads(files.read_text(spark, f"{lake.root}/_journal"))
    assert not state["finished"] and "gold/gold_customer_rfm" not in state["steps"]
    assert state["steps"]["silver/silver_orders"]["rows"] == {"silver/silver_orders": lake.silver("silver_orders").count()}

    assert run().count() == 12
    assert {t: lake.version(*t) for t in done} == before  # nothing below gold was built again
    after = json.loads(files.read_text(spark, f"{lake.root}/_journal"))
    assert after["finished"] and after["settings"] == state["settings"]
    assert daily_run.get_mart(lake, "rfm_segments").count() > 0

    # a finished run is not gone on with, changed inputs are built again
    run()
    assert all(lake.version(*t) != before[t] for t in done)


def test_journal_repeats_a_step_whose_inputs_changed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    calls = []

    def build(name):
        calls.append(name)
        return lake.write("gold", name, spark.range(len(calls)).toDF("x"))

    build("a")
    journal = Journal(lake, {"k": 1, "as_of": None})
    assert journal.setting("as_of", lambda: "now") == "now"
    for _ in range(2):
        journal.table(("gold", "b"), [("gold", "a")], lambda: build("b"))
    assert calls == ["a", "b"]
    again = Journal(lake, {"k": 1, "as_of": None})
    assert again.resumed and again.setting("as_of", lambda: "later") == "now"
    again.table(("gold", "b"), [("gold", "a")], lambda: build("b"))
    assert calls == ["a", "b"]
    build("a")
    again.table(("gold", "b"), [("gold", "a")], lambda: build("b"))
    build("b")  # written by somebody else
    again.table(("gold", "b"), [("gold", "a")], lambda: build("b"))
    assert calls == ["a", "b", "a", "b", "b", "b"]
    assert not Journal(lake, {"k": 2, "as_of": None}).resumed


def test_column_types_of_target_tables(spark):
    assert jdbc_column_types(raw_schema("order_items")) == (
        "`order_id` VARCHAR(50), `order_item_id` INT, `product_id` VARCHAR(50), `seller_id` VARCHAR(50), `shipping_limit_date` TIMESTAMP, "
        "`price` DECIMAL(10,2), `freight_value` DECIMAL(10,2), `ingested_at` TIMESTAMP"
    )
    assert "review_comment" not in jdbc_column_types(raw_schema("reviews"))
    for table in RAW_TABLES:
        text = {f.name for f in raw_schema(table).fields if f.dataType.simpleString() == "string"}
        assert text - TEXT_WIDTHS.keys() <= {"review_comment_title", "review_comment_message"}
        parsed = spark._jvm.org.apache.spark.sql.types.StructType.fromDDL(jdbc_column_types(raw_schema(table)))
        assert parsed.size() == len(raw_schema(table)) - len(text - TEXT_WIDTHS.keys())

