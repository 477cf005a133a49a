"""Every registered query against its SQL, and again with the size limits lowered."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from ordermill.functions import skew
from ordermill.operators import ranking, silver
from ordermill.plans.star_queries import QUERIES
from tools import check_oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, db, name):
    assert check_oracle.compare(spark, db, name, SF_DIR, entry.oracle_sql()[name]) == []


LARGE = [
    "silver_orders",
    "silver_customers",
    "product_sales",
    "silver_products",
    "gold_revenue_daily",
    "rfm_scores",
    "gold_customer_rfm",
    "gold_product_performance",
    "reviews_by_category",
]


@pytest.mark.parametrize("name", LARGE)
def test_matches_sql_with_hot_keys(spark, db, name, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 8)
    monkeypatch.setattr(silver, "WIDE_ORDER", 1)
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 20)
    assert check_oracle.compare(spark, db, name, SF_DIR, entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
