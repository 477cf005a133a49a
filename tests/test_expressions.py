from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.functions import expressions as x


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "title"),
    [
        ("SÃO JOÃO D'OESTE", "São João D'Oeste"),
        ("embu-guaçu", "Embu-Guaçu"),
        ("2a x", "2a X"),
        ("", ""),
        ("-", "-"),
        ("rio  de", "Rio  De"),
    ],
)
def test_title_case(spark, text, title):
    assert one(spark, x.title_case(F.lit(text))) == title


def test_percent_rounds_exactly(spark):
    pairs = [(a, b) for b in (1, 3, 7, 8, 96, 160, 800, 20000) for a in range(0, b + 1, max(1, b // 7))]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for row in df.withColumn("p", x.percent(F.col("a"), F.col("b"))).collect():
        exact = (Decimal(row["a"] * 100) / row["b"]).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["p"] == float(exact), row


def test_percent_of_nothing_is_null(spark):
    assert one(spark, x.percent(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))) is None


def _python_label(v: float) -> str:
    if v >= 1e6:
        return f"R${v / 1e6:.2f}M"
    if v >= 1e3:
        return f"R${v / 1e3:.0f}K"
    return f"R${v:.0f}"


def test_money_label_like_python(spark):
    amounts = [0, 0.5, 1.5, 2.5, 999, 999.49, 999.5, 999.99, 1000, 1499.99, 1500, 2500, 3500, 999499, 999500]
    amounts += [999999.99, 1e6, 1005000, 1015000, 1025000, 2675000, 1234567.89, 15810000, 123456789012.34]
    df = spark.createDataFrame([(Decimal(str(a)).quantize(Decimal("0.01")),) for a in amounts], "a decimal(18,2)")
    for row in df.withColumn("t", x.money_label(F.col("a"))).collect():
        assert row["t"] == _python_label(float(row["a"])), row


def test_fixed_digits_and_thousands(spark):
    for v in (0.0, 0.05, 0.15, 4.125, 4.135, 99.95, 100.0):
        assert one(spark, x.fixed_digits(F.lit(v), 1)) == f"{v:.1f}"
        assert one(spark, x.fixed_digits(F.lit(v), 2)) == f"{v:.2f}"
    assert one(spark, x.thousands(F.lit(1234567))) == "1,234,567"


def test_labels(spark):
    days = [one(spark, x.label_of(F.lit(i), x.DAY_LABELS)) for i in range(8)]
    assert days == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", None]
    months = [one(spark, x.label_of(F.lit(i), x.MONTH_LABELS)) for i in (0, 1, 6, 12)]
    assert months == [None, "Jan", "Jun", "Dec"]


def test_distinct_list(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "")], "k int, t string")
    found = {r["k"]: r["l"] for r in df.groupBy("k").agg(x.distinct_list(F.col("t")).alias("l")).collect()}
    assert found == {1: "a, b", 2: None, 3: ""}


def test_exact_avg(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (2, None)], "k int, v int")
    found = {r["k"]: r["a"] for r in df.groupBy("k").agg(x.exact_avg(F.col("v")).alias("a")).collect()}
    assert found == {1: 1.5, 2: None}


def test_day_of_week(spark):
    # 2024-01-07 was a Sunday
    found = [one(spark, F.expr(x.DAY_OF_WEEK.format(f"date '2024-01-{d:02d}'"))) for d in range(7, 14)]
    assert found == [0, 1, 2, 3, 4, 5, 6]
