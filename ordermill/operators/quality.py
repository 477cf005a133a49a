"""Twelve checks on the raw tables, and the gate that stops a run when one fails."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a status and a payment type may be, written exactly so.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "invoiced",
    "processing",
    "created",
    "approved",
    "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
MIN_ORDERS = 90_000


class QualityError(ValueError):
    """At least one check failed."""


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _report(table: DataFrame, checks: list[tuple[str, Column, str, int]]) -> DataFrame:
    """One pass over the table for all of its checks, one row for each."""
    observed = table.agg(*[value.cast("bigint").alias(f"c{i}") for i, (_, value, _, _) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            F.col(f"c{i}").alias("observed"),
            F.lit(op).alias("op"),
            F.lit(expected).cast("bigint").alias("expected"),
        )
        for i, (name, _, op, expected) in enumerate(checks)
    ]
    return observed.select(F.inline(F.array(*rows)))


def _orphans(child: DataFrame, orders: DataFrame, name: str) -> DataFrame:
    """Rows of ``child`` whose order is missing. Rows are counted per order id first, so the join has
    one row per id on both sides; rows without an id count as well."""
    per_order = child.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    known = orders.select("order_id").filter(F.col("order_id").isNotNull()).distinct()
    lost = per_order.join(known, "order_id", "left_anti")
    return _report(lost, [(name, F.coalesce(F.sum("n"), F.lit(0)), "==", 0)])


def quality_report(raw: Mapping[str, DataFrame], min_orders: int = MIN_ORDERS) -> DataFrame:
    """name, observed, op, expected, passed: one row per check.

    Text is compared as stored, without trimming. A NULL status, type or score passes.
    """
    orders = raw["orders"]
    # The names of the checks, by which reports know them.
    parts = [
        _report(
            orders,
            [
                ("orders — no null order_id", _missing("order_id"), "==", 0),
                ("orders — no null customer_id", _missing("customer_id"), "==", 0),
                ("orders — valid status", F.count_if(~F.col("order_status").isin(*ORDER_STATUSES)), "==", 0),
                ("orders — minimum rows", F.count(F.lit(1)), ">=", min_orders),
            ],
        ),
        _report(
            raw["customers"],
            [
                ("customers — no null customer_id", _missing("customer_id"), "==", 0),
                ("customers — no null state", _missing("customer_state"), "==", 0),
            ],
        ),
        _report(raw["products"], [("products — no null product_id", _missing("product_id"), "==", 0)]),
        _report(
            raw["payments"],
            [
                ("payments — positive values", F.count_if(F.col("payment_value") < 0), "==", 0),
                ("payments — valid types", F.count_if(~F.col("payment_type").isin(*PAYMENT_TYPES)), "==", 0),
            ],
        ),
        _report(
            raw["reviews"],
            [("reviews — score between 1 and 5", F.count_if(~F.col("review_score").between(1, 5)), "==", 0)],
        ),
        _orphans(raw["order_items"], orders, "order_items — valid order_id"),
        _orphans(raw["payments"], orders, "payments — valid order_id"),
    ]
    report = reduce(DataFrame.unionByName, parts)
    passed = F.when(F.col("op") == "==", F.col("observed") == F.col("expected")).otherwise(
        F.col("observed") >= F.col("expected")
    )
    return report.withColumn("passed", passed)


def enforce(report: DataFrame) -> None:
    """Raise when a check failed, after all of them ran. Collects the twelve rows of the report."""
    failed = [f"{r['name']} (observed {r['observed']})" for r in report.collect() if not r["passed"]]
    if failed:
        raise QualityError(f"{len(failed)} check(s) failed: " + "; ".join(failed))
