from __future__ import annotations

import pytest

from ordermill.operators import quality


@pytest.fixture
def good(raw):
    """Rows that pass, by table; a test changes one."""
    rows = {
        "orders": [{"order_id": "a", "customer_id": "c", "order_status": "delivered"}, {"order_id": "b", "customer_id": "c"}],
        "order_items": [{"order_id": "a"}],
        "customers": [{"customer_id": "c", "customer_state": "SP"}],
        "products": [{"product_id": "p"}],
        "payments": [{"order_id": "a", "payment_type": "boleto", "payment_value": 0}, {"order_id": "b"}],
        "reviews": [{"review_id": "r", "review_score": 1}, {"review_id": "r", "review_score": None}],
    }
    return rows


def report_of(raw, rows, min_orders=1):
    return quality.quality_report({t: raw(t, *r) for t, r in rows.items()}, min_orders)


def test_all_pass(raw, good):
    report = report_of(raw, good)
    quality.enforce(report)
    assert report.count() == 12


BAD = [
    ("orders — no null order_id", "orders", {"customer_id": "c"}),
    ("orders — no null customer_id", "orders", {"order_id": "x"}),
    ("orders — valid status", "orders", {"order_id": "x", "customer_id": "c", "order_status": "Delivered"}),
    ("customers — no null customer_id", "customers", {"customer_state": "SP"}),
    ("customers — no null state", "customers", {"customer_id": "x"}),
    ("products — no null product_id", "products", {}),
    ("payments — positive values", "payments", {"order_id": "a", "payment_value": "-0.01"}),
    ("payments — valid types", "payments", {"order_id": "a", "payment_type": " boleto"}),
    ("reviews — score between 1 and 5", "reviews", {"review_score": 6}),
    ("order_items — valid order_id", "order_items", {"order_id": "lost"}),
    ("order_items — valid order_id", "order_items", {}),
    ("payments — valid order_id", "payments", {"order_id": "lost"}),
    ("payments — valid order_id", "payments", {}),
]


@pytest.mark.parametrize(("name", "table", "row"), BAD)
def test_one_bad_row(raw, good, name, table, row):
    good[table].append(row)
    failed = [(r["name"], r["observed"]) for r in report_of(raw, good).collect() if not r["passed"]]
    assert failed == [(name, 1)]


def test_too_few_orders_and_gate(raw, good):
    report = report_of(raw, good, min_orders=3)
    with pytest.raises(quality.QualityError, match="minimum rows .observed 2."):
        quality.enforce(report)


def test_orphans_count_rows(raw, good):
    good["order_items"] += [{"order_id": "lost"}] * 3 + [{}]
    observed = {r["name"]: r["observed"] for r in report_of(raw, good).collect()}
    assert observed["order_items — valid order_id"] == 4
