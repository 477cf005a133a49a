from __future__ import annotations

from decimal import Decimal

from ordermill.operators import bronze


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_orders(raw):
    def order(i, delivered, estimated, status=" Delivered", customer="c"):
        return {
            "order_id": i,
            "customer_id": customer,
            "order_status": status,
            "order_delivered_customer_date": delivered,
            "order_estimated_delivery_date": estimated,
        }

    df = bronze.bronze_orders(
        raw(
            "orders",
            order("a", None, "2018-01-02"),
            order("b", "2018-01-02", None),
            order("c", "2018-01-02", "2018-01-02", "CANCELED "),
            order("d", "2018-01-02 00:00:01", "2018-01-02"),
            order(None, None, None),
            order("f", None, None, customer=None),
            order("g", None, None, status=None),
        )
    )
    rows = {r["order_id"]: r for r in df.collect()}
    assert {k: r["is_late_delivery"] for k, r in rows.items()} == {"a": None, "b": None, "c": False, "d": True, "g": None}
    assert rows["a"]["order_status"] == "delivered" and rows["c"]["order_status"] == "canceled"
    assert rows["g"]["order_status"] is None


def test_items(raw):
    def item(i, price, freight=1):
        return {"order_id": i, "price": price, "freight_value": freight}

    df = bronze.bronze_order_items(
        raw("order_items", item("null", None), item("minus", "-0.01"), item("zero", 0), item(None, 5), item("no freight", 5, None))
    )
    assert {r["order_id"]: r["total_item_value"] for r in df.collect()} == {"zero": Decimal("1.00"), "no freight": None}


def test_customers(raw):
    df = bronze.bronze_customers(
        raw(
            "customers",
            {"customer_id": "a", "customer_city": "  embu-guaçu ", "customer_state": " sp"},
            {"customer_id": None, "customer_city": "x"},
        )
    )
    (row,) = df.collect()
    assert (row["customer_city"], row["customer_state"]) == ("Embu-Guaçu", "SP")


def test_products(raw):
    df = bronze.bronze_products(
        raw(
            "products",
            {"product_id": "a", "product_category_name": "brinquedos"},
            {"product_id": "b", "product_category_name": "outro"},
            {"product_id": "c"},
            {"product_id": None, "product_category_name": "brinquedos"},
        ),
        raw("category_translation", {"product_category_name": "brinquedos", "product_category_name_english": "toys"}),
    )
    assert {r["product_id"]: r["category_english"] for r in df.collect()} == {"a": "toys", "b": "outro", "c": "unknown"}


def test_payments(raw):
    def payment(i, value, kind="X "):
        return {"order_id": i, "payment_value": value, "payment_type": kind}

    df = bronze.bronze_payments(raw("payments", payment("a", 0), payment("b", "-1"), payment("c", None), payment(None, 1)))
    assert [(r["order_id"], r["payment_type"]) for r in df.collect()] == [("a", "x")]


def test_reviews(raw):
    rows = [{"review_id": str(s), "order_id": "o", "review_score": s} for s in (0, 1, 2, 3, 4, 5, 6, None)]
    df = bronze.bronze_reviews(raw("reviews", *rows, {"review_id": None, "review_score": 3}))
    assert {r["review_score"]: r["sentiment"] for r in df.collect()} == {
        1: "negative",
        2: "negative",
        3: "neutral",
        4: "positive",
        5: "positive",
    }
