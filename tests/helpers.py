"""Hand-made raw tables for unit tests (ids as bigint, timestamps as text)."""

from __future__ import annotations

from decimal import Decimal

from mercato.schemas import RAW_TABLE_NAMES, raw_schema
from mercato.sources.testdata import RawTables


def D(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


DEFAULTS = {
    "customers": [(1, 100, "01001", "sao paulo", "sp"), (2, 200, "20000", "rio", "rj")],
    "sellers": [(10, "01001", "sao paulo", "sp"), (11, "30000", "belo horizonte", "mg")],
    "products": [(50, "cama", 10.0, 100.0, 1.0, 500.0, 10.0, 10.0, 10.0),
                 (51, "moveis", 20.0, 200.0, 2.0, 1500.0, 20.0, 10.0, 5.0)],
    "category_name_translation": [("cama", "bed"), ("moveis", "furniture")],
    "geolocation": [("01001", -23.5, -46.6, "sao paulo", "sp"), ("20000", -22.9, -43.2, "rio", "rj"),
                    ("30000", -19.9, -43.9, "bh", "mg")],
    "order_payments": [],
    "order_reviews": [],
    "order_items": [],
    "orders": [],
}


def order(order_id, customer_id=1, status="delivered", purchased="2018-01-10 10:00:00",
          approved="2018-01-10 12:00:00", carrier="2018-01-11 10:00:00",
          delivered="2018-01-15 10:00:00", estimated="2018-01-20 00:00:00"):
    return (order_id, customer_id, status, purchased, approved, carrier, delivered, estimated)


def item(order_id, item_id, product_id=50, seller_id=10, price=100, freight=10,
         limit="2018-01-12 00:00:00"):
    return (order_id, item_id, product_id, seller_id, limit, D(price), D(freight))


def review(review_id, order_id, score, answered="2018-01-25 00:00:00", created="2018-01-24 00:00:00"):
    return (review_id, order_id, score, None, None, created, answered)


def make_raw(spark, **tables) -> RawTables:
    frames = {}
    for name in RAW_TABLE_NAMES:
        rows = tables.get(name, DEFAULTS[name])
        frames[name] = spark.createDataFrame(rows, raw_schema(name, id_type="bigint"))
    return RawTables(**frames)
