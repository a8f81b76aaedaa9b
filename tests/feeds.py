"""Small hand-written change feeds."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidestar.schemas import feed_schema

BASE = dt.datetime(2024, 6, 1)
CREATED = dt.datetime(2024, 1, 1)


def at(minutes: float | None) -> dt.datetime | None:
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def customers(spark, *rows):
    """Rows of (Op, id, name, city, minutes)."""
    data = [(o, i, n, f"{n}@example.com", c, "US", CREATED, at(m)) for o, i, n, c, m in rows]
    return spark.createDataFrame(data, feed_schema("customers"))


def products(spark, *rows):
    """Rows of (Op, id, name, price, minutes)."""
    data = [(o, i, n, "Tools", Decimal(p), CREATED, at(m)) for o, i, n, p, m in rows]
    return spark.createDataFrame(data, feed_schema("products"))


def orders(spark, *rows):
    """Rows of (Op, id, customer_id, date, minutes)."""
    data = [(o, i, c, d, "shipped", Decimal("1.00"), at(m)) for o, i, c, d, m in rows]
    return spark.createDataFrame(data, feed_schema("orders"))


def items(spark, *rows):
    """Rows of (Op, id, order_id, product_id, quantity, price, minutes)."""
    data = [(o, i, r, p, q, Decimal(u), at(m)) for o, i, r, p, q, u, m in rows]
    return spark.createDataFrame(data, feed_schema("order_items"))


ARRIVAL = {t: ("Timestamp",) for t in ("customers", "products", "orders")} | {
    "order_items": ("product_id", "quantity", "unit_price")
}
