"""Order facts, rejected items and hard deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.convert import (
    to_date_safe,
    to_decimal_safe,
    to_int_safe,
    to_string_safe,
    to_timestamp_safe,
)
from tidestar.functions.keys import surrogate_key
from tidestar.operators.dimensions import _column, date_sk
from tidestar.operators.skew import SkewPolicy, heavy_keys, keyed_join
from tidestar.schemas import AMOUNT


def _orders(orders: DataFrame, id_type: T.DataType) -> DataFrame:
    return orders.select(
        to_int_safe(*_column(orders, "id"), id_type).alias("order_id"),
        to_int_safe(*_column(orders, "customer_id"), id_type).alias("customer_id"),
        to_date_safe(*_column(orders, "order_date")).alias("order_date"),
        to_timestamp_safe(*_column(orders, "order_date")).alias("order_timestamp"),
        to_string_safe(_column(orders, "status")[0]).alias("order_status"),
    )


def _items(items: DataFrame, id_type: T.DataType) -> DataFrame:
    # The item's own id makes rows distinct, which salting relies on. Items with ``since`` went through here before: a null price was too large.
    return items.select(
        *[c for c in ("Op", "since", "waited") if c in items.columns],
        F.col("id").cast("string").alias("item_id"),
        to_int_safe(*_column(items, "order_id"), id_type).alias("order_id"),
        to_int_safe(*_column(items, "product_id"), id_type).alias("product_id"),
        to_int_safe(*_column(items, "quantity")).alias("quantity"),
        (F.col("unit_price") if "since" in items.columns else to_decimal_safe(*_column(items, "unit_price"))).alias("unit_price"),
    )


def _current_ids(dim: DataFrame, natural_id: str) -> DataFrame:
    return dim.where("is_current").select(natural_id)


def _not_deleted(changes: DataFrame) -> DataFrame:
    return changes.where(~F.col("Op").eqNullSafe("D"))


def _heavy(orders: DataFrame, items: DataFrame, raw: dict[str, DataFrame] | None, id_type: T.DataType, skew: SkewPolicy) -> dict[str, DataFrame]:
    """Heavy keys of the three joins, counted in the feeds before dedup where they are given, which costs a narrow scan only."""
    many_orders = _orders(raw["orders"] if raw else orders, id_type)
    many_items = _items(raw["order_items"] if raw else items, id_type)
    return heavy_keys({"customer_id": many_orders, "order_id": many_items, "product_id": many_items}, skew)


def build_fact_orders(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    id_type: T.DataType = T.IntegerType(),
    drop_deleted: bool = False,
    skew: SkewPolicy = SkewPolicy(),
    raw: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One fact per order item whose order, customer, product and date exist.

    ``orders`` and ``items`` are deduplicated changes, ``customers`` and
    ``products`` dimension rows of which only current ones count. The keys of
    the dimensions are functions of the natural ids, so the dimensions are only
    asked whether the id exists: semi-joins on one narrow column. The date
    dimension holds every date of the same orders, so its lookup is a null
    test. The smaller side, orders, is cut down before it meets the items. An
    item whose price or total is too large for its column gives no fact either;
    :func:`fact_rejects` names it.

    The winners come out of an aggregation, and adaptive execution splits heavy
    keys only between two plain shuffles; so the joins split keys that are heavy
    by ``skew`` themselves. ``raw`` holds the feeds before dedup, to count keys in.
    """
    heavy = _heavy(orders, items, raw, id_type, skew)
    if drop_deleted:
        orders, items = _not_deleted(orders), _not_deleted(items)
    known_orders = keyed_join(
        _orders(orders, id_type).where("order_date IS NOT NULL"),
        _current_ids(customers, "customer_id"), "customer_id", "left_semi", heavy=heavy.get("customer_id"),
    )
    # One key per order here, not one per item later.
    known_orders = known_orders.withColumn(
        "customer_key", surrogate_key("dim_customer", F.col("customer_id"))
    ).drop("customer_id")
    known_items = keyed_join(
        _items(items, id_type).where("unit_price IS NOT NULL"), _current_ids(products, "product_id"), "product_id", "left_semi",
        heavy=heavy.get("product_id"),
    )
    lines = keyed_join(known_items, known_orders, "order_id", "inner", heavy=heavy.get("order_id"))
    return _facts(lines.withColumn("total_amount", _total()).where("total_amount IS NOT NULL"))


def _total() -> Column:
    """Null where the product is too large for its column."""
    return (F.col("unit_price") * F.col("quantity")).try_cast(AMOUNT)


def _facts(lines: DataFrame) -> DataFrame:
    return lines.select(
        surrogate_key("fact_orders", F.col("order_id"), F.col("product_id")).alias("order_sk"),
        "order_id",
        "customer_key",
        surrogate_key("dim_product", F.col("product_id")).alias("product_key"),
        date_sk(F.col("order_date")).alias("date_sk"),
        "quantity",
        "unit_price",
        "total_amount",
        "order_status",
        "order_timestamp",
    )


def fact_rejects(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    id_type: T.DataType = T.IntegerType(),
    drop_deleted: bool = False,
    skew: SkewPolicy = SkewPolicy(),
    raw: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The items that give no fact, each with the first reason that applies."""
    lines = judged_items(orders, items, customers, products, id_type=id_type, drop_deleted=drop_deleted, skew=skew, raw=raw)
    return lines.select("order_id", "product_id", "quantity", "unit_price", "reason").where("reason IS NOT NULL")


def facts_of(judged: DataFrame) -> DataFrame:
    """The facts among :func:`judged_items`."""
    kept = judged.where("reason IS NULL")
    return _facts(kept.withColumn("customer_key", surrogate_key("dim_customer", F.col("customer_id"))))


def with_totals(lines: DataFrame) -> DataFrame:
    """Lines with the date and the total that follow from their time, price and quantity."""
    return lines.withColumn("order_date", F.to_date("order_timestamp")).withColumn("total_amount", _total())


def judged_items(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    id_type: T.DataType = T.IntegerType(),
    drop_deleted: bool = False,
    skew: SkewPolicy = SkewPolicy(),
    raw: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Every item with its order, and the reason why it gives no fact, null where it gives one."""
    heavy = _heavy(orders, items, raw, id_type, skew)
    if drop_deleted:
        orders, items = _not_deleted(orders), _not_deleted(items)
    there = F.lit(True)
    marked_orders = keyed_join(
        _orders(orders, id_type),
        _current_ids(customers, "customer_id").withColumn("has_customer", there),
        "customer_id", "left", heavy=heavy.get("customer_id"),
    ).withColumn("has_order", there)
    marked_items = keyed_join(
        _items(items, id_type),
        _current_ids(products, "product_id").withColumn("has_product", there),
        "product_id", "left", heavy=heavy.get("product_id"),
    )
    lines = keyed_join(marked_items, marked_orders, "order_id", "left", heavy=heavy.get("order_id")).withColumn("total_amount", _total())
    reason = (
        F.when(F.col("has_order").isNull(), "order not found")
        .when(F.col("has_customer").isNull(), "no current customer")
        .when(F.col("has_product").isNull(), "no current product")
        .when(F.col("order_date").isNull(), "no order date")
        .when(F.col("unit_price").isNull(), "unit price too large")
        .when(F.col("total_amount").isNull(), "total too large")
    )
    return lines.withColumn("reason", reason).drop("has_order", "has_customer", "has_product")


def delete_facts(facts: DataFrame, deletes: DataFrame, *, batch_col: str | None = None) -> DataFrame:
    """Facts without those of deleted orders.

    With ``batch_col`` a delete removes only what was written up to its own
    batch, so an order that is written again later survives. Both sides come
    straight from tables, so adaptive execution can split a heavy order.
    """
    if batch_col is None:
        return facts.join(deletes.select("order_id"), "order_id", "left_anti")
    gone = deletes.select("order_id", F.col(batch_col).alias("_deleted_in"))
    on = (facts["order_id"] == gone["order_id"]) & (facts[batch_col] <= gone["_deleted_in"])
    return facts.join(gone, on, "left_anti")
