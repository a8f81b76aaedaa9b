"""Dimension rows from deduplicated changes."""

from __future__ import annotations

from dataclasses import dataclass

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


@dataclass(frozen=True)
class Dimension:
    """Names that the history operators need to know of a dimension."""

    table: str
    key: str
    natural_id: str
    attributes: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, self.natural_id, *self.attributes,
                "effective_start_date", "effective_end_date", "is_current")


CUSTOMER = Dimension("dim_customer", "customer_key", "customer_id",
                     ("name", "email", "city", "country", "created_date"))
PRODUCT = Dimension("dim_product", "product_key", "product_id",
                    ("product_name", "category", "unit_price", "created_date"))


def _validity(batch_ts: Column) -> list[Column]:
    """A delete gives a closed marker row, any other change an open row."""
    deleted = F.coalesce(F.col("Op") == "D", F.lit(False))
    return [
        batch_ts.cast("timestamp_ntz").alias("effective_start_date"),
        F.when(deleted, batch_ts.cast("timestamp_ntz")).alias("effective_end_date"),
        (~deleted).alias("is_current"),
    ]


def _column(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A source column, or a null one where the feed does not carry it."""
    if name in df.columns:
        return F.col(name), df.schema[name].dataType
    return F.lit(None).cast("string"), T.StringType()


def customer_columns(changes: DataFrame, batch_ts: Column, id_type: T.DataType = T.IntegerType()) -> list[Column]:
    """The columns of a customer version, from those of a change."""
    customer_id = to_int_safe(*_column(changes, "id"), id_type)
    return [
        surrogate_key("dim_customer", customer_id).alias("customer_key"),
        customer_id.alias("customer_id"),
        *[to_string_safe(_column(changes, c)[0]).alias(c) for c in ("name", "email", "city", "country")],
        to_timestamp_safe(*_column(changes, "created_at")).alias("created_date"),
        *_validity(batch_ts),
    ]


def build_dim_customer(changes: DataFrame, batch_ts: Column, id_type: T.DataType = T.IntegerType()) -> DataFrame:
    return changes.select(*customer_columns(changes, batch_ts, id_type))


def product_columns(changes: DataFrame, batch_ts: Column, id_type: T.DataType = T.IntegerType()) -> list[Column]:
    """The columns of a product version, from those of a change."""
    product_id = to_int_safe(*_column(changes, "id"), id_type)
    return [
        surrogate_key("dim_product", product_id).alias("product_key"),
        product_id.alias("product_id"),
        to_string_safe(_column(changes, "name")[0]).alias("product_name"),
        to_string_safe(_column(changes, "category")[0]).alias("category"),
        to_decimal_safe(*_column(changes, "price")).alias("unit_price"),
        to_timestamp_safe(*_column(changes, "created_at")).alias("created_date"),
        *_validity(batch_ts),
    ]


def build_dim_product(changes: DataFrame, batch_ts: Column, id_type: T.DataType = T.IntegerType()) -> DataFrame:
    return changes.select(*product_columns(changes, batch_ts, id_type))


def date_sk(day: Column) -> Column:
    """A date as the number YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per distinct order date. At most one row per calendar day."""
    days = (
        orders.select(to_date_safe(*_column(orders, "order_date")).alias("full_date"))
        .where("full_date IS NOT NULL")
        .distinct()
    )
    day = F.col("full_date")
    return days.select(
        date_sk(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
