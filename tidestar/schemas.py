"""Declared schemas of the source tables and of the star schema.

Ids are INT in the source system. A feed with more than 2^31 rows per table
needs BIGINT ids, so every schema takes ``id_type``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = T.IntegerType()
WIDE_ID = T.LongType()
PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
NTZ = T.TimestampNTZType()



def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, without a Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


SOURCE_TABLES = ("customers", "products", "orders", "order_items")
STAR_TABLES = ("dim_customer", "dim_product", "dim_date", "fact_orders")


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def source_schema(table: str, id_type: T.DataType = ID) -> T.StructType:
    """Columns of one source table, without the change columns."""
    columns = {
        "customers": [
            ("id", id_type), ("name", T.StringType()), ("email", T.StringType()),
            ("city", T.StringType()), ("country", T.StringType()), ("created_at", NTZ),
        ],
        "products": [
            ("id", id_type), ("name", T.StringType()), ("category", T.StringType()),
            ("price", PRICE), ("created_at", NTZ),
        ],
        "orders": [
            ("id", id_type), ("customer_id", id_type), ("order_date", T.DateType()),
            ("status", T.StringType()), ("total", AMOUNT),
        ],
        "order_items": [
            ("id", id_type), ("order_id", id_type), ("product_id", id_type),
            ("quantity", T.IntegerType()), ("unit_price", PRICE),
        ],
    }[table]
    return _struct(*[(name, kind, True) for name, kind in columns])


def feed_schema(table: str, id_type: T.DataType = ID, ts_col: str = "Timestamp") -> T.StructType:
    """A change row: ``Op``, the source columns, the change time."""
    head = [T.StructField("Op", T.StringType())]
    tail = [T.StructField(ts_col, NTZ)]
    return T.StructType(head + source_schema(table, id_type).fields + tail)


def union_feed_schema(id_type: T.DataType = ID, ts_col: str = "Timestamp") -> T.StructType:
    """All columns of the four feeds, for one stream over the whole prefix."""
    fields: dict[str, T.StructField] = {}
    for table in SOURCE_TABLES:
        for field in feed_schema(table, id_type, ts_col).fields:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


def star_schema(table: str, id_type: T.DataType = ID) -> T.StructType:
    long, text, flag = T.LongType(), T.StringType(), T.BooleanType()
    whole, day = T.IntegerType(), T.DateType()
    return {
        "dim_customer": lambda: _struct(
            ("customer_key", long, False), ("customer_id", id_type, False), ("name", text, True),
            ("email", text, True), ("city", text, True), ("country", text, True),
            ("created_date", NTZ, True), ("effective_start_date", NTZ, True),
            ("effective_end_date", NTZ, True), ("is_current", flag, False),
        ),
        "dim_product": lambda: _struct(
            ("product_key", long, False), ("product_id", id_type, False), ("product_name", text, True),
            ("category", text, True), ("unit_price", PRICE, True), ("created_date", NTZ, True),
            ("effective_start_date", NTZ, True), ("effective_end_date", NTZ, True),
            ("is_current", flag, False),
        ),
        "dim_date": lambda: _struct(
            ("date_sk", whole, False), ("full_date", day, False), ("year", whole, False),
            ("month", whole, False), ("day", whole, False), ("quarter", whole, False),
            ("day_of_week", text, True), ("is_weekend", flag, False),
        ),
        "fact_orders": lambda: _struct(
            ("order_sk", long, False), ("order_id", id_type, False), ("customer_key", long, False),
            ("product_key", long, False), ("date_sk", whole, False), ("quantity", whole, True),
            ("unit_price", PRICE, True), ("total_amount", AMOUNT, True), ("order_status", text, True),
            ("order_timestamp", NTZ, True),
        ),
    }[table]()
