"""Change feeds derived from the order-management sample tables.

Every customer, part, order and line item is inserted. Some customers and
parts are updated or deleted later; which ones follows from their attributes:

* customers of the segment BUILDING move to another city, those of AUTOMOBILE
  get an update that changes nothing, those with a negative balance are deleted;
* parts of size above 40 become dearer, those of size 36 to 40 get an update
  that changes nothing, those of size up to 2 are deleted.

Line numbers repeat within an order, so the item feed holds real duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Change times of the three batches, and the creation time.
INSERTED_AT = "2024-01-01 00:00:00"
UPDATED_AT = "2024-02-01 00:00:00"
DELETED_AT = "2024-03-01 00:00:00"
CREATED_AT = "2023-06-01 12:00:00"

# Order of arrival where two changes have the same time.
ARRIVAL = {
    "customers": ("Timestamp",),
    "products": ("Timestamp",),
    "orders": ("Timestamp",),
    "order_items": ("product_id", "quantity", "unit_price"),
}


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


_schemas: dict[str, T.StructType] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A sample table. Its schema is read from a footer once, not at every use."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _explode_changes(rows: DataFrame, columns: list[str], update: Column, changed: dict[str, Column], delete: Column) -> DataFrame:
    """Insert, update and delete rows from one scan of the table.

    Only the operation is exploded; the other columns are taken after that, so
    a query that needs few of them reads few of them.
    """
    op = F.explode(F.array_compact(F.array(F.lit("I"), F.when(update, "U"), F.when(delete, "D"))))
    times = F.when(F.col("Op") == "I", at(INSERTED_AT)).when(F.col("Op") == "U", at(UPDATED_AT)).otherwise(at(DELETED_AT))
    values = {c: F.when(F.col("Op") == "U", new).otherwise(F.col(c)) for c, new in changed.items()}
    return rows.select("*", op.alias("Op")).select(
        "Op", *[values.get(c, F.col(c)).alias(c) for c in columns], times.alias("Timestamp"),
    )


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            (F.col("c_custkey") + 1).alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            at(CREATED_AT).alias("created_at"),
            "c_mktsegment", "c_acctbal",
        )
    )
    moved = F.when(F.col("c_mktsegment") == "BUILDING", F.concat("city", F.lit(" WEST"))).otherwise(F.col("city"))
    return _explode_changes(
        rows, ["id", "name", "email", "city", "country", "created_at"],
        F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), {"city": moved}, F.col("c_acctbal") < 0,
    )


def products_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        at(CREATED_AT).alias("created_at"),
        "p_size",
    )
    dearer = F.when(F.col("p_size") > 40, F.col("price") + F.lit("1.00").cast("decimal(10,2)")).otherwise(F.col("price"))
    return _explode_changes(
        rows, ["id", "name", "category", "price", "created_at"],
        F.col("p_size") > 35, {"price": dearer.cast("decimal(10,2)")}, F.col("p_size") <= 2,
    )


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.lit("I").alias("Op"),
        (F.col("o_orderkey") + 1).alias("id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        at(INSERTED_AT).alias("Timestamp"),
    )


def order_items_feed(spark: SparkSession, sf_dir: str, returnflag: str | None = None) -> DataFrame:
    """All items, or the batch of items that share one return flag."""
    lines = read(spark, sf_dir, "lineitem")
    if returnflag is not None:
        lines = lines.where(F.col("l_returnflag") == returnflag)
    return lines.select(
        F.lit("I").alias("Op"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_orderkey") + 1).alias("order_id"),
        (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("Timestamp"),
    )


FEEDS = {
    "customers": customers_feed,
    "products": products_feed,
    "orders": orders_feed,
    "order_items": order_items_feed,
}


def sample_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: feed(spark, sf_dir) for table, feed in FEEDS.items()}
