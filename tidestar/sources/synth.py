"""Synthetic shop data, made by Spark from a frame of numbers.

Each value is a function of the row number and a salt through MD5, so a rerun
or a retried task gives the same rows, on any number of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, city and status pools, status weights, product templates.
FIRST_NAMES = [
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda",
    "David", "Elizabeth", "William", "Barbara", "Richard", "Susan", "Joseph", "Jessica",
    "Thomas", "Sarah", "Christopher", "Karen", "Daniel", "Lisa", "Matthew", "Nancy",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
    "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson",
    "Thomas", "Taylor", "Moore", "Jackson", "Martin", "Lee", "Perez", "Thompson",
]
CITIES = [
    "New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia",
    "San Antonio", "San Diego", "Dallas", "San Jose", "Austin", "Jacksonville",
    "Fort Worth", "Columbus", "Charlotte", "Indianapolis", "San Francisco", "Seattle",
]
STATUSES = [("pending", 0.15), ("shipped", 0.25), ("delivered", 0.55), ("cancelled", 0.05)]
PRODUCTS = [
    ("Wireless Headphones", "Electronics", "79.99"),
    ("USB-C Charging Cable", "Electronics", "12.99"),
    ("Laptop Stand", "Office", "45.50"),
    ("Mechanical Keyboard", "Electronics", "129.00"),
    ("Ergonomic Mouse", "Office", "34.99"),
    ("Coffee Mug Set", "Kitchen", "24.99"),
    ("Desk Lamp LED", "Office", "39.99"),
    ("Notebook Bundle", "Office", "18.50"),
    ("Water Bottle", "Sports", "15.99"),
    ("Yoga Mat", "Sports", "29.99"),
    ("Blender Pro", "Kitchen", "89.99"),
    ("Backpack 30L", "Sports", "59.99"),
]
STEPS = 1 << 32


def draw(row: Column, salt: str) -> Column:
    """A number in [0, 2^32), evenly spread over rows."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(salt), row.cast("string"))), 1, 8), 16, 10).cast("bigint")


def pick(row: Column, salt: str, n: int | Column) -> Column:
    """A number in [0, n)."""
    return F.pmod(draw(row, salt), F.lit(n) if isinstance(n, int) else n)


def _choose(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def numbers(spark: SparkSession, n: int) -> DataFrame:
    """Row numbers 0 to n - 1, as the input of the generators."""
    return spark.range(n).select(F.col("id").alias("n"))


def gen_customers(rows: DataFrame, now: Column) -> DataFrame:
    """One customer per row number ``n``, created within 30 days before ``now``."""
    n = F.col("n")
    first, last = _choose(FIRST_NAMES, pick(n, "first", len(FIRST_NAMES))), _choose(LAST_NAMES, pick(n, "last", len(LAST_NAMES)))
    named = rows.select(n, first.alias("first"), last.alias("last"))
    return named.select(
        (n + 1).alias("id"),
        F.concat_ws(" ", "first", "last").alias("name"),
        F.concat(F.lower("first"), F.lit("."), F.lower("last"), n.cast("string"), F.lit("@example.com")).alias("email"),
        _choose(CITIES, pick(n, "city", len(CITIES))).alias("city"),
        (now - F.make_dt_interval(hours=pick(n, "created", 30 * 24).cast("int"))).cast("timestamp_ntz").alias("created_at"),
    )


def gen_products(rows: DataFrame, now: Column) -> DataFrame:
    """One product per row number, from the templates in turn, created within 90 days."""
    n = F.col("n")
    template = F.get(
        F.array(*[
            F.struct(F.lit(a).alias("name"), F.lit(b).alias("category"), F.lit(c).cast("decimal(10,2)").alias("price"))
            for a, b, c in PRODUCTS
        ]),
        F.pmod(n, F.lit(len(PRODUCTS))).cast("int"),
    )
    return rows.select(n, template.alias("t")).select(
        (n + 1).alias("id"),
        "t.name", "t.category", "t.price",
        (now - F.make_dt_interval(hours=pick(n, "product", 90 * 24).cast("int"))).cast("timestamp_ntz").alias("created_at"),
    )


def gen_orders(rows: DataFrame, n_customers: int | Column, today: Column) -> DataFrame:
    """One order per row number: a customer, a day within 90 days, a weighted status."""
    n = F.col("n")
    roll, status, bound = draw(n, "status"), F.lit(STATUSES[-1][0]), 1.0
    for (name, _), (_, weight) in zip(STATUSES[-2::-1], STATUSES[:0:-1], strict=True):
        bound -= weight
        status = F.when(roll < int(round(bound, 6) * STEPS), F.lit(name)).otherwise(status)
    return rows.select(
        (n + 1).alias("id"),
        (pick(n, "customer", n_customers) + 1).alias("customer_id"),
        F.date_sub(today, pick(n, "day", 90).cast("int")).alias("order_date"),
        status.alias("status"),
        # 5.00 to 200.00; replaced once the order has items.
        ((pick(n, "total", 19501) + 500) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)").alias("total"),
    )


def gen_order_items(rows: DataFrame, n_orders: int | Column, n_products: int | Column) -> DataFrame:
    """One item per row number: an order, a product at its template price, 1 to 5 pieces."""
    n = F.col("n")
    prices = F.array(*[F.lit(p).cast("decimal(10,2)") for _, _, p in PRODUCTS])
    drawn = rows.select(n, pick(n, "item-order", n_orders).alias("o"), pick(n, "item-product", n_products).alias("p"))
    return drawn.select(
        (n + 1).alias("id"),
        (F.col("o") + 1).alias("order_id"),
        (F.col("p") + 1).alias("product_id"),
        (pick(n, "quantity", 5) + 1).cast("int").alias("quantity"),
        F.get(prices, F.pmod("p", F.lit(len(PRODUCTS))).cast("int")).alias("unit_price"),
    )


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Each order's total as the sum over its items; orders without items keep theirs."""
    sums = items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("_total")
    )
    joined = orders.join(sums, orders["id"] == sums["order_id"], "left")
    return joined.select(
        *[F.coalesce("_total", "total").alias("total") if c == "total" else orders[c] for c in orders.columns]
    )


def reset_tables(frames: dict[str, DataFrame], root: str) -> None:
    """Write the tables anew, replacing whatever they held."""
    for table, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{root}/{table}")
