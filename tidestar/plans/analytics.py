"""Reports over the star tables.

``star`` maps the four table names to frames. Sums and counts are taken per key
of the facts first and only then meet the dimensions: the joins then carry one
row per key, however many facts a key has, and repeated dimension versions
count exactly as they do in the plain join. Where facts must meet a dimension as
they are, both sides come straight from tables, and adaptive execution splits
the shuffle of a heavy key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestar.plans.star import row_counts
from tidestar.schemas import STAR_TABLES

Star = dict[str, DataFrame]
TOTAL = "decimal(22,2)"


def _spend(star: Star, *keys: str) -> DataFrame:
    """Facts and their amount per key."""
    return star["fact_orders"].groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount")
    )


def _current(star: Star, table: str, *columns: str) -> DataFrame:
    return star[table].where("is_current").select(*columns)


def q_row_counts(star: Star) -> DataFrame:
    return row_counts({table: star[table] for table in STAR_TABLES})


def _partners(star: Star) -> list[tuple[str, DataFrame]]:
    """The keys a fact must find, each with the rows it may find them in."""
    return [
        ("date_sk", star["dim_date"]),
        ("customer_key", star["dim_customer"].where("is_current")),
        ("product_key", star["dim_product"]),
    ]


def q_star_join_top20(star: Star, n: int = 20) -> DataFrame:
    """The largest facts with customer, product and date.

    Every fact that finds its partners gives at least one row, so the first
    ``n`` such facts hold the whole result, and only they are joined with the
    wide dimension columns. Dates and products are asked for first; then each
    customer keeps its ``n`` largest facts, a limit that every task applies
    before the shuffle, so that a customer of many facts is ``n`` rows per task
    when the customers are asked for.
    """
    order = [F.col("total_amount").desc(), F.col("order_sk"), F.col("quantity"), F.col("unit_price")]
    matched = star["fact_orders"]
    dates, customers, products = _partners(star)
    for key, rows in (dates, products):
        matched = matched.join(rows.select(key), key, "left_semi")
    best = Window.partitionBy("customer_key").orderBy(*order)
    matched = matched.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n).drop("_rank")
    matched = matched.join(customers[1].select(customers[0]), customers[0], "left_semi")

    # After each join the first n rows hold the result of the next one, and n rows are broadcast.
    top = matched.orderBy(*order).limit(n)
    for (key, rows), columns in zip(
        _partners(star), (["full_date", "day_of_week"], ["name", "email", "city"], ["product_name", "category"]), strict=True,
    ):
        order += [F.col(c) for c in columns]
        top = F.broadcast(top).join(rows.select(key, *columns), key).orderBy(*order).limit(n)
    return top.select(
        F.col("name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("city").alias("customer_city"),
        "product_name",
        F.col("category").alias("product_category"),
        F.col("full_date").alias("order_date"),
        F.col("day_of_week").alias("order_day"),
        "quantity", "unit_price", "total_amount", "order_status",
    )


def q_top_customers(star: Star, n: int = 10) -> DataFrame:
    return top_customers(_spend(star, "customer_key"), star, n)


def top_customers(spend: DataFrame, star: Star, n: int = 10) -> DataFrame:
    """From facts and amount by customer: (customer_key, n, amount)."""
    customers = _current(star, "dim_customer", "customer_key", "customer_id", "name", "email")
    spent = spend.join(customers, "customer_key").groupBy("customer_id", "name", "email").agg(
        F.sum("n").alias("order_count"), F.sum("amount").alias("_spent")
    )
    return spent.orderBy(F.col("_spent").desc(), "customer_id").limit(n).select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email",
        "order_count",
        F.col("_spent").cast(TOTAL).alias("total_spent"),
        F.round(F.col("_spent").cast(TOTAL) / F.col("order_count"), 2).cast("decimal(12,2)").alias("avg_order_value"),
    )


def q_top_products(star: Star, n: int = 10) -> DataFrame:
    products = _current(star, "dim_product", "product_key", "product_id", "product_name", "category")
    sold = _spend(star, "product_key").join(products, "product_key").groupBy("product_id", "product_name", "category").agg(
        F.sum("n").alias("units_sold"), F.sum("amount").cast(TOTAL).alias("total_revenue")
    )
    return sold.orderBy(F.col("total_revenue").desc(), "product_id").limit(n)


def q_daily_sales(star: Star) -> DataFrame:
    return daily_sales(_spend(star, "date_sk"), star)


def daily_sales(spend: DataFrame, star: Star) -> DataFrame:
    """From facts and amount by day: (date_sk, n, amount)."""
    days = star["dim_date"].select("date_sk", "full_date", "day_of_week")
    return spend.join(days, "date_sk").groupBy("full_date", "day_of_week").agg(
        F.sum("n").alias("order_count"), F.sum("amount").cast(TOTAL).alias("daily_revenue")
    ).orderBy("full_date", "day_of_week")


def q_quarter_category(star: Star) -> DataFrame:
    """Sales by quarter and category: per quarter and product first, then per category."""
    quarters = star["dim_date"].select("date_sk", "year", "quarter")
    per_product = star["fact_orders"].join(quarters, "date_sk").groupBy("year", "quarter", "product_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount")
    )
    return quarter_category(per_product, star)


def quarter_category(per_product: DataFrame, star: Star) -> DataFrame:
    """From facts and amount by quarter and product: (year, quarter, product_key, n, amount)."""
    products = _current(star, "dim_product", "product_key", "category")
    return per_product.join(products, "product_key").groupBy("year", "quarter", "category").agg(
        F.sum("n").alias("transactions"), F.sum("amount").cast(TOTAL).alias("category_revenue")
    ).orderBy("year", "quarter", F.col("category_revenue").desc(), "category")


def q_category_totals(star: Star) -> DataFrame:
    """Spend by customer name and category.

    Facts take their category first and are summed per customer and category,
    so the join with customers sees few rows per customer.
    """
    facts = star["fact_orders"].select(
        "customer_key", "product_key", (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("amount")
    )
    return category_totals(facts, star)


def category_totals(facts: DataFrame, star: Star) -> DataFrame:
    """From amounts of facts, or sums of them: (customer_key, product_key, amount)."""
    products = _current(star, "dim_product", "product_key", "category")
    customers = _current(star, "dim_customer", "customer_key", "name")
    per_customer = facts.join(products, "product_key").groupBy("customer_key", "category").agg(
        F.sum("amount").alias("amount")
    )
    return per_customer.join(customers, "customer_key").groupBy("name", "category").agg(
        F.sum("amount").cast(TOTAL).alias("total")
    ).orderBy(F.col("total").desc(), "name", "category")


def q_top5_spend(star: Star, n: int = 5) -> DataFrame:
    customers = _current(star, "dim_customer", "customer_key", "name")
    return _spend(star, "customer_key").join(customers, "customer_key").groupBy("name").agg(
        F.sum("n").alias("orders"), F.sum("amount").cast(TOTAL).alias("spent")
    ).orderBy(F.col("spent").desc(), "name").limit(n)


def q_first_customer_history(star: Star) -> DataFrame:
    """All orders of the current customer with the lowest id."""
    first = F.broadcast(  # one row
        _current(star, "dim_customer", "customer_key", "customer_id", "name").orderBy("customer_id").limit(1)
    )
    products = star["dim_product"].select("product_key", "product_name")
    days = star["dim_date"].select("date_sk", "full_date")
    own = star["fact_orders"].join(first, "customer_key")
    return own.join(products, "product_key").join(days, "date_sk").orderBy(
        "full_date", "product_name", "quantity", "total_amount"
    ).select(
        F.col("name").alias("customer_name"), "customer_id", "product_name", F.col("full_date").alias("order_date"),
        "quantity", "total_amount", "order_status",
    )
