"""Checks of the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.plans.analytics import Star


def _orphans(star: Star, dim: str, key: str, name: str) -> DataFrame:
    """Facts whose key the dimension does not hold.

    Facts are counted per key before the anti-join, so a heavy key is one row.
    A null key finds no partner and counts.
    """
    per_key = star["fact_orders"].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(star[dim].select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(name)
    )


def q_orphan_customers(star: Star) -> DataFrame:
    return _orphans(star, "dim_customer", "customer_key", "orphan_customer_facts")


def q_orphan_products(star: Star) -> DataFrame:
    return _orphans(star, "dim_product", "product_key", "orphan_product_facts")


def q_orphan_dates(star: Star) -> DataFrame:
    return _orphans(star, "dim_date", "date_sk", "orphan_date_facts")


def q_scd2_versions(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("version_count"),
        F.count_if(F.col("is_current")).alias("current_rows"),
        F.count_if(~F.col("is_current")).alias("historical_rows"),
    ).where("version_count > 1").orderBy(F.col("version_count").desc(), "customer_id")


def q_mismatched_totals(facts: DataFrame) -> DataFrame:
    gap = F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price"))
    return facts.where(F.col("total_amount").isNotNull() & (gap > 0.01)).agg(
        F.count(F.lit(1)).alias("mismatched_totals")
    )


def q_duplicate_active(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.where("is_current").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_rows")
    ).where("active_rows > 1")
