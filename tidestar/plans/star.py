"""A batch of changes as the four star tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.operators import (
    SkewPolicy,
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_fact_orders,
    dedup_changes,
    heavy_keys,
)
from tidestar.schemas import ID, SOURCE_TABLES, empty_frame, feed_schema


@dataclass(frozen=True)
class StarBatch:
    """The star tables of one batch, each a lazy frame."""

    customers: DataFrame
    products: DataFrame
    dates: DataFrame
    facts: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_customer": self.customers,
            "dim_product": self.products,
            "dim_date": self.dates,
            "fact_orders": self.facts,
        }

    def summary(self) -> DataFrame:
        """Rows of each table."""
        return row_counts(self.tables())

    def total_rows(self) -> DataFrame:
        return self.summary().agg(F.sum("row_count").alias("total_rows"))

    def is_empty(self) -> bool:
        return all(frame.isEmpty() for frame in self.tables().values())


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in frames.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionAll(frame)
    return result


def empty_feed(spark: SparkSession, table: str, id_type: T.DataType = ID) -> DataFrame:
    return empty_frame(spark, feed_schema(table, id_type))


def dedup_feeds(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    arrival: dict[str, tuple[str, ...]],
    *,
    id_type: T.DataType = ID,
    null_timestamps: bool | Collection[str] = True,
    skew: SkewPolicy = SkewPolicy(),
) -> dict[str, DataFrame]:
    """Winning changes of the four source tables; a missing feed counts as empty.

    ``null_timestamps`` may name the tables whose changes can lack a time. The
    ids of the others are looked through for ones that are heavy by ``skew``.
    """
    timeless = null_timestamps
    if isinstance(null_timestamps, bool):
        timeless = SOURCE_TABLES if null_timestamps else ()
    timed = {table: feeds[table].select(F.col("id").alias(table)) for table in SOURCE_TABLES if feeds.get(table) is not None and table not in timeless}
    heavy = heavy_keys(timed, skew) if timed else {}
    winners = {}
    for table in SOURCE_TABLES:
        feed = feeds.get(table)
        if feed is None:
            winners[table] = empty_feed(spark, table, id_type)
        else:
            winners[table] = dedup_changes(feed, seq=arrival[table], null_timestamps=table in timeless, even=table not in heavy)
    return winners


def heavy_sources(feeds: dict[str, DataFrame]) -> dict[str, DataFrame] | None:
    """The feeds whose keys may be heavy, where both are there."""
    return feeds if {"orders", "order_items"} <= feeds.keys() else None


def transform_star(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    arrival: dict[str, tuple[str, ...]],
    batch_ts: Column,
    *,
    id_type: T.DataType = ID,
    null_timestamps: bool | Collection[str] = True,
    drop_deleted: bool = False,
    skew: SkewPolicy = SkewPolicy(),
) -> StarBatch:
    """The whole batch as lazy star tables, keys looked up within the batch.

    The frames share their inputs but not their work: each reads only the
    columns it needs of the feeds, so nothing has to be kept in between.
    """
    won = dedup_feeds(spark, feeds, arrival, id_type=id_type, null_timestamps=null_timestamps, skew=skew)
    customers = build_dim_customer(won["customers"], batch_ts, id_type)
    products = build_dim_product(won["products"], batch_ts, id_type)
    facts = build_fact_orders(
        won["orders"], won["order_items"], customers, products,
        id_type=id_type, drop_deleted=drop_deleted, skew=skew, raw=heavy_sources(feeds),
    )
    return StarBatch(customers, products, build_dim_date(won["orders"]), facts)


def gather_by(rows: DataFrame, folder: str) -> DataFrame:
    """Bring the rows of a partition folder together before they are written.

    A folder then gets few files. Spark sizes the tasks: it splits a folder that
    is large and joins small ones.
    """
    return rows.hint("rebalance", F.col(folder))
