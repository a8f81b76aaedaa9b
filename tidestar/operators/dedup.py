"""One winning change per primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestar.functions.convert import epoch_micros
from tidestar.functions.keys import op_priority


def has_null_timestamps(feed: DataFrame, ts_col: str = "Timestamp") -> bool:
    """Whether any change has no time.

    On Parquet this is answered from row-group statistics where the column has
    no nulls, so it reads next to nothing.
    """
    return not feed.where(F.col(ts_col).isNull()).isEmpty()


def dedup_changes(
    feed: DataFrame,
    key: str = "id",
    *,
    seq: Sequence[str],
    ts_col: str = "Timestamp",
    op_col: str = "Op",
    null_timestamps: bool = True,
    even: bool = False,
) -> DataFrame:
    """Keep one change per key; rows without a key are dropped.

    The highest operation rank wins (D, U, I, other), then the newest time,
    then the first arrived, where ``seq`` gives the order of arrival. A change
    with no time cannot be compared: if it is the first arrived of the highest
    rank, no later change of that rank replaces it.

    Both plans reduce every map task to at most one or two rows per key before
    the shuffle, so a key that holds a third of the feed is no hot spot. This takes
    a sort of all that a map task reads. Where no key is heavy, which ``even`` says,
    the plan for changes with a time sorts behind the shuffle only.
    """
    if op_col not in feed.columns:
        feed = feed.withColumn(op_col, F.lit(None).cast("string"))
    feed = feed.where(F.col(key).isNotNull())
    rank = op_priority(F.col(op_col))
    arrival = [F.col(c) for c in seq]

    if not null_timestamps:
        # row_number() = 1 lets Spark cut each key to one row before and after the shuffle; with the shuffle below it, after it only.
        if even:
            feed = feed.repartition(F.col(key))
        order = Window.partitionBy(key).orderBy(rank.desc(), F.col(ts_col).desc_nulls_last(), *[c.asc() for c in arrival])
        return feed.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")

    others = [c for c in feed.columns if c != key]
    row = F.struct(*others)
    low = (-rank).alias("_rank")
    age = F.coalesce(-epoch_micros(F.col(ts_col), feed.schema[ts_col].dataType), F.lit(2**63 - 1)).alias("_age")
    timeless = F.when(F.col(ts_col).isNull(), row)
    winners = feed.groupBy(key).agg(
        F.min_by(timeless, F.struct(low, *arrival)).alias("_pinned"),
        F.min_by(row, F.struct(low, age, *arrival)).alias("_best"),
    )
    return (
        winners.select(key, F.coalesce("_pinned", "_best").alias("_row"))
        .select(key, "_row.*")
        .select(*feed.columns)
    )
