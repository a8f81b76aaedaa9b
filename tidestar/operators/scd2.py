"""Version history of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestar.functions.convert import epoch_micros
from tidestar.functions.keys import op_priority
from tidestar.operators.dimensions import Dimension
from tidestar.operators.skew import SkewPolicy, heavy_keys


def _struct(dim: Dimension, side: str, **replaced: Column) -> Column:
    """A dimension row taken from one side of the join."""
    return F.struct(*[replaced.get(c, F.col(f"{side}.{c}")).alias(c) for c in dim.columns])


def _events(dim: Dimension, batch_ts: Column) -> Column:
    """What becomes of a pair of current row ``c`` and change row ``b``.

    New id: the change row. Deleted: the old row closed. Changed: the old row
    closed and the change row. Unchanged, or not in the batch: the old row.
    """
    now = batch_ts.cast("timestamp_ntz")
    closed = _struct(dim, "c", effective_end_date=now, is_current=F.lit(False))
    old, new = _struct(dim, "c"), _struct(dim, "b")
    same = F.lit(True)
    for name in dim.attributes:
        same = same & F.col(f"c.{name}").eqNullSafe(F.col(f"b.{name}"))

    def tagged(*pairs: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(tag).alias("event"), row.alias("row")) for tag, row in pairs])

    return (
        F.when(F.col(f"b.{dim.natural_id}").isNull(), tagged(("keep", old)))
        .when(F.col(f"c.{dim.natural_id}").isNull(), tagged(("open", new)))
        .when(~F.col("b.is_current"), tagged(("close", closed)))
        .when(same, tagged(("keep", old)))
        .otherwise(tagged(("close", closed), ("open", new)))
    )


def _pair(current: DataFrame, batch: DataFrame, dim: Dimension, how: str) -> DataFrame:
    # Both sides hold each id once, so no key of this join can be heavy.
    on = F.col(f"b.{dim.natural_id}") == F.col(f"c.{dim.natural_id}")
    return batch.alias("b").join(current.alias("c"), on, how)


def scd2_changes(current: DataFrame, batch: DataFrame, dim: Dimension, batch_ts: Column) -> DataFrame:
    """Rows that a batch closes and opens, with ``event`` close or open.

    ``current`` may be cut down to the ids of the batch: the result, and the
    work after the join, grow with the batch and not with the dimension. Further
    columns of ``current`` (such as the batch a version was opened in) are kept.
    """
    extra = [c for c in current.columns if c not in dim.columns]
    pairs = _pair(current, batch, dim, "left")
    rows = pairs.select(
        *[F.col(f"c.{c}").alias(c) for c in extra], F.explode(_events(dim, batch_ts)).alias("_e"),
    )
    return rows.select("_e.event", "_e.row.*", *extra).where("event <> 'keep'")


def scd2_merge(existing: DataFrame, batch: DataFrame, dim: Dimension, batch_ts: Column) -> DataFrame:
    """The whole dimension after a batch: history untouched, current rows merged."""
    current = existing.where("is_current")
    history = existing.where("NOT is_current").select(*dim.columns)
    pairs = _pair(current, batch, dim, "full")
    merged = pairs.select(F.explode(_events(dim, batch_ts)).alias("_e")).select("_e.row.*")
    return history.unionByName(merged)


def scd2_append(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Append the batch's rows as they are; nothing is closed."""
    return existing.unionByName(batch)


def scd2_history(
    feed: DataFrame,
    key: str = "id",
    *,
    seq: Sequence[str],
    ts_col: str = "Timestamp",
    skew: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Every version of every key, with the time it began and ended.

    Of several changes at one instant only the winner is a version. A version
    ends when the next one begins; a delete is a version that ends at once.

    Without heavy keys both steps share one shuffle by key. A heavy key does not
    come into one task: changes of one instant are reduced before they are
    shuffled, and the look at the next version covers one bucket of its time
    only. The key's number of rows tells the width of its buckets; the first
    instant of its next bucket is taken from a small frame, which holds a row
    for each bucket that has one.
    """
    changes = feed.where(F.col(key).isNotNull() & F.col(ts_col).isNotNull())
    best = Window.partitionBy(key, ts_col).orderBy(op_priority(F.col("Op")).desc(), *[F.col(c).asc() for c in seq])

    def winners(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")

    found = heavy_keys({key: changes}, skew).get(key)
    if found is None:
        after = F.lead(ts_col).over(Window.partitionBy(key).orderBy(ts_col))
        chained = winners(changes.repartition(F.col(key))).withColumn("_next", after)
        return chained.select(*_validity_of(feed, ts_col, F.col("_next")))

    micros = epoch_micros(F.col(ts_col), feed.schema[ts_col].dataType)
    spans = changes.join(found, key).groupBy(key, "_parts").agg(F.min(micros).alias("_from"), F.max(micros).alias("_to"))
    # Four buckets to a part, since changes are not even in time.
    heavy = spans.select(key, "_from", F.greatest(F.lit(1), F.ceil((F.col("_to") - F.col("_from") + 1) / (F.col("_parts") * 4))).alias("_width")).checkpoint()
    slot = F.floor((micros - F.col("_from")) / F.col("_width"))

    firsts = changes.select(key, ts_col).join(heavy, key).groupBy(key, slot.alias("_slot")).agg(
        F.min(ts_col).alias("_first")
    )
    following = firsts.select(
        key, "_slot", F.lead("_first").over(Window.partitionBy(key).orderBy("_slot")).alias("_following")
    )
    placed = winners(changes).join(heavy, key, "left").withColumn(
        "_slot", F.coalesce(slot, F.lit(0)).cast("bigint")
    )
    within = Window.partitionBy(key, "_slot").orderBy(ts_col)
    chained = placed.withColumn("_next", F.lead(ts_col).over(within)).join(following, [key, "_slot"], "left")
    return chained.select(*_validity_of(feed, ts_col, F.coalesce("_next", "_following")))


def _validity_of(feed: DataFrame, ts_col: str, following: Column) -> list[Column]:
    """The feed's columns, and when the version began and ended."""
    deleted = F.coalesce(F.col("Op") == "D", F.lit(False))
    ends = F.when(deleted, F.col(ts_col)).otherwise(following)
    return [
        *[F.col(c) for c in feed.columns],
        F.col(ts_col).alias("effective_start_date"),
        ends.alias("effective_end_date"),
        (ends.isNull() & ~deleted).alias("is_current"),
    ]


def dim_date_upsert(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Dates of the batch that the dimension does not hold yet."""
    return batch.join(existing.select("date_sk"), "date_sk", "left_anti").select(*batch.columns)
