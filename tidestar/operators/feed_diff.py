"""A change feed from two states of a table.

Where most of a table stays as it is, digests tell which rows have to be looked
at: rows fall into buckets by a hash of their key, a bucket's digest sums up the
hashes of its rows, and the digests of ``FANOUT`` buckets are summed up again.
Only buckets below a changed sum are compared, and only the rows of changed
buckets are shuffled and joined. Digests of the earlier state can be kept, so
that it is read for its changed buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.session import checkpoint_root


def snapshot_diff(before: DataFrame | None, after: DataFrame, at: Column, key: str = "id") -> DataFrame:
    """Inserts, updates and deletes that lead from ``before`` to ``after``.

    Without ``before`` it is the first full load. Both states hold each key
    once, so the join has no heavy key. A delete carries the last known row.
    """
    columns = after.columns
    stamp = at.cast("timestamp_ntz").alias("Timestamp")
    if before is None:
        return after.select(F.lit("I").alias("Op"), *columns, stamp)
    old, new = before.select(*columns).alias("o"), after.alias("n")
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    op = (
        F.when(F.col(f"o.{key}").isNull(), "I")
        .when(F.col(f"n.{key}").isNull(), "D")
        .when(~same, "U")
    )
    gone = F.col(f"n.{key}").isNull()
    return (
        old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
        .select(op.alias("Op"), *[F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in columns], stamp)
        .where("Op IS NOT NULL")
    )


BUCKETS = 4096
FANOUT = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def digests(rows: DataFrame, key: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """Digest of each bucket that has rows: bucket, n, low, high, mixed. One scan; each task leaves a row for each bucket."""
    # A hash skips nulls, so it is told apart which columns are null.
    columns = sorted(rows.columns)
    row = F.xxhash64(*[c for name in columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())])
    hashed = rows.select(_bucket(key, buckets).alias("bucket"), row.alias("h"))
    # Sums of halves don't overflow.
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.bit_xor("h").alias("mixed"),
    )


_DIGEST = ("n", "low", "high", "mixed")


def _differing(old: DataFrame, new: DataFrame, on: str) -> DataFrame:
    same = F.lit(True)
    for name in _DIGEST:
        same = same & F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    pairs = old.alias("o").join(new.alias("n"), F.col(f"o.{on}") == F.col(f"n.{on}"), "full")
    return pairs.where(~same).select(F.coalesce(f"o.{on}", f"n.{on}").alias(on))


def changed_buckets(old: DataFrame, new: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Buckets whose digests differ. Buckets are looked at where the sum over their group of ``fanout`` differs."""
    group = F.floor(F.col("bucket") / fanout).cast("int").alias("group")

    def summed(frame: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("n", "low", "high")]
        return frame.groupBy(group).agg(*sums, F.bit_xor("mixed").alias("mixed"))

    groups = _differing(summed(old), summed(new), "group")
    below = lambda frame: frame.withColumn("group", group).join(groups, "group", "left_semi").drop("group")
    return _differing(below(old), below(new), "bucket")


def snapshot_diff_by_digest(
    before: DataFrame, after: DataFrame, at: Column, key: str = "id", *, old: DataFrame | None = None, new: DataFrame | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """The same changes as :func:`snapshot_diff`, at the cost of the buckets that changed.

    ``old`` and ``new`` are digests with ``buckets`` buckets, made here where they are not given.
    Rows that differ with equal digests would be missed; four equal sums of 64-bit hashes make that
    a matter of chance below 1e-19 for each changed bucket.
    """
    before = before.select(*after.columns)
    old = digests(before, key, buckets) if old is None else old
    new = digests(after, key, buckets) if new is None else new
    checkpoint_root(after.sparkSession)
    # At most ``buckets`` numbers; both sides take the same ones.
    changed = F.broadcast(changed_buckets(old, new).checkpoint())
    cut = lambda rows: rows.withColumn("_bucket", _bucket(key, buckets)).join(changed, F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")
    return snapshot_diff(cut(before), cut(after), at, key)
