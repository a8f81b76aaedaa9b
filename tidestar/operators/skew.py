"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.session import checkpoint_root


@dataclass(frozen=True)
class SkewPolicy:
    """``rows``: a key with more rows than this is heavy, and is spread over as many tasks as leave about so many rows to each."""

    rows: int = 1_000_000


# A key at the bound is expected so many times in the sample; one that is seen at least a quarter as often is counted.
# The chance that a key at the bound is missed is that of a Poisson variable of mean 100 under 25, some 1e-19.
EXPECTED = 100
SEED = 7


def heavy_keys(counted: dict[str, DataFrame], policy: SkewPolicy) -> dict[str, DataFrame]:
    """Of several columns, each with the frame to count it in, the heavy keys: (key, parts), only for columns that have one.

    A frame of at most ``policy.rows`` rows has none, which Parquet footers tell.
    In others a sample names the candidates, and only those are counted
    exactly: no shuffle takes all keys. There are at most some rows * 4 / ``policy.rows``
    candidates. Both sides of a join must agree on the keys, so they are checkpointed.
    A heavy key that the sample misses makes a large task and no wrong row.
    """
    frames = list({id(frame): frame for frame in counted.values()}.values())
    sizes = dict(zip(map(id, frames), _counts(frames), strict=True))
    large = {name: frame.select(F.col(f"`{name}`")) for name, frame in counted.items() if sizes[id(frame)] > policy.rows}
    if not large:
        return {}
    checkpoint_root(frames[0].sparkSession)
    kinds = {name: frame.schema[name].dataType for name, frame in large.items()}
    rate = min(1.0, EXPECTED / policy.rows)

    def named(take: Callable[[DataFrame], DataFrame]) -> DataFrame:
        keys = [take(frame).select(F.lit(name).alias("_of"), F.col(f"`{name}`").cast("string").alias("_key")) for name, frame in large.items()]
        return reduce(DataFrame.unionAll, keys).where("_key IS NOT NULL")

    sampled = named(lambda frame: frame.sample(rate, SEED) if rate < 1 else frame)
    seen = sampled.groupBy("_of", "_key").agg(F.count(F.lit(1)).alias("_n"))
    candidates = seen.where(F.col("_n") >= F.lit(rate * policy.rows / 4)).select("_of", "_key").checkpoint()
    if candidates.isEmpty():
        return {}
    # Left to Spark's size check; a broadcast of the candidates leaves their rows only to the count.
    exact = named(lambda frame: frame).join(candidates, ["_of", "_key"]).groupBy("_of", "_key").agg(F.count(F.lit(1)).alias("_n"))
    found = exact.where(F.col("_n") > policy.rows).select("_of", "_key", F.ceil(F.col("_n") / policy.rows).cast("int").alias("_parts")).checkpoint()
    present = {row["_of"] for row in found.select("_of").distinct().collect()}  # at most one row for each column
    return {
        name: found.where(F.col("_of") == name).select(F.col("_key").cast(kinds[name]).alias(name), "_parts") for name in large if name in present
    }


def _counts(frames: list[DataFrame]) -> list[int]:
    """Rows of each frame, in one job."""
    counts = [frame.select(F.lit(i).alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")) for i, frame in enumerate(frames)]
    told = {row["i"]: row["n"] for row in reduce(DataFrame.unionAll, counts).collect()}  # a row for each frame
    return [told.get(i, 0) for i in range(len(frames))]


def keyed_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", *, heavy: DataFrame | None = None) -> DataFrame:
    """Join ``left`` with ``right`` on one shared key column.

    The right side must hold few rows per key (a dimension, an index); the
    left side may hold any number. ``how`` is inner, left, left_semi or
    left_anti. Without heavy keys (:func:`heavy_keys`) this is the plain join.
    Rows of a heavy left key get one of its ``_parts`` numbers and the matching
    right rows are repeated for each number, so that every left row still meets
    each right row exactly once. The number is a hash of the whole left row: a
    retried task finds the same one, and rows spread well where they are distinct.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if heavy is None:
        return left.join(right, key, how)

    # At most rows / policy.rows keys: a millionth of the rows by default. Left to Spark's size check.
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.col("_parts")).cast("int")
    salted_left = left.join(heavy, key, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_parts")
    numbers = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    salted_right = right.join(heavy, key, "left").withColumn("_salt", F.explode(numbers)).drop("_parts")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
