"""Written intermediate tables, checked broadcasts and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.session import scratch_dir

# A frame of at most so many rows of fixed width is broadcast (some 32 MB as a hash table); a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once for each application, as ``--py-files`` would."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "tidestar_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", codec).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it is proven small, else as it is, so that Spark shuffles.

    Counts the frame: give it one that is written.
    """
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def running_sums(numbers: Column) -> Column:
    """Running sums of an array of int. Appending copies an array, so sums are made in stretches of about the root of its size, then shifted."""

    def sums(of: Column, first: Column) -> Column:
        return F.aggregate(of, first, lambda a, x: F.array_append(a, F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + x))

    def whole(n: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(n))).cast("int"))
        last = F.floor((F.size(n) - 1) / width).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: sums(F.slice(n, k * width + 1, width), F.array().cast("array<int>")))
        shifted = lambda p: let(
            sums(F.transform(p, lambda x: F.get(x, F.size(x) - 1)), F.array(F.lit(0))),
            lambda before: F.flatten(F.transform(p, lambda x, k: F.transform(x, lambda v: v + F.get(before, k)))),
        )
        return F.when(F.size(n) > 0, let(parts, shifted)).otherwise(F.array().cast("array<int>"))

    return let(numbers, whole)


def held_out(doc_id: Column) -> Column:
    """True for the fixed quarter of the ids that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fixed_bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column, each value ``width`` bytes long, as a matrix of bytes."""
    column = column.cast(pa.binary())
    _, at, raw = column.buffers()
    if not len(column):
        return np.zeros((0, width), np.uint8)
    first = int(np.frombuffer(at, np.int32)[column.offset])
    return np.frombuffer(raw, np.uint8)[first : first + len(column) * width].reshape(-1, width)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: a row (id, component) for each id in a link.

    The component is its smallest id. Each round takes the smallest label among
    the neighbours and then the label of the label, so that long chains halve;
    ``rounds`` grow with the logarithm of a chain.
    """
    one = links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = written(one.union(one.select("dst", "src")).where("src is not null and dst is not null").distinct(), "links")
    label = written(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.first("src")).alias("component")), "label")
    while True:
        seen = both.join(label, both["dst"] == label["id"]).groupBy(F.col("src").alias("id")).agg(F.min("component").alias("near"))
        own = label.join(seen, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = label.select(F.col("id").alias("new"), F.col("component").alias("further"))
        after = written(own.join(jump, "new").select("id", "old", F.least("new", "further").alias("component")), "label")
        if after.where("old <> component").isEmpty():
            return after.select("id", "component")
        label = after.select("id", "component")
