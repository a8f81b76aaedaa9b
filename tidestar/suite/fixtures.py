"""Tables the registered queries share, made once per session and data folder.

All are written below the shared checkpoint folder and read back, as the gold
tables of a deployment would be.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.plans import catalog
from tidestar.plans.star import StarBatch, transform_star
from tidestar.plans.warehouse import MONTH, Warehouse
from tidestar.schemas import SOURCE_TABLES, STAR_TABLES, WIDE_ID, star_schema
from tidestar.session import scratch_dir
from tidestar.sources import sample_feed as sf
from tidestar.sources.files import RAW_PREFIX

T_ = TypeVar("T_")
_made: dict[tuple[str, str, str], object] = {}

# Time of the one-batch star, and a time between batches 1 and 2.
BATCH_AT = "2024-03-02 00:00:00"
BETWEEN = "2024-02-15 00:00:00"

def once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], T_]) -> T_:
    slot = (spark.sparkContext.applicationId, sf_dir, label)
    if slot not in _made:
        _made[slot] = make()
    return _made[slot]  # type: ignore[return-value]


def new_warehouse(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    return Warehouse(
        spark, scratch_dir(spark, label), id_type=WIDE_ID, fact_unit=MONTH,
    )


def literal_star(spark: SparkSession, sf_dir: str) -> StarBatch:
    """The whole feed as one batch. The sample feeds have no missing times."""
    return transform_star(
        spark, sf.sample_feed(spark, sf_dir), sf.ARRIVAL, sf.at(BATCH_AT),
        id_type=WIDE_ID, null_timestamps=False,
    )


def gold_root(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the one-batch star."""

    def write() -> str:
        root = scratch_dir(spark, "gold")
        for table, frame in literal_star(spark, sf_dir).tables().items():
            frame.write.parquet(f"{root}/{table}")
        return root

    return once(spark, sf_dir, "gold", write)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The one-batch star as written tables."""
    root = gold_root(spark, sf_dir)
    return {t: spark.read.schema(star_schema(t, WIDE_ID)).parquet(f"{root}/{t}") for t in STAR_TABLES}


def batches(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """The feed as three batches: inserts, updates, deletes.

    Items come in three parts by return flag; orders come with each part.
    """
    customers, products = sf.customers_feed(spark, sf_dir), sf.products_feed(spark, sf_dir)
    return [
        {
            "customers": customers.where(F.col("Op") == op),
            "products": products.where(F.col("Op") == op),
            "orders": sf.orders_feed(spark, sf_dir),
            "order_items": sf.order_items_feed(spark, sf_dir, flag),
        }
        for op, flag in (("I", "A"), ("U", "N"), ("D", "R"))
    ]


def versioned(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse after the three batches."""

    def write() -> Warehouse:
        warehouse = new_warehouse(spark, sf_dir, "versions")
        warehouse.create_tables()
        times = (sf.INSERTED_AT, sf.UPDATED_AT, sf.DELETED_AT)
        for batch_id, (feeds, when) in enumerate(zip(batches(spark, sf_dir), times, strict=True)):
            warehouse.write_batch(feeds, sf.ARRIVAL, batch_id, sf.at(when), null_timestamps=False)
        return warehouse

    return once(spark, sf_dir, "versions", write)


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The feeds as change files, some gzip, some snappy."""

    def write() -> str:
        root = scratch_dir(spark, "landing")
        for table, feed in sf.sample_feed(spark, sf_dir).items():
            codec = "gzip" if table in ("customers", "orders") else "snappy"
            feed.write.option("compression", codec).parquet(f"{root}/{RAW_PREFIX}/public/{table}")
        return root

    return once(spark, sf_dir, "landing", write)


def broken_landing(spark: SparkSession, sf_dir: str) -> str:
    """The change files of all feeds, each table with one file that is not Parquet."""

    def write() -> str:
        root = scratch_dir(spark, "broken")
        feeds = sf.sample_feed(spark, sf_dir)
        for table in SOURCE_TABLES:
            folder = f"{root}/{RAW_PREFIX}/public/{table}"
            feeds[table].write.parquet(folder)
            lines = sf.read(spark, sf_dir, "region").select("r_name").coalesce(1)  # five rows
            lines.write.mode("append").text(folder)
        return root

    return once(spark, sf_dir, "broken", write)


# Bytes of a row group and of a block that is read at a time, for files of which one place is damaged.
SMALL_GROUP, SMALL_BLOCK = 32_000, 12_000


def damaged_file(spark: SparkSession, sf_dir: str) -> str:
    """The orders in one file of small row groups, with some bytes after its first quarter that no writer wrote."""

    def write() -> str:
        root = scratch_dir(spark, "damaged")
        rows = sf.orders_feed(spark, sf_dir).coalesce(1)
        rows.write.option("parquet.block.size", SMALL_GROUP).option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{root}/good")
        hadoop = spark._jvm.org.apache.hadoop
        files = hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        good = next(s for s in files.listStatus(hadoop.fs.Path(f"{root}/good")) if s.getPath().getName().endswith(".parquet"))
        bad = f"{root}/bad/part-0.parquet"
        wrong, first = b"?" * 64, good.getLen() // 4
        source, target = files.open(good.getPath()), files.create(hadoop.fs.Path(bad))
        copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
        copy(source, target, 0, first)
        target.write(wrong)
        copy(source, target, len(wrong), good.getLen() - first - len(wrong))
        source.close()
        target.close()
        return bad

    return once(spark, sf_dir, "damaged", write)


def catalog_database(spark: SparkSession, sf_dir: str) -> str:
    """The one-batch star as tables of a database, facts partitioned by day."""

    def write() -> str:
        root = scratch_dir(spark, "catalog")
        database = "tidestar_" + root[-12:]
        catalog.ensure_database(spark, database, f"{root}/{database}")
        for _ in range(2):  # the second call finds everything in place
            catalog.create_star_tables(spark, database, root, id_type=WIDE_ID)
        catalog.append_star_tables(spark, database, gold(spark, sf_dir))
        return database

    return once(spark, sf_dir, "catalog", write)


def source_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(zip(SOURCE_TABLES, (sf.read(spark, sf_dir, t) for t in ("customer", "part", "orders", "lineitem")), strict=True))
