"""Star tables in a folder, with batches, versions and history.

Every row lies in the folder of the batch that wrote it (``_batch_id=n``), and
``commits`` tells which batches are complete. Its rows are written last, so the
four tables of a batch appear together or not at all, and writing a batch again
replaces its folders and changes nothing else.

A delete marks rows instead of looking for them at every read: ``fact_vectors``
holds for each file of facts bitmaps of the row positions that are gone, one for
each 32,768 rows of a file that has any. A read tests the bits of the files
that have some. :meth:`Warehouse.compact_facts` writes the facts of all batches so far anew, without
deleted rows, in a few files along a space-filling curve over date and customer;
readers of that version and later ones take these files, readers of earlier
versions the old folders, which stay.

What a batch writes is measured while it is written (``batch_metrics``), without
another scan. With ``limits`` a batch that is above one of them is not committed:
its folders stay unseen, ``quarantined`` tells which limit it was, and the same
batch id can be written again.

Dimensions are logs: a batch appends the versions it opens and, for versions it
closes, their final form. A batch writes as much as it changes; it reads the
ids of the whole log, and the other columns of the ids it needs.

An item and its order need not come in the same batch. The orders that won are
kept as a log too, and items that found no partner wait in ``pending_items``
with the reason, a log as well: a batch notes the items that begin to wait, wait
for another reason, or wait no more. Waiting items are judged again only if the
batch has a change of their order, customer or product; a waiting item that finds
its partners becomes a fact once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.convert import to_int_safe
from tidestar.operators import (
    CUSTOMER,
    PRODUCT,
    Dimension,
    SkewPolicy,
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    dim_date_upsert,
    facts_of,
    judged_items,
    scd2_changes,
    schema_mismatches,
    with_totals,
)
from tidestar.functions.convert import to_decimal_safe, to_string_safe, to_timestamp_safe
from tidestar.plans.star import dedup_feeds, gather_by
from tidestar.schemas import ID, NTZ, PRICE, STAR_TABLES, empty_frame, feed_schema, star_schema

DIMENSIONS = {d.table: d for d in (CUSTOMER, PRODUCT)}
BUILDERS = {"dim_customer": build_dim_customer, "dim_product": build_dim_product}
FEEDS = {"dim_customer": "customers", "dim_product": "products"}

T_ = TypeVar("T_")

# The unit of the fact partition folders.
DAY, MONTH = "day", "month"
_FORMATS = {DAY: "yyyy-MM-dd", MONTH: "yyyy-MM"}

# Fixed value: positions of one bitmap of Spark's bitmap functions, 2 ** 15.
BITMAP_BITS = 15
ROWS_PER_FILE = 4_000_000
# Bitmaps of 4 kB that are broadcast: 128 MB, enough for a thousand million facts in full buckets.
BROADCAST_BITMAPS = 32_768
# What is measured of a batch: of the items it judges, and of the facts it writes.
_JUDGED = {"judged_items": "count(1)", "rejected_items": "count_if(reason IS NOT NULL)", "rejected_share": "avg(cast(reason IS NOT NULL AS double))"}
_WRITTEN = {
    "facts": "count(1)", "mismatched_totals": "count_if(abs(total_amount - quantity * unit_price) > 0.01)", "negative_totals": "count_if(total_amount < 0)",
    "largest_total": "max(total_amount)", "undated_facts": "count_if(order_timestamp IS NULL)",
}
METRICS = (*_JUDGED, *_WRITTEN)
# What a batch reads of its winners.
_NEEDED = {"orders": ("Op", "id", "customer_id", "order_date", "status"), "order_items": ("Op", "id", "order_id", "product_id", "quantity", "unit_price")}
CURVE_BITS = 16  # of each dimension of the space-filling curve


def interleaved(x: Column, y: Column, bits: int = CURVE_BITS) -> Column:
    """Place on the curve that takes the bits of two numbers in turn (Morton order)."""

    def apart(c: Column) -> Column:
        # Doubles the distance of all bits, in halves; the masks keep 16, 8, 4, 2 and 1 bits of each pair.
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        return c

    kept = [c.cast("bigint").bitwiseAND(F.lit((1 << bits) - 1)) for c in (x, y)]
    return F.shiftleft(apart(kept[0]), 1).bitwiseOR(apart(kept[1]))


class Warehouse:
    """The star tables below one folder on shared storage."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        id_type: T.DataType = ID,
        fact_unit: str = DAY,
        skew: SkewPolicy = SkewPolicy(),
        limits: dict[str, float] | None = None,
    ) -> None:
        self.spark, self.root, self.id_type = spark, root.rstrip("/"), id_type
        self.fact_unit, self.skew, self.limits = fact_unit, skew, limits or {}
        if unknown := set(self.limits) - set(METRICS):
            raise ValueError(f"no such metrics: {sorted(unknown)}")

    # ---- tables -------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def fact_folder(self) -> str:
        return f"order_{self.fact_unit}"

    def schema(self, table: str) -> T.StructType:
        """Columns on storage, the batch folder last."""
        batch = T.StructField("_batch_id", T.LongType())
        if table == "commits":
            fields = [T.StructField("table_name", T.StringType()), T.StructField("batch_id", T.LongType()),
                      T.StructField("committed_at", NTZ), T.StructField("rows", T.LongType())]
        elif table == "failed_files":
            fields = [T.StructField("path", T.StringType()), T.StructField("lost_rows", T.LongType()), T.StructField("reason", T.StringType())]
        elif table == "schema_mismatches":
            fields = [T.StructField(c, T.StringType()) for c in ("source_table", "column_name", "table_type", "data_type")]
            fields += [T.StructField(c, T.LongType()) for c in ("filled_rows", "lost_rows")]
        elif table == "stored_orders":
            fields = [T.StructField("id", self.id_type), T.StructField("customer_id", self.id_type), T.StructField("order_date", NTZ),
                      T.StructField("status", T.StringType()), T.StructField("Op", T.StringType())]
        elif table == "pending_items":
            fields = [T.StructField("id", T.StringType()), T.StructField("order_id", self.id_type), T.StructField("product_id", self.id_type),
                      T.StructField("customer_id", self.id_type), T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", PRICE),
                      T.StructField("Op", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("since", T.LongType())]
        elif table in ("batch_metrics", "quarantined"):
            fields = [T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("limit_value", T.DoubleType())]
        elif table == "fact_deletes":
            fields = [T.StructField("order_id", self.id_type)]
        elif table == "fact_vectors":
            fields = [T.StructField("file", T.StringType()), T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType()), T.StructField("rows", T.LongType())]
        else:
            fields = [T.StructField(f.name, f.dataType) for f in star_schema(table, self.id_type).fields]
            if table in DIMENSIONS:
                fields += [T.StructField("event", T.StringType()), T.StructField("opened_in", T.LongType())]
        if table == "fact_orders":
            folder = T.DateType() if self.fact_unit == DAY else T.StringType()
            return T.StructType([*fields, batch, T.StructField(self.fact_folder, folder)])
        return T.StructType([*fields, batch])

    def create_tables(self) -> None:
        """Make the folders of all tables; those that exist are left alone."""
        tables = (*STAR_TABLES, "fact_deletes", "fact_vectors", "failed_files", "stored_orders", "pending_items", "schema_mismatches", "batch_metrics", "quarantined", "commits")
        self._together([partial(self._create, table) for table in tables])

    def _create(self, table: str) -> None:
        empty_frame(self.spark, self.schema(table)).coalesce(1).write.mode("ignore").partitionBy("_batch_id").parquet(self.path(table))

    def _together(self, jobs: list[Callable[[], T_]]) -> list[T_]:
        """Run jobs that don't depend on each other side by side; small ones leave most of a cluster idle. All have ended when this returns or raises."""
        with ThreadPoolExecutor(4) as pool:
            started = [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs]
        return [job.result() for job in started]

    def _scan(self, table: str, merge_schema: bool = False) -> DataFrame:
        reader = self.spark.read
        if merge_schema:
            return reader.option("mergeSchema", "true").parquet(self.path(table))
        return reader.schema(self.schema(table)).parquet(self.path(table))

    def _put(self, df: DataFrame, table: str, batch_id: int, partition: str | None = None, seen: Observation | None = None, metrics: dict[str, str] | None = None) -> int:
        """Write a batch folder anew and tell its rows, counted on the way, as ``metrics`` are."""
        seen = seen or Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.expr(e).alias(m) for m, e in (metrics or {}).items()])
        writer = counted.write.mode("overwrite")
        if partition:
            writer = writer.partitionBy(partition)
        writer.parquet(f"{self.path(table)}/_batch_id={batch_id}")
        return seen.get["rows"]

    def stage(self, df: DataFrame, label: str, batch_id: int, observation: Observation | None = None, metrics: dict[str, str] | None = None) -> DataFrame:
        """The frame written below the warehouse and read back, so that a batch computes it once. ``metrics`` are measured on the way."""
        path = f"{self.path('_staging')}/{label}-{batch_id}"
        seen = df.observe(observation, *[F.expr(e).alias(m) for m, e in metrics.items()]) if observation and metrics else df
        seen.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def unstage(self, label: str, batch_id: int) -> None:
        """Remove what :meth:`stage` wrote."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path('_staging')}/{label}-{batch_id}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    # ---- commits and versions ----------------------------------------

    def commits(self) -> DataFrame:
        return self._scan("commits").select("table_name", "batch_id", "committed_at", "rows")

    def snapshots(self, table: str, n: int = 5) -> DataFrame:
        """The latest commits of a table."""
        own = self.commits().where(F.col("table_name") == table)
        return own.orderBy(F.col("committed_at").desc(), F.col("batch_id").desc()).limit(n)

    def next_batch_id(self) -> int:
        last = self.commits().agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1

    def _committed(
        self, table: str, version: int | None = None, as_of: Column | None = None, writing: int | None = None,
        merge_schema: bool = False, *columns: str | Column,
    ) -> DataFrame:
        """Rows of committed batches, up to a batch id or a time.

        The batch is a partition folder, so a version test prunes folders. The
        batch being written counts as committed to itself.
        """
        done = self.commits().where(F.col("table_name") == table)
        if as_of is not None:
            done = done.where(F.col("committed_at") <= as_of)
        rows = self._scan(table, merge_schema)
        if columns:
            rows = rows.select(*columns)
        if version is not None:
            done, rows = done.where(F.col("batch_id") <= version), rows.where(F.col("_batch_id") <= version)
        ids = done.select(F.col("batch_id").alias("_batch_id"))
        if writing is not None:
            ids = ids.where(F.col("_batch_id") != writing).unionAll(
                self.spark.range(writing, writing + 1, 1, 1).select(F.col("id").alias("_batch_id"))
            )
        return rows.join(ids, "_batch_id", "left_semi")

    # ---- reading ------------------------------------------------------

    def facts(
        self, version: int | None = None, as_of: Column | None = None, merge_schema: bool = False, *,
        days: tuple[dt.date, dt.date] | None = None, customer_key: int | None = None,
    ) -> DataFrame:
        """Facts at a version or time, without those deleted by then.

        ``days`` (first and last) and ``customer_key`` choose facts; files of the last compaction that
        cannot hold any, by their least and largest values, are not opened.
        """
        rows = self._undeleted(self._placed_facts(version, as_of, merge_schema, days=days, customer_key=customer_key), version, as_of)
        if days is not None:
            rows = rows.where(F.col("date_sk").between(*[int(d.strftime("%Y%m%d")) for d in days]))
        if customer_key is not None:
            rows = rows.where(F.col("customer_key") == customer_key)
        return rows.drop("_file", "_position")

    def _generation(self, version: int | None, as_of: Column | None) -> int | None:
        """The batch id of the last compaction that a reader sees."""
        done = self.commits().where(F.col("table_name") == "fact_compacted")
        if as_of is not None:
            done = done.where(F.col("committed_at") <= as_of)
        if version is not None:
            done = done.where(F.col("batch_id") <= version)
        return done.agg(F.max("batch_id")).first()[0]

    def _placed_facts(
        self, version: int | None = None, as_of: Column | None = None, merge_schema: bool = False, writing: int | None = None,
        days: tuple[dt.date, dt.date] | None = None, customer_key: int | None = None,
    ) -> DataFrame:
        """Facts of all batches, deleted ones too, each with its file and its position there."""
        position = F.col("_metadata.row_index").alias("_position")
        file = F.concat_ws("/", "_batch_id", self.fact_folder, "_metadata.file_name").alias("_file")
        rows = self._committed("fact_orders", version, as_of, writing, merge_schema, "*", file, position)
        generation = self._generation(version, as_of)
        if generation is None:
            return rows
        rows = rows.where(F.col("_batch_id") > generation)
        path = f"{self.path('fact_compacted')}/_generation={generation}"
        paths = [path]
        if days is not None or customer_key is not None:
            hit = F.lit(True)
            if days is not None:
                first, last = (int(d.strftime("%Y%m%d")) for d in days)
                hit = hit & (F.col("last_date") >= first) & (F.col("first_date") <= last)
            if customer_key is not None:
                hit = hit & F.lit(customer_key).between(F.col("first_customer"), F.col("last_customer"))
            # One row for each file of the compaction.
            paths = [f"{path}/{row['file']}" for row in self.compacted_files(generation).where(hit).select("file").collect()]
            if not paths:
                return rows
        reader = self.spark.read.option("mergeSchema", "true") if merge_schema else self.spark.read.schema(self.schema("fact_orders"))
        old = reader.parquet(*paths)
        old = old.select("*", F.concat_ws("/", F.lit("compacted"), F.lit(generation), "_metadata.file_name").alias("_file"), position)
        return rows.unionByName(old, allowMissingColumns=merge_schema)

    def _undeleted(self, rows: DataFrame, version: int | None = None, as_of: Column | None = None) -> DataFrame:
        """The rows whose bit is not set. Where a batch deletes from a file again, its bitmaps are united.

        A bit stands for a fact of a hundred bytes, so the bitmaps are broadcast up to a bound that the
        commits tell, and no fact is shuffled to meet its bit; above it Spark's size check decides.
        """
        vectors = self._committed("fact_vectors", version, as_of).groupBy(F.col("file").alias("_file"), F.col("bucket").alias("_bucket")).agg(
            F.bitmap_or_agg("bitmap").alias("_bitmap"))
        if self.bitmaps(version, as_of) <= BROADCAST_BITMAPS:
            vectors = F.broadcast(vectors)
        at = F.col("_position")
        byte = F.conv(F.hex(F.substring("_bitmap", (F.shiftright(at.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        # The least bit of a byte is its first position.
        mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (at.bitwiseAND(F.lit(7)) + 1).cast("int"))
        placed = rows.withColumn("_bucket", F.shiftright("_position", BITMAP_BITS)).join(vectors, ["_file", "_bucket"], "left")
        return placed.where(F.col("_bitmap").isNull() | (byte.bitwiseAND(mask) == 0)).select(*rows.columns)

    def bitmaps(self, version: int | None = None, as_of: Column | None = None) -> int:
        """How many bitmaps were written up to a version or time, a few numbers of the commits."""
        done = self.commits().where("table_name = 'fact_vectors'")
        if as_of is not None:
            done = done.where(F.col("committed_at") <= as_of)
        if version is not None:
            done = done.where(F.col("batch_id") <= version)
        return done.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _marked(self, orders: DataFrame, writing: int | None = None) -> DataFrame:
        """Bitmaps of the facts of ``orders.order_id``: a scan of two columns of the facts, grouped by file and bucket.

        Places are brought together before they become bitmaps. Bitmaps of each task that has some rows
        of a bucket would be tasks times buckets, 4 kB each.
        """
        rows = self._undeleted(self._placed_facts(writing=writing)).select("order_id", "_file", "_position")
        gone = rows.join(orders.select("order_id").distinct(), "order_id", "left_semi")
        bits = F.col("_position").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
        placed = gone.select(F.col("_file").alias("file"), F.shiftright("_position", BITMAP_BITS).alias("bucket"), bits.alias("_bit"))
        return placed.repartition("file", "bucket").groupBy("file", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"), F.count(F.lit(1)).alias("rows"))

    def _put_vectors(self, orders: DataFrame, batch_id: int, writing: int | None = None) -> int:
        """Mark the facts of ``orders.order_id`` as deleted."""
        return self._put(self._marked(orders, writing), "fact_vectors", batch_id)

    def deleted_rows(self, version: int | None = None) -> DataFrame:
        """Of each batch that deleted facts, how many, told by the bits of its bitmaps."""
        vectors = self._committed("fact_vectors", version)
        return vectors.groupBy("_batch_id").agg(F.sum(F.bitmap_count("bitmap")).alias("deleted"))

    def compacted_files(self, generation: int) -> DataFrame:
        """Files of a compaction with their rows, and the least and largest date and customer of each."""
        return self.spark.read.parquet(f"{self.path('fact_files')}/_generation={generation}")

    def compact_facts(self, batch_id: int, committed_at: Column, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Write all facts so far anew, without deleted ones, as batch ``batch_id``, and tell their number.

        Each fact keeps the batch it came with. Files hold about ``rows_per_file`` facts that are near
        in date and customer: the curve interleaves the bits of the two, dates scaled to their range, and
        customer keys are spread evenly as they are. Later batches are read from their own folders.
        """
        done = self.commits().where((F.col("batch_id") == batch_id) & (F.col("table_name") == "fact_compacted")).select("rows").collect()
        if done:
            return done[0]["rows"]
        # Without any fact there is no file to take columns from.
        facts = self.facts(merge_schema=self._last_commit("fact_orders") is not None)
        top = (1 << CURVE_BITS) - 1
        day = F.unix_date(F.col("order_timestamp").cast("date"))
        total, first, last = facts.agg(F.count(F.lit(1)), F.min(day), F.max(day)).first()
        x = ((day - F.lit(first or 0)) * F.lit(top) / F.lit(max(1, (last or 0) - (first or 0)))).cast("bigint")
        y = F.shiftright("customer_key", 64 - CURVE_BITS) + F.lit(1 << (CURVE_BITS - 1))
        path, files = f"{self.path('fact_compacted')}/_generation={batch_id}", max(1, -(-total // rows_per_file))
        placed = facts.withColumn("_curve", interleaved(x, y)).repartitionByRange(files, "_curve").sortWithinPartitions("_curve")
        placed.drop("_curve").write.mode("overwrite").parquet(path)
        told = self.spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("date_sk").alias("first_date"), F.max("date_sk").alias("last_date"),
            F.min("customer_key").alias("first_customer"), F.max("customer_key").alias("last_customer"), F.count(F.lit(1)).alias("rows"),
        )
        told.coalesce(1).write.mode("overwrite").parquet(f"{self.path('fact_files')}/_generation={batch_id}")
        self._commit({"fact_compacted": total}, batch_id, committed_at)
        return total

    def dates(self, version: int | None = None) -> DataFrame:
        return self._committed("dim_date", version).drop("_batch_id")

    def _versions(self, log: DataFrame, dim: Dimension) -> DataFrame:
        """Each version once: its closed form if it was closed, else as opened."""
        # One pass: of the at most two rows of a version the closed one comes first by name.
        row = F.struct(*[F.col(f.name) for f in log.schema.fields if f.name not in (dim.natural_id, "opened_in")])
        # By the id alone, so that a log that was shuffled to meet ids is not shuffled again.
        latest = log.repartition(F.col(dim.natural_id)).groupBy(dim.natural_id, "opened_in").agg(F.min_by(row, "event").alias("_row"))
        return latest.select(dim.natural_id, "opened_in", "_row.*")

    def dimension(self, table: str, version: int | None = None, as_of: Column | None = None) -> DataFrame:
        """All versions of a dimension, current and closed."""
        dim = DIMENSIONS[table]
        return self._versions(self._committed(table, version, as_of), dim).select(*dim.columns)

    def current_rows(self, table: str, wanted: DataFrame, writing: int | None = None, before: int | None = None) -> DataFrame:
        """Current rows of the ids in ``wanted`` (one column, the natural id).

        The log is cut down to those ids first. Spark broadcasts ``wanted``
        where its size allows, and the log is then not shuffled.
        """
        dim = DIMENSIONS[table]
        log = self._committed(table, before, writing=writing).join(wanted, dim.natural_id, "left_semi")
        return self._versions(log, dim).where("is_current").select(*dim.columns, "opened_in")

    def current_ids(self, table: str, wanted: DataFrame, writing: int | None = None, before: int | None = None) -> DataFrame:
        """Which ids in ``wanted`` have a current row, told by four narrow columns of the log."""
        dim = DIMENSIONS[table]
        log = self._committed(table, before, None, writing, False, dim.natural_id, "opened_in", "event", "is_current", "_batch_id")
        return self._versions(log.drop("_batch_id").join(wanted, dim.natural_id, "left_semi"), dim).where("is_current").select(dim.natural_id, "is_current")

    def star(self, version: int | None = None, as_of: Column | None = None) -> dict[str, DataFrame]:
        """The four star tables at a version or time, for the reports."""
        return {
            **{table: self.dimension(table, version, as_of) for table in DIMENSIONS},
            "dim_date": self._committed("dim_date", version, as_of).drop("_batch_id"),
            "fact_orders": self.facts(version, as_of).drop("_batch_id", self.fact_folder),
        }

    def create_views(self, version: int | None = None, as_of: Column | None = None, prefix: str = "") -> None:
        """Temporary views of the star tables and of their commits, for SQL text."""
        for table, frame in self.star(version, as_of).items():
            frame.createOrReplaceTempView(prefix + table)
        self.commits().createOrReplaceTempView(prefix + "commits")

    # ---- writing ------------------------------------------------------

    def _ids(self, feed: DataFrame | None, column: str, name: str) -> DataFrame:
        """Distinct ids that a feed mentions, before dedup: one narrow column is all this reads."""
        if feed is None:
            return empty_frame(self.spark, T.StructType([T.StructField(name, self.id_type)]))
        return feed.select(to_int_safe(F.col(column), feed.schema[column].dataType, self.id_type).alias(name)).distinct()

    def _write_dimension(
        self, table: str, feed: DataFrame | None, changes: DataFrame, batch_id: int, batch_ts: Column,
    ) -> int:
        dim = DIMENSIONS[table]
        batch = BUILDERS[table](changes, batch_ts, self.id_type)
        wanted = self._ids(feed, "id", dim.natural_id)
        current = self.current_rows(table, wanted, before=batch_id - 1)
        rows = scd2_changes(current, batch, dim, batch_ts)
        opened_in = F.when(F.col("event") == "open", F.lit(batch_id)).otherwise(F.col("opened_in"))
        return self._put(rows.withColumn("opened_in", opened_in.cast("bigint")), table, batch_id)

    def write_facts(
        self, facts: DataFrame, batch_id: int, seen: Observation | None = None, form: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Facts in one folder per day (or month) of the order.

        ``form`` makes them of ``facts`` behind the shuffle, which then carries ids in place of their hashes.
        """
        folder = F.date_format("order_timestamp", _FORMATS[self.fact_unit])
        placed = gather_by(facts.withColumn(self.fact_folder, folder), self.fact_folder)
        if form:
            placed = form(placed).withColumn(self.fact_folder, folder)
        return self._put(placed, "fact_orders", batch_id, self.fact_folder, seen, _WRITTEN if seen else None)

    def delete_from_fact(self, orders: DataFrame, batch_id: int, committed_at: Column) -> None:
        """Hard-delete the facts of the orders in ``orders.order_id`` as of a batch."""
        ids = orders.select("order_id").distinct()
        rows = {"fact_vectors": self._put_vectors(ids, batch_id), "fact_deletes": self._put(ids, "fact_deletes", batch_id)}
        self._commit(rows, batch_id, committed_at)

    def write_failed_files(self, failed: DataFrame, batch_id: int) -> None:
        """Note the files a batch could not read, so that none is lost from sight.

        ``lost_rows`` is null where not even the footer could be read.
        """
        self._put(failed.select("path", F.col("lost_rows").cast("bigint").alias("lost_rows"), "reason"), "failed_files", batch_id)

    def failed_files(self) -> DataFrame:
        return self._scan("failed_files")

    def _commit(self, rows: dict[str, int], batch_id: int, committed_at: Column) -> None:
        entries = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(batch_id).cast("bigint").alias("batch_id"),
                committed_at.cast("timestamp_ntz").alias("committed_at"), F.lit(n).cast("bigint").alias("rows"),
            )
            for table, n in rows.items()
        ]
        # One file per group of tables, so a later delete in the same batch id keeps the earlier entries.
        label = "fact_deletes" if "fact_orders" not in rows and "fact_vectors" in rows else next(iter(rows)) if len(rows) == 1 else "batch"
        self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries))).write.mode("overwrite").parquet(
            f"{self.path('commits')}/_batch_id={batch_id}/part_of={label}"
        )

    def _mismatches(self, feeds: dict[str, DataFrame]) -> list[DataFrame]:
        """Of each feed whose columns have other types than declared: which ones, and how many values do not fit."""
        found = []
        for table, feed in feeds.items():
            declared = feed_schema(table, self.id_type)
            if any(f.name in feed.columns and feed.schema[f.name].dataType != f.dataType for f in declared.fields):
                found.append(schema_mismatches(declared, feed).withColumn("source_table", F.lit(table)))
        return found

    def schema_mismatches(self, version: int | None = None) -> DataFrame:
        """Columns that arrived with other types than declared, by batch."""
        return self._committed("schema_mismatches", version)

    def _orders_in_reach(self, won: DataFrame, asked: DataFrame, before: int, batch_id: int) -> DataFrame:
        """The winning orders of a batch (``own``), and the latest stored form of other orders, those in ``asked``."""
        int_of = lambda c: to_int_safe(F.col(c), won.schema[c].dataType, self.id_type)
        own = won.select(
            int_of("id").alias("id"), int_of("customer_id").alias("customer_id"), to_timestamp_safe(F.col("order_date"), won.schema["order_date"].dataType).alias("order_date"),
            to_string_safe(F.col("status")).alias("status"), "Op", F.lit(True).alias("own"),
        )
        if self._last_commit("stored_orders", before) is None:
            return own
        # Written, so that Spark knows their size: the log is not shuffled for a few ids, and what is found in it is found once.
        missing = self.stage(asked.select(F.col("order_id").alias("id")).join(own.select("id"), "id", "left_anti"), "missing", batch_id)
        stored = self._committed("stored_orders", before).join(missing, "id", "left_semi")
        row = F.struct("customer_id", "order_date", "status", "Op")
        # An id is in a batch once, so nothing is gained by a sort of the log before the shuffle.
        latest = stored.repartition(F.col("id")).groupBy("id").agg(F.max_by(row, "_batch_id").alias("_row")).select("id", "_row.*")
        return own.unionByName(self.stage(latest, "latest", batch_id).withColumn("own", F.lit(False)))

    def _items_in_reach(self, won: DataFrame, feeds: dict[str, DataFrame], before: int, batch_id: int) -> DataFrame:
        """The winning items of a batch, and those that wait for something the batch changes. ``waited``: whether it waited before."""
        int_of = lambda c, kind=self.id_type: to_int_safe(F.col(c), won.schema[c].dataType, kind)
        own = won.select(
            F.col("id").cast("string").alias("id"), int_of("order_id").alias("order_id"), int_of("product_id").alias("product_id"), int_of("quantity", T.IntegerType()).alias("quantity"),
            to_decimal_safe(F.col("unit_price"), won.schema["unit_price"].dataType).alias("unit_price"), "Op", F.lit(batch_id).cast("bigint").alias("since"),
        )
        if self._last_commit("pending_items", before) is None:
            return own.withColumn("waited", F.lit(False))
        waiting = self.pending_items(before)
        own = own.join(waiting.select("id", F.lit(True).alias("waited")), "id", "left").withColumn("waited", F.coalesce("waited", F.lit(False)))
        touched, hit = waiting, F.lit(False)
        for table, column in (("orders", "order_id"), ("customers", "customer_id"), ("products", "product_id")):
            if table in feeds:
                ids = self._ids(feeds[table], "id", column).withColumn(f"_{table}", F.lit(True))
                touched, hit = touched.join(ids, column, "left"), hit | F.col(f"_{table}").isNotNull()
        again = touched.where(hit).join(own.select("id"), "id", "left_anti").withColumn("waited", F.lit(True))
        return self.stage(own.unionByName(again.select(*own.columns)), "reach", batch_id)

    def _last_commit(self, table: str, version: int | None = None) -> int | None:
        done = self.commits().where((F.col("table_name") == table) & (F.col("rows") > 0))
        if version is not None:
            done = done.where(F.col("batch_id") <= version)
        return done.agg(F.max("batch_id")).first()[0]

    def pending_items(self, version: int | None = None) -> DataFrame:
        """Items that gave no fact up to a version, with the reason and the batch they came in (``since``)."""
        log = self._committed("pending_items", version)
        row = F.struct(*[f.name for f in self.schema("pending_items").fields if f.name not in ("id", "_batch_id")])
        # An item is in a batch once, so nothing is gained by a sort of the log before the shuffle.
        latest = log.repartition(F.col("id")).groupBy("id").agg(F.max_by(row, "_batch_id").alias("_row"))
        return latest.select("id", "_row.*").where("reason IS NOT NULL")

    def write_batch(
        self,
        feeds: dict[str, DataFrame],
        arrival: dict[str, tuple[str, ...]],
        batch_id: int,
        batch_ts: Column,
        *,
        null_timestamps: bool | Collection[str] = True,
        drop_deleted: bool = False,
        hard_delete: bool = False,
    ) -> dict[str, int]:
        """Merge one batch of changes into the star tables and commit it.

        Dimensions are written first and read back for the key lookup of the
        facts, so an item finds customers and products of earlier batches, and
        their changes are not computed twice. With ``hard_delete`` deleted
        orders also lose the facts of earlier batches. A batch id that is
        committed is left as it is.
        """
        aside = F.col("table_name").isin("fact_deletes", "fact_vectors", "fact_compacted", "quarantined") | F.col("table_name").startswith("report_sums")
        done = self.commits().where((F.col("batch_id") == batch_id) & ~aside)
        written = {row["table_name"]: row["rows"] for row in done.select("table_name", "rows").collect()}
        if written:
            return written
        won = dedup_feeds(
            self.spark, feeds, arrival, id_type=self.id_type, null_timestamps=null_timestamps, skew=self.skew,
        )
        # Winners are found once, then read by the dates, the facts and the logs.
        # Items are looked at a second time only where some wait.
        waits = self._last_commit("pending_items", batch_id - 1) is not None
        twice = [table for table in (["orders", "order_items"] if waits else ["orders"]) if table in feeds]
        needed = {table: [c for c in _NEEDED[table] if c in won[table].columns] for table in twice}
        won |= dict(zip(twice, self._together([partial(self.stage, won[table].select(*needed[table]), table, batch_id) for table in twice]), strict=True))
        dates = dim_date_upsert(self.dates(batch_id - 1), build_dim_date(won["orders"]))
        written = self._together([
            *[partial(self._write_dimension, table, feeds.get(feed), won[feed], batch_id, batch_ts) for table, feed in FEEDS.items()],
            partial(self._put, dates, "dim_date", batch_id),
        ])
        rows = dict(zip([*FEEDS, "dim_date"], written, strict=True))

        if other := self._mismatches(feeds):
            rows["schema_mismatches"] = self._put(reduce(DataFrame.unionByName, other), "schema_mismatches", batch_id)
        before, id_type = batch_id - 1, self.id_type
        items = self._items_in_reach(won["order_items"], feeds, before, batch_id)
        # Items that are written are asked for their ids; of others all changes are, which mention no fewer, before dedup.
        asked = {c: items.select(c).distinct() if waits else self._ids(feeds.get("order_items"), c, c) for c in ("order_id", "product_id")}
        orders = self._orders_in_reach(won["orders"], asked["order_id"], before, batch_id)
        known = {
            "dim_customer": self.current_ids("dim_customer", orders.select("customer_id").distinct(), writing=batch_id, before=batch_id),
            "dim_product": self.current_ids("dim_product", asked["product_id"], writing=batch_id, before=batch_id),
        }
        judged = judged_items(
            orders, items, *known.values(), id_type=id_type, drop_deleted=drop_deleted, skew=self.skew,
            raw={"orders": won["orders"], "order_items": won["order_items"] if "order_items" in twice else feeds.get("order_items", won["order_items"])},
        )
        # Judged once, then read by the facts and by the waiting items. The item's own columns are kept where the log
        # gets them; the date and the total of a fact follow from its other columns.
        of_items, of_facts = Observation(), Observation()
        logged = F.expr("reason IS NOT NULL OR waited")
        judged = judged.withColumns({c: F.when(logged, F.col(c)) for c in ("item_id", "since", "Op")}).drop("order_date", "total_amount")
        judged = self.stage(judged, "judged", batch_id, of_items, _JUDGED)
        noted = judged.where(logged).withColumnRenamed("item_id", "id")
        own = orders.where("own")
        columns = lambda table: [f.name for f in self.schema(table).fields if f.name != "_batch_id"]
        rows["fact_orders"], rows["pending_items"], rows["stored_orders"] = self._together([
            partial(self.write_facts, judged.where("reason IS NULL"), batch_id, of_facts, lambda kept: facts_of(with_totals(kept))),
            partial(self._put, noted.select(*columns("pending_items")), "pending_items", batch_id),
            partial(self._put, own.select(*columns("stored_orders")), "stored_orders", batch_id),
        ])
        if hard_delete:
            gone = won["orders"].where("Op = 'D'").select(F.col("id").cast(self.id_type).alias("order_id"))
            rows["fact_deletes"] = self._put(gone, "fact_deletes", batch_id)
            rows["fact_vectors"] = self._put_vectors(gone, batch_id, writing=batch_id)
        above = self._write_metrics({**of_items.get, **{m: v for m, v in of_facts.get.items() if m != "rows"}}, batch_id, rows)
        for label in ("orders", "order_items", "reach", "missing", "latest", "judged"):
            self.unstage(label, batch_id)
        if above:
            self._commit({"quarantined": above}, batch_id, batch_ts)
            return {}
        self._commit(rows, batch_id, batch_ts)
        return rows

    def _write_metrics(self, measured: dict[str, object], batch_id: int, rows: dict[str, int]) -> int:
        """Note what was measured, and tell how many limits it is above; these are noted as quarantined."""
        told = [(m, None if measured[m] is None else float(measured[m]), None if m not in self.limits else float(self.limits[m])) for m in METRICS]
        schema = "metric string, value double, limit_value double"
        rows["batch_metrics"] = self._put(self.spark.createDataFrame(told, schema).coalesce(1), "batch_metrics", batch_id)
        above = [x for x in told if x[1] is not None and x[2] is not None and x[1] > x[2]]
        if above:
            self._put(self.spark.createDataFrame(above, schema).coalesce(1), "quarantined", batch_id)
        return len(above)

    def batch_metrics(self, version: int | None = None) -> DataFrame:
        """What was measured of each committed batch: metric, value, limit_value, _batch_id."""
        return self._committed("batch_metrics", version)

    def quarantined(self) -> DataFrame:
        """Batches that were not committed, with the limits they are above; those that were written again and committed since are left out."""
        there = self.commits().where("table_name = 'batch_metrics'").select(F.col("batch_id").alias("_batch_id"))
        return self._committed("quarantined").join(there, "_batch_id", "left_anti")
