"""Structured Streaming over the landing folder.

The stream carries file names only; the checkpoint remembers which files were
taken. Each micro-batch then reads the new files of each table as an ordinary
Parquet scan, so column pruning, file pruning and push-down all apply, which
they do not to the rows that a stream hands to ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidestar.operators import has_null_timestamps
from tidestar.plans.warehouse import Warehouse
from tidestar.schemas import ID, SOURCE_TABLES, empty_frame, union_feed_schema
from tidestar.sources.files import (
    ARRIVAL,
    PARQUET_GLOB,
    RECOVERY_BYTES,
    damaged_blocks,
    failed_files,
    object_key,
    read_cdc_parquet,
    table_of_key,
)

# Files of one micro-batch. A bound of the driver's list only: an item and its order may come in different batches.
MAX_FILES = 10_000

FAILED = T.StructType([T.StructField("path", T.StringType()), T.StructField("lost_rows", T.LongType()), T.StructField("reason", T.StringType())])
UNKNOWN_TABLE = "no table of the star"

# The columns of Spark's binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_cdc(
    spark: SparkSession, prefix: str, root: str, *, id_type: T.DataType = ID, ts_col: str = "Timestamp",
    max_files: int = MAX_FILES,
) -> DataFrame:
    """Change rows of all tables as one stream, with their ``source_table``.

    Columns that a table does not have are null.
    """
    rows = (
        spark.readStream.schema(union_feed_schema(id_type, ts_col))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
        .option("maxFilesPerTrigger", max_files)
        .parquet(prefix)
    )
    return rows.withColumn("source_table", table_of_key(object_key(F.col("_metadata.file_path"), root)))


def stream_files(spark: SparkSession, prefix: str, root: str, *, max_files: int = MAX_FILES) -> DataFrame:
    """New change files as a stream of one row per file; no file is opened."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PARQUET_GLOB)
        .option("maxFilesPerTrigger", max_files)
        .load(prefix)
    )
    return files.select("path", "length", table_of_key(object_key(F.col("path"), root)).alias("source_table"))


def _new_files(files: DataFrame) -> dict[str, list[str]]:
    """Paths per source table. The trigger bounds their number (``max_files``)."""
    paths: dict[str, list[str]] = {}
    for row in files.select("source_table", "path").collect():
        paths.setdefault(row["source_table"], []).append(row["path"])
    return paths


def process_batch(
    warehouse: Warehouse, *, clock: Callable[[int], Column] | None = None, ts_col: str = "Timestamp",
    arrival: dict[str, tuple[str, ...]] | None = None, skip_corrupt: bool = True, drop_deleted: bool = False,
    hard_delete: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: new files to star tables, one commit.

    A batch that is run again after a failure gets the same files and the same
    id, and replaces what it wrote before. ``clock`` gives the time of a batch,
    ``arrival`` the order of arrival where it is not that of the files.
    """

    def run(files: DataFrame, batch_id: int) -> None:
        spark = warehouse.spark
        found = _new_files(files)
        new = {table: paths for table, paths in found.items() if table in SOURCE_TABLES}
        foreign = {path: UNKNOWN_TABLE for table, paths in found.items() if table not in SOURCE_TABLES for path in paths}
        if not new and not foreign:
            return
        unreadable: dict[str, str] = {}
        if skip_corrupt and new:
            every = [path for paths in new.values() for path in paths]
            unreadable = {row["path"]: row["reason"] for row in failed_files(spark, every).collect()}  # at most max_files rows
        readable = {table: [p for p in paths if p not in unreadable] for table, paths in new.items()}
        readable = {table: paths for table, paths in readable.items() if paths}

        def feeds(leave_out: bool) -> dict[str, DataFrame]:
            return {
                table: read_cdc_parquet(
                    spark, paths, table, id_type=warehouse.id_type, ts_col=ts_col, declared=False,
                    skip_corrupt=leave_out, arrival=True, block_bytes=RECOVERY_BYTES if leave_out else None,
                )
                for table, paths in readable.items()
            }

        def write(frames: dict[str, DataFrame]) -> None:
            warehouse.write_batch(
                frames, arrival or {table: ARRIVAL for table in SOURCE_TABLES}, batch_id, stamp,
                null_timestamps={table for table, feed in frames.items() if has_null_timestamps(feed)},
                drop_deleted=drop_deleted, hard_delete=hard_delete,
            )

        stamp = clock(batch_id) if clock else F.lit(_now(spark))
        noted = [(path, None, reason) for path, reason in {**unreadable, **foreign}.items()]
        failed = spark.createDataFrame(noted, FAILED) if noted else empty_frame(spark, FAILED)
        warehouse.write_failed_files(failed, batch_id)
        if not readable:
            return
        try:
            write(feeds(leave_out=False))
        except Exception as error:
            if not skip_corrupt or "FAILED_READ_FILE" not in str(error):
                raise
            # Some file has a good footer and bad content: tell which blocks, and take all others.
            frames = feeds(leave_out=True)
            for table, paths in readable.items():
                lost = damaged_blocks(frames[table], spark, paths)
                why = F.concat(F.lit("content cannot be read in the block at byte "), F.col("block").cast("string"))
                failed = failed.unionByName(lost.select("path", "lost_rows", why.alias("reason")))
            warehouse.write_failed_files(failed, batch_id)
            write(frames)

    return run


def _now(spark: SparkSession):  # noqa: ANN202 - a datetime, the same for all tables of a batch
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]


def start(
    warehouse: Warehouse, prefix: str, root: str, *, once: bool = True, interval: str = "60 seconds",
    max_files: int = MAX_FILES, **options: object,
) -> StreamingQuery:
    """Run the stream: all files now present (``once``), or every ``interval``.

    The checkpoint lies with the warehouse, since its batch numbers are those
    of the warehouse.
    """
    warehouse.create_tables()
    files = stream_files(warehouse.spark, prefix, root, max_files=max_files)
    writer = files.writeStream.foreachBatch(process_batch(warehouse, **options)).option(
        "checkpointLocation", f"{warehouse.root}/_checkpoint"
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
