"""Change files: discovery, ledger, reading, routing, error report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.convert import to_timestamp_safe
from tidestar.schemas import ID, WIDE_ID, empty_frame, feed_schema
from tidestar.session import scratch_dir

# Where the change files of a table lie below the landing folder.
RAW_PREFIX = "dms-source"
PARQUET_GLOB = "*.parquet"
SIZE_UNITS = ("B", "KB", "MB", "GB")

LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()), T.StructField("processed_at", T.TimestampType()),
])


def discover_files(
    spark: SparkSession, prefix: str | list[str], *, ledger: DataFrame | None = None, glob: str = PARQUET_GLOB,
) -> DataFrame:
    """Files below a prefix that are not in the ledger, oldest first.

    Only names, sizes and times are listed; no file is opened. Files of no bytes
    are not listed, as by every Spark file source.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(prefix)
        .select("path", "length", "modificationTime")
    )
    if ledger is not None:
        files = files.join(ledger.select("path"), "path", "left_anti")
    return files.orderBy("modificationTime", "path")


def mark_processed(files: DataFrame, ledger_path: str) -> None:
    """Append files to the ledger, so that discovery leaves them out."""
    (
        files.select("path", "length", "modificationTime", F.current_timestamp().alias("processed_at"))
        .write.mode("append").parquet(ledger_path)
    )


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger; make it first with :func:`create_ledger`."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def create_ledger(spark: SparkSession, ledger_path: str) -> None:
    empty_frame(spark, LEDGER_SCHEMA).write.mode("ignore").parquet(ledger_path)


def size_formatted(size: Column) -> Column:
    """Size for people: whole bytes, else one decimal of KB, MB or GB."""
    units = F.array(*[F.lit(unit) for unit in SIZE_UNITS])
    # The unit is the power of 1024 that the number's binary digits reach.
    power = F.least(F.floor((F.length(F.bin(size)) - 1) / 10), F.lit(len(SIZE_UNITS) - 1)).cast("int")
    digits = F.when(power == 0, size.cast("string")).otherwise(F.format_string("%.1f", size / F.pow(F.lit(1024.0), power)))
    return F.concat_ws(" ", digits, F.get(units, power))


def file_catalog(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("path").alias("uri"), "length", size_formatted(F.col("length")).alias("size_formatted"),
        "modificationTime",
    )


def table_of_key(key: Column) -> Column:
    """Source table of an object key such as ``prefix/schema/table/file``.

    The third part; for shorter keys the nearest folder that has a name, else
    ``unknown``.
    """
    parts = F.split(key, "/")
    folders = F.filter(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p != "")
    nearest = F.get(folders, F.size(folders) - 1)
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(2))).otherwise(F.coalesce(nearest, F.lit("unknown")))


def object_key(path: Column, root: str) -> Column:
    """A path relative to the bucket or landing folder it lies in."""
    bare = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    marker = f"/{bare}/"
    return F.substring_index(path, marker, -1)


def route_by_table(rows: DataFrame, table: str, root: str, path_col: str = "_metadata.file_path") -> DataFrame:
    """The rows that came from the files of one table.

    On a file scan Spark applies a test of the file path while planning, so
    the other tables' files are not opened.
    """
    return rows.where(table_of_key(object_key(F.col(path_col), root)) == table)


def _merged_schema(reader: DataFrameReader, paths: list[str]) -> T.StructType | None:
    """The schema the footers agree on, or None where they do not."""
    try:
        return reader.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").parquet(*paths).schema
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def read_cdc_parquet(
    spark: SparkSession,
    paths: str | list[str],
    table: str,
    *,
    id_type: T.DataType = ID,
    ts_col: str = "Timestamp",
    declared: bool = True,
    skip_corrupt: bool = False,
    glob: str = PARQUET_GLOB,
    arrival: bool = False,
    block_bytes: int | None = None,
) -> DataFrame:
    """Changes of one table, any codec. ``ts_col`` is renamed to ``Timestamp``.

    ``declared`` reads with the declared schema. Otherwise the footers tell the
    schema: columns keep the type they were written with, for the safe
    conversions to work on, absent ones are null. Files that do not agree are
    read with wide ids.

    ``skip_corrupt`` leaves out what cannot be read. To Spark that includes a
    column of another type than asked for, so use it on files that were checked
    (:func:`failed_files`, :func:`damaged_files`). With ``arrival`` the columns
    ``_file_time``, ``_file`` and ``_row`` tell the order of arrival.

    What is left out is the rest of the block that a task reads at a time. With
    ``block_bytes`` files are read in blocks of at most so many bytes; where that
    is less than a row group, each row group is a block of its own, so good ones
    behind a damaged one are kept. Pages are then checked against their checksums,
    and ``_block`` tells where the block of a row begins. Files of very many row groups
    are cut into files of a few row groups first, below the shared checkpoint folder.
    """
    paths = [paths] if isinstance(paths, str) else paths
    if block_bytes:
        spark = _block_session(spark, block_bytes)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    schema = feed_schema(table, id_type, ts_col) if declared else _merged_schema(reader, paths)
    if schema is None:
        schema = feed_schema(table, WIDE_ID, ts_col)

    def settled(reader: DataFrameReader) -> DataFrameReader:
        reader = reader.option("ignoreCorruptFiles", str(skip_corrupt).lower()).option("mergeSchema", "false")
        return reader.option("parquet.page.verify-checksum.enabled", "true") if block_bytes else reader

    columns = [F.col(f"`{c}`") for c in schema.fieldNames() if c != ts_col]
    absent = [f for f in feed_schema(table, id_type, ts_col).fields if f.name not in schema.fieldNames() and f.name != ts_col]
    columns += [F.lit(None).cast(f.dataType).alias(f.name) for f in absent]
    if ts_col in schema.fieldNames():
        columns.append(to_timestamp_safe(F.col(ts_col), schema[ts_col].dataType).alias("Timestamp"))
    else:
        columns.append(F.lit(None).cast("timestamp_ntz").alias("Timestamp"))
    places = [*ARRIVAL, *["_block"] * bool(block_bytes)] if arrival else []
    if block_bytes:
        return _block_scans(spark, paths, block_bytes, schema, settled, glob=glob, keep=(*columns, *places))
    rows = settled(reader.schema(schema)).parquet(*paths)
    return rows.select(*columns, *[F.col(_PLACES[c]).alias(c) for c in places])


# Bytes of a block where files with damaged content are read again: less than the row groups that writers make.
RECOVERY_BYTES = 1 << 20
# Tasks for each core that read blocks; without a bound every block is a task.
BLOCK_TASKS = 8


def _block_session(spark: SparkSession, block_bytes: int) -> SparkSession:
    """A session whose scans read files in smaller blocks, many to a task; all else is shared. A block that cannot be read costs its own rows only."""
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        other.conf.set(key, spark.conf.get(key))
    other.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    other.conf.set("spark.sql.files.maxPartitionNum", str(BLOCK_TASKS * spark.sparkContext.defaultParallelism))
    return other


ARRIVAL = ("_file_time", "_file", "_row")
# Where a row lies, as a file scan tells it.
_PLACES = {
    "_file_time": "_metadata.file_modification_time", "_file": "_metadata.file_path", "_row": "_metadata.row_index",
    "_block": "_metadata.file_block_start",
}
# A scan reads the footer of a file anew for each block. Files with a footer longer than so many blocks are cut first.
LONG_FOOTER = 4
_PIECE = T.StructType([T.StructField(c, T.LongType()) for c in ("piece_file", "piece_row", "piece_at")])
_cut: dict[tuple, str] = {}


def _footer_bytes(spark: SparkSession, path: str, length: int) -> int:
    """Length of a Parquet footer, 0 where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        stream.seek(length - 8)
        n, magic = spark._jvm.java.lang.Integer.reverseBytes(stream.readInt()), stream.readInt()
    finally:
        stream.close()
    return n if magic == int.from_bytes(b"PAR1", "big") and 0 < n < length else 0


def _pieces(spark: SparkSession, files: list[tuple[str, int, int]], block_bytes: int) -> str:
    """Files (path, length, length of the footer) cut into pieces of a few row groups, each with a footer of about a block.

    The bytes of the row groups are copied as they are. Folders tell the number of the file, and of a piece the first row and the place
    in the file. This passes the files through the driver, once; it is meant for those of the batch that failed.
    """
    root = scratch_dir(spark, "pieces")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet, to_path = jvm.org.apache.parquet.hadoop, jvm.org.apache.hadoop.fs.Path
    for number, (path, _, footer) in enumerate(files):
        source = parquet.util.HadoopInputFile.fromPath(to_path(path), conf)
        reader = parquet.ParquetFileReader.open(source)
        stream = source.newStream()
        try:
            meta, groups = reader.getFooter().getFileMetaData(), reader.getRowGroups()
            n = groups.size()
            step = max(1, block_bytes * n // footer)
            for first in range(0, n, step):
                group = groups.get(first)
                # What comes before the first row group of a file are four bytes.
                place = f"piece_file={number}/piece_row={group.getRowIndexOffset()}/piece_at={group.getStartingPos() - 4}"
                target = parquet.util.HadoopOutputFile.fromPath(to_path(f"{root}/{place}/part-0.parquet"), conf)
                writer = parquet.ParquetFileWriter(target, meta.getSchema(), parquet.ParquetFileWriter.Mode.CREATE, 1 << 27, 0)
                writer.start()
                writer.appendRowGroups(stream, groups.subList(first, min(n, first + step)), False)
                writer.end(meta.getKeyValueMetaData())
        finally:
            stream.close()
            reader.close()
    return root


def _block_scans(
    spark: SparkSession, paths: list[str], block_bytes: int, schema: T.StructType, settled: Callable[[DataFrameReader], DataFrameReader], *,
    glob: str, keep: tuple[Column | str, ...],
) -> DataFrame:
    """Columns ``keep`` of the files, of which ``_PLACES`` may be some, read in blocks by a session of :func:`_block_session`."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths)
        .select("path", "length", F.unix_micros("modificationTime").alias("at"), F.col(_PLACES["_file"]).alias("file"))
    )
    large = sorted(listed.where(F.col("length") > 4 * LONG_FOOTER * block_bytes).collect())
    told = [(row, _footer_bytes(spark, row["path"], row["length"])) for row in large]
    told = [(row, footer) for row, footer in told if footer > LONG_FOOTER * block_bytes]
    rest = paths
    if told:
        cut = {row["path"] for row, _ in told}
        rest = [r["path"] for r in listed.select("path").collect() if r["path"] not in cut]
    frames = []
    if rest:
        rows = settled(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).schema(schema)).parquet(*rest)
        frames.append(rows.select(*[F.col(_PLACES[c]).alias(c) if isinstance(c, str) else c for c in keep]))
    if told:
        slot = (spark.sparkContext.applicationId, block_bytes, *[row for row, _ in told])
        if slot not in _cut:
            _cut[slot] = _pieces(spark, [(row["path"], row["length"], footer) for row, footer in told], block_bytes)
        rows = settled(spark.read.schema(T.StructType([*schema.fields, *_PIECE.fields]))).parquet(_cut[slot])
        of = lambda values: F.get(F.array(*values), F.col("piece_file").cast("int"))
        places = {
            "_file_time": of([F.timestamp_micros(F.lit(row["at"])) for row, _ in told]), "_file": of([F.lit(row["file"]) for row, _ in told]),
            "_row": F.col("piece_row") + F.col(_PLACES["_row"]), "_block": F.col("piece_at") + F.col(_PLACES["_block"]),
        }
        frames.append(rows.select(*[places[c].alias(c) if isinstance(c, str) else c for c in keep]))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def failed_files(spark: SparkSession, prefix: str | list[str], *, glob: str = PARQUET_GLOB) -> DataFrame:
    """Files (below a prefix, or listed) that cannot be read, with the ``reason``.

    One scan takes no column, so it reads footers only; every file that shows a
    row is fine. The silent ones, which have no rows or cannot be read, are
    opened again by Spark's own reader, which then fails: all at once, and in
    halves of those that fail.
    """
    files = discover_files(spark, prefix, glob=glob).select("path", "length")
    seen = (
        spark.read.schema("Op string")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("ignoreCorruptFiles", "true")
        .parquet(*([prefix] if isinstance(prefix, str) else prefix))
        .select(_plain_path(F.col("_metadata.file_path")).alias("plain"))
        .distinct()
    )
    silent = files.withColumn("plain", _plain_path(F.col("path"))).join(seen, "plain", "left_anti")
    # Files without rows or without a footer: few next to the files of a prefix.
    listed = {row["path"]: row["length"] for row in silent.select("path", "length").collect()}
    failed = [(path, listed[path], reason) for path, reason in _unreadable(spark, sorted(listed))]
    schema = "path string, length bigint, reason string"
    return spark.createDataFrame(failed, schema) if failed else spark.range(0).selectExpr("'' AS path", "0L AS length", "'' AS reason")


def _unreadable(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    if not paths:
        return []
    try:
        spark.read.schema("Op string").option("ignoreCorruptFiles", "false").parquet(*paths).select(F.lit(1)).count()
        return []
    except Exception as error:
        if not any(sign in str(error) for sign in ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file")):
            raise
        if len(paths) == 1:
            return [(paths[0], str(error).split("\n", 1)[0][:300])]
    half = len(paths) // 2
    return _unreadable(spark, paths[:half]) + _unreadable(spark, paths[half:])


def damaged_files(read: DataFrame, spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of which some rows cannot be read, and how many.

    ``read`` is the frame of those files with what cannot be read left out, and
    with their ``_file``. The footers tell how many rows there should be. This
    reads all columns of the files once; it is meant for the batch that failed.
    """
    told = (
        spark.read.schema("Op string").option("ignoreCorruptFiles", "true").parquet(*paths)
        .groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("told"))
    )
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in read.columns if not c.startswith("_")])
    # Counted by value: a plain count would look at the footers again and read no column.
    got = read.groupBy("_file").agg((F.count_if(whole == 0) + F.count_if(whole != 0)).alias("got"))
    lost = F.col("told") - F.coalesce("got", F.lit(0))
    return told.join(got, "_file", "left").select(F.col("_file").alias("path"), lost.alias("lost_rows")).where("lost_rows > 0")


def damaged_blocks(read: DataFrame, spark: SparkSession, paths: list[str], block_bytes: int = RECOVERY_BYTES) -> DataFrame:
    """Blocks of which rows cannot be read: path, block (its first byte), lost_rows. ``read``: the files by blocks of the same size, with ``_block``."""
    one, settled = T.StructType([T.StructField("Op", T.StringType())]), lambda reader: reader.option("ignoreCorruptFiles", "true")
    told = _block_scans(_block_session(spark, block_bytes), paths, block_bytes, one, settled, glob="*", keep=("_file", "_block"))
    told = told.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("told"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in read.columns if not c.startswith("_")])
    got = read.groupBy("_file", "_block").agg((F.count_if(whole == 0) + F.count_if(whole != 0)).alias("got"))
    lost = F.col("told") - F.coalesce("got", F.lit(0))
    return told.join(got, ["_file", "_block"], "left").select(F.col("_file").alias("path"), F.col("_block").alias("block"), lost.alias("lost_rows")).where("lost_rows > 0")


def _plain_path(path: Column) -> Column:
    """Paths come as ``file:/x`` or ``file:///x`` depending on the source."""
    return F.regexp_replace(path, r"^([a-z0-9]+):/+", "$1:/")


def file_error_report(failed: DataFrame, root: str) -> DataFrame:
    """Failed files per source table, and a row with the total."""
    per_table = failed.groupBy(table_of_key(object_key(F.col("path"), root)).alias("source_table")).agg(
        F.count(F.lit(1)).alias("errors")
    )
    total = failed.agg(F.count(F.lit(1)).alias("errors")).select(F.lit("TOTAL").alias("source_table"), "errors")
    return per_table.unionByName(total)


# ---- ledger by time -------------------------------------------------------
#
# The plain ledger above is read whole by each discovery. This one keeps the
# processed files in folders by the hour of their time, and for each hour how
# many there are and the sum of their hashes. Discovery compares these with the
# listing and reads the hours that differ only: at steady state the last one, or
# the hour of a late file, however old it is.

_HOUR = "yyyy-MM-dd-HH"
_HOURS_SCHEMA = "hour string, n bigint, low bigint, mixed bigint"


def _by_hour(files: DataFrame) -> DataFrame:
    """Number and hashes of the files of each hour. A file that is written anew has another time and is another file."""
    h = F.xxhash64("path", "modificationTime")
    return files.groupBy(F.date_format("modificationTime", _HOUR).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.bit_xor(h).alias("mixed"))


def create_hour_ledger(spark: SparkSession, ledger_path: str) -> None:
    empty_frame(spark, LEDGER_SCHEMA).withColumn("hour", F.lit("")).write.mode("ignore").partitionBy("hour").parquet(f"{ledger_path}/files")
    spark.range(0).selectExpr("'' AS hour", "0L AS n", "0L AS low", "0L AS mixed").write.mode("ignore").parquet(f"{ledger_path}/hours")


def _hours(spark: SparkSession, ledger_path: str) -> DataFrame:
    """What the ledger holds of each hour: appended counts summed up."""
    told = spark.read.schema(_HOURS_SCHEMA).parquet(f"{ledger_path}/hours")
    return told.groupBy("hour").agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.bit_xor("mixed").alias("mixed"))


def read_hour_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    schema = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("hour", T.StringType())])
    return spark.read.schema(schema).parquet(f"{ledger_path}/files")


def hours_to_read(spark: SparkSession, files: DataFrame, ledger_path: str) -> list[str]:
    """Hours of the listing that the ledger does not hold as they are; a row for each such hour comes to the driver."""
    listed, told = _by_hour(files).alias("f"), _hours(spark, ledger_path).alias("l")
    same = F.lit(True)
    for c in ("n", "low", "mixed"):
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}"))
    pairs = listed.join(told, F.col("f.hour") == F.col("l.hour"), "left")
    return sorted(r["hour"] for r in pairs.where(~same).select("f.hour").collect())


def discover_new_files(spark: SparkSession, prefix: str | list[str], ledger_path: str, *, glob: str = PARQUET_GLOB) -> DataFrame:
    """Files below a prefix that the ledger by hours does not hold, oldest first."""
    files = discover_files(spark, prefix, glob=glob)
    hours = hours_to_read(spark, files, ledger_path)
    known = read_hour_ledger(spark, ledger_path).where(F.col("hour").isin(hours)).select("path", "modificationTime")
    open_ = files.where(F.date_format("modificationTime", _HOUR).isin(hours))
    return open_.join(known, ["path", "modificationTime"], "left_anti").orderBy("modificationTime", "path")


def mark_files_processed(spark: SparkSession, files: DataFrame, ledger_path: str) -> None:
    """Note files in the ledger by hours. If this stops after the files are noted and before the counts, discovery reads their hours again and finds them noted."""
    rows = files.select("path", "length", "modificationTime", F.current_timestamp().alias("processed_at"), F.date_format("modificationTime", _HOUR).alias("hour"))
    # The listing may have changed since; what is written is what counts.
    staged = f"{ledger_path}/staged"
    rows.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(T.StructType([*LEDGER_SCHEMA.fields, T.StructField("hour", T.StringType())])).parquet(staged)
    rows.write.mode("append").partitionBy("hour").parquet(f"{ledger_path}/files")
    _by_hour(rows).coalesce(1).write.mode("append").parquet(f"{ledger_path}/hours")


def compact_hours(spark: SparkSession, ledger_path: str) -> int:
    """Write the counts of the hours anew from the noted files, one row for each hour, and tell how many hours there are.

    Also mends counts that were not written because a job stopped. The files of an hour are noted twice
    if a job stopped and ran again; they count once.
    """
    counted = _by_hour(read_hour_ledger(spark, ledger_path).select("path", "modificationTime").distinct())
    staged = f"{ledger_path}/hours_staged"
    counted.coalesce(1).write.mode("overwrite").parquet(staged)
    spark.read.schema(_HOURS_SCHEMA).parquet(staged).write.mode("overwrite").parquet(f"{ledger_path}/hours")
    return spark.read.schema(_HOURS_SCHEMA).parquet(f"{ledger_path}/hours").count()
