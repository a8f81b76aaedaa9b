from __future__ import annotations

import os

import feeds as fd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_warehouse import HISTORY, TIMES, first, rows, second, versions

from tidestar.plans.warehouse import Warehouse
from tidestar.schemas import feed_schema
from tidestar.session import scratch_dir
from tidestar.sources import files
from tidestar.streaming import micro_batch


def local(path: str) -> str:
    return path.removeprefix("file:")


def land(feeds, root, mode="append"):
    for table, feed in feeds.items():
        feed.coalesce(1).write.mode(mode).option("compression", "gzip").parquet(f"{root}/dms-source/public/{table}")


@pytest.fixture
def root(spark):
    return scratch_dir(spark, "landing")


def test_discovery_and_ledger(spark, root):
    land(first(spark), root)
    prefix, ledger = f"{root}/dms-source", f"{root}/ledger"
    files.create_ledger(spark, ledger)
    found = files.discover_files(spark, prefix, ledger=files.read_ledger(spark, ledger))
    assert found.count() == 4
    times = [r["modificationTime"] for r in found.collect()]
    assert times == sorted(times)
    files.mark_processed(found, ledger)
    assert files.discover_files(spark, prefix, ledger=files.read_ledger(spark, ledger)).count() == 0
    land({"orders": second(spark)["orders"]}, root)
    assert files.discover_files(spark, prefix, ledger=files.read_ledger(spark, ledger)).count() == 1
    assert "KB" in files.file_catalog(found).first()["size_formatted"]


def test_empty_prefix(spark, root):
    os.makedirs(f"{local(root)}/dms-source")
    assert files.discover_files(spark, f"{root}/dms-source").isEmpty()


def test_other_name_of_the_time_column(spark, root):
    fd.customers(spark, ("I", 1, "a", "x", 0)).withColumnRenamed("Timestamp", "change_time").write.parquet(root)
    read = files.read_cdc_parquet(spark, root, "customers", ts_col="change_time")
    assert read.columns[-1] == "Timestamp" and read.first()["Timestamp"] == fd.at(0)


def test_routing_opens_only_the_files_of_the_table(spark, root):
    land(first(spark), root)
    scan = spark.read.schema(feed_schema("orders")).option("recursiveFileLookup", "true").parquet(f"{root}/dms-source")
    routed = files.route_by_table(scan, "orders", root)
    assert rows(routed, "id") == [(10,)]
    # A file of another table that cannot be read does no harm.
    with open(f"{local(root)}/dms-source/public/customers/part-bad.parquet", "w") as bad:
        bad.write("nothing")
    scan = spark.read.schema(feed_schema("orders")).option("recursiveFileLookup", "true").parquet(f"{root}/dms-source")
    assert rows(files.route_by_table(scan, "orders", root), "id") == [(10,)]


def test_corrupt_and_empty_files(spark, root):
    land(first(spark), root)
    fd.customers(spark).coalesce(1).write.mode("append").parquet(f"{root}/dms-source/public/customers")  # zero rows
    for table, content in (("customers", b"nothing"), ("orders", b"PAR1" + b"\0" * 40 + b"PAR1"), ("orders", b"")):
        name = f"{local(root)}/dms-source/public/{table}/bad-{len(content)}.parquet"
        with open(name, "wb") as bad:
            bad.write(content)
    failed = files.failed_files(spark, f"{root}/dms-source")
    names = sorted(os.path.basename(r["path"]) for r in failed.collect())
    # No Spark source lists a file of no bytes at all.
    assert names == ["bad-48.parquet", "bad-7.parquet"]
    assert rows(files.file_error_report(failed, root), "source_table", "errors") == [("TOTAL", 2), ("customers", 1), ("orders", 1)]
    good = files.read_cdc_parquet(spark, f"{root}/dms-source/public/customers", "customers", skip_corrupt=True)
    assert rows(good, "id") == [(1,), (2,)]


def test_stream_of_rows(spark, root):
    land(first(spark), root)
    stream = micro_batch.stream_cdc(spark, f"{root}/dms-source", root)
    query = (
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    assert rows(got.groupBy("source_table").count(), "source_table", "count") == [
        ("customers", 2), ("order_items", 1), ("orders", 1), ("products", 1),
    ]
    assert got.where("source_table = 'orders'").first()["customer_id"] == 1


def run(w, root, **options):
    micro_batch.start(w, f"{root}/dms-source", root, **options).awaitTermination()


def test_stream_into_the_warehouse(spark, root):
    w = Warehouse(spark, f"{root}/gold")
    options = {"clock": lambda n: F.lit(TIMES[n])}
    land(first(spark), root)
    with open(f"{local(root)}/dms-source/public/orders/bad.parquet", "w") as bad:
        bad.write("nothing")
    run(w, root, **options)
    assert versions(w) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    assert [os.path.basename(r["path"]) for r in w.failed_files().collect()] == ["bad.parquet"]
    run(w, root, **options)  # nothing new: no batch
    assert w.next_batch_id() == 1
    land(second(spark), root)
    run(w, root, **options)
    assert versions(w) == HISTORY
    assert rows(w.facts(), "order_id", "_batch_id") == [(10, 0), (11, 1)]


@pytest.mark.parametrize("max_files", [1, 2, 100])
def test_no_fact_is_lost_between_triggers(spark, root, max_files):
    w = Warehouse(spark, f"{root}/gold")
    for tables in (("order_items",), ("orders",), ("customers", "products")):  # items are the oldest files
        land({t: f.coalesce(1) for t, f in first(spark).items() if t in tables}, root)
    land({"unknown": first(spark)["orders"].coalesce(1)}, root)
    run(w, root, max_files=max_files)
    assert rows(w.facts(), "order_id") == [(10,)]
    assert w.pending_items().isEmpty()
    assert {r["reason"] for r in w.failed_files().collect()} == {micro_batch.UNKNOWN_TABLE}


def test_one_bad_price_does_not_stop_the_stream(spark, root):
    feeds = first(spark)
    feeds["order_items"] = fd.items(spark, ("I", 1, 10, 100, 5, "9.99", 0), ("I", 2, 10, 100, 6, "1.00", 0)).withColumn(
        "unit_price", F.when(F.col("quantity") == 6, F.lit(1e12)).otherwise(F.col("unit_price").cast("double")))
    land(feeds, root)
    w = Warehouse(spark, f"{root}/gold")
    run(w, root)
    assert rows(w.facts(), "quantity") == [(5,)]
    assert rows(w.pending_items(), "quantity", "reason") == [(6, "unit price too large")]


def test_valid_files_without_rows_are_not_failed(spark, root):
    import pyarrow as pa
    import pyarrow.parquet as pq

    land(first(spark), root)
    folder = f"{local(root)}/dms-source/public/customers"
    schema = pa.schema([("id", pa.int32()), ("name", pa.string())])
    pq.write_table(schema.empty_table(), f"{folder}/none.parquet")
    with pq.ParquetWriter(f"{folder}/group.parquet", schema) as out:
        out.write_batch(pa.RecordBatch.from_pylist([], schema))
    pq.write_table(schema.with_metadata({"note": "x" * 1_500_000}).empty_table(), f"{folder}/footer.parquet")
    whole = open(f"{folder}/footer.parquet", "rb").read()
    with open(f"{folder}/cut.parquet", "wb") as cut:
        cut.write(whole[:-200])
    failed = files.failed_files(spark, f"{root}/dms-source").collect()
    assert [os.path.basename(r["path"]) for r in failed] == ["cut.parquet"]
    assert failed[0]["reason"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tidestar.session import checkpoint_root

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(session)


def test_a_batch_that_fails_is_run_again(spark, root):
    w = Warehouse(spark, f"{root}/gold")
    land(first(spark), root)
    commit, calls = w._commit, []

    def fail_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return commit(*args)

    w._commit = fail_once
    with pytest.raises(Exception, match="executor lost"):
        run(w, root, clock=lambda n: F.lit(TIMES[n]))
    assert w.facts().isEmpty()
    run(w, root, clock=lambda n: F.lit(TIMES[n]))
    assert rows(w.facts(), "order_id", "_batch_id") == [(10, 0)]


def test_arrival_order_of_files(spark, root):
    feed = fd.customers(spark, ("I", 1, "first", "x", 0), ("I", 1, "second", "x", 0)).coalesce(1)
    feed.write.parquet(f"{root}/dms-source/public/customers")
    w = Warehouse(spark, f"{root}/gold")
    run(w, root)
    assert rows(w.dimension("dim_customer"), "name") == [("first",)]


def test_other_physical_types_are_converted_not_skipped(spark, root):
    """Ids as long, text and int, a time with a zone, a column that is missing and one that is new."""
    feeds = first(spark)
    land({
        "customers": feeds["customers"].drop("country").withColumn("id", F.col("id").cast("bigint")).withColumn(
            "Timestamp", F.col("Timestamp").cast("timestamp")),
        "products": feeds["products"].withColumn("id", F.col("id").cast("string")).withColumn("price", F.lit("9.99")),
        "orders": feeds["orders"].withColumn("channel", F.lit("web")),
        "order_items": feeds["order_items"].withColumn("id", F.col("id").cast("bigint")),
    }, root)
    land({"order_items": feeds["order_items"].withColumn("id", F.col("id") + 1)}, root)  # int beside long
    w = Warehouse(spark, f"{root}/gold")
    run(w, root)
    assert rows(w.dimension("dim_customer"), "customer_id", "country") == [(1, None), (2, None)]
    assert [(r["product_id"], str(r["unit_price"])) for r in w.dimension("dim_product").collect()] == [(100, "9.99")]
    assert w.facts().count() == 2
    assert w.failed_files().isEmpty()
    told = rows(w.schema_mismatches(), "source_table", "column_name", "data_type", "filled_rows", "lost_rows")
    assert {("customers", "id", "LONG", 2, 0), ("products", "id", "STRING", 1, 0), ("products", "price", "STRING", 1, 0)} <= set(told)


def test_damaged_content_is_reported(spark, root):
    feeds = first(spark)
    land(feeds, root)
    good = fd.customers(spark, *[("I", n, f"n{n}", "x", 0) for n in range(50, 60)])
    good.coalesce(1).write.option("compression", "none").mode("append").parquet(f"{root}/dms-source/public/customers")
    folder = f"{local(root)}/dms-source/public/customers"
    name = max((f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet")), key=os.path.getmtime)
    with open(name, "r+b") as file:
        file.seek(4)
        file.write(b"\xff" * 60)
    for crc in (n for n in os.listdir(folder) if n.endswith(".crc")):
        os.remove(f"{folder}/{crc}")
    w = Warehouse(spark, f"{root}/gold")
    run(w, root)
    assert rows(w.dimension("dim_customer"), "customer_id") == [(1,), (2,)]
    assert [(os.path.basename(r["path"]), r["lost_rows"]) for r in w.failed_files().collect()] == [(os.path.basename(name), 10)]
    assert w.facts().count() == 1


def damaged(spark, root, n=3000, groups=3):
    """Customers in a file of several row groups, the second of which has bad pages. Returns its path and the ids of each group."""
    import pyarrow.parquet as pq

    feed = fd.customers(spark, *[("I", i, f"name {i} " * 9, f"{i * 7919}", 0) for i in range(n)])
    folder = f"{local(root)}/dms-source/public/customers"
    feed.limit(1).coalesce(1).write.mode("append").parquet(f"{root}/dms-source/public/customers")
    path = f"{folder}/several.parquet"
    pq.write_table(feed.toArrow(), path, row_group_size=n // groups, compression="none", use_dictionary=False, write_page_checksum=True)
    group = pq.ParquetFile(path).metadata.row_group(1)
    names = [group.column(k) for k in range(group.num_columns) if group.column(k).path_in_schema == "name"][0]
    with open(path, "r+b") as file:
        file.seek(names.data_page_offset + names.total_compressed_size // 2)
        file.write(b"?" * 40)  # a changed text that only the checksum tells
    return path, [range(k * n // groups, (k + 1) * n // groups) for k in range(groups)]


def test_good_row_groups_of_a_damaged_file(spark, root):
    path, groups = damaged(spark, root)
    read = files.read_cdc_parquet(spark, path, "customers", skip_corrupt=True, arrival=True, block_bytes=30_000)
    assert sorted(r["id"] for r in read.collect()) == [*groups[0], *groups[2]]
    assert read.select("id").count() == 3000  # of a column that is not damaged nothing is lost
    lost = files.damaged_blocks(read, spark, [path], block_bytes=30_000).collect()
    assert [(os.path.basename(r["path"]), r["lost_rows"]) for r in lost] == [("several.parquet", len(groups[1]))]
    assert lost[0]["block"] > 0
    everything = files.read_cdc_parquet(spark, path, "customers", skip_corrupt=True, block_bytes=1 << 30)
    assert everything.select("Op", "name").where("length(name) > 0").count() < len(groups[0]) + len(groups[2])


def test_blocks_are_many_to_a_task(spark):
    root = scratch_dir(spark, "blocks")
    rows = spark.range(60_000).selectExpr("'I' AS Op", "id", "id % 7 AS customer_id", "date'2024-01-15' AS order_date", "'x' AS status", "cast(id AS decimal(12,2)) AS total", "timestamp_ntz'2024-01-15 00:00:00' AS Timestamp")
    rows.coalesce(1).write.option("parquet.block.size", 8_000).option("parquet.enable.dictionary", "false").option("compression", "none").parquet(root)
    read = files.read_cdc_parquet(spark, root, "orders", id_type=T.LongType(), skip_corrupt=True, arrival=True, block_bytes=3_000)
    tasks = files.BLOCK_TASKS * spark.sparkContext.defaultParallelism
    assert read.select("_block").distinct().count() > 2 * tasks
    assert read.rdd.getNumPartitions() <= 1.5 * tasks
    assert read.agg(F.sum("id")).first()[0] == sum(range(60_000))


def test_a_long_footer_is_not_read_for_each_block(spark):
    root = scratch_dir(spark, "footer")
    rows = spark.range(60_000).selectExpr("'I' AS Op", "id", "id % 7 AS customer_id", "date'2024-01-15' AS order_date", "'x' AS status", "cast(id AS decimal(12,2)) AS total", "timestamp_ntz'2024-01-15 00:00:00' AS Timestamp")
    rows.coalesce(1).write.option("parquet.block.size", 8_000).option("parquet.enable.dictionary", "false").option("compression", "none").parquet(root)
    path = next(f"{local(root)}/{n}" for n in os.listdir(local(root)) if n.endswith(".parquet"))
    with open(path, "r+b") as file:
        file.seek(os.path.getsize(path) // 3)
        file.write(b"?" * 64)
    os.remove(f"{local(root)}/.{os.path.basename(path)}.crc")
    read = files.read_cdc_parquet(spark, root, "orders", id_type=T.LongType(), skip_corrupt=True, arrival=True, block_bytes=3_000)
    opened = sum(os.path.getsize(name.removeprefix("file:").replace("///", "/")) for name in read.inputFiles())
    assert len(read.inputFiles()) > 1 and opened < 1.5 * os.path.getsize(path)
    whole = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at")).first()
    got = read.select("id", "_row", "_file", "_file_time", "_block", *[c for c in read.columns if c[0] != "_" and c != "id"]).collect()
    assert all(r["id"] == r["_row"] for r in got) and {(r["_file"], r["_file_time"]) for r in got} == {tuple(whole)}
    lost = files.damaged_blocks(read, spark, [path], 3_000).collect()
    assert len(lost) == 1 and lost[0]["path"] == whole["path"] and lost[0]["lost_rows"] + len(got) == 60_000
    blocks = [r["_block"] for r in got]
    assert min(blocks) < lost[0]["block"] < max(blocks) and abs(lost[0]["block"] - os.path.getsize(path) // 3) < 16_000
