"""All registered queries by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import functions as fn
from tidestar import operators as op
from tidestar.plans import analytics, catalog, quality, star, time_travel
from tidestar.plans.report_sums import ReportSums
from tidestar.plans.star import row_counts
from tidestar.plans.warehouse import Warehouse
from tidestar.schemas import SOURCE_TABLES, STAR_TABLES, WIDE_ID, feed_schema
from tidestar.session import scratch_dir
from tidestar.sources import files, synth, untyped
from tidestar.sources import sample_feed as sf
from tidestar.streaming import keyed_state, micro_batch
from tidestar.suite import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _won(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Winning changes. Only item changes take their times from a table, so only those are probed for nulls."""
    feed = sf.FEEDS[table](spark, sf_dir)
    probe = table == "order_items" and op.has_null_timestamps(feed)
    return op.dedup_changes(feed, seq=sf.ARRIVAL[table], null_timestamps=probe)


# ---- sources, ingest, sinks, tables ------------------------------------


def _rows_per_file(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.schema("Op string").option("recursiveFileLookup", "true").parquet(f"{root}/{files.RAW_PREFIX}")
    plain = files._plain_path(F.col("_metadata.file_path"))
    return rows.groupBy(plain.alias("path")).agg(F.count(F.lit(1)).alias("n"))


def _rows_per_table(listed: DataFrame, per_file: DataFrame, root: str) -> DataFrame:
    table = files.table_of_key(files.object_key(F.col("path"), root))
    return listed.select(files._plain_path(F.col("path")).alias("path")).join(per_file, "path").groupBy(
        table.alias("source_table")
    ).agg(F.sum("n").alias("n_rows"))


@query
def discover_files(spark, sf_dir):
    """Rows of the files that discovery still finds once customers and products are processed."""
    root = fx.landing(spark, sf_dir)
    ledger = scratch_dir(spark, "ledger")
    for table in ("customers", "products"):
        files.mark_processed(files.discover_files(spark, f"{root}/{files.RAW_PREFIX}/public/{table}"), ledger)
    found = files.discover_files(spark, f"{root}/{files.RAW_PREFIX}", ledger=files.read_ledger(spark, ledger))
    return _rows_per_table(found, _rows_per_file(spark, root), root)


@query
def processed_ledger(spark, sf_dir):
    """Rows of processed files per table, and how many files are found again."""
    root = fx.landing(spark, sf_dir)
    ledger = scratch_dir(spark, "ledger")
    files.create_ledger(spark, ledger)
    prefix = f"{root}/{files.RAW_PREFIX}"
    files.mark_processed(files.discover_files(spark, prefix, ledger=files.read_ledger(spark, ledger)), ledger)
    done = files.read_ledger(spark, ledger)
    again = files.discover_files(spark, prefix, ledger=done).count()
    return _rows_per_table(done, _rows_per_file(spark, root), root).withColumn("found_again", F.lit(again).cast("bigint"))


@query
def hour_ledger(spark, sf_dir):
    """Rows of the files noted in the ledger by hours, in two steps, with the hours that the second and a third discovery had to read."""
    root = fx.landing(spark, sf_dir)
    ledger, prefix = scratch_dir(spark, "ledger"), f"{root}/{files.RAW_PREFIX}"
    files.create_hour_ledger(spark, ledger)
    first = files.discover_new_files(spark, f"{prefix}/public/orders", ledger)
    files.mark_files_processed(spark, first, ledger)
    files.mark_files_processed(spark, files.discover_new_files(spark, prefix, ledger), ledger)
    files.compact_hours(spark, ledger)
    left = len(files.hours_to_read(spark, files.discover_files(spark, prefix), ledger))
    return _rows_per_table(files.read_hour_ledger(spark, ledger), _rows_per_file(spark, root), root).withColumn("hours_left", F.lit(left).cast("bigint"))


@query
def file_catalog(spark, sf_dir):
    """Of the catalogued files of each table: their rows, whether all names and printed sizes are as they should be."""
    root = fx.landing(spark, sf_dir)
    listed = files.file_catalog(files.discover_files(spark, f"{root}/{files.RAW_PREFIX}"))
    number, unit = F.split("size_formatted", " ")[0].cast("double"), F.split("size_formatted", " ")[1]
    factor = F.element_at(F.create_map(F.lit("B"), F.lit(1), F.lit("KB"), F.lit(1 << 10), F.lit("MB"), F.lit(1 << 20), F.lit("GB"), F.lit(1 << 30)), unit)
    fits = (F.abs(number * factor - F.col("length")) <= 0.05001 * factor) & ((factor == 1) | (F.col("length") >= factor))
    checked = listed.select(
        F.col("uri").alias("path"), F.col("uri").endswith(".parquet").alias("named"), fits.alias("fits"), F.col("modificationTime").isNotNull().alias("timed"),
    )
    told = checked.groupBy(files.table_of_key(files.object_key(F.col("path"), root)).alias("source_table")).agg(
        F.bool_and("named").alias("all_parquet"), F.bool_and("fits").alias("sizes_agree"), F.bool_and("timed").alias("all_timed"),
    )
    return told.join(_rows_per_table(checked, _rows_per_file(spark, root), root), "source_table")


@query
def size_formatted(spark, sf_dir):
    """Sizes from bytes to gigabytes, made from order totals."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    scaled = F.when(F.col("o_orderpriority") < "2", F.pmod(cents, F.lit(1024))).when(
        F.col("o_orderpriority") < "4", cents
    ).otherwise(cents * 1000)
    return sf.read(spark, sf_dir, "orders").select("o_orderkey", scaled.alias("size")).select(
        "o_orderkey", "size", files.size_formatted(F.col("size")).alias("size_text")
    )


@query
def read_cdc_parquet(spark, sf_dir):
    root = fx.landing(spark, sf_dir)
    return files.read_cdc_parquet(spark, f"{root}/{files.RAW_PREFIX}/public/order_items", "order_items", id_type=WIDE_ID)


@query
def stream_cdc(spark, sf_dir):
    """All change rows through one stream, counted per table and operation."""
    root, out = fx.landing(spark, sf_dir), scratch_dir(spark, "stream")
    rows = micro_batch.stream_cdc(spark, f"{root}/{files.RAW_PREFIX}", root, id_type=WIDE_ID)
    stream = (
        rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{out}/rows").groupBy("source_table", "Op").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
    )


@query
def skip_corrupt_files(spark, sf_dir):
    """The good rows of folders that also hold an unreadable file."""
    root = fx.broken_landing(spark, sf_dir)
    return _union([
        files.read_cdc_parquet(
            spark, f"{root}/{files.RAW_PREFIX}/public/{table}", table, id_type=WIDE_ID, skip_corrupt=True, glob="part-*",
        ).select(F.lit(table).alias("source_table"), "Op", "id", "Timestamp")
        for table in SOURCE_TABLES
    ])


@query
def row_group_recovery(spark, sf_dir):
    """Of a file with one damaged row group: rows kept and lost together, blocks lost, and whether rows behind the damage are kept."""
    path = fx.damaged_file(spark, sf_dir)
    read = files.read_cdc_parquet(spark, path, "orders", id_type=WIDE_ID, skip_corrupt=True, arrival=True, block_bytes=fx.SMALL_BLOCK)
    lost = files.damaged_blocks(read, spark, [path], fx.SMALL_BLOCK).agg(F.sum("lost_rows").alias("lost"), F.count(F.lit(1)).alias("blocks_lost"), F.min("block").alias("at"))
    h = F.xxhash64(*[c for c in read.columns if not c.startswith("_")])
    kept = read.join(F.broadcast(lost)).groupBy("lost", "blocks_lost").agg((F.count_if(h % 2 == 0) + F.count_if(h % 2 != 0)).alias("kept"), F.count_if(F.col("_block") > F.col("at")).alias("behind"))
    return kept.select((F.col("kept") + F.col("lost")).alias("n_rows"), "blocks_lost", (F.col("behind") > 0).alias("rows_behind"))


@query
def file_error_report(spark, sf_dir):
    root = fx.broken_landing(spark, sf_dir)
    failed = files.failed_files(spark, f"{root}/{files.RAW_PREFIX}", glob="part-*")
    return files.file_error_report(failed, root)


@query
def route_by_table(spark, sf_dir):
    """Rows of one scan over all tables' files, told apart by path."""
    root = fx.landing(spark, sf_dir)
    parts = []
    for table in SOURCE_TABLES:
        rows = (
            spark.read.schema(feed_schema(table, WIDE_ID)).option("recursiveFileLookup", "true")
            .parquet(f"{root}/{files.RAW_PREFIX}")
        )
        parts.append(
            files.route_by_table(rows, table, root).select(F.lit(table).alias("source_table"), "Op", "id")
            .groupBy("source_table", "Op").agg(F.count(F.lit(1)).alias("n_rows"), F.max("id").alias("max_id"))
        )
    return _union(parts)


def _streamed(warehouse: Warehouse) -> DataFrame:
    """Rows of the star tables and of the waiting items, and the revenue."""
    counts = row_counts({
        "dim_customer": warehouse.dimension("dim_customer"),
        "dim_product": warehouse.dimension("dim_product"),
        "dim_date": warehouse.dates(),
    }).withColumn("amount", F.lit(None).cast(analytics.TOTAL))
    facts = warehouse.facts().agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").cast(analytics.TOTAL).alias("amount"))
    return counts.unionByName(facts.withColumn("table_name", F.lit("fact_orders")))


@query
def process_batch(spark, sf_dir):
    """Landing files through the stream into a warehouse, then its row counts and revenue."""
    root = fx.landing(spark, sf_dir)
    warehouse = fx.new_warehouse(spark, sf_dir, "stream")
    stream = micro_batch.start(
        warehouse, f"{root}/{files.RAW_PREFIX}", root, clock=lambda _: sf.at(fx.BATCH_AT), arrival=sf.ARRIVAL,
    )
    stream.awaitTermination()
    return _streamed(warehouse)


@query
def process_batch_split(spark, sf_dir):
    """Every table's changes in a batch of its own, the items first: each waits until its order and product are there."""
    warehouse = fx.new_warehouse(spark, sf_dir, "split")
    warehouse.create_tables()
    feeds = sf.sample_feed(spark, sf_dir)
    for batch_id, table in enumerate(("order_items", "orders", "customers", "products")):
        warehouse.write_batch({table: feeds[table]}, sf.ARRIVAL, batch_id, sf.at(fx.BATCH_AT), null_timestamps=False)
    return _streamed(warehouse)


@query
def batch_checks(spark, sf_dir):
    """What is measured while a batch is written, without limits and with one that keeps it from being committed, and the facts seen after it."""
    result = []
    for limits in ({}, {"rejected_items": 0, "largest_total": 1e12}):
        warehouse = fx.new_warehouse(spark, sf_dir, "checks")
        warehouse.limits = limits
        warehouse.create_tables()
        warehouse.write_batch(sf.sample_feed(spark, sf_dir), sf.ARRIVAL, 0, sf.at(fx.BATCH_AT), null_timestamps=False)
        told = warehouse.quarantined() if limits else warehouse.batch_metrics().where("metric IN ('judged_items', 'rejected_items', 'facts', 'mismatched_totals')")
        seen = warehouse.facts().agg(F.count(F.lit(1)).alias("facts_seen"))
        result.append(told.join(F.broadcast(seen)).select("metric", F.col("value").cast("bigint").alias("value"), F.col("limit_value").cast("bigint").alias("limit_value"), "facts_seen"))
    return _union(result)


@query
def pending_items(spark, sf_dir):
    """What waits, and why, while the customers have not come yet."""
    warehouse = fx.new_warehouse(spark, sf_dir, "pending")
    warehouse.create_tables()
    feeds = sf.sample_feed(spark, sf_dir)
    for batch_id, tables in enumerate((("order_items",), ("orders", "products"))):
        warehouse.write_batch({t: feeds[t] for t in tables}, sf.ARRIVAL, batch_id, sf.at(fx.BATCH_AT), null_timestamps=False)
    return warehouse.pending_items().select("order_id", "product_id", "quantity", "unit_price", "reason", "since")


@query
def keyed_state_star(spark, sf_dir):
    """Landing files through keyed state into a warehouse, then its row counts and revenue."""
    root = fx.landing(spark, sf_dir)
    warehouse = fx.new_warehouse(spark, sf_dir, "keyed")
    keyed_state.start(warehouse, f"{root}/{files.RAW_PREFIX}", clock=sf.at(fx.BATCH_AT), arrival=sf.ARRIVAL).awaitTermination()
    return _streamed(warehouse)


def _landed_apart(spark: SparkSession, sf_dir: str, *tables: tuple[str, ...]) -> Warehouse:
    """A warehouse fed from keyed state; the query stops after each group of tables and starts again from its checkpoint."""
    root, warehouse = scratch_dir(spark, "apart"), fx.new_warehouse(spark, sf_dir, "keyed")
    feeds = sf.sample_feed(spark, sf_dir)
    for group in tables:
        for table in group:
            feeds[table].write.parquet(f"{root}/{files.RAW_PREFIX}/public/{table}")
        keyed_state.start(warehouse, f"{root}/{files.RAW_PREFIX}", clock=sf.at(fx.BATCH_AT), arrival=sf.ARRIVAL).awaitTermination()
    return warehouse


@query
def keyed_state_restarted(spark, sf_dir):
    """Items first, then orders, customers and products, the stream started anew for each."""
    return _streamed(_landed_apart(spark, sf_dir, ("order_items",), ("orders",), ("customers",), ("products",)))


@query
def keyed_state_waiting(spark, sf_dir):
    """What waits in the state, and why, while the customers have not come yet."""
    warehouse = _landed_apart(spark, sf_dir, ("order_items",), ("orders", "products"))
    return keyed_state.waiting_items(warehouse).select("order_id", "product_id", "quantity", "unit_price", "reason")


@query
def create_star_tables(spark, sf_dir):
    database = fx.catalog_database(spark, sf_dir)
    widths = [(t, len(spark.table(f"{database}.{t}").columns)) for t in STAR_TABLES]
    return spark.createDataFrame(widths, "table_name string, n_columns int").join(
        catalog.registered_counts(spark, database), "table_name"
    )


@query
def append_star_tables(spark, sf_dir):
    return spark.table(f"{fx.catalog_database(spark, sf_dir)}.fact_orders").drop("order_day")


@query
def fact_day_partition(spark, sf_dir):
    facts = spark.table(f"{fx.catalog_database(spark, sf_dir)}.fact_orders")
    return facts.groupBy("order_day").agg(
        F.count(F.lit(1)).alias("n_facts"), F.sum("total_amount").cast(analytics.TOTAL).alias("amount")
    )


@query
def evolve_add_columns(spark, sf_dir):
    """Inserts without a country column, then updates that have one."""
    feed = sf.customers_feed(spark, sf_dir)
    return op.evolve_union(feed.where("Op = 'I'").drop("country"), feed.where("Op = 'U'"))


@query
def schema_mismatch_report(spark, sf_dir):
    """Line items that arrive with other column types than declared."""
    batch = sf.read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_returnflag").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )
    return op.schema_mismatches(feed_schema("order_items", WIDE_ID), batch)


@query
def register_tables(spark, sf_dir):
    """Star tables under a second database name, with merged properties."""
    root = fx.gold_root(spark, sf_dir)
    database = "tidestar_registered_" + scratch_dir(spark, "names")[-12:]
    catalog.ensure_database(spark, database, scratch_dir(spark, "registered"))
    for properties in ({"layer": "raw", "origin": "feed"}, catalog.TABLE_PROPERTIES):
        for table in STAR_TABLES:
            catalog.register_table(spark, database, table, f"{root}/{table}", properties)
    properties = catalog.table_properties(spark, database).where(F.col("key").isin("layer", "origin"))
    return properties.join(F.broadcast(catalog.registered_counts(spark, database)), "table_name")


@query
def verify_tables(spark, sf_dir):
    """The star tables and one that nobody made."""
    database = fx.catalog_database(spark, sf_dir)
    found = catalog.verify_tables(spark, database, (*STAR_TABLES, "fact_returns"))
    return found.join(catalog.registered_counts(spark, database), "table_name", "left")


@query
def delete_from_fact(spark, sf_dir):
    """Facts left after a hard delete of all orders of status P."""
    gone = sf.orders_feed(spark, sf_dir).where("status = 'P'").select(F.col("id").alias("order_id"))
    return op.delete_facts(fx.gold(spark, sf_dir)["fact_orders"], gone)


@query
def snapshot_diff_cdc(spark, sf_dir):
    """Changes between two states of the customers table."""
    columns = ["id", "name", "email", "city", "country"]
    feed = sf.customers_feed(spark, sf_dir)
    before = feed.where("Op = 'I'").where("country <> 'ASIA'").select(*columns)
    won = _won(spark, sf_dir, "customers")
    return op.snapshot_diff(before, won.where("Op <> 'D'").select(*columns), sf.at(sf.UPDATED_AT))


@query
def snapshot_diff_digest(spark, sf_dir):
    """The same changes, found by digests of buckets."""
    columns = ["id", "name", "email", "city", "country"]
    before = sf.customers_feed(spark, sf_dir).where("Op = 'I'").where("country <> 'ASIA'").select(*columns)
    won = _won(spark, sf_dir, "customers")
    return op.snapshot_diff_by_digest(before, won.where("Op <> 'D'").select(*columns), sf.at(sf.UPDATED_AT))


@query
def snapshot_diff_few(spark, sf_dir):
    """Orders of which one in a hundred changed, some came and some went: changes from changed buckets, and the share of rows they hold."""
    orders = sf.orders_feed(spark, sf_dir).select("id", "customer_id", "order_date", "status", "total")
    after = orders.where("id % 500 <> 7").withColumn("status", F.when(F.col("id") % 400 == 9, "X").otherwise(F.col("status")))
    changes = op.snapshot_diff_by_digest(orders.where("id % 600 <> 11"), after, sf.at(sf.UPDATED_AT), buckets=op.BUCKETS * 16)
    return changes.groupBy("Op").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("id").alias("ids"), F.sum("total").cast(analytics.TOTAL).alias("amount"))


def _pruned(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The three batches, then two deletes, a compaction, and a delete from the compacted files."""

    def write() -> Warehouse:
        warehouse = fx.new_warehouse(spark, sf_dir, "pruned")
        warehouse.create_tables()
        for batch_id, feeds in enumerate(fx.batches(spark, sf_dir)):
            warehouse.write_batch(feeds, sf.ARRIVAL, batch_id, sf.at(sf.INSERTED_AT), null_timestamps=False)
        orders = sf.orders_feed(spark, sf_dir).select(F.col("id").alias("order_id"), "status", "order_date")
        warehouse.delete_from_fact(orders.where("status = 'P'"), 3, sf.at(sf.UPDATED_AT))
        warehouse.delete_from_fact(orders.where("order_id % 5 = 0"), 4, sf.at(sf.UPDATED_AT))
        warehouse.compact_facts(5, sf.at(sf.DELETED_AT), rows_per_file=20_000)
        warehouse.delete_from_fact(orders.where("order_id % 7 = 0"), 6, sf.at(sf.DELETED_AT))
        return warehouse

    return fx.once(spark, sf_dir, "pruned", write)


@query
def deletion_vectors(spark, sf_dir):
    """Facts of each version left by deletes that mark positions in files, before and after a compaction."""
    warehouse = _pruned(spark, sf_dir)
    return _union([
        warehouse.facts(version=v).agg(F.count(F.lit(1)).alias("n_facts"), F.sum("total_amount").cast(analytics.TOTAL).alias("amount")).withColumn("version", F.lit(v))
        for v in (2, 3, 4, 5, 6)
    ])


@query
def deleted_rows(spark, sf_dir):
    """Facts that each delete marked, counted in its bitmaps."""
    return _pruned(spark, sf_dir).deleted_rows().select(F.col("_batch_id").alias("batch_id"), "deleted")


@query
def compacted_facts(spark, sf_dir):
    """All facts left, most of them from the compacted files."""
    return _pruned(spark, sf_dir).facts().drop("order_month")


@query
def compacted_range(spark, sf_dir):
    """Facts of a quarter, from the files of the compaction that can hold any."""
    days = (dt.date(1995, 4, 1), dt.date(1995, 6, 30))
    return _pruned(spark, sf_dir).facts(days=days).drop("order_month")


def _kept(spark: SparkSession, sf_dir: str, kind: str) -> ReportSums:
    """Sums of one kind of the batches, deletes and compaction of ``_pruned``, each taken from its own rows."""
    return fx.once(spark, sf_dir, f"sums_{kind}", lambda: _refreshed(ReportSums(_pruned(spark, sf_dir), [kind])))


def _refreshed(sums: ReportSums) -> ReportSums:
    sums.refresh()
    return sums


@query
def kept_daily_sales(spark, sf_dir):
    return _kept(spark, sf_dir, "days").daily_sales()


@query
def kept_quarter_category(spark, sf_dir):
    return _kept(spark, sf_dir, "quarters").quarter_category()


@query
def kept_category_totals(spark, sf_dir):
    return _kept(spark, sf_dir, "pairs").category_totals()


@query
def kept_top_customers(spark, sf_dir):
    return _kept(spark, sf_dir, "pairs").top_customers()


# ---- scalar functions ---------------------------------------------------


@query
def op_priority(spark, sf_dir):
    feed = sf.customers_feed(spark, sf_dir)
    return feed.select("id", "Op", fn.op_priority(F.col("Op")).alias("priority"))


@query
def surrogate_key(spark, sf_dir):
    return sf.read(spark, sf_dir, "customer").select(
        "c_custkey", fn.surrogate_key("dim_customer", F.col("c_custkey")).alias("customer_key"),
        fn.surrogate_key("dim_customer", F.col("c_name")).alias("name_key"),
    )


@query
def surrogate_key_composite(spark, sf_dir):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return sf.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag",
        fn.surrogate_key("fact_orders", F.col("l_orderkey"), F.col("l_partkey")).alias("order_sk"),
        fn.surrogate_key("fact_orders", F.col("l_orderkey"), flag).alias("flag_sk"),
    )


@query
def md5_hex(spark, sf_dir):
    return sf.read(spark, sf_dir, "documents").select("doc_id", fn.md5_hex(F.col("text")).alias("digest"))


def _lines(spark: SparkSession, feed: DataFrame) -> DataFrame:
    """The feed as JSON lines, read back without a schema."""
    root = scratch_dir(spark, "untyped")
    feed.select(F.to_json(F.struct("*"))).write.text(root)
    return untyped.read_lines(spark, root, glob="part-*")


@query
def untyped_star(spark, sf_dir):
    """Row counts of the star from feeds that come as JSON lines."""
    feeds = {table: untyped.typed_feed(_lines(spark, feed), table, WIDE_ID) for table, feed in sf.sample_feed(spark, sf_dir).items()}
    return star.transform_star(spark, feeds, sf.ARRIVAL, sf.at(fx.BATCH_AT), id_type=WIDE_ID, null_timestamps=False).summary()


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose product is a number, a text of digits or another text, by return flag."""
    lines = sf.read(spark, sf_dir, "lineitem")
    head, tail = F.concat(F.lit('{"id":'), F.col("l_orderkey").cast("string"), F.lit(',"product_id":')), F.lit("}")
    number = F.col("l_partkey").cast("string")
    value = F.when(F.col("l_returnflag") == "A", number).when(F.col("l_returnflag") == "N", F.concat(F.lit('"'), number, F.lit('"'))).otherwise(F.concat(F.lit('"p'), number, F.lit('"')))
    root = scratch_dir(spark, "untyped")
    lines.select(F.concat(head, value, tail)).write.text(root)
    return untyped.read_lines(spark, root, glob="part-*")


@query
def untyped_mixed_fields(spark, sf_dir):
    return untyped.mixed_fields(_mixed(spark, sf_dir))


@query
def untyped_lost_values(spark, sf_dir):
    return untyped.lost_values(_mixed(spark, sf_dir), "order_items", WIDE_ID)


@query
def to_string_safe(spark, sf_dir):
    orders = sf.orders_feed(spark, sf_dir)
    return orders.select(
        "id", *[fn.to_string_safe(F.col(c)).alias(f"{c}_text") for c in ("customer_id", "order_date", "status", "total")]
    )


@query
def to_int_safe(spark, sf_dir):
    text, number = T.StringType(), T.DoubleType()
    brand = F.replace("p_brand", F.lit("Brand#"), F.lit(""))
    return sf.read(spark, sf_dir, "part").select(
        "p_partkey",
        fn.to_int_safe(brand, text).alias("brand_no"),
        fn.to_int_safe(F.col("p_name"), text).alias("name_no"),
        fn.to_int_safe(F.concat(brand, F.lit(".5")), text).alias("fraction_no"),
        fn.to_int_safe(F.col("p_retailprice"), number).alias("whole_price"),
        fn.to_int_safe(F.when(F.col("p_size") > 10, F.col("p_size")), T.IntegerType()).alias("large_size"),
    )


@query
def to_decimal_safe(spark, sf_dir):
    return sf.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        fn.to_decimal_safe(F.col("l_extendedprice"), T.DoubleType()).alias("price"),
        fn.to_decimal_safe(F.col("l_returnflag"), T.StringType()).alias("flag"),
        fn.to_decimal_safe(F.concat(F.col("l_linenumber").cast("string"), F.lit(".25")), T.StringType()).alias("line"),
        fn.to_decimal_safe(F.concat(F.floor(F.col("l_extendedprice") * 10_000).cast("string"), F.lit(".5")), T.StringType()).alias("wide_text"),
        fn.to_decimal_safe(F.floor(F.col("l_extendedprice") * 10_000), T.LongType()).alias("wide"),
    )


@query
def to_timestamp_safe(spark, sf_dir):
    events = sf.read(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    return events.select(
        "event_id",
        fn.to_timestamp_safe(F.col("ts"), kind).alias("stamp"),
        fn.to_timestamp_safe(F.col("ts").cast("date"), T.DateType()).alias("midnight"),
        fn.to_timestamp_safe(F.col("event_type"), T.StringType()).alias("none"),
    )


@query
def to_date_safe(spark, sf_dir):
    events = sf.read(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    return events.select(
        "event_id",
        fn.to_date_safe(F.col("ts"), kind).alias("day"),
        fn.to_date_safe(F.col("user_id"), T.LongType()).alias("none"),
    )


def _per_table(frames: dict[str, DataFrame], profile: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return _union([profile(frame).withColumn("table_name", F.lit(table)) for table, frame in frames.items()])


@query
def infer_column_types(spark, sf_dir):
    return _per_table(sf.sample_feed(spark, sf_dir), fn.infer_column_types)


@query
def type_name(spark, sf_dir):
    """Printed type and filled rows of every column of the star tables."""
    result = []
    for table, frame in fx.gold(spark, sf_dir).items():
        names = F.create_map(*[F.lit(x) for f in frame.schema.fields for x in (f.name, fn.type_name(f.dataType))])
        result.append(fn.column_profile(frame).select(
            F.lit(table).alias("table_name"), "column_name", names[F.col("column_name")].alias("type_name"), "filled_rows",
        ))
    return _union(result)


@query
def column_optionality(spark, sf_dir):
    return _per_table(fx.gold(spark, sf_dir), lambda frame: fn.column_profile(frame).select("column_name", "is_optional"))


@query
def date_to_epoch_day(spark, sf_dir):
    orders = sf.orders_feed(spark, sf_dir)
    return orders.select("id", fn.date_to_epoch_day(F.col("order_date"), T.DateType()).alias("epoch_day"))


@query
def ts_to_epoch_micros(spark, sf_dir):
    events = sf.read(spark, sf_dir, "events")
    kind = events.schema["ts"].dataType
    return events.select("event_id", fn.ts_to_epoch_micros(F.col("ts"), kind).alias("micros"))


@query
def batch_summary(spark, sf_dir):
    """Rows of each table of a batch and of all together."""
    counts = row_counts(fx.gold(spark, sf_dir))
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty"),
    )


# ---- dedup, dimensions, facts, history ---------------------------------


@query
def dedup_customers(spark, sf_dir):
    return _won(spark, sf_dir, "customers")


@query
def dedup_products(spark, sf_dir):
    return _won(spark, sf_dir, "products")


@query
def dedup_orders(spark, sf_dir):
    return _won(spark, sf_dir, "orders")


@query
def dedup_order_items(spark, sf_dir):
    return _won(spark, sf_dir, "order_items")


@query
def dedup_missing_times(spark, sf_dir):
    """Items of flag N arrive without a time, and those shipped in 1995 or before without an operation."""
    lines = sf.read(spark, sf_dir, "lineitem")
    feed = lines.select(
        F.when(F.year("l_shipdate") > 1996, "I").alias("Op"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_partkey") + 1).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("timestamp_ntz")).alias("Timestamp"),
    )
    return op.dedup_changes(feed, seq=sf.ARRIVAL["order_items"])


@query
def build_dim_customer(spark, sf_dir):
    return op.build_dim_customer(_won(spark, sf_dir, "customers"), sf.at(fx.BATCH_AT), WIDE_ID)


@query
def build_dim_product(spark, sf_dir):
    return op.build_dim_product(_won(spark, sf_dir, "products"), sf.at(fx.BATCH_AT), WIDE_ID)


@query
def build_dim_date(spark, sf_dir):
    return op.build_dim_date(_won(spark, sf_dir, "orders"))


def _fact_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    stamp = sf.at(fx.BATCH_AT)
    return (
        _won(spark, sf_dir, "orders"),
        _won(spark, sf_dir, "order_items"),
        op.build_dim_customer(_won(spark, sf_dir, "customers"), stamp, WIDE_ID),
        op.build_dim_product(_won(spark, sf_dir, "products"), stamp, WIDE_ID),
    )


@query
def build_fact_orders(spark, sf_dir):
    return op.build_fact_orders(
        *_fact_inputs(spark, sf_dir), id_type=WIDE_ID, raw=sf.sample_feed(spark, sf_dir),
    )


@query
def build_fact_orders_salted(spark, sf_dir):
    """The same facts with so low a bound that many keys are heavy."""
    return op.build_fact_orders(
        *_fact_inputs(spark, sf_dir), id_type=WIDE_ID, skew=op.SkewPolicy(rows=20), raw=sf.sample_feed(spark, sf_dir),
    )


@query
def fact_rejects(spark, sf_dir):
    """Rejected items where the orders of status O are missing as well."""
    orders, items, customers, products = _fact_inputs(spark, sf_dir)
    return op.fact_rejects(
        orders.where("status <> 'O'"), items, customers, products, id_type=WIDE_ID,
        raw=sf.sample_feed(spark, sf_dir),
    )


@query
def transform_star(spark, sf_dir):
    """Row counts of the star straight from the feeds."""
    return fx.literal_star(spark, sf_dir).summary()


def _merged(spark: SparkSession, sf_dir: str, dim: op.Dimension, feed: str, until: int = 3) -> DataFrame:
    """A dimension after the first batches (inserts, updates, deletes)."""
    build = {"dim_customer": op.build_dim_customer, "dim_product": op.build_dim_product}[dim.table]
    changes = sf.FEEDS[feed](spark, sf_dir)
    state = None
    for code, when in (("I", sf.INSERTED_AT), ("U", sf.UPDATED_AT), ("D", sf.DELETED_AT))[:until]:
        won = op.dedup_changes(changes.where(F.col("Op") == code), seq=sf.ARRIVAL[feed], null_timestamps=False)
        batch = build(won, sf.at(when), WIDE_ID)
        state = batch if state is None else op.scd2_merge(state, batch, dim, sf.at(when))
    return state


@query
def scd2_merge_customer(spark, sf_dir):
    return _merged(spark, sf_dir, op.CUSTOMER, "customers")


@query
def scd2_merge_product(spark, sf_dir):
    return _merged(spark, sf_dir, op.PRODUCT, "products")


@query
def scd2_history(spark, sf_dir):
    return op.scd2_history(
        sf.customers_feed(spark, sf_dir), seq=sf.ARRIVAL["customers"],
    )


@query
def scd2_history_items(spark, sf_dir):
    return op.scd2_history(
        sf.order_items_feed(spark, sf_dir), seq=sf.ARRIVAL["order_items"],
    )


@query
def scd2_history_items_spread(spark, sf_dir):
    """The same history with so low a bound that many keys are heavy."""
    return op.scd2_history(
        sf.order_items_feed(spark, sf_dir), seq=sf.ARRIVAL["order_items"], skew=op.SkewPolicy(rows=1),
    )


@query
def scd2_delete_expire(spark, sf_dir):
    """Versions that the batch of deletes closes."""
    state = _merged(spark, sf_dir, op.CUSTOMER, "customers", until=2)
    gone = op.dedup_changes(
        sf.customers_feed(spark, sf_dir).where("Op = 'D'"), seq=sf.ARRIVAL["customers"], null_timestamps=False,
    )
    stamp = sf.at(sf.DELETED_AT)
    batch = op.build_dim_customer(gone, stamp, WIDE_ID)
    return op.scd2_changes(state.where("is_current"), batch, op.CUSTOMER, stamp)


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = sf.customers_feed(spark, sf_dir)
    rows = [
        op.build_dim_customer(
            op.dedup_changes(feed.where(F.col("Op") == code), seq=sf.ARRIVAL["customers"], null_timestamps=False),
            sf.at(when), WIDE_ID,
        )
        for code, when in (("I", sf.INSERTED_AT), ("U", sf.UPDATED_AT), ("D", sf.DELETED_AT))
    ]
    return reduce(op.scd2_append, rows)


@query
def scd2_append(spark, sf_dir):
    return _appended(spark, sf_dir)


@query
def dim_date_upsert(spark, sf_dir):
    """Dates of status F first, then those of all orders that are new."""
    orders = sf.orders_feed(spark, sf_dir)
    existing = op.build_dim_date(orders.where("status = 'F'"))
    return existing.unionByName(op.dim_date_upsert(existing, op.build_dim_date(orders)))


# ---- reports, quality, time travel --------------------------------------


@query
def q_row_counts(spark, sf_dir):
    return analytics.q_row_counts(fx.gold(spark, sf_dir))


@query
def q_star_join_top20(spark, sf_dir):
    return analytics.q_star_join_top20(fx.gold(spark, sf_dir))


@query
def q_top_customers(spark, sf_dir):
    return analytics.q_top_customers(fx.gold(spark, sf_dir))


@query
def q_top_products(spark, sf_dir):
    return analytics.q_top_products(fx.gold(spark, sf_dir))


@query
def q_daily_sales(spark, sf_dir):
    return analytics.q_daily_sales(fx.gold(spark, sf_dir))


@query
def q_quarter_category(spark, sf_dir):
    return analytics.q_quarter_category(fx.gold(spark, sf_dir))


@query
def q_category_totals(spark, sf_dir):
    return analytics.q_category_totals(fx.gold(spark, sf_dir))


@query
def q_top5_spend(spark, sf_dir):
    return analytics.q_top5_spend(fx.gold(spark, sf_dir))


@query
def q_first_customer_history(spark, sf_dir):
    return analytics.q_first_customer_history(fx.gold(spark, sf_dir))


@query
def q_orphan_customers(spark, sf_dir):
    return quality.q_orphan_customers(fx.gold(spark, sf_dir))


@query
def q_orphan_products(spark, sf_dir):
    return quality.q_orphan_products(fx.gold(spark, sf_dir))


@query
def q_orphan_dates(spark, sf_dir):
    return quality.q_orphan_dates(fx.gold(spark, sf_dir))


def _lossy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star after some dimension rows got lost."""
    star = fx.gold(spark, sf_dir)
    return {
        **star,
        "dim_customer": star["dim_customer"].where("country <> 'ASIA'"),
        "dim_product": star["dim_product"].where("category <> 'ECONOMY'"),
        "dim_date": star["dim_date"].where("year <> 1997"),
    }


@query
def q_orphan_customers_lossy(spark, sf_dir):
    return quality.q_orphan_customers(_lossy(spark, sf_dir))


@query
def q_orphan_products_lossy(spark, sf_dir):
    return quality.q_orphan_products(_lossy(spark, sf_dir))


@query
def q_orphan_dates_lossy(spark, sf_dir):
    return quality.q_orphan_dates(_lossy(spark, sf_dir))


@query
def q_scd2_versions(spark, sf_dir):
    return quality.q_scd2_versions(fx.versioned(spark, sf_dir).dimension("dim_customer"))


@query
def q_fact_count_as_of(spark, sf_dir):
    facts = fx.versioned(spark, sf_dir).facts(as_of=sf.at(fx.BETWEEN))
    return facts.agg(F.count(F.lit(1)).alias("fact_count_at_timestamp"))


@query
def q_snapshots(spark, sf_dir):
    return fx.versioned(spark, sf_dir).snapshots("fact_orders")


@query
def q_fact_count_version(spark, sf_dir):
    return fx.versioned(spark, sf_dir).facts(version=0).agg(F.count(F.lit(1)).alias("fact_count_at_version"))


def _in_sql(spark: SparkSession, warehouse: Warehouse, label: str, text: str) -> DataFrame:
    """SQL text over the table functions of a warehouse, whose names stand in braces."""
    time_travel.create_functions(warehouse, f"{label}_")
    return spark.sql(text.replace("{", f"{label}_").replace("}", ""))


@query
def sql_count_at_version(spark, sf_dir):
    return _in_sql(spark, fx.versioned(spark, sf_dir), "versioned", "SELECT COUNT(*) AS fact_count_at_version FROM {fact_orders_at_version}(0)")


@query
def sql_count_as_of(spark, sf_dir):
    return _in_sql(spark, fx.versioned(spark, sf_dir), "versioned", f"SELECT COUNT(*) AS fact_count_at_timestamp FROM {{fact_orders_as_of}}(TIMESTAMP_NTZ '{fx.BETWEEN}')")


@query
def sql_facts_of_version(spark, sf_dir):
    """Facts after a delete and a compaction, as SQL text asks for them."""
    return _in_sql(spark, _pruned(spark, sf_dir), "pruned", "SELECT * FROM {fact_orders_at_version}(6)")


@query
def sql_report_of_version(spark, sf_dir):
    """Spend by customer and category as it was before the deletes of customers and products."""
    return _in_sql(spark, fx.versioned(spark, sf_dir), "versioned", """
        SELECT c.name, p.category, CAST(SUM(CAST(f.quantity * f.unit_price AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total
        FROM {fact_orders_at_version}(1) f JOIN {dim_customer_at_version}(2) c ON f.customer_key = c.customer_key
        JOIN {dim_product_at_version}(2) p ON f.product_key = p.product_key
        WHERE c.is_current AND p.is_current GROUP BY c.name, p.category""")


@query
def q_facts_latest(spark, sf_dir):
    """All facts of the three batches at the latest version."""
    return fx.versioned(spark, sf_dir).facts().drop("order_month")


@query
def q_mismatched_totals(spark, sf_dir):
    return quality.q_mismatched_totals(fx.gold(spark, sf_dir)["fact_orders"])


@query
def q_mismatched_totals_discounted(spark, sf_dir):
    """The same check where totals of status O orders were reduced by 0.02."""
    facts = fx.gold(spark, sf_dir)["fact_orders"]
    reduced = F.when(F.col("order_status") == "O", F.col("total_amount") - F.lit("0.02").cast("decimal(12,2)"))
    return quality.q_mismatched_totals(facts.withColumn("total_amount", F.coalesce(reduced, "total_amount")))


@query
def q_duplicate_active(spark, sf_dir):
    return quality.q_duplicate_active(fx.versioned(spark, sf_dir).dimension("dim_customer"))


@query
def q_duplicate_active_appended(spark, sf_dir):
    return quality.q_duplicate_active(_appended(spark, sf_dir))


@query
def q_table_columns(spark, sf_dir):
    """Columns of dim_customer in order, with the rows that fill each."""
    database = fx.catalog_database(spark, sf_dir)
    filled = fn.column_profile(spark.table(f"{database}.dim_customer")).select("column_name", "filled_rows")
    return catalog.table_columns(spark, database, "dim_customer").join(F.broadcast(filled), "column_name").orderBy(
        "ordinal_position"
    )


@query
def q_source_counts(spark, sf_dir):
    return row_counts(fx.source_frames(spark, sf_dir))


@query
def q_order_totals(spark, sf_dir):
    orders = sf.orders_feed(spark, sf_dir).drop("Op", "Timestamp")
    return synth.order_totals(orders, sf.order_items_feed(spark, sf_dir))


# ---- synthetic feed, one row per row of the sample tables ----------------

SYNTH_NOW = "2024-03-01 00:00:00"


def _numbered(spark: SparkSession, sf_dir: str, table: str, key: str) -> DataFrame:
    return sf.read(spark, sf_dir, table).select(F.col(key).alias("n"))


def _synth_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_customers = sf.read(spark, sf_dir, "customer").count()
    return synth.gen_orders(_numbered(spark, sf_dir, "orders", "o_orderkey"), n_customers, F.lit(SYNTH_NOW).cast("date"))


@query
def gen_customers(spark, sf_dir):
    return synth.gen_customers(_numbered(spark, sf_dir, "customer", "c_custkey"), sf.at(SYNTH_NOW))


@query
def gen_products(spark, sf_dir):
    return synth.gen_products(_numbered(spark, sf_dir, "part", "p_partkey"), sf.at(SYNTH_NOW))


@query
def gen_orders(spark, sf_dir):
    return _synth_orders(spark, sf_dir)


@query
def gen_order_items(spark, sf_dir):
    rows = sf.read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"))
    n_orders, n_parts = sf.read(spark, sf_dir, "orders").count(), sf.read(spark, sf_dir, "part").count()
    return synth.gen_order_items(rows, n_orders, n_parts)


@query
def reset_tables(spark, sf_dir):
    """Tables written twice hold the second content only."""
    root = scratch_dir(spark, "reset")
    customers = gen_customers(spark, sf_dir)
    synth.reset_tables({"customers": customers, "products": gen_products(spark, sf_dir)}, root)
    synth.reset_tables({"customers": customers}, root)
    return row_counts({t: spark.read.parquet(f"{root}/{t}") for t in ("customers", "products")})
