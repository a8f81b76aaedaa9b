from __future__ import annotations

import datetime as dt

import feeds as fd
import pytest
from pyspark.sql import functions as F

from tidestar.operators import SkewPolicy
from tidestar.plans import analytics, catalog
from tidestar.plans.star import StarBatch, transform_star
from tidestar.plans.warehouse import Warehouse, interleaved
from tidestar.session import scratch_dir

DAY = dt.date(2024, 1, 15)
TIMES = [dt.datetime(2024, 6, n) for n in (1, 2, 3, 4)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def first(spark):
    return {
        "customers": fd.customers(spark, ("I", 1, "a", "x", 0), ("I", 2, "b", "y", 0)),
        "products": fd.products(spark, ("I", 100, "p", "9.99", 0)),
        "orders": fd.orders(spark, ("I", 10, 1, DAY, 0)),
        "order_items": fd.items(spark, ("I", 1, 10, 100, 5, "9.99", 0)),
    }


def second(spark):
    """An update, a delete, and an order that refers to the first batch."""
    return {
        "customers": fd.customers(spark, ("U", 1, "a", "NEW", 1), ("D", 2, "b", "y", 1)),
        "orders": fd.orders(spark, ("I", 11, 1, dt.date(2024, 1, 16), 1), ("I", 12, 2, DAY, 1)),
        "order_items": fd.items(spark, ("I", 2, 11, 100, 1, "9.99", 1), ("I", 3, 12, 100, 1, "9.99", 1)),
    }


@pytest.fixture(scope="module", params=[SkewPolicy(), SkewPolicy(rows=1)], ids=["plain", "salted"])
def warehouse(spark, request):
    w = Warehouse(spark, scratch_dir(spark, "test"), skew=request.param)
    w.create_tables()
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    return w


def versions(w, **at):
    return rows(w.dimension("dim_customer", **at), "customer_id", "city", "effective_start_date", "effective_end_date", "is_current")


HISTORY = [
    (1, "NEW", TIMES[1], None, True), (1, "x", TIMES[0], TIMES[1], False), (2, "y", TIMES[0], TIMES[1], False),
]


def test_history_and_late_lookup(warehouse):
    assert versions(warehouse) == HISTORY
    # Order 11 finds a product of batch 0; order 12 belongs to a customer who is gone.
    assert rows(warehouse.facts(), "order_id", "_batch_id") == [(10, 0), (11, 1)]
    assert rows(warehouse.dates(), "date_sk") == [(20240115,), (20240116,)]


def test_versions(warehouse):
    assert versions(warehouse, version=0) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    assert warehouse.facts(version=0).count() == 1
    assert warehouse.facts(as_of=F.lit(TIMES[0] + dt.timedelta(hours=1))).count() == 1
    assert warehouse.facts(as_of=F.lit(TIMES[0] - dt.timedelta(hours=1))).count() == 0
    assert [tuple(r)[1:] for r in warehouse.snapshots("fact_orders").collect()] == [(1, TIMES[1], 1), (0, TIMES[0], 1)]
    assert warehouse.next_batch_id() == 2


def test_rerun_changes_nothing(spark, warehouse):
    before = rows(warehouse.commits(), "table_name", "batch_id", "rows")
    warehouse.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    assert versions(warehouse) == HISTORY
    assert rows(warehouse.facts(), "order_id") == [(10,), (11,)]
    assert rows(warehouse.commits(), "table_name", "batch_id", "rows") == before


def test_uncommitted_rows_are_not_seen(spark):
    w = Warehouse(spark, scratch_dir(spark, "crash"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w._commit, commit = lambda *a: None, w._commit  # the batch stops before its commit
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    w._commit = commit
    assert versions(w) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    assert w.facts().count() == 1
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    assert versions(w) == HISTORY


def test_hard_deletes(spark):
    w = Warehouse(spark, scratch_dir(spark, "deletes"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    gone = {
        "orders": fd.orders(spark, ("D", 10, 1, DAY, 1), ("I", 11, 1, DAY, 1)),
        "order_items": fd.items(spark, ("I", 2, 11, 100, 1, "9.99", 1)),
    }
    w.write_batch(gone, fd.ARRIVAL, 1, F.lit(TIMES[1]), hard_delete=True)
    assert rows(w.facts(), "order_id") == [(11,)]
    assert rows(w.facts(version=0), "order_id") == [(10,)]
    w.write_batch(first(spark), fd.ARRIVAL, 2, F.lit(TIMES[2]))  # the order comes again
    assert rows(w.facts(), "order_id", "_batch_id") == [(10, 2), (11, 1)]
    w.delete_from_fact(spark.createDataFrame([(11,)], "order_id int"), 3, F.lit(TIMES[3]))
    assert rows(w.facts(), "order_id") == [(10,)]
    assert w.facts(version=2).count() == 2


def split(spark, batches, root):
    w = Warehouse(spark, root)
    w.create_tables()
    for n, tables in enumerate(batches):
        w.write_batch({t: f for t, f in first(spark).items() if t in tables}, fd.ARRIVAL, n, F.lit(TIMES[n]))
    return w


@pytest.mark.parametrize("batches", [
    [("order_items",), ("orders",), ("customers", "products")],
    [("customers", "products", "orders"), ("order_items",)],
    [("order_items", "customers"), ("products",), ("orders",)],
])
def test_items_wait_for_their_partners(spark, batches):
    w = split(spark, batches, scratch_dir(spark, "split"))
    assert rows(w.facts(), "order_id", "_batch_id") == [(10, len(batches) - 1)]
    assert w.pending_items().isEmpty()
    if "order_items" in batches[0]:
        assert rows(w.pending_items(0), "id", "reason", "since") == [("1", "order not found", 0)]
        assert w.facts(version=0).isEmpty()
    w.write_batch({}, fd.ARRIVAL, 3, F.lit(TIMES[3]))
    assert w.facts().count() == 1  # a fact once


def test_a_waiting_item_that_changes(spark):
    w = split(spark, [("order_items",)], scratch_dir(spark, "change"))
    again = first(spark) | {"order_items": fd.items(spark, ("U", 1, 10, 100, 7, "9.99", 1))}
    w.write_batch(again, fd.ARRIVAL, 1, F.lit(TIMES[1]))
    assert rows(w.facts(), "quantity") == [(7,)]
    assert w.pending_items().isEmpty()


def test_day_folders_prune(spark, warehouse):
    facts = warehouse.facts().where(F.col("order_day") == DAY)
    assert rows(facts, "order_id") == [(10,)]
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "order_day" in plan.split("PartitionFilters")[1].split("]")[0]


def test_catalog(spark):
    root = scratch_dir(spark, "catalog")
    database = "tidestar_test_" + root[-12:]
    catalog.ensure_database(spark, database, f"{root}/db")
    assert not any(r["is_registered"] for r in catalog.verify_tables(spark, database).collect())
    for _ in range(2):
        catalog.create_star_tables(spark, database, root)
    assert all(r["is_registered"] for r in catalog.verify_tables(spark, database).collect())
    star = transform_star(spark, first(spark), fd.ARRIVAL, F.lit(TIMES[0]))
    for _ in range(2):
        catalog.append_star_tables(spark, database, star.tables())
    assert rows(catalog.registered_counts(spark, database), "table_name", "row_count") == [
        ("dim_customer", 4), ("dim_date", 2), ("dim_product", 2), ("fact_orders", 2),
    ]
    columns = catalog.table_columns(spark, database, "dim_product").collect()
    assert [c["column_name"] for c in columns][:2] == ["product_key", "product_id"]
    assert columns[4]["data_type"] == "DECIMAL(10,2)"
    catalog.register_table(spark, database, "dim_customer", f"{root}/dim_customer", {"a": "1", "b": "2"})
    catalog.register_table(spark, database, "dim_customer", f"{root}/dim_customer", {"b": "3"})
    found = dict(rows(catalog.table_properties(spark, database, ("dim_customer",)), "key", "value"))
    assert (found["a"], found["b"]) == ("1", "3")


def test_summary_of_a_batch(spark):
    star = transform_star(spark, first(spark), fd.ARRIVAL, F.lit(TIMES[0]))
    assert isinstance(star, StarBatch)
    assert star.total_rows().first()[0] == 5


def test_sql_over_views(spark, warehouse):
    warehouse.create_views()
    warehouse.create_views(version=0, prefix="first_")
    found = spark.sql("""
        SELECT c.name, p.category, SUM(f.quantity * f.unit_price) AS total
        FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key
        JOIN dim_product p ON f.product_key = p.product_key
        WHERE c.is_current = true AND p.is_current = true
        GROUP BY c.name, p.category ORDER BY total DESC""")
    assert [(r["name"], r["category"], str(r["total"])) for r in found.collect()] == [("a", "Tools", "59.94")]
    assert spark.sql("SELECT count(*) FROM first_fact_orders").first()[0] == 1
    assert spark.sql("SELECT max(batch_id) FROM commits WHERE table_name = 'fact_orders'").first()[0] == 1
    assert [tuple(r) for r in analytics.q_category_totals(warehouse.star()).collect()] == [tuple(r) for r in found.collect()]


def test_new_columns_of_written_facts(spark):
    w = Warehouse(spark, scratch_dir(spark, "evolve"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    more = w.facts().drop("_batch_id", "order_day").withColumn("channel", F.lit("web"))
    w._commit({"fact_orders": w.write_facts(more, 1)}, 1, F.lit(TIMES[1]))
    assert "channel" not in w.facts().columns
    assert [tuple(r) for r in w.facts(merge_schema=True).select("_batch_id", "channel").orderBy("_batch_id").collect()] == [
        (0, None), (1, "web"),
    ]


def many(spark, n=400, customers=20, days=40):
    """A warehouse with four batches of facts over many days and customers."""
    w = Warehouse(spark, scratch_dir(spark, "many"))
    w.create_tables()
    start = dt.date(2024, 1, 1)
    for b in range(4):
        feeds = {
            "orders": fd.orders(spark, *[("I", i, i % customers, start + dt.timedelta(days=i * 7 % days), 0) for i in range(b, n, 4)]),
            "order_items": fd.items(spark, *[("I", i, i, 1, i, "1.00", 0) for i in range(b, n, 4)]),
        }
        if b == 0:
            feeds |= {"customers": fd.customers(spark, *[("I", i, f"c{i}", "x", 0) for i in range(customers)]), "products": fd.products(spark, ("I", 1, "p", "1.00", 0))}
        w.write_batch(feeds, fd.ARRIVAL, b, F.lit(TIMES[0] + dt.timedelta(hours=b)))
    return w


def ids(df):
    return sorted(r["order_id"] for r in df.select("order_id").collect())


def gone(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "order_id int")


def test_deletion_vectors(spark):
    w = many(spark)
    files = w._scan("fact_orders").select("_metadata.file_path").distinct().count()
    w.delete_from_fact(gone(spark, range(0, 400, 3)), 4, F.lit(TIMES[1]))
    w.delete_from_fact(gone(spark, [*range(0, 400, 5), 5000]), 5, F.lit(TIMES[2]))  # some are gone already
    left = [i for i in range(400) if i % 3 and i % 5]
    assert ids(w.facts()) == left
    assert ids(w.facts(version=4)) == [i for i in range(400) if i % 3]
    assert ids(w.facts(version=3)) == ids(w.facts(as_of=F.lit(TIMES[0] + dt.timedelta(hours=5)))) == list(range(400))
    assert rows(w.deleted_rows(), "_batch_id", "deleted") == [(4, 134), (5, 400 - 134 - len(left))]
    assert w._scan("fact_orders").select("_metadata.file_path").distinct().count() == files  # no file was written anew
    w.write_batch({"orders": fd.orders(spark, ("I", 3, 1, DAY, 5)), "order_items": fd.items(spark, ("I", 3, 3, 1, 9, "1.00", 5))}, fd.ARRIVAL, 6, F.lit(TIMES[3]))
    assert ids(w.facts()) == sorted([*left, 3])  # comes again after its deletion


def test_every_position_of_a_bitmap(spark):
    w = Warehouse(spark, scratch_dir(spark, "bits"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    n = 70_000  # three bitmaps of one file
    one = w.facts().drop("_batch_id", "order_day", "order_id")
    facts = one.crossJoin(spark.range(n).select(F.col("id").cast("int").alias("order_id"))).select(*[f.name for f in w.schema("fact_orders").fields if f.name not in ("_batch_id", "order_day")])
    w._commit({"fact_orders": w.write_facts(facts.coalesce(1), 1)}, 1, F.lit(TIMES[1]))
    kept = spark.range(n).select(F.col("id").cast("int").alias("order_id")).where("order_id % 7 <> 0")
    w.delete_from_fact(spark.range(n).select(F.col("id").cast("int").alias("order_id")).where("order_id % 7 = 0"), 2, F.lit(TIMES[2]))
    found = w.facts().select("order_id")
    assert found.where("_batch_id = 1").exceptAll(kept).isEmpty() and kept.exceptAll(found).isEmpty()
    assert w._scan("fact_vectors").count() >= 3


def test_compaction(spark):
    w = many(spark)
    w.delete_from_fact(gone(spark, range(0, 400, 3)), 4, F.lit(TIMES[1]))
    before = sorted(map(tuple, w.facts().collect()), key=repr)
    assert w.compact_facts(5, F.lit(TIMES[2]), rows_per_file=30) == len(before)
    assert w.compact_facts(5, F.lit(TIMES[2]), rows_per_file=30) == len(before)  # done already
    assert sorted(map(tuple, w.facts().collect()), key=repr) == before
    assert ids(w.facts(version=3)) == list(range(400)) and ids(w.facts(version=4)) == ids(w.facts())
    told = w.compacted_files(5)
    assert 5 <= told.count() <= 12 and told.agg(F.sum("rows")).first()[0] == len(before)
    read = lambda **at: [r["_file"] for r in w._placed_facts(**at).select("_file").distinct().collect()]
    assert len(read()) == told.count() < len(read(version=4))
    # A short time and one customer: few files are opened, none is missed.
    customer = w.facts().where("order_id = 1").first()["customer_key"]
    days = (dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    part = w.facts(days=days, customer_key=customer)
    every = w.facts().where((F.col("customer_key") == customer) & F.col("order_timestamp").cast("date").between(*days))
    assert ids(part) == ids(every) and ids(part)
    assert len(read(days=days, customer_key=customer)) <= told.count() // 2
    assert ids(w.facts(days=(dt.date(2030, 1, 1), dt.date(2030, 1, 2)))) == []
    # Life goes on: a batch, a delete in compacted and in new files, another compaction.
    w.write_batch({"orders": fd.orders(spark, ("I", 901, 1, DAY, 5), ("I", 902, 1, DAY, 5)), "order_items": fd.items(spark, ("I", 901, 901, 1, 9, "1.00", 5), ("I", 902, 902, 1, 9, "1.00", 5))}, fd.ARRIVAL, 6, F.lit(TIMES[3]))
    w.delete_from_fact(gone(spark, [1, 902]), 7, F.lit(TIMES[3] + dt.timedelta(hours=1)))
    left = sorted([i for i in range(2, 400) if i % 3] + [901])
    assert ids(w.facts()) == left
    w.compact_facts(8, F.lit(TIMES[3] + dt.timedelta(hours=2)))
    assert ids(w.facts()) == left and ids(w.facts(version=6)) == sorted([*left, 1, 902])
    assert w.compacted_files(8).count() == 1
    assert rows(w.facts().where("order_id = 901"), "_batch_id") == [(6,)]


def test_compaction_keeps_added_columns_and_takes_no_facts(spark):
    w = Warehouse(spark, scratch_dir(spark, "empty"))
    w.create_tables()
    assert w.compact_facts(0, F.lit(TIMES[0])) == 0 and w.facts().isEmpty()
    w.write_batch(first(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    more = w.facts().drop("_batch_id", "order_day").withColumn("channel", F.lit("web"))
    w._commit({"fact_orders": w.write_facts(more, 2)}, 2, F.lit(TIMES[2]))
    w.compact_facts(3, F.lit(TIMES[3]))
    assert [tuple(r) for r in w.facts(merge_schema=True).select("_batch_id", "channel").orderBy("_batch_id").collect()] == [(1, None), (2, "web")]


def test_curve(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    got = {(r["x"], r["y"]): r["z"] for r in df.select("x", "y", interleaved(F.col("x"), F.col("y")).alias("z")).collect()}
    for (x, y), z in got.items():
        assert z == sum(((x >> k & 1) << (2 * k + 1)) | ((y >> k & 1) << 2 * k) for k in range(16))
    assert spark.range(1).select(interleaved(F.lit(65535), F.lit(0)).alias("z")).first()["z"] == 0xAAAAAAAA


def test_waiting_items_that_nothing_touches_are_not_written_again(spark):
    w = split(spark, [("order_items",)], scratch_dir(spark, "still"))
    w.write_batch({"customers": first(spark)["customers"]}, fd.ARRIVAL, 1, F.lit(TIMES[1]))
    assert rows(w.pending_items(), "id", "reason", "since") == [("1", "order not found", 0)]
    assert w._scan("pending_items").where("_batch_id = 1").isEmpty()
    w.write_batch({t: first(spark)[t] for t in ("orders", "products")}, fd.ARRIVAL, 2, F.lit(TIMES[2]))
    assert w.facts().count() == 1 and w.pending_items().isEmpty()
    assert rows(w.pending_items(1), "id") == [("1",)]
    staged = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(w.root)
    assert staged.where("path like '%_staging%'").isEmpty()


def test_limits(spark):
    root = scratch_dir(spark, "limits")
    w = Warehouse(spark, root, limits={"rejected_share": 0.4, "largest_total": 1000})
    w.create_tables()
    assert w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))["fact_orders"] == 1
    told = {r["metric"]: (r["value"], r["limit_value"]) for r in w.batch_metrics().collect()}
    assert told["facts"] == (1, None) and told["rejected_share"] == (0, 0.4) and told["largest_total"] == (49.95, 1000) and told["mismatched_totals"] == (0, None)
    # Half of the items of the second batch are rejected: nothing of it is seen.
    assert w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1])) == {}
    assert versions(w) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    assert rows(w.facts(), "order_id") == [(10,)] and w.pending_items().isEmpty()
    assert rows(w.quarantined(), "_batch_id", "metric", "value", "limit_value") == [(1, "rejected_share", 0.5, 0.4)]
    # It is written again under another limit.
    w = Warehouse(spark, root, limits={"rejected_share": 0.6})
    assert w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))["fact_orders"] == 1
    assert versions(w) == HISTORY and w.quarantined().isEmpty()
    assert rows(w.batch_metrics().where("metric = 'rejected_items'"), "_batch_id", "value") == [(0, 0), (1, 1)]
    with pytest.raises(ValueError, match="no such metrics"):
        Warehouse(spark, root, limits={"nothing": 1})


def test_logs_are_not_sorted_before_their_shuffle(spark):
    w = split(spark, [("order_items",)], scratch_dir(spark, "unsorted"))
    for latest, key in ((w.pending_items(), "id"), (w.dimension("dim_customer"), "customer_id")):
        plan = latest._jdf.queryExecution().executedPlan().toString()
        below = plan.split(f"Exchange hashpartitioning({key}")
        assert len(below) == 2 and "Aggregate" not in below[1]


def test_facts_are_not_shuffled_for_their_bits(spark):
    w = Warehouse(spark, scratch_dir(spark, "bits"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    w.delete_from_fact(gone(spark, [10]), 2, F.lit(TIMES[2]))
    assert w.bitmaps() == 1 and w.bitmaps(version=1) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as bitmaps of a large table are
    try:
        plan = w.facts()._jdf.queryExecution().executedPlan().toString()
        # Below the bitmaps' join no exchange takes facts, which are known by their total.
        assert [line for line in plan.split("\n") if "Join" in line and "_file" in line and "BroadcastHashJoin" not in line] == []
        assert rows(w.facts(), "order_id") == [(11,)]
        # Places are shuffled, not bitmaps.
        marks = w._marked(gone(spark, [11]))
        plan = marks._jdf.queryExecution().executedPlan().toString().split("\n")
        ends = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
        assert len(ends) == 2 and not any("Exchange" in line for line in plan[ends[0]:ends[1]])
        assert [r["rows"] for r in marks.collect()] == [1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_a_batch_asks_for_ids_and_stages_what_it_needs(spark):
    w = Warehouse(spark, scratch_dir(spark, "narrow"))
    w.create_tables()
    staged, keep = {}, w.stage
    w.stage = lambda df, label, *more: staged.setdefault(label, df.columns) and keep(df, label, *more)
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    assert not {"total", "Timestamp"} & {*staged["orders"]} and not {"order_date", "total_amount"} & {*staged["judged"]}
    assert rows(w.facts(), "order_id", "date_sk", "total_amount") == [(10, 20240115, fd.Decimal("49.95")), (11, 20240116, fd.Decimal("9.99"))]
    assert rows(w.pending_items(), "id", "Op", "reason", "since") == [("3", "I", "no current customer", 1)]
    ids = w.current_ids("dim_customer", spark.createDataFrame([(1,), (2,), (3,)], "customer_id int"))
    assert [tuple(r) for r in ids.collect()] == [(1, True)]
    assert "email" not in ids._jdf.queryExecution().executedPlan().toString()
