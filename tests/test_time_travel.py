from __future__ import annotations

import datetime as dt

import feeds as fd
import pytest
from pyspark.sql import functions as F
from test_warehouse import DAY, HISTORY, TIMES, first, gone, rows, second

from tidestar.plans.time_travel import create_functions
from tidestar.plans.warehouse import Warehouse
from tidestar.session import scratch_dir

HOUR = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def warehouse(spark):
    w = Warehouse(spark, scratch_dir(spark, "travel"))
    w.create_tables()
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))
    w.delete_from_fact(gone(spark, [10]), 2, F.lit(TIMES[2]))
    w.compact_facts(3, F.lit(TIMES[2] + HOUR))
    w.write_batch({"orders": fd.orders(spark, ("I", 20, 1, DAY, 5)), "order_items": fd.items(spark, ("I", 20, 20, 100, 9, "1.00", 5))}, fd.ARRIVAL, 4, F.lit(TIMES[3]))
    w.delete_from_fact(gone(spark, [11]), 5, F.lit(TIMES[3] + HOUR))
    w.compact_facts(6, F.lit(TIMES[3] + 2 * HOUR))
    return w


def test_functions_against_the_warehouse(spark, warehouse):
    names = create_functions(warehouse, "t_")
    assert sorted(names) == sorted(f"t_{t}_{k}" for t in ("fact_orders", "dim_customer", "dim_product") for k in ("at_version", "as_of"))
    for v in range(7):
        assert rows(spark.sql(f"SELECT * FROM t_fact_orders_at_version({v})"), "order_id", "total_amount") == rows(warehouse.facts(version=v), "order_id", "total_amount"), v
        got = spark.sql(f"SELECT * FROM t_dim_customer_at_version({v})")
        assert got.columns == warehouse.dimension("dim_customer").columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, warehouse.dimension("dim_customer", version=v).collect())), v
    assert spark.sql("SELECT count(*) FROM t_fact_orders_at_version(-1)").first()[0] == 0
    for at in (TIMES[0] - HOUR, *[t + n * HOUR for t in TIMES for n in range(3)]):
        sql = f"TIMESTAMP_NTZ '{at}'"
        assert rows(spark.sql(f"SELECT * FROM t_fact_orders_as_of({sql})"), "order_id") == rows(warehouse.facts(as_of=F.lit(at)), "order_id"), at
        assert spark.sql(f"SELECT count(*) FROM t_dim_product_as_of({sql})").first()[0] == warehouse.dimension("dim_product", as_of=F.lit(at)).count()


def test_reports_as_text(spark, warehouse):
    create_functions(warehouse)
    # A literal with a zone is taken in the session's zone.
    assert spark.sql(f"SELECT COUNT(*) AS n FROM fact_orders_as_of(TIMESTAMP '{TIMES[1]}')").first()["n"] == 2
    joined = spark.sql("""
        SELECT c.name, c.city, f.total_amount FROM fact_orders_at_version(1) f
        JOIN dim_customer_at_version(1) c ON f.customer_key = c.customer_key WHERE c.is_current ORDER BY f.order_id""")
    assert [(r["name"], r["city"], str(r["total_amount"])) for r in joined.collect()] == [("a", "NEW", "49.95"), ("a", "NEW", "9.99")]
    history = spark.sql("SELECT customer_id, city, effective_start_date, effective_end_date, is_current FROM dim_customer_at_version(1)")
    assert sorted(map(tuple, history.collect())) == HISTORY


def test_a_version_opens_its_own_folders(spark, warehouse):
    create_functions(warehouse)
    plan = spark.sql("SELECT count(*) FROM fact_orders_at_version(0)")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.split("== Initial Plan")[0].split("\n") if "FileScan" in line and "row_index" in line]
    # The folders of batches are pruned; those of compactions are told apart by the segment.
    assert any("<= 0)" in s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans), scans
    log = spark.sql("SELECT count(*) FROM dim_customer_at_version(0)")
    assert "<= 0)" in log._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_functions_do_not_shuffle_facts(spark, warehouse):
    create_functions(warehouse, "n_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.sql("SELECT * FROM n_fact_orders_at_version(6)")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert [line for line in text.split("\n") if "Join" in line and ("_file" in line or "_folder" in line) and "BroadcastHashJoin" not in line] == []
        assert rows(plan, "order_id", "total_amount") == rows(warehouse.facts(version=6), "order_id", "total_amount")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
