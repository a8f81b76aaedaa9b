from __future__ import annotations

import datetime as dt

import feeds as fd
from pyspark.sql import functions as F
from test_warehouse import DAY, TIMES, first, gone, rows, second

from tidestar.plans import analytics
from tidestar.plans.report_sums import ReportSums
from tidestar.plans.warehouse import Warehouse
from tidestar.session import scratch_dir

HOUR = dt.timedelta(hours=1)


def same(w, sums, version=None):
    star = w.star(version)
    for mine, theirs in (
        (sums.daily_sales(version), analytics.q_daily_sales(star)), (sums.quarter_category(version), analytics.q_quarter_category(star)),
        (sums.category_totals(version), analytics.q_category_totals(star)), (sums.top_customers(version), analytics.q_top_customers(star)),
    ):
        assert mine.columns == theirs.columns and mine.schema.simpleString() == theirs.schema.simpleString()
        assert [tuple(r) for r in mine.collect()] == [tuple(r) for r in theirs.collect()]


def test_reports_follow_the_batches(spark):
    w = Warehouse(spark, scratch_dir(spark, "sums"))
    w.create_tables()
    sums = ReportSums(w)
    assert sums.refresh() == []
    w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    w.write_batch(second(spark), fd.ARRIVAL, 1, F.lit(TIMES[1]))  # a customer moves, another one goes
    assert sums.pending() == [0, 1]
    assert sums.refresh() == [0, 1] and sums.refresh() == []
    same(w, sums)
    same(w, sums, version=0)
    assert all("_batch_id=1/" in f for f in sums.added(1).inputFiles())
    more = {
        "orders": fd.orders(spark, *[("I", 100 + i, 1, DAY + dt.timedelta(days=17 * i), 0) for i in range(20)]),
        "order_items": fd.items(spark, *[("I", 100 + i, 100 + i, 100, i, "2.50", 0) for i in range(20)]),
    }
    w.write_batch(more, fd.ARRIVAL, 2, F.lit(TIMES[2]))
    w.delete_from_fact(gone(spark, [10, 103, 107]), 3, F.lit(TIMES[2] + HOUR))
    assert sums.refresh() == [2, 3]
    same(w, sums)
    same(w, sums, version=2)
    w.compact_facts(4, F.lit(TIMES[2] + 2 * HOUR))
    assert sums.refresh() == []  # a compaction changes no sum
    w.delete_from_fact(gone(spark, [107, 110, 111]), 5, F.lit(TIMES[3]))
    assert rows(sums.removed(5), "order_id") == [(110,), (111,)]
    # An order comes again and another one is deleted in the same batch.
    w.write_batch({"orders": fd.orders(spark, ("I", 110, 1, DAY, 9), ("D", 112, 1, DAY, 9)), "order_items": fd.items(spark, ("I", 110, 110, 100, 3, "2.50", 9))}, fd.ARRIVAL, 6, F.lit(TIMES[3] + HOUR), hard_delete=True)
    assert sums.refresh() == [5, 6]
    same(w, sums)
    same(w, sums, version=4)
    left = sums.sums("days").agg(F.sum("n")).first()[0]
    assert left == w.facts().count()


def test_kinds_are_summed_apart(spark):
    w = Warehouse(spark, scratch_dir(spark, "kinds"))
    w.create_tables()
    written = w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0]))
    days, others = ReportSums(w, ["days"]), ReportSums(w, ["quarters", "pairs"])
    assert days.refresh() == [0] and days.pending() == [] and others.pending() == [0]
    assert [tuple(r) for r in days.daily_sales().collect()] == [tuple(r) for r in analytics.q_daily_sales(w.star()).collect()]
    assert w.write_batch(first(spark), fd.ARRIVAL, 0, F.lit(TIMES[0])).keys() == written.keys()
    assert others.refresh() == [0] and ReportSums(w).pending() == []
    same(w, ReportSums(w))
