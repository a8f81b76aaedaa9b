from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import feeds as fd
import pytest
from pyspark.sql import functions as F

from tidestar import operators as op
from tidestar.plans import analytics
from tidestar.plans.star import dedup_feeds, transform_star

NOW = dt.datetime(2024, 7, 1)
DAY = dt.date(2024, 1, 15)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def dedup(feed, seq=("name",), **kw):
    return op.dedup_changes(feed, seq=seq, **kw)


@pytest.mark.parametrize("null_timestamps", [True, False])
@pytest.mark.parametrize(
    ("changes", "kept"),
    [
        ([("I", 1, "a", "x", 0), ("U", 1, "b", "x", 1)], [(1, "b")]),
        ([("U", 1, "b", "x", 0), ("I", 1, "a", "x", 1)], [(1, "b")]),
        ([("I", 1, "a", "x", 0), ("I", 1, "b", "x", 1)], [(1, "b")]),
        ([("I", 1, "a", "x", 0), ("I", 2, "b", "x", 0), ("I", 3, "c", "x", 0)], [(1, "a"), (2, "b"), (3, "c")]),
        ([("I", 1, "a", "x", 0), ("I", None, "b", "x", 0)], [(1, "a")]),
        ([("D", 1, "a", "x", 0), ("I", 1, "b", "x", 5)], [(1, "a")]),
        ([("X", 1, "a", "x", 0), ("I", 1, "b", "x", 0)], [(1, "b")]),
        ([("I", 1, "a", "x", 1), ("I", 1, "b", "x", 1)], [(1, "a")]),
    ],
)
def test_dedup_examples(spark, changes, kept, null_timestamps):
    assert rows(dedup(fd.customers(spark, *changes), null_timestamps=null_timestamps), "id", "name") == kept


def test_dedup_without_operation(spark):
    feed = fd.customers(spark, ("I", 1, "a", "x", 0), ("I", 1, "b", "x", 1)).drop("Op")
    assert rows(dedup(feed), "id", "name", "Op") == [(1, "b", None)]


def fold(changes):
    """Keep the incumbent unless the next arrival beats it."""
    rank = {"I": 1, "U": 2, "D": 3}
    kept = {}
    for change in changes:
        op_, key, _, when = change
        if key is None:
            continue
        held = kept.get(key)
        new, old = rank.get(op_, 0), rank.get(held[0], 0) if held else None
        if held is None or new > old or (new == old and when is not None and held[3] is not None and when > held[3]):
            kept[key] = change
    return sorted((c[1], c[2]) for c in kept.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedup_equals_the_fold(spark, seed):
    """Random feeds; one key holds a third of the rows."""
    rng = random.Random(seed)
    changes = []
    for n in range(3000):
        key = 7 if rng.random() < 1 / 3 else rng.choice([None, *range(300)])
        when = None if rng.random() < 0.3 else fd.at(rng.randrange(20))
        changes.append((rng.choice(["I", "U", "D", "X", None]), key, n, when))
    feed = spark.createDataFrame(changes, "Op string, id int, seq int, Timestamp timestamp_ntz").repartition(7)
    assert rows(op.dedup_changes(feed, seq=["seq"]), "id", "seq") == fold(changes)
    timed = [c for c in changes if c[3] is not None]
    feed = spark.createDataFrame(timed, feed.schema).repartition(5)
    assert rows(op.dedup_changes(feed, seq=["seq"], null_timestamps=False), "id", "seq") == fold(timed)


def test_null_timestamps_are_found(spark):
    assert op.has_null_timestamps(fd.customers(spark, ("I", 1, "a", "x", None)))
    assert not op.has_null_timestamps(fd.customers(spark, ("I", 1, "a", "x", 1)))


def test_dimension_rows(spark):
    dim = op.build_dim_customer(fd.customers(spark, ("I", 1, "a", "x", 0), ("D", 2, "b", "y", 0), (None, 3, "c", "z", 0)), F.lit(NOW))
    assert rows(dim, "customer_id", "is_current", "effective_start_date", "effective_end_date") == [
        (1, True, NOW, None), (2, False, NOW, NOW), (3, True, NOW, None),
    ]
    dim = op.build_dim_product(fd.products(spark, ("U", 1, "p", "9.99", 0), ("D", 2, "q", "1.00", 0)), F.lit(NOW))
    assert rows(dim, "product_id", "product_name", "unit_price", "is_current") == [
        (1, "p", Decimal("9.99"), True), (2, "q", Decimal("1.00"), False),
    ]


def test_missing_source_column_is_null(spark):
    dim = op.build_dim_customer(fd.customers(spark, ("I", 1, "a", "x", 0)).drop("country"), F.lit(NOW))
    assert dim.first()["country"] is None


def test_date_dimension(spark):
    orders = fd.orders(spark, ("I", 1, 1, DAY, 0), ("I", 2, 1, DAY, 0), ("I", 3, 1, dt.date(2024, 6, 15), 0), ("I", 4, 1, None, 0))
    got = sorted(tuple(r) for r in op.build_dim_date(orders).collect())
    assert got == [
        (20240115, DAY, 2024, 1, 15, 1, "Monday", False), (20240615, dt.date(2024, 6, 15), 2024, 6, 15, 2, "Saturday", True),
    ]


def batch(spark):
    return {
        "customers": fd.customers(spark, ("I", 1, "a", "x", 0), ("I", 2, "b", "y", 0), ("D", 3, "c", "z", 0)),
        "products": fd.products(spark, ("I", 100, "p", "9.99", 0), ("I", 200, "q", "1.50", 0), ("D", 300, "r", "1.00", 0)),
        "orders": fd.orders(spark, ("I", 10, 1, DAY, 0), ("I", 11, 3, DAY, 0), ("I", 12, 2, None, 0)),
        "order_items": fd.items(
            spark, ("I", 1, 10, 100, 5, "9.99", 0), ("I", 2, 10, 200, 1, "1.50", 0), ("I", 3, 999, 100, 1, "1.00", 0),
            ("I", 4, 11, 100, 1, "1.00", 0), ("I", 5, 10, 300, 1, "1.00", 0), ("I", 6, 12, 100, 1, "1.00", 0),
            ("D", 7, 10, 100, 2, "9.99", 0),
        ),
    }


SKEWS = [op.SkewPolicy(), op.SkewPolicy(rows=1)]


@pytest.mark.parametrize("skew", SKEWS)
def test_star_of_a_batch(spark, skew):
    star = transform_star(spark, batch(spark), fd.ARRIVAL, F.lit(NOW), skew=skew)
    assert rows(star.facts, "order_id", "quantity", "total_amount") == [
        (10, 1, Decimal("1.50")), (10, 2, Decimal("19.98")), (10, 5, Decimal("49.95")),
    ]
    assert [f.name for f in star.facts.schema.fields] == [
        "order_sk", "order_id", "customer_key", "product_key", "date_sk", "quantity", "unit_price", "total_amount",
        "order_status", "order_timestamp",
    ]
    assert rows(star.summary(), "table_name", "row_count") == [
        ("dim_customer", 3), ("dim_date", 1), ("dim_product", 3), ("fact_orders", 3),
    ]
    joined = star.facts.join(star.customers, "customer_key").join(star.products, "product_key").join(star.dates, "date_sk")
    assert joined.count() == 3
    assert not star.is_empty()


def test_deleted_items_can_be_left_out(spark):
    star = transform_star(spark, batch(spark), fd.ARRIVAL, F.lit(NOW), drop_deleted=True)
    assert rows(star.facts, "quantity") == [(1,), (5,)]


def test_empty_batch(spark):
    star = transform_star(spark, {}, fd.ARRIVAL, F.lit(NOW))
    assert star.is_empty()
    assert star.total_rows().first()[0] == 0


@pytest.mark.parametrize("skew", SKEWS)
def test_rejects(spark, skew):
    b = batch(spark)
    won = {t: op.dedup_changes(f, seq=fd.ARRIVAL[t]) for t, f in b.items()}
    customers, products = op.build_dim_customer(won["customers"], F.lit(NOW)), op.build_dim_product(won["products"], F.lit(NOW))
    rejects = op.fact_rejects(won["orders"], won["order_items"], customers, products, skew=skew, raw=b)
    assert rows(rejects, "order_id", "product_id", "reason") == [
        (10, 300, "no current product"), (11, 100, "no current customer"), (12, 100, "no order date"),
        (999, 100, "order not found"),
    ]


def test_values_too_large_are_rejected_not_zero(spark):
    b = batch(spark)
    b["order_items"] = b["order_items"].withColumn("unit_price", F.when(F.col("quantity") == 5, F.lit(1e12)).otherwise(F.col("unit_price").cast("double")))
    won = {t: op.dedup_changes(f, seq=fd.ARRIVAL[t]) for t, f in b.items()}
    dims = op.build_dim_customer(won["customers"], F.lit(NOW)), op.build_dim_product(won["products"], F.lit(NOW))
    facts = op.build_fact_orders(won["orders"], won["order_items"], *dims)
    rejects = op.fact_rejects(won["orders"], won["order_items"], *dims)
    assert rows(facts, "quantity") == [(1,), (2,)]
    assert rows(rejects.where("reason LIKE '%large'"), "quantity", "unit_price", "reason") == [(5, None, "unit price too large")]


def test_heavy_keys_are_found_and_bounded(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("k"))
    assert rows(op.heavy_keys({"k": df}, op.SkewPolicy(rows=3_000))["k"], "k", "_parts") == [(7, 4)]
    assert op.heavy_keys({"k": df}, op.SkewPolicy(rows=10_000)) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("copies", [1, 2])
def test_salted_join_equals_plain_join(spark, how, copies):
    left = spark.range(9_000).select(
        F.when(F.col("id") < 3_000, 5).when(F.col("id") < 3_100, None).otherwise(F.col("id") % 1_000).alias("k"), F.col("id").alias("v"),
    )
    right = spark.range(0, 1_000, 5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right if copies == 1 else right.unionAll(right)
    plain = op.keyed_join(left, right, "k", how)
    salted = op.keyed_join(left, right, "k", how, heavy=op.heavy_keys({"k": left}, op.SkewPolicy(rows=400))["k"])
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_salting_spreads_a_heavy_key(spark):
    """With one key on a third of the rows, no task of the join holds much more of it than the policy's rows."""
    left = spark.range(30_000).select(F.when(F.col("id") < 10_000, 5).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(30_000).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        heavy = op.heavy_keys({"k": left}, op.SkewPolicy(rows=200))["k"]
        joined = op.keyed_join(left, right, "k", "left_semi", heavy=heavy)
        sizes = [r[0] for r in joined.where("k = 5").groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 10_000
    assert max(sizes) < 4_000


def dim(spark, *changes, when=NOW):
    feed = op.dedup_changes(fd.customers(spark, *changes), seq=["name"])
    return op.build_dim_customer(feed, F.lit(when))


T2, T3 = dt.datetime(2024, 8, 1), dt.datetime(2024, 9, 1)


def test_history_merge(spark):
    state = dim(spark, ("I", 1, "a", "x", 0), ("I", 2, "b", "y", 0), ("I", 3, "c", "z", 0), ("I", 5, "e", "v", 0))
    update = dim(
        spark, ("U", 1, "a", "NEW", 1), ("U", 2, "b", "y", 1), ("D", 3, "c", "z", 1), ("D", 4, "d", "w", 1), ("I", 6, "f", "u", 1),
        when=T2,
    )
    merged = op.scd2_merge(state, update, op.CUSTOMER, F.lit(T2))
    assert rows(merged, "customer_id", "city", "effective_start_date", "effective_end_date", "is_current") == [
        (1, "NEW", T2, None, True), (1, "x", NOW, T2, False), (2, "y", NOW, None, True), (3, "z", NOW, T2, False),
        (4, "w", T2, T2, False), (5, "v", NOW, None, True), (6, "u", T2, None, True),
    ]
    again = op.scd2_merge(merged, dim(spark, ("I", 3, "c", "z", 2), when=T3), op.CUSTOMER, F.lit(T3))
    assert again.where("customer_id = 3").count() == 2
    assert again.where("is_current").groupBy("customer_id").count().where("count > 1").isEmpty()
    changes = op.scd2_changes(state.where("is_current"), update, op.CUSTOMER, F.lit(T2))
    assert rows(changes, "event", "customer_id") == [
        ("close", 1), ("close", 3), ("open", 1), ("open", 4), ("open", 6),
    ]


@pytest.mark.parametrize("most", [1_000_000, 100, 5, 1])
def test_history_of_a_feed(spark, most):
    """Against a plain loop; one key holds a third of the changes."""
    rng = random.Random(5)
    changes = []
    for n in range(1500):
        key = 7 if rng.random() < 1 / 3 else rng.randrange(40)
        changes.append((rng.choice("IUD"), key, n, fd.BASE + dt.timedelta(seconds=rng.randrange(4000) / 4)))
    feed = spark.createDataFrame(changes, "Op string, id int, seq int, Timestamp timestamp_ntz").repartition(6)
    rank, best = {"I": 1, "U": 2, "D": 3}, {}
    for change in changes:
        slot = (change[1], change[3])
        if slot not in best or rank[change[0]] > rank[best[slot][0]]:
            best[slot] = change
    expected, ordered = [], sorted(best)
    for here, after in zip(ordered, [*ordered[1:], (None, None)], strict=True):
        change = best[here]
        end = here[1] if change[0] == "D" else after[1] if after[0] == here[0] else None
        expected.append((here[0], here[1], change[0], change[2], end or dt.datetime.max, end is None))
    got = op.scd2_history(feed, seq=["seq"], skew=op.SkewPolicy(rows=most))
    assert sorted(
        (r["id"], r["effective_start_date"], r["Op"], r["seq"], r["effective_end_date"] or dt.datetime.max, r["is_current"])
        for r in got.collect()
    ) == sorted(expected)


def test_dates_are_added_once(spark):
    old = op.build_dim_date(fd.orders(spark, ("I", 1, 1, DAY, 0)))
    new = op.build_dim_date(fd.orders(spark, ("I", 1, 1, DAY, 0), ("I", 2, 1, dt.date(2024, 1, 16), 0)))
    assert rows(op.dim_date_upsert(old, new), "date_sk") == [(20240116,)]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "id int, name string")
    assert rows(op.snapshot_diff(old, new, F.lit(NOW)), "Op", "id", "name") == [("I", 4, "d"), ("U", 2, "B")]
    assert rows(op.snapshot_diff(new, old, F.lit(NOW)), "Op", "id", "name") == [("D", 4, "d"), ("U", 2, "b")]
    assert rows(op.snapshot_diff(None, old.where("id < 3"), F.lit(NOW)), "Op", "id") == [("I", 1), ("I", 2)]


def test_schema_evolution(spark):
    table = spark.createDataFrame([(1, "a")], "id int, name string")
    more = spark.createDataFrame([("2", "b", 9), ("x", "c", 8)], "id string, name string, extra int")
    merged = op.evolve_union(table, more)
    assert merged.columns == ["id", "name", "extra"]
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted([(1, "a", None), (2, "b", 9), (None, "c", 8)], key=repr)
    report = op.schema_mismatches(table.schema, more)
    assert [tuple(r) for r in report.collect()] == [("id", "INT", "STRING", 2, 1)]
    assert op.schema_mismatches(table.schema, table).isEmpty()


def test_fact_deletes(spark):
    facts = spark.createDataFrame([(1, 0), (1, 2), (2, 0), (3, 1)], "order_id int, _batch_id bigint")
    gone = spark.createDataFrame([(1, 1), (3, 0)], "order_id int, _batch_id bigint")
    assert rows(op.delete_facts(facts, gone), "order_id", "_batch_id") == [(2, 0)]
    assert rows(op.delete_facts(facts, gone, batch_col="_batch_id"), "order_id", "_batch_id") == [(1, 2), (2, 0), (3, 1)]


@pytest.mark.parametrize("orphans", [0, 60])
def test_top_facts_beyond_the_pool(spark, orphans):
    """Where the largest facts lack partners, the result comes from all facts; repeated dimension rows count."""
    star = transform_star(spark, {
        "customers": fd.customers(spark, ("I", 1, "a", "x", 0)),
        "products": fd.products(spark, ("I", 100, "p", "1.00", 0), ("I", 200, "q", "1.00", 0)),
        "orders": fd.orders(spark, ("I", 10, 1, DAY, 0)),
        "order_items": fd.items(spark, *[("I", n, 10, 200 if n > 100 - orphans else 100, n, "1.00", 0) for n in range(1, 101)]),
    }, fd.ARRIVAL, F.lit(NOW)).tables()
    if orphans:
        star["dim_product"] = star["dim_product"].where("product_id = 100")
    star["dim_product"] = star["dim_product"].unionAll(star["dim_product"])
    got = analytics.q_star_join_top20(star, n=5).select("quantity").collect()
    top = 100 - orphans
    assert [r[0] for r in got] == [top, top, top - 1, top - 1, top - 2]


@pytest.mark.parametrize(("skew", "cut"), [(op.SkewPolicy(), False), (op.SkewPolicy(rows=1), True)], ids=["even", "heavy"])
def test_winners_are_sorted_before_the_shuffle_only_where_a_key_is_heavy(spark, skew, cut):
    feeds = {"orders": fd.orders(spark, ("I", 1, 1, DAY, 0), ("U", 1, 2, DAY, 1), ("U", 2, 3, DAY, 0))}
    won = dedup_feeds(spark, feeds, fd.ARRIVAL, null_timestamps=False, skew=skew)["orders"]
    plan = won._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan.split("Exchange")[-1]) == cut
    assert rows(won, "id", "customer_id") == [(1, 2), (2, 3)]
