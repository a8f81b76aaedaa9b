from __future__ import annotations

import datetime as dt
import random

import feeds as fd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_files_and_stream import land
from test_warehouse import DAY, HISTORY, TIMES, first, rows, second, versions

from tidestar.operators import dedup_changes
from tidestar.plans.warehouse import Warehouse
from tidestar.session import scratch_dir
from tidestar.streaming import keyed_state


def run(w, root, n, **options):
    query = keyed_state.start(w, f"{root}/dms-source", clock=F.lit(TIMES[n]), arrival=fd.ARRIVAL, **options)
    query.awaitTermination()
    return query


def updated(query):
    return sum(s.numRowsUpdated for s in query.lastProgress.stateOperators)


@pytest.fixture
def root(spark):
    return scratch_dir(spark, "landing")


def test_history_over_restarts(spark, root):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    land(first(spark), root)
    run(w, root, 0)
    assert versions(w) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    land(second(spark), root)
    run(w, root, 1)
    assert versions(w) == HISTORY
    assert versions(w, version=0) == [(1, "x", TIMES[0], None, True), (2, "y", TIMES[0], None, True)]
    # Order 11 finds a product of the first run; order 12 belongs to a customer who is gone.
    assert rows(w.facts(), "order_id", "_batch_id") == [(10, 0), (11, 1)]
    assert rows(w.dates(), "date_sk") == [(20240115,), (20240116,)]
    assert rows(keyed_state.waiting_items(w), "order_id", "item_id", "reason") == [(12, "3", "no current customer")]
    before = w.commits().count()
    run(w, root, 2)  # no new files
    assert w.commits().count() == before


@pytest.mark.parametrize(("order", "spread"), [(("order_items", "orders", "customers", "products"), 3), (("products", "order_items", "customers", "orders"), 1)])
def test_partners_in_any_order(spark, root, order, spread):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    for n, table in enumerate(order):
        assert w.spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "unset") in ("unset", "false")
        land({table: first(spark)[table]}, root)
        run(w, root, n, spread=spread, order_spread=spread)
    assert rows(w.facts(), "order_id", "quantity", "_batch_id") == [(10, 5, 3)]
    assert keyed_state.waiting_items(w).isEmpty()


def test_waiting_items_change(spark, root):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    land({"order_items": fd.items(spark, ("I", 1, 10, 100, 5, "9.99", 0), ("I", 2, 10, 100, 2_000_000_000, "99999999.99", 0), ("I", 3, 77, 100, 1, "1.00", 0))}, root)
    run(w, root, 0)
    land({"order_items": fd.items(spark, ("U", 1, 10, 100, 7, "9.99", 1)), "orders": fd.orders(spark, ("I", 10, 1, None, 0))}, root)
    run(w, root, 1)
    assert rows(keyed_state.waiting_items(w), "item_id", "quantity", "reason") == [
        ("1", 7, "no order date"), ("2", 2_000_000_000, "no order date"), ("3", 1, "order not found"),
    ]
    land({**{t: first(spark)[t] for t in ("customers", "products")}, "orders": fd.orders(spark, ("U", 10, 1, DAY, 1))}, root)
    run(w, root, 2)
    assert rows(w.facts(), "quantity") == [(7,)]
    assert rows(keyed_state.waiting_items(w), "item_id", "reason") == [("2", "total too large"), ("3", "order not found")]
    assert not list(w.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(w.root).where("path like '%_staging%'").take(1))


def test_work_grows_with_the_batch(spark, root):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    many = 300
    land({
        "customers": fd.customers(spark, *[("I", i, "a", "x", 0) for i in range(many)]), "products": fd.products(spark, *[("I", i, "p", "1.00", 0) for i in range(many)]),
        "orders": fd.orders(spark, *[("I", i, i, DAY, 0) for i in range(many)]), "order_items": fd.items(spark, *[("I", i, i, i, 1, "1.00", 0) for i in range(many)]),
    }, root)
    query = run(w, root, 0)
    total = sum(s.numRowsTotal for s in query.lastProgress.stateOperators)
    assert total > many and w.facts().count() == many
    land({"customers": fd.customers(spark, ("U", 5, "a", "NEW", 1)), "order_items": fd.items(spark, ("I", 9999, 5, 7, 1, "1.00", 1))}, root)
    query = run(w, root, 1)
    assert updated(query) <= 2 * keyed_state.SPREAD
    assert rows(w.facts().where("_batch_id = 1"), "order_id") == [(5,)]
    assert rows(w.dimension("dim_customer").where("customer_id = 5"), "city", "is_current") == [("NEW", True), ("x", False)]


def test_a_batch_that_stops_before_its_commit(spark, root):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    land(first(spark), root)
    w._commit, commit = None, w._commit
    with pytest.raises(Exception, match="not callable"):
        run(w, root, 0)
    w._commit = commit
    assert w.facts().isEmpty()
    run(w, root, 1)
    assert rows(w.facts(), "order_id") == [(10,)] and len(versions(w)) == 2


def test_winner_as_in_batches(spark):
    rng = random.Random(3)
    data = [(rng.choice(["I", "U", "D", None, "x"]), rng.randint(1, 40), None, None, None, n, rng.choice([None, fd.at(1), fd.at(2), fd.at(3)])) for n in range(200)]
    feed = spark.createDataFrame(data, "Op string, id int, name string, city string, country string, place int, Timestamp timestamp_ntz")
    expected = {r["id"]: r["place"] for r in dedup_changes(feed, seq=("place",)).collect()}
    rank = {"I": 1, "U": 2, "D": 3}
    groups = {}
    for op, i, *_, n, at in data:
        groups.setdefault(i, []).append(Row(rank=rank.get(op, 0), micros=None if at is None else int((at - dt.datetime(1970, 1, 1)).total_seconds() * 1e6), arrival=[f"{n:09d}"]))
    assert {i: int(keyed_state.winner(g)["arrival"][0]) for i, g in groups.items()} == expected




def test_neighbouring_ids_share_a_key_of_the_state(spark, root):
    w = Warehouse(spark, scratch_dir(spark, "keyed"))
    many = 640
    # One item comes again while it waits, in another form; ids below zero have neighbours too.
    land({"order_items": fd.items(spark, *[("I", i, i - 20, 100, 1, "1.00", 0) for i in range(many)])}, root)
    query = run(w, root, 0)
    assert updated(query) <= many / 4  # a block of orders at a time, not an order
    land({"order_items": fd.items(spark, ("U", 3, -17, 100, 7, "2.50", 1)), "orders": fd.orders(spark, *[("I", i - 20, 1, DAY, 0) for i in range(0, many, 2)])}, root)
    run(w, root, 1)
    waits = keyed_state.waiting_items(w)
    assert waits.groupBy("reason").count().orderBy("reason").collect() == [Row(reason="no current customer", count=many // 2), Row(reason="order not found", count=many // 2)]
    assert [(r["order_id"], r["quantity"], str(r["unit_price"])) for r in waits.where("quantity > 1").collect()] == [(-17, 7, "2.50")]
    land({t: first(spark)[t] for t in ("customers", "products")} | {"orders": fd.orders(spark, ("I", -17, 1, DAY, 0))}, root)
    run(w, root, 2)
    assert w.facts().count() == many // 2 + 1 and rows(w.facts().where("order_id < 0 AND quantity = 7"), "order_id") == [(-17,)]
    assert keyed_state.waiting_items(w).count() == many // 2 - 1


class Map:
    """A map state that counts what it is asked."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def exists(self):
        return bool(self.held)

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls += 1
        del self.held[key]

    def getMapState(self, *_):  # noqa: N802
        return self


def packed(kind, table, parted_by=None):
    deal = keyed_state.Deal(keyed_state.ORDERS.bits, 4, 2)
    batches = keyed_state._Pack(kind, deal, "order_id", parted_by)(iter(table.to_batches(1000)))
    return [Row(**row) for batch in batches for row in batch.to_pylist()], deal


def test_a_large_batch_makes_few_packets_and_asks_the_state_seldom():
    many = 5000
    changes = {"rank": pa.array([1] * many), "micros": pa.array([0] * many), "a0": pa.array([0] * many)}
    n = pa.array(range(many))
    items = pa.table({"order_id": n, "item_id": n, "product_id": n, "quantity": n.cast(pa.int32()), "unit_price": n.cast(pa.decimal128(21, 2)).cast(pa.decimal128(10, 2)), "total_amount": n.cast(pa.decimal128(21, 2)).cast(pa.decimal128(12, 2)), **changes})
    orders = pa.table({"order_id": n, "customer_id": n, "order_timestamp": pa.array([DAY] * many).cast(pa.timestamp("us")), "order_status": pa.array(["x"] * many), **changes})
    rows, deal = packed("item", items, "item_id")
    assert len(rows) == 8 and sum(keyed_state._table([r["data"]]).num_rows for r in rows) == many
    handles, found = {(b, p): Map() for b in range(4) for p in range(2)}, []
    for batch in (rows, packed("order", orders)[0]):
        for key, handle in handles.items():
            step = keyed_state._Orders(T.LongType(), deal, keyed_state.Deal(10, 1, 1))
            step.init(handle)
            found += step.handleInputRows(key, iter([r for r in batch if (r["bucket"], r["part"]) == key]), None)
    lines = keyed_state._table([r["data"] for r in found])
    assert sorted(lines["order_id"].to_pylist()) == sorted(lines["customer_id"].to_pylist()) == list(range(many))
    # In both batches, a block of 256 orders at a time and part: two writes, then a look, one entry read and dropped, and a write.
    assert sum(handle.calls for handle in handles.values()) <= 2 * (many // 256 + 1) * 6


def test_winners_of_many_keys():
    rng = random.Random(5)
    rows = [{"id": rng.randint(1, 60), "item": rng.randint(1, 3), "rank": rng.randint(0, 3), "micros": rng.choice([None, 1, 2, -3]), "a0": rng.choice([None, 1, 2, 30, -4]), "a1": rng.choice([None, "b", "ab", "c"]), "at": n} for n in range(900)]

    def counts(changes):
        best = sorted((c for c in changes if c["rank"] == max(c["rank"] for c in changes)), key=lambda c: [(c[a] is not None, c[a]) for a in ("a0", "a1")])
        return best[0] if best[0]["micros"] is None else max(best, key=lambda c: (c["micros"] is not None, c["micros"] or 0))

    groups = {}
    for row in rows:
        groups.setdefault((row["id"], row["item"]), []).append(row)
    won = keyed_state.winners(pa.Table.from_pylist(rows), ["id", "item"])
    assert {(r["id"], r["item"]): r["at"] for r in won.to_pylist()} == {key: counts(changes)["at"] for key, changes in groups.items()}
    assert won.num_rows == len(groups)
