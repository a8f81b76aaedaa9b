"""The star kept up to date from keyed state instead of from its own tables.

``micro_batch.start`` looks up what a batch needs in the stored tables. Here a
state store on each executor's disk (RocksDB) holds, by key, what later changes
need to know, so a batch reads and writes the state of its own keys only:

* by order: the latest form of the order, and items that have no order yet;
* by customer, and by product: the current version, and lines that wait for it.

Neighbouring ids share a key of the state, a block, so that a batch asks for a block once and not for each id.
Rows travel between the steps as Arrow tables, and each step works on their columns.

An item meets its order, then asks for its customer, then for its product, each a
stateful step of one streaming query; what comes out at the end are facts,
versions that open and versions that close, appended to the warehouse's logs. The
streaming checkpoint holds the state, so a stopped query goes on where it was.

Keys that hold a large share of the rows are dealt to ``spread`` parts: lines by
the hash of their item, while changes of an order, customer or product go to all
parts, each of which keeps its own copy.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidestar.functions.convert import epoch_micros, to_decimal_safe, to_int_safe, to_string_safe, to_timestamp_safe
from tidestar.functions.keys import op_priority
from tidestar.operators import CUSTOMER, PRODUCT, Dimension, build_dim_date, dim_date_upsert, facts_of
from tidestar.operators.dimensions import customer_columns, product_columns
from tidestar.plans.warehouse import Warehouse
from tidestar.schemas import AMOUNT, NTZ, PRICE, feed_schema, star_schema
from tidestar.sources.files import ARRIVAL, PARQUET_GLOB
from tidestar.streaming.micro_batch import MAX_FILES

# Parts of a key. Dimension changes are copied to each, so a dimension's state grows with it.
SPREAD = 4
ORDER_SPREAD = 2

COLUMNS = {"customers": customer_columns, "products": product_columns}
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch then uploads the keys it changed, not its whole part of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Packets are large rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

_ORDER = [("customer_id", None), ("order_timestamp", NTZ), ("order_status", T.StringType())]
_ITEM = [("item_id", T.LongType()), ("product_id", None), ("quantity", T.IntegerType()), ("unit_price", PRICE), ("total_amount", AMOUNT)]


def _struct(fields: list[tuple[str, T.DataType | None]], id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t or id_type) for n, t in fields])


def _line(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("order_id", id_type), *_struct(_ITEM, id_type).fields, *_struct(_ORDER, id_type).fields])


def _version(dim: Dimension, id_type: T.DataType) -> T.StructType:
    """A row of the dimension's log."""
    kinds = star_schema(dim.table, id_type)
    return T.StructType([T.StructField("event", T.StringType()), T.StructField("opened_in", T.LongType()), *[T.StructField(c, kinds[c].dataType) for c in dim.columns]])


# ---- packets ------------------------------------------------------------
#
# Rows that go from step to step travel as Arrow tables, those of one key in one value: Python then works on columns,
# and a row costs a fraction of what it costs as a Python object.

_PACKET = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("data", T.BinaryType())])
# Rows a task of the source gathers before it deals them out, and rows of a packet or of an entry of a waiting list at most.
PACK_ROWS, CHUNK = 500_000, 100_000


@dataclass(frozen=True)
class Deal:
    """How ids are dealt out: blocks of neighbouring ids (their upper bits) share a key of the state, blocks fall to ``buckets``, of ``parts`` parts each."""

    bits: int
    buckets: int
    parts: int = 1


ORDERS, DIMENSION = Deal(8, 128), Deal(10, 64)


def _bytes(table: pa.Table) -> bytes:
    # Not compressed: shuffles and state are. Threads of their own would cost more than so few rows take.
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(use_threads=False)) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _table(data: list[bytes]) -> pa.Table:
    options = pa.ipc.IpcReadOptions(use_threads=False)
    return pa.concat_tables([pa.ipc.open_stream(d, options=options).read_all() for d in data]).combine_chunks()


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].fill_null(0).cast(pa.int64()).to_numpy()


def _valid(table: pa.Table, name: str) -> np.ndarray:
    return table[name].is_valid().to_numpy()


def _runs(sorted_codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last place of each run of equal values."""
    if len(sorted_codes):
        ends = [*(np.flatnonzero(sorted_codes[1:] != sorted_codes[:-1]) + 1).tolist(), len(sorted_codes)]
        yield from zip([0, *ends], ends, strict=False)


def _find(sorted_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ids among others, and whether they are there."""
    if not len(sorted_ids):
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
    return at, sorted_ids[at] == ids


def _part_of(items: np.ndarray, parts: int) -> np.ndarray:
    """The part of each item, by a hash of its id."""
    return ((items.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _dealt(table: pa.Table, deal: Deal, id_: str, parted_by: str | None = None) -> Iterator[tuple[int, int, pa.Table]]:
    """Bucket, part and rows; part 0 unless there is a column to tell it."""
    if not table.num_rows:
        return
    code = (_numbers(table, id_) >> deal.bits) % deal.buckets * deal.parts
    if parted_by:
        code += _part_of(_numbers(table, parted_by), deal.parts)
    order = np.argsort(code, kind="stable")
    table, code = table.combine_chunks().take(pa.array(order)), code[order]
    for first, last in _runs(code):
        yield int(code[first]) // deal.parts, int(code[first]) % deal.parts, table.slice(first, last - first)


def _packets(table: pa.Table, kind: str, deal: Deal, id_: str, parted_by: str | None = None) -> Iterator[Row]:
    for bucket, part, rows in _dealt(table, deal, id_, parted_by):
        for first in range(0, rows.num_rows, CHUNK):
            yield Row(bucket=bucket, part=part, kind=kind, data=_bytes(rows.slice(first, CHUNK)))


@dataclass(frozen=True)
class _Pack:
    """Rows of a source to packets, for ``mapInArrow``. Without ``parted_by`` rows go to all parts, to the first with ``whole`` columns more."""

    kind: str
    deal: Deal
    id_: str
    parted_by: str | None = None
    whole: tuple[str, ...] = ()

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK_ROWS:
                yield from self.packed(held)
                held, n = [], 0
        if n:
            yield from self.packed(held)

    def packed(self, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        if self.parted_by:
            rows = list(_packets(table, self.kind, self.deal, self.id_, self.parted_by))
        else:
            rows = []
            for packet in _packets(table.drop_columns(list(self.whole)), self.kind, self.deal, self.id_):
                rows += [Row(**packet.asDict() | {"part": part}) for part in range(bool(self.whole), self.deal.parts)]
            if self.whole:
                rows += _packets(table, self.kind, self.deal, self.id_)
        yield _batch(rows)


def _batch(packets: list[Row]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "part": pa.int32(), "kind": pa.string(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([p[c] for p in packets], kind) for c, kind in kinds.items()], names=list(kinds))


def _unpacked(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packets to rows with the packet's kind filled and the other kinds null, for ``mapInArrow``."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data"), strict=True):
                table = _table([data.as_py()])
                own = {f.name: pa.StructArray.from_arrays([table[c.name].chunk(0).cast(c.type) for c in f.type], fields=list(f.type)) for f in target if f.name == kind}
                yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(table.num_rows, f.type)) for f in target], schema=target)

    return run


# ---- winners --------------------------------------------------------------


def _ranks(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that sort as the values do, nulls aside."""
    if pa.types.is_integer(column.type):
        return column.fill_null(0).cast(pa.int64()).to_numpy()
    codes = column.fill_null("").combine_chunks().dictionary_encode()
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    rank = np.empty(len(codes.dictionary), np.int64)
    rank[pc.sort_indices(codes.dictionary).to_numpy()] = np.arange(len(rank))
    return rank[codes.indices.to_numpy()]


def winners(changes: pa.Table, keys: list[str]) -> pa.Table:
    """Of each key's changes, each with rank, micros and its arrival (a0, a1, ..., nulls first), the one that counts, as in ``dedup_changes``."""
    ids = [_numbers(changes, k) for k in keys]
    order = np.lexsort(ids[::-1])
    same = np.ones(max(len(order) - 1, 0), bool)
    for column in ids:
        same &= column[order][1:] == column[order][:-1]
    if not same.any():
        return changes
    after = np.concatenate([[False], same])
    several = after | np.concatenate([same, [False]])
    rows, group = order[several], np.cumsum(~after)[several]
    own = changes.take(pa.array(rows))
    arrival = sorted((c for c in changes.column_names if c[:1] == "a" and c[1:].isdigit()), key=lambda c: int(c[1:]))
    by = [key for c in arrival for key in (_valid(own, c), _ranks(own[c]))]
    rank = _numbers(own, "rank")
    order2 = np.lexsort([*by[::-1], ~rank, group])
    rows, group, rank = rows[order2], group[order2], rank[order2]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    top = rank == rank[first][np.cumsum(first) - 1]
    timed = _valid(own, "micros")[order2]
    # The first to arrive counts if it has no time; else the latest, and of those the first to arrive.
    micros = np.where(timed, _numbers(own, "micros")[order2], np.where(first, np.iinfo(np.int64).max, np.iinfo(np.int64).min))
    rows, group, micros = rows[top], group[top], micros[top]
    order3 = np.lexsort([~micros, group])
    group = group[order3]
    won = rows[order3][np.concatenate([[True], group[1:] != group[:-1]])]
    return changes.take(pa.array(np.concatenate([order[~several], won])))


def winner(changes: list[Row]) -> Row:
    """:func:`winners` of one key's changes, each with (rank, micros, arrival)."""
    columns = {"id": [0] * len(changes), "at": list(range(len(changes))), "rank": [c["rank"] for c in changes], "micros": pa.array([c["micros"] for c in changes], pa.int64())}
    arrival = {f"a{n}": list(values) for n, values in enumerate(zip(*[c["arrival"] for c in changes], strict=True))}
    return changes[winners(pa.table(columns | arrival), ["id"])["at"][0].as_py()]


# ---- state ----------------------------------------------------------------

# State of a block: at ``n`` = -1 what is known of its ids, which ids (as 64-bit numbers) have lines in the waiting list, and how
# many entries that has; from 0 on the entries, Arrow tables of lines.
_KEY = T.StructType([T.StructField("block", T.LongType()), T.StructField("n", T.LongType())])
_BLOCK = T.StructType([T.StructField("data", T.BinaryType()), T.StructField("waits", T.BinaryType()), T.StructField("entries", T.LongType())])
_HEAD = -1
# A version of a customer or product, by id: values in the order of the columns, as a JSON list of texts.
_ID = T.StructType([T.StructField("id", T.LongType())])
_LAST = T.StructType([T.StructField("opened_in", T.LongType()), T.StructField("row", T.StringType())])


class _Blocks:
    """The state of the blocks of a batch's ids: what is known of them, and lists of lines that wait, by the id in column ``id_``.

    A list is appended to, and read only if an id is asked for that has lines in it.
    """

    def __init__(self, handle: StatefulProcessorHandle, bits: int, id_: str) -> None:
        self.map, self.bits, self.id_ = handle.getMapState("blocks", _KEY, _BLOCK), bits, id_

    def open(self, *ids: np.ndarray) -> list[bytes]:
        """Read the blocks of some ids, and tell what is known of them, by ascending ids."""
        there = self.map.exists()
        self.heads, self.changed = {}, set()
        for block in np.unique(np.concatenate(ids) >> self.bits).tolist():
            data, waits, entries = (there and self.map.getValue((block, _HEAD))) or (None, b"", 0)
            self.heads[block] = [data, np.frombuffer(waits, np.int64), entries]
        return [head[0] for head in self.heads.values() if head[0] is not None]

    def by_block(self, sorted_ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        blocks = sorted_ids >> self.bits
        for first, last in _runs(blocks):
            yield int(blocks[first]), first, last

    def set(self, block: int, data: bytes) -> None:
        self.heads[block][0] = data
        self.changed.add(block)

    def wait(self, lines: pa.Table) -> None:
        """Append lines."""
        if not lines.num_rows:
            return
        ids = _numbers(lines, self.id_)
        order = np.argsort(ids >> self.bits, kind="stable")
        lines, ids = lines.combine_chunks().take(pa.array(order)), ids[order]
        for block, start, end in self.by_block(ids):
            head = self.heads[block]
            for first in range(start, end, CHUNK):
                self.map.updateValue((block, head[2]), (_bytes(lines.slice(first, min(CHUNK, end - first))), None, None))
                head[2] += 1
            head[1] = np.union1d(head[1], ids[start:end])
            self.changed.add(block)

    def take(self, sorted_ids: np.ndarray) -> pa.Table | None:
        """The waiting lines of some ids, those of an id in the order they came, out of the list."""
        taken = []
        for block, start, end in self.by_block(sorted_ids):
            head, asked = self.heads[block], sorted_ids[start:end]
            if not np.isin(head[1], asked).any():
                continue
            lines = _table([self.map.getValue((block, n))[0] for n in range(head[2])])
            for n in range(head[2]):
                self.map.removeKey((block, n))
            mine = np.isin(_numbers(lines, self.id_), asked)
            head[1], head[2] = np.empty(0, np.int64), 0
            self.changed.add(block)
            self.wait(lines.filter(pa.array(~mine)))
            taken.append(lines.filter(pa.array(mine)))
        return pa.concat_tables(taken) if taken else None

    def close(self) -> None:
        """Write the blocks that are others now."""
        for block in sorted(self.changed):
            data, waits, entries = self.heads[block]
            self.map.updateValue((block, _HEAD), (data, waits.tobytes(), entries))


def _came(rows: Iterator[Row]) -> dict[str, list[bytes]]:
    came: dict[str, list[bytes]] = {}
    for row in rows:
        came.setdefault(row["kind"], []).append(row["data"])
    return came


class _Orders(StatefulProcessor):
    """Lines of items whose order is known. State by block of orders: their latest forms, and the items that wait for one."""

    def __init__(self, id_type: T.DataType, deal: Deal, lines_to: Deal) -> None:
        self.deal, self.lines_to = deal, lines_to
        self.orders = to_arrow_schema(T.StructType([T.StructField("order_id", id_type), *_struct(_ORDER, id_type).fields]))
        self.items = to_arrow_schema(T.StructType([T.StructField("order_id", id_type), *_struct(_ITEM, id_type).fields]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = _Blocks(handle, self.deal.bits, "order_id")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        came, state = _came(rows), self.state
        changes = winners(_table(came["order"]), ["order_id"]).select(self.orders.names).cast(self.orders).sort_by("order_id") if "order" in came else self.orders.empty_table()
        items = winners(_table(came["item"]), ["order_id", "item_id"]).select(self.items.names).cast(self.items) if "item" in came else self.items.empty_table()
        changed = _numbers(changes, "order_id")
        data = state.open(changed, _numbers(items, "order_id"))
        orders = _table(data) if data else self.orders.empty_table()
        if len(changed):
            known = _numbers(orders, "order_id")
            at, found = _find(known, changed)
            before = orders.take(pa.array(at, mask=~found))
            other = ~found
            for name in self.orders.names[1:]:
                equal = pc.equal(changes[name], before[name]).fill_null(False).to_numpy()
                other |= ~(equal | (~_valid(changes, name) & ~_valid(before, name)))
            completed = changed[_valid(changes, "order_timestamp") & ~_valid(before, "order_timestamp")]
            orders = pa.concat_tables([orders.filter(pa.array(~_find(changed, known)[1])), changes]).sort_by("order_id").combine_chunks()
            ids = _numbers(orders, "order_id")
            rewritten = set((changed[other] >> self.deal.bits).tolist())
            for block, first, last in state.by_block(ids):
                if block in rewritten:
                    state.set(block, _bytes(orders.slice(first, last - first)))
            waited = state.take(completed)
            if waited is not None:
                # Of an item that waited in several forms the last one counts, and one of this batch before those.
                items = pa.concat_tables([waited, items]).combine_chunks()
                of, item = _numbers(items, "order_id"), _numbers(items, "item_id")
                order = np.lexsort([item, of])
                last = (of[order][1:] != of[order][:-1]) | (item[order][1:] != item[order][:-1])
                items = items.take(pa.array(order[np.concatenate([last, [True]])]))
        at, found = _find(_numbers(orders, "order_id"), _numbers(items, "order_id"))
        of = orders.take(pa.array(at, mask=~found)).drop_columns("order_id")
        ready = _valid(of, "order_timestamp") & _valid(items, "total_amount")
        lines = items
        for name in of.column_names:
            lines = lines.append_column(name, of[name])
        state.wait(items.filter(pa.array(~ready)))
        state.close()
        yield from _packets(lines.filter(pa.array(ready)), "line", self.lines_to, "customer_id", "item_id")

    def close(self) -> None:
        pass


class _Lookup(StatefulProcessor):
    """Lines whose customer (or product) is current, and the versions that changes open and close.

    State by block of ids: which are current, and the lines that wait; in the first part also the last version
    of each id, with its number. Rows of one bucket and part in one batch are held in memory: the batch's files
    and ``spread`` bound them.
    """

    def __init__(self, dim: Dimension, id_type: T.DataType, deal: Deal, lines_to: Deal | None, line_to: str | None) -> None:
        self.dim, self.deal, self.lines_to, self.line_to = dim, deal, lines_to, line_to
        self.version = to_arrow_schema(_version(dim, id_type))
        self.line = to_arrow_schema(_line(id_type))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = _Blocks(handle, self.deal.bits, self.dim.natural_id)
        self.versions = handle.getMapState("versions", _ID, _LAST)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        came, state, id_ = _came(rows), self.state, self.dim.natural_id
        at = {"bucket": key[0], "part": key[1]}
        for kind in came.keys() - {"change", "line"}:  # versions of the step before
            for data in came[kind]:
                yield Row(**at, kind=kind, data=data)
        if not came.keys() & {"change", "line"}:
            return
        changes = winners(_table(came["change"]), [id_]).sort_by(id_).combine_chunks() if "change" in came else None
        lines = _table(came["line"]) if "line" in came else self.line.empty_table()
        changed = _numbers(changes, id_) if changes is not None else np.empty(0, np.int64)
        current = np.concatenate([np.empty(0, np.int64), *[np.frombuffer(d, np.int64) for d in state.open(changed, _numbers(lines, id_))]])
        if len(changed):
            is_now = changes["is_current"].to_numpy()
            was = _find(current, changed)[1]
            now = np.union1d(np.setdiff1d(current, changed, assume_unique=True), changed[is_now])
            blocks = now >> self.deal.bits
            for block in np.unique(changed[is_now != was] >> self.deal.bits).tolist():
                state.set(block, now[np.searchsorted(blocks, block):np.searchsorted(blocks, block, side="right")].tobytes())
            current = now
            if key[1] == 0:  # the other parts say nothing
                for versions in self.events(changes, changed):
                    for first in range(0, versions.num_rows, CHUNK):
                        yield Row(**at, kind=self.dim.table, data=_bytes(versions.slice(first, CHUNK)))
            taken = state.take(changed[is_now & ~was])
        else:
            taken = None
        there = _find(current, _numbers(lines, id_))[1]
        state.wait(lines.filter(pa.array(~there)))
        state.close()
        lines = lines.filter(pa.array(there))
        if taken is not None:
            lines = pa.concat_tables([taken, lines])
        if self.lines_to:
            yield from _packets(lines, "line", self.lines_to, self.line_to, "item_id")
        else:
            for first in range(0, lines.num_rows, CHUNK):
                yield Row(**at, kind="line", data=_bytes(lines.slice(first, CHUNK)))

    def events(self, changes: pa.Table, ids: np.ndarray) -> Iterator[pa.Table]:
        """Versions that open and close, and the state of the last ones."""
        names = self.dim.columns
        place = {name: n for n, name in enumerate(names)}
        there = self.versions.exists()
        opened, opened_in, closed = [], [], []
        for n, (id_, text, is_current) in enumerate(zip(ids.tolist(), changes["row"].to_pylist(), changes["is_current"].to_pylist(), strict=True)):
            last = self.versions.getValue((id_,)) if there else None
            old = json.loads(last[1]) if last else None
            before = old is not None and old[place["is_current"]] == "true"
            number, state = last[0] if last else -1, None
            if before:
                new = json.loads(text)
                if is_current and all(old[place[c]] == new[place[c]] for c in self.dim.attributes):
                    continue
                old[place["effective_end_date"]], old[place["is_current"]] = new[place["effective_start_date"]], "false"
                closed.append([str(number), *old])
                state = (number, json.dumps(old))
            if not before or is_current:
                opened.append(n)
                opened_in.append(number + 1)
                state = (number + 1, text)
            self.versions.updateValue((id_,), state)
        if opened:
            rows = changes.take(pa.array(opened))
            columns = [pa.array(["open"] * len(opened)), pa.array(opened_in, pa.int64()), *[rows[name] for name in names]]
            yield pa.table([c.cast(f.type) for c, f in zip(columns, self.version, strict=True)], schema=self.version)
        if closed:
            columns = [pa.array(["close"] * len(closed))]
            for field, texts in zip(list(self.version)[1:], zip(*closed, strict=True), strict=True):
                columns.append(pa.array([None if t is None else _READERS.get(field.type.id, str)(t) for t in texts], field.type))
            yield pa.table(columns, schema=self.version)

    def close(self) -> None:
        pass


# What reads the texts of a version's values.
_READERS = {
    pa.int32().id: int, pa.int64().id: int, pa.bool_().id: lambda t: t == "true", pa.timestamp("us").id: dt.datetime.fromisoformat,
    pa.decimal128(10, 2).id: Decimal,
}


def _feed(spark: SparkSession, prefix: str, table: str, id_type: T.DataType, max_files: int) -> DataFrame:
    """Changes of one table as a stream; the folder may not be there yet."""
    rows = (
        spark.readStream.schema(feed_schema(table, id_type))
        .option("pathGlobFilter", PARQUET_GLOB).option("maxFilesPerTrigger", max_files)
        .parquet(f"{prefix}/*/{table}")
    )
    return rows.select("*", F.col("_metadata.file_modification_time").alias("_file_time"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _ranked(feed: DataFrame, arrival: tuple[str, ...]) -> list[Column]:
    kind = feed.schema["Timestamp"].dataType
    return [op_priority(F.col("Op")).alias("rank"), epoch_micros(F.col("Timestamp"), kind).alias("micros"), *[_sortable(feed, c).alias(f"a{n}") for n, c in enumerate(arrival)]]


def _sortable(feed: DataFrame, name: str) -> Column:
    """A number or text that sorts as the column does; numbers of arrival that are no whole numbers are not negative."""
    kind = feed.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return epoch_micros(F.col(name), kind)
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= 15:
        return (F.col(name) * F.lit(10**kind.scale)).cast("bigint")
    if isinstance(kind, T.DecimalType):
        return F.lpad(F.col(name).cast("string"), kind.precision + 2, "0")
    if isinstance(kind, T.NumericType):
        return F.lpad(F.col(name).cast("string"), 20, "0")
    return F.col(name).cast("string")


def star_stream(
    spark: SparkSession, prefix: str, stamp: Column, *, id_type: T.DataType, arrival: dict[str, tuple[str, ...]] | None = None,
    max_files: int = MAX_FILES, spread: int = SPREAD, order_spread: int = ORDER_SPREAD,
) -> DataFrame:
    """What each micro-batch adds to the star: ``line``, ``customer``, ``product`` or ``date``, one of them filled in each row.

    An item counts by its order: a change that moves it to another order is a further item there.
    """
    arrival = arrival or {t: ARRIVAL for t in ("customers", "products", "orders", "order_items")}
    feed = {t: _feed(spark, prefix, t, id_type, max_files) for t in arrival}
    null = lambda t: F.lit(None).cast(t)
    of_orders, of_dimension = replace(ORDERS, parts=order_spread), replace(DIMENSION, parts=spread)

    orders, items = feed["orders"].where("id IS NOT NULL"), feed["order_items"].where("id IS NOT NULL")
    price = to_decimal_safe(F.col("unit_price"), PRICE)
    quantity = to_int_safe(F.col("quantity"), T.IntegerType())
    order_rows = orders.select(
        to_int_safe(F.col("id"), id_type, id_type).alias("order_id"), to_int_safe(F.col("customer_id"), id_type, id_type).alias("customer_id"),
        to_timestamp_safe(F.col("order_date"), T.DateType()).alias("order_timestamp"), to_string_safe(F.col("status")).alias("order_status"),
        *_ranked(orders, arrival["orders"]),
    )
    item_rows = items.select(
        to_int_safe(F.col("order_id"), id_type, id_type).alias("order_id"), F.col("id").cast("bigint").alias("item_id"),
        to_int_safe(F.col("product_id"), id_type, id_type).alias("product_id"), quantity.alias("quantity"), price.alias("unit_price"),
        (price * quantity).try_cast(AMOUNT).alias("total_amount"), *_ranked(items, arrival["order_items"]),
    )
    packets = order_rows.mapInArrow(_Pack("order", of_orders, "order_id"), _PACKET).unionByName(
        item_rows.mapInArrow(_Pack("item", of_orders, "order_id", "item_id"), _PACKET))
    found = packets.groupBy("bucket", "part").transformWithState(_Orders(id_type, of_orders, of_dimension), _PACKET, "Append", "None")
    for dim, table, after in ((CUSTOMER, "customers", PRODUCT), (PRODUCT, "products", None)):
        changes = feed[table].where("id IS NOT NULL")
        built = changes.select(*COLUMNS[table](changes, stamp, id_type), *_ranked(changes, arrival[table]))
        built = built.select("*", F.to_json(F.array(*[F.col(c).cast("string") for c in dim.columns])).alias("row"))
        whole = ("row", *[c for c in dim.columns if c not in (dim.natural_id, "is_current")])
        changed = built.mapInArrow(_Pack("change", of_dimension, dim.natural_id, whole=whole), _PACKET)
        lookup = _Lookup(dim, id_type, of_dimension, after and of_dimension, after and after.natural_id)
        found = changed.unionByName(found).groupBy("bucket", "part").transformWithState(lookup, _PACKET, "Append", "None")

    line_type = T.StructType([T.StructField(f.name, T.StringType() if f.name == "item_id" else f.dataType) for f in _line(id_type).fields])
    versions = {d: _version(d, id_type) for d in (CUSTOMER, PRODUCT)}
    schema = T.StructType([T.StructField("line", line_type), *[T.StructField(d.table, kind) for d, kind in versions.items()]])
    found = found.mapInArrow(_unpacked(schema), schema).withColumnsRenamed({CUSTOMER.table: "customer", PRODUCT.table: "product"})
    dates = build_dim_date(orders)
    date = F.struct(*dates.columns)
    out = found.select("*", null(dates.select(date.alias("d")).schema["d"].dataType).alias("date"))
    return out.unionByName(dates.select(null(line_type).alias("line"), null(versions[CUSTOMER]).alias("customer"), null(versions[PRODUCT]).alias("product"), date.alias("date")))


def write_additions(warehouse: Warehouse, additions: DataFrame, batch_id: int, batch_ts: Column) -> dict[str, int]:
    """Append one micro-batch of :func:`star_stream` to the warehouse and commit it. A batch id that is committed is left alone."""
    done = warehouse.commits().where(F.col("batch_id") == batch_id).select("table_name", "rows").collect()
    if done:
        return {r["table_name"]: r["rows"] for r in done}
    # Each look at the batch would run its state again, so it is written once.
    staged = warehouse.stage(additions, "additions", batch_id)
    rows = {
        dim.table: warehouse._put(staged.where(F.col(name).isNotNull()).select(f"{name}.*").select(*[f.name for f in warehouse.schema(dim.table).fields if f.name != "_batch_id"]), dim.table, batch_id)
        for name, dim in (("customer", CUSTOMER), ("product", PRODUCT))
    }
    dates = staged.where("date IS NOT NULL").select("date.*")
    rows["dim_date"] = warehouse._put(dim_date_upsert(warehouse.dates(batch_id - 1), dates), "dim_date", batch_id)
    lines = staged.where("line IS NOT NULL").select("line.*", F.col("line.order_timestamp").cast("date").alias("order_date"), F.lit(None).cast("string").alias("reason"))
    rows["fact_orders"] = warehouse.write_facts(facts_of(lines), batch_id)
    warehouse._commit(rows, batch_id, batch_ts)
    warehouse.unstage("additions", batch_id)
    return rows


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings a query takes when it starts."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(
    warehouse: Warehouse, prefix: str, *, once: bool = True, interval: str = "60 seconds", clock: Column | None = None, **options: object,
) -> StreamingQuery:
    """Run the stream: all files now present (``once``), or every ``interval``. ``clock`` gives the time of a batch.

    The checkpoint lies with the warehouse. A warehouse is fed by this or by ``micro_batch``, not by both.
    """
    warehouse.create_tables()
    # Spark takes one time for a whole batch, and the same one if the batch is run again.
    stamp = clock if clock is not None else F.current_timestamp().cast("timestamp_ntz")
    with _state_settings(warehouse.spark):
        additions = star_stream(warehouse.spark, prefix, stamp, id_type=warehouse.id_type, **options)
        writer = additions.writeStream.outputMode("append").foreachBatch(
            lambda frame, batch_id: write_additions(warehouse, frame, batch_id, stamp) and None
        ).option("checkpointLocation", f"{warehouse.root}/_keyed")
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


# The numbers Spark gives to the stateful steps of the query, counted from its end.
_PRODUCTS, _CUSTOMERS, _ORDERS = 0, 1, 2


def waiting_items(warehouse: Warehouse) -> DataFrame:
    """The items that gave no fact yet, read from the state: order_id, item_id, product_id, quantity, unit_price, reason."""
    kinds = {"order_id": warehouse.id_type, "item_id": T.StringType(), "product_id": warehouse.id_type, "quantity": T.IntegerType(), "unit_price": PRICE, "reason": T.StringType()}
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])

    def state(operator: int) -> DataFrame:
        reader = warehouse.spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "blocks")
        blocks = reader.load(f"{warehouse.root}/_keyed")
        return blocks.select("key", F.col("user_map_key.block").alias("block"), F.col("user_map_key.n").alias("n"), F.col("user_map_value.data").alias("data"))

    # What is known of a block's orders comes to the items that wait there; packed as they are.
    entry = F.when(F.col("n") >= 0, F.struct("n", "data"))
    blocks = state(_ORDERS).groupBy("key", "block").agg(F.max(F.when(F.col("n") == _HEAD, F.col("data"))).alias("known"), F.sort_array(F.collect_list(entry)).alias("lists"))
    rows = blocks.where("size(lists) > 0").select("known", F.col("lists.data").alias("lists")).mapInArrow(_judged(schema), schema)
    for operator, why in ((_CUSTOMERS, "no current customer"), (_PRODUCTS, "no current product")):
        rows = rows.unionByName(state(operator).where("n >= 0").select("data").mapInArrow(_listed(schema, why), schema))
    return rows


def _result(lines: pa.Table, reasons: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    columns = [reasons if f.name == "reason" else lines[f.name].cast(f.type) for f in schema]
    return pa.table(columns, schema=schema).combine_chunks().to_batches()[0]


def _judged(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Items that wait for their order, or have no price or total, of blocks (known, lists), for ``mapInArrow``."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for known, lists in zip(batch.column("known"), batch.column("lists"), strict=True):
                items = _table(lists.as_py())
                # An item may have come again while it waited; its last form counts.
                of, item = _numbers(items, "order_id"), _numbers(items, "item_id")
                order = np.lexsort([item, of])
                last = (of[order][1:] != of[order][:-1]) | (item[order][1:] != item[order][:-1])
                items = items.take(pa.array(order[np.concatenate([last, [True]])]))
                there = dated = np.zeros(items.num_rows, bool)
                if known.is_valid:
                    orders = _table([known.as_py()])
                    at, there = _find(_numbers(orders, "order_id"), _numbers(items, "order_id"))
                    dated = _valid(orders, "order_timestamp")[at] & there
                reason = np.where(~there, "order not found", np.where(~dated, "no order date", np.where(~_valid(items, "unit_price"), "unit price too large", "total too large")))
                yield _result(items, pa.array(reason, pa.string()), target)

    return run


def _listed(schema: T.StructType, reason: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                lines = _table([data.as_py()])
                yield _result(lines, pa.array([reason] * lines.num_rows, pa.string()), target)

    return run
