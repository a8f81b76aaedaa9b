"""Code lengths of texts by context-tree weighting over bytes, and a word base line.

Each byte is taken as eight binary decisions, most significant bit first; a
decision has one of 255 places, told by the bits before it. Each place has a
tree of contexts: the node at depth d stands for the d bytes before. A node
counts zeros and ones (a, b), and estimates the next bit as one with
(b + 1/2) / (a + b + 1), Krichevsky and Trofimov's estimate. With Pe the
estimate's probability of all a + b bits of a node, its weighted probability is

    Pw = Pe at the deepest level, else (Pe + product of the children's Pw) / 2

so all depths are mixed, each node by how well it and its children did. The
probability of a further bit is the ratio of the root's Pw with that bit and
without it. Along the path of nodes that is a sum: a node gives its estimate the
share beta / (1 + beta) of what is left, beta = Pe / product of children's Pw,
and the deepest one all of the rest.

Counting is a sum over all learned texts; nothing is sampled. Texts are dealt
into blocks of some ``BLOCK_BYTES`` in the order of the scan, written with the
distinct grams (context and byte) of each block, packed by part: all grams that
agree in the last three bytes of the context are in one part. A part sums its
grams over the blocks and its tree up to depth three; these nodes are summed up
by last byte, and the rest, which is 256 x 255 nodes at most, on the driver. On
the way back the shares go down the same way, and each block gets the
probabilities of its own grams, so a task holds one block or one part and no
table of the corpus. A part that is spread over many blocks is read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.shared import col, ship, table, written

DEPTH = 5  # bytes of context; 4 to 6
BLOCK_BYTES = 16 << 20
PARTS = 2048  # a power of two
CHUNK = 1 << 20
END = 0xFF  # the symbol after the last byte of a text: no byte of UTF-8
END_TOKEN = 0  # key of the token after the last word
TEXT, GRAM, TOKEN = 0, 1, 2  # kinds of rows of a block
U64 = np.uint64


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series at x + 8."""
    y, rising = x + 8, x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * y * y)) / (y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(rising)


def log_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - np.log(np.pi) - log_gamma(a + b + 1.0)


class Level:
    """Nodes of one depth. ``keys``: sorted (context, place), the most recent byte of the context first; ``below``: log of the children's product, None at the deepest."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        self.keys, self.zeros, self.ones, self.below = keys, zeros, ones, below
        self.log_pe = log_estimate(zeros, ones)
        self.parent: np.ndarray | None = None

    def up(self) -> Level:
        """The level above. Its nodes have all their children here."""
        log_pw = self.log_pe if self.below is None else np.logaddexp(self.log_pe, self.below) - np.log(2)
        keys, self.parent = np.unique(((self.keys >> U64(16)) << U64(8)) | (self.keys & U64(255)), return_inverse=True)
        add = lambda v: np.bincount(self.parent, weights=v, minlength=len(keys))
        return Level(keys, add(self.zeros), add(self.ones), add(log_pw))

    def down(self, one: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the nodes from the root to here say about a one, and the share that is left to deeper ones, from what the parents' levels say."""
        if self.parent is not None:
            one, rest = one[self.parent], rest[self.parent]
        share = 1.0 if self.below is None else 0.5 * (1 + np.tanh((self.log_pe - self.below) / 2))
        return one + rest * share * (self.ones + 0.5) / (self.zeros + self.ones + 1), rest * (1 - share)


def leaves(grams: np.ndarray, counts: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
    """The deepest level of distinct grams; for each gram and bit its node, and whether the bit is one."""
    byte = (grams & U64(255)).astype(np.int64)
    bits = np.arange(8)
    place = (1 << bits) | (byte[:, None] >> (8 - bits))
    one = ((byte[:, None] >> (7 - bits)) & 1).astype(bool)
    keys, node = np.unique((grams & ~U64(255))[:, None] | place.astype(U64), return_inverse=True)
    node = node.reshape(place.shape)
    each = np.broadcast_to(counts[:, None].astype(float), place.shape)
    sums = [np.bincount(node[m], weights=each[m], minlength=len(keys)) for m in (~one, one)]
    return Level(keys, sums[0], sums[1], None), node, one


def climb(level: Level, steps: int) -> list[Level]:
    levels = [level]
    for _ in range(steps):
        levels.append(levels[-1].up())
    return levels


def descend(levels: list[Level], one: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From what is known at the last of ``levels`` down to the first."""
    for level in reversed(levels[:-1]):
        one, rest = level.down(one, rest)
    return one, rest


def symbols(part: textops.Slice, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a slice, each text with ``depth`` zeros before it and ``END`` behind; which places are bytes or ends; the first place of each text, and the number of places."""
    sizes = np.diff(part.offsets) + depth + 1
    first = np.r_[0, np.cumsum(sizes)]
    out, own = np.zeros(int(first[-1]), np.uint8), np.ones(int(first[-1]), bool)
    for k in range(depth):
        own[first[:-1] + k] = False
    own[first[1:] - 1] = False
    out[own] = part.data
    out[first[1:] - 1] = END
    own[first[1:] - 1] = True
    return out, own, first


def grams_of(part: textops.Slice, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, row of each) of all bytes and ends of a slice, some ``CHUNK`` at a time."""
    out, own, first = symbols(part, depth)
    for start in range(0, len(out), CHUNK):
        stop = min(start + CHUNK, len(out))
        row = np.repeat(np.arange(len(part)), np.clip(first[1:], start, stop) - np.clip(first[:-1], start, stop))
        gram = out[start:stop].astype(U64)
        for k in range(1, depth + 1):
            before = max(k - start, 0)  # no byte stands before the first text's zeros
            gram[before:] |= out[start + before - k : stop - k].astype(U64) << U64(8 * (depth + 1 - k))
        kept = own[start:stop]
        yield gram[kept], row[kept]


def tokens_of(part: textops.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of a slice, A-Z in lower case, and the first one of each text."""
    low = textops.LOWER[part.data]
    starts, ends = textops.words(textops.Slice(part.first, low, part.offsets))
    return textops.hashes(low, starts, ends), part.per_row(starts)


class Tally:
    """Counts by key; sums up what it holds whenever that has grown by ``CHUNK`` entries."""

    def __init__(self) -> None:
        self.keys, self.counts, self.loose = [], [], 0

    def add(self, keys: np.ndarray, counted: np.ndarray) -> None:
        """Keys, and whether each one counts; one that doesn't is kept with 0."""
        for flag in (True, False):
            own = np.sort(keys[counted == flag])
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            n = np.diff(np.r_[first, len(own)]) if flag else np.zeros(len(first), np.int64)
            self.merge(own[first], n)

    def merge(self, distinct: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(distinct)
        self.counts.append(counts)
        self.loose += len(distinct)
        if self.loose > CHUNK:
            self.keys, self.counts = ([x] for x in self.total())
            self.loose = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def pack(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, first all their first bytes, then all their second ones: they compress well where they are small or near each other."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, by their differences."""
    return pack(np.diff(keys, prepend=U64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, U64), dtype=U64)


def part_of(context: np.ndarray) -> np.ndarray:
    """Part of a context of three bytes, or of a token."""
    return (textops.mix(context) & U64(PARTS - 1)).astype(np.int32)


def _by_part(kind: int, keys: np.ndarray, n: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    part = part_of(keys >> U64(8 * (depth - 2)) if kind == GRAM else keys)
    order = np.argsort(part, kind="stable")
    first = np.r_[np.flatnonzero(np.diff(part[order], prepend=-1)), len(part)]
    for a, b in zip(first, first[1:], strict=False):
        yield int(part[order[a]]), keys[order[a:b]], n[order[a:b]]


def _rows(schema: pa.Schema, count: int, **columns: object) -> pa.RecordBatch:
    """A batch of the schema with nulls in all other columns."""
    filled = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(filled, schema=schema)


def _blocks(docs: DataFrame, depth: int, block_bytes: int) -> DataFrame:
    """Rows of kind ``TEXT``: block, doc_id, text, learn; of the other kinds: block, part, keys, counts (occurrences in learned texts of the block)."""
    id_type = docs.schema["doc_id"].dataType
    types = f"block bigint, kind int, doc_id {id_type.simpleString()}, text string, learn boolean, part int, keys binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, tallies, schema = TaskContext.get().partitionId() << 32, 0, {GRAM: Tally(), TOKEN: Tally()}, None

        def counted() -> Iterator[pa.RecordBatch]:
            for kind, tally in tallies.items():
                parts = list(_by_part(kind, *tally.total(), depth))
                yield _rows(
                    schema, len(parts), block=[block] * len(parts), kind=[kind] * len(parts), part=[p for p, _, _ in parts],
                    keys=[pack_keys(k) for _, k, _ in parts], counts=[pack(n) for _, _, n in parts],
                )

        for batch in batches:
            if schema is None:
                kinds = [pa.int64(), pa.int32(), batch.column(0).type, pa.string(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
                schema = pa.schema(list(zip(("block", "kind", "doc_id", "text", "learn", "part", "keys", "counts"), kinds, strict=True)))
            for part in textops.slices(batch.column(1)):
                rows = len(part)
                ids, texts, flags = (batch.column(k).slice(part.first, rows) for k in range(3))
                learn = flags.to_numpy(zero_copy_only=False).astype(bool)
                for gram, row in grams_of(part, depth):
                    tallies[GRAM].add(gram, learn[row])
                token, at = tokens_of(part)
                tallies[TOKEN].add(token, np.repeat(learn, np.diff(at)))
                tallies[TOKEN].merge(np.array([END_TOKEN], U64), np.array([learn.sum()]))
                whole = _rows(schema, rows, block=[block] * rows, kind=[TEXT] * rows)
                for name, column in (("doc_id", ids), ("text", texts), ("learn", flags)):
                    whole = whole.set_column(schema.get_field_index(name), schema.field(name), column)
                yield whole
                size += len(part.data) + rows
                if size >= block_bytes:
                    yield from counted()
                    block, size, tallies = block + 1, 0, {GRAM: Tally(), TOKEN: Tally()}
        if size:
            yield from counted()

    return docs.mapInArrow(run, types)


def _column(frame: pa.Table, name: str, kind: type = np.float64) -> np.ndarray:
    return frame[name].to_numpy().astype(kind)


def _nodes(frame: pa.Table) -> Level:
    keys = _column(frame, "key", np.int64).view(U64)
    order = np.argsort(keys)
    return Level(keys[order], *(_column(frame, c)[order] for c in ("zeros", "ones", "below")))


NODES = [("key", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("below", pa.float64())]
# Of each part a row with its sums, and one for each of its nodes at depth three.
SUMS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64()), *NODES])
SUMS_TYPE = "kind int, part int, keys binary, counts binary, total bigint, distinct bigint, key bigint, zeros double, ones double, below double"
NODES_TYPE = "key bigint, zeros double, ones double, below double"


def _node_columns(level: Level) -> dict[str, np.ndarray]:
    return {"key": level.keys.view(np.int64), "zeros": level.zeros, "ones": level.ones, "below": level.below}


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """All rows of a kind and part in one task, one part after another."""
    return rows.repartition("kind", "part").sortWithinPartitions("kind", "part", *order)


def _part_sums(packed: DataFrame, depth: int) -> DataFrame:
    """Sums of each part over the blocks, and its nodes of depth three."""

    def finish(kind: int, part: int, tally: Tally) -> Iterator[pa.RecordBatch]:
        keys, n = tally.total()
        yield _rows(SUMS, 1, kind=[kind], part=[part], keys=[pack_keys(keys)], counts=[pack(n)], total=[int(n.sum())], distinct=[int((n > 0).sum())])
        if kind == GRAM:
            top = climb(leaves(keys, n)[0], depth - 3)[-1]
            yield _rows(SUMS, len(top.keys), kind=np.full(len(top.keys), kind), part=np.full(len(top.keys), part), **_node_columns(top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tally = None, Tally()
        for batch in batches:
            kinds, parts, keys, counts = (batch.column(k).to_pylist() for k in range(4))
            for kind, part, k, n in zip(kinds, parts, keys, counts, strict=True):
                if (kind, part) != now:
                    if now:
                        yield from finish(*now, tally)
                    now, tally = (kind, part), Tally()
                tally.merge(unpack_keys(k), unpack(n))
        if now:
            yield from finish(*now, tally)

    return _dealt(packed.select("kind", "part", "keys", "counts")).mapInArrow(run, SUMS_TYPE)


def _shares_of_three(three: DataFrame) -> DataFrame:
    """For the nodes of depth three what their ancestors say: part, key, one, rest."""
    by_byte = three.withColumn("byte", F.shiftrightunsigned("key", 24))

    def to_one(frame: pa.Table) -> pa.Table:
        return pa.table(_node_columns(climb(_nodes(frame), 2)[-1]))

    # At most 256 x 255 nodes.
    top = by_byte.groupBy("byte").applyInArrow(to_one, NODES_TYPE).toArrow()
    levels = climb(_nodes(top), 1)
    known = levels[-1].down(np.zeros(len(levels[-1].keys)), np.ones(len(levels[-1].keys)))
    shared = three.sparkSession.sparkContext.broadcast((levels[0].keys, *descend(levels, *known)))

    def from_one(frame: pa.Table) -> pa.Table:
        levels = climb(_nodes(frame), 2)
        keys, one, rest = shared.value
        at = np.searchsorted(keys, levels[-1].keys)
        one, rest = descend(levels, one[at], rest[at])
        return pa.table({"part": part_of(levels[0].keys >> U64(8)), "key": levels[0].keys.view(np.int64), "one": one, "rest": rest})

    return by_byte.groupBy("byte").applyInArrow(from_one, "part int, key bigint, one double, rest double")


def log_probabilities(grams: np.ndarray, counts: np.ndarray, steps: int, above: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Log10 of the probability of the byte of each distinct gram. ``above``: sorted nodes ``steps`` levels up and what is known there; None where that is the root."""
    level, node, bit = leaves(grams, counts)
    levels = climb(level, steps)
    top = levels[-1]
    if above is None:
        one, rest = top.down(np.zeros(len(top.keys)), np.ones(len(top.keys)))
    else:
        at = np.searchsorted(above[0], top.keys)
        one, rest = above[1][at], above[2][at]
    one, _ = descend(levels, one, rest)
    return np.log10(np.where(bit, one[node], 1 - one[node])).sum(axis=1)


def _block_values(packed: DataFrame, sums: DataFrame, shares: DataFrame, depth: int) -> DataFrame:
    """The keys of each block with their values: block, kind, keys, values. A gram's is its log10 probability, a token's its count."""
    null = lambda t: F.lit(None).cast(t)
    rows = shares.select(
        F.lit(GRAM).alias("kind"), "part", F.lit(0).alias("step"), null("bigint").alias("block"), null("binary").alias("keys"), null("binary").alias("counts"), "key", "one", "rest",
    ).unionByName(
        sums.where("keys IS NOT NULL").select("kind", "part", F.lit(1).alias("step"), "keys", "counts"), allowMissingColumns=True,
    ).unionByName(packed.select("kind", "part", F.lit(2).alias("step"), "block", "keys"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, keys, values = [], np.zeros(0, U64), np.zeros(0)
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            step = column["step"].to_numpy()
            out = {"block": [], "kind": [], "keys": [], "values": []}
            # A stretch of rows of one step; a part's shares come before its sums, and those before its blocks.
            for rows in np.split(np.arange(len(step)), np.flatnonzero(np.diff(step)) + 1):
                if not len(rows):
                    continue
                a, n = int(rows[0]), len(rows)
                if step[a] == 0:
                    above.append([column[c].slice(a, n).to_numpy() for c in ("key", "one", "rest")])
                    continue
                kinds, own = column["kind"].slice(a, n).to_pylist(), column["keys"].slice(a, n).to_pylist()
                if step[a] == 1:
                    for kind, k, c in zip(kinds, own, column["counts"].slice(a, n).to_pylist(), strict=True):
                        keys, values = unpack_keys(k), unpack(c).astype(float)
                        if kind == GRAM:
                            known = [np.concatenate(c) for c in zip(*above, strict=True)]
                            order = np.argsort(known[0].view(U64))
                            values = log_probabilities(keys, values, depth - 3, (known[0].view(U64)[order], known[1][order], known[2][order]))
                        above = []
                    continue
                for kind, block, k in zip(kinds, column["block"].slice(a, n).to_pylist(), own, strict=True):
                    out["block"].append(block)
                    out["kind"].append(kind)
                    out["keys"].append(k)
                    own_values = values[np.searchsorted(keys, unpack_keys(k))]
                    # Without their last 16 bits (a part in 3e10) values take three quarters of the room.
                    out["values"].append(pack(own_values.view(U64) & ~U64(0xFFFF)))
            yield pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int64()), pa.array(out["kind"], pa.int32()), pa.array(out["keys"], pa.binary()), pa.array(out["values"], pa.binary())], list(out))

    return _dealt(rows, "step").mapInArrow(run, "block bigint, kind int, keys binary, values binary")


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of ``wanted``, all of them in the sorted ``keys``. Looked up in order, each distinct one once."""
    order = np.argsort(wanted)
    ordered = wanted[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else order
    found = values[np.searchsorted(keys, ordered[first])]
    out = np.empty(len(wanted))
    out[order] = np.repeat(found, np.diff(np.r_[first, len(ordered)]))
    return out


def score_texts(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", *,
    depth: int = DEPTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, learned, n_bytes, score, bits_per_byte, n_tokens, n_known, train_tokens, base_score.

    ``learn`` tells the rows whose texts are counted; null counts as false. ``score`` is the log10 of
    the probability of the text's UTF-8 bytes and an end after them, ``bits_per_byte`` the same as a
    code length over the bytes and the end. The base line takes words, A-Z in lower case, and one end:
    log10 of (count + 1) / (all + distinct + 1), summed. Words are compared by 64-bit hashes.

    A null text counts as an empty one, which has its end only. Without learned texts all bits have
    the probability 1/2 and the base line is 0. Nulls elsewhere, repeated rows and an empty table
    need no care; other columns are ignored.
    """
    if not 4 <= depth <= 6:
        raise ValueError("a context has 4 to 6 bytes")
    spark = docs.sparkSession
    ship(spark)
    frame = docs.select(
        col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    rows = written(_blocks(frame, depth, block_bytes), "blocks", "zstd")
    packed = rows.where(F.col("kind") != TEXT)
    sums = written(_part_sums(packed, depth), "sums")
    train, distinct = sums.where(F.col("kind") == TOKEN).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    known = _block_values(packed, sums, _shares_of_three(sums.where("key IS NOT NULL")), depth).withColumnRenamed("block", "home")
    texts = rows.where(F.col("kind") == TEXT).select("block", "doc_id", "text", "learn")
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind, tables = _column(right, "kind", np.int8), {}
        for k in (GRAM, TOKEN):
            own = right.filter(pa.array(kind == k))
            keys = [unpack_keys(x) for x in own["keys"].to_pylist()]
            values = [unpack(x, np.float64) for x in own["values"].to_pylist()]
            keys, values = (np.concatenate(x) if x else np.zeros(0) for x in (keys, values))
            order = np.argsort(keys)
            tables[k] = keys[order], values[order]
        of_end = _lookup(*tables[TOKEN], np.array([END_TOKEN], U64))[0] if len(tables[TOKEN][0]) else 0.0
        log_of = lambda c: np.log10((c + 1) / (train + distinct + 1))
        out = {c: np.zeros(len(left), t) for c, t in (("n_bytes", np.int64), ("score", float), ("n_tokens", np.int64), ("n_known", np.int64), ("base_score", float))}
        for part in textops.slices(left["text"]):
            here = slice(part.first, part.first + len(part))
            for gram, row in grams_of(part, depth):
                out["score"][here] += np.bincount(row, weights=_lookup(*tables[GRAM], gram), minlength=len(part))
            token, at = tokens_of(part)
            count = _lookup(*tables[TOKEN], token)
            row = np.repeat(np.arange(len(part)), np.diff(at))
            out["n_bytes"][here] = np.diff(part.offsets)
            out["n_tokens"][here] = np.diff(at) + 1
            out["n_known"][here] = np.bincount(row, weights=count > 0, minlength=len(part)).astype(np.int64) + (of_end > 0)
            out["base_score"][here] = np.bincount(row, weights=log_of(count), minlength=len(part)) + log_of(of_end)
        return pa.table({
            "doc_id": left["doc_id"], "learned": left["learn"], "n_bytes": out["n_bytes"], "score": out["score"],
            "bits_per_byte": -out["score"] / np.log10(2) / (out["n_bytes"] + 1), "n_tokens": out["n_tokens"], "n_known": out["n_known"],
            "train_tokens": np.full(len(left), train, np.int64), "base_score": out["base_score"],
        })

    return texts.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(
        run, f"doc_id {id_type}, learned boolean, n_bytes bigint, score double, bits_per_byte double, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double",
    )


def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
