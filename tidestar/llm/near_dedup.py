"""Near-duplicate documents by a chosen-path similarity join.

Every document is a set of five-word shingles and has a sketch of minwise
tokens. A tree starts with all documents in its root and sends each of them to
the children of a few selected tokens, so that alike documents meet again in
small nodes. Nodes small enough are compared exhaustively; larger ones branch
on. Independent trees repeat this until the wanted recall is reached.

Only connected components are asked for, so no group is expanded into pairs:

1. documents with equal sets become one class, which one of them stands for;
2. the nodes below the roots are cut into blocks, each block is compared by its
   sketches, and only the edges of a maximum spanning forest of it are kept;
3. these edges are confirmed on the full sets and give components;
4. nodes that hold more than one component go on: they branch until they are
   small, and there all pairs across components are compared on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.shared import col, components, fixed_bytes, ship, small, table, written
from tidestar.llm.textops import U64, mix

WORDS = 5
THRESHOLD = 75  # per cent
TOKENS = 128  # minwise tokens of a sketch, 16 bits each
# Twelve trees. Every third has two children at its root, the others one: 4/3 = 1 / 0.75 on average, as below the roots.
# A pair at the threshold misses all 16 roots' children with a chance of 0.25 ** 16.
TREES = 12
ROOT_TOKENS = 16
LEAF = 256  # a node of at most so many documents is compared exhaustively; larger ones are cut into blocks of this size
# A node is also compared exhaustively if at most so many of its documents are outside its largest component: they meet
# that one's blocks, so the work is in proportion to the node. All other nodes branch.
OUTSIDE = 1024
CUT = 0.60  # sketches that agree less than this are four deviations below the threshold
DEPTH = 40  # nodes that still branch at this depth are compared exhaustively as they are

_RNG = np.random.default_rng(20)
_MULTIPLY = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_ROOT = np.arange(1, ROOT_TOKENS + 1, dtype=U64) << U64(32)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of ``TOKENS`` hash functions."""
    best = np.full(TOKENS, 0xFFFFFFFFFFFFFFFF, U64)
    for at in range(0, len(shingles), 256):
        block = shingles[at : at + 256, None] * _MULTIPLY + _ADD
        np.minimum(best, block.min(axis=0), out=best)
    return best


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, key, low, roots, tokens = [], [], [], [], []
        for part in textops.slices(batch.column(1)):
            for s in textops.shingle_sets(part, WORDS):
                n.append(len(s))
                key.append(int(s.sum(dtype=U64).view(np.int64)) if len(s) else 0)
                low.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0)
                best = minwise(s)
                roots.append(mix(best[:ROOT_TOKENS] + _ROOT).view(np.int64).tolist() if len(s) else None)
                tokens.append((mix(best) >> U64(48)).astype(np.uint16).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, key, low)), pa.array(roots, pa.list_(pa.int64())), pa.array(tokens, pa.binary())],
            ["doc_id", "n_shingles", "key", "low", "roots", "sketch"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch.column(1)):
            sets = [s.tobytes() for s in textops.shingle_sets(part, WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(sets, pa.binary())], ["rep", "shingles"])


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One or two children of each document's node: by tokens that the node selects, so all its documents agree."""
    for batch in batches:
        names = batch.schema.names
        node = batch.column(names.index("node")).to_numpy().view(U64)
        values = fixed_bytes(batch.column(names.index("sketch")), 2 * TOKENS).view(np.uint16)
        for child in (1, 2):
            choice = mix(node + U64(child))
            rows = np.flatnonzero((choice >> U64(32)) % U64(3) == 0) if child == 2 else np.arange(len(node))
            token = (choice[rows] % U64(TOKENS)).astype(np.int64)
            nodes = mix(choice[rows] ^ mix(values[rows, token].astype(U64) + U64(child << 20)))
            taken = batch.take(pa.array(rows))
            yield taken.set_column(names.index("node"), "node", pa.array(nodes.view(np.int64)))


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key``, dealt out so that no group is cut."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield _joined([*kept, batch.slice(0, cut)])
            kept = []
        elif kept and kept[-1].column(batch.schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield _joined(kept)
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _pairs(group: np.ndarray, comp: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of a group and of different components whose sketches agree in at least ``CUT``; rows are sorted by group."""
    lag = 1
    rows = np.arange(len(group))
    while True:
        rows = rows[rows + lag < len(group)]
        rows = rows[group[rows] == group[rows + lag]]
        if not len(rows):
            return
        other = rows[comp[rows] != comp[rows + lag]]
        for at in range(0, len(other), 4096):
            i = other[at : at + 4096]
            same = np.count_nonzero(tokens[i] == tokens[i + lag], axis=1)
            good = same >= CUT * TOKENS
            yield i[good], i[good] + lag, same[good]
        lag += 1


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, the edges of a maximum spanning forest by the sketches' agreement."""
    for batch in _grouped(batches, "block"):
        block, rep, node = (batch.column(k).to_numpy() for k in (0, 1, 2))
        tokens = fixed_bytes(batch.column(3), 2 * TOKENS).view(np.uint16)
        found = list(_pairs(block, rep, tokens))
        if not found:
            continue
        i, j, same = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((j, i, -same))
        forest = _Forest(len(rep))
        edges = [(x, y) for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True) if forest.join(x, y)]
        if edges:
            x, y = np.array(edges).T
            yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(np.minimum(rep[x], rep[y])), pa.array(np.maximum(rep[x], rep[y]))], ["node", "a", "b"])


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a leaf that agree with a row of another component."""
    for batch in _grouped(batches, "node"):
        node, rep, comp = (batch.column(k).to_numpy() for k in (0, 1, 2))
        tokens = fixed_bytes(batch.column(3), 2 * TOKENS).view(np.uint16)
        keep = np.zeros(len(node), bool)
        for i, j, _ in _pairs(node, comp, tokens):
            keep[i] = keep[j] = True
        if keep.any():
            yield batch.select(["node", "rep", "comp"]).filter(pa.array(keep))


def linked(n_common: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return 100 * n_common >= THRESHOLD * (n_a + n_b - n_common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
            keep.append(bool(linked(textops.common(x, y), len(x), len(y))))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over blocks of shingles that two sets at least share."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.r_[True, every[1:] != every[:-1]]
    shared = np.diff(np.r_[np.flatnonzero(new), len(every)]) > 1
    place = np.cumsum(new) - 1
    use = shared[place]
    column, owner = (np.cumsum(shared) - 1)[place[use]], owner[use]
    out = np.zeros((len(sets), len(sets)), np.float32)
    total = int(shared.sum())
    for at in range(0, total, 4096):
        width = min(4096, total - at)
        lo, hi = np.searchsorted(column, (at, at + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _exhaustive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each leaf, links on the full sets that join two of its components; a spanning forest of them."""
    for batch in _grouped(batches, "node"):
        node, rep, comp = (batch.column(k).to_numpy() for k in (0, 1, 2))
        edges = []
        bounds = [*np.flatnonzero(np.r_[True, node[1:] != node[:-1]]), len(node)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            names, which = np.unique(comp[lo:hi], return_inverse=True)
            forest = _Forest(len(names))
            for i, j in _compared([batch.column(3)[k].as_buffer() for k in range(lo, hi)]):
                if forest.join(int(which[i]), int(which[j])):
                    edges.append((rep[lo + i], rep[lo + j]))
        if edges:
            x, y = np.array(edges).T
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def _compared(buffers: list[pa.Buffer]) -> Iterator[tuple[int, int]]:
    sets = [np.frombuffer(x, U64) for x in buffers]
    size = np.array([len(s) for s in sets])
    most = LEAF + OUTSIDE  # more than one round only for a leaf at the greatest depth
    for lo in range(0, len(sets), most):
        for lo2 in range(lo, len(sets), most):
            some = [*range(lo, min(lo + most, len(sets))), *(range(lo2, min(lo2 + most, len(sets))) if lo2 > lo else ())]
            at = np.array(some)
            i, j = np.nonzero(np.triu(linked(_overlaps([sets[k] for k in some]), size[at][:, None], size[at][None, :]), 1))
            yield from zip(at[i].tolist(), at[j].tolist(), strict=True)


def _sorted_map(frame: DataFrame, key: str, order: list[str], run, schema: str) -> DataFrame:
    return frame.repartition(col(key)).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def _sets_of(documents: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """The full sets of some documents, written; ids are broadcast only if proven small."""
    wanted = documents.join(small(ids), documents["doc_id"] == ids["rep"], "left_semi")
    return written(wanted.mapInArrow(_full_sets, "rep long, shingles binary"), label)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one, two = (sets.select(F.col("rep").alias(k), F.col("shingles").alias(f"set_{k}")) for k in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= 75 * union of their shingle
    sets, and every returned link is confirmed on full sets. component_id is the
    smallest id reachable. A null or empty text has no shingles and is linked
    with nothing; texts of one to four words are one shingle. Rows with a null
    id are left out, since nothing can be said of them by id; rows that repeat
    an id count as one document, whose set is the union of what its rows link
    to, and come back once. Other columns are ignored.
    """
    ship(docs.sparkSession)
    documents = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text")).where("doc_id is not null")
    sketches = written(documents.mapInArrow(_sketches, "doc_id long, n_shingles long, key long, low long, roots array<long>, sketch binary"), "sketches")
    some = sketches.where("n_shingles > 0")
    tokens = some.select(F.col("doc_id").alias("rep"), "sketch")

    same = ["n_shingles", "key", "low"]
    classes = written(some.groupBy(*same).agg(F.min_by("roots", "doc_id").alias("roots"), F.min("doc_id").alias("rep")), "classes")
    rows = classes.select("rep", F.explode("roots").alias("node"))
    sizes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    first = written(rows.join(sizes, "node").select("node", "n", "rep"), "nodes")
    blocks = first.join(tokens, "rep").select(
        F.xxhash64("node", F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("n") / LEAF))).alias("block"), "rep", "node", "sketch",
    )
    edges = written(_sorted_map(blocks, "block", ["rep"], _spanning, "node long, a long, b long"), "edges")
    pairs = edges.select("a", "b").distinct()
    ids = written(edges.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "ids")
    sets = _sets_of(documents, ids, "sets")
    links = written(_with_sets(pairs, sets).mapInArrow(_confirm, "a long, b long"), "links")
    found = components(links)

    leaves = _unsettled(first, edges, found, tokens)
    ready = written(_sorted_map(leaves, "node", ["rep"], _active, "node long, rep long, comp long"), "active")
    if not ready.isEmpty():
        more = written(ready.select("rep").distinct().join(ids, "rep", "left_anti"), "ids")
        if not more.isEmpty():
            sets = sets.union(_sets_of(documents, more, "sets"))
        full = ready.join(sets, "rep").select("node", "rep", "comp", "shingles")
        late = written(_sorted_map(full, "node", ["rep"], _exhaustive, "a long, b long").distinct(), "links")
        if not late.isEmpty():
            found = components(links.union(late))

    members = classes.select(*same, "rep").join(found, F.col("rep") == F.col("id"), "left").select(*same, F.coalesce("component", "rep").alias("component_id"))
    joined = some.select("doc_id", *same).join(members, same).select("doc_id", "n_shingles", "component_id")
    alone = sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    every = joined.union(alone).groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    return every.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _unsettled(first: DataFrame, edges: DataFrame, found: DataFrame, tokens: DataFrame) -> DataFrame:
    """Leaves below the roots' children that hold more than one component: rows (node, rep, comp, sketch).

    A child of at most ``LEAF`` documents was compared as a whole: it is settled unless an edge of its forest still joins two components.
    """
    label = lambda frame, key, name: frame.join(found.select(F.col("id").alias(key), F.col("component").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))
    loose = label(label(edges, "a", "comp_a"), "b", "comp_b").where("comp_a <> comp_b").select("node").distinct()
    rows = label(first, "rep", "comp")
    narrow = rows.where(F.col("n") <= LEAF).join(loose, "node", "left_semi").unionByName(rows.where(F.col("n") > LEAF)).select("node", "rep", "comp")
    now = written(_open_nodes(narrow).join(tokens, "rep").select(*_LEVEL), "level")
    leaves = _blocks(now)
    for depth in range(DEPTH):
        large = now.where(F.col("outside") > OUTSIDE).select("node", "rep", "comp", "sketch")
        if large.isEmpty():
            break
        if depth == DEPTH - 1:
            return leaves.union(large)
        now = written(_open_nodes(large.mapInArrow(_children, large.schema).dropDuplicates(["node", "rep"])).select(*_LEVEL), "level")
        leaves = leaves.union(_blocks(now))
    return leaves


_LEVEL = ["node", "rep", "comp", "sketch", "main", "n_main", "outside"]


def _open_nodes(state: DataFrame) -> DataFrame:
    """The rows of nodes with more than one component, with the node's largest one, its size and how many are outside it."""
    sizes = state.groupBy("node", "comp").agg(F.count("*").alias("n"))
    held = sizes.groupBy("node").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"))
    open_ = held.select("node", F.col("main.comp").alias("main"), F.col("main.n").alias("n_main"), (F.col("n") - F.col("main.n")).alias("outside")).where("outside > 0")
    return state.join(open_, "node")


def _blocks(now: DataFrame) -> DataFrame:
    """Nodes that are ready, the largest component in blocks and the few others in each of them."""
    ready = now.where(F.col("outside") <= OUTSIDE)
    n = F.ceil(F.col("n_main") / LEAF).cast("int")
    own = F.array(F.pmod(F.xxhash64("rep"), n).cast("int"))
    block = F.explode(F.when(F.col("comp") == F.col("main"), own).otherwise(F.sequence(F.lit(0), n - 1)))
    return ready.select("*", block.alias("block")).select(F.xxhash64("node", "block").alias("node"), "rep", "comp", "sketch")


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
