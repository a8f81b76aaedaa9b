"""Words one letter apart, by a trie of letter-group counts, and the form each rare spelling stands for.

Letters fall into 16 groups. The path of a word in the trie is its length, then
how many of its letters are in the first group, in the second, and so on. One
replaced letter takes one from a count and adds one to another (or leaves all as
they are), one deleted letter takes one from a count. So a search goes down from
the root with a budget of one surplus and one deficit: at each level it follows
the child of its own count, and those of one more or one less while the budget
lasts. Words at the leaves it reaches are compared letter by letter. Each pair
is found from one side: a word looks for shorter words, and for words of its
length whose first different count is larger than its own.

The trie is spread over tasks by its own nodes. A node with more than
``NODE_WORDS`` words is split by the next count, and what searches there follows
it down, budget and all; a smaller node is one group, in which the rest of the
descent runs for all searching words side by side. Words at one leaf that could
be equal up to a letter agree in their first or their second half, which cuts
leaves of many words. A group is larger than ``NODE_WORDS`` only if so many words
have all sixteen counts in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.shared import col, ship, table, written

NODE_WORDS = 20_000
GROUPS = 16
# Groups are code points modulo 16, those of frequent letters first: e, a, i, o, n, t, s, r, l, h, ...
_ORDER = [5, 1, 9, 15, 14, 4, 3, 2, 12, 8, 13, 7, 0, 6, 11, 10]
_RANK = np.argsort(_ORDER)
SEARCHES = 50_000  # words that search a group at a time

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10  # how many times as frequent as a spelling its form has to be

U64 = np.uint64
LINKS = "word string, n bigint, other string, other_n bigint"


def vectors(words: list[str]) -> np.ndarray:
    """Length and group counts of each word, one column for each level of the trie."""
    length = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    cell = np.repeat(np.arange(len(words)) * GROUPS, length) + _RANK[codes % GROUPS]
    return np.c_[length, np.bincount(cell, minlength=len(words) * GROUPS).reshape(-1, GROUPS)]


def _choices(surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """By how much a count may differ, and which searches can afford it. The deficit is spent after the surplus."""
    yield 0, np.ones(len(surplus), bool)
    yield 1, surplus > 0
    yield -1, (surplus == 0) & (deficit > 0)


class Trie:
    """The levels of a set of words. ``children[l]``: sorted (node of level l) * base + count; a child's place in it is its node."""

    def __init__(self, counts: np.ndarray, base: int) -> None:
        self.base, self.order = base, np.lexsort(counts.T[::-1])
        self.children, node = [], np.zeros(len(counts), np.int64)
        for level in counts[self.order].T:
            keys, node = np.unique(node * base + level, return_inverse=True)
            self.children.append(keys)
        self.leaf = np.empty(len(counts), np.int64)
        self.leaf[self.order] = node

    def search(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``counts``, leaf) of all leaves within the budget of each row."""
        row, node = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        surplus = deficit = np.ones(len(counts), np.int8)
        for level, children in enumerate(self.children):
            found = []
            # A word of the same length may have one more and one less; a shorter one has one less.
            steps = _choices(surplus, deficit) if level else [(0, surplus > 0), (-1, surplus > 0)]
            for step, can in steps:
                key = node[can] * self.base + counts[row[can], level] + step
                at = np.minimum(np.searchsorted(children, key), len(children) - 1)
                hit = children[at] == key
                left = surplus[can][hit] - (step == 1), deficit[can][hit] - (step == -1)
                if not level:
                    left = np.full(hit.sum(), 1 + step, np.int8), np.ones(hit.sum(), np.int8)
                found.append((row[can][hit], at[hit], *left))
            row, node, surplus, deficit = (np.concatenate(c) for c in zip(*found, strict=True))
        return row, node


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is replaced, or is in ``a`` and not in ``b``, which is no longer."""
    if a == b or len(a) - len(b) > 1:
        return False
    k = 0
    while k < len(b) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def _ranges(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``wanted``, index in ``keys``) of all equal values."""
    order = np.argsort(keys, kind="stable")
    first, last = (np.searchsorted(keys[order], wanted, side=s) for s in ("left", "right"))
    n = last - first
    own = np.repeat(np.arange(len(wanted)), n)
    return own, order[first[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)]


def near_in_group(words: list[str], others: list[str]) -> Iterator[tuple[int, int]]:
    """(i, j): ``words[i]`` and ``others[j]`` are one edit apart, the second not longer; of equal counts the first is smaller."""
    counts = vectors(others)
    base = int(max(counts.max(), max(map(len, words)))) + 3
    trie = Trie(counts, base)
    halves = [np.array([hash(half(w, len(w) // 2)) for w in others], np.int64).view(U64) for half in (lambda w, h: w[:h], lambda w, h: w[h:])]
    keyed = [textops.mix(h ^ textops.mix(trie.leaf.astype(U64))) for h in halves]
    size = counts[trie.order, 0][np.searchsorted(trie.leaf[trie.order], np.arange(len(trie.children[-1])))]
    for first in range(0, len(words), SEARCHES):
        part = words[first : first + SEARCHES]
        row, leaf = trie.search(vectors(part))
        cut = size[leaf] // 2
        pairs = set()
        for k, key in enumerate(keyed):
            # The second half of a shorter word stands one place further on in the longer one.
            own = [hash(part[i][:h] if k == 0 else part[i][h + len(part[i]) - m :]) for i, h, m in zip(row.tolist(), cut.tolist(), size[leaf].tolist(), strict=True)]
            at, other = _ranges(key, textops.mix(np.array(own, np.int64).view(U64) ^ textops.mix(leaf.astype(U64))))
            pairs.update(zip(row[at].tolist(), other.tolist(), strict=True))
        same = {i: part[i] for i, _ in pairs}
        own_counts = dict(zip(same, map(tuple, vectors(list(same.values())).tolist()), strict=True)) if same else {}
        for i, j in sorted(pairs):
            if one_edit(part[i], others[j]) and (part[i] < others[j] or own_counts[i] != tuple(counts[j].tolist())):
                yield first + i, j


def _seeds() -> np.ndarray:
    return np.array([textops.mixed(k + 1) | 1 for k in range(GROUPS + 1)], U64)


def _start(words: DataFrame) -> DataFrame:
    """Each word as a member of its node at the level of lengths, and as a search there and among words shorter by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = _seeds()[0]
        for batch in batches:
            length = np.array([len(w) for w in batch.column(0).to_pylist()], np.int64)
            node = lambda m: pa.array(textops.mix(m.astype(U64) * seed).view(np.int64))  # noqa: B023, E731
            for searches, m, budget in ((False, length, 0), (True, length, 1), (True, length - 1, 0)):
                full = lambda v, t=np.int8: pa.array(np.full(len(length), v, t))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([*batch.columns, node(m), full(searches, bool), full(budget), full(1)], _NAMES)

    return words.mapInArrow(run, _FRONTIER)


_NAMES = ["word", "n", "node", "searches", "surplus", "deficit"]
_FRONTIER = "word string, n bigint, node bigint, searches boolean, surplus tinyint, deficit tinyint"


def _deeper(frontier: DataFrame, level: int) -> DataFrame:
    """All rows one level down: members at their own count, searches at all counts that they can afford."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = _seeds()[level]
        for batch in batches:
            if not len(batch):
                continue
            count = vectors(batch.column(0).to_pylist())[:, level]
            node, surplus, deficit = (batch.column(k).to_numpy() for k in (2, 4, 5))
            searches = batch.column(3).to_numpy(zero_copy_only=False)
            for step, can in _choices(surplus, deficit):
                can = can & (count + step >= 0) & (searches | (step == 0))
                kept = batch.filter(pa.array(can))
                after = textops.mix(node[can].view(U64) + (count[can] + step + 1).astype(U64) * seed)
                yield pa.RecordBatch.from_arrays([
                    kept.column(0), kept.column(1), pa.array(after.view(np.int64)), kept.column(3),
                    pa.array(surplus[can] - np.int8(step == 1)), pa.array(deficit[can] - np.int8(step == -1)),
                ], _NAMES)

    return frontier.mapInArrow(run, _FRONTIER)


def _search(frontier: DataFrame) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        searches = group["searches"].to_numpy().astype(bool)
        words, n = np.array(group["word"].to_pylist(), object), group["n"].to_numpy()
        ours, theirs = np.flatnonzero(searches), np.flatnonzero(~searches)
        found = list(near_in_group(words[ours].tolist(), words[theirs].tolist())) if len(ours) and len(theirs) else []
        a, b = (ours[[i for i, _ in found]], theirs[[j for _, j in found]]) if found else (ours[:0], theirs[:0])
        return pa.table({
            "word": pa.array(words[a], pa.string()), "n": pa.array(n[a], pa.int64()), "other": pa.array(words[b], pa.string()), "other_n": pa.array(n[b], pa.int64()),
        })

    return frontier.groupBy("node").applyInArrow(run, LINKS)


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """Of distinct words (word, n) all pairs that differ by one inserted, deleted or replaced letter, each once: word, n, other, other_n."""
    ship(words.sparkSession)
    frontier = written(_start(words.select("word", "n")), "trie")
    links = None
    for level in range(GROUPS + 1):
        sizes = written(frontier.where("NOT searches").groupBy("node").agg(F.count(F.lit(1)).alias("members")), "nodes")
        large = sizes.where(F.col("members") > (node_words if level < GROUPS else (1 << 62)))
        # A node without members ends the searches that came to it.
        found = _search(frontier.join(sizes.join(large.select("node"), "node", "left_anti").select("node"), "node", "left_semi"))
        links = found if links is None else links.unionAll(found)
        if large.isEmpty():
            break
        frontier = written(_deeper(frontier.join(large.select("node"), "node", "left_semi").select(*_NAMES), level + 1), "trie")
    # Two nodes of one hash would find a pair twice.
    return written(links.distinct(), "near")


def _roots(forms: DataFrame) -> DataFrame:
    """From (word, form) the last word that forms lead to: word, root. Counts grow ``TIMES`` from word to form, so no chain closes or is long."""
    ways = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = written(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        ways = after.select("word", "root")
        if after.where("moved").isEmpty():
            return ways


def spelling_variants(words: DataFrame, times: int = TIMES, node_words: int = NODE_WORDS) -> DataFrame:
    """One row for each row of ``words`` (distinct words and their counts n): word, form, root, n, n_near, form_n.

    The form is the near word of the largest count, of equal ones the smallest in
    code-point order, if it is ``times`` as frequent, else null. The root is where
    forms lead in the end, the word itself without one. Rows of a null word or
    count are left out; a word without near ones has n_near 0; other columns are ignored.
    """
    if times < 2:
        raise ValueError("a form has to be more frequent than its spelling")
    words = words.where("word IS NOT NULL AND n IS NOT NULL").select("word", F.col("n").cast("bigint").alias("n"))
    links = near_words(words, node_words)
    both = links.unionAll(links.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other"))).alias("best"),
    )
    frequent = F.col("best.other_n") >= times * F.col("n")
    chosen = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, F.col("best.other_n")).alias("form_n"),
    ), "forms")
    roots = _roots(chosen.where("form IS NOT NULL"))
    return chosen.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def misspelt_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts, one in 31 by the CRC of its id and spelling without one of its letters.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are
    made small. Null texts have none; in rows without id all letters stay.
    """
    text = F.translate(col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Shorter runs give no word, with or without a letter less.
    runs = F.regexp_extract_all(text, F.lit(f"([a-zÀ-ÿ]{{{min_length},}})"), F.lit(1))
    each = docs.select(col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.pmod(F.col("h"), F.length("run")) + 1).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at - 1), F.substring("run", at + 1, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run"))
    counted = each.select("run", h.alias("h")).select(word.alias("word")).where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def op13_group_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(written(misspelt_words(table(spark, sf_dir, "documents")), "words"))


# Words are near if one is the other without a letter, or both are the same without the letter at one place.
OP13_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS n, i::UBIGINT AS x, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT n, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END), k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(x ORDER BY n) AS t FROM bits WHERE k = 8),
e AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
o AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id::VARCHAR || ':' || run)) AS raw FROM e WHERE length(run) >= 7 GROUP BY doc_id, run),
h AS (
  SELECT run, n, xor(list_reduce([4294967295::UBIGINT] || list_transform(range(length(raw) // 2), lambda i: ('0x' || raw[2 * i + 1:2 * i + 2])::UBIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
  FROM o, crc),
r AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM r WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
l AS (SELECT word, k, substring(word, 1, k) || substring(word, k + 2) AS less FROM (SELECT word, unnest(range(length(word))) AS k FROM w)),
p AS (
  SELECT a.word AS word, b.word AS other FROM l a JOIN l b ON a.less = b.less AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word FROM l a JOIN w b ON a.less = b.word
  UNION SELECT b.word, a.word FROM l a JOIN w b ON a.less = b.word),
b AS (SELECT p.word, count(*) AS n_near, first(p.other ORDER BY o.n DESC, p.other) AS best, max(o.n) AS best_n FROM p JOIN w o ON o.word = p.other GROUP BY p.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
way AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN f ON f.word = way.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word)
SELECT f.word, f.form, last.root, f.n, f.n_near, f.form_n FROM f JOIN last USING (word)
"""
