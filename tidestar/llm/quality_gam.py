"""Quality score by a generalised additive model with pairwise interactions.

Each measure of a document is cut into bins. Boosting goes round the measures
in turn and adds a shallow tree on one of them at a time, so the sum of a
measure's trees is a lookup table over its bins. Pairs of measures that explain
most of what is left get tables too, made by trees that split both. A document
scores the sum of the entries that its bins point at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.measures import Measures, measure, share
from tidestar.llm.quality_rules import labelled, one_each
from tidestar.llm.shared import col, held_out, ship, table

TRAIN_DOCUMENTS = 20_000  # labelled documents to learn from, at most
THRESHOLD = 0.7
BINS = 32
COARSE = 8  # bins of either measure of a pair
PAIRS = 6
ROUNDS = 150
RATE = 0.1

MEASURES = [
    "words", "mean word", "symbols", "symbol words", "capitals", "digits", "stops", "loud", "repeated words", "repeated lines",
    "distinct words", "long words", "bare words", "words in a line", "letters", "worst line", "stopped lines",
]


def document_measures(m: Measures) -> np.ndarray:
    """A row for each document, a column for each of ``MEASURES``."""
    x, n, chars = m.rows, m.rows["n_words"], m.rows["n_chars"]
    per_doc = lambda v: np.add.reduceat(v, m.line_at[:-1])
    worst = np.maximum.reduceat(share(m.lines["n_symbols"], m.lines["n_words"]), m.line_at[:-1])
    return np.stack([
        np.log1p(n), share(x["word_chars"], n), share(x["n_symbols"], chars), share(x["symbol_words"], n), share(x["n_capitals"], x["n_letters"]),
        share(x["n_digits"], chars), share(x["n_stops"], n), share(x["n_loud"], n), share(x["repeat_words"], n), share(x["n_dup_lines"], x["n_lines"]),
        share(x["distinct_words"], n), share(x["long_words"], n), share(x["bare_words"], n), share(n, x["n_lines"]), share(x["n_letters"], chars),
        worst, share(per_doc(m.lines["stopped"].astype(np.int64)), x["n_lines"]),
    ], axis=1)


@dataclass
class Model:
    """``edges[f]``: upper bounds of the bins of measure f; ``tables[f]``: their scores; ``pairs``: (f, g, edges of both, table)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, f])]
        for f, g, one, two, values in self.pairs:
            total += values[np.searchsorted(one, x[:, f]), np.searchsorted(two, x[:, g])]
        return sigmoid(total)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _cut(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="inverted_cdf"))


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of ordered bins with gradients g and weights h."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - g.sum() ** 2 / (h.sum() + 1)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values of a tree of depth two, one for each bin."""
    out = np.zeros(len(g))
    _, k = _best_split(g, h)
    for lo, hi in ((0, k), (k, len(g))):
        if hi > lo:
            _, j = _best_split(g[lo:hi], h[lo:hi])
            for a, b in ((lo, lo + j), (lo + j, hi)):
                if b > a:
                    out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that splits the first measure and then, on each side, the second."""
    _, k = _best_split(g.sum(axis=1), h.sum(axis=1))
    out, gain = np.zeros(g.shape), 0.0
    for rows in (slice(0, k), slice(k, None)):
        a, b = g[rows].sum(axis=0), h[rows].sum(axis=0)
        _, j = _best_split(a, b)
        for cols in (slice(0, j), slice(j, None)):
            up, down = a[cols].sum(), b[cols].sum() + 1
            out[rows, cols] = up / down
            gain += up * up / down
    return gain, out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    edges = [_cut(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    base = float(np.log(mean / (1 - mean)))
    total = np.full(len(y), base)
    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            p = sigmoid(total)
            step = RATE * _tree(np.bincount(b, y - p, len(tables[f])), np.bincount(b, p * (1 - p), len(tables[f])))
            tables[f] += step
            total += step[b]
    coarse = [_cut(x[:, f], COARSE) for f in range(x.shape[1])]
    low = [np.searchsorted(e, x[:, f]) for f, e in enumerate(coarse)]

    def grid(f: int, g: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
        cell, p = low[f] * shape[1] + low[g], sigmoid(total)
        return cell, tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))

    ranked = sorted(((-_pair_tree(*grid(f, g)[1])[0], f, g) for f in range(x.shape[1]) for g in range(f + 1, x.shape[1])))[:PAIRS]
    pair_tables = {(f, g): np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)) for _, f, g in ranked}
    for _ in range(ROUNDS // 3):
        for (f, g), values in pair_tables.items():
            cell, sums = grid(f, g)
            step = RATE * _pair_tree(*sums)[1]
            values += step
            total += step.ravel()[cell]
    return Model(base, edges, tables, [(f, g, coarse[f], coarse[g], v) for (f, g), v in pair_tables.items()])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch.column(2)):
            x = document_measures(measure(part)).astype(np.float64)
            own = [batch.column(k).slice(part.first, len(part)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCUMENTS) -> Model | None:
    """Learned from at most ``most`` labelled documents outside the held-out quarter; None if either label is missing."""
    ship(docs.sparkSession)
    sample = labelled(docs, labels, most, id_col, text_col)
    rows = one_each(sample.mapInArrow(_measured, f"doc_id {sample.schema[0].dataType.simpleString()}, quality int, x binary"))
    y = np.array([r["quality"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    return train(np.array([np.frombuffer(r["x"], np.float64) for r in rows]), y)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, score, predicted.

    Null and empty texts are scored as texts without words. Without a model all
    scores are 0.5. Nulls, repeated rows and an empty table need no care: each
    row is scored by its text alone; other columns are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch.column(1)):
                x = document_measures(measure(part))
                s = model.score(x) if model else np.full(len(part), 0.5)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([ids, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, score double, predicted int")


def op6_pairwise_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
