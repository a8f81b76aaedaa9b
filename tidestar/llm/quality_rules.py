"""Quality rules: lines are labelled as content or boilerplate by a linear-chain conditional random field.

The field is trained on a bounded sample of labelled documents, whose lines all
take the label of their document; its transitions make single odd lines follow
their neighbours. Viterbi decoding labels the lines of every document, and the
share of words in content lines decides whether the document is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.measures import Measures, measure, share
from tidestar.llm.shared import col, held_out, ship, table

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
CONTENT_SHARE = 0.5
# The sample to train on: so many labelled documents at most, none of more lines than this.
TRAIN_DOCUMENTS = 3000
TRAIN_LINES = 600
# Lines of a sample all have their document's label, which would make moves between labels impossible; so moves are held back more than the rest.
STIFF = 30

FEATURES = [
    "bias", "few words", "many words", "mean word", "long words", "symbols", "symbol words", "digits", "capitals",
    "loud", "stops", "stopped", "repeated words", "repeated line", "no letters",
]


def line_features(m: Measures) -> np.ndarray:
    """A row for each line, a column for each of ``FEATURES``, all between 0 and 1."""
    x = m.lines
    n, chars = x["n_words"], x["n_chars"]
    ramp = lambda v, top: np.minimum(v / top, 1.0)
    return np.stack([
        np.ones(len(n)), n <= 3, ramp(n, 30), ramp(share(x["word_chars"], n), 12), share(x["long_words"], n), ramp(share(x["n_symbols"], chars), 0.3),
        share(x["symbol_words"], n), ramp(share(x["n_digits"], chars), 0.3), share(x["n_capitals"], x["n_letters"]), ramp(share(x["n_loud"], n), 1),
        ramp(share(x["n_stops"], n), 0.5), x["stopped"], share(x["repeat_words"], n), x["twice"], share(x["bare_words"], n),
    ], axis=1).astype(np.float64)


@dataclass
class Field:
    """Scores of label 1 (content) against 0 for each feature; ``moves[a, b]``: score of b after a."""

    weights: np.ndarray
    moves: np.ndarray


def _padded(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences side by side, the longest first: (time, sequence, feature), and how many are left at each time."""
    length = np.array([len(f) for f in features])
    out = np.zeros((length.max(), len(features), features[0].shape[1]))
    for i, f in enumerate(features):
        out[: len(f), i] = f
    return out, (length[None, :] > np.arange(length.max())[:, None]).sum(axis=1)


def train(features: list[np.ndarray], labels: np.ndarray, rounds: int = 150, penalty: float = 5e-4) -> Field:
    """Maximum likelihood by gradient ascent with momentum; the gradient comes from the forward-backward algorithm."""
    order = np.argsort([-len(f) for f in features], kind="stable")
    features, labels = [features[i] for i in order], labels[order].astype(int)
    x, left = _padded(features)
    steps, n, k = x.shape
    scale = 1.0 / np.array([len(f) for f in features])  # each document counts once, whatever its length
    weight = scale / n
    held = np.r_[np.full(k, penalty), np.full(4, STIFF * penalty)]
    theta, speed = np.zeros(k + 4), np.zeros(k + 4)
    for _ in range(rounds):
        moves = theta[k:].reshape(2, 2)
        score = np.zeros((steps, n, 2))
        score[..., 1] = x @ theta[:k]
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[0] = score[0]
        for t in range(1, steps):
            m = left[t]
            forward[t, :m] = np.logaddexp.reduce(forward[t - 1, :m, :, None] + moves, axis=1) + score[t, :m]
        for t in range(steps - 2, -1, -1):
            m = left[t + 1]
            backward[t, :m] = np.logaddexp.reduce(moves + (score[t + 1, :m] + backward[t + 1, :m])[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward[0] + backward[0], axis=1)
        grad = np.zeros(k + 4)
        for t in range(steps):
            m = left[t]
            off = (labels[:m] - np.exp(forward[t, :m, 1] + backward[t, :m, 1] - total[:m])) * weight[:m]
            grad[:k] += off @ x[t, :m]
            if t:
                pair = np.exp(forward[t - 1, :m, :, None] + moves + (score[t, :m] + backward[t, :m])[:, None, :] - total[:m, None, None])
                seen = np.zeros((m, 2, 2))
                seen[np.arange(m), labels[:m], labels[:m]] = 1
                grad[k:] += np.einsum("n,nab->ab", weight[:m], seen - pair).ravel()
        speed = 0.9 * speed + grad - held * theta
        theta = theta + 1.0 * speed
    return Field(theta[:k], theta[k:].reshape(2, 2))


def viterbi(field: Field, features: np.ndarray, line_at: np.ndarray) -> np.ndarray:
    """The best label of each line; the lines of document i are ``line_at[i]:line_at[i + 1]``. All documents go forward together."""
    gain = features @ field.weights
    count = np.diff(line_at)
    order = np.argsort(-count, kind="stable")
    first, count = line_at[:-1][order], count[order]
    out = np.zeros(len(features), np.int8)
    from_one = np.zeros((len(features), 2), np.int8)  # the label before, for either label
    best = np.zeros((len(count), 2))
    if len(count):
        best[:, 1] = gain[first]
    for t in range(1, int(count[0]) if len(count) else 0):
        m = int(np.searchsorted(-count, -t))
        ways = best[:m, :, None] + field.moves
        came = (ways[:, 1] > ways[:, 0]).astype(np.int8)
        from_one[first[:m] + t] = came
        best[:m] = np.maximum(ways[:, 0], ways[:, 1])
        best[:m, 1] += gain[first[:m] + t]
    label = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for t in range(int(count[0]) - 1 if len(count) else -1, -1, -1):
        m = int(np.searchsorted(-count, -t))
        rows = first[:m] + t
        out[rows] = label[:m]
        if t:
            label[:m] = from_one[rows, label[:m]]
    return out


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textops.slices(batch.column(2)):
            m = measure(part)
            f = line_features(m).astype(np.float32)
            rows = [f[a:b].tobytes() if b - a <= TRAIN_LINES else None for a, b in zip(m.line_at, m.line_at[1:], strict=False)]
            own = [batch.column(k).slice(part.first, len(part)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(rows, pa.binary())], ["doc_id", "quality", "x"])


def labelled(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """A fixed sample of (doc_id, quality, text), at most ``most`` ids, none held out; which ones depends on the ids alone."""
    clean = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "text")


def one_each(rows: DataFrame) -> list:
    """(doc_id, quality, x) of a sample on the driver, one row for each id and in an order that doesn't depend on tasks."""
    return sorted(rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).where("x is not null").collect(), key=lambda r: r["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCUMENTS) -> Field | None:
    """The field learned from at most ``most`` labelled documents; None if either label is missing."""
    ship(docs.sparkSession)
    sample = labelled(docs, labels, most, id_col, text_col)
    rows = one_each(sample.mapInArrow(_features_of, f"doc_id {sample.schema[0].dataType.simpleString()}, quality int, x binary"))
    quality = np.array([r["quality"] for r in rows])
    if not len(rows) or quality.min() == quality.max():
        return None
    return train([np.frombuffer(r["x"], np.float32).reshape(-1, len(FEATURES)).astype(np.float64) for r in rows], quality)


# Columns that the rules add, and their types.
ADDED = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "content_words": "long", "base_failed": "boolean", "kept": "boolean",
}


def _judge(field: Field | None, text_at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch.column(text_at)):
                m = measure(part)
                n = m.rows["n_words"]
                label = viterbi(field, line_features(m), m.line_at) if field else np.ones(len(m.lines["n_words"]), np.int8)
                content = np.add.reduceat(m.lines["n_words"] * label, m.line_at[:-1])
                failed = (n < MIN_WORDS) | (100 * m.rows["repeat_words"] > MOST_REPEATED * n)
                kept = ~failed & (content >= CONTENT_SHARE * n)
                own = batch.slice(part.first, len(part)).columns
                new = [n, m.rows["word_chars"], m.rows["n_symbols"], m.rows["n_dup_lines"], m.rows["repeat_words"], content]
                arrays = [*own, *(pa.array(x.astype(np.int64)) for x in new), pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *ADDED])

    return run


def judge(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` and the columns of ``ADDED``.

    A document fails the base rules with fewer than 50 words, or more than half
    of them in three-word windows found again. Others are kept if lines labelled
    as content hold at least half of the words; without a field all lines are
    content. Null and empty texts have no words and fail. Nulls elsewhere,
    repeated rows and an empty table need no care: each row is judged by its
    text alone. Columns of ``docs`` that have a name of ``ADDED`` give way.
    """
    ship(docs.sparkSession)
    taken = {c.lower() for c in ADDED}
    own = [c for c in docs.columns if c.lower() not in taken]
    frame = docs.select(*[col(c).cast("string").alias(c) if c == text_col else col(c) for c in own])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema), *(f"{k} {v}" for k, v in ADDED.items())])
    return frame.mapInArrow(_judge(field, own.index(text_col)), schema)


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")
