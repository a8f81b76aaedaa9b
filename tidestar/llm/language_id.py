"""Language identification by a convolutional network over bytes.

A text is cut into windows of fixed length, all of it. In each window filters of
several widths look at the embedded bytes, each filter gives its largest answer,
and a softmax over these gives the languages. The windows of a text vote with
their probabilities, each with the number of its letters. The network is small
and is trained here, in numpy, on a bounded sample of labelled texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidestar.llm import textops
from tidestar.llm.measures import LETTER
from tidestar.llm.shared import col, held_out, ship, table

UNKNOWN = "und"
WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
DEPTH = 6  # numbers of an embedded byte
CLASS_DOCUMENTS = 1500  # documents of each language to learn from, at most
ALL_DOCUMENTS = 30_000  # documents of all languages together, at most; each has 2 KB at most on the driver
CLASS_WINDOWS = 4000  # windows of each language, at most
DOCUMENT_WINDOWS = 8  # windows of a document to learn from, spread evenly over it
EPOCHS = 8
RATE = 0.004
BATCH = 64
MOST_LANGUAGES = 500  # the most frequent ones are learned; others are no classes
AT_ONCE = 64  # windows scored at once, small enough for a cache


def _padding(width: int) -> int:
    return WINDOW - width + 1


@dataclass
class Network:
    """``embed``: 256 x DEPTH; ``filters``: for each width, width x DEPTH x FILTERS and a bias; ``out``, ``bias``: the softmax layer."""

    languages: list[str]
    embed: np.ndarray
    filters: list[tuple[np.ndarray, np.ndarray]]
    out: np.ndarray
    bias: np.ndarray

    @staticmethod
    def new(languages: list[str]) -> Network:
        rng = np.random.default_rng(7)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
        hidden = FILTERS * len(WIDTHS)
        return Network(
            languages, rng.standard_normal((256, DEPTH)).astype(np.float32) * np.float32(0.5),
            [(draw(w, DEPTH, FILTERS), np.zeros(FILTERS, np.float32)) for w in WIDTHS], draw(hidden, len(languages)), np.zeros(len(languages), np.float32),
        )

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest answers, rectified, and where they were; ``windows``: rows of WINDOW bytes."""
        n = len(windows)
        answers, places = [], []
        for weights, bias in self.filters:
            w = len(weights)
            # A filter's answer is a sum of one entry for each of its bytes.
            tables = [self.embed @ weights[k] for k in range(w)]
            total = tables[0][windows[:, : _padding(w)]]
            for k in range(1, w):
                total += tables[k][windows[:, k : k + _padding(w)]]
            place = total.argmax(axis=1)
            places.append(place)
            answers.append(np.take_along_axis(total, place[:, None, :], axis=1)[:, 0] + bias)
        return np.maximum(np.concatenate(answers, axis=1), 0) if n else np.zeros((0, len(self.out)), np.float32), places

    def largest(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """As ``pooled`` without the places; ``tables`` as ``lookups`` makes them."""
        answers = []
        for (weights, bias), steps in zip(self.filters, tables, strict=True):
            w = len(weights)
            total = steps[0].take(windows[:, : _padding(w)], axis=0)
            for k in range(1, w):
                total += steps[k].take(windows[:, k : k + _padding(w)], axis=0)
            answers.append(total.max(axis=1) + bias)
        return np.maximum(np.concatenate(answers, axis=1), 0)

    def lookups(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.embed @ weights[k]) for k in range(len(weights))] for weights, _ in self.filters]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        tables = self.lookups()
        out = np.zeros((len(windows), len(self.languages)))
        for at in range(0, len(windows), AT_ONCE):
            x = self.largest(windows[at : at + AT_ONCE], tables) @ self.out + self.bias
            e = np.exp(x - x.max(axis=1, keepdims=True))
            out[at : at + AT_ONCE] = e / e.sum(axis=1, keepdims=True)
        return out


def train(windows: np.ndarray, classes: np.ndarray, languages: list[str]) -> Network:
    """Cross-entropy, Adam. The gradient of a largest answer goes to the bytes that gave it."""
    net = Network.new(languages)
    rng = np.random.default_rng(11)
    params = [net.embed, *(p for f in net.filters for p in f), net.out, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, n = windows[rows], len(rows)
            hidden, places = net.pooled(x)
            z = hidden @ net.out + net.bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            dz = e / e.sum(axis=1, keepdims=True)
            dz[np.arange(n), classes[rows]] -= 1
            dz /= n
            dh = (dz @ net.out.T) * (hidden > 0)
            d_embed = np.zeros_like(net.embed)
            grads = []
            for i, (weights, _) in enumerate(net.filters):
                d = dh[:, i * FILTERS : (i + 1) * FILTERS]
                dw = np.zeros_like(weights)
                for k in range(len(weights)):
                    seen = x[np.arange(n)[:, None], places[i] + k]  # the byte under place k of each filter
                    dw[k] = np.einsum("nf,nfd->df", d, net.embed[seen])
                    np.add.at(d_embed, seen, d[:, :, None] * weights[k].T[None])
                grads += [dw, d.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, [d_embed, *grads, hidden.T @ dz, dz.sum(axis=0)], first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def windows_of(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """All of a text in rows of WINDOW bytes; zeros fill the last row. An empty text has no row."""
    rows = -(-(end - start) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: end - start] = data[start:end]
    return out.reshape(rows, WINDOW)


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to DOCUMENT_WINDOWS rows of each text, spread evenly over it."""
    for batch in batches:
        for part in textops.slices(batch.column(2)):
            found = []
            for a, b in zip(part.offsets, part.offsets[1:], strict=False):
                w = windows_of(part.data, int(a), int(b))
                found.append(w[np.unique(np.linspace(0, len(w) - 1, DOCUMENT_WINDOWS).astype(int))].tobytes() if len(w) else None)
            own = [batch.column(k).slice(part.first, len(part)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.binary())], ["doc_id", "lang", "x"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = CLASS_DOCUMENTS) -> Network | None:
    """Learned from at most ``most`` documents of each language outside the held-out quarter; None if no text has a language.

    Which documents depends on their ids alone. Of more than ``MOST_LANGUAGES`` languages the most
    frequent ones are learned (of equally frequent ones the first by name), and all share ``ALL_DOCUMENTS``.
    """
    ship(docs.sparkSession)
    usable = docs.select(col(id_col).alias("doc_id"), col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    common = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES).collect()
    if not common:
        return None
    most = max(1, min(most, ALL_DOCUMENTS // len(common)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 40))
    # The ``most`` least draws of each language; every task leaves so many rows of it at most.
    order = W.partitionBy("lang").orderBy("draw")
    drawn = usable.where(F.col("lang").isin([r["lang"] for r in common])).select("lang", draw.alias("draw")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    bounds = drawn.groupBy("lang").agg(F.max("draw").alias("bound")).collect()  # one row for each language
    bound = F.create_map(*[F.lit(v) for r in bounds for v in (r["lang"], r["bound"])])
    # Rows that share an id share the draw, and count once below.
    sample = usable.where(draw <= F.element_at(bound, F.col("lang")))
    kind = sample.schema[0].dataType.simpleString()
    taken = sample.mapInArrow(_chosen, f"doc_id {kind}, lang string, x binary").where("x is not null")
    rows = taken.groupBy("lang", "doc_id").agg(F.min("x").alias("x")).collect()
    by: dict[str, list[tuple]] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((zlib.crc32(str(r["doc_id"]).encode()), bytes(r["x"])))
    languages = sorted(by)
    x, y = [], []
    for k, lang in enumerate(languages):
        found = [np.frombuffer(b, np.uint8).reshape(-1, WINDOW) for _, b in sorted(by[lang])[:most]]
        if found:
            w = np.concatenate(found)
            w = w[np.random.default_rng(k).permutation(len(w))[:CLASS_WINDOWS]]
            x.append(w)
            y.append(np.full(len(w), k))
    return train(np.concatenate(x), np.concatenate(y), languages) if x else None


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, lang_pred, score.

    lang_pred is ``und`` and score 0 where the text is null or empty or has no
    letter, and everywhere without a network. Any byte of a character outside
    ASCII that is a letter counts as one; other columns are ignored. Each row is
    judged by its text alone.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch.column(1)):
                names, scores = _predicted(part, net)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, lang_pred string, score double")


def _has_letter(data: np.ndarray) -> bool:
    """Exact, on the characters; called only where no ASCII letter settles it."""
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def _predicted(part: textops.Slice, net: Network | None) -> tuple[list[str], np.ndarray]:
    n = len(part)
    if net is None or not n:
        return [UNKNOWN] * n, np.zeros(n)
    rows = [windows_of(part.data, int(a), int(b)) for a, b in zip(part.offsets, part.offsets[1:], strict=False)]
    at = np.cumsum([0, *(len(r) for r in rows)])
    every = np.concatenate(rows)
    letters = LETTER[every]
    votes = net.probabilities(every) * letters.sum(axis=1, keepdims=True)
    sums = np.zeros((len(every) + 1, votes.shape[1]))
    np.cumsum(votes, axis=0, out=sums[1:])
    total = sums[at[1:]] - sums[at[:-1]]
    weight = total.sum(axis=1)
    ascii_letters = np.r_[0, np.cumsum((letters & (every < 128)).sum(axis=1))]
    plain = ascii_letters[at[1:]] > ascii_letters[at[:-1]]
    known = np.array([bool(weight[i] > 0 and (plain[i] or _has_letter(part.data[part.offsets[i] : part.offsets[i + 1]]))) for i in range(n)], bool)
    best = total.argmax(axis=1)
    score = np.divide(total[np.arange(n), best], weight, out=np.zeros(n), where=known & (weight > 0))
    return [net.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.clip(score, 0, 1)


def op7_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
