from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, words
from pyspark.sql import functions as F

from tidestar.llm import queries
from tidestar.llm.context_tree import log_estimate, log_probabilities, pack, pack_keys, score_texts, unpack, unpack_keys

SMALL = "/root/testdata/sf0.001"


class Tree:
    """The contexts of one binary place; Pw from its definition, node by node."""

    def __init__(self, depth):
        self.depth, self.nodes, self.children = depth, Counter(), {}

    def add(self, context, bit):
        for d in range(self.depth + 1):
            self.nodes[context[:d], bit] += 1
            if d:
                self.children.setdefault(context[: d - 1], set()).add(context[:d])

    def log_pw(self, node=b""):
        a, b = self.nodes[node, 0], self.nodes[node, 1]
        log_pe = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        if len(node) == self.depth:
            return log_pe
        return np.logaddexp(log_pe, sum(self.log_pw(c) for c in sorted(self.children.get(node, ())))) - math.log(2)

    def probability(self, context, bit):
        """Pw with one bit more over Pw without it."""
        before = self.log_pw()
        saved, children = self.nodes.copy(), {k: set(v) for k, v in self.children.items()}
        self.add(context, bit)
        after = self.log_pw()
        self.nodes, self.children = saved, children
        return math.exp(after - before)


def coded(text, depth):
    """(context, latest byte first; place; bit) of each binary decision of a text."""
    data = b"\0" * depth + (text or "").encode() + b"\xff"
    for t in range(depth, len(data)):
        for j in range(8):
            yield data[t - depth : t][::-1], (1 << j) | (data[t] >> (8 - j)), (data[t] >> (7 - j)) & 1


@pytest.mark.parametrize("depth", [4, 5, 6])
def test_scores_against_the_definition(spark, depth):
    learned = ["abab abba", "the cat, the hat", "", "caé the", None]
    tested = ["abba", "the bat", "zq", "", "aé"]
    trees = {}
    for text in learned:
        for context, place, bit in coded(text, depth):
            trees.setdefault(place, Tree(depth)).add(context, bit)
    rows = [(i, t, i < len(learned)) for i, t in enumerate([*learned, *tested])]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r["doc_id"]: r for r in score_texts(df.repartition(3), F.col("learn"), depth=depth, block_bytes=10).collect()}
    for i, text, _ in rows:
        expected = sum(math.log10(trees[p].probability(c, b) if p in trees else 0.5) for c, p, b in coded(text, depth))
        assert math.isclose(got[i]["score"], expected, rel_tol=1e-9), text
        assert got[i]["n_bytes"] == len((text or "").encode())


def test_bytes_of_a_context_have_probability_one():
    learned = {(5 << 32) << 8 | 65: 9, (5 << 32) << 8 | 66: 1, (7 << 24) << 8 | 65: 4}
    every = np.unique(np.array([*learned, *(((5 << 32) + 1 << 8) + np.arange(256)).tolist()], np.uint64))
    logs = log_probabilities(every, np.array([learned.get(int(k), 0) for k in every]), 5)
    assert math.isclose(sum(10 ** v for k, v in zip(every.tolist(), logs, strict=True) if k >> 8 == (5 << 32) + 1), 1, rel_tol=1e-9)


def test_packed_numbers():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (unpack_keys(pack_keys(keys)) == keys).all() and len(unpack_keys(pack_keys(keys[:0]))) == 0
    values = rng.standard_normal(7)
    assert (unpack(pack(values), np.float64) == values).all()


def test_estimate_of_large_counts():
    for a, b in ((0, 0), (1, 0), (3, 5), (1000, 7), (10**9, 10**6)):
        expected = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        assert math.isclose(log_estimate(np.array([a], float), np.array([b], float))[0], expected, rel_tol=1e-9, abs_tol=1e-11)


def base_line(rows):
    """(n_tokens, n_known, train_tokens, base score) of each row of (doc_id, text)."""
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*words(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    counts = Counter(w for i, t in rows if not out(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        w = tokens(t)
        yield i, out(i), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)


def test_query_base_line(spark, tmp_path):
    df = documents(spark, [(200 + i, f"Shared words and Number {i}", None, None, None, None, None, None) for i in range(60)])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_context_tree"](spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    expected = sorted(base_line([(r["doc_id"], r["text"]) for r in df.collect()]), key=key)
    for g, e in zip(sorted(got, key=key), expected, strict=True):
        assert tuple(g)[:5] == e[:5] and math.isclose(g["base_score"], e[5], rel_tol=1e-9)
        assert g["score"] < 0
    empty = score_texts(df.limit(0), F.lit(True))
    assert empty.count() == 0
    unlearned = score_texts(df.where("doc_id = 105"), F.lit(None).cast("boolean")).first()
    assert math.isclose(unlearned["bits_per_byte"], 8) and unlearned["base_score"] == 0 and unlearned["train_tokens"] == 0


def test_text_like_the_corpus_is_shorter(spark):
    rows = queries.QUERIES["op12_context_tree"](spark, SMALL).where("n_bytes > 200").collect()
    held = [r["bits_per_byte"] for r in rows if r["held_out"]]
    letters = Counter(b for t in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").toArrow()["text"].to_pylist() for b in (t or "").encode())
    shares = np.array(list(letters.values())) / sum(letters.values())
    assert len(held) > 10 and np.median(held) < 0.75 * -(shares * np.log2(shares)).sum()
