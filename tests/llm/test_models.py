from __future__ import annotations

import base64
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, words

from tidestar.llm import language_id, queries, quality_gam, quality_rules, textops, token_counts
from tidestar.llm.measures import measure

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def base(text):
    """The base measures word by word."""
    w, lines = words(text), (text or "").split("\n")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    worded = [x for x in lines if words(x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(worded) - len(set(worded)), len(hit), failed


def test_rules_base(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(["a", "b", "cé", "#x", "𝒳𝒳", "d|", "<e>"]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 12))]
        rows.append((700 + i, rng.choice(["\n", "\r\n", "\n\n"]).join(lines), None, None, None, None, None, None))
    df = documents(spark, rows).where("doc_id is null or doc_id <> 103")
    got = quality_rules.judge(df, None)
    assert [c for c in got.columns if c in df.columns] == [c for c in df.columns if c != "kept"] + ["kept"]
    for r in got.collect():
        expected = base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == expected
        assert r["kept"] == (not expected[-1])  # without a field all lines are content
    assert quality_rules.judge(df.limit(0), None).count() == 0


def test_viterbi_against_every_path():
    rng = np.random.default_rng(3)
    field = quality_rules.Field(rng.standard_normal(len(quality_rules.FEATURES)), rng.standard_normal((2, 2)))
    lengths = [1, 5, 3, 7, 1]
    features = rng.random((sum(lengths), len(quality_rules.FEATURES)))
    at = np.cumsum([0, *lengths])
    got = quality_rules.viterbi(field, features, at)
    for a, b in zip(at, at[1:], strict=False):
        gain = features[a:b] @ field.weights
        total = lambda p: sum(g for g, x in zip(gain, p, strict=True) if x) + sum(field.moves[x, y] for x, y in zip(p, p[1:], strict=False))  # noqa: B023, E731
        paths = [[(k >> i) & 1 for i in range(b - a)] for k in range(1 << (b - a))]
        assert np.isclose(total(got[a:b].tolist()), max(map(total, paths)))


def test_gradient_of_the_field_makes_the_labels_likely():
    rng = np.random.default_rng(4)
    features, labels = [], []
    for k in range(60):
        f = np.zeros((rng.integers(1, 6), len(quality_rules.FEATURES)))
        f[:, 0], f[:, 5] = 1, (k % 2) * rng.random(len(f))
        features.append(f)
        labels.append(1 - k % 2)
    field = quality_rules.train(features, np.array(labels))
    assert field.weights[5] < -0.5 < 0 < field.weights[0]


def accuracy(df, truth, column):
    rows = df.where("held_out").join(truth, "doc_id").select(column, "truth").collect()
    return len(rows), np.mean([r[0] == r[1] for r in rows])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    n, right = accuracy(queries.op6_pairwise_gam(spark, MORE), labels.selectExpr("doc_id", "quality AS truth"), "predicted")
    assert n > 50 and right > 0.95
    n, right = accuracy(queries.op7_byte_network(spark, MORE), docs.selectExpr("doc_id", "lang AS truth"), "lang_pred")
    assert n > 150 and right > 0.95
    rules = queries.op3_line_crf(spark, MORE).where("NOT base_failed").join(labels, "doc_id").selectExpr("kept", "quality = 1 AS good").collect()
    assert np.mean([r["kept"] == r["good"] for r in rules]) > 0.98


@pytest.mark.parametrize("trained", [True, False])
def test_scores_of_odd_rows(spark, trained):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    odd = documents(spark)
    model = quality_gam.fit(docs, labels if trained else labels.limit(0))
    net = language_id.fit(docs if trained else docs.limit(0))
    assert (model is not None) == (net is not None) == trained
    scores = quality_gam.score(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    langs = {r["doc_id"]: r for r in language_id.predict(odd, net).collect() if r["doc_id"] is not None}
    assert {k for k in (100, 101, 102) if langs[k]["lang_pred"] == "und" and langs[k]["score"] == 0} == {100, 101, 102}
    assert (langs[104]["lang_pred"] != "und") == trained
    assert quality_gam.score(odd.limit(0), model).count() == language_id.predict(odd.limit(0), net).count() == 0


def test_network_gradient():
    """The largest answers for training and for scoring agree, and training fits what it sees."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(97, 105, (40, language_id.WINDOW)), rng.integers(104, 112, (40, language_id.WINDOW))]).astype(np.uint8)
    y = np.repeat([0, 1], 40)
    net = language_id.train(x, y, ["a", "b"])
    assert np.allclose(net.pooled(x)[0], net.largest(x, net.lookups()), atol=1e-4)
    assert (net.probabilities(x).argmax(axis=1) == y).all()


def greedy(text, vocabulary):
    total = 0
    for w in words(text):
        rest = (" " + w).encode()
        while rest:
            size = next(n for n in range(min(len(rest), 130), 0, -1) if rest[:n] in vocabulary)
            rest, total = rest[size:], total + 1
    return total


def test_tokens_against_greedy_search(spark):
    tokens = token_counts.read_vocabulary()
    known = set(tokens)
    for r in token_counts.count_tokens(documents(spark), tokens).join(documents(spark).select("doc_id", "text").distinct(), "doc_id").collect():
        assert (r["n_words"], r["n_tokens"]) == (len(words(r["text"])), greedy(r["text"], known))
    small = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bcde", b" a", b" abcx", b"cdcdcd"]
    automaton, rng = token_counts.build(small), random.Random(2)
    texts = ["".join(rng.choice("abcdex") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    for part in textops.slices(pa.array(texts)):
        got = automaton.count(part.data, *textops.words(part))
        assert got.tolist() == [greedy(t, set(small)) for t in texts]
    with pytest.raises(ValueError, match="single bytes"):
        token_counts.build([b"a"])
    assert base64.b64encode(tokens[0])
    assert token_counts.count_tokens(documents(spark).limit(0), tokens).count() == 0


def test_slices_cut_long_batches(monkeypatch):
    """The same measures whatever the slices, also for a word longer than a block."""
    rng = random.Random(9)
    texts = [None, "", "x" * 3000, *[" ".join(rng.choice(["aa", "b", "ccc\n"]) for _ in range(rng.randint(0, 300))) for _ in range(50)]]
    whole = [s for p in textops.slices(pa.array(texts)) for s in textops.shingle_sets(p)]
    rows = np.concatenate([measure(p).rows["repeat_words"] for p in textops.slices(pa.array(texts))])
    monkeypatch.setattr(textops, "SLICE_BYTES", 700)
    assert all(np.array_equal(a, b) for a, b in zip(whole, [s for p in textops.slices(pa.array(texts)) for s in textops.shingle_sets(p)], strict=True) if len(a) and len(a) != 1)
    assert np.array_equal(rows, np.concatenate([measure(p).rows["repeat_words"] for p in textops.slices(pa.array(texts))]))
