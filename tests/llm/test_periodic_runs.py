from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import documents, words

from tidestar.llm import queries
from tidestar.llm.periodic_runs import _grouped_runs, periodic_runs, runs_of

SMALL = "/root/testdata/sf0.001"


def plain(w, min_words=24):
    """Every maximal stretch, by comparing each word with the one q further on, for every q."""
    found, n = {}, len(w)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1 if j == i else j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def coded(w):
    return np.array([zlib.crc32(str(x).encode()) * 0x9E3779B97F4A7C15 % (1 << 64) for x in w], np.uint64)


def sequence(rng, n, letters):
    """Random words with repeats inside repeats."""
    w = []
    while len(w) < n:
        kind = rng.random()
        if w and kind < 0.5:
            back = rng.randint(1, min(len(w), rng.choice([3, 10, 40, 130])))
            piece = w[-back:]
            for _ in range(rng.randint(1, 5)):
                w += piece
            w += piece[: rng.randint(0, back)]
        elif kind < 0.6:
            w += [rng.choice(letters)] * rng.randint(1, 90)
        else:
            w += [rng.choice(letters) for _ in range(rng.randint(1, 30))]
    return w[:n]


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefghijklmnopqrstuvwxyz"])
def test_runs_against_every_lag(letters):
    rng = random.Random(11)
    n_long = 0
    for k in range(120):
        w = sequence(rng, rng.choice([0, 5, 23, 24, 100, 400, 900]), letters)
        expected = plain(w)
        n_long += sum(q > 32 for _, _, q in expected)
        assert runs_of(coded(w)) == expected, k
    assert n_long > 20


def test_shortest_possible_runs_of_every_period():
    rng = random.Random(5)
    for q in range(1, 300):
        base = [f"{rng.random()}" for _ in range(q)]
        n = max(24, 3 * q)
        w = ["x", "y", *[base[i % q] for i in range(n)], "z"]
        assert runs_of(coded(w)) == [(2, n, q)]
        # A period that consists of almost nothing but one word.
        base = ["a"] * (q - 1) + ["b"]
        w = [base[i % q] for i in range(n + q // 2)]
        assert runs_of(coded(w)) == plain(w)


def test_structured_words():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 1500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    for w in (fibonacci[-1], thue, thue[:300] * 3, ("a" * 100 + "b") * 3, ("a" * 50 + "b" * 51) * 4, "a" * 2000, ("ab" * 40 + "a") * 5 + "b" * 7):
        assert runs_of(coded(w)) == plain(w)


def test_texts_of_a_slice_do_not_meet():
    rng = random.Random(8)
    texts = [sequence(rng, rng.choice([0, 10, 60, 200]), "ab") for _ in range(80)] + [["a"] * 30] * 4
    at = np.r_[0, np.cumsum([len(w) for w in texts])]
    assert _grouped_runs(coded([x for w in texts for x in w]), at) == [plain(w) for w in texts]


def digest(doc_id, text):
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_against_plain(spark, tmp_path):
    rng = random.Random(2)
    more = [(900 + i, " ".join(sequence(rng, 300, "abc")), None, None, None, None, None, None) for i in range(150)]
    df = documents(spark, more).where("doc_id is null or doc_id <> 103")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_multi_scale_minimizers"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: repr(tuple(r))
    expected = [digest(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert sum(r[1] for r in expected) > 100


def test_odd_rows_and_long_texts(spark):
    df = documents(spark, [(950, "one two " * 200_000, "en", "s", None, None, None, None)])
    got = {r["doc_id"]: r for r in periodic_runs(df).where("doc_id is not null").collect()}
    assert [tuple(x) for x in got[950]["runs"]] == [(0, 400_000, 2)] and got[950]["collapsed"] == "one two"
    assert got[100]["runs"] == [] and got[100]["collapsed"] == "" and got[102]["n_words"] == 0
    assert got[103]["n_words"] == 30_000
    assert periodic_runs(df.limit(0)).count() == 0
