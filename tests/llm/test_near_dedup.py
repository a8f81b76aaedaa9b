from __future__ import annotations

import random

import numpy as np
import pytest
from cases import components, documents, sentence, shingles

from tidestar.llm import near_dedup as nd
from tidestar.llm.near_dedup import near_duplicates


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = sentence(rng, 1)
    return " ".join(w)


def check(df, texts):
    got = {r["doc_id"]: r for r in near_duplicates(df).collect()}
    expected = components(texts)
    assert {k: r["component_id"] for k, r in got.items()} == expected
    assert all(r["kept"] == (k == expected[k]) and r["n_shingles"] == len(shingles(texts[k])) for k, r in got.items())


@pytest.mark.parametrize(("leaf", "outside"), [(256, 1024), (4, 8)])
def test_against_all_pairs(spark, monkeypatch, leaf, outside):
    """Groups of exact copies and of near copies around the threshold; with small leaves all levels are used."""
    monkeypatch.setattr(nd, "LEAF", leaf)
    monkeypatch.setattr(nd, "OUTSIDE", outside)
    rng = random.Random(8)
    base = [sentence(rng, n) for n in (60, 90, 40)]
    texts = [edited(rng, b, rng.randint(0, 6)) for b in base for _ in range(20)]
    texts += [t.upper() for t in texts[:5]] + [sentence(rng, 50) for _ in range(20)]
    extra = [(1000 + i, t, "en", "s0", None, None, None, None) for i, t in enumerate(texts)]
    df = documents(spark, extra).where("doc_id is not null")
    # Rows that repeat an id agree here.
    check(df, {r["doc_id"]: r["text"] for r in df.collect()})


def test_empty_table_and_null_ids(spark):
    assert near_duplicates(documents(spark).limit(0)).count() == 0
    assert None not in {r["doc_id"] for r in near_duplicates(documents(spark)).select("doc_id").collect()}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = np.r_[a[:2700], rng.integers(0, 1 << 63, 300, dtype=np.uint64)]
    same = (nd.minwise(np.unique(a)) == nd.minwise(np.unique(b))).mean()
    assert abs(same - 2700 / 3300) < 0.15


def test_overlaps_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (5, 40, 50, 1)]
    assert nd._overlaps(sets).tolist() == [[len(np.intersect1d(x, y)) if (x is not y or np.isin(x, np.concatenate([s for s in sets if s is not x])).all()) else int(np.isin(x, np.concatenate([s for s in sets if s is not x])).sum()) for y in sets] for x in sets]
