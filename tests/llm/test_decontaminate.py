from __future__ import annotations

import hashlib
import random
import re

from cases import documents, sentence

from tidestar.llm.decontaminate import contamination, phrase_matches, positional_index, proximity_matches, test_items as items_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
items_of.__test__ = False


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def judged(text, items):
    w, hit, ids = split(text), set(), set()
    for item, words in items:
        size = min(10, len(words))
        for s in range(len(words) - size + 1) if words else ():
            for i in range(len(w) - size + 1):
                if w[i : i + size] == words[s : s + size]:
                    hit |= set(range(i, i + size))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_against_plain_search(spark):
    rng = random.Random(4)
    tests = [sentence(rng, n) for n in (10, 25, 12, 3, 40)]
    tests += [tests[0], "the the the the the the the the the the the the", "ab CD éÀ", None, "", "...", "漢字 𝒳"]
    benchmark = spark.createDataFrame([*enumerate(tests), (None, tests[2])], "item_id long, text string")
    w = tests[1].split()
    texts = [
        "x " + tests[0] + " y", "x " + " ".join(w[3:13]).upper() + "! z", " ".join(w[:9]), tests[4] + " " + tests[4], "no " + tests[3],
        "the " * 30, "ab, cd. éÀ", "ab cd éà", " ".join(w[:12] + ["q"] + w[12:]), tests[2], ". ".join(w),
    ]
    df = documents(spark, [(2000 + i, t, "en", "s0", None, None, None, None) for i, t in enumerate(texts)])
    got = sorted((tuple(r) for r in contamination(df, benchmark).collect()), key=repr)
    named = [(i, split(t)) for i, t in enumerate(tests)]
    expected = []
    for r in df.collect():
        n, hit, ids, digest, bad = judged(r["text"], named)
        expected.append((r["doc_id"], n, hit, ids, digest, bad))
    assert got == sorted(expected, key=repr)


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert contamination(documents(spark).limit(0), benchmark).count() == 0
    clean = contamination(documents(spark), benchmark.limit(0))
    assert clean.count() == documents(spark).count() and clean.where("contaminated").isEmpty()


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha x beta gamma"), (3, "alpha x x x beta gamma"), (4, "gamma beta alpha")], "doc_id long, text string")
    items = items_of(spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string"))
    index = positional_index(docs, items.terms)
    ids = index.select("row", "doc_id").distinct()
    found = lambda matches: sorted(r["doc_id"] for r in matches.join(ids, "row").select("doc_id").distinct().collect())
    assert found(phrase_matches(index, items)) == found(proximity_matches(index, items, 0)) == [1]
    assert found(proximity_matches(index, items, 1)) == [1, 2]
    assert found(proximity_matches(index, items, 2)) == [1, 2]
    assert found(proximity_matches(index, items, 3)) == [1, 2, 3]
    assert found(proximity_matches(index, items, 4)) == [1, 2, 3, 4]


def test_a_long_item_against_itself(spark):
    rng = random.Random(9)
    words = sentence(rng, 200_000).split()
    words[50_000:50_400] = ["again", "and"] * 200
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[100_000:100_010])), (3, " ".join(words[100_000:100_009])), (4, " ".join([*words[:70_000], "break", *words[70_001:]]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words)), (8, "again and again"), (9, "again")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in contamination(docs, items).collect()}
    assert got == {1: (200_000, 200_000, 3), 2: (10, 10, 1), 3: (9, 0, 0), 4: (200_000, 199_999, 3)}
