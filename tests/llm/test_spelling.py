from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from cases import documents

from tidestar.llm import queries
from tidestar.llm.spelling import near_in_group, near_words, one_edit, spelling_variants, vectors

SMALL = "/root/testdata/sf0.001"


def near(a, b):
    """All edits of one letter, spelt out."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def vocabulary(rng, n, letters):
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        words.add(w)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[::-1]])
            words.add(w)
    return sorted(words)


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzàéîõüÿ漢"])
@pytest.mark.parametrize("node_words", [3, 20_000])
def test_pairs_against_all_pairs(spark, letters, node_words):
    words = vocabulary(random.Random(len(letters)), 150, letters)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = near_words(df, node_words).collect()
    pairs = [tuple(sorted((r["word"], r["other"]))) for r in got]
    expected = {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected and len(expected) > 20
    assert all(words[r["n"]] == r["word"] and words[r["other_n"]] == r["other"] for r in got)


def test_one_group_with_many_words_at_a_leaf():
    rng = random.Random(4)
    words = sorted({"".join(rng.sample("abcdefgh", 8)) for _ in range(300)} | {"abcdefgx", "abcdefgha", "bcdefgh"})
    assert len({tuple(v) for v in vectors(words).tolist()}) < 8
    found = {tuple(sorted((words[i], words[j]))) for i, j in near_in_group(words, words)}
    assert found == {(a, b) for a in words for b in words if a < b and near(a, b)}
    assert all(one_edit(a, b) == near(a, b) for a in words[:60] for b in words if len(a) >= len(b))


def expected_rows(counts, times=10):
    words = sorted(counts)
    beside = defaultdict(list)
    by_part = defaultdict(set)
    for w in words:  # words one edit apart share a string with one letter left out
        for k in range(len(w)):
            by_part[w[:k] + w[k + 1 :]].add(w)
        by_part[w].add(w)
    for group in by_part.values():
        for a in group:
            beside[a] += [b for b in group if near(a, b)]
    form = {}
    for w in words:
        if near_ones := set(beside[w]):
            best = min(near_ones, key=lambda x: (-counts[x], x))
            if counts[best] >= times * counts[w]:
                form[w] = best
    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), counts[w], len(set(beside[w])), counts.get(form.get(w))) for w in words)


def words_of(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_forms_and_roots(spark):
    counts = {"spelling": 5000, "speling": 400, "spelng": 30, "spelings": 40, "spellings": 40, "spellins": 3, "alonely": 9, "ÀÉÎÕÜß×": 20, "ÀÉÎÕÜß": 2}
    df = spark.createDataFrame([*counts.items(), (None, 3), ("nothing", None)], "word string, n long")
    got = {r["word"]: tuple(r) for r in spelling_variants(df).collect()}
    assert sorted(got.values()) == expected_rows(counts)
    assert got["spelng"][1:3] == ("speling", "spelling") and got["alonely"][1:3] == (None, "alonely")
    assert spelling_variants(df.limit(0)).count() == 0


def test_query_against_plain(spark, tmp_path):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(7, 11))) for _ in range(25)]
    text = lambda: " ".join(rng.choice([w, w.upper(), w + ",", w.title()]) for w in rng.choices(base, [40 // (k + 1) + 1 for k in range(25)], k=150))
    df = documents(spark, [(300 + i, text() + " éàüßÿ÷×Àabc", None, None, None, None, None, None) for i in range(80)] + [(None, text(), None, None, None, None, None, None)])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_group_trie"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = expected_rows(words_of([(r["doc_id"], r["text"]) for r in df.collect()]))
    assert sorted(map(tuple, got.collect())) == expected
    assert sum(r[1] is not None for r in expected) > 10


def test_query_on_the_sample(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.QUERIES["op13_group_trie"](spark, SMALL).collect()))
    assert got == expected_rows(words_of([tuple(r) for r in rows]))
