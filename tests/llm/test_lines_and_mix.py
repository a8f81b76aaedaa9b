from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

from cases import SCHEMA, documents, sentence, words
from compare import connect, difference
from pyspark.sql import functions as F

from tidestar.llm import queries
from tidestar.llm.line_dedup import dedup_lines
from tidestar.llm.mixing import MOST, SHARE, WEIGHTS, mix, targets

SMALL = "/root/testdata/sf0.001"


def test_lines_against_plain_counts(spark):
    rng = random.Random(5)
    common = [f"Boilerplate number {k}: all rights reserved." for k in range(6)]
    rows = []
    for i in range(60):
        lines = [sentence(rng, 6) for _ in range(rng.randint(0, 4))] + [c for k, c in enumerate(common) if rng.random() < 0.1 + 0.05 * k]
        lines += ["short"] * rng.randint(0, 1) + ["  " + common[0] + " "] * (i % 7 == 0) + [""] * rng.randint(0, 1)
        rng.shuffle(lines)
        rows.append((500 + i, "\n".join(lines), "en", rng.choice([None, "a", "b", "c", "d", "e"]), None, None, None, None))
    df = documents(spark, rows)
    got = dedup_lines(df, min_sites=4)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    sites, keeper = defaultdict(set), {}
    for r in df.collect():
        for line in (r["text"] or "").split("\n"):
            line = line.strip(" ")
            if len(line) >= 20:
                sites[line].add(r["source"])
                if r["doc_id"] is not None:
                    keeper[line] = min(keeper.get(line, r["doc_id"]), r["doc_id"])
    gone = lambda r, line: len(sites[line.strip(" ")]) >= 4 and keeper.get(line.strip(" "), r["doc_id"]) != r["doc_id"]
    expected = []
    for r in df.collect():
        lines = [] if r["text"] is None else r["text"].split("\n")
        left = [x for x in lines if not gone(r, x)]
        expected.append((r["doc_id"], None if r["text"] is None else "\n".join(left), len(lines), len(lines) - len(left)))
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect()), key=repr) == sorted(expected, key=repr)
    assert any(n for *_, n in expected)
    assert dedup_lines(df.limit(0)).count() == 0


def filled(sizes):
    """Targets by sharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(sizes, 0.0), SHARE * sum(sizes.values()), set(sizes)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= MOST * sizes[s] - 1e-9:
                left += target[s] - MOST * sizes[s]
                target[s] = MOST * sizes[s]
                open_.discard(s)
    return target


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "B": 50, "c": 3, None: 400, "é": 0, "z": 77}
    got = targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long"))
    expected = filled(sizes)
    assert {r["source"]: round(r["target"], 6) for r in got.collect()} == {s: round(t, 6) for s, t in expected.items()}


def test_mix(spark):
    rng = random.Random(6)
    rows = [(3000 + i, sentence(rng, rng.randint(1, 40)), "en", rng.choice(["a", "b", "b", "b", "c", None]), None, None, None, None) for i in range(600)]
    df = documents(spark, rows)
    got = mix(df)
    # ``Size`` is there already.
    assert got.columns == [*df.columns, "size_", "source_size", "target", "taken"]
    every = got.collect()
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in every) == sorted((r["doc_id"] or -1, r["taken"]) for r in mix(df.repartition(7)).collect())
    sums, sizes = defaultdict(int), defaultdict(int)
    for r in every:
        n = len(words(r["text"]))
        assert r["size_"] == n and r["taken"] % max(n, 1) == 0 and r["taken"] <= MOST * n
        sums[r["source"]] += r["taken"]
        sizes[r["source"]] += n
    target = filled(sizes)
    for r in every:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
    largest = max(len(words(r["text"])) for r in every)
    assert all(abs(sums[s] - target[s]) <= largest / 2 + 1 for s in sizes)
    assert mix(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", None, None, None, None), (1, "", None, None, None, None, None, None)], SCHEMA)
    assert [r["taken"] for r in mix(blank).collect()] == [0, 0]


def drawn(rows, seed="mix"):
    """Copies of each row (id, text, source) without rows equal in all three: factors by bisection, then the odds one by one."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    target, out = filled(sizes), {}
    for source in sizes:
        own = [(i, t, len(words(t))) for i, t, s in rows if s == source]
        weight = {n: max(1, math.floor(256 * math.sqrt(n))) for *_, n in own if n}
        low, high = 0.0, 10.0
        for _ in range(200):
            middle = (low + high) / 2
            if sum(n * min(MOST, middle * weight[n]) for *_, n in own if n) < target[source]:
                low = middle
            else:
                high = middle
        odds, rest = [], target[source]
        for i, t, n in own:
            if n:
                e = min(MOST, high * weight[n])
                out[i] = math.floor(e + 1e-9)
                rest -= n * out[i]
                if e - out[i] > 1e-9:
                    p = e - out[i]
                    digest = hashlib.md5(f"{seed}|{i}|{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()
                    u = (int(digest[:12], 16) + 0.5) / 2**48
                    odds.append((u / (1 - u) / (p / (1 - p)), i, n))
        for _, i, n in sorted(odds):
            if rest < n / 2:
                break
            out[i] += 1
            rest -= n
    return out


def test_the_draw_against_plain(spark):
    rng = random.Random(16)
    rows = [(i, sentence(rng, rng.choice([1, 3, 10, 40, 200, 900])), rng.choice(["a", "b", "b", "c", "d"])) for i in range(400)] + [(1000, "", "a"), (1001, None, "e")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    expected = drawn(rows)
    assert {r["doc_id"]: r["taken"] for r in got} == {i: expected.get(i, 0) * len(words(t)) for i, t, _ in rows}
    assert len({expected[i] for i, *_ in rows if i < 1000}) == 3  # none, one and two copies


def test_equal_rows_meet_the_target(spark):
    rng = random.Random(17)
    rows = [(i, sentence(rng, 10), "a") for i in range(300)] + [(None, "the same ten words stand in each of these rows", "c")] * 1000 + [(7, "twice", "d")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    sums = {r["source"]: (r["n"], r["taken"], r["target"], r["most"]) for r in mix(df).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()}
    assert {s: x[0] for s, x in sums.items()} == {"a": 300, "c": 1000, "d": 3}
    assert all(abs(x[1] - x[2]) <= 5 and x[3] <= MOST for x in sums.values())
    again = mix(df.repartition(3)).where("source = 'c'").groupBy("taken").count().collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mix(df).where("source = 'c'").groupBy("taken").count().collect()))


def test_targets_of_many_sources(spark):
    rng = random.Random(18)
    sizes = {f"host{i:04d}": rng.choice([0, 1, 5, 100, 3000, 100000]) for i in range(700)}
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(9))
    expected = filled(sizes)
    assert all(abs(r["target"] - expected[r["source"]]) < 1e-6 * max(1, r["source_size"]) for r in got.collect())


def test_queries_against_sql(spark):
    with connect(SMALL) as con:
        for name, sql in queries.SQL.items():
            assert difference(queries.QUERIES[name](spark, SMALL), con, sql) is None, name
