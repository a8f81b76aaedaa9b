from __future__ import annotations

import random

import pytest
from cases import SCHEMA, components, sentence
from pyspark.sql import functions as F
from test_decontaminate import judged, split

import corpus_pipeline as pipeline

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(*COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_order_and_columns(spark, docs):
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "mixing"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_quality_keeps_clean_documents(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r["doc_id"] for r in pipeline.quality_rules(spark, docs, SMALL).select("doc_id").collect()}
    good = {r["doc_id"] for r in docs.join(labels.where("quality = 1"), "doc_id").where("size(split(text, '[ \\n]+')) >= 60").select("doc_id").collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").select("doc_id").collect()}
    assert len(good - kept) <= 0.02 * len(good)
    assert len(bad & kept) <= 0.1 * len(bad)


def test_near_and_benchmark_stages_against_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    texts = {r[0]: r[1] for r in rows}
    comp = components(texts)
    assert {r["doc_id"] for r in pipeline.near_dedup(spark, docs, SMALL).collect()} == {k for k, c in comp.items() if k == c}
    items = [(r["item_id"], split(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {k for k, t in texts.items() if not judged(t, items)[-1]}
    assert {r["doc_id"] for r in pipeline.decontamination(spark, docs, SMALL).collect()} == clean


def test_lines_that_others_hold_go(spark):
    rng = random.Random(1)
    shared = "All rights reserved by the makers of this page."
    rows = [(i, shared + "\n" + sentence(rng, 9), "en", f"s{i}", 1, None, None, None) for i in range(6)]
    rows += [(50, shared, "en", "s9", 2, None, None, None), (51, "", "en", "s9", 0, None, None, None), (52, None, None, None, None, None, None, None)]
    got = {r["doc_id"]: r for r in pipeline.line_dedup(spark, documents(spark, rows), SMALL).collect()}
    assert set(got) == {*range(6), 51, 52}
    assert got[0]["text"].startswith(shared) and got[0]["n_chars"] == 1
    assert all(shared not in got[i]["text"] and got[i]["n_chars"] == len(got[i]["text"]) for i in range(1, 6))


def test_odd_rows_and_empty_tables(spark):
    odd = documents(spark, [(None, None, None, None, None, None, None, None), (1, None, None, None, None, None, None, None), (None, "words " * 80, "en", "s", 1, None, None, None)])
    for name, stage in pipeline.STAGES:
        assert stage(spark, odd.limit(0), SMALL).count() == 0, name
        stage(spark, odd, SMALL).collect()


def test_rows_without_id_pass_the_filters(spark, docs):
    """Rows without an id, and rows that share one, are judged by their own text."""
    rng = random.Random(5)
    good, near = sentence(rng, 200), sentence(rng, 200)
    close = near.rsplit(" ", 1)[0] + " other"
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("size(split(text, ' ')) >= 12").first()["text"]
    row = lambda i, t, s="s": (i, t, "en", s, 1, None, None, None)
    left = lambda stage, rows: sorted(((r["doc_id"], r["text"]) for r in stage(spark, documents(spark, rows), SMALL).collect()), key=repr)
    junk = "too short"
    assert left(pipeline.quality_rules, [row(None, junk), row(None, good), row(1, good), row(1, junk)]) == sorted([(None, good), (1, good)], key=repr)
    assert left(pipeline.decontamination, [row(None, item), row(None, good), row(1, good), row(1, item)]) == sorted([(None, good), (1, good)], key=repr)
    rows = [row(None, good, "a"), row(None, good, "b"), row(7, near), row(None, close), row(None, None), row(None, None), row(None, " ")]
    assert left(pipeline.near_dedup, rows) == sorted([(None, good), (7, near), (None, None), (None, None), (None, " ")], key=repr)


def test_clashing_columns_and_repeated_rows(spark, docs):
    names = ["n_removed", "n_lines", "kept", "copies", "name", "cut", "u", "Taken", "target", "key", "rep", "id"]
    rows = docs.limit(30)
    wide = rows.union(rows).select("*", *[F.lit(1).alias(c) for c in names])
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, wide, SMALL).columns == wide.columns, name
    mixed = pipeline.mixing(spark, wide, SMALL)
    assert mixed.columns == [*wide.columns, "size", "source_size", "target_", "taken_"]
    assert mixed.where("taken_ > 0").count() > 0


def test_run(spark):
    got = pipeline.run(spark, SMALL)
    assert got.columns == [*COLUMNS, "size", "source_size", "target", "taken"]
    assert got.count() > 50
