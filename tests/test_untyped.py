from __future__ import annotations

import json
import os

import feeds as fd
from pyspark.sql import functions as F
from test_files_and_stream import local
from test_warehouse import TIMES, first, rows

from tidestar.plans.star import transform_star
from tidestar.schemas import SOURCE_TABLES
from tidestar.session import scratch_dir
from tidestar.sources import untyped


def write(spark, lines):
    root = scratch_dir(spark, "untyped")
    os.makedirs(local(root))
    with open(f"{local(root)}/part.json", "w") as out:
        out.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n\n")
    return untyped.read_lines(spark, root)


def test_star_from_json_lines(spark):
    typed = first(spark)
    feeds = {}
    for table in SOURCE_TABLES:
        lines = [r[0] for r in typed[table].select(F.to_json(F.struct("*"))).collect()]
        read = write(spark, lines)
        feeds[table] = untyped.typed_feed(read, table)
        assert feeds[table].schema.simpleString() == typed[table].schema.simpleString()
        assert feeds[table].exceptAll(typed[table]).isEmpty() and typed[table].exceptAll(feeds[table]).isEmpty()
        assert untyped.bad_lines(read).isEmpty() and untyped.mixed_fields(read).isEmpty()
    star = transform_star(spark, feeds, fd.ARRIVAL, F.lit(TIMES[0]))
    assert rows(star.summary(), "table_name", "row_count") == rows(transform_star(spark, typed, fd.ARRIVAL, F.lit(TIMES[0])).summary(), "table_name", "row_count")


def test_values_of_several_types(spark):
    read = write(spark, [
        {"Op": "I", "id": 1, "name": "a", "created_at": "2024-01-01 10:00:00", "more": {"x": 1}},
        {"Op": "I", "id": "2", "name": 7, "created_at": "2024-01-01"},
        {"Op": "I", "id": "three", "name": None, "created_at": 5},
        {"Op": "I", "id": 4.5, "it's": True},
        "no json", "[1, 2]", "7",
    ])
    assert rows(untyped.mixed_fields(read), "field", "value_types", "n_values") == [
        ("created_at", "BIGINT,STRING", 3), ("id", "BIGINT,DECIMAL,STRING", 4), ("name", "BIGINT,STRING", 2),
    ]
    assert {("name", "VOID", 1), ("it's", "BOOLEAN", 1), ("more", "OBJECT<x: BIGINT>", 1)} <= set(rows(untyped.field_types(read), "field", "value_type", "n_values"))
    assert sorted(r["line"] for r in untyped.bad_lines(read).collect()) == ["7", "[1, 2]", "no json"]
    feed = untyped.typed_feed(read.where("line like '{%'"), "customers")
    assert [(r["id"], r["name"], str(r["created_at"])[:10]) for r in feed.orderBy("name", "id").collect()][-2:] == [(2, "7", "2024-01-01"), (1, "a", "2024-01-01")]
    lost = {r["column_name"]: (r["filled_rows"], r["lost_rows"]) for r in untyped.lost_values(read, "customers").collect()}
    assert lost["id"] == (4, 1) and lost["name"] == (2, 0) and lost["created_at"][0] == 3 and lost["email"] == (0, 0)
    assert "VARIANT" in untyped.inferred_schema(read.where("line like '{%'"))


def test_empty(spark):
    read = write(spark, [])
    assert untyped.typed_feed(read, "orders").isEmpty() and untyped.mixed_fields(read).isEmpty()
