from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import functions as fn
from tidestar.functions.typing import inferred_type
from tidestar.sources.files import object_key, size_formatted, table_of_key

VECTORS = [
    (("dim_customer", "1"), -5992128038920610821),
    (("dim_customer", "42"), -344945729526503112),
    (("dim_customer", "john@example.com"), -2202040070805221224),
    (("dim_product", "500"), 41397866417225453),
    (("dim_date", "2024-06-15"), 8376945982727323774),
    (("fact_orders", "42", "100"), -658910977464371143),
    (("dim_customer", "Jane Smith"), 1055786537866384777),
    (("dim_customer", "客户名称"), 2824187262262169604),
]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("parts", "expected"), VECTORS)
def test_key_vectors(spark, parts, expected):
    assert one(spark, fn.surrogate_key(parts[0], *[F.lit(p) for p in parts[1:]])) == expected


def test_key_formula_and_null_part(spark):
    text = "t|null|7"
    expected = int(hashlib.md5(text.encode()).hexdigest()[:16], 16)
    expected -= (1 << 64) if expected >= 1 << 63 else 0
    assert one(spark, fn.surrogate_key("t", F.lit(None).cast("int"), F.lit(7))) == expected


def test_keys_do_not_collide(spark):
    keys = spark.range(10_000).select(fn.surrogate_key("dim_customer", F.col("id")).alias("k"))
    assert keys.distinct().count() == 10_000


def test_md5_hex(spark):
    assert one(spark, fn.md5_hex(F.lit("客"))) == hashlib.md5("客".encode()).hexdigest()


def test_op_priority(spark):
    for op, rank in (("I", 1), ("U", 2), ("D", 3), ("X", 0), ("i", 0), (None, 0)):
        assert one(spark, fn.op_priority(F.lit(op).cast("string"))) == rank


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        (None, T.StringType(), 0), ("12", T.StringType(), 12), ("-7", T.StringType(), -7), ("+3", T.StringType(), 3),
        ("12.5", T.StringType(), 0), (" 12", T.StringType(), 0), ("abc", T.StringType(), 0), ("", T.StringType(), 0),
        ("99999999999", T.StringType(), 0), (5, T.IntegerType(), 5), (2**31, T.LongType(), -(2**31)),
        (2**32 + 9, T.LongType(), 9), (3.99, T.DoubleType(), 3), (-3.99, T.DoubleType(), -3),
        (1e12, T.DoubleType(), 2**31 - 1), (float("nan"), T.DoubleType(), 0), (Decimal("8.75"), T.DecimalType(10, 2), 8),
        (True, T.BooleanType(), 0),
    ],
)
def test_to_int_safe(spark, value, kind, expected):
    row = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", kind)]))
    assert row.select(fn.to_int_safe(F.col("x"), kind)).first()[0] == expected


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        (None, T.DecimalType(10, 2), "0.00"), (Decimal("9.99"), T.DecimalType(10, 2), "9.99"), (5, T.IntegerType(), "5.00"),
        (2.5, T.DoubleType(), "2.50"), ("12.34", T.StringType(), "12.34"), ("1e2", T.StringType(), "100.00"),
        ("x", T.StringType(), "0.00"), (" 1", T.StringType(), "0.00"), (True, T.BooleanType(), "0.00"),
    ],
)
def test_to_decimal_safe(spark, value, kind, expected):
    row = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", kind)]))
    assert str(row.select(fn.to_decimal_safe(F.col("x"), kind)).first()[0]) == expected


def test_dates_and_times(spark):
    day, when = dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 10, 30, 0, 123456)
    row = spark.createDataFrame(
        [(day, when, "x")], "d date, t timestamp_ntz, s string",
    )
    ntz = T.TimestampNTZType()
    got = row.select(
        fn.to_timestamp_safe(F.col("d"), T.DateType()), fn.to_timestamp_safe(F.col("t"), ntz),
        fn.to_timestamp_safe(F.col("s"), T.StringType()), fn.to_date_safe(F.col("t"), ntz),
        fn.to_date_safe(F.col("s"), T.StringType()), fn.date_to_epoch_day(F.col("d"), T.DateType()),
        fn.ts_to_epoch_micros(F.col("t"), ntz), fn.epoch_micros(F.col("t"), ntz),
    ).first()
    seconds = int((when.replace(microsecond=0) - dt.datetime(1970, 1, 1)).total_seconds())
    assert list(got) == [
        dt.datetime(2024, 1, 15), when, None, day, None, (day - dt.date(1970, 1, 1)).days,
        seconds * 1_000_000 + 123_000, seconds * 1_000_000 + 123_456,
    ]


def test_micros_before_the_epoch(spark):
    row = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 999_900),)], "t timestamp_ntz")
    ntz = T.TimestampNTZType()
    assert list(row.select(fn.epoch_micros(F.col("t"), ntz), fn.ts_to_epoch_micros(F.col("t"), ntz)).first()) == [-100, -1000]


def test_conversion_of_other_types_raises():
    with pytest.raises(TypeError):
        fn.date_to_epoch_day(None, T.StringType())
    with pytest.raises(TypeError):
        fn.ts_to_epoch_micros(None, T.StringType())


@pytest.mark.parametrize(
    ("kind", "name", "inferred"),
    [
        (T.IntegerType(), "INT", "INT"), (T.LongType(), "LONG", "LONG"), (T.DecimalType(12, 2), "DECIMAL(12,2)", "DECIMAL(38,18)"),
        (T.StringType(), "STRING", "STRING"), (T.BooleanType(), "BOOLEAN", "BOOLEAN"), (T.TimestampNTZType(), "TIMESTAMP", "TIMESTAMP"),
        (T.DateType(), "DATE", "DATE"), (T.DoubleType(), "DOUBLE", "DOUBLE"), (T.FloatType(), "FLOAT", "DOUBLE"),
        (T.BinaryType(), "BINARY", "BINARY"), (T.ArrayType(T.StringType()), "ARRAY", "STRING"),
    ],
)
def test_type_names(kind, name, inferred):
    assert fn.type_name(kind) == name
    assert fn.type_name(inferred_type(kind)) == inferred


def test_inference_needs_a_value(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    got = {r["column_name"]: (r["inferred_type"], r["is_optional"]) for r in fn.infer_column_types(df).collect()}
    assert got == {"a": ("INT", False), "b": (None, True)}


@pytest.mark.parametrize(
    ("key", "table"),
    [
        ("dms-source/public/customers/LOAD1.parquet", "customers"), ("a/b/c", "c"), ("folder/file.parquet", "folder"),
        ("/file.parquet", "unknown"), ("file.parquet", "unknown"),
    ],
)
def test_table_of_key(spark, key, table):
    assert one(spark, table_of_key(F.lit(key))) == table


def test_object_key(spark):
    for path in ("file:/x/landing/a/b/c.parquet", "file:///x/landing/a/b/c.parquet"):
        assert one(spark, object_key(F.lit(path), "file:/x/landing")) == "a/b/c.parquet"
    assert one(spark, object_key(F.lit("s3://bucket/a/b/c.parquet"), "s3://bucket")) == "a/b/c.parquet"


@pytest.mark.parametrize(
    ("size", "text"),
    [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1536, "1.5 KB"), (1 << 20, "1.0 MB"), (5 << 30, "5.0 GB"), (5 << 40, "5120.0 GB")],
)
def test_size_formatted(spark, size, text):
    assert one(spark, size_formatted(F.lit(size).cast("bigint"))) == text
