"""Type names, inferred types and nullability of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Printed name of each Spark type.
TYPE_NAMES = {
    T.ByteType: "INT",
    T.ShortType: "INT",
    T.IntegerType: "INT",
    T.LongType: "LONG",
    T.StringType: "STRING",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.BinaryType: "BINARY",
}


def type_name(kind: T.DataType) -> str:
    """Printable name of a type, with precision and scale for decimals."""
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return TYPE_NAMES.get(type(kind), kind.typeName().upper())


def inferred_type(kind: T.DataType) -> T.DataType:
    """Type a table column gets when only a sample value is known."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, 18)
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(kind, T.TimestampType):
        return T.TimestampNTZType()
    return kind if type(kind) in TYPE_NAMES else T.StringType()


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, rows, non-null rows, whether it is optional.

    All counts are taken in a single pass and only then turned into rows, so
    the shuffle carries one row per task.
    """
    counts = [F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(df.columns)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows: list[Column] = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.col("total").alias("total_rows"),
            F.col(f"c{i}").alias("filled_rows"),
            (F.col(f"c{i}") < F.col("total")).alias("is_optional"),
        )
        for i, name in enumerate(df.columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def infer_column_types(df: DataFrame) -> DataFrame:
    """One row per column: its type if it holds a value, else null.

    With no value at all there is no sample to infer from.
    """
    names = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, type_name(inferred_type(f.dataType)))]
    )
    return column_profile(df).select(
        "position",
        "column_name",
        F.when(F.col("filled_rows") > 0, names[F.col("column_name")]).alias("inferred_type"),
        "is_optional",
    )
