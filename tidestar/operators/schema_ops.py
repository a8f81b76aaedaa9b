"""Schema evolution and type mismatches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.typing import type_name


def evolve_union(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Table and batch together; new columns of the batch are null in old rows."""
    return table.unionByName(align_to(batch, table.schema), allowMissingColumns=True)


def align_to(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """The batch in the table's column types, new columns last.

    Missing columns are null; a value that does not fit the column is null.
    """
    have = {f.name: f.dataType for f in batch.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType:
            column = F.col(field.name)
        else:
            column = F.col(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    known = set(schema.fieldNames())
    return batch.select(*columns, *[F.col(f"`{c}`") for c in batch.columns if c not in known])


def schema_mismatches(schema: T.StructType, batch: DataFrame) -> DataFrame:
    """One row per column whose type differs from the table's.

    Tells both types, the rows with a value, and the rows whose value would be
    lost by coercion. One pass over only the columns concerned.
    """
    have = {f.name: f.dataType for f in batch.schema.fields}
    bad = [f for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    shape = "column_name string, table_type string, data_type string, filled_rows bigint, lost_rows bigint"
    if not bad:
        return batch.sparkSession.createDataFrame([], shape)
    counts = []
    for i, field in enumerate(bad):
        value = F.col(field.name)
        counts.append(F.count(value).alias(f"f{i}"))
        counts.append(F.count(F.when(value.try_cast(field.dataType).isNull(), value)).alias(f"l{i}"))
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(type_name(field.dataType)).alias("table_type"),
            F.lit(type_name(have[field.name])).alias("data_type"),
            F.col(f"f{i}").alias("filled_rows"),
            F.col(f"l{i}").alias("lost_rows"),
        )
        for i, field in enumerate(bad)
    ]
    return batch.agg(*counts).select(F.inline(F.array(*rows)))
