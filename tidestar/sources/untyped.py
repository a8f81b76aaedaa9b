"""Change feeds without a schema: one JSON object to a line.

Lines are parsed once into a VARIANT, which keeps each value with the type it
has. What columns there are, and whether a column holds values of several
types, is told by aggregations over the values; the change rows of the star are
taken out by path, with the declared types, and what does not fit counts as it
does in typed feeds. All of it is expressions and aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.schemas import ID, NTZ, feed_schema

JSON_GLOB = "*.json"


def read_lines(spark: SparkSession, paths: str | list[str], glob: str = JSON_GLOB) -> DataFrame:
    """Rows (row, line): the line as a VARIANT, null where it is no JSON."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(paths)
    return lines.where("trim(value) <> ''").select(F.try_parse_json("value").alias("row"), F.col("value").alias("line"))


def bad_lines(rows: DataFrame) -> DataFrame:
    """Lines that are no JSON objects."""
    return rows.where(F.col("row").isNull() | ~F.startswith(F.schema_of_variant("row"), F.lit("OBJECT"))).select("line")


def inferred_schema(rows: DataFrame) -> str:
    """The type that all lines fit, as Spark's name of it; fields of several types that have none in common are VARIANT."""
    return rows.agg(F.schema_of_variant_agg("row")).first()[0]


def field_types(rows: DataFrame) -> DataFrame:
    """Of each top-level field and each type of its values: field, value_type, n_values. A null value has the type VOID."""
    rows.createOrReplaceTempView("_untyped_rows")
    return rows.sparkSession.sql(
        "SELECT v.key AS field, regexp_replace(schema_of_variant(v.value), '\\\\(.*', '') AS value_type, count(*) AS n_values "
        "FROM _untyped_rows r, LATERAL variant_explode(r.row) AS v WHERE v.key IS NOT NULL GROUP BY ALL"
    )


def mixed_fields(rows: DataFrame) -> DataFrame:
    """Fields whose values have several types, nulls aside: field, value_types (sorted), n_values."""
    return field_types(rows).where("value_type <> 'VOID'").groupBy("field").agg(
        F.array_join(F.array_sort(F.collect_set("value_type")), ",").alias("value_types"), F.sum("n_values").alias("n_values"), F.count(F.lit(1)).alias("k"),
    ).where("k > 1").drop("k")


def _taken(name: str, kind: T.DataType) -> Column:
    path = "$['" + name.replace("'", "\\'") + "']"
    # A time without a zone is meant; a number with too many places is rounded by a cast from text, as in typed feeds.
    target = "string" if isinstance(kind, T.DecimalType) else "timestamp_ntz" if kind == NTZ else kind.simpleString()
    value = F.try_variant_get("row", path, target)
    return (value.try_cast(kind) if isinstance(kind, T.DecimalType) else value).alias(name)


def typed_feed(rows: DataFrame, table: str, id_type: T.DataType = ID, ts_col: str = "Timestamp") -> DataFrame:
    """Change rows of a table with the declared columns; a value that does not fit its column, or is not there, is null."""
    declared = feed_schema(table, id_type, ts_col)
    return rows.where(F.col("row").isNotNull()).select(*[_taken(f.name, f.dataType) for f in declared.fields]).withColumnRenamed(ts_col, "Timestamp")


def lost_values(rows: DataFrame, table: str, id_type: T.DataType = ID) -> DataFrame:
    """Of each declared column: how many lines hold a value, and how many of these do not fit its type: column_name, filled_rows, lost_rows."""
    counted = []
    for f in feed_schema(table, id_type).fields:
        there = F.try_variant_get("row", f"$['{f.name}']", "string").isNotNull()
        counted += [F.count_if(there).alias(f"filled_{f.name}"), F.count_if(there & _taken(f.name, f.dataType).isNull()).alias(f"lost_{f.name}")]
    one = rows.agg(*counted)
    names = [f.name for f in feed_schema(table, id_type).fields]
    told = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"filled_{n}").alias("filled_rows"), F.col(f"lost_{n}").alias("lost_rows")) for n in names])
    return one.select(F.inline(told))
