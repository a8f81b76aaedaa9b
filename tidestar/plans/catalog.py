"""Star tables as named tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.typing import type_name
from tidestar.plans.star import gather_by, row_counts
from tidestar.schemas import ID, STAR_TABLES, star_schema

# Properties every star table carries.
TABLE_PROPERTIES = {"layer": "gold", "parquet.compression": "snappy"}


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT 'Change data as a star schema'{where}")


def create_star_tables(
    spark: SparkSession, database: str, root: str, *, id_type: T.DataType = ID, tables: tuple[str, ...] = STAR_TABLES,
) -> None:
    """Make the declared tables where they are missing.

    Facts are partitioned by the day of the order. Each gets ``TABLE_PROPERTIES``.
    """
    properties = ", ".join(f"'{key}' = '{value}'" for key, value in TABLE_PROPERTIES.items())
    for table in tables:
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in star_schema(table, id_type).fields]
        partition = ""
        if table == "fact_orders":
            columns.append("order_day date")
            partition = " PARTITIONED BY (order_day)"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(columns)}) USING parquet{partition} "
            f"LOCATION '{root}/{table}' TBLPROPERTIES ({properties})"
        )


def append_star_tables(
    spark: SparkSession, database: str, frames: dict[str, DataFrame],
) -> None:
    """Append each frame to its table by column name."""
    for table, frame in frames.items():
        if table == "fact_orders":
            frame = gather_by(frame.withColumn("order_day", F.to_date("order_timestamp")), "order_day")
        columns = spark.table(f"{database}.{table}").columns
        frame.select(*columns).write.mode("append").insertInto(f"{database}.{table}")


def register_table(spark: SparkSession, database: str, table: str, location: str, properties: dict[str, str]) -> None:
    """Make the table known under its name, or move it to ``location`` and merge its properties."""
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def table_properties(spark: SparkSession, database: str, tables: tuple[str, ...] = STAR_TABLES) -> DataFrame:
    result = None
    for table in tables:
        own = spark.sql(f"SHOW TBLPROPERTIES {database}.{table}").select(F.lit(table).alias("table_name"), "key", "value")
        result = own if result is None else result.unionAll(own)
    return result


def verify_tables(spark: SparkSession, database: str, tables: tuple[str, ...] = STAR_TABLES) -> DataFrame:
    """Whether each expected table is registered."""
    rows = [(table, spark.catalog.tableExists(f"{database}.{table}")) for table in tables]
    return spark.createDataFrame(rows, "table_name string, is_registered boolean")


def table_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Name and type of each column, in order."""
    fields = spark.table(f"{database}.{table}").schema.fields
    rows = [(i + 1, f.name, type_name(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string").orderBy(
        "ordinal_position"
    )


def registered_counts(spark: SparkSession, database: str, tables: tuple[str, ...] = STAR_TABLES) -> DataFrame:
    return row_counts({table: spark.table(f"{database}.{table}") for table in tables})
