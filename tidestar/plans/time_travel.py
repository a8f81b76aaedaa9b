"""Versions of the star tables as SQL table functions.

``fact_orders_at_version(n)`` and ``fact_orders_as_of(t)``, and the same for the
dimensions, can stand in SQL text where a table name stands. Their bodies are
plain SQL over views of the warehouse's logs, with the argument in the test of
the batch folders, so a call opens the folders of its version only. Reading the
logs is left to the query: a function sees batches that are committed after it
was made, unless a compaction has come in between; then make it anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.plans.warehouse import BITMAP_BITS, BROADCAST_BITMAPS, DIMENSIONS, Warehouse
from tidestar.schemas import star_schema

VERSION, TIME = "at_version", "as_of"
# The test of a batch or a commit against the argument: of versions and of times.
_UNTIL = {VERSION: "batch_id <= {f}.v", TIME: "committed_at <= {f}.t"}
_ARGUMENT = {VERSION: "v BIGINT", TIME: "t TIMESTAMP_NTZ"}


def _segments(warehouse: Warehouse) -> DataFrame:
    """Folders of facts, each with the first batch and time that show it, and the ones from which another one takes its place."""
    commits = warehouse.commits()
    over = commits.where("table_name = 'fact_compacted'").select(F.col("batch_id").alias("g"), F.col("committed_at").alias("g_at"))
    own = commits.where("table_name IN ('fact_orders', 'fact_compacted')")
    # A batch is hidden by the first compaction from its own number on, a compaction by the next one.
    hides = (F.col("g") > F.col("batch_id")) | ((F.col("g") == F.col("batch_id")) & (F.col("table_name") == "fact_orders"))
    return own.join(over, hides, "left").groupBy(
        (F.col("table_name") == "fact_compacted").alias("compacted"), F.col("batch_id"), F.col("committed_at"),
    ).agg(F.min("g").alias("hidden_in"), F.min("g_at").alias("hidden_at"))


def _placed(warehouse: Warehouse) -> DataFrame:
    """All facts of all folders, with folder, file, bucket and position."""
    position = F.col("_metadata.row_index")
    place = [F.shiftright(position, BITMAP_BITS).alias("_bucket"), position.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("_position")]
    columns = star_schema("fact_orders", warehouse.id_type).fieldNames()
    rows = warehouse._scan("fact_orders").select(
        *columns, F.lit(False).alias("_compacted"), F.col("_batch_id").alias("_folder"),
        F.concat_ws("/", "_batch_id", warehouse.fact_folder, "_metadata.file_name").alias("_file"), *place,
    )
    generations = [r["batch_id"] for r in warehouse.commits().where("table_name = 'fact_compacted'").select("batch_id").distinct().collect()]
    for g in generations:
        old = warehouse.spark.read.schema(warehouse.schema("fact_orders")).parquet(f"{warehouse.path('fact_compacted')}/_generation={g}")
        rows = rows.unionByName(old.select(
            *columns, F.lit(True).alias("_compacted"), F.lit(g).cast("bigint").alias("_folder"),
            F.concat_ws("/", F.lit("compacted"), F.lit(g), "_metadata.file_name").alias("_file"), *place,
        ))
    return rows


def _returns(schema_of: list) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema_of)


def create_functions(warehouse: Warehouse, prefix: str = "") -> list[str]:
    """Make the table functions of this session, and tell their names.

    ``prefix`` comes before the names of the functions and of the views they are built on.
    """
    spark: SparkSession = warehouse.spark
    p = prefix
    warehouse.commits().createOrReplaceTempView(f"{p}commits")
    _segments(warehouse).createOrReplaceTempView(f"{p}fact_segments")
    _placed(warehouse).createOrReplaceTempView(f"{p}fact_rows")
    warehouse._scan("fact_vectors").withColumnRenamed("_batch_id", "batch_id").createOrReplaceTempView(f"{p}fact_vectors")
    made = []
    # One row for each folder of facts, and the bitmaps up to a bound as in the warehouse's own reads: no fact is shuffled.
    small = "s, gone" if warehouse.bitmaps() <= BROADCAST_BITMAPS else "s"
    facts = star_schema("fact_orders", warehouse.id_type).fields
    for kind in (VERSION, TIME):
        name = f"{p}fact_orders_{kind}"
        until = _UNTIL[kind].format(f=name)
        hidden = f"(s.hidden_in IS NULL OR s.hidden_in > {name}.v)" if kind == VERSION else f"(s.hidden_at IS NULL OR s.hidden_at > {name}.t)"
        folder = f"AND r._folder <= {name}.v" if kind == VERSION else ""
        spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({_ARGUMENT[kind]}) RETURNS TABLE ({_returns(facts)}) RETURN
            WITH gone AS (
              SELECT v.file, v.bucket, bitmap_or_agg(v.bitmap) AS bitmap
              FROM {p}fact_vectors v JOIN (SELECT batch_id, committed_at FROM {p}commits WHERE table_name = 'fact_vectors') c USING (batch_id)
              WHERE {until} GROUP BY v.file, v.bucket)
            SELECT /*+ BROADCAST({small}) */ {', '.join('r.' + f.name for f in facts)} FROM {p}fact_rows r
              JOIN {p}fact_segments s ON r._compacted = s.compacted AND r._folder = s.batch_id
              LEFT JOIN gone ON r._file = gone.file AND r._bucket = gone.bucket
            WHERE s.{until} AND {hidden} {folder} AND (gone.bitmap IS NULL
              OR shiftright(cast(conv(hex(substring(gone.bitmap, cast(shiftright(r._position, 3) AS INT) + 1, 1)), 16, 10) AS INT), cast(r._position & 7 AS INT)) & 1 = 0)""")
        made.append(name)
        for table, dim in DIMENSIONS.items():
            fields = [f for f in star_schema(table, warehouse.id_type).fields]
            warehouse._scan(table).withColumnRenamed("_batch_id", "batch_id").createOrReplaceTempView(f"{p}{table}_log")
            name = f"{p}{table}_{kind}"
            until = _UNTIL[kind].format(f=name)
            folder = f"AND l.batch_id <= {name}.v" if kind == VERSION else ""
            others = ", ".join(f"l.{f.name}" for f in fields if f.name != dim.natural_id)
            spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({_ARGUMENT[kind]}) RETURNS TABLE ({_returns(fields)}) RETURN
                WITH versions AS (
                  SELECT l.{dim.natural_id}, l.opened_in, min_by(struct({others}), l.event) AS row
                  FROM {p}{table}_log l JOIN (SELECT batch_id, committed_at FROM {p}commits WHERE table_name = '{table}') c USING (batch_id)
                  WHERE {until.replace('batch_id', 'c.batch_id', 1) if kind == VERSION else until} {folder} GROUP BY l.{dim.natural_id}, l.opened_in)
                SELECT {', '.join(dim.natural_id if f.name == dim.natural_id else 'row.' + f.name for f in fields)} FROM versions""")
            made.append(name)
    return made
