"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm.decontaminate import contamination
from tidestar.llm.line_dedup import dedup_lines
from tidestar.llm.mixing import WORD, mix
from tidestar.llm.near_dedup import near_duplicates
from tidestar.llm.quality_rules import fit, judge
from tidestar.llm.shared import col, free_name, small, table, written


def _key() -> Column:
    """A hash of id and text, equal only for equal ids and texts; a null id is one of its own."""
    return F.xxhash64(col("doc_id"), col("text").cast("string"))


def _only(docs: DataFrame, decisions: DataFrame, by: Column) -> DataFrame:
    """The rows of ``docs`` whose ``by`` is not that of a decision against them. ``decisions``: (doc_id, kept), doc_id = a value of ``by``."""
    key = free_name(docs, "_key")
    dropped = written(decisions.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct(), "dropped")
    return docs.withColumn(key, by).join(small(dropped), key, "left_anti").select(*[col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the labelling of lines reject go; each row is judged by its own text, in one pass."""
    field = fit(docs, table(spark, sf_dir, "labels"))
    # The verdict stands beside the columns of the documents, whatever these are called.
    apart = {c: f"_column_{k}" for k, c in enumerate(docs.columns)}
    judged = judge(docs.select(*[col(c).alias(name) for c, name in apart.items()]), field, apart["text"])
    return judged.where("kept").select(*[F.col(name).alias(c) for c, name in apart.items()])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; a document that loses all its lines goes with them, as others hold each of them. n_chars follows the text."""
    cleaned = dedup_lines(docs)
    n_lines, n_removed = (col(c) for c in cleaned.columns[-2:])
    left = cleaned.where(~((n_removed > 0) & (n_removed == n_lines)))
    n_chars = F.when(n_removed > 0, F.length("text").cast("long")).otherwise(col("n_chars")) if "n_chars" in docs.columns else None
    return left.select(*[n_chars.alias(c) if c == "n_chars" else col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Rows without id get one made of their text, above 2 ** 62; of equal texts among them one row stays.
    """
    own = col("doc_id").cast("long")
    text = col("text").cast("string")
    # Texts without words are no copies of each other and are linked with nothing.
    nameless = F.coalesce(own.isNull() & text.rlike(WORD), F.lit(False))
    row = F.struct(*[col(c) for c in docs.columns])
    once = docs.where(nameless).select(text.alias("text"), row.alias("row")).groupBy("text").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    docs = docs.where(~nameless).union(once)
    by = F.when(nameless, F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)).otherwise(own)
    return _only(docs, near_duplicates(docs.select(by.alias("doc_id"), "text")), by)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = contamination(docs.select(_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _only(docs, found.select("doc_id", (~F.col("contaminated")).alias("kept")), _key())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with how many words of each are taken, repeats counted."""
    mixed = mix(docs)
    return mixed.where(col(mixed.columns[-1]) > 0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The first stage's verdict is a trained field's, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name.replace(' ', '-')}")
    return docs
