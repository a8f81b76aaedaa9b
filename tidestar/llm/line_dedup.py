"""Removal of boilerplate lines that are spread over many sites.

The distinct sites of each line are sketched with HyperLogLog, and the sketches
merge by aggregation, so a line in a third of all documents costs one row for
each task. Lines whose estimate is near the threshold are counted exactly. Of a
boilerplate line one document keeps its copy: the one with the smallest id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.llm.shared import col, free_name, small, table, written

MIN_SITES = 5
MIN_CHARS = 20  # shorter lines recur by chance
LG_K = 8  # 256 registers; up to some ten sites a sketch is a list of hashes
DEVIATIONS = 5  # estimates this close to the threshold are counted exactly


def _site(source: Column) -> Column:
    """The name of a site; a null source is a site of its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int) -> DataFrame:
    """Lines that are long enough: (key, doc_id, site, at, line), line = a hash. ``key`` is a hash of id and text, equal only for equal rows."""
    text = col(text_col).cast("string")
    rows = docs.select(F.xxhash64(col(id_col), text).alias("key"), col(id_col).alias("doc_id"), _site(col(site_col)).alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("at", "content"))
    stripped = F.trim(F.col("content"))
    return rows.where(F.length(stripped) >= min_chars).select("key", "doc_id", "site", "at", F.xxhash64(stripped).alias("line"))


def boilerplate_hits(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Places to remove: (key, doc_id, at), one row for each line of each document but the one that keeps it."""
    lines = _lines(docs, id_col, text_col, site_col, min_chars)
    sketched = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min("doc_id").alias("keeper"))
    margin = max(1.0, DEVIATIONS * 1.04 / math.sqrt(1 << LG_K) * min_sites)
    spread = sketched.select("line", "keeper", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites - margin)
    candidates = written(spread, "spread")
    hits = written(lines.join(small(candidates), "line"), "hits")
    exact = hits.where(F.col("estimate") <= min_sites + margin).groupBy("line").agg(F.count_distinct("site").alias("sites"))
    local = written(exact.where(F.col("sites") < min_sites).select("line"), "local")
    # A line that only documents without id hold has no keeper and stays.
    return hits.join(small(local), "line", "left_anti").where(F.col("keeper").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("key", "doc_id", "at")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines taken out, and two more columns, n_lines and n_removed.

    A line (a piece between line feeds, without spaces at its ends) is boilerplate
    if it has at least ``min_chars`` characters and at least ``min_sites`` distinct
    sites hold it. The document with the smallest id keeps it as often as it has
    it; all others lose it. A null text stays null and has no lines, an empty one
    has one. A null site counts as a site. Rows without id never keep a line that
    a row with an id holds; rows that repeat an id keep or lose alike. Clashing
    column names are kept: the new columns get an underscore more.
    """
    hits = boilerplate_hits(docs, id_col, text_col, site_col, min_sites, min_chars)
    key, gone = free_name(docs, "_key"), free_name(docs, "_gone")
    removed = hits.groupBy(F.col("key").alias(key)).agg(F.collect_set("at").alias(gone))
    text = col(text_col).cast("string")
    # Neither side has a bound, so the join is the same at every size.
    joined = docs.withColumn(key, F.xxhash64(col(id_col), text)).join(removed.hint("merge"), key, "left")
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    # The list in a list of one: it is split once, not once for each line that stays.
    rest = F.transform(F.array(lines), lambda every: F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n"))[0]
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    return joined.select(
        *[F.when(F.col(gone).isNull(), text).otherwise(rest).alias(c) if c == text_col else col(c) for c in docs.columns],
        F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias(n_lines),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(n_removed),
    )


def op2_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


# Sites are counted exactly for every line.
OP2_SQL = f"""
WITH l AS (
  SELECT doc_id, source, p, trim(s[p], ' ') AS line
  FROM (SELECT doc_id, source, s, unnest(range(1, len(s) + 1)) AS p FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents))),
b AS (
  SELECT line, min(doc_id) AS keeper FROM l WHERE length(line) >= {MIN_CHARS}
  GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '-')) >= {MIN_SITES}),
g AS (
  SELECT doc_id, list(p) AS gone FROM l JOIN b USING (line) WHERE doc_id <> keeper GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(g.gone), 0)::BIGINT AS n_removed,
  CASE WHEN g.gone IS NULL THEN d.text ELSE coalesce(array_to_string(
    list_transform(list_filter(range(1, len(string_split(d.text, chr(10))) + 1), lambda i: NOT list_contains(g.gone, i)), lambda i: string_split(d.text, chr(10))[i]),
    chr(10)), '') END AS text
FROM documents d LEFT JOIN g USING (doc_id)
"""
