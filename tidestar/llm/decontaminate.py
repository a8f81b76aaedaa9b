"""Benchmark decontamination with a positional inverted index of the training texts.

``positional_index`` writes one posting (row, term, position) for each token of
the training texts that is a term of the test items; tokens that are no such
term cannot take part in a match. The index stays dealt out by document, as the
texts were, so that it is made without a shuffle. Phrases are found from it by
intersecting lists adjusted by offset: a posting at position p of the term at
place q of an item lies on the diagonal p - q, and a phrase is a run of places
on one diagonal. The two rarest terms of each window pick the diagonals, and
only on those the other terms are looked up. Everything is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidestar.llm.shared import col, small, table, written

WINDOW = 10
# Words before their letters A-Z are put into lower case: runs of digits, letters and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = ""  # stands behind the last word of a text; its position is the number of words


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def folded(word: Column) -> Column:
    """A-Z in lower case and nothing else; most words need no work, which ``lower`` tells fast."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


@dataclass
class Items:
    """Test items. ``places``: (item, item_id, n, q, term, word), ``terms``: (word, term)."""

    places: DataFrame
    terms: DataFrame


def test_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Items:
    """The words of the test items with a number for each distinct word. Size: that of the test set."""
    rows = items.select(
        F.monotonically_increasing_id().alias("item"), col(id_col).alias("item_id"), words(col(text_col).cast("string")).alias("words"),
    )
    each = written(rows.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("q", "word")).withColumn("word", folded(F.col("word"))), "places")
    terms = written(each.select("word").distinct().withColumn("term", F.xxhash64("word")), "terms")
    return Items(each.withColumn("term", F.xxhash64("word")), terms)


def positional_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (row, doc_id, pos, term) of the given terms, written.

    ``row`` tells rows of ``docs`` apart, also where ids are null or repeat. Each
    row has one posting without term at the end of its text, so ``pos`` there is
    its number of words; a null or empty text has only that one.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("doc_id"), words(col(text_col).cast("string")).alias("words"))
    tokens = texts.select("row", "doc_id", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "word"))
    ends = terms.limit(0).union(docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(None).cast("long").alias("term")))
    postings = tokens.withColumn("word", folded(F.col("word"))).join(small(terms.union(ends)), "word")
    return written(postings.select("row", "doc_id", "pos", "term"), "postings")


def _windows(items: Items, index: DataFrame) -> DataFrame:
    """Windows that can occur at all: (item, s, size, rare), rare = places of the two rarest terms by count of postings.

    A row for each place of an item looks at the places of its window only, so long items are no matter.
    """
    counts = index.where("term is not null").groupBy("term").agg(F.count("*").alias("postings"))
    places = items.places.join(counts, "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    onward = W.partitionBy("item").orderBy("q").rowsBetween(0, WINDOW - 1)
    ranked = F.array_sort(F.collect_list(F.struct("postings", "q")).over(onward))
    size = F.least(F.lit(WINDOW), F.col("n"))
    cut = places.select("item", F.col("q").alias("s"), size.alias("size"), "n", ranked.alias("ranked")).where("s + size <= n")
    return cut.where(F.col("ranked")[0]["postings"] > 0).select("item", "s", "size", F.slice(F.transform("ranked", lambda x: x["q"]), 1, 2).alias("rare"))


def phrase_matches(index: DataFrame, items: Items) -> DataFrame:
    """Stretches of a document whose every window of ``WINDOW`` words is one of an item: (row, item, item_id, start, end).

    Items of fewer words are one window. ``end`` is exclusive; positions count words.
    """
    windows = written(_windows(items, index), "windows")
    rare = written(windows.select("item", "s", F.size("rare").alias("n_rare"), F.explode("rare").alias("q")), "rare")
    # Of the places that pick diagonals, how many of a window have to lie on one: two, or one if a window is one word.
    anchors = written(rare.groupBy("item", "q").agg(F.min("n_rare").alias("least")).join(items.places.select("item", "q", "term"), ["item", "q"]), "anchors")
    met = index.where("term is not null").join(small(anchors), "term").select("row", "item", (F.col("pos") - F.col("q")).alias("diagonal"), "q", "least")
    line = ["row", "item", "diagonal"]
    on_line = met.withColumn("seen", F.count(F.lit(1)).over(W.partitionBy(*line))).where("seen >= least").select(*line, "q")
    # A place is one of the two rarest of at most ``WINDOW`` windows.
    open_ = written(on_line.join(rare, ["item", "q"]).groupBy(*line, "s", "n_rare").agg(F.count(F.lit(1)).alias("found")).where("found = n_rare").select(*line, "s"), "open")

    sizes = windows.select("item", "s", "size")
    places = open_.join(sizes, ["item", "s"]).select(*line, F.explode(F.sequence(F.col("s"), F.col("s") + F.col("size") - 1)).alias("q")).distinct()
    expected = places.join(items.places.select("item", "item_id", "n", "q", "term"), ["item", "q"])
    rows = written(open_.select("row").distinct(), "rows")
    near = index.where("term is not null").join(small(rows), "row", "left_semi").select("row", "pos", "term")
    there = expected.withColumn("pos", F.col("diagonal") + F.col("q")).join(near, ["row", "pos", "term"])
    # Places in a row have the same difference to their rank.
    kind = [*line, "item_id", "n"]
    ranked = there.withColumn("run", F.col("q") - F.row_number().over(W.partitionBy(*line).orderBy("q")))
    runs = ranked.groupBy(*kind, "run").agg(F.min("q").alias("a"), F.max("q").alias("b"))
    long_enough = runs.where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(WINDOW), F.col("n")))
    return long_enough.select("row", "item", "item_id", (F.col("diagonal") + F.col("a")).alias("start"), (F.col("diagonal") + F.col("b") + 1).alias("end"))


def proximity_matches(index: DataFrame, items: Items, slop: int) -> DataFrame:
    """Windows whose rarest term occurs and whose other terms all lie at most ``slop`` words from where the phrase would have them.

    Rows (row, item, item_id, s, start): the window from place ``s`` of the item, and where its phrase would start.
    """
    windows = _windows(items, index).select("item", "s", "size", F.col("rare")[0].alias("q"))
    anchored = windows.join(items.places.select("item", "item_id", "q", "term"), ["item", "q"])
    starts = index.where("term is not null").select("row", "pos", "term").join(anchored, "term").select(
        "row", "item", "item_id", "s", "size", (F.col("pos") - F.col("q") + F.col("s")).alias("start"),
    )
    others = items.places.select("item", "q", "term")
    wide = 2 * slop + 1
    expected = starts.join(others, "item").where(F.col("q").between(F.col("s"), F.col("s") + F.col("size") - 1)).withColumn("at", F.col("start") + F.col("q") - F.col("s"))
    cells = expected.withColumn("cell", F.explode(F.array_distinct(F.array(F.floor((F.col("at") - slop) / wide), F.floor((F.col("at") + slop) / wide)))))
    near = index.where("term is not null").select("row", "term", "pos", F.floor(F.col("pos") / wide).alias("cell"))
    hits = cells.join(near, ["row", "term", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
    key = ["row", "item", "item_id", "s", "start", "size"]
    return hits.groupBy(*key).agg(F.count_distinct("q").alias("found")).where(F.col("found") == F.col("size")).drop("found", "size")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words. Null ids and repeated rows are kept and judged row
    by row; items with a null id count as hits, but are not among the items named.
    Neither an empty table of documents nor one of items is an error. Other columns are ignored.
    """
    tests = test_items(items)
    index = positional_index(docs, tests.terms, id_col, text_col)
    found = phrase_matches(index, tests)
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    by_row = found.groupBy("row").agg(spans.alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    # Words under at least one span; spans come sorted by start.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["to"], x["end"]).alias("to"),
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["to"], x["start"]))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    hits = by_row.select("row", covered.alias("n_hit"), F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    every = index.where("term is null").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return every.join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def op4_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Every window of an item as text, looked for in every window of a document.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, k, i, item_id FROM dw JOIN bw USING (k, g)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
