"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. How often a document is expected in the mix
grows with the square root of its size, up to ``MOST`` times, by a factor of its source
that makes the expected words meet the target. The whole part of that number is certain. The
fraction is its probability of inclusion p: documents are ranked by their random
odds divided by their odds of inclusion, (u / (1 - u)) / (p / (1 - p)), and the
first ones are taken until the source's target is reached. The place where a
source is cut is found by histograms of the ranking variable, each within one
bin of the one before, so no source is ever sorted as a whole. Rows that are
equal there share the variable; where the cut falls among them, they are numbered
by their places in a written table, and as many are taken as the target asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidestar.llm.shared import col, free_name, small, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
POWER = 0.5  # of the size, in a document's weight; 0 gives all documents of a source the same odds
UNITS = 256  # weights are whole numbers of so many parts, so that sums are exact and reruns agree
WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096
LEVELS = 3  # 2 ** 36 bins: of sixty billion documents of a source, one bin holds one


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number between 0 and 1 that depends on the row alone: 48 bits of MD5."""
    parts = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(parts), 1, 12), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def _name(source: Column) -> Column:
    """The source as a join key without nulls."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def _numbered(frame: DataFrame, order: Column, name: str) -> DataFrame:
    """The frame with a number from 0 in the order given, found from the places of its rows in sorted files."""
    files = written(frame.repartitionByRange(order).sortWithinPartitions(order), "numbered")
    placed = files.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row for each part of the order; files are named in its order.
    parts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    offsets = parts.select("_file", (F.sum("_n").over(W.orderBy("_file")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(offsets), "_file").withColumn(name, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size); a row for each source.

    Sources in order of code points, null last, take the weights in turn. They
    share ``share`` times all words; none gets more than ``most`` times its own,
    and what it can't take is shared by the others: all others get the same for
    each unit of weight, which is found by leaving out full sources until none is new.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.col("turn") % len(weights)
    weighed = _numbered(sums, F.col("source").asc_nulls_last(), "turn").withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    limited = written(weighed.withColumn("most", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight")).drop("turn"), "limits")
    total = share * (limited.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        below = F.col("ratio") < F.lit(level)
        n, taken, units = limited.agg(F.count_if(below), F.sum(F.when(below, F.col("most"))), F.sum(F.when(~below, F.col("weight")))).first()
        if n == full or not units:
            break
        level, full = (total - (taken or 0.0)) / units, n
    return limited.select("source", "source_size", F.least("most", F.lit(level) * F.col("weight")).alias("target"))


def _weight(size: Column, power: float) -> Column:
    return F.when(size > 0, F.greatest(F.lit(1), F.floor(F.lit(float(UNITS)) * F.pow(size, F.lit(power))))).otherwise(0).cast("long")


def _factors(rows: DataFrame, plan: DataFrame, power: float, most: float) -> DataFrame:
    """For each source: (name, factor, full). A document of weight w is expected factor * w times, ``most`` times from the weight ``full`` on."""
    kinds = rows.where("size > 0").groupBy("name", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("w", _weight(F.col("size"), power))
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    by_weight = kinds.groupBy("name", "w").agg(exact(F.col("n") * F.col("size")).alias("words"), exact(F.col("n").cast("decimal(19,0)") * F.col("w") * F.col("size")).alias("mass"))
    # Distinct weights of a source: as many as there are lengths of texts.
    heavier = W.partitionBy("name").orderBy(F.col("w").desc()).rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("mass").over(W.partitionBy("name")) - F.coalesce(F.sum("mass").over(heavier), F.lit(0))
    tried = by_weight.join(small(plan.select("name", "target")), "name").select(
        "name", "w", ((F.col("target") - F.lit(float(most)) * F.coalesce(F.sum("words").over(heavier), F.lit(0)).cast("double")) / left.cast("double")).alias("factor"),
    )
    # The first weight that need not be full, going down, and the one before it.
    open_ = tried.where(F.col("factor") * F.col("w") < F.lit(float(most))).groupBy("name").agg(F.max(F.struct("w", "factor")).alias("open"))
    return open_.select("name", "open.factor", (F.col("open.w") + 1).alias("full"))


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Where each source is cut: (name, cut, taken_equal, equal); a row for each source of the plan.

    ``rows``: (name, q, size), ``plan``: (name, rest), rest = words to take. All rows below
    ``cut`` are taken, and ``taken_equal`` of the ``equal`` ones there, which comes nearest to the rest.
    """
    state = plan.select("name", "rest", F.lit(0.0).alias("from"), F.lit(0.0).alias("taken"))
    width = 1.0
    for _ in range(LEVELS):
        width /= BINS
        inside = rows.join(small(state), "name").where((F.col("q") >= F.col("from")) & (F.col("q") < F.col("from") + F.lit(width * BINS)))
        bins = inside.groupBy("name", "rest", "from", "taken", F.floor((F.col("q") - F.col("from")) / F.lit(width)).alias("bin")).agg(F.sum("size").alias("size"))
        order = W.partitionBy("name").orderBy("bin")
        summed = bins.withColumn("before", F.col("taken") + F.sum("size").over(order) - F.col("size"))
        # The bin in which the rest ends, or else the last one.
        end = summed.where(F.col("before") <= F.col("rest")).groupBy("name", "rest", "from").agg(F.max(F.struct("bin", "before")).alias("end"))
        state = written(end.select("name", "rest", (F.col("from") + F.col("end.bin") * F.lit(width)).alias("from"), F.col("end.before").alias("taken")), "cut")
    last = rows.join(small(state), "name").where((F.col("q") >= F.col("from")) & (F.col("q") < F.col("from") + F.lit(width)))
    equal = last.groupBy("name", "rest", "taken", "q").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("equal"))
    before = F.col("taken") + F.sum("size").over(W.partitionBy("name").orderBy("q")) - F.col("size")
    reached = equal.withColumn("left", F.col("rest") - before).where("left >= 0").groupBy("name").agg(F.max(F.struct("q", "left", "size", "equal")).alias("end"))
    nearest = F.floor(F.col("end.left") * F.col("end.equal") / F.col("end.size") + F.lit(0.5))
    return reached.select("name", F.col("end.q").alias("cut"), F.least(nearest, F.col("end.equal")).cast("long").alias("taken_equal"), F.col("end.equal").alias("equal"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, power: float = POWER, seed: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` and four columns: size, source_size, target, taken.

    size counts words, target is the source's, taken is what the mix takes of the
    document, repeats counted: size times its number of copies. A source's taken
    words miss its target by at most half a document, also where rows are equal. The draw depends on id,
    text and seed alone, so reruns agree; of rows equal in these, as many are taken in each run, and which
    ones makes no difference to them. Null sources are one source, the last; a null text has size 0 and is
    never taken. Clashing column names are kept: the new ones get an underscore more.
    """
    text = col(text_col).cast("string")
    names = {c: free_name(docs, c) for c in ("size", "source_size", "target", "taken")}
    rows = written(
        docs.select(col(source_col).cast("string").alias("source"), _name(col(source_col)).alias("name"), uniform(col(id_col), text, seed).alias("u"), n_words(text).alias("size")),
        "sizes",
    )
    plan = written(targets(rows, weights, share, most).withColumn("name", _name(F.col("source"))), "targets")
    plan = written(plan.join(_factors(rows, plan, power, most), "name", "left"), "factors")

    def copies(weight: Column, of: str = "") -> Column:
        """How often a document is expected; without a factor all documents of the source are full, or it has no words."""
        factor, full = F.col(f"{of}factor"), F.col(f"{of}full")
        return F.when(factor.isNull() | (weight >= full), F.lit(float(most))).otherwise(factor * weight)

    def place(expected: Column, u: Column) -> Column:
        """Rank of the random odds over the odds of inclusion, as a number between 0 and 1; null for what is certain."""
        p = expected - F.floor(expected)
        return F.when(p > 0, u * (1 - p) / (u * (1 - p) + (1 - u) * p))

    ranked = rows.where("size > 0").join(small(plan.select("name", "factor", "full")), "name").withColumn("expected", copies(_weight(F.col("size"), power)))
    ranked = written(ranked.select("name", "size", F.floor("expected").alias("whole"), place(F.col("expected"), F.col("u")).alias("q")), "ranked")
    certain = ranked.groupBy("name").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    rest = plan.join(certain, "name").select("name", (F.col("target") - F.col("certain")).alias("rest")).where("rest > 0")
    cuts = written(_cuts(ranked.where("q IS NOT NULL").select("name", "q", "size"), rest), "cuts")
    decided = written(plan.join(cuts, "name", "left").select("name", F.struct("source_size", "target", "factor", "full", "cut", "taken_equal", "equal").alias("plan")), "decided")

    name, size, q, whole, of, extra = (free_name(docs, c) for c in ("_name", "_size", "_q", "_whole", "_plan", "_extra"))
    measured = docs.select("*", _name(col(source_col)).alias(name), n_words(text).alias(size), uniform(col(id_col), text, seed).alias(q))
    joined = measured.join(small(decided.select(F.col("name").alias(name), F.col("plan").alias(of))), name)
    expected = copies(_weight(F.col(size), power), f"{of}.")
    joined = joined.select(*[col(c) for c in joined.columns if c != q], F.floor(expected).alias(whole), place(expected, F.col(q)).alias(q))
    at_cut = F.coalesce(F.col(q) == F.col(f"{of}.cut"), F.lit(False))
    split = at_cut & F.col(f"{of}.taken_equal").between(F.lit(1), F.col(f"{of}.equal") - 1)

    def told(frame: DataFrame, more: Column) -> DataFrame:
        return frame.select(
            *[col(c) for c in docs.columns],
            F.col(size).alias(names["size"]), F.col(f"{of}.source_size").alias(names["source_size"]), F.col(f"{of}.target").alias(names["target"]),
            (F.col(size) * (F.col(whole) + more)).cast("long").alias(names["taken"]),
        )

    below = F.coalesce(F.col(q) < F.col(f"{of}.cut"), F.lit(False)) | (at_cut & (F.col(f"{of}.taken_equal") == F.col(f"{of}.equal")))
    if cuts.where("taken_equal BETWEEN 1 AND equal - 1").isEmpty():
        return told(joined, F.when(below, 1).otherwise(0))
    # Equal rows where a cut falls: counted off by their places in files, within their source.
    equal = written(joined.where(split).sortWithinPartitions(name), "equal")
    file, row, before, first = (free_name(equal, c) for c in ("_file", "_row", "_before", "_first"))
    placed = equal.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    # One row for each source and file.
    parts = placed.groupBy(name, file).agg(F.min(row).alias(first), F.count(F.lit(1)).alias(extra))
    offsets = parts.select(name, file, first, (F.sum(extra).over(W.partitionBy(name).orderBy(file)) - F.col(extra)).alias(before))
    numbered = placed.join(small(written(offsets, "offsets")), [name, file])
    place_in = F.col(before) + F.col(row) - F.col(first)
    return told(joined.where(~split), F.when(below, 1).otherwise(0)).unionAll(told(numbered, F.when(place_in < F.col(f"{of}.taken_equal"), 1).otherwise(0)))


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = f"""WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ((('0x' || left(md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, '-'), md5(coalesce(text, '')))), 12))::BIGINT)::DOUBLE + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighed AS (
  SELECT *, ([{", ".join(map(str, WEIGHTS))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight, {MOST}::DOUBLE * source_size AS most
  FROM sums),
levels AS (
  SELECT *, most / weight AS ratio, ({SHARE}::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
plan AS (SELECT source, source_size, least(most, coalesce((SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio), 0) * weight) AS target FROM levels),
rows AS (SELECT *, CASE WHEN size > 0 THEN greatest(1, floor({UNITS}::DOUBLE * pow(size::DOUBLE, {POWER}::DOUBLE)))::BIGINT ELSE 0 END AS w FROM d),
kinds AS (SELECT source, w, sum(size)::HUGEINT AS words, sum(size::HUGEINT * w) AS mass FROM rows WHERE size > 0 GROUP BY source, w),
tried AS (
  SELECT k.source, w, (target - {MOST}::DOUBLE * coalesce(sum(words) OVER (PARTITION BY k.source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(mass) OVER (PARTITION BY k.source ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS factor
  FROM kinds k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source),
factors AS (SELECT source, max(w) AS open, arg_max(factor, w) AS factor FROM tried WHERE factor * w < {MOST}::DOUBLE GROUP BY source),
expected AS (
  SELECT r.*, p.source_size, p.target, CASE WHEN f.factor IS NULL OR r.w > f.open THEN {MOST}::DOUBLE ELSE f.factor * r.w END AS e
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source LEFT JOIN factors f ON r.source IS NOT DISTINCT FROM f.source),
placed AS (
  SELECT *, floor(e)::BIGINT AS whole, CASE WHEN size > 0 AND e > floor(e) THEN u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (1 - u) * (e - floor(e))) END AS q FROM expected),
ordered AS (
  SELECT *, target - sum(size * whole) OVER (PARTITION BY source) AS rest,
    coalesce(sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN q IS NOT NULL AND before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM ordered"""
