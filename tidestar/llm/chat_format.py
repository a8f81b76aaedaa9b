"""Chat formatting of reply trees.

Messages point at the message they answer. Iterative self-joins find the root,
the depth and the summed score of every message: each round doubles the distance
that a message looks up its tree, so a thread of a thousand turns takes ten.
Leaves are ranked by the mean score of their branch; the messages of the chosen
branches are enumerated by the same jumps and each branch becomes one
conversation. Everything is DataFrame work.

A turn is ``<s>[role]text</s>``. Within roles and texts the characters of these
control strings are escaped with a backslash, so no text can hold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidestar.llm.shared import col, let, running_sums, table, written

OPEN, BETWEEN, CLOSE = "<s>[", "]", "</s>"
# The backslash first, so that undoing in turn from the last is right.
ESCAPES = {"\\": "\\0", "<": "\\1", "[": "\\2", "]": "\\3"}
TRAINED_ROLE = "assistant"
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def chosen_branches(messages: DataFrame, most: int = 1) -> DataFrame:
    """Of each tree its ``most`` best branches: rows (tree, branch, leaf, depth, node), depth from 0 at the root.

    ``messages``: (tree, node, parent, score), written or cheap; node is unique
    within its tree. A message whose parent is null or not there is a root;
    messages on a circle reach no root and belong to no branch. A branch's score
    is the mean of its messages', null as 0; equal ones rank by leaf. Several
    roots of one tree compete with each other.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    linked = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score")
    # up: the message 2 ** k steps above; steps and total: how many messages it takes to get there, and their scores.
    first = written(linked.select("tree", "node", "up", F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")), "tree")
    rooted, open_ = first.where("up is null"), first.where("up is not null")
    jumps, size = [open_], first.count()
    # Messages that have reached their root jump no more, so a long conversation costs no other one a round.
    while not open_.isEmpty() and 1 << len(jumps) <= 2 * size:
        above = rooted.union(open_).select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("higher"))
        after = written(
            open_.join(above, ["tree", "up"], "left").select(
                "tree", "node", F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                (F.col("total") + F.coalesce("higher", F.lit(0.0))).alias("total"),
            ),
            "tree",
        )
        rooted, open_ = rooted.union(after.where("up is null")), after.where("up is not null")
        jumps.append(open_)
    leaves = rooted.join(linked.select("tree", F.col("up").alias("node")).distinct(), ["tree", "node"], "left_anti")
    order = W.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), "node")
    best = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= most)
    members = written(best.select("tree", "branch", F.col("node").alias("leaf"), (F.col("steps") - 1).alias("depth"), "node"), "branch")
    for k in range(len(jumps) - 1, -1, -1):
        higher = members.join(jumps[k], ["tree", "node"]).select("tree", "branch", "leaf", (F.col("depth") - (1 << k)).alias("depth"), F.col("up").alias("node"))
        members = written(members.union(higher), "branch")
    return members


def format_branches(members: DataFrame, texts: DataFrame) -> DataFrame:
    """One text for each branch: (tree, branch, formatted). ``texts``: (tree, node, role, text); nulls count as empty."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.concat(F.lit(OPEN), escape(blank("role")), F.lit(BETWEEN), escape(blank("text")), F.lit(CLOSE))
    rows = members.join(texts, ["tree", "node"]).select("tree", "branch", F.struct("depth", turn.alias("turn")).alias("at"))
    whole = rows.groupBy("tree", "branch").agg(F.array_sort(F.collect_list("at")).alias("turns"))
    return whole.select("tree", "branch", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), nothing but the template read."""
    pieces = F.filter(F.split(formatted, r"<s>\["), lambda p: p != "")
    read = lambda p: F.struct(
        unescape(F.substring_index(p, BETWEEN, 1)).alias("role"), unescape(F.regexp_extract(p, r"(?s)^[^\]]*\](.*)</s>$", 1)).alias("text"),
    )
    return F.transform(pieces, read)


def loss_spans(formatted: Column) -> Column:
    """The loss mask: an array of (start, end) in characters of the formatted text, end exclusive, one for each trained text."""
    mark = f"{OPEN}{TRAINED_ROLE}{BETWEEN}"

    def spans(pieces: Column, ends: Column) -> Column:
        every = F.transform(pieces, lambda p, i: F.when(
            F.startswith(p, F.lit(mark)),
            F.struct((F.get(ends, i) - F.length(p) + len(mark)).alias("start"), (F.get(ends, i) - len(CLOSE)).alias("end")),
        ))
        return F.filter(every, lambda x: x.isNotNull())

    return let(F.split(formatted, r"(?=<s>\[)"), lambda pieces: let(running_sums(F.transform(pieces, F.length)), lambda ends: spans(pieces, ends)))


def conversations_formatted(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations whose turns answer each other in order, formatted: (conv_id, formatted).

    Null ids are one conversation; null turns come first; null roles and texts
    are empty; repeated turns follow each other, rows equal in all but the text
    by their text. An empty table gives none. Other columns are ignored.
    """
    named = rows.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), col(role_col).cast("string").alias("role"), col(text_col).cast("string").alias("text"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    # A join key without nulls.
    keyed = named.withColumn("node", F.row_number().over(order).cast("long")).withColumn("tree", F.struct(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"), F.col("conv_id").isNull().alias("none")))
    turns = written(keyed, "turns")
    tree = turns.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"))
    done = format_branches(chosen_branches(tree), turns.select("tree", "node", "role", "text"))
    ids = turns.where("node = 1").select("tree", "conv_id")
    return done.join(ids, "tree").select("conv_id", "formatted")


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    made = conversations_formatted(rows.union(probe))
    turns = F.array_join(F.transform(parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform(loss_spans(F.col("formatted")), lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    read = made.select("conv_id", "formatted", F.size(parsed(F.col("formatted"))).cast("long").alias("n_turns"), turns.alias("turns"), masked.alias("loss"))
    return read.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
t AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{TRAINED_ROLE}'), '') AS loss,
    sum(length('{OPEN}{BETWEEN}{CLOSE}') + length(role || text)
      + length(regexp_replace(role || text, '[^<\\[\\]\\\\]', '', 'g'))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars FROM t
"""
