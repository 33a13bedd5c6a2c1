"""Reply trees as conversations: root-to-leaf paths, ranked branches, a reversible template. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join
from threadloom.session import cut

# Every control string begins with MARK, which no escaped text contains.
MARK = "<|"
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"


@dataclass(frozen=True)
class Levels:
    """``messages`` with a number ``_id`` a row, and for each power of two the ancestor that many steps up."""

    messages: DataFrame
    jumps: list[DataFrame]
    endless: DataFrame


def escape(text: Column) -> Column:
    r"""Null becomes empty; every ``\`` is doubled and ``<|`` becomes ``<\|``, so no control string is left."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit(MARK), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _levels(messages: DataFrame) -> Levels:
    """Replies joined with the messages they answer, then with themselves: each round doubles the reach of the jumps."""
    own = messages.select("tree", "node", "parent", "role", "text", "score")
    numbered = cut(own.withColumn("_id", F.monotonically_increasing_id()))
    pick = F.min_by("_id", F.struct("role", "text", "_id"))
    named = numbered.filter(F.col("node").isNotNull()).groupBy(F.col("tree").alias("_t"), F.col("node").alias("_n")).agg(pick.alias("up"))
    named = named.withColumn("_nh", F.xxhash64("_t", "_n"))
    replies = numbered.filter(F.col("parent").isNotNull()).select(F.col("_id").alias("node"), "tree", "parent", F.xxhash64("tree", "parent").alias("_ph"))
    same = F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_n")) & (F.col("_ph") == F.col("_nh"))
    jump = cut(replies.join(named, same).select("node", "up"))
    rows, jumps = numbered.count(), []
    while not jump.isEmpty() and 1 << len(jumps) <= 2 * rows:
        jumps.append(jump)
        again = jump.select(F.col("node").alias("up"), F.col("up").alias("_next"))
        jump = cut(skew_join(jump, again, "up").select("node", F.col("_next").alias("up")))
    return Levels(numbered, jumps, jump)


def reply_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(path, place, tree, node, role, text, path_score, rank): the messages of every root-to-leaf path, root at place 0.

    ``messages(tree, node, parent, role, text, score)`` are joined with themselves: jumps of 1, 2, 4, ... steps up are made
    once per message, and each leaf then gathers its path by halves, in as many joins as the longest path's length has
    binary digits. A path's score is the sum of its scores (null counts as 0). ``branches`` keeps that many paths of each
    tree, best score first, then by the leaf's node and number, and gives their rank; None keeps all, with a null rank.

    A message without a parent, or whose parent is not there, is a root. Of rows that share a node in a tree each stays a
    message of its own; replies hang on the one with the smallest role and text. Messages in or below a circle of replies
    have no root and no path. Rows without a node are roots that nothing can answer. Extra columns are not read. No rows
    give no rows.
    """
    levels = _levels(messages)
    every = levels.messages.select(F.col("_id").alias("node"))
    parents = levels.jumps[0].select(F.col("up").alias("node")).distinct() if levels.jumps else every.limit(0)
    leaves = every.join(parents, "node", "left_anti").join(levels.endless.select("node"), "node", "left_anti")
    paths = leaves.select(F.col("node").alias("path"), "node", F.lit(0).alias("up_steps"))
    for k in reversed(range(len(levels.jumps))):
        steps = levels.jumps[k].select("node", F.col("up").alias("_to"), F.lit(1 << k).alias("_by"))
        stay = every.select("node", F.col("node").alias("_to"), F.lit(0).alias("_by"))
        paths = skew_join(paths, steps.unionByName(stay), "node").select(
            "path", F.col("_to").alias("node"), (F.col("up_steps") + F.col("_by")).alias("up_steps")
        )
    said = levels.messages.withColumnsRenamed({"node": "name", "_id": "node"}).drop("parent")
    paths = skew_join(paths, said, "node").drop("node").withColumnRenamed("name", "node")
    totals = paths.groupBy("path").agg(
        F.sum(F.coalesce("score", F.lit(0))).alias("path_score"), F.max("up_steps").alias("_last"),
        F.min_by("tree", "up_steps").alias("_tree"), F.min_by("node", "up_steps").alias("_leaf"),
    )
    if branches is None:
        totals = totals.withColumn("rank", F.lit(None).cast("int"))
    else:
        best = Window.partitionBy("_tree").orderBy(F.col("path_score").desc(), F.col("_leaf").asc_nulls_last(), "path")
        totals = totals.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    return skew_join(paths, totals, "path").select(
        "path", (F.col("_last") - F.col("up_steps")).alias("place"), "tree", "node", "role", "text", "path_score", "rank"
    )


def format_paths(paths: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(path, tree, path_score, rank, formatted, loss_spans): each path as one text.

    A turn is ``<|turn|>role<|says|>text<|end|>`` and a newline, with role and text escaped. ``loss_spans`` are (begin,
    end) in code points of the escaped texts of roles in ``learn``, in order. A null role or text is empty. A path is one
    row, so it has to fit one, as its text must.
    """
    in_path = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        paths.withColumn("_head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)))
        .withColumn("_body", escape(F.col("text")))
        .withColumn("_turn", F.concat("_head", "_body", F.lit(END)))
        .withColumn("_begin", F.coalesce(F.sum(F.length("_turn")).over(in_path), F.lit(0)) + F.length("_head"))
    )
    turn = F.struct("place", "_turn", "_begin", F.length("_body").alias("_chars"), F.coalesce(F.col("role").isin(*learn), F.lit(False)).alias("_learn"))
    whole = turns.groupBy("path").agg(
        F.array_sort(F.collect_list(turn)).alias("_turns"), F.first("tree").alias("tree"),
        F.first("path_score").alias("path_score"), F.first("rank").alias("rank"),
    )
    spans = F.transform(
        F.filter("_turns", lambda t: t["_learn"]),
        lambda t: F.struct(t["_begin"].alias("begin"), (t["_begin"] + t["_chars"]).alias("end")),
    )
    return whole.select(
        "path", "tree", "path_score", "rank", F.concat_ws("", F.col("_turns._turn")).alias("formatted"), spans.alias("loss_spans")
    )


def read_turns(formatted: Column) -> Column:
    """array of struct(role, text): the turns of a formatted text, as they were before escaping (null as empty)."""
    blocks = F.filter(F.split(formatted, "<\\|turn\\|>", -1), lambda b: b != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.substring_index(b, SAYS, 1)).alias("role"),
            unescape(F.regexp_replace(F.substring_index(b, SAYS, -1), r"<\|end\|>\n$", "")).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    parts = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
    return F.concat_ws("", parts)
