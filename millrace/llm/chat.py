"""Conversations from reply trees.

Messages point to the one they answer. Self-joins that double their reach find for every message its
distance from the root and the scores on the way; a chain of n messages takes log2(n) of them. The leaves
of a conversation are its branches; the best are chosen, the same doubled links enumerate each chosen
path, and a path becomes one text in which turns are marked and control strings of the messages escaped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import stored

TURN, END = "<|turn|>", "<|end|>\n"
#: What a text may not hold unescaped: marks of this template and of others.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
#: Roles whose texts are learned from.
LEARNED = ("assistant",)

_ANGLE = "<(?=" + "|".join(re.escape(x[1:]) for x in CONTROL if x[0] == "<") + ")"
_SQUARE = r"\[(?=" + "|".join(re.escape(x[1:]) for x in CONTROL if x[0] == "[") + ")"


def escaped(text: Column) -> Column:
    """A text without control strings: the first character of each becomes a backslash and a letter."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, _ANGLE, r"\\l"), _SQUARE, r"\\b")


def escaped_role(role: Column) -> Column:
    """A role in one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` and ``escaped_role`` were given."""

    def plain(part: Column) -> Column:
        for code, character in (("\\l", "<"), ("\\b", "["), ("\\n", "\n")):
            part = F.replace(part, F.lit(code), F.lit(character))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def _messages(messages: DataFrame) -> DataFrame:
    """Messages with a key for null-safe joins; a parent that doesn't exist makes a root."""
    key = F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    rows = messages.withColumn("_conv", key)
    ids = rows.select(F.col("_conv").alias("_c"), F.col("msg_id").alias("_m"))
    known = (F.col("_conv") == F.col("_c")) & (F.col("parent_id") == F.col("_m"))
    return rows.join(ids, known, "left").withColumn("_parent", F.col("_m")).drop("_c", "_m")


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Messages on the ``branches`` best paths of each conversation: conv_id, branch, depth, role, text.

    ``messages`` has conv_id, msg_id, parent_id, role, text and score; ids are unique in a conversation. A
    path is worth its mean score, a null score is 0, and equal paths go by their leaf's id. A message whose
    parent is missing is a root, and every leaf below any root is a branch. Messages that answer each other
    in a circle, or hang on one, have no root, so they are on no path. A null conv_id is a conversation.
    """
    rows = stored(_messages(messages), "messages")
    state = rows.select(
        "_conv",
        F.col("msg_id").alias("node"),
        F.col("_parent").alias("jump"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("worth"),
        F.lit(1).cast("long").alias("hops"),
    )
    levels, rooted = [], None
    limit = rows.count()
    while True:
        state = stored(state, "reach")
        ended, going = state.filter("jump IS NULL"), state.filter("jump IS NOT NULL")
        rooted = ended if rooted is None else rooted.unionByName(ended)
        if (1 << len(levels)) > limit or going.isEmpty():
            break
        levels.append(going.select(F.col("_conv").alias("_c"), F.col("node").alias("_n"), "jump"))
        upper = rooted.unionByName(going).select(
            F.col("_conv").alias("_c"), F.col("node").alias("_n"), F.col("jump").alias("_j"), F.col("worth").alias("_w"), F.col("hops").alias("_h")
        )
        on = (F.col("_conv") == F.col("_c")) & (F.col("jump") == F.col("_n"))
        state = going.join(upper, on).select(
            "_conv",
            "node",
            F.col("_j").alias("jump"),
            (F.col("worth") + F.col("_w")).alias("worth"),
            (F.col("hops") + F.col("_h")).alias("hops"),
        )
    parents = rows.select(F.col("_conv").alias("_c"), F.col("_parent").alias("_p")).filter("_p IS NOT NULL")
    leaves = rooted.join(parents, (F.col("_conv") == F.col("_c")) & (F.col("node") == F.col("_p")), "left_anti")
    order = Window.partitionBy("_conv").orderBy((F.col("worth") / F.col("hops")).desc(), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= branches)
    paths = chosen.select("_conv", "branch", "node")
    for level in reversed(levels):
        up = paths.join(level, (F.col("_conv") == F.col("_c")) & (F.col("node") == F.col("_n")))
        paths = paths.unionByName(up.select("_conv", "branch", F.col("jump").alias("node")))
        paths = stored(paths, "paths")
    depths = rooted.select(F.col("_conv").alias("_c"), F.col("node").alias("_n"), F.col("hops").alias("depth"))
    texts = rows.select("conv_id", F.col("_conv").alias("_k"), "msg_id", "role", "text")
    found = paths.join(depths, (F.col("_conv") == F.col("_c")) & (F.col("node") == F.col("_n")))
    found = found.join(texts, (F.col("_conv") == F.col("_k")) & (F.col("node") == F.col("msg_id")))
    return found.select("conv_id", "branch", "depth", "role", "text")


def formatted(paths: DataFrame, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per path: conv_id, branch, formatted, and loss_spans, the (start, end) of what is learned.

    A null role or text counts as empty. Offsets count code points of the formatted text.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    head = F.concat(F.lit(TURN), escaped_role(role), F.lit("\n"))
    rows = paths.select("conv_id", "branch", "depth", role.isin(*learned).alias("_learned"), head.alias("_head"), escaped(text).alias("_body"))
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit(END)))
    before = Window.partitionBy("conv_id", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)) + F.length("_head")
    rows = rows.withColumn("_start", start.cast("long")).withColumn("_end", F.col("_start") + F.length("_body"))
    turn = F.struct("depth", F.col("_piece").alias("piece"), "_learned", F.struct(F.col("_start").alias("start"), F.col("_end").alias("end")).alias("span"))
    turns = rows.groupBy("conv_id", "branch").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    return turns.select(
        "conv_id",
        "branch",
        F.array_join(F.transform("_turns", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("_turns", lambda x: x["_learned"]), lambda x: x["span"]).alias("loss_spans"),
    )


def parsed(texts: DataFrame) -> DataFrame:
    """Adds ``turns``, the (role, text) of each turn, and ``loss_text`` to formatted conversations."""
    pieces = F.slice(F.split("formatted", re.escape(TURN), -1), 2, F.greatest(F.size(F.split("formatted", re.escape(TURN), -1)) - 1, F.lit(0)))
    bodies = F.transform(pieces, lambda x: F.substr(x, F.lit(1), F.length(x) - len(END)))

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(x, F.length(role) + 2)).alias("text"))

    loss = F.transform("loss_spans", lambda x: unescaped(F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))))
    return texts.withColumns({"turns": F.transform(bodies, turn), "loss_text": F.array_join(loss, "")})


def as_replies(conversations: DataFrame) -> DataFrame:
    """Plain conversations, rows by turn, as reply trees: each row answers the one before it.

    Rows with the same turn are ordered by role and text; null turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("msg_id"))
    parent = F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
    return rows.withColumns({"parent_id": parent, "score": F.lit(0.0)})
