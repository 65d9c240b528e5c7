"""Chat formatting of reply trees.

Messages form trees: a message may have a parent in its conversation. Iterative
self-joins double the reach of every message's pointer to its ancestors (1, 2,
4, ... steps), adding up scores and depths, until all reach their root: as many
joins as the logarithm of the longest path, each of the messages still on their way. Leaves are ranked within their
conversation by the score of their branch (ties: deeper, then larger node id),
and the paths of the chosen leaves are enumerated back through the same
pointers. Each path is formatted as one conversation.

Format of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles a
backslash is doubled and ``<|`` becomes ``<\\|`` (in roles a line feed becomes
``<\\n``), so control strings inside them are not marks, and ``unescape`` gives
the original back. The loss mask lists, in code points of the formatted text,
the (escaped) texts of the loss role.

A formatted conversation is one value and its turns meet in one row; nothing
else is gathered per conversation. Defined results: null texts and roles are
empty; messages without a parent, or whose parent does not exist, are roots;
repeated messages (same conversation and node) count once, the first in order
of their other columns; conversations without messages don't appear; cycles
(no root) are left out, as no leaf or root leads into them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.frames import col, stored

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def chains(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Linear conversations as message trees: each turn replies to the one before it (rows by turn, role, text)."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = conversations.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), col(role_col).cast("string").alias("role"),
                                col(text_col).cast("string").alias("text"))
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select(
        "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """(conv, leaf, rank, node, depth): the messages on the ``top`` best root-to-leaf paths of each conversation."""
    nodes = stored(messages.select("conv", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")))
    known = nodes.select(F.col("conv").alias("c"), F.col("node").alias("up"))
    # a parent that does not exist makes a root; null conversations are one conversation
    reach = stored(nodes.join(known, F.expr("conv <=> c and parent = up"), "left").select(
        "conv", "node", "up", "score", F.lit(1).cast("long").alias("depth")))
    steps: list[DataFrame] = []  # pointers that reach 1, 2, 4, ... messages up
    arrived = reach.filter("up is null")
    while not (step := reach.filter("up is not null")).isEmpty() and len(steps) <= 40:  # longer than any table: cycles
        steps.append(step)
        # only messages that have not met their root go on, so short conversations cost no further rounds
        a, b = step.alias("a"), step.union(arrived).alias("b")
        reach = stored(a.join(b, F.expr("a.conv <=> b.conv and a.up = b.node"), "left").select(
            "a.conv", "a.node", F.col("b.up").alias("up"), (F.col("a.score") + F.coalesce("b.score", F.lit(0.0))).alias("score"),
            (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth")))
        arrived = arrived.union(reach.filter("up is null"))
    replied = nodes.filter("parent is not null").select(F.col("conv").alias("c"), F.col("parent").alias("n")).distinct()
    leaves = (arrived.join(replied, F.expr("conv <=> c and node = n"), "left_anti")
              .select("conv", "node", "score", "depth"))
    best = Window.partitionBy("conv").orderBy(F.desc("score"), F.desc("depth"), F.desc("node"))
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    path = stored(chosen.select("conv", F.col("node").alias("leaf"), "rank", "node"))
    for step in reversed(steps):  # every distance is a sum of powers of two
        s = step.select(F.col("conv").alias("c"), F.col("node").alias("n"), "up")
        up = path.join(s, F.expr("conv <=> c and node = n")).select("conv", "leaf", "rank", F.col("up").alias("node"))
        path = stored(path.union(up))
    depth = arrived.select(F.col("conv").alias("c"), F.col("node").alias("n"), "depth")
    return path.join(depth, F.expr("conv <=> c and node = n")).select("conv", "leaf", "rank", "node", "depth")


def formatted(messages: DataFrame, top: int = 1, loss_role: str = "assistant") -> DataFrame:
    """One row per chosen path: conv, leaf, rank, formatted, loss (array of structs start, length; code points from 0)."""
    order = Window.partitionBy("conv", "node").orderBy("parent", "role", "text", "score")
    once = stored(messages.withColumn("again", F.row_number().over(order)).filter("again = 1").drop("again"))
    text = escape(F.coalesce("text", F.lit("")))
    turns = once.select(
        F.col("conv").alias("c"), F.col("node").alias("n"),
        F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n")).alias("head"), text.alias("body"),
        F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("learned"))
    rows = branches(once, top).join(turns, F.expr("conv <=> c and node = n"))
    ordered = F.array_sort(F.collect_list(F.struct("depth", "head", "body", "learned")))
    paths = rows.groupBy("conv", "leaf", "rank").agg(ordered.alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END)
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    masked = F.aggregate("turns", none, lambda a, t: F.struct(
        (a["at"] + size(t)).alias("at"),
        F.when(t["learned"], F.concat(a["loss"], F.array(F.struct(
            (a["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))))).otherwise(a["loss"]).alias("loss")),
        lambda a: a["loss"])
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    return paths.select("conv", "leaf", "rank", whole.alias("formatted"), masked.alias("loss"))


def turns_of(text: Column) -> Column:
    """Array of structs role, text read back from a formatted conversation."""
    pieces = F.filter(F.split(text, "<\\|im_end\\|>\n"), lambda p: p != "")
    return F.transform(pieces, _turn)


def _turn(piece: Column) -> Column:
    rest = F.substr(piece, F.lit(len(START) + 1))
    role = F.substring_index(rest, "\n", 1)
    return F.struct(unescape_role(role).alias("role"), unescape(F.substr(rest, F.length(role) + 2)).alias("text"))


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(loss, lambda s: unescape(F.substr(text, s["start"] + 1, s["length"]))))


def report(messages: DataFrame) -> DataFrame:
    """Digest per conversation, read back from the best path's formatted text."""
    made = formatted(messages, top=1).select("conv", "formatted", "loss")
    turns = turns_of(F.col("formatted"))
    read = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    learned = loss_text(F.col("formatted"), F.col("loss"))
    return made.select(
        F.col("conv").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"),
        F.sha2(read.cast("binary"), 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
