"""Reply trees as chat transcripts, with DataFrame functions only.

Messages point to the message they answer. Self-joins that double their reach enumerate the
root-to-leaf paths: after k rounds every message knows its ancestor 2**k steps up, so a path of n
messages takes log2(n) rounds. Branches are ranked by the sum of their messages' scores, and each
chosen path becomes one transcript with a loss mask over the assistant's texts.

    <|im_start|>role
    text<|im_end|>

A backslash in a role or text is doubled, and one is put into every control string, so that no
control string is left; taking one backslash away from each group reads the text back. A null
text or role is empty. A message whose parent is null or missing is a root; messages on a cycle
have no root and are left out. Repeated message ids keep the smallest parent. Turns of a
conversation with equal numbers are ordered by role and text, nulls first, and all of them stay.
Empty tables give empty results; other columns do not matter. A transcript is one string, so a
path must fit in one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import running_sums
from tidemark.session import materialise

START, END = "<|im_start|>", "<|im_end|>"
#: The control strings of common templates begin with these.
_CONTROL = r"(<(?=\||/?s>|<?/?SYS>)|\[(?=/?INST\]))"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _nodes(messages: DataFrame) -> DataFrame:
    """`tree`, `node`, `score` and `up`: the parent, if it exists."""
    single = messages.groupBy("tree", "node").agg(
        F.min(F.struct("parent", "score")).alias("m")).select(
        "tree", "node", F.col("m.parent").alias("parent"),
        F.coalesce("m.score", F.lit(0.0)).alias("score"))
    single = materialise(single, "messages")
    known = single.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    return single.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("up")),
                       "left").select("tree", "node", "score", "up")


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The messages of the best `branches` root-to-leaf paths of each tree.

    `messages` has tree, node, parent and score. Returns tree, leaf, node, `depth` (from 1 at
    the root) and `branch` (1 for the best; ties by depth, then by the leaf's id).
    """
    climbs = materialise(_nodes(messages).select(
        "tree", "node", "up", F.lit(1).cast("bigint").alias("steps"),
        F.col("score").cast("double").alias("total")), "climbs")
    first = climbs
    longest = climbs.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    for _ in range(math.ceil(math.log2(longest)) + 1 if longest > 1 else 0):
        if climbs.filter("up IS NOT NULL").isEmpty():
            break
        jumps.append(climbs.filter("up IS NOT NULL").select(
            "tree", "node", "up"))
        above = climbs.select(F.col("tree").alias("t"), F.col("node").alias("n"),
                              F.col("up").alias("next"), F.col("steps").alias("more"),
                              F.col("total").alias("rest"))
        # Only messages that are not at their root yet climb on.
        moved = climbs.filter("up IS NOT NULL").join(
            above, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("n"))).select(
            "tree", "node", F.col("next").alias("up"),
            (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("total") + F.col("rest")).alias("total"))
        climbs = materialise(climbs.filter("up IS NULL").unionByName(moved), "climbs")
    rooted = climbs.filter("up IS NULL")
    parents = first.filter("up IS NOT NULL").select("tree", F.col("up").alias("node"))
    leaves = rooted.join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "node")
    paths = leaves.withColumn("branch", F.row_number().over(best)).filter(
        F.col("branch") <= branches).select("tree", F.col("node").alias("leaf"), "node", "branch")
    for jump in jumps:
        up = jump.select("tree", "node", F.col("up").alias("above"))
        climbed = paths.join(up, ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), "branch")
        paths = materialise(paths.unionByName(climbed), "paths")
    return paths.join(rooted.select("tree", "node", F.col("steps").alias("depth")),
                      ["tree", "node"])


def _heading(role: Column) -> Column:
    return F.concat(F.lit(START), F.regexp_replace(escaped(role), "\n", "\\\\\n"), F.lit("\n"))


_TAIL = END + "\n"


def format_paths(path_messages: DataFrame) -> DataFrame:
    """One row per path: `formatted`, and `loss`, the stretches (start, length) that count.

    `path_messages` has tree, leaf, depth, role and text. Starts count code points from 0.
    """
    turn = F.struct("depth", _heading(F.col("role")).alias("head"),
                    escaped(F.col("text")).alias("body"),
                    F.coalesce(F.col("role") == ASSISTANT, F.lit(False)).alias("learned"))
    gathered = path_messages.select("tree", "leaf", turn.alias("turn")).groupBy(
        "tree", "leaf").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    sized = gathered.select(
        "tree", "leaf", "turns", F.transform("turns", lambda t: (
            F.length(t["head"]) + F.length(t["body"]) + len(_TAIL)).cast("bigint")).alias("sizes"))
    placed = sized.select(
        "tree", "leaf", "turns", running_sums("sizes").alias("begins"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(
        t["head"], t["body"], F.lit(_TAIL))), "")
    stretches = F.transform(
        F.filter(F.arrays_zip("turns", "begins"), lambda z: z["turns"]["learned"]),
        lambda z: F.struct(
            (z["begins"] + F.length(z["turns"]["head"])).alias("start"),
            F.length(z["turns"]["body"]).cast("bigint").alias("length")))
    return placed.select("tree", "leaf", joined.alias("formatted"), stretches.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) and learned texts, parsed from `formatted` and `loss` alone."""
    blocks = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda b: b != "")
    block = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)<\|im_end\|>\n$"
    turns = F.transform(blocks, lambda b: F.struct(
        unescaped(F.regexp_extract(b, block, 1)).alias("role"),
        unescaped(F.regexp_extract(b, block, 2)).alias("text")))
    learned = F.transform("loss", lambda s: unescaped(
        F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return formatted.select("*", turns.alias("turns"), learned.alias("learned"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees: every turn answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("bigint")
    numbered = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).withColumn("node", node)
    return numbered.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text")


def chat_transcripts(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `formatted` and `loss` of each conversation's best branch."""
    messages = materialise(conversation_messages(conversations), "turns")
    paths = reply_paths(messages)
    texts = paths.select("tree", "leaf", "node", "depth").join(
        messages.select("conv_id", "tree", "node", "role", "text"), ["tree", "node"])
    formatted = format_paths(texts)
    return formatted.select(
        F.when(F.col("tree") != "", F.col("tree").cast("bigint")).alias("conv_id"),
        "formatted", "loss")


def transcript_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the transcripts, as counts and digests."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
