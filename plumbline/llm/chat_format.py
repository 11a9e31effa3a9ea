"""Chat formatting of reply trees.

Messages point to the message they answer. Root-to-leaf paths are enumerated
by self-joins whose reach doubles each time, branches are ranked by the sum of
their scores, and each chosen path becomes one conversation in the template

    ### role: text</turn>

with one line per turn. Control strings inside texts are escaped, so that the
output can be read back exactly: a backslash becomes ``\\b``, ``###`` becomes
``\\h``, ``</turn>`` becomes ``\\t``, and a colon in a role ``\\c``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import saved, whole_text

HEAD, MID, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for raw, mark in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    """In an escaped text every backslash begins a mark, so marks can be
    replaced one kind after another, the backslash's own last."""
    for raw, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(raw))
    return text


def chain(turns: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) of linear conversations
    (conv_id, turn, role, text): each turn answers the one before.

    Rows with equal turns follow each other by role and text; null turns come
    last; a null conv_id is a conversation.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    node = F.row_number().over(order).cast("bigint")
    return turns.select("conv_id", "role", "text", node.alias("node")).select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, score, depth, node): the messages of each chosen
    branch; ``depth`` is 0 at the leaf.

    ``best`` branches per tree are kept, all if None, by score (the sum over
    the path, nulls count 0), then the smaller leaf. (tree, node) must be
    unique; a message whose parent is missing is a root; replies that answer
    each other in a ring are an error. Jump tables hold the ancestor 1, 2, 4,
    ... steps up, so a path of n messages takes log2(n) joins, and branches
    are ranked before any path is spelled out. Only ids and scores are moved.
    """
    same = F.col("a.tree").eqNullSafe(F.col("b.tree"))
    ids = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    up = ids.alias("a").join(ids.alias("b"), same & (F.col("a.parent") == F.col("b.node")), "left")
    # own: score of the steps a jump passes, from its message up to below the ancestor.
    jump = saved(up.select("a.tree", "a.node", F.col("b.node").alias("up"), F.col("a.score").alias("own")), "chat-jump")
    jumps, n = [], jump.count()
    while True:
        # Paths that have reached their root are not joined again.
        rising, done = jump.where("up IS NOT NULL"), jump.where("up IS NULL")
        jumps.append(rising.select("tree", "node", "up"))
        if rising.isEmpty():
            break
        if 1 << (len(jumps) - 1) > n:
            raise ValueError("messages answer each other in a ring")
        higher = rising.alias("a").join(jump.alias("b"), same & (F.col("a.up") == F.col("b.node"))).select(
            "a.tree", "a.node", "b.up", (F.col("a.own") + F.col("b.own")).alias("own")
        )
        jump = saved(done.unionByName(higher), "chat-jump")
    # Now no ancestor is left above, so ``own`` is the score of the whole path.
    inner = ids.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = jump.alias("a").join(inner.alias("b"), same & (F.col("a.node") == F.col("b.node")), "left_anti")
    ranked = leaves.select(
        "tree", F.col("node").alias("leaf"), F.col("own").alias("score"),
        F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("own"), "node")).alias("rank"),
    )
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    path = ranked.select("*", F.lit(0).cast("bigint").alias("depth"), F.col("leaf").alias("node"))
    for k in reversed(range(len(jumps) - 1)):
        far = path.alias("a").join(jumps[k].alias("b"), same & (F.col("a.node") == F.col("b.node")))
        path = path.unionByName(far.select(
            "a.tree", "a.leaf", "a.score", "a.rank", (F.col("a.depth") + (1 << k)).alias("depth"), F.col("b.up").alias("node")
        ))
        path = saved(path, "chat-path")
    return path


def formatted(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss): one row per chosen branch.

    ``loss`` lists the spans (start, end in code points, end exclusive) of
    assistant texts. Null roles and texts count as empty. One branch becomes
    one string, so its turns meet in one place; that is the output itself.
    """
    path = branches(messages, best)
    joined = path.alias("p").join(
        messages.alias("m"), F.col("p.tree").eqNullSafe(F.col("m.tree")) & (F.col("p.node") == F.col("m.node"))
    )
    role = F.replace(escape(whole_text("role")), F.lit(":"), F.lit("\\c"))
    turn = F.struct((-F.col("p.depth")).alias("at"), role.alias("role"), escape(whole_text("text")).alias("text"))
    rows = joined.groupBy("p.tree", "p.leaf", "p.rank", "p.score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    body = F.concat_ws("", F.transform("turns", lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MID), t["text"], F.lit(END))))
    head = len(HEAD) + len(MID)
    loss = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + head + F.length(t["role"]) + F.length(t["text"]) + len(END)).alias("at"),
            F.when(t["role"] == LEARNED_ROLE, F.concat(a["spans"], F.array(F.struct(
                (a["at"] + head + F.length(t["role"])).alias("start"),
                (a["at"] + head + F.length(t["role"]) + F.length(t["text"])).alias("end"),
            )))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return rows.select("tree", "leaf", "rank", "score", body.alias("formatted"), loss.alias("loss"))


def turns_of(text: str = "formatted") -> Column:
    """Turns (role, text) read back from formatted text."""
    lines = F.split(text, END, -1)
    lines = F.slice(lines, F.lit(1), F.size(lines) - 1)
    split = F.transform(lines, lambda s: F.struct(s.alias("line"), F.instr(s, MID).alias("mid")))
    return F.transform(split, lambda s: F.struct(
        unescape(F.replace(s["line"].substr(F.lit(len(HEAD) + 1), s["mid"] - len(HEAD) - 1), F.lit("\\c"), F.lit(":"))).alias("role"),
        unescape(s["line"].substr(s["mid"] + len(MID), F.length(s["line"]))).alias("text"),
    ))


def learned_text(text: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.concat_ws("", F.transform(loss, lambda s: unescape(
        F.col(text).substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    )))
