"""Reply trees as conversations, with DataFrame operations only.

Root-to-leaf paths come from iterated self-joins that double their reach: after ``k`` rounds every leaf knows its
ancestors up to ``2 ** k`` steps away, so the rounds grow with the logarithm of the deepest tree, and the rows with
the paths' total length. Paths are ranked by score; each chosen one is formatted as one conversation. Each round is
written to the shared folder.

Template: a turn is ``<s>[role]``, a line break, the text, ``</s>`` and a line break. ``%`` and the first character of
each control string inside a role or text are written as ``%`` and two hex digits, so a text can't end its turn or
start another one, and :func:`read_back` gives it back exactly.

Defined results: a NULL text or role is empty; rows without a tree or node id are left out, a node that repeats
counts once (of several versions the one that sorts first); a node whose parent is missing is a root; nodes on a
cycle of parents, or below one, have no root and are left out; equal scores are ranked by leaf id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.session import stage

# Control strings of this and of common chat templates.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
OPEN, MIDDLE, CLOSE = "<s>[", "]\n", "</s>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"%{ord(control[0]):02X}{control[1:]}"))
    return out


def unescape(text: Column) -> Column:
    firsts = sorted({c[0] for c in CONTROLS})
    out = reduce(lambda t, c: F.replace(t, F.lit(f"%{ord(c):02X}"), F.lit(c)), firsts, text)
    return F.replace(out, F.lit("%25"), F.lit("%"))


def escape_role(role: Column) -> Column:
    out = F.replace(escape(role), F.lit("]"), F.lit("%5D"))
    return F.replace(out, F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%5D"), F.lit("]")), F.lit("%0A"), F.lit("\n")))


def _doubled(jump: DataFrame) -> DataFrame:
    """Jumps of twice the length; nodes that would leave the tree are gone."""
    further = jump.withColumnsRenamed({"node": "start", "above": "node"}).join(jump.select("tree", "node", "above"), ["tree", "node"])
    return further.drop("node").withColumnRenamed("start", "node")


def lost_nodes(jump: DataFrame, sizes: DataFrame) -> DataFrame | None:
    """``(tree, node)`` of the nodes on a cycle of parents or below one; None without any.

    Parents are jumped over in doubling steps, nodes alone. A node that still jumps after as many steps as its tree
    has nodes never reaches a root; it leaves the table of jumps then, so one bad tree costs no more rounds than its own
    size asks for.
    """
    jump, reach, lost = stage(jump.join(sizes, "tree"), "jump-alone"), 1, None
    while not jump.isEmpty():
        over = F.col("size") <= reach
        bad = stage(jump.where(over).select("tree", "node"), "lost")
        lost = bad if lost is None else lost.unionByName(bad)
        jump, reach = stage(_doubled(jump.where(~over)), "jump-alone"), 2 * reach
    return lost if lost is not None and not lost.isEmpty() else None


def paths(nodes: DataFrame) -> DataFrame:
    """``(tree, leaf, node, up)`` for every leaf with a root above it: all nodes of its path, ``up`` steps above.

    ``nodes`` has ``tree``, ``node`` (together unique) and ``parent`` (NULL or an unknown node for a root).
    """
    parents = nodes.select("tree", F.col("node").alias("parent")).distinct()
    known = nodes.where("parent IS NOT NULL").join(parents, ["tree", "parent"], "left_semi")
    jump = stage(known.select("tree", "node", F.col("parent").alias("above")), "jump")
    inner = jump.select("tree", F.col("above").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    lost = lost_nodes(jump, nodes.groupBy("tree").agg(F.count("*").alias("size")))
    if lost is not None:
        jump = stage(jump.join(lost, ["tree", "node"], "left_anti"), "jump")
        leaves = leaves.join(lost, ["tree", "node"], "left_anti")
    walks = stage(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "walks")
    reach = 1
    while not jump.isEmpty():
        step = walks.join(jump, ["tree", "node"])
        step = step.select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up"))
        walks, jump, reach = stage(walks.union(step), "walks"), stage(_doubled(jump), "jump"), 2 * reach
    return walks


def format_conversations(
    df: DataFrame,
    branches: int | None = None,
    trained_roles: tuple[str, ...] = ("assistant",),
    tree_col: str = "tree",
    node_col: str = "node",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
) -> DataFrame:
    """``(tree, leaf, rank, score, n_turns, formatted, loss_spans)``: one row per chosen path.

    A path's score is the mean of its nodes' scores (0 without ``score_col``; NULL counts as 0); of each tree the
    best ``branches`` are chosen, all by default. ``loss_spans`` are the stretches ``start`` to ``end`` of
    ``formatted``, in characters from 0, that are texts of ``trained_roles``.
    """
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) if score_col else F.lit(0.0)
    nodes = df.where(F.col(tree_col).isNotNull() & F.col(node_col).isNotNull()).select(
        F.col(tree_col).alias("tree"),
        F.col(node_col).alias("node"),
        F.col(parent_col).alias("parent"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        score.alias("score"),
    )
    version = F.struct("parent", "role", "text", "score")
    nodes = nodes.groupBy("tree", "node").agg(F.min(version).alias("version")).select("tree", "node", "version.*")
    nodes = stage(nodes, "nodes")
    steps = stage(paths(nodes.select("tree", "node", "parent")), "paths")
    scored = steps.join(nodes.select("tree", "node", "score"), ["tree", "node"])
    ranked = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = ranked.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    turns = steps.join(stage(ranked, "ranked"), ["tree", "leaf"]).join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MIDDLE))
    body = escape(F.col("text"))
    turn = F.struct(
        (-F.col("up")).alias("place"), head.alias("head"), body.alias("body"), F.col("role").isin(*trained_roles).alias("trained")
    )
    whole = turns.groupBy("tree", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    add = lambda s, t: F.struct(
        (s["at"] + size(t)).alias("at"),
        F.when(
            t["trained"],
            F.concat(
                s["spans"],
                F.array(
                    F.struct(
                        (s["at"] + F.length(t["head"])).alias("start"),
                        (s["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"),
                    )
                ),
            ),
        )
        .otherwise(s["spans"])
        .alias("spans"),
    )
    return whole.select(
        "tree",
        "leaf",
        "rank",
        "score",
        F.size("turns").cast("long").alias("n_turns"),
        text.alias("formatted"),
        F.aggregate("turns", start, add)["spans"].alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """Turns ``(role, text)`` of a formatted conversation."""
    whole = F.filter(F.split(formatted, F.lit("</s>\n")), lambda t: t != "")
    cut = lambda t: F.instr(t, MIDDLE)
    return F.transform(
        whole,
        lambda t: F.struct(
            unescape_role(F.substring(t, len(OPEN) + 1, cut(t) - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(t, cut(t) + len(MIDDLE), F.length(t))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations given as rows by turn (``conv_id, turn, role, text``) as trees without branches.

    Rows of a turn that repeats follow each other by role and text; a row without a turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree"), "node", (F.col("node") - 1).alias("parent"), "role", "text")
