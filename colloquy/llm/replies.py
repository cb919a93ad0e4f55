"""Chat formatting of reply trees, by DataFrame operations alone.

Messages name the one they reply to. Iterative self-joins with doubling steps
give every message its depth and the sum of scores up to its root: after round
r a link reaches 2**r messages up, so a tree of depth d takes log2(d) + 1
rounds, however long its chains. A leaf's sum ranks its branch; the best
branches of each tree climb back along the links of every round, and each
becomes one conversation: its messages from root to leaf, in a template whose
control strings are escaped inside texts.

Rounds move keys alone. Texts move once: those of a tree meet its paths where
the tree is; trees that hold more than 1 / HOT of all messages (at most HOT of
them) are dealt by message, then by path, so no task gets one whole.
Intermediate tables lie in the shared folder. A conversation is one value and
must fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_table
from .common import materialize

HOT = 1000
HOT_ROWS = 100_000            # a tree of fewer messages is never dealt apart
SALTS = 32
START, END = "<|im_start|>", "<|im_end|>"
MESSAGES = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    """A text without control strings: ``<``, any backslashes and ``|`` get one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role without line ends and bars, by percent signs."""
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("|"), F.lit("%7C"))


def unescape_role(role: Column) -> Column:
    """The inverse of ``escape_role``."""
    out = F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def _link(a: DataFrame, b: DataFrame, on: str) -> Column:
    """Join condition: ``on`` of ``a`` is a node of ``b`` in the same tree; ``b`` has its columns renamed by ``_other``."""
    return a["tree_id"].eqNullSafe(b["b_tree_id"]) & a[on].eqNullSafe(b["b_node_id"])


def _other(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).alias(f"b_{c}") for c in df.columns))


def links_of(messages: DataFrame) -> DataFrame:
    """(tree_id, node_id, parent_id, score) of ``messages``, one row per node: rows that share an id are one node's
    messages, their least parent and the sum of their scores are the node's."""
    return messages.groupBy("tree_id", "node_id").agg(
        F.min("parent_id").alias("parent_id"), F.sum(F.coalesce(F.col("score").cast("double"), F.lit(0.0))).alias("score"))


def branches(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(leaves, levels) of the trees of ``links``.

    ``leaves`` are (tree_id, node_id, depth, total): the nodes that none
    replies to, the number of nodes on their branch and the sum of its scores.
    ``levels[r]`` is a written table of all nodes with ``up``, the ancestor
    2**r steps up. A node whose parent is null, itself or not in its tree is a
    root. Nodes of a circle of replies, and those below it, have no root and
    so no branch.
    """
    known = _other(links.select("tree_id", "node_id"))
    own = links.withColumn("up", F.when(F.col("parent_id") != F.col("node_id"), F.col("parent_id")))
    nodes = own.join(known, _link(own, known, "up") & own["up"].isNotNull(), "left").select(
        "tree_id", "node_id", F.col("b_node_id").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    levels = [materialize(nodes, "reply-links")]
    rounds = int(levels[0].count()).bit_length()
    while levels[-1].where("up IS NOT NULL").take(1) and len(levels) <= rounds:
        now = levels[-1]
        rising, b = now.where("up IS NOT NULL"), _other(now)
        risen = rising.join(b, _link(rising, b, "up")).select(
            "tree_id", "node_id", F.col("b_up").alias("up"), (F.col("depth") + F.col("b_depth")).alias("depth"),
            (F.col("total") + F.col("b_total")).alias("total"))
        levels.append(materialize(now.where("up IS NULL").unionByName(risen), "reply-links"))
    ended = levels[-1].where("up IS NULL")
    parents = _other(levels[0].where("up IS NOT NULL").select("tree_id", F.col("up").alias("node_id")).distinct())
    return ended.join(parents, _link(ended, parents, "node_id"), "left_anti").drop("up"), levels


def best(leaves: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` leaves of each tree with the greatest total (ties: the smaller id), numbered ``path`` from 1.

    Each salt of a tree keeps that many, then the tree: no task sees all leaves of a large tree.
    """
    order = [F.desc("total"), F.asc_nulls_first("node_id")]
    salted = leaves.withColumn("salt", F.pmod(F.xxhash64("node_id"), F.lit(SALTS)))
    some = salted.withColumn("path", F.row_number().over(Window.partitionBy("tree_id", "salt").orderBy(*order))).where(F.col("path") <= keep)
    return some.withColumn("path", F.row_number().over(Window.partitionBy("tree_id").orderBy(*order))).where(F.col("path") <= keep).drop("salt")


def paths(links: DataFrame, keep: int = 1) -> DataFrame:
    """(tree_id, path, pos, node_id): the nodes of each tree's ``keep`` best branches, ``pos`` from 0 at the root."""
    leaves, levels = branches(links)
    out = materialize(best(leaves, keep).select("tree_id", "path", (F.col("depth") - 1).alias("pos"), "node_id"), "reply-paths")
    for r, level in enumerate(levels[:-1]):
        b = _other(level.where("up IS NOT NULL").select("tree_id", "node_id", "up"))
        climbed = out.join(b, _link(out, b, "node_id")).select(
            "tree_id", "path", (F.col("pos") - (1 << r)).alias("pos"), F.col("b_up").alias("node_id"))
        old, out = out, materialize(out.unionByName(climbed), "reply-paths")
        drop_table(old)
    for level in levels:
        drop_table(level)
    return out


def _assemble(rows: DataFrame, loss_role: str) -> DataFrame:
    """One conversation per (tree_id, path) of ``rows`` (tree_id, path, pos, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    turn = rows.select("tree_id", "path", "pos", role.alias("role"), text.alias("text"), head.alias("head"),
                       F.concat(escape(text), F.lit(END + "\n")).alias("body"))
    turn = turn.withColumn("size", (F.length("head") + F.length("body")).cast("long"))
    before = Window.partitionBy("tree_id", "path").orderBy("pos", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0).cast("long"))
    turn = turn.withColumn("start", start).select("tree_id", "path", F.struct(
        "start", F.concat("head", "body").alias("piece"),
        F.when(F.col("role") == loss_role, F.struct((F.col("start") + F.length("head")).alias("start"),
                                                    (F.col("start") + F.col("size") - len(END) - 1).alias("stop"))).alias("loss")).alias("t"))
    whole = turn.groupBy("tree_id", "path").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("tree_id", "path", F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
                        F.filter(F.transform("t", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss"))


def format_branches(messages: DataFrame, links: DataFrame | None = None, keep: int = 1, loss_role: str = "assistant",
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tree_id, path, formatted, loss) of the ``keep`` best branches of every tree of ``messages``.

    ``messages`` are (tree_id, node_id, parent_id, role, text, score), other
    columns are not read; with ``links`` given (one row per node, as of
    ``links_of``) parent_id and score are not needed. Rows that share a tree and an id (repeated rows, null
    ids) are one node, whose messages follow each other by role and text. Null
    roles and texts are empty, null scores 0; null trees are one tree. ``loss``
    are the code points [start, stop) of the texts of ``loss_role``, in order.
    An empty table gives no rows.
    """
    members = paths(links_of(messages) if links is None else links, keep)
    texts = messages.select("tree_id", "node_id", "role", "text")
    sizes = materialize(messages.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")), "tree-sizes")
    least = max(hot_rows, (sizes.agg(F.sum("n")).first()[0] or 0) // HOT)
    hot = sizes.where(F.col("n") > least).select(F.col("tree_id").alias("b_tree_id"))           # HOT rows at most
    some_hot = bool(hot.take(1))

    def side(df: DataFrame, how: str) -> DataFrame:
        b = F.broadcast(hot)
        return df.join(b, df["tree_id"].eqNullSafe(b["b_tree_id"]), how)
    cold_texts, cold_members = (side(texts, "left_anti"), side(members, "left_anti")) if some_hot else (texts, members)
    at = F.struct("path", "pos")
    met = (cold_texts.select("tree_id", "node_id", F.struct("role", "text").alias("m"), F.lit(None).cast("struct<path:int,pos:long>").alias("at"))
           .unionByName(cold_members.select("tree_id", "node_id", F.lit(None).cast("struct<role:string,text:string>").alias("m"), at.alias("at")))
           .repartition("tree_id"))
    node = Window.partitionBy("tree_id", "node_id")
    met = met.withColumn("at", F.collect_list("at").over(node)).where("m IS NOT NULL")
    rows = met.select("tree_id", F.explode("at").alias("at"), "m").select("tree_id", "at.path", "at.pos", "m.role", "m.text")
    out = _assemble(rows, loss_role)
    if some_hot:
        t, b = side(texts, "left_semi"), _other(side(members, "left_semi"))
        apart = t.join(b, _link(t, b, "node_id")).select("tree_id", F.col("b_path").alias("path"), F.col("b_pos").alias("pos"), "role", "text")
        out = out.unionByName(_assemble(apart, loss_role))
    return out


def read_turns(formatted: Column) -> Column:
    """The (role, text) of the turns of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        return F.struct(unescape_role(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"),
                        unescape(F.substring(x, F.length(role) + 2, F.length(x))).alias("text"))
    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask of a formatted conversation."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, (s["stop"] - s["start"]).cast("int"))))


def conversation_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages, links) of a table (conv_id, turn, role, text): each turn replies to the one before it; a null turn comes first."""
    rows = conversations.select(F.col("conv_id").alias("tree_id"), "role", "text",
                                F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63))).alias("node_id"))
    before = F.lag("node_id").over(Window.partitionBy("tree_id").orderBy("node_id"))
    ids = rows.select("tree_id", "node_id").distinct()
    return rows, ids.select("tree_id", "node_id", before.alias("parent_id"), F.lit(0.0).alias("score"))
