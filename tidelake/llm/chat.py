"""Chat formatting of reply trees: root-to-leaf paths by self-joins, ranked, one conversation each.

Messages form trees by their parents. Ancestors of every leaf are found by doubling: each round
joins the pairs found so far with jumps twice as long, so a thread of n messages takes log2(n)
rounds. Of each tree the paths with the highest mean score stay.

Nulls and edge cases: a null text or role counts as empty, a null score as 0. A message whose
parent is null or missing is a root. Rows without a tree id are one tree. Of rows with one tree and
message id the smallest by parent, role, text and score takes part, nulls first, so repeated rows
change nothing; rows without a message id take no part. Messages on a cycle of parents have no root
and form no path. Equal scores are ordered by the leaf's id. An empty table gives no rows. Texts of
any length are kept whole; a conversation must fit into one string. Other columns are not read.
All work is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.lake import stage

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Strings that steer a model; inside texts they are escaped.
CONTROLS = (BEGIN, END, "<s>", "</s>", "[INST]", "[/INST]")
ESCAPE = "\\"


def escape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    """Double every backslash, then put one after the first sign of every control string."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescape(text: Column) -> Column:
    """Take a backslash away and keep the sign after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_replies(df: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns of plain conversations as reply trees: each turn answers the one before.

    Turns with equal numbers are ordered by role and text, so every row takes part.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = df.select(
        F.col(tree).alias("tree"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    number = F.row_number().over(order).cast("bigint")
    return rows.select("tree", number.alias("message"), "role", "text").select(
        "tree", "message",
        F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def single_messages(messages: DataFrame) -> DataFrame:
    """One row for each message id of a tree: tree, message, parent, role, text, score."""
    rest = ["parent", "role", "text", "score"]
    return messages.filter("message IS NOT NULL").groupBy("tree", "message").agg(
        F.min(F.struct(*rest)).alias("row")
    ).select("tree", "message", *[F.col("row")[c].alias(c) for c in rest])


def leaf_paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, message, up: every message on the way from a leaf to its root.

    ``up`` is the number of replies between message and leaf.
    """
    ids = messages.select("tree", "message", "parent")
    parents = ids.select("tree", F.col("message").alias("above"))
    jumps = ids.filter("parent IS NOT NULL").alias("m").join(
        parents.alias("p"),
        F.expr("m.tree <=> p.tree AND m.parent = p.above"),
    ).select("m.tree", "m.message", F.col("m.parent").alias("target"))
    jumps = stage(jumps)
    answered = jumps.select("tree", F.col("target").alias("message")).distinct()
    leaves = ids.alias("m").join(
        answered.alias("a"), F.expr("m.tree <=> a.tree AND m.message = a.message"), "left_anti"
    )
    sizes = ids.groupBy("tree").agg(F.count("*").alias("most"))
    found = stage(
        leaves.alias("l").join(sizes.alias("s"), F.expr("l.tree <=> s.tree")).select(
            "l.tree", F.col("l.message").alias("leaf"), F.col("l.message").alias("message"),
            F.lit(0).cast("bigint").alias("up"), "s.most",
        )
    )
    step = 1
    while not jumps.isEmpty():
        further = found.alias("f").join(
            jumps.alias("j"), F.expr("f.tree <=> j.tree AND f.message = j.message")
        ).select(
            "f.tree", "f.leaf", F.col("j.target").alias("message"),
            (F.col("f.up") + step).alias("up"), "f.most",
        )
        # A way longer than its tree has messages runs in a circle.
        further = stage(further.filter("up < most"))
        if further.isEmpty():
            break
        found = found.unionAll(further)
        jumps = stage(
            jumps.alias("a").join(
                jumps.alias("b"), F.expr("a.tree <=> b.tree AND a.target = b.message")
            ).select("a.tree", "a.message", "b.target")
        )
        step *= 2
    rooted = found.alias("f").join(
        ids.alias("i"), F.expr("f.tree <=> i.tree AND f.message = i.message")
    ).join(parents.alias("p"), F.expr("i.tree <=> p.tree AND i.parent = p.above"), "left")
    roots = rooted.filter("p.above IS NULL").select("f.tree", "f.leaf").distinct()
    return found.alias("f").join(
        roots.alias("r"), F.expr("f.tree <=> r.tree AND f.leaf = r.leaf"), "left_semi"
    ).drop("most")


def best_paths(
    messages: DataFrame, per_tree: int = 1
) -> DataFrame:
    """Turns of the best paths: tree, branch (from 1), leaf, up, role, text.

    Paths are ranked by the mean score of their messages, ties by the smaller leaf id.
    """
    messages = stage(single_messages(messages))
    paths = leaf_paths(messages)
    full = stage(
        paths.alias("p").join(
            messages.alias("m"), F.expr("p.tree <=> m.tree AND p.message = m.message")
        ).select("p.tree", "p.leaf", "p.up", "m.role", "m.text",
                 F.coalesce("m.score", F.lit(0.0)).alias("score"))
    )
    ranked = full.groupBy("tree", "leaf").agg(F.avg("score").alias("mean")).withColumn(
        "branch",
        F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")),
    ).filter(F.col("branch") <= per_tree)
    return full.alias("f").join(
        ranked.alias("r"), F.expr("f.tree <=> r.tree AND f.leaf = r.leaf")
    ).select("f.tree", "r.branch", "f.leaf", "f.up", "f.role", "f.text")


def format_chats(
    messages: DataFrame, per_tree: int = 1, learn_from: Sequence[str] = ("assistant",)
) -> DataFrame:
    """One row per chosen path: tree, branch, formatted, loss spans.

    ``messages`` has tree, message, parent, role, text, score. A turn is the begin mark, the
    escaped role, a line feed, the escaped text, the end mark and a line feed. ``loss`` lists the
    begin and length, in code points, of the text of every turn to learn from.
    """
    escaped_role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    turns = best_paths(messages, per_tree).select(
        "tree", "branch", (-F.col("up")).alias("at"), escaped_role.alias("head"),
        F.coalesce("role", F.lit("")).isin(*learn_from).alias("learn"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    lead = F.char_length("head") + len(BEGIN) + 1
    width = lead + F.char_length("body") + len(END) + 1
    before = Window.partitionBy("tree", "branch").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = turns.withColumn(
        "begin", F.coalesce(F.sum(width).over(before), F.lit(0)) + lead
    ).withColumn("turn", F.concat(F.lit(BEGIN), "head", F.lit("\n"), "body", F.lit(END + "\n")))
    return placed.groupBy("tree", "branch").agg(
        F.array_sort(F.collect_list(F.struct("at", "turn", "learn", "begin",
                                             F.char_length("body").alias("length")))).alias("t")
    ).select(
        "tree", "branch",
        F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(
            F.filter("t", lambda t: t["learn"]),
            lambda t: F.struct(t["begin"].cast("bigint").alias("begin"),
                               t["length"].cast("bigint").alias("length")),
        ).alias("loss"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Turns and learnt texts of formatted conversations: tree, branch, turns, learnt, …"""
    pieces = F.split(F.col("formatted"), r"\Q" + END + r"\E\n")
    bodies = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substr(p, F.lit(len(BEGIN) + 1))
    )
    turn = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)$"
    turns = F.transform(
        bodies,
        lambda b: F.struct(
            unescape(F.regexp_extract(b, turn, 1)).alias("role"),
            unescape(F.regexp_extract(b, turn, 2)).alias("text"),
        ),
    )
    learnt = F.transform(
        "loss",
        lambda s: unescape(F.substr(F.col("formatted"), s["begin"].cast("int") + 1,
                                    s["length"].cast("int"))),
    )
    return chats.select("tree", "branch", "formatted", turns.alias("turns"), learnt.alias("learnt"))
