"""Chat formatting of reply trees (DataFrame functions only).

A tree's messages hang on their parents. Iterative self-joins with doubling
jumps give every message its depth and the score of its path; the leaves of a
tree are ranked by that score; for the chosen leaves, the same jump tables
enumerate the path from leaf to root; each path becomes one conversation. The
number of joins is logarithmic in the longest path.

Template: ``<|turn:role|>\\ntext<|end|>\\n`` a turn. Control strings inside a text
(``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a backslash after their
first character, and one that already has backslashes there gets one more, so
unescaping gives back exactly the text and no text can open or close a turn.
A role's ``|>`` is escaped the same way.

Defined results: null text or role is the empty string; repeated messages are
messages of their own; a message whose parent is missing is a root; a tree
without messages does not exist; columns that are not named are not read; an empty
table gives an empty result. One
formatted conversation is one row, so its length is bounded by Spark's 2 GB a value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import running_totals, stage

#: fixed values: the strings a text must not be able to forge
CONTROL = "([<\\[])(\\\\*)(\\||/?s>|/?INST\\])"
ESCAPED = "([<\\[])\\\\(\\\\*)(\\||/?s>|/?INST\\])"
HEAD, END = "<|turn:", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "$1\\\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def escape_role(c: Column) -> Column:
    return F.regexp_replace(c, "\\|(\\\\*)>", "|\\\\$1>")


def unescape_role(c: Column) -> Column:
    return F.regexp_replace(c, "\\|\\\\(\\\\*)>", "|$1>")


def linear_tree(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Message rows of linear conversations as trees: each row's parent is the row
    before it. (tree, node, parent, role, text, score); rows of one turn order
    by role and text. Numbered by a range sort over all rows, so one long
    conversation is not one task."""
    m = conversations.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"),
                             F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("tree", "turn", "role", "text")]
    m = stage(running_totals(m, order, {}, "messages"), "messages")
    prev = m.select((F.col("rn") + 1).alias("rn"), F.struct(F.col("tree").alias("t"), F.col("rn").alias("p")).alias("prev"))
    return (m.join(prev, "rn", "left")
            .select("tree", F.col("rn").alias("node"),
                    F.when(F.col("prev.t").eqNullSafe(F.col("tree")) & F.col("prev").isNotNull(), F.col("prev.p")).alias("parent"),
                    "role", "text", F.lit(1.0).alias("score")))


def tree_paths(nodes: DataFrame, branches: int | None = None, max_rounds: int = 40) -> DataFrame:
    """(path, tree, node, depth, branch, path_score) of the chosen root-to-leaf paths.

    ``nodes``: (tree, node, parent, score), ``node`` unique. ``path`` is the
    leaf; ``branch`` ranks the paths of a tree by total score, ties to the
    smaller leaf; ``branches`` keeps that many of each tree (None: all).
    """
    ids = nodes.select(F.col("node").alias("up"))
    n = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    held = n.where("parent is not null").join(ids, F.col("parent") == F.col("up"), "left")
    n = stage(held.select("tree", "node", F.col("up").alias("parent"), "score").unionByName(n.where("parent is null")), "tree_nodes")
    # climb: (node, anc 2**k steps up, steps made, score collected); a row that reached its root rests
    part = n.select("node", F.col("parent").alias("anc"), F.lit(1).cast("long").alias("steps"), "score")
    done, jumps = [], []
    for _ in range(max_rounds):
        part = stage(part, "tree_climb")
        done.append(part.where("anc is null"))
        going = part.where("anc is not null")
        if going.isEmpty():
            break
        jumps.append(going.select("node", "anc"))
        up = reduce(DataFrame.unionByName, done, going).select(
            F.col("node").alias("anc"), F.col("anc").alias("anc2"), F.col("steps").alias("steps2"), F.col("score").alias("score2"))
        part = going.join(up, "anc").select("node", F.col("anc2").alias("anc"), (F.col("steps") + F.col("steps2")).alias("steps"),
                                            (F.col("score") + F.col("score2")).alias("score"))
    else:
        raise ValueError("the parents of some messages form a circle, or a path is too long")
    climb = reduce(DataFrame.unionByName, done)
    depth = climb.select("node", (F.col("steps") - 1).alias("depth"), F.col("score").alias("path_score"))
    leaves = (n.join(n.where("parent is not null").select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
              .select("tree", "node").join(depth.select("node", "path_score"), "node"))
    # rank the branches of a tree: totals first, so a tree of very many leaves is range-sorted, not one window
    order = [F.col("tree").asc_nulls_first(), F.col("path_score").desc(), F.col("node")]
    r = running_totals(leaves, order, {}, "tree_leaves")
    first = r.groupBy(F.col("tree").alias("t")).agg(F.min("rn").alias("first"))
    r = (r.join(first, F.col("tree").eqNullSafe(F.col("t")))
         .select("tree", F.col("node").alias("path"), (F.col("rn") - F.col("first") + 1).alias("branch"), "path_score"))
    if branches is not None:
        r = r.where(F.col("branch") <= branches)
    paths = stage(r.select("path", F.col("path").alias("node"), "tree", "branch", "path_score"), "tree_paths")
    for jump in reversed(jumps):     # longest jump first: every distance once
        paths = paths.unionByName(paths.join(jump, "node").select("path", F.col("anc").alias("node"), "tree", "branch", "path_score"))
        paths = stage(paths, "tree_paths")
    return paths.join(depth.select("node", "depth"), "node").select("path", "tree", "node", "depth", "branch", "path_score")


def format_trees(nodes: DataFrame, branches: int | None = None, trained_role: str = "assistant") -> DataFrame:
    """(tree, path, branch, path_score, n_turns, formatted, loss_spans): one row a chosen path.

    ``loss_spans`` are code point ranges (end exclusive) of ``formatted`` that
    hold the texts of ``trained_role``, still escaped.
    """
    p = tree_paths(nodes, branches)
    body = nodes.select("node", F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit("|>\n")).alias("head"),
                        escape(F.col("text")).alias("body"), (F.col("role") == trained_role).alias("loss"))
    turns = (p.join(body, "node").groupBy("path")
             .agg(F.first("tree").alias("tree"), F.first("branch").alias("branch"), F.first("path_score").alias("path_score"),
                  F.array_sort(F.collect_list(F.struct("depth", "head", "body", "loss"))).alias("turns")))
    end = len(END)
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"),
                          F.array().cast("array<struct<start:bigint,end:bigint>>").alias("s")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + end).cast("long").alias("at"),
            F.when(t["loss"], F.concat(acc["s"], F.array(F.struct(
                (acc["at"] + F.length(t["head"])).cast("long").alias("start"),
                (acc["at"] + F.length(t["head"]) + F.length(t["body"])).cast("long").alias("end")))))
            .otherwise(acc["s"]).alias("s")),
        lambda acc: acc["s"])
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return turns.select("tree", "path", "branch", "path_score", F.size("turns").cast("long").alias("n_turns"),
                        text.alias("formatted"), spans.alias("loss_spans"))


def read_formatted(formatted: DataFrame) -> DataFrame:
    """Parse :func:`format_trees` output: adds ``turns`` (role, text) and ``loss_text``
    (the unescaped text under the loss mask)."""
    parts = F.filter(F.split("formatted", "<\\|end\\|>\n"), lambda x: x != "")
    turns = F.transform(parts, lambda x: F.struct(
        unescape_role(F.substring(x, F.lit(len(HEAD) + 1), F.instr(x, F.lit("|>\n")) - 1 - len(HEAD))).alias("role"),
        unescape(F.substring(x, F.instr(x, F.lit("|>\n")) + 3, F.length(x))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.select("*", turns.alias("turns"), loss.alias("loss_text"))
