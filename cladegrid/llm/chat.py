"""Chat formatting: root-to-leaf paths of reply trees, ranked by score and written in a turn template.

Paths come from iterative self-joins on (tree, message). A round joins the ancestor table with itself, so the distance
covered doubles and a thread of n turns takes log2(n) rounds; the same tables then list the messages of the chosen
leaves. Everything is DataFrame operations; lineage is cut after each round in the reliable checkpoint folder.

The template opens a turn with its role and closes it after its text. Control strings inside roles and texts get a
backslash after their first character (one more if there are some), which ``unescape`` takes back.

Defined cases: a null text or role is empty; a null tree id is a tree of its own; a missing parent makes a root;
messages in or below a reply cycle have no root and no path; of several messages with one id the least by (parent,
role, text) counts; a null score is 0; equal branches rank by the smaller leaf id; a conversation must fit a row.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage

# Control strings of common chat templates, by first character and rest.
CONTROL_FIRST = ("<", "[")
CONTROL_REST = ("|", "s>", "/s>", "SYS>>", "/SYS>>", "INST]", "/INST]")
_FIRST = "[" + "".join(re.escape(c) for c in CONTROL_FIRST) + "]"
_REST = "|".join(re.escape(c) for c in CONTROL_REST)


class Template(NamedTuple):
    open: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    close: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)


TEMPLATE = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_FIRST})(\\*)({_REST})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_FIRST})\\(\\*)({_REST})", r"$1$2$3")


def chain(rows: DataFrame, tree: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """Messages of linear threads: each row (by ``order``, then role and text) replies to the one before it."""
    chosen = rows.select(F.col(f"`{tree}`").alias("tree"), F.col(f"`{order}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    node = F.row_number().over(W.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return chosen.select("tree", node.alias("node"), "role", "text").select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _at(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join the row of ``right`` (r_tree, r_node, ..) that (tree, key) of ``left`` names."""
    return left.join(right, F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col(key) == F.col("r_node")), how).drop("r_tree", "r_node")


def ancestors(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up, total) for distances 1, 2, 4, .., and the rooted messages (tree, node, total).

    ``up`` is the ancestor at that distance, ``total`` the score from the node to below it; only messages with such an
    ancestor are in a table. For a rooted message ``total`` is the score of its whole path.
    """
    known = messages.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.lit(True).alias("known"))
    own = messages.withColumn("parent", F.when(F.col("parent") != F.col("node"), F.col("parent")))
    moved = _at(own, known, "parent", "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"))
    moved = cut_lineage(moved)
    rooted, tables = moved.where("up is null"), [moved.where("up is not null")]
    rounds = math.ceil(math.log2(moved.count() + 2)) + 1
    while len(tables) <= rounds and not tables[-1].isEmpty():
        above = rooted.unionByName(tables[-1]).select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.col("up").alias("r_up"), F.col("total").alias("r_total"))
        moved = _at(tables[-1], above, "up", "inner").select("tree", "node", F.col("r_up").alias("up"), (F.col("total") + F.col("r_total")).alias("total"))
        moved = cut_lineage(moved)
        rooted = rooted.unionByName(moved.where("up is null"))
        tables.append(moved.where("up is not null"))
    return tables[:-1] if tables[-1].isEmpty() else tables, rooted.drop("up")


def best_paths(messages: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, branch, path_score, node, above): the messages of each tree's best leaves; ``above`` counts from the leaf."""
    tables, rooted = ancestors(messages)
    inner = messages.where("parent <> node").select(F.col("tree").alias("r_tree"), F.col("parent").alias("r_node"))
    leaves = _at_anti(rooted, inner)
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("total"), "node"))
    best = leaves.withColumn("branch", rank).where(F.col("branch") <= branches)
    paths = cut_lineage(best.select("tree", F.col("node").alias("leaf"), "branch", F.col("total").alias("path_score"), "node", F.lit(0).cast("long").alias("above")))
    for k, table in enumerate(tables):
        step = table.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), "up")
        moved = _at(paths, step, "node", "inner").withColumn("node", F.col("up")).withColumn("above", F.col("above") + (1 << k)).select(*paths.columns)
        paths = cut_lineage(paths.unionByName(moved))
    return paths


def _at_anti(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col("node") == F.col("r_node")), "left_anti")


def format_trees(messages: DataFrame, branches: int = 1, template: Template = TEMPLATE) -> DataFrame:
    """(tree, leaf, branch, path_score, formatted, loss_spans) from messages (tree, node, parent, role, text, score).

    ``loss_spans`` are the (first, last) code points, last exclusive, of the escaped texts of the trained roles.
    """
    fields = ("parent", "role", "text", "score")
    messages = cut_lineage(messages.groupBy("tree", "node").agg(F.min(F.struct(*fields)).alias("m")).select("tree", "node", *[F.col(f"m.{f}").alias(f) for f in fields]))
    paths = best_paths(messages, branches)
    texts = messages.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), escape(F.coalesce("role", F.lit(""))).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce(F.col("role").isin(*template.trained), F.lit(False)).alias("trained"))
    turns = _at(paths, texts, "node", "inner")
    head = F.concat(F.lit(template.open), F.col("role"), F.lit(template.middle))
    turns = turns.select("tree", "leaf", "branch", "path_score", (-F.col("above")).alias("at"), head.alias("head"), "text", "trained")
    size = F.length("head") + F.length("text") + len(template.close)
    before = F.sum(size).over(W.partitionBy("tree", "leaf").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)) - size
    start = before + F.length("head")
    span = F.when(F.col("trained"), F.struct(start.alias("first"), (start + F.length("text")).alias("last")))
    placed = turns.select("tree", "leaf", "branch", "path_score", F.struct("at", F.concat("head", "text", F.lit(template.close)).alias("turn"), span.alias("span")).alias("part"))
    whole = placed.groupBy("tree", "leaf").agg(F.first("branch").alias("branch"), F.first("path_score").alias("path_score"), F.sort_array(F.collect_list("part")).alias("parts"))
    spans = F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull())
    return whole.select("tree", "leaf", "branch", "path_score", F.array_join(F.transform("parts", lambda p: p["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    pieces = F.split(formatted, re.escape(template.close).replace("\\\n", "\\n"), -1)
    body = lambda p: F.substr(p, F.lit(len(template.open) + 1))
    part = lambda p, k: unescape(F.split_part(body(p), F.lit(template.middle), F.lit(k)))
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(part(p, 1).alias("role"), part(p, 2).alias("text")))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(loss_spans, lambda s: unescape(F.substr(formatted, (s["first"] + 1).cast("int"), (s["last"] - s["first"]).cast("int"))))
