"""Prefix trie of conversations, found by fixed-length blocks of turns first and by turns only where blocks differ.

Every conversation is cut into blocks of ``block`` turns. A block's digest chains the digests of its turns; the digest
of all blocks up to one comes from joins of (conversation, block) with the block 1, 2, 4, .. before it, so a
conversation of n blocks takes log2(n) rounds and is never gathered. Conversations are grouped by (blocks before,
block). A block without a sibling is a plain chain: all its turns have the members of the block. Only the blocks that
share what comes before and differ are taken apart into turns, which are counted again by their prefix.

Sums over subtrees double their reach each round: a node adds what its descendants 1, 2, 4, .. turns below it have
summed up. Their common ancestor is looked up by (smallest member, depth), which is unique, so no join has a hot key;
parents with a large share of all nodes meet their children in a broadcast join of bounded size.

The digest of a node's finished conversations needs their ids in order; SHA-256 has no parallel form. Ids are joined
into texts by ranges of ``IDS`` first, and one task streams the few texts of a node through the digest.

Defined cases: turns are ordered by (order, digest of role and text), nulls first, so equal turns may come in any
order without a change; repeated rows are turns of their own; a null role or text is empty; rows without a
conversation id take no part; a conversation without turns ends at the root; an empty table has no root and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladegrid.operators.joins import attach_by_key
from cladegrid.session import cut_lineage

BLOCK = 8
# Turn numbers that are ordered in one task, and conversation ids that are joined into one text.
SPAN, IDS = 1024, 4096
ROOT = ""
WORD = r"[^\x20\x09-\x0D]+"


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def number_turns(rows: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words): turns by position from 0, with the digest of role and text and the words of the text."""
    own, spoken = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    slim = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{order}`").alias("turn"), _sha(F.length(own).cast("string"), F.lit(":"), own, spoken).alias("digest"), F.regexp_count(spoken, F.lit(WORD)).cast("long").alias("words")
    )
    slim = slim.withColumn("span", F.floor(F.col("turn") / F.lit(SPAN)))
    inside = F.row_number().over(W.partitionBy("conv", "span").orderBy("turn", "digest")) - 1
    earlier = W.partitionBy("conv").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = slim.groupBy("conv", "span").agg(F.count("*").alias("n"))
    spans = spans.select(F.col("conv").alias("r_conv"), F.col("span").alias("r_span"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = slim.withColumn("inside", inside).join(spans, (F.col("conv") == F.col("r_conv")) & F.col("span").eqNullSafe(F.col("r_span")))
    return placed.select("conv", (F.col("before") + F.col("inside")).cast("long").alias("pos"), "digest", "words")


def share_openings(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns, and all conversations: the first h turns of conversation c - c % every, then those of c after its first h.

    h is crc32 of the decimal c modulo ``most``. Fewer turns are taken where the other conversation has fewer or is absent.
    """
    heads = turns.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1)).groupBy(F.col("conv").alias("base"))
    heads = heads.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    plans = turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), h.alias("h"))
    plans = plans.join(heads, "base", "left").select("conv", F.col("h"), F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(array(struct(0L as pos, '' as digest, 0L as words)), 1, 0)")).alias("head"))
    plans = cut_lineage(plans)
    own = turns.join(plans.select("conv", "h", F.size("head").alias("taken")), "conv").where(F.col("pos") >= F.col("h"))
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    return own.unionByName(plans.select("conv", F.inline("head"))), plans.select("conv")


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """(conv, k, chain, words): block k with the digests of its first 1, 2, .. turns and their words."""
    listed = turns.groupBy("conv", F.floor(F.col("pos") / block).alias("k")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"))
    chain = F.aggregate("turns", F.array().cast("array<string>"), lambda done, t: F.concat(done, F.array(_sha(F.lit("turn"), F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), t["digest"]))))
    return listed.select("conv", "k", chain.alias("chain"), F.col("turns.words").alias("words"))


def _digests_so_far(blocks: DataFrame) -> DataFrame:
    """(conv, k, upto): digest of the blocks 0 to k; after a round it covers the 2, 4, 8, .. blocks up to k."""
    upto = blocks.select("conv", "k", F.element_at("chain", -1).alias("upto"))
    most = blocks.agg(F.max("k")).first()[0] or 0
    step = 1
    while step <= most:
        earlier = upto.select("conv", (F.col("k") + step).alias("k"), F.col("upto").alias("earlier"))
        joined = upto.where(F.col("k") >= step).join(earlier, ["conv", "k"])
        upto = cut_lineage(upto.where(F.col("k") < step).unionByName(joined.select("conv", "k", _sha(F.lit("blocks"), F.col("earlier"), F.col("upto")).alias("upto"))))
        step *= 2
    return upto


def _turn_keys(block: int) -> Column:
    """Node keys of the turns of a block: a whole block's end is what following blocks continue from."""
    whole = lambda i: (i + 1) == block
    return F.transform("chain", lambda q, i: F.when(whole(i), F.col("upto")).otherwise(_sha(F.lit("node"), F.col("before"), q)))


def _digest_ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows (conv, key): SHA-256 of the ids of a key, ascending and comma-joined."""
    texts = ends.groupBy("key", F.floor(F.col("conv") / IDS).alias("range")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out: list[tuple[str, str]] = []
            for at, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if at != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _pairs(out)
        if state is not None:
            yield _pairs([(key, state.hexdigest())])

    return texts.repartition("key").sortWithinPartitions("key", "range").mapInArrow(digest, "key string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["key", "ends_sha256"])


def _subtree_sums(nodes: DataFrame, paths: DataFrame, columns: list[str]) -> DataFrame:
    """Replace columns of ``nodes`` (key, conv, depth, ..) by their sums over the subtree of each node."""
    sums = cut_lineage(nodes.select("key", "conv", "depth", *columns))
    deepest = sums.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        below = sums.where(F.col("depth") > step).select("conv", (F.col("depth") - step).alias("depth"), *columns)
        moved = below.join(paths, ["conv", "depth"]).select(F.col("key").alias("above"), *columns)
        moved = moved.unionByName(sums.where(F.col("depth") == step).select(F.lit(ROOT).alias("above"), *columns))
        moved = moved.groupBy("above").agg(*[F.sum(c).alias(f"more_{c}") for c in columns])
        joined = sums.join(moved, F.col("key") == F.col("above"), "left")
        sums = cut_lineage(joined.select("key", "conv", "depth", *[(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in columns]))
        step *= 2
    return sums.select("key", *columns)


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix: smallest member, depth, parent, members, children, leaves, saved words, finished members.

    ``turns`` are (conv, pos, digest, words) with positions from 0; ``convs`` lists all conversations, also turnless ones.
    """
    blocks = cut_lineage(_blocks(turns, block))
    upto = _digests_so_far(blocks)
    before = upto.select("conv", (F.col("k") + 1).alias("k"), F.col("upto").alias("before"))
    placed = blocks.join(upto, ["conv", "k"]).join(before, ["conv", "k"], "left").withColumn("before", F.coalesce("before", F.lit(ROOT)))
    placed = cut_lineage(placed.select("conv", "k", "before", "upto", "chain", "words", _turn_keys(block).alias("keys")))

    grouped = cut_lineage(placed.groupBy("k", "before", "keys", "words").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")))
    siblings = grouped.groupBy("k", "before").agg(F.count("*").alias("siblings"))
    met = attach_by_key(grouped, siblings, ["k", "before"], "siblings")
    turn = F.posexplode(F.arrays_zip("keys", "words")).alias("t", "turn")
    single = met.select("siblings", "k", "before", "keys", "n_convs", "conv", turn).select(
        "siblings", F.col("turn.keys").alias("key"), F.when(F.col("t") == 0, F.col("before")).otherwise(F.try_element_at("keys", F.col("t"))).alias("parent"),
        (F.col("k") * block + F.col("t") + 1).cast("long").alias("depth"), F.col("turn.words").alias("words"), "n_convs", "conv",
    )
    alone = single.where("siblings = 1").drop("siblings")
    apart = single.where("siblings > 1").groupBy("key", "parent", "depth", "words").agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "n_convs", "conv")
    nodes = cut_lineage(alone.unionByName(apart).unionByName(root))

    ends = placed.groupBy("conv").agg(F.max(F.struct("k", F.element_at("keys", -1).alias("key")))["key"].alias("key"))
    ends = convs.join(ends, "conv", "left").select("conv", F.coalesce("key", F.lit(ROOT)).alias("key"))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    paths = placed.select("conv", "k", F.posexplode("keys").alias("t", "key")).select("conv", (F.col("k") * block + F.col("t") + 1).cast("long").alias("depth"), "key")
    own = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    sums = _subtree_sums(own, paths, ["n_leaves", "saved_tokens"])
    full = nodes.join(sums, "key").join(_digest_ends(ends), "key", "left")

    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("n_children").alias("siblings"), F.col("conv").alias("parent_conv"))
    below = attach_by_key(full.where("depth > 0"), parents, ["parent"], "siblings")
    every = below.unionByName(full.where("depth = 0").withColumns({"siblings": F.lit(0).cast("long"), "parent_conv": F.lit(None).cast(dict(nodes.dtypes)["conv"])}))
    return every.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
