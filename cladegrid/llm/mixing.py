"""Mix sources to target weights: every document is repeated so that each source nears its share of the words.

Tokens are summed per source, shares become repetition rates, and a document is emitted floor(rate) times plus one
copy more with the fraction as probability. The coin is a hash of seed, document id and text, so reruns agree. Rows are
never gathered per source: the sums are combined on the map side, and the per-source table (a row a source) is joined
back: by a broadcast if its row count is small enough, else with skewed sources split by the join.

Defined cases: a null or blank text has size 0; a null source is a source of its own, the last; rows of one id
and text get one coin, so repeated rows are copied alike; a null id or text is hashed as an empty string. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage

# [^\x20\x09-\x0D]+
WORD = r"[^\x20\x09-\x0D]+"
DEFAULT_WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# A row of the per-source table is a name and three numbers.
BROADCAST_SOURCES = 10_000


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(key: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 of seed, key and the MD5 of the text."""
    own, content = (F.coalesce(c.cast("string"), F.lit("")) for c in (key, text))
    text = F.concat(F.lit(f"{seed}:"), own, F.lit(":"), F.md5(content.cast("binary")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def source_targets(sizes: DataFrame, weights: Sequence[float] = DEFAULT_WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in code-point order, null last, take the weights in turn. Targets share the sum of all sizes by weight; no
    target exceeds ``most`` times its source, and what is above is shared again by weight among the others. In order
    of cap by weight the capped sources come first, so one pass over the per-source rows finds the level.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    sources = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    by_cap = W.orderBy((F.col("source_size") * most / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, after, whole = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing), by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = sources.withColumn("level", level)
    # the level at the first source that stays at or under its cap holds for all after it; sources before it are capped
    fits = F.min(F.when(F.col("level") * F.col("weight") <= most * F.col("source_size"), F.struct((F.col("source_size") * most / F.col("weight")).alias("cap"), F.col("level").alias("level")))).over(whole)
    target = F.least((F.lit(most) * F.col("source_size")).cast("double"), F.coalesce(fits["level"] * F.col("weight"), F.lit(most) * F.col("source_size").cast("double")))
    levels = levels.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    return levels.select("source", "source_size", "target", rate.alias("rate"))


def _small(targets: DataFrame) -> DataFrame:
    """The per-source table, to be broadcast if it has at most ``BROADCAST_SOURCES`` rows; else the join shuffles."""
    targets = cut_lineage(targets)
    return F.broadcast(targets) if targets.count() <= BROADCAST_SOURCES else targets


def repeats(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 7, weights: Sequence[float] = DEFAULT_WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """Id, source and size of each document with ``source_size``, ``target``, ``rate`` and ``copies``, without texts."""
    draw = coin(F.col(f"`{key}`"), F.col(f"`{text}`"), seed)
    sizes = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), text_size(F.col(f"`{text}`")).alias("size"), draw.alias("coin"))
    targets = _small(source_targets(sizes, weights, most).withColumnRenamed("source", "of_source"))
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["of_source"])).drop("of_source")
    return joined.withColumn("copies", _copies(F.col("rate"), F.col("coin"))).drop("coin")


def _copies(rate: Column, drawn: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(drawn < rate - whole, 1).otherwise(0)).cast("long")


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 7, weights: Sequence[float] = DEFAULT_WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """The mix: the columns of ``docs``, each row as often as its source's rate and its coin say.

    Only the per-source table is joined to the rows, so texts are not shuffled as long as that table is small.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{source}`").alias("source"), coin(F.col(f"`{key}`"), F.col(f"`{text}`"), seed).alias("coin"))
    sizes = docs.select(F.col(f"`{source}`").alias("source"), text_size(F.col(f"`{text}`")).alias("size"))
    targets = _small(source_targets(sizes, weights, most).select(F.col("source").alias("of_source"), "rate"))
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
    copies = joined.withColumn("copies", _copies(F.col("rate"), F.col("coin"))).where("copies > 0")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
