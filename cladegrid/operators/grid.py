"""Zero-complete grids: every combination of dimension values, absent counts as 0.

The rows of a grid are its result, so their number is given. What matters is how they are made:
listed dimensions are exploded from a literal array, and two data-derived dimensions are paired
block by block through an equi-join, so that neither side has to fit anywhere as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladegrid.functions.scalars import safe_fraction
from cladegrid.operators.joins import keyed_join

BLOCKS = 4


def pair_blocks(left: DataFrame, right: DataFrame, on: Sequence[str] = (), blocks: int = BLOCKS) -> DataFrame:
    """Combine every left row with every right row that agrees on ``on``, in blocks x blocks pieces."""

    def sided(df: DataFrame, own: str, other: str) -> DataFrame:
        number = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(blocks)).cast("int")
        return df.withColumn(own, number).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    keys = ["_block_l", "_block_r", *on]
    a, b = sided(left, "_block_l", "_block_r"), sided(right, "_block_r", "_block_l")
    return a.join(b, keys).select(*on, *[c for c in left.columns + right.columns if c not in on])


def with_listed(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Every row once per listed value."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def complete(counts: DataFrame, grid: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left-join counts to a grid; missing cells become 0."""
    joined = keyed_join(grid, counts.select(*keys, *values), keys, "left")
    return joined.withColumns({v: F.coalesce(F.col(v), F.lit(0)).cast("long") for v in values})


def share_of_total(
    df: DataFrame, within: Sequence[str], shares: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Add the total of each value column over ``within`` and the row's fraction of it.

    ``shares`` maps a value column to the names of its total and its fraction. The table is a grid of
    counts, so a partition holds one row per cell of the other dimensions.
    """
    window = Window.partitionBy(*within)
    totals = {total: F.sum(value).over(window) for value, (total, _) in shares.items()}
    fractions = {fraction: safe_fraction(value, total) for value, (total, fraction) in shares.items()}
    return df.withColumns(totals).withColumns(fractions)
