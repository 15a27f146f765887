"""Exact ranks, quantiles, prefix sums and suffix minima of groups of any size.

A window over a whole group would sort the group inside one task. Here equal values are first
counted (combined on the map side), the distinct values of large groups are cut into buckets at
split points taken from the data, and only bucket totals are accumulated per group; running sums
inside a bucket are added to the total of the buckets before it. Work is spread by (group, bucket)
and results are exact, whatever the distribution of the values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladegrid.operators.joins import attach_by_key, keyed_join

# A group is cut when it holds more than 1/SHARE of all points and more than SMALL of them, into
# buckets of about half that size. There are fewer than SHARE such groups, with some 2 * SHARE split
# points in all; that is the size bound of what is broadcast.
SHARE, SMALL = 1000, 10_000
# Points are drawn by a hash; every OVERSAMPLE-th of them splits, which evens the buckets out.
OVERSAMPLE = 16


def split_points(points: DataFrame, keys: Sequence[str], position: str, share: int = SHARE, small: int = SMALL) -> DataFrame:
    """(keys, _splits): ascending split points of the keys that are too large for one task.

    ``points`` has one row per (keys, position). The draw depends on the values alone, so the same
    points always have the same splits.
    """
    sizes = points.groupBy(*keys).agg(F.count("*").alias("_points"))
    most = F.greatest(F.lit(small), F.floor(sizes.agg(F.sum("_points")).scalar() / F.lit(share)))
    large = sizes.where(F.col("_points") > most).select(*keys, F.greatest(F.lit(1), F.floor(most / F.lit(2 * OVERSAMPLE))).alias("_every"))
    drawn = keyed_join(points.select(*keys, position), F.broadcast(large), keys, "inner")
    drawn = drawn.where(F.pmod(F.xxhash64(*keys, position), F.col("_every")) == 0)
    listed = drawn.groupBy(*keys).agg(F.array_sort(F.collect_list(position)).alias("_drawn"))
    return listed.select(*keys, F.filter("_drawn", lambda _, i: i % OVERSAMPLE == OVERSAMPLE - 1).alias("_splits"))


def _splits_up_to(splits: Column, value: Column) -> Column:
    """How many of the ascending split points are not above the value, by bisection."""
    steps = F.array(*[F.lit(1 << b) for b in range(15, -1, -1)])

    def step(at: Column, reach: Column) -> Column:
        return F.when(F.get(splits, at + reach - 1) <= value, at + reach).otherwise(at)

    return F.aggregate(steps, F.lit(0), step).cast("long")


def with_buckets(points: DataFrame, keys: Sequence[str], position: str, share: int = SHARE, small: int = SMALL) -> DataFrame:
    """Add ``_bucket``, which ascends with the position within a key; keys that fit a task have one bucket."""
    splits = split_points(points, keys, position, share, small)
    joined = keyed_join(points, F.broadcast(splits), keys, "left")
    bucket = F.coalesce(_splits_up_to(F.col("_splits"), F.col(position)), F.lit(0).cast("long"))
    return joined.withColumn("_bucket", bucket).drop("_splits")


def width_bucket_of(width: int):
    """Bucket function for integer coordinates: fixed-width bins."""
    return lambda position: F.floor(position / F.lit(width)).cast("long")


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """Rows per distinct value of a key; NULL and NaN values are left out."""
    number = F.col(value).cast("double")
    kept = df.where(number.isNotNull() & ~F.isnan(number)).select(*keys, number.alias(value))
    return kept.groupBy(*keys, value).agg(F.count("*").alias(count))


def running_before(
    points: DataFrame,
    keys: Sequence[str],
    position: str,
    sums: Mapping[str, str],
    bucket=None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add sums of columns over all smaller positions of the same key.

    ``points`` has one row per (keys, position). ``sums`` maps a column to the name of its sum over
    strictly smaller positions; ``totals`` optionally maps a column to the name of its key total.
    Positions are cut at split points, or by ``bucket`` (coordinates into bins of a width).
    """
    totals = totals or {}
    bucketed = with_buckets(points, keys, position) if bucket is None else points.withColumn("_bucket", bucket(F.col(position)))
    columns = sorted(set(sums) | set(totals))
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_s_{c}") for c in columns])
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(by_key).alias(name) for c, name in totals.items()],
    )
    joined = keyed_join(bucketed, offsets, [*keys, "_bucket"], "inner")
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    )
    return joined.select(
        *points.columns,
        *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(s) for c, s in sums.items()],
        *totals.values(),
    )


def rank_table(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per distinct value: ``n`` equal rows, ``n_before`` smaller rows, ``n_total`` and average rank."""
    counts = value_counts(df, keys, value)
    ranked = running_before(counts, keys, value, {"n": "n_before"}, totals={"n": "n_total"})
    return ranked.withColumn("avg_rank", F.col("n_before") + (F.col("n") + F.lit(1)) / F.lit(2.0))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float]) -> DataFrame:
    """Exact linearly interpolated quantiles per key: one column per ``name -> probability``.

    Only the buckets that contain a wanted rank are looked into.
    """
    counts = with_buckets(value_counts(df, keys, value), keys, value)
    per_bucket = counts.groupBy(*keys, "_bucket").agg(F.sum("n").alias("_in_bucket"))
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_bucket.withColumns(
        {
            "_offset": F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)),
            "_total": F.sum("_in_bucket").over(by_key),
        }
    )

    def position(p: float) -> Column:
        return (F.col("_total") - F.lit(1)) * F.lit(float(p))

    ranks = [r for p in wanted.values() for r in (F.floor(position(p)), F.ceil(position(p)))]
    needed = F.lit(False)
    for rank in ranks:
        needed = needed | ((rank >= F.col("_offset")) & (rank < F.col("_offset") + F.col("_in_bucket")))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed_join(counts, placed.where(needed).drop("_in_bucket"), [*keys, "_bucket"], "inner").withColumn(
        "_before", F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )

    def at(rank: Column) -> Column:
        here = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("n"))
        return F.max(F.when(here, F.col(value)))

    picked = ranked.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[at(F.floor(position(p))).alias(f"_lo_{name}") for name, p in wanted.items()],
        *[at(F.ceil(position(p))).alias(f"_hi_{name}") for name, p in wanted.items()],
    )

    def between(name: str, p: float) -> Column:
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        share = position(p) - F.floor(position(p))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * share).alias(name)

    return picked.select(*keys, *[between(name, p) for name, p in wanted.items()])


def minimum_from_here(points: DataFrame, keys: Sequence[str], position: str, value: str, name: str) -> DataFrame:
    """Add the least ``value`` over this and all larger positions of the same key.

    ``points`` has one row per (keys, position) and its ``_bucket``: bucket minima are carried down
    from the larger buckets, so only the positions of one bucket meet in a task.
    """
    lows = points.groupBy(*keys, "_bucket").agg(F.min(value).alias("_low"))
    later = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    carried = lows.select(*keys, "_bucket", F.min("_low").over(later).alias("_later"))
    joined = keyed_join(points, carried, [*keys, "_bucket"], "inner")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(position).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return joined.withColumn(name, F.least(F.min(value).over(inside), F.col("_later"))).drop("_later")


def adjusted_p_values(df: DataFrame, keys: Sequence[str], p: str, adjusted: str) -> DataFrame:
    """Benjamini-Hochberg adjustment of the p-values of each key, of any number; NULL and NaN ones stay without.

    Equal p-values are adjusted alike, so the work is done once per distinct value and joined back.
    """
    bucketed = with_buckets(value_counts(df, keys, p, "_n"), keys, p)
    ranked = running_before(bucketed, keys, p, {"_n": "_before"}, lambda _: F.col("_bucket"), {"_n": "_total"})
    scaled = ranked.withColumn("_scaled", F.col(p) * F.col("_total") / (F.col("_before") + F.col("_n")))
    lowest = minimum_from_here(scaled, keys, p, "_scaled", adjusted)
    per_value = lowest.select(*keys, p, "_n", F.least(F.lit(1.0), F.col(adjusted)).alias(adjusted))
    given = F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))
    tested = attach_by_key(df.where(given), per_value, [*keys, p], "_n").drop("_n")
    return tested.unionByName(df.where(~given).withColumn(adjusted, F.lit(None).cast("double")))
