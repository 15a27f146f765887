"""First rows per key in a total order.

All of these filter ``row_number`` by a constant, which Spark turns into a group limit below the
exchange: every map task forwards at most n rows per key, so a heavy key never travels whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this n Spark keeps no group limit below the exchange, so rows are limited per task first.
PUSHED_LIMIT = 1000


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    order = list(order)
    if n > PUSHED_LIMIT:
        local = Window.partitionBy(*keys, "_task").orderBy(*order)
        tasked = df.withColumn("_task", F.pmod(F.xxhash64(*df.columns), F.lit(1024)))
        df = tasked.withColumn("_n", F.row_number().over(local)).where(F.col("_n") <= n).drop("_n", "_task")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n).drop("_n")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order`` (end it with an ordinal to make ties certain)."""
    return first_n_per_key(df, keys, order, 1)


def top_labels(df: DataFrame, label: str, n: int, count: str = "count") -> DataFrame:
    """The n most frequent labels, ties by label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias(count))
    return counts.orderBy(F.col(count).desc(), label).limit(n)


def top_by_sum(df: DataFrame, label: str, value: str, n: int, total: str = "total") -> DataFrame:
    """The n labels with the largest sum of ``value``, ties by label."""
    sums = df.groupBy(label).agg(F.sum(value).alias(total))
    return sums.orderBy(F.col(total).desc(), label).limit(n)


def natural_name_order(name: str) -> list[Column]:
    """Sort keys that put ``chr2`` before ``chr10``: shorter names first, then by name."""
    return [F.length(name), F.col(name)]


def longest_per_parent(items: DataFrame, parent: str, item: str, length: str) -> DataFrame:
    """One item per parent: the longest, ties by smallest id."""
    return first_per_key(items.where(F.col(length).isNotNull()), [parent], [F.col(length).desc(), F.col(item)])
