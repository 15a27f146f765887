"""Descriptive statistics of metrics within strata, exact for strata of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import as_col
from cladegrid.operators.cumulative import quantiles
from cladegrid.operators.joins import keyed_join

QUARTILES: Mapping[str, float] = {"median": 0.5, "q1": 0.25, "q3": 0.75}


def stratified_metrics(
    df: DataFrame, strata: Mapping[str, Column | str], metrics: Mapping[str, Column | str]
) -> DataFrame:
    """Long form: one row per (input row, stratification, metric), labels and values as given."""
    levels = F.array(
        *[
            F.struct(F.lit(name).alias("stratification"), as_col(c).cast("string").alias("stratum"))
            for name, c in strata.items()
        ]
    )
    values = F.array(
        *[F.struct(F.lit(name).alias("metric"), as_col(c).cast("double").alias("value")) for name, c in metrics.items()]
    )
    return df.select(levels.alias("_levels"), F.inline(values)).select("metric", "value", F.inline("_levels"))


def describe(long: DataFrame, keys: Sequence[str], value: str = "value", keep_empty: bool = True) -> DataFrame:
    """n, mean, sd (n-1), min, max and quartiles per key; NULL keys are kept as a stratum.

    With ``keep_empty`` a key without any value stays with n = 0 and NULL statistics.
    """
    clean = long.select(*keys, F.when(~F.isnan(value), F.col(value)).alias(value))
    moments = clean.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.when(F.count(value) > 1, F.stddev_samp(value)).alias("sd"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )
    result = keyed_join(moments, quantiles(clean, keys, value, QUARTILES), list(keys), "left")
    return result if keep_empty else result.where(F.col("n") > 0)


def per_end_medians(pairs: DataFrame, ends: Sequence[str], key: str, metrics: Sequence[str], counted: str) -> DataFrame:
    """Roll pairs up to their ends: number of pairs with ``counted`` and median of each metric."""
    sides = F.array(*[F.col(e) for e in ends])
    rows = pairs.select(F.explode(sides).alias(key), *metrics)
    result = rows.groupBy(key).agg(F.count(counted).alias("pair_count"))
    values = F.array(*[F.struct(F.lit(m).alias("_metric"), F.col(m).cast("double").alias("_value")) for m in metrics])
    medians = quantiles(rows.select(key, F.inline(values)), [key, "_metric"], "_value", {"_median": 0.5})
    wide = medians.groupBy(key).agg(
        *[F.max(F.when(F.col("_metric") == m, F.col("_median"))).alias(f"median_{m}") for m in metrics]
    )
    return keyed_join(result, wide, [key], "left")
