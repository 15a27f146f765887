"""Sample values per member: status, long form, summaries and row z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import log2_plus_one
from cladegrid.operators.cumulative import quantiles
from cladegrid.operators.grid import pair_blocks
from cladegrid.operators.joins import attach_by_key, keyed_join


def wide_with_status(members: DataFrame, matrix: DataFrame, key: str, samples: Sequence[str]) -> DataFrame:
    """Members with their sample columns and how complete they are; members without a row stay."""
    joined = members.join(matrix.select(key, *[f"`{s}`" for s in samples]), key, "left")
    present = sum((F.when(F.col(f"`{s}`").isNotNull(), 1).otherwise(0) for s in samples), F.lit(0))
    status = (
        F.when(present == 0, F.lit("MISSING"))
        .when(present < len(samples), F.lit("PARTIAL_MISSING"))
        .otherwise(F.lit("AVAILABLE"))
    )
    return joined.withColumn("expression_data_status", status)


def long_from_wide(wide: DataFrame, ids: Sequence[str], samples: Sequence[str], threshold: float) -> DataFrame:
    """One row per member and sample with measurement status and detection call."""
    long = wide.unpivot(list(ids), [f"`{s}`" for s in samples], "sample_id", "expression_value")
    present = F.col("expression_value").isNotNull()
    return long.withColumns(
        {
            "measurement_status": F.when(present, "OBSERVED").otherwise("MISSING_IN_INPUT"),
            "detected": F.when(present, F.col("expression_value") >= F.lit(threshold)),
        }
    )


def long_from_abundance(
    members: DataFrame, samples: DataFrame, abundance: DataFrame, mapping: DataFrame, threshold: float,
    key: str = "stable_id", unit: str = "species_id", item: str = "gene_id", sample: str = "sample_id", value: str = "tpm",
) -> DataFrame:
    """Member x sample grid from per-sample abundances.

    Item ids are looked up only within the unit of their sample. A member measured nowhere in a sample
    of its own unit is an assayed zero; a sample of another unit is not applicable. ``samples`` is the sample sheet, a
    row per sample, and is sent to all tasks: few samples are few keys, and no task should hold one. Rows are summed
    once, after those of other units have gone.
    """
    placed = abundance.join(F.broadcast(samples.select(sample, unit)), sample)
    keyed = placed.join(mapping.select(unit, item, key), [unit, item])
    sums = keyed.groupBy(sample, key).agg(F.sum(value).alias("_v"))
    grid = pair_blocks(members, F.broadcast(samples.select(sample, F.col(unit).alias("sample_unit"))))
    cells = grid.join(sums, [sample, key], "left")
    applicable = F.col(unit) == F.col("sample_unit")
    status = (
        F.when(~applicable, F.lit("NOT_APPLICABLE"))
        .when(F.col("_v").isNotNull(), F.lit("MEASURED"))
        .otherwise(F.lit("ASSAYED_ZERO"))
    )
    found = F.when(applicable, F.coalesce(F.col("_v"), F.lit(0.0)))
    return cells.withColumns({"expression_value": found, "measurement_status": status}).select(
        *members.columns,
        sample,
        "sample_unit",
        "expression_value",
        "measurement_status",
        F.when(F.col("expression_value").isNotNull(), F.col("expression_value") >= F.lit(threshold)).alias("detected"),
    )


def summarize(long: DataFrame, ids: Sequence[str], with_assay_counts: bool = False) -> DataFrame:
    """Per member: samples available, detected count and fraction, median and maximum.

    Nothing detected and nothing measured both count 0, but the fraction is NULL without a measurement.
    """
    status = F.col("measurement_status") if with_assay_counts else None
    extra: list[Column] = []
    if status is not None:
        extra = [
            F.count_if(status == "MEASURED").alias("measured_samples"),
            F.count_if(status == "ASSAYED_ZERO").alias("assayed_zero_samples"),
        ]
    detected = F.col("detected").cast("int")
    summary = long.groupBy(*ids).agg(
        F.count("expression_value").alias("samples_available"),
        F.coalesce(F.sum(detected), F.lit(0)).alias("expression_detected_samples"),
        F.avg(detected).alias("expression_detected_fraction"),
        *extra,
        F.max("expression_value").alias("max_expression"),
    )
    medians = quantiles(long, list(ids), "expression_value", {"median_expression": 0.5})
    return keyed_join(summary, medians, list(ids), "left")


def row_zscores(long: DataFrame, key: str, value: str = "expression_value", z: str = "zscore_log2") -> DataFrame:
    """z-score of log2(x + 1) over the present samples of a member; a constant member scores 0."""
    rows = long.withColumn("_log", log2_plus_one(value))
    stats = rows.groupBy(key).agg(
        F.avg("_log").alias("_mean"), F.stddev_pop("_log").alias("_sd"), F.count("*").alias("_n")
    )
    joined = attach_by_key(rows, stats, [key], "_n")
    sd = F.when(F.col("_sd") == 0, F.lit(1.0)).otherwise(F.col("_sd"))
    return joined.withColumn(z, (F.col("_log") - F.col("_mean")) / sd).drop("_log", "_mean", "_sd", "_n")
