"""Constrained pairs of members, their merged provenance and their strata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import pair_stratum, ratio_or_infinity
from cladegrid.operators.describe import describe, stratified_metrics
from cladegrid.operators.joins import annotate_pair_ends
from cladegrid.operators.ranking import first_n_per_key

SINGLE_COPY_TYPE = "orthology_single_copy_to_reference"
DESCRIPTIVE_ONLY = "DESCRIPTIVE_ONLY_NONINDEPENDENT_PAIRS"


def _arrival(source: int, group, unit, member, file=None, block=None, row=None) -> Column:
    """The place at which a pair arrived, comparable over all sources."""
    numbers = [F.lit(0) if n is None else n for n in (file, block, row)]
    named = [F.lit(source).alias("source"), group.alias("group"), unit.alias("unit"), member.alias("member")]
    return F.struct(*named, *[n.cast("long").alias(name) for n, name in zip(numbers, ("file", "block", "row"))]).alias("arrival")


def single_copy_pairs(membership: DataFrame, group: str, unit: str, member: str, reference: str) -> DataFrame:
    """Reference member paired with the member of every other unit, where both have exactly one.

    A (group, unit) has one member when its smallest is its largest: one aggregation, in which repeated rows do no
    harm. So what meets in the join has one row per unit. Pairs arrive by group, then unit, then member.
    """
    single = (
        membership.groupBy(group, unit)
        .agg(F.min(member).alias(member), F.max(member).alias("_last"))
        .where(F.col(member) == F.col("_last"))
        .drop("_last")
    )
    anchors = single.where(F.col(unit) == reference).select(group, F.col(member).alias("_anchor"))
    others = single.where(F.col(unit) != reference)
    return others.join(anchors, group).select(
        F.col("_anchor").alias("left_id"),
        F.col(member).alias("right_id"),
        F.lit(SINGLE_COPY_TYPE).alias("pair_type"),
        F.col(group).cast("string").alias("group_id"),
        _arrival(0, F.col(group).cast("string"), F.col(unit).cast("string"), F.col(member).cast("string")),
    )


def listed_pairs(pairs: DataFrame, left: str, right: str, mode: str, unit: str, ordinal: str) -> DataFrame:
    """Given pairs (for instance by duplication mode) in the common pair form, after the single-copy ones.

    ``ordinal`` is a number, or a place as ``sources.order`` gives it.
    """
    placed = dict(pairs.dtypes)[ordinal].startswith("struct")
    numbers = [F.col(ordinal)[part] for part in ("file", "block", "row")] if placed else [F.lit(0), F.lit(0), F.col(ordinal)]
    return pairs.select(
        F.col(left).alias("left_id"),
        F.col(right).alias("right_id"),
        F.concat(F.lit("duplication_"), F.coalesce(F.col(mode), F.lit("unknown"))).alias("pair_type"),
        F.coalesce(F.col(unit).cast("string"), F.lit("")).alias("group_id"),
        _arrival(1, *[F.lit("")] * 3, *numbers),
    )


def merge_pairs(
    sources: Sequence[DataFrame], known: DataFrame | None = None, member: str = "stable_id", max_per_group: int | None = None
) -> DataFrame:
    """Unordered distinct pairs; types and their groups are packed in arrival order.

    Self pairs and pairs with an unknown end are dropped. A pair gets one entry per distinct type, so
    the packed list is as long as there are types, however often the pair was listed.
    """
    rows = reduce(lambda a, b: a.unionByName(b), sources).where(F.col("left_id") != F.col("right_id"))
    for end in ("left_id", "right_id") if known is not None else ():
        rows = rows.join(known.select(F.col(member).alias(end)), end, "left_semi")
    ordered = rows.select(
        F.least("left_id", "right_id").alias("stable_id_1"),
        F.greatest("left_id", "right_id").alias("stable_id_2"),
        "pair_type",
        F.struct("arrival", "group_id").alias("_first"),
    )
    ends = ["stable_id_1", "stable_id_2"]
    per_type = ordered.groupBy(*ends, "pair_type").agg(F.min("_first").alias("_first"))
    entry = F.struct(F.col("_first.arrival").alias("a"), F.col("pair_type").alias("t"), F.col("_first.group_id").alias("g"))
    merged = per_type.groupBy(*ends).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    packed = merged.select(
        *ends,
        F.array_join(F.transform("_e", lambda e: e["t"]), ";").alias("pair_type"),
        F.array_join(F.transform("_e", lambda e: e["g"]), ";").alias("group_id"),
        F.element_at("_e", 1)["a"].alias("_arrival"),
    )
    if max_per_group is not None:
        packed = first_n_per_key(packed, ["pair_type", "group_id"], ["_arrival", *ends], max_per_group)
    return packed.drop("_arrival")


def with_strata(pairs: DataFrame, meta: DataFrame, key: str, strata: Mapping[str, str], ends=("stable_id_1", "stable_id_2")) -> DataFrame:
    """Both ends' labels plus one symmetric stratum per label; ``strata`` maps label to stratum column."""
    return strata_of_ends(annotate_pair_ends(pairs, meta.select(key, *strata), ends[0], ends[1], key), strata)


def strata_of_ends(annotated: DataFrame, strata: Mapping[str, str]) -> DataFrame:
    """Symmetric strata of pairs whose ends carry their labels under ``_1`` and ``_2`` already."""
    return annotated.withColumns({target: pair_stratum(f"{c}_1", f"{c}_2") for c, target in strata.items()})


def summarize_strata(pairs: DataFrame, strata: Mapping[str, str], metrics: Sequence[str]) -> DataFrame:
    """n, median, quartiles and range of every metric in every stratum of every stratification.

    Pairs share members, so the summary is descriptive and says so.
    """
    long = stratified_metrics(pairs, strata, {m: m for m in metrics})
    keys = ["stratification", "stratum", "metric"]
    return describe(long, keys).select(
        *keys,
        F.col("n").alias("n_pairs"),
        "median", "q1", "q3", "minimum", "maximum",
        F.lit(DESCRIPTIVE_ONLY).alias("inference_status"),
    )


def box_statistics(pairs: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    """Five-number summaries per label for box plots; labels without a value are left out."""
    long = stratified_metrics(pairs, {by: by}, {m: m for m in metrics})
    summary = describe(long, ["stratum", "metric"], keep_empty=False)
    return summary.select(F.col("stratum").alias(by), "metric", "n", "minimum", "q1", "median", "q3", "maximum")


def with_ratio(estimates: DataFrame, ka: str, ks: str, ratio: str | None) -> DataFrame:
    """Ka, Ks and their ratio: the given one where present, else the quotient (infinite for Ks = 0)."""
    quotient = ratio_or_infinity(ka, ks)
    return estimates.withColumn("Ka_Ks", quotient if ratio is None else F.coalesce(F.col(ratio).cast("double"), quotient))
