"""Zero-complete stratified distributions with explicit denominators.

Member tables have one row per member (``expect.duplicate_keys`` says so), hence members are counted
as rows, which combines on the map side; only groups, which repeat, need a distinct count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladegrid.functions.scalars import CLASS_ORDER, cell_id, is_finite, label_or, label_or_null, safe_fraction
from cladegrid.operators.expect import union_all
from cladegrid.operators.grid import complete, pair_blocks, share_of_total, with_listed
from cladegrid.operators.joins import keyed_join

NOT_APPLICABLE = "NOT_APPLICABLE"


def unit_stratum_distribution(
    members: DataFrame, unit: str, stratum: str, member: str, units: Sequence[str] = ()
) -> DataFrame:
    """Members per (unit, stratum), zero-complete, with the unit total and fraction.

    Configured units appear even when nothing was observed in them.
    """
    rows = members.select(label_or(unit).alias(unit), label_or(stratum).alias(stratum), F.col(member))
    counts = rows.groupBy(unit, stratum).agg(F.count(member).alias("member_count"))
    observed = counts.select(unit).distinct()
    if units:
        listed = with_listed(members.sparkSession.range(1).select(), unit, units)
        observed = observed.unionByName(listed).distinct()
    grid = pair_blocks(observed, counts.select(stratum).distinct())
    cells = complete(counts, grid, [unit, stratum], ["member_count"])
    return share_of_total(cells, [unit], {"member_count": ("unit_total", "within_unit_fraction")})


def class_summary(
    classes: DataFrame, members: DataFrame, group: str, member: str, label: str, labels: Sequence[str] = CLASS_ORDER
) -> DataFrame:
    """Counts of the listed classes under two denominators: all groups, and all members.

    Labels outside the list count in neither denominator.
    """

    def counted(df: DataFrame, counting_unit: str, key: str) -> DataFrame:
        counts = df.where(F.col(label).isin(*labels)).groupBy(label).agg(F.count(key).alias("count"))
        grid = with_listed(df.sparkSession.range(1).select(), label, labels)
        cells = complete(counts, grid, [label], ["count"]).withColumn("counting_unit", F.lit(counting_unit))
        return share_of_total(cells, ["counting_unit"], {"count": ("denominator", "fraction")})

    both = counted(classes, "GROUP", group).unionByName(counted(members, "MEMBER", member))
    return both.select("counting_unit", label, "count", "denominator", "fraction")


def stratum_class_distribution(
    joined: DataFrame,
    stratum: str,
    label: str,
    member: str,
    group: str,
    strata: Sequence[str] | None = None,
    labels: Sequence[str] = CLASS_ORDER,
) -> DataFrame:
    """Members and groups per (stratum, class) with stratum totals and fractions.

    Strata are the given list or, without one, those observed; classes are always the list.
    """
    rows = joined.withColumns({stratum: label_or(stratum), label: label_or(label)})
    counts = rows.groupBy(stratum, label).agg(
        F.count(member).alias("member_count"), F.countDistinct(group).alias("group_count")
    )
    if strata is not None:
        base = with_listed(joined.sparkSession.range(1).select(), stratum, list(dict.fromkeys(strata)))
    else:
        base = counts.select(stratum).distinct()
    cells = complete(counts, with_listed(base, label, labels), [stratum, label], ["member_count", "group_count"])
    return share_of_total(
        cells,
        [stratum],
        {
            "member_count": ("stratum_member_total", "member_fraction"),
            "group_count": ("stratum_group_total", "group_fraction"),
        },
    )


def mode_by_strata(df: DataFrame, member: str, mode: str, levels: Mapping[str, str]) -> DataFrame:
    """Members per (stratum, mode) for several stratifications, stacked and zero-complete.

    ``levels`` maps the name of a stratification to its column. All levels are counted in one pass.
    """
    pairs = F.array(
        *[F.struct(F.lit(name).alias("stratification"), label_or(c).alias("stratum")) for name, c in levels.items()]
    )
    rows = df.select(F.col(member), label_or(mode).alias(mode), F.inline(pairs))
    counts = rows.groupBy("stratification", "stratum", mode).agg(F.count(member).alias("member_count"))
    grid = pair_blocks(counts.select("stratification", "stratum").distinct(), counts.select(mode).distinct())
    cells = complete(counts, grid, ["stratification", "stratum", mode], ["member_count"])
    return share_of_total(
        cells, ["stratification", "stratum"], {"member_count": ("stratum_total", "within_stratum_fraction")}
    )


def with_zscore(df: DataFrame, by: Sequence[str], value: str, z: str, status: str, eps: float = 1e-12) -> DataFrame:
    """Population z-score of a cell value across the cells of ``by``, with the reason when there is none.

    The input is a complete grid, so each partition has one row per cell.
    """
    finite = is_finite(value)
    usable = F.when(finite, F.col(value).cast("double"))
    window = Window.partitionBy(*by)
    mean, sd, n = F.avg(usable).over(window), F.stddev_pop(usable).over(window), F.count(usable).over(window)
    scored = df.withColumns({"_mean": mean, "_sd": sd, "_n": n})
    flat = F.col("_sd") <= F.lit(eps)
    reason = (
        F.when(~finite, F.lit("MISSING_DENOMINATOR"))
        .when(F.col("_n") < 2, F.lit("INSUFFICIENT_CELLS"))
        .when(flat, F.lit("ZERO_VARIANCE"))
        .otherwise(F.lit("PASS"))
    )
    score = F.when(F.col(status) == "ZERO_VARIANCE", F.lit(0.0)).when(
        F.col(status) == "PASS", (F.col(value) - F.col("_mean")) / F.col("_sd")
    )
    return scored.withColumn(status, reason).withColumn(z, score).drop("_mean", "_sd", "_n")


def _level_structs(levels: Mapping[str, Sequence[str]], dimensions: Sequence[str]) -> Column:
    """One struct per level: its name, whether the row has all its labels, and its labels."""
    structs = []
    for name, used in levels.items():
        eligible = reduce(lambda a, b: a & b, [F.col(d).isNotNull() for d in used])
        own_id = cell_id(list(used))
        labels = [(F.col(d) if d in used else F.lit(NOT_APPLICABLE)).alias(d) for d in dimensions]
        structs.append(
            F.struct(F.lit(name).alias("aggregation_level"), eligible.alias("_eligible"), own_id.alias("cell_id"), *labels)
        )
    return F.array(*structs)


class ElementDistribution:
    """Hits of elements over carriers with a length, aggregated into cells at several levels.

    ``carriers`` has one row per id with its length and labels; ``hits`` one row per hit. Labels that
    are missing exclude a carrier from the levels that need them, and only from those. Hits are
    reduced to one row per (carrier, element) before they meet the labels and the levels.
    """

    def __init__(self, hits: DataFrame, carriers: DataFrame, key: str, element: str, length: str,
                 dimensions: Sequence[str], levels: Mapping[str, Sequence[str]]) -> None:
        self.levels, self.dimensions, self.element = levels, list(dimensions), element
        labels = {d: label_or_null(d) for d in dimensions}
        known = carriers.select(key, F.col(length).alias("_length"), *dimensions).withColumns(labels)
        self._by_level = known.select(
            key, "_length", F.inline(_level_structs(levels, dimensions))
        )
        cell_keys = ["aggregation_level", "cell_id", *dimensions]
        eligible = self._by_level.where("_eligible")
        self.cells = eligible.groupBy(*cell_keys).agg(
            F.count("*").alias("n_carriers"), F.sum("_length").alias("total_length")
        )
        named = hits.select(key, label_or_null(element).alias(element)).where(F.col(element).isNotNull())
        per_carrier = named.groupBy(key, element).agg(F.count("*").alias("_hits"))
        self.elements = per_carrier.select(element).distinct()
        hit_levels = per_carrier.join(known.drop("_length"), key).select(
            element, "_hits", F.inline(_level_structs(levels, dimensions))
        )
        self.counts = (
            hit_levels.where("_eligible")
            .groupBy("aggregation_level", "cell_id", element)
            .agg(F.sum("_hits").alias("hit_count"), F.count("*").alias("carriers_with_hit"))
        )

    def distribution(self, per: float = 1000.0) -> DataFrame:
        """Complete cell x element grid with counts, rates per carrier and per ``per`` of length, z-scores."""
        grid = pair_blocks(self.cells, self.elements)
        keys = ["aggregation_level", "cell_id", self.element]
        cells = complete(self.counts, grid, keys, ["hit_count", "carriers_with_hit"])
        rates = cells.withColumns(
            {
                "hits_per_carrier": safe_fraction("hit_count", "n_carriers"),
                "hits_per_kb": safe_fraction("hit_count", F.col("total_length") / F.lit(per)),
            }
        )
        by = ["aggregation_level", self.element]
        scored = with_zscore(rates, by, "hit_count", "zscore_hit_count", "raw_zscore_status")
        scored = with_zscore(scored, by, "hits_per_kb", "zscore_hits_per_kb", "rate_zscore_status")
        return scored.select(
            "aggregation_level", "cell_id", *self.dimensions, self.element, "hit_count", "carriers_with_hit",
            "n_carriers", "total_length", "hits_per_carrier", "hits_per_kb", "zscore_hit_count",
            "raw_zscore_status", "zscore_hits_per_kb", "rate_zscore_status",
            F.lit("PER_ELEMENT_ACROSS_CELLS").alias("zscore_axis"), F.lit(0).cast("long").alias("zscore_ddof"),
        )

    def quality(self) -> DataFrame:
        """One row per level: carriers in and out, cells, elements, grid size and status."""
        carriers = self._by_level.groupBy("aggregation_level").agg(
            F.count("*").alias("total_carriers"), F.count_if("_eligible").alias("eligible_carriers")
        )
        cells = self.cells.groupBy("aggregation_level").agg(
            F.count("*").alias("n_cells"), F.count_if(F.col("total_length") <= 0).alias("cells_zero_length")
        )
        listed = with_listed(self.cells.sparkSession.range(1).select(), "aggregation_level", list(self.levels))
        joined = complete(carriers, listed, ["aggregation_level"], ["total_carriers", "eligible_carriers"])
        joined = complete(cells, joined, ["aggregation_level"], ["n_cells", "cells_zero_length"])
        n_elements = self.elements.agg(F.count("*")).scalar()
        required = F.create_map(*[F.lit(x) for n, d in self.levels.items() for x in (n, ",".join(d))])
        status = (
            F.when(F.col("eligible_carriers") == 0, F.lit("NO_ELIGIBLE_GENES"))
            .when(F.col("n_elements") == 0, F.lit("NO_ELEMENTS"))
            .when(F.col("cells_zero_length") > 0, F.lit("ZERO_PROMOTER_LENGTH"))
            .otherwise(F.lit("PASS"))
        )
        return joined.withColumn("n_elements", n_elements).select(
            "aggregation_level",
            required[F.col("aggregation_level")].alias("required_annotations"),
            "total_carriers",
            "eligible_carriers",
            (F.col("total_carriers") - F.col("eligible_carriers")).alias("excluded_missing_annotation"),
            "n_cells",
            "n_elements",
            (F.col("n_cells") * F.col("n_elements")).alias("complete_grid_rows"),
            "cells_zero_length",
            F.lit("PER_ELEMENT_ACROSS_CELLS").alias("zscore_axis"),
            F.lit(0).cast("long").alias("zscore_ddof"),
            status.alias("qc_status"),
        )


def ordered_matrix(
    df: DataFrame, index: str, column: str, value: str, order: Sequence[str], fill: float | None = None
) -> DataFrame:
    """Pivot into one double column per listed label; absent cells stay NULL or become ``fill``."""
    picks = [F.max(F.when(F.col(column) == label, F.col(value).cast("double"))).alias(label) for label in order]
    matrix = df.groupBy(index).agg(*picks)
    if fill is None:
        return matrix
    filled = [F.coalesce(F.col(f"`{c}`"), F.lit(float(fill))).alias(c) for c in order]
    return matrix.select(index, *filled)


def positive_slices(df: DataFrame, label: str, count: str = "count") -> DataFrame:
    """Only labels with a positive count, for composition charts."""
    return df.where(F.col(count) > 0).select(label, count)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label; order by count descending when shown."""
    return df.groupBy(label).agg(F.count("*").alias("count"))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames)


def membership_with_metadata(
    membership: DataFrame, classes: DataFrame, members: DataFrame, group: str, member: str, unit: str, label: str,
    extra: Sequence[str] = ("subfamily", "group"),
) -> DataFrame:
    """Membership rows with member labels and their group's class; missing labels become Unassigned."""
    for name in extra:
        if name not in members.columns:
            members = members.withColumn(name, F.lit(None).cast("string"))
    joined = membership.select(group, member, unit).join(members.select(member, *extra), member, "left")
    joined = keyed_join(joined, classes.select(group, label), [group], "left")
    return joined.withColumns({c: label_or(c) for c in (unit, *extra, label)})
