"""Non-parametric comparisons of groups on unit medians, with explicit reasons for withheld p-values.

Units (for instance species) are the replicates: each contributes one median per group and metric.
Rank sums come from distinct-value counts, so no list of values is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import numbers_of, strip
from cladegrid.functions.stats import EXACT_SIDE, chi_square_p, rank_sum_normal, rank_sum_tails
from cladegrid.operators.cumulative import adjusted_p_values, quantiles, rank_table, running_before, value_counts
from cladegrid.operators.expect import conflicting_assignments, duplicate_keys, union_all
from cladegrid.operators.grid import complete, pair_blocks, with_listed
from cladegrid.operators.joins import keyed_join
from cladegrid.session import cut_lineage

LOW_REPLICATION = 5  # fixed value: fewer units than this in a group is reported as low replication


class GroupComparison:
    """Global, pairwise and quality tables for metrics compared between the labels of ``group``."""

    def __init__(self, table: DataFrame, group: str, metrics: Sequence[str], *, unit: str = "species_id",
                 item: str = "stable_id", qc: str = "structure_qc", min_units: int = 2, alpha: float = 0.05) -> None:
        if min_units < 2:
            raise ValueError("min_units must be at least 2")
        if not 0 < alpha < 1:
            raise ValueError("alpha must be between 0 and 1")
        self.group_field, self.metrics, self.min_units, self.alpha = group, list(metrics), min_units, alpha
        self.table = table
        rows = table.where(F.col(qc) == "PASS") if qc in table.columns else table
        named = rows.withColumns({"_g": strip(F.col(group).cast("string")), "_u": strip(F.col(unit).cast("string"))})
        self.clean = named.where((F.col("_g") != "") & (F.col("_u") != ""))
        self._item = item
        values = F.array(*[F.struct(F.lit(m).alias("metric"), numbers_of(table, m).alias("value")) for m in metrics])
        long = self.clean.select(F.col(item).alias("_item"), "_g", "_u", F.inline(values))
        self.long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        # Units are what is left after reducing all rows; every table below starts from them, so they
        # are written once instead of being derived again by each.
        self.units = cut_lineage(quantiles(self.long, ["metric", "_u", "_g"], "value", {"unit_value": 0.5}))

    def violations(self) -> DataFrame:
        """Items assigned to several groups or units, or listed more than once."""
        conflicts = conflicting_assignments(self.clean, self._item, ["_u", "_g"])
        named = conflicts.select(
            F.lit("ONE_GROUP_PER_ITEM").alias("rule"), F.col(self._item).cast("string").alias("key"), F.lit("").alias("detail")
        )
        return union_all([named, duplicate_keys(self.clean, [self._item], "ONE_ROW_PER_ITEM")])

    def group_stats(self) -> DataFrame:
        """Per (metric, group): items, and medians of units and of items."""
        by = ["metric", "_g"]
        result = self.long.groupBy(*by).agg(F.countDistinct("_item").alias("n_items"))
        units = self.units.select(*by, F.lit("unit").alias("_kind"), F.col("unit_value").alias("value"))
        both = units.unionByName(self.long.select(*by, F.lit("item").alias("_kind"), "value"))
        medians = quantiles(both, [*by, "_kind"], "value", {"_m": 0.5})
        wide = medians.groupBy(*by).agg(
            *[F.max(F.when(F.col("_kind") == k, F.col("_m"))).alias(f"median_{k}") for k in ("unit", "item")]
        )
        return keyed_join(result, wide, by)

    def global_tests(self) -> DataFrame:
        """Kruskal-Wallis per metric over groups with enough units."""
        sizes = self.units.groupBy("metric", "_g").agg(F.count("*").alias("n_units"))
        eligible = sizes.where(F.col("n_units") >= self.min_units)
        units = keyed_join(self.units, eligible.select("metric", "_g"), ["metric", "_g"], "left_semi")
        ranks = rank_table(units, ["metric"], "unit_value")
        per_group = value_counts(units, ["metric", "_g"], "unit_value")
        ranked = keyed_join(per_group, ranks.drop("n"), ["metric", "unit_value"], "inner")
        sums = ranked.groupBy("metric", "_g").agg(
            F.sum(F.col("n") * F.col("avg_rank")).alias("_r"), F.sum("n").alias("_n")
        )
        spread = sums.groupBy("metric").agg(
            F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_sum_r"),
            F.sum("_n").alias("_total"),
            F.count("*").alias("n_groups_eligible"),
            F.min("_n").alias("_smallest"),
        )
        t = F.col("n").cast("double")
        ties = ranks.groupBy("metric").agg(
            F.sum(t * t * t - t).alias("_ties"), F.count("*").alias("_distinct")
        )
        observed = sizes.groupBy("metric").agg(
            F.count("*").alias("n_groups_observed"), F.sum("n_units").alias("n_unit_group_cells")
        )
        counts = self.long.groupBy("metric").agg(
            F.countDistinct("_item").alias("n_items"), F.countDistinct("_u").alias("n_units")
        )
        base = with_listed(self.table.sparkSession.range(1).select(), "metric", self.metrics)
        for part in (observed, counts, spread, ties):
            base = keyed_join(base, part, ["metric"], "left")
        zero = ["n_groups_observed", "n_unit_group_cells", "n_items", "n_units", "n_groups_eligible"]
        base = base.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})
        total = F.col("_total").cast("double")
        h = (F.lit(12.0) / (total * (total + 1)) * F.col("_sum_r") - F.lit(3.0) * (total + 1)) / (
            F.lit(1.0) - F.try_divide(F.col("_ties"), total * total * total - total)
        )
        few, flat = F.col("n_groups_eligible") < 2, F.col("_distinct") == 1
        scored = base.withColumn(
            "h_statistic", F.when(few, F.lit(None).cast("double")).when(flat, F.lit(0.0)).otherwise(h)
        )
        status = F.when(few, "INSUFFICIENT_GROUP_UNITS").when(flat, "ZERO_VARIANCE").otherwise("PASS")
        warning = (
            F.when(few, "INSUFFICIENT_SPECIES_REPLICATION")
            .when(flat, "NO_BETWEEN_UNIT_VARIATION")
            .when(F.col("_smallest") < LOW_REPLICATION, "LOW_SPECIES_REPLICATION")
            .otherwise("NONE")
        )
        p = F.when(few, F.lit(None).cast("double")).when(flat, F.lit(1.0)).otherwise(F.col("_p"))
        return scored.withColumn("_p", chi_square_p("h_statistic", F.col("n_groups_eligible") - 1)).select(
            F.lit(self.group_field.upper()).alias("comparison_scope"),
            F.lit(self.group_field).alias("group_field"),
            "metric",
            F.lit("SPECIES_MEDIAN").alias("analysis_unit"),
            F.lit("Kruskal-Wallis").alias("test_name"),
            "n_groups_observed",
            "n_groups_eligible",
            "n_items",
            "n_units",
            "n_unit_group_cells",
            F.lit(self.min_units).cast("long").alias("min_group_units"),
            "h_statistic",
            p.alias("p_value"),
            F.lit(self.alpha).alias("alpha"),
            status.alias("test_status"),
            warning.alias("inference_warning"),
            (F.coalesce(F.col("_smallest"), F.lit(LOW_REPLICATION)) < LOW_REPLICATION).alias("low_power_warning"),
        )

    def pair_statistics(self) -> DataFrame:
        """U of the first group, tie term and sizes for every pair of group labels of a metric."""
        labels = self.units.select("metric", "_g").distinct()
        counts = value_counts(self.units, ["metric", "_g"], "unit_value")
        other = labels.withColumnRenamed("_g", "_other")
        met = pair_blocks(counts, other, on=["metric"]).where(F.col("_g") != F.col("_other"))
        first = F.col("_g") < F.col("_other")
        keys = ["metric", "group_1", "group_2"]
        sided = met.select(
            "metric",
            F.least("_g", "_other").alias("group_1"),
            F.greatest("_g", "_other").alias("group_2"),
            "unit_value",
            F.when(first, F.col("n")).otherwise(0).alias("_n1"),
            F.when(first, F.lit(0)).otherwise(F.col("n")).alias("_n2"),
        )
        points = sided.groupBy(*keys, "unit_value").agg(F.sum("_n1").alias("_n1"), F.sum("_n2").alias("_n2"))
        running = running_before(points, keys, "unit_value", {"_n2": "_below"})
        t = (F.col("_n1") + F.col("_n2")).cast("double")
        return running.groupBy(*keys).agg(
            F.sum(F.col("_n1") * (F.col("_below") + F.col("_n2") / F.lit(2.0))).alias("u_statistic"),
            F.sum(t * t * t - t).alias("_ties"),
            F.sum("_n1").alias("n_units_1"),
            F.sum("_n2").alias("n_units_2"),
        )

    def pairwise_tests(self, global_tests: DataFrame | None = None) -> DataFrame:
        """Mann-Whitney U per pair of groups; p-values only after a significant global test."""
        overall = cut_lineage(self.global_tests() if global_tests is None else global_tests).select(
            "metric",
            F.col("p_value").alias("global_p_value"),
            F.col("test_status").alias("_status"),
            F.col("inference_warning").alias("_warning"),
        )
        stats = self.group_stats()
        result = keyed_join(self.pair_statistics(), overall, ["metric"], "inner")
        for side in ("1", "2"):
            named = stats.select(
                "metric",
                F.col("_g").alias(f"group_{side}"),
                F.col("n_items").alias(f"n_items_{side}"),
                F.col("median_item").alias(f"median_item_{side}"),
                F.col("median_unit").alias(f"median_unit_{side}"),
            )
            result = keyed_join(result, named, ["metric", f"group_{side}"], "left")
        few = F.least("n_units_1", "n_units_2") < self.min_units
        tested = (F.col("_status") == "PASS") & (F.col("global_p_value") < F.lit(self.alpha))
        status = F.when(few, "INSUFFICIENT_GROUP_UNITS").when(tested, "PASS").otherwise("SKIPPED_GLOBAL_NOT_SIGNIFICANT")
        warning = F.when(few, "INSUFFICIENT_SPECIES_REPLICATION").otherwise(F.col("_warning"))
        result = result.withColumns({"test_status": status, "inference_warning": warning})
        small, large = F.least("n_units_1", "n_units_2"), F.greatest("n_units_1", "n_units_2")
        exact = (small <= EXACT_SIDE) & (F.col("_ties") == 0) & (F.col("test_status") == "PASS")
        # one row per pair of groups; kept, as what follows starts from it several times
        result = cut_lineage(result.withColumns({"_m": F.when(exact, small), "_n": F.when(exact, large)}))
        # sizes that occur with small groups and no ties have their whole table of tails, once for all pairs
        tails = rank_sum_tails(result.where("_m is not null").select(F.col("_m").alias("m"), F.col("_n").alias("n")).distinct())
        u, m, n = F.col("u_statistic"), F.col("n_units_1"), F.col("n_units_2")
        larger = F.greatest(u, m * n - u).cast("long")
        met = (F.col("_m") == F.col("m")) & (F.col("_n") == F.col("n")) & (larger == F.col("u"))
        p_value = F.when(F.col("_m").isNotNull(), F.col("p")).otherwise(rank_sum_normal(u, m, n, F.col("_ties")))
        result = result.join(tails, met, "left").withColumn("p_value", F.when(F.col("test_status") == "PASS", p_value))
        result = cut_lineage(result.drop("_m", "_n", "m", "n", "u", "p"))
        adjusted = adjusted_p_values(result, ["metric"], "p_value", "p_adjusted_bh")
        effect = F.lit(2.0) * F.col("u_statistic") / (F.col("n_units_1") * F.col("n_units_2")) - F.lit(1.0)
        return adjusted.select(
            F.lit(self.group_field.upper()).alias("comparison_scope"),
            F.lit(self.group_field).alias("group_field"),
            "metric",
            F.lit("SPECIES_MEDIAN").alias("analysis_unit"),
            "group_1", "group_2", "n_items_1", "n_items_2", "n_units_1", "n_units_2",
            "median_item_1", "median_item_2", "median_unit_1", "median_unit_2",
            (F.col("median_unit_1") - F.col("median_unit_2")).alias("median_unit_difference"),
            effect.alias("rank_biserial_effect"),
            F.lit("Mann-Whitney U").alias("test_name"),
            "u_statistic", "global_p_value", "p_value", "p_adjusted_bh",
            F.lit(self.alpha).alias("alpha"),
            "test_status", "inference_warning",
        )

    def quality(self, global_tests: DataFrame | None = None) -> DataFrame:
        """Rows in, kept and excluded per metric with the status of its global test."""
        overall = self.global_tests() if global_tests is None else global_tests
        kept = self.long.groupBy("metric").agg(F.count("*").alias("eligible_item_rows"))
        named = complete(kept, overall, ["metric"], ["eligible_item_rows"])
        rows = self.table.agg(F.count("*")).scalar()
        return named.withColumn("input_item_rows", rows).select(
            "comparison_scope",
            "group_field",
            "metric",
            "input_item_rows",
            "eligible_item_rows",
            (F.col("input_item_rows") - F.col("eligible_item_rows")).alias("excluded_item_rows"),
            F.col("n_groups_observed").alias("observed_groups"),
            F.col("n_groups_eligible").alias("eligible_groups"),
            F.col("n_unit_group_cells").alias("eligible_unit_group_cells"),
            "min_group_units",
            F.lit("SPECIES_MEDIAN").alias("inference_unit"),
            F.col("test_status").alias("qc_status"),
            "inference_warning",
            "low_power_warning",
        )


def inference_note(units: DataFrame, keys: Sequence[str], group: str, value: str, min_units: int = 2) -> DataFrame:
    """Text per key that keeps a descriptive panel honest; empty when nothing needs saying."""
    is_finite = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    finite = units.where(is_finite)
    per_group = units.groupBy(*keys, group).agg(F.count(F.when(is_finite, F.col(value))).alias("_n"))
    sizes = per_group.groupBy(*keys).agg(F.min("_n").alias("_least"))
    span = finite.groupBy(*keys).agg((F.max(value) - F.min(value)).alias("_span"))
    joined = keyed_join(sizes, span, list(keys), "left")
    flat = F.col("_span") == 0
    note = F.concat_ws(
        "\n",
        F.when(
            F.col("_least") < min_units, F.lit(f"Inference withheld: <{min_units} species units in at least one group")
        ),
        F.when(flat, F.lit("No between-unit variation")).when(
            F.col("_least") < LOW_REPLICATION,
            F.lit(f"Low species replication: <{LOW_REPLICATION} units in at least one group"),
        ),
    )
    return joined.select(*keys, note.alias("inference_note"))
