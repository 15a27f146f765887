"""Group occupancy over units: who is present where, in how many copies, and what class that makes.

A membership is a table of distinct (group, unit, member) rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import occupancy_class, safe_fraction, split_multi
from cladegrid.operators.joins import attach_by_key


def membership_from_wide(wide: DataFrame, group: str, units: Sequence[str], members: DataFrame | None = None,
                         member: str = "stable_id", unit: str = "species_id") -> DataFrame:
    """Wide group table (one column per unit, packed ids in cells) -> distinct long membership.

    Only ids in ``members`` are kept when given, so groups without one of them disappear.
    """
    if len(set(units)) != len(units):
        raise ValueError("units are not unique")
    missing = [u for u in units if u not in wide.columns]
    if missing:
        raise ValueError("units missing from the group table: " + ", ".join(missing))
    cells = wide.unpivot([group], [f"`{u}`" for u in units], unit, "_cell")
    items = cells.select(group, unit, F.explode(split_multi("_cell")).alias(member))
    if members is not None:
        items = items.join(members.select(member), member, "left_semi")
    return items.select(group, unit, member).distinct()


def copies_per_unit(membership: DataFrame, group: str, unit: str, member: str) -> DataFrame:
    """Members per (group, unit) of a distinct membership."""
    return membership.groupBy(group, unit).agg(F.count(member).alias("copies"))


def classify_groups(
    membership: DataFrame,
    group: str,
    unit: str,
    member: str,
    units: Sequence[str],
    core: float = 0.99,
    soft: float = 0.90,
    shell: float = 0.10,
    labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per group: occupancy, fractions, copy numbers and occupancy class."""
    n_units = F.lit(len(units))
    copies = copies_per_unit(membership.where(F.col(unit).isin(*units)), group, unit, member)
    per_group = copies.groupBy(group).agg(
        F.count("*").alias("unit_occupancy"),
        F.sum("copies").alias("member_count"),
        F.max("copies").alias("max_copy_number"),
        F.count_if(F.col("copies") == 1).alias("_single"),
    )
    fraction = safe_fraction("unit_occupancy", n_units)
    return per_group.select(
        group,
        *[F.lit(value).alias(name) for name, value in (labels or {}).items()],
        "unit_occupancy",
        fraction.alias("unit_fraction"),
        "member_count",
        safe_fraction("member_count", "unit_occupancy").alias("mean_copies_in_present_units"),
        "max_copy_number",
        safe_fraction("_single", n_units).alias("single_copy_unit_fraction"),
        occupancy_class(fraction, core, soft, shell).alias("occupancy_class"),
        (F.col("unit_occupancy") == 1).alias("is_private"),
    )


def with_copies(membership: DataFrame, group: str, unit: str, member: str) -> DataFrame:
    """Membership rows plus the number of members of their (group, unit)."""
    rows = membership.select(group, unit, member)
    counts = rows.groupBy(group, unit).agg(F.count("*").alias("copies_in_unit"))
    return attach_by_key(rows, counts, [group, unit], "copies_in_unit")


def presence_matrix(membership: DataFrame, group: str, unit: str, units: Sequence[str]) -> DataFrame:
    """One 0/1 column per unit, in the given order."""
    flags = [F.max(F.when(F.col(unit) == u, 1).otherwise(0)).cast("long").alias(u) for u in units]
    return membership.where(F.col(unit).isin(*units)).groupBy(group).agg(*flags)
