"""Keyed joins: null-safe equality, skew-safe lookups, both-ends annotation, wide integration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.operators.expect import duplicate_keys
from cladegrid.operators.ranking import first_per_key

# A key is heavy when it holds more than 1/HEAVY_SHARE of the rows, so there are fewer than
# HEAVY_SHARE heavy keys whatever the data: that is the size bound of what is broadcast below.
HEAVY_SHARE = 1000


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on same-named keys where NULL equals NULL; keeps the left keys once."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def checked_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], one_to_one: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(left join, violations): right keys must be unique, and left ones too for one to one."""
    violations = duplicate_keys(right, on, "RIGHT_KEY_UNIQUE")
    if one_to_one:
        violations = violations.unionByName(duplicate_keys(left, on, "LEFT_KEY_UNIQUE"))
    return left.join(right, list(on), "left"), violations


def attach_by_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Join per-key aggregates back to the rows they came from, without gathering a heavy key.

    ``per_key`` has one row per key and ``n``, the number of rows of that key. Rows of heavy keys
    meet their aggregate in a broadcast join and stay where they are; only the rest is shuffled.
    """
    total = per_key.agg(F.sum(n)).scalar()
    heavy = per_key.where(F.col(n) * F.lit(HEAVY_SHARE) > total)
    in_place = keyed_join(rows, F.broadcast(heavy), keys, "inner")
    rest = keyed_join(rows, F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return in_place.unionByName(keyed_join(rest, per_key, keys, "inner"))


def annotate_pair_ends(pairs: DataFrame, meta: DataFrame, first: str, second: str, key: str) -> DataFrame:
    """Attach the same metadata to both ends of a pair under ``_1`` and ``_2`` suffixes."""
    result = annotate_end(annotate_end(pairs, meta, first, key, "1"), meta, second, key, "2")
    return result.select(*pairs.columns, *[c for c in result.columns if c not in pairs.columns])


def annotate_end(rows: DataFrame, meta: DataFrame, end: str, key: str, suffix: str) -> DataFrame:
    """Attach metadata to one end under a suffix; where each end has a table of its own, before the pairs are formed."""
    side = meta.select(F.col(key).alias(end), *[F.col(c).alias(f"{c}_{suffix}") for c in meta.columns if c != key])
    return rows.join(side, end, "left")


def integrate(
    base: DataFrame,
    tables: Sequence[tuple[DataFrame | None, str, Sequence[str]]],
    key: str,
) -> DataFrame:
    """Left-join module tables to ``base`` one after the other.

    Each entry is ``(table, suffix, order)``: absent tables are skipped, repeated keys keep the first
    row by ``order``, and columns already present get the suffix.
    """
    result = base
    for table, suffix, order in tables:
        if table is None or key not in table.columns:
            continue
        unique = first_per_key(table, [key], order) if order else table
        taken = set(result.columns) - {key}
        renamed = unique.select(*[F.col(c).alias(c + suffix if c in taken else c) for c in unique.columns])
        result = result.join(renamed, key, "left")
    return result


def last_wins_lookup(df: DataFrame, lookup: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Left join against a lookup in which a later row replaces an earlier one of the same key."""
    latest = first_per_key(lookup, [key], [F.col(ordinal).desc()]).drop(ordinal)
    return df.join(latest, key, "left")


def fallback_lookup(df: DataFrame, preferred: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill columns from ``preferred`` where it knows the key, else keep the row's own values."""
    side = preferred.select(key, *[F.col(c).alias(f"_p_{c}") for c in columns], F.lit(True).alias("_known"))
    joined = df.join(side, key, "left")
    filled = {c: F.when(F.col("_known"), F.col(f"_p_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(filled).drop("_known", *[f"_p_{c}" for c in columns])


def unassigned_rows(rows: DataFrame, assigned: DataFrame, key: str, labels: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs nowhere in ``assigned``, with constant provenance columns."""
    missing = rows.join(assigned.select(key), key, "left_anti").select(*rows.columns)
    return missing.withColumns({name: F.lit(value) for name, value in labels.items()})


def explode_parents(features: DataFrame, parent: str = "parent") -> DataFrame:
    """One row per parent of a feature whose parent cell lists several, comma-separated."""
    each = F.explode(F.filter(F.split(F.col(parent), ","), lambda p: p != ""))
    return features.select(*[c for c in features.columns if c != parent], each.alias(parent))
