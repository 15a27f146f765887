"""Data-quality rules. Each returns a table of violations; ``enforce`` runs many in one job.

Violation columns: ``rule``, ``key`` (text of the offending key) and ``detail``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import is_finite


class QualityError(ValueError):
    """Raised when enforced rules have violations; the message shows examples."""


def _violations(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.alias("key"), detail.alias("detail"))


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str], rule: str = "UNIQUE_KEY") -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return _violations(counts, rule, _key_text(keys), F.concat(F.lit("rows="), F.col("_n").cast("string")))


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "table") -> None:
    """Checked on the schema alone; no job is run."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{label} lacks required columns: {', '.join(missing)}")


def unknown_keys(df: DataFrame, parent: DataFrame, key: str, rule: str = "KNOWN_KEY") -> DataFrame:
    missing = df.select(key).distinct().join(parent.select(key), key, "left_anti")
    return _violations(missing, rule, _key_text([key]), F.lit("absent from parent table"))


def outside_domain(
    df: DataFrame,
    column: str,
    key: str,
    rule: str = "VALUE_DOMAIN",
    nullable: bool = True,
    minimum: float | None = 0.0,
    allowed: Sequence[str] | None = None,
) -> DataFrame:
    """Values that are not finite, below ``minimum`` or not among ``allowed``; NULL if not nullable."""
    value = F.col(column)
    if allowed is not None:
        good = value.isin(*allowed)
    else:
        number = value.cast("double")
        good = is_finite(value) & (F.lit(True) if minimum is None else number >= F.lit(minimum))
    bad = value.isNull() if not nullable else F.lit(False)
    broken = df.where(bad | (value.isNotNull() & ~good))
    detail = F.concat(F.lit(f"{column}="), F.coalesce(value.cast("string"), F.lit("NULL")))
    return _violations(broken, rule, _key_text([key]), detail)


def inconsistent(
    left: DataFrame, right: DataFrame, on: str, column: str, rule: str = "CONSISTENT_VALUE"
) -> DataFrame:
    """Keys present on both sides whose ``column`` differs (both values known)."""
    other = right.select(on, F.col(column).alias("_other"))
    differing = left.select(on, column).join(other, on).where(F.col(column) != F.col("_other"))
    detail = F.concat(F.col(column).cast("string"), F.lit(" <> "), F.col("_other").cast("string"))
    return _violations(differing, rule, _key_text([on]), detail)


def prefix_mismatch(df: DataFrame, key: str, unit: str, separator: str = "__") -> DataFrame:
    """Ids that carry a unit prefix other than the unit they are listed under."""
    head = F.substring_index(F.col(key), separator, 1)
    broken = df.where(F.contains(F.col(key), F.lit(separator)) & (head != F.col(unit)))
    return _violations(broken, "PREFIX_IS_UNIT", _key_text([key]), F.concat(F.lit("listed under "), F.col(unit)))


def ambiguous_mapping(ids: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Ids that do not map to exactly one target."""
    targets = mapping.groupBy(source).agg(F.countDistinct(target).alias("_n"))
    counted = ids.select(source).distinct().join(targets, source, "left")
    broken = counted.where(F.coalesce(F.col("_n"), F.lit(0)) != 1)
    detail = F.concat(F.lit("targets="), F.coalesce(F.col("_n"), F.lit(0)).cast("string"))
    return _violations(broken, "UNIQUE_MAPPING", _key_text([source]), detail)


def conflicting_assignments(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys assigned to more than one value of a column: ``key, n_<column>..., row_count``."""
    counts = df.groupBy(key).agg(
        *[F.countDistinct(c).alias(f"n_{c}") for c in columns], F.count("*").alias("row_count")
    )
    broken = reduce(lambda a, b: a | b, [F.col(f"n_{c}") > 1 for c in columns])
    return counts.where(broken)


def empty_result(df: DataFrame, message: str) -> DataFrame:
    """One violation when the table has no row."""
    count = df.limit(1).agg(F.count("*").alias("_n")).where("_n = 0")
    return _violations(count, "NON_EMPTY", F.lit(""), F.lit(message))


def hierarchy_violations(features: DataFrame, file: str | None = None) -> DataFrame:
    """Rules of a gene -> transcript -> part annotation, with ``feature``, ``id`` and ``parent`` columns."""
    scope = [file] if file else []
    kind = F.lower("feature")
    is_transcript = kind.isin(*TRANSCRIPT_FEATURES)
    rows = features.withColumn("_kind", kind)
    genes = rows.where(kind == "gene")
    transcripts = rows.where(is_transcript)
    parts = rows.where((kind != "gene") & ~is_transcript & F.col("parent").isNotNull())
    n_parents = F.size(F.filter(F.split("parent", ","), lambda p: p != ""))
    raw_id = F.coalesce(F.col("id"), F.lit(""))

    def absent(children: DataFrame, parents: DataFrame, rule: str) -> DataFrame:
        known = parents.select(*scope, F.col("id").alias("parent"))
        return _violations(children.join(known, [*scope, "parent"], "left_anti"), rule, raw_id, F.col("parent"))

    single = n_parents == 1
    return union_all(
        [
            _violations(genes.where(raw_id == ""), "GENE_ID_REQUIRED", raw_id, F.lit("")),
            duplicate_keys(genes.where(raw_id != ""), [*scope, "id"], "GENE_ID_UNIQUE"),
            _violations(
                transcripts.where((raw_id == "") | F.col("parent").isNull()), "TRANSCRIPT_ID_AND_PARENT", raw_id, F.lit("")
            ),
            duplicate_keys(transcripts.where(raw_id != ""), [*scope, "id"], "TRANSCRIPT_ID_UNIQUE"),
            _violations(transcripts.where(~single), "ONE_PARENT_PER_TRANSCRIPT", raw_id, F.col("parent")),
            absent(transcripts.where(single), genes, "TRANSCRIPT_PARENT_KNOWN"),
            _violations(parts.where(~single), "ONE_PARENT_PER_PART", F.col("_kind"), F.col("parent")),
            absent(parts.where(single & F.col("_kind").isin("cds", "exon")), transcripts, "PART_PARENT_KNOWN"),
        ]
    )


# Feature types that count as transcripts, lower case.
TRANSCRIPT_FEATURES = ("mrna", "transcript", "ncrna", "trna", "rrna")


def metadata_violations(species: DataFrame, samples: DataFrame) -> DataFrame:
    """References inside study metadata: ids unique, outgroups known and not self, sample species known."""
    with_outgroup = species.where(F.col("outgroup").isNotNull())
    known = species.select(F.col("species_id").alias("outgroup"))
    itself = with_outgroup.where(F.col("outgroup") == F.col("species_id"))
    unknown = with_outgroup.join(known, "outgroup", "left_anti")
    return union_all(
        [
            duplicate_keys(species, ["species_id"], "SPECIES_ID_UNIQUE"),
            _violations(unknown, "OUTGROUP_KNOWN", F.col("species_id"), F.col("outgroup")),
            _violations(itself, "OUTGROUP_NOT_SELF", F.col("species_id"), F.col("outgroup")),
            duplicate_keys(samples, ["sample_id"], "SAMPLE_ID_UNIQUE"),
            unknown_keys(samples, species, "species_id", "SAMPLE_SPECIES_KNOWN"),
        ]
    )


def namespace_overlap(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Shared ids for every pair of tables: counts of both sides, of the overlap, and a status."""
    names = list(tables)
    ids = union_all([tables[n].select(F.lit(n).alias("_t"), key).distinct() for n in names])
    present = ids.groupBy(key).agg(*[F.max((F.col("_t") == n).cast("int")).alias(f"_in_{n}") for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    sums = present.agg(
        *[F.sum(f"_in_{n}").cast("long").alias(f"_n_{n}") for n in names],
        *[F.sum(F.col(f"_in_{a}") * F.col(f"_in_{b}")).cast("long").alias(f"_both_{a}_{b}") for a, b in pairs],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("left_table"),
                F.lit(b).alias("right_table"),
                F.col(f"_n_{a}").alias("left_ids"),
                F.col(f"_n_{b}").alias("right_ids"),
                F.col(f"_both_{a}_{b}").alias("shared_ids"),
            )
            for a, b in pairs
        ]
    )
    complete = (F.col("shared_ids") == F.col("left_ids")) & (F.col("shared_ids") == F.col("right_ids"))
    return sums.select(F.inline(rows)).withColumn("status", F.when(complete, "PASS").otherwise("REVIEW"))


def replicate_warnings(samples: DataFrame, keys: Sequence[str], minimum: int = 2) -> DataFrame:
    """Sample groups with fewer than ``minimum`` samples."""
    return samples.groupBy(*keys).agg(F.count("*").alias("n_samples")).where(F.col("n_samples") < minimum)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def enforce(violations: Sequence[DataFrame], context: str = "") -> None:
    """Run all rules in one job and fail when any is broken; a few examples go into the message."""
    examples = union_all(violations).limit(10).collect()
    if examples:
        shown = "; ".join(f"{r['rule']} {r['key']} {r['detail']}" for r in examples)
        raise QualityError(f"{context}: {shown}" if context else shown)
