"""Evidence per candidate: filters, best hit, set algebra over sources, decision and reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.operators.ranking import first_per_key

MODES = ("union", "intersection", "hmm_only", "blast_only", "precomputed")


def domain_hits_within(hits: DataFrame, evalue: float, domain_evalue: float, curated_cutoff: bool = False) -> DataFrame:
    """Both e-values within bounds; with a curated cutoff the search tool has already decided."""
    if curated_cutoff:
        return hits
    return hits.where((F.col("full_evalue") <= evalue) & (F.col("domain_ievalue") <= domain_evalue))


def alignment_hits_within(hits: DataFrame, evalue: float, identity: float, coverage: float) -> DataFrame:
    return hits.where(
        (F.col("evalue") <= evalue) & (F.col("identity") >= identity) & (F.col("query_coverage") >= coverage)
    )


def best_domain_hit(hits: DataFrame, target: str = "stable_id", score: str = "domain_ievalue", ordinal: str = "ordinal") -> DataFrame:
    """Smallest domain e-value per target, the first listed among equals."""
    return first_per_key(hits, [target], [F.col(score), F.col(ordinal)])


def best_alignment_hit(hits: DataFrame, subject: str = "stable_id", ordinal: str = "ordinal") -> DataFrame:
    """Smallest e-value per subject, then the largest bit score, then the first listed."""
    return first_per_key(hits, [subject], [F.col("evalue"), F.col("bitscore").desc(), F.col(ordinal)])


def combine_sources(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per id found anywhere with a boolean ``evidence_<source>`` per source."""
    flagged = [df.select(key, *[F.lit(n == name).alias(f"evidence_{n}") for n in sources]) for name, df in sources.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), flagged)
    return stacked.groupBy(key).agg(*[F.bool_or(f"evidence_{n}").alias(f"evidence_{n}") for n in sources])


def decide(flags: DataFrame, mode: str, first: str = "hmm", second: str = "blast") -> DataFrame:
    """Add ``decision`` and ``rejection_reason`` for the evidence rule ``mode``."""
    if mode not in MODES:
        raise ValueError(f"unknown evidence rule: {mode}")
    a, b = F.col(f"evidence_{first}"), F.col(f"evidence_{second}")
    rules: dict[str, tuple[Column, list[Column]]] = {
        "union": (a | b, []),
        "intersection": (a & b, [F.when(~a, F.lit(f"missing_{first}_evidence")), F.when(~b, F.lit(f"missing_{second}_evidence"))]),
        "hmm_only": (a, [F.lit(f"missing_{first}_evidence")]),
        "blast_only": (b, [F.lit(f"missing_{second}_evidence")]),
        "precomputed": (F.lit(True), []),
    }
    selected, reasons = rules[mode]
    text = F.nullif(F.concat_ws(";", *reasons), F.lit("")) if reasons else F.lit(None).cast("string")
    reason = F.coalesce(text, F.lit("did_not_pass_selection_rule"))
    return flags.withColumns(
        {
            "selection_basis": F.lit(mode),
            "decision": F.when(selected, "PASS").otherwise("REJECT"),
            "rejection_reason": F.when(~selected, reason),
        }
    )


def prefixed_annotations(table: DataFrame, prefix: str, key: str = "stable_id") -> DataFrame:
    """Annotation columns under a prefix, unless they already carry it."""
    return table.select(
        *[F.col(c).alias(c if c == key or c.startswith(f"{prefix}_") else f"{prefix}_{c}") for c in table.columns]
    )


def assign_modes(members: DataFrame, assignments: DataFrame, key: str, mode: str, missing: str = "Unclassified") -> DataFrame:
    """Mode per member: ``missing`` without one, NULL with several. :func:`mode_conflicts` lists the latter."""
    per_key = assignments.groupBy(key).agg(F.min(mode).alias(mode), F.max(mode).alias("_other"))
    joined = members.join(per_key, key, "left")
    named = F.when(F.col(mode).isNull(), F.lit(missing)).when(F.col(mode) == F.col("_other"), F.col(mode))
    return joined.withColumn(mode, named).drop("_other")


def mode_conflicts(assignments: DataFrame, key: str, mode: str) -> DataFrame:
    """Violations: members with more than one mode."""
    counts = assignments.groupBy(key).agg(F.countDistinct(mode).alias("_n")).where("_n > 1")
    detail = F.concat(F.lit("modes="), F.col("_n").cast("string"))
    return counts.select(F.lit("ONE_MODE_PER_MEMBER").alias("rule"), F.col(key).cast("string").alias("key"), detail.alias("detail"))


def partner_rows(pairs: DataFrame, first: str, second: str, key: str, partner: str) -> DataFrame:
    """Distinct (member, partner) rows, each pair seen from both ends."""
    both = F.array(
        F.struct(F.col(first).alias(key), F.col(second).alias(partner)),
        F.struct(F.col(second).alias(key), F.col(first).alias(partner)),
    )
    return pairs.select(F.inline(both)).distinct()


def pack_partners(partners: DataFrame, key: str, partner: str, name: str = "partner_stable_ids") -> DataFrame:
    """Sorted ``;``-joined partner list per member for the wide table."""
    distinct = partners.select(key, partner).distinct()
    return distinct.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(partner)), ";").alias(name))


def classify_elements(hits: DataFrame, categories: DataFrame | None, element: str = "element") -> DataFrame:
    """Class and subclass per hit: from the map, else the hit's own, else Unclassified / the element."""
    own = [c for c in ("major_class", "subclass") if c in hits.columns]
    rows = hits.select(*[c for c in hits.columns if c not in own], *[F.col(c).alias(f"_own_{c}") for c in own])
    mapped: Sequence[str] = []
    if categories is not None:
        mapped = [c for c in ("major_class", "subclass") if c in categories.columns]
        side = categories.select(element, *[F.col(c).alias(f"_map_{c}") for c in mapped])
        rows = rows.join(side, element, "left")
    defaults = {"major_class": F.lit("Unclassified"), "subclass": F.col(element)}

    def chosen(name: str) -> Column:
        sources = [F.col(f"_map_{name}")] if name in mapped else []
        sources += [F.col(f"_own_{name}")] if name in own else []
        has_default = name == "major_class" or not sources
        return F.coalesce(*sources, *([defaults[name]] if has_default else []))

    full = rows.withColumns({name: chosen(name) for name in defaults})
    return full.drop(*[f"_own_{c}" for c in own], *[f"_map_{c}" for c in mapped])
