"""Gene-family analyses: the generic operators bound to gene tables and their column names.

Each function takes DataFrames and parameters and returns a DataFrame or a dict of named ones. Rules
that must hold are enforced together, in one job per analysis, unless ``check=False``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.functions.scalars import (
    closed_length,
    key_item,
    key_unit,
    stable_key,
    substitution_flags,
)
from cladegrid.functions.sequences import closed_substring, reverse_complement, with_protein_properties
from cladegrid.operators import describe, distribution, evidence, expect, expression, intervals, joins, occupancy, pairs, ranking, rarefaction, tiles
from cladegrid.operators.expect import TRANSCRIPT_FEATURES, enforce, require_columns
from cladegrid.operators.grouptests import GroupComparison
from cladegrid.sources.groups import GroupSource, provenance

LABELS = ("subfamily", "group")
SEPARATOR = "__"

# Metrics summarised per subfamily and group.
STRUCTURE_SUMMARY_METRICS = (
    "gene_length", "protein_length", "cds_length", "exon_count", "intron_count", "total_intron_length",
)

# Promoter aggregation levels and the labels each needs.
PROMOTER_LEVELS = {
    "SPECIES_SUBFAMILY": ("species_id", "subfamily"),
    "SUBFAMILY": ("subfamily",),
    "SPECIES": ("species_id",),
    "GROUP": ("group",),
    "GROUP_SUBFAMILY": ("group", "subfamily"),
}

PAIR_STRATA = {
    "subfamily": "subfamily_stratum",
    "group": "group_stratum",
    "pan_family_class": "pan_class_stratum",
    "duplication_mode": "duplication_mode_stratum",
}


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


SPECIES_SCHEMA = (
    "species_id string, species_name string, group string, species_subfamily string, representative boolean, outgroup string"
)
SAMPLE_SCHEMA = "sample_id string, species_id string, condition string, tissue string"


def study_tables(spark: SparkSession, species: Sequence[tuple], samples: Sequence[tuple] = (), check: bool = True) -> tuple[DataFrame, DataFrame]:
    """Species and sample metadata of a study as small tables, their references checked."""
    tables = spark.createDataFrame(list(species), SPECIES_SCHEMA), spark.createDataFrame(list(samples), SAMPLE_SCHEMA)
    if check:
        enforce([expect.metadata_violations(*tables)], "study metadata")
    return tables


# --- canonical transcripts -----------------------------------------------------------------------


def select_canonical(features: DataFrame, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(selected transcripts, counters). ``features`` have ``file``, ``id`` and ``parent`` columns.

    Per file and gene the transcript with the longest coding length is chosen, ties by smallest id.
    """
    kind = F.lower("feature")
    cds = features.where(kind == "cds").select("file", F.col("parent").alias("transcript_id"), "seqid", "strand", "start", "end")
    if check:
        overlapping = intervals.overlapping_neighbours(cds, ["file", "transcript_id", "seqid", "strand"]).select(
            F.lit("CDS_SEGMENTS_DISJOINT").alias("rule"), F.col("transcript_id").alias("key"), F.col("start").cast("string").alias("detail")
        )
        enforce([expect.hierarchy_violations(features, "file"), overlapping], "annotation")
    lengths = cds.groupBy("file", "transcript_id").agg(F.sum(closed_length("start", "end")).alias("cds_length"))
    transcripts = features.where(kind.isin(*TRANSCRIPT_FEATURES)).select(
        "file", F.col("id").alias("transcript_id"), F.col("parent").alias("gene_id")
    )
    coding = transcripts.join(lengths, ["file", "transcript_id"])
    order = [F.col("cds_length").desc(), F.col("transcript_id")]
    selected = ranking.first_per_key(coding, ["file", "gene_id"], order)
    if check:
        enforce([expect.empty_result(selected, "no transcript with a coding part")], "annotation")
    genes = features.where(kind == "gene").groupBy("file").agg(F.count("*").alias("_genes"))
    counters = selected.groupBy("file").agg(F.count("*").alias("genes_with_cds")).join(genes, "file", "left")
    return selected, counters.select(
        "file",
        "genes_with_cds",
        F.col("genes_with_cds").alias("selected_transcripts"),
        (F.coalesce("_genes", F.lit(0)) - F.col("genes_with_cds")).alias("skipped_genes"),
    )


def canonical_features(features: DataFrame, selected: DataFrame) -> DataFrame:
    """Feature rows of the selected genes, transcripts and their direct parts."""
    kind = F.lower("feature")
    is_gene, is_transcript = kind == "gene", kind.isin(*TRANSCRIPT_FEATURES)
    anchor = F.when(is_gene, F.concat(F.lit("g:"), F.col("id")))
    anchor = anchor.when(is_transcript, F.concat(F.lit("t:"), F.col("id"))).otherwise(F.concat(F.lit("t:"), F.col("parent")))
    kept = selected.select(
        "file",
        F.explode(F.array(F.concat(F.lit("g:"), "gene_id"), F.concat(F.lit("t:"), "transcript_id"))).alias("_anchor"),
    )
    return features.withColumn("_anchor", anchor).join(kept, ["file", "_anchor"], "left_semi").select(*features.columns)


def canonical_map(
    features: DataFrame, selected: DataFrame, genome: DataFrame, species: DataFrame, separator: str = SEPARATOR
) -> DataFrame:
    """One row per gene with coordinates and sequence lengths.

    ``species``: ``file, species_id, species_name, group, species_subfamily``; ``genome``: ``seq_id``
    with ``tile, residues`` or ``sequence``, and names unique over all files of the call.
    """
    kind = F.lower("feature")
    genes = features.where(kind == "gene").select(
        "file", F.col("id").alias("gene_id"), F.col("seqid").alias("chromosome"), F.col("start").alias("gene_start"),
        F.col("end").alias("gene_end"), "strand",
    )
    spans = features.where(kind.isin(*TRANSCRIPT_FEATURES)).select(
        "file", F.col("id").alias("transcript_id"), F.col("start").alias("transcript_start"), F.col("end").alias("transcript_end")
    )
    parts = features.select("file", "seqid", "strand", "start", "end", F.lower("feature").alias("_kind"), F.col("parent").alias("transcript_id"))
    own = parts.join(selected.select("file", "transcript_id"), ["file", "transcript_id"], "left_semi")
    exons = own.where("_kind = 'exon'").groupBy("file", "transcript_id").agg(F.sum(closed_length("start", "end")).alias("transcript_length"))
    segments = own.where("_kind = 'cds'").withColumn("_id", F.concat_ws("\t", "file", "transcript_id"))
    tiled = genome if "tile" in genome.columns else tiles.tile_sequences(genome, ["seq_id"])
    coding = tiles.spliced_from_tiles(segments, tiled.withColumnRenamed("seq_id", "seqid"), ["seqid"], "_id").select(
        F.substring_index("_id", "\t", 1).alias("file"),
        F.substring_index("_id", "\t", -1).alias("transcript_id"),
        F.length(F.rtrim("protein", F.lit("*"))).cast("long").alias("protein_length"),
        F.length("cds").cast("long").alias("cds_length"),
    )
    base = selected.select("file", "gene_id", "transcript_id").join(species, "file")
    base = base.join(genes, ["file", "gene_id"], "left").join(spans, ["file", "transcript_id"], "left")
    base = base.join(coding, ["file", "transcript_id"], "left").join(exons, ["file", "transcript_id"], "left")
    return base.withColumn("cds_modulo_3", F.col("cds_length") % 3).select(
        "species_id", "species_name", "group", "species_subfamily", "gene_id", "transcript_id",
        stable_key("species_id", "gene_id", separator).alias("stable_id"), "chromosome", "gene_start", "gene_end", "strand",
        "transcript_start", "transcript_end", "protein_length", "cds_length", "transcript_length", "cds_modulo_3",
    )


# --- family membership ---------------------------------------------------------------------------


def family_members(
    domain_hits: DataFrame, alignment_hits: DataFrame, canonical: DataFrame, proteins: DataFrame, mode: str = "union", *,
    listed: DataFrame | None = None, evalue: float = 1e-5, domain_evalue: float = 1e-5, curated_cutoff: bool = False,
    alignment_evalue: float = 1e-5, identity: float = 30.0, coverage: float = 50.0, subfamilies: DataFrame | None = None,
    annotations: Mapping[str, DataFrame] | None = None, family_name: str = "", species_ids: Sequence[str] = (),
    properties: bool = True, check: bool = True,
) -> dict[str, DataFrame]:
    """Members, rejected candidates, domain sequences and the species x subfamily distribution.

    ``listed`` replaces the evidence rule by a given member list. ``subfamilies`` has ``stable_id,
    subfamily`` and an ``ordinal`` by which later rows win.
    """
    passing = evidence.domain_hits_within(domain_hits, evalue, domain_evalue, curated_cutoff)
    hmm = evidence.best_domain_hit(passing)
    blast = evidence.best_alignment_hit(evidence.alignment_hits_within(alignment_hits, alignment_evalue, identity, coverage))
    given = listed if listed is not None else canonical.sparkSession.createDataFrame([], "stable_id string")
    flags = evidence.combine_sources({"hmm": hmm, "blast": blast, "precomputed": given}, "stable_id")
    if listed is not None:
        flags, mode = flags.where("evidence_precomputed"), "precomputed"
    decided = evidence.decide(flags, mode).withColumn("family_name", F.lit(family_name))
    known = canonical.join(decided.select("stable_id"), "stable_id", "left_semi")
    if check:
        rules = [
            expect.empty_result(decided.where("decision = 'PASS'"), "no member passed the evidence rule"),
            expect.unknown_keys(decided, canonical, "stable_id", "CANDIDATE_IN_MAP"),
            expect.unknown_keys(decided, proteins.select(F.col("seq_id").alias("stable_id")), "stable_id", "CANDIDATE_HAS_PROTEIN"),
            expect.duplicate_keys(known, ["stable_id"], "MAP_ID_UNIQUE"),
        ]
        rules += [expect.duplicate_keys(a, ["stable_id"], f"{p.upper()}_UNIQUE") for p, a in (annotations or {}).items()]
        enforce(rules, "family members")
    hmm_columns = {
        "query": "hmm_query", "full_evalue": "hmm_full_evalue", "domain_ievalue": "hmm_domain_ievalue",
        "domain_score": "hmm_domain_score", "ali_from": "hmm_ali_from", "ali_to": "hmm_ali_to",
    }
    blast_columns = {
        "query_id": "blast_query_id", "evalue": "blast_best_evalue", "identity": "blast_best_identity",
        "query_coverage": "blast_best_query_coverage", "bitscore": "blast_best_bitscore",
    }
    rows = known.join(decided, "stable_id")
    for side, columns in ((hmm, hmm_columns), (blast, blast_columns)):
        rows = rows.join(side.select("stable_id", *[F.col(c).alias(n) for c, n in columns.items()]), "stable_id", "left")
    if subfamilies is not None:
        rows = joins.last_wins_lookup(rows, subfamilies, "stable_id", "ordinal")
    else:
        rows = rows.withColumn("subfamily", F.lit(None).cast("string"))
    rows = rows.join(proteins.select(F.col("seq_id").alias("stable_id"), F.col("sequence").alias("_protein")), "stable_id", "left")
    if properties:
        rows = with_protein_properties(rows, "_protein")
    members = rows.where("decision = 'PASS'")
    domains = members.select("stable_id", closed_substring("_protein", "hmm_ali_from", "hmm_ali_to").alias("sequence"))
    final = members.drop("_protein")
    for prefix, table in (annotations or {}).items():
        final = final.join(evidence.prefixed_annotations(table, prefix), "stable_id", "left")
    return {
        "members": final,
        "rejected": rows.where("decision = 'REJECT'").drop("_protein"),
        "domains": domains.where("sequence is not null").withColumnRenamed("stable_id", "seq_id"),
        "distribution": family_distribution(final, species_ids),
    }


def family_distribution(members: DataFrame, species_ids: Sequence[str] = ()) -> DataFrame:
    require_columns(members, ("stable_id", "species_id", "subfamily"), "family members")
    grid = distribution.unit_stratum_distribution(members, "species_id", "subfamily", "stable_id", species_ids)
    names = {"member_count": "gene_count", "unit_total": "species_gene_total", "within_unit_fraction": "within_species_fraction"}
    return renamed(grid, names).withColumns(
        {"counting_unit": F.lit("GENE"), "absence_interpretation": F.lit("ANNOTATION_COUNT_NOT_VALIDATED_GENE_LOSS")}
    )


# --- groups --------------------------------------------------------------------------------------

CLASS_COLUMNS = {
    "unit_occupancy": "species_occupancy",
    "unit_fraction": "species_fraction",
    "member_count": "family_gene_count",
    "mean_copies_in_present_units": "mean_copy_number_present_species",
    "single_copy_unit_fraction": "single_copy_species_fraction",
    "occupancy_class": "pan_family_class",
}


def pan_family(
    wide: DataFrame, group_column: str, source: GroupSource, members: DataFrame, species_ids: Sequence[str], *,
    core: float = 0.99, soft: float = 0.90, shell: float = 0.10, max_exact: int = 1000, iterations: int = 5000, seed: int = 1,
    separator: str = SEPARATOR, check: bool = True,
) -> dict[str, DataFrame]:
    """Classification, membership, presence, unassigned members, rarefaction and class summaries."""
    require_columns(members, ("stable_id", "species_id", "gene_id"), "family members")
    listed = wide.withColumnRenamed(group_column, "HOG_ID")
    rows = occupancy.membership_from_wide(listed, "HOG_ID", species_ids, members)
    if check:
        rules = [
            expect.duplicate_keys(members, ["stable_id"], "MEMBER_ID_UNIQUE"),
            expect.prefix_mismatch(rows, "stable_id", "species_id", separator),
            expect.empty_result(rows, "no group holds a family member"),
        ]
        enforce(rules, "pan family")
    labels = provenance(source)
    classes = occupancy.classify_groups(rows, "HOG_ID", "species_id", "stable_id", species_ids, core, soft, shell, labels)
    classes = renamed(classes, CLASS_COLUMNS)
    copies = occupancy.with_copies(rows, "HOG_ID", "species_id", "stable_id")
    membership = copies.select(
        "HOG_ID",
        F.lit(source.group_type).alias("orthology_group_type"),
        key_unit("stable_id", separator, F.col("species_id")).alias("species_id"),
        key_item("stable_id", separator).alias("gene_id"),
        "stable_id",
        F.col("copies_in_unit").alias("copy_number_in_species"),
    )
    reasons = {
        "reason": "NOT_FOUND_IN_SELECTED_HOG_NODE",
        "selected_hog_node": source.node,
        "hog_node_status": source.node_status,
        "orthology_group_type": source.group_type,
        "orthology_source_file": source.relative_path,
    }
    subsets = rarefaction.rarefaction(rows, "HOG_ID", "species_id", species_ids, max_exact, iterations, seed)
    counted = renamed(
        subsets, {"subset_size": "n_species", "pan_count": "pan_family_hog_count", "core_count": "core_family_hog_count"}
    )
    return {
        "classification": classes,
        "membership": membership,
        "presence": occupancy.presence_matrix(rows, "HOG_ID", "species_id", species_ids),
        "unassigned": joins.unassigned_rows(members, rows, "stable_id", reasons),
        "rarefaction": counted,
        "rarefaction_summary": renamed(rarefaction.rarefaction_summary(subsets), {"subset_size": "n_species"}),
        **pan_summaries(classes, membership, members, species_ids, check=check),
    }


def joined_membership(membership: DataFrame, classes: DataFrame, members: DataFrame, check: bool = True) -> DataFrame:
    """Membership with subfamily, group and class labels; missing ones are ``Unassigned``."""
    if check:
        rules = [
            expect.duplicate_keys(membership, ["stable_id"], "MEMBERSHIP_ID_UNIQUE"),
            expect.duplicate_keys(classes, ["HOG_ID"], "GROUP_ID_UNIQUE"),
            expect.duplicate_keys(members, ["stable_id"], "MEMBER_ID_UNIQUE"),
            expect.inconsistent(membership, members, "stable_id", "species_id", "SPECIES_CONSISTENT"),
        ]
        enforce(rules, "membership")
    return distribution.membership_with_metadata(
        membership, classes, members, "HOG_ID", "stable_id", "species_id", "pan_family_class", LABELS
    )


def pan_summaries(
    classes: DataFrame, membership: DataFrame, members: DataFrame, species_ids: Sequence[str], check: bool = True
) -> dict[str, DataFrame]:
    """Class, species x class and subfamily x class tables, gene and group denominators kept apart."""
    joined = joined_membership(membership, classes, members, check)
    summary = distribution.class_summary(classes, joined, "HOG_ID", "stable_id", "pan_family_class")
    unit = F.when(F.col("counting_unit") == "GROUP", "HOG").otherwise("GENE")

    def by(stratum: str, prefix: str, strata: Sequence[str] | None) -> DataFrame:
        table = distribution.stratum_class_distribution(joined, stratum, "pan_family_class", "stable_id", "HOG_ID", strata)
        names = {
            "member_count": "gene_count", "group_count": "hog_count", "stratum_member_total": f"{prefix}_gene_total",
            "stratum_group_total": f"{prefix}_hog_total", "member_fraction": "gene_fraction", "group_fraction": "hog_fraction",
        }
        return renamed(table, names)

    return {
        "class_summary": summary.withColumn("counting_unit", unit),
        "species_class_summary": by("species_id", "species", species_ids),
        "subfamily_class_summary": by("subfamily", "subfamily", None),
    }


# --- structure, positions, promoters -------------------------------------------------------------


def gene_structure(features: DataFrame, canonical: DataFrame, members: DataFrame) -> DataFrame:
    """One row per member of the map: spans, exon, intron, coding and UTR metrics.

    Coordinates come from the annotation where it has the gene or transcript, else from the map.
    ``features`` have ``species_id``, ``id`` and ``parent``.
    """
    kind = F.lower("feature")
    own = canonical.join(members.select("stable_id"), "stable_id", "left_semi")
    gene_ids = own.select("species_id", F.col("gene_id").alias("id"), "stable_id")
    transcript_ids = own.select("species_id", F.col("transcript_id").alias("id"), "stable_id")
    genes = features.where(kind == "gene").join(gene_ids, ["species_id", "id"]).select(
        "stable_id", F.col("seqid").alias("chromosome"), F.col("start").alias("gene_start"), F.col("end").alias("gene_end"), "strand"
    )
    spans = features.where(kind.isin(*TRANSCRIPT_FEATURES)).join(transcript_ids, ["species_id", "id"]).select(
        "stable_id", F.col("start").alias("transcript_start"), F.col("end").alias("transcript_end")
    )
    placed = joins.fallback_lookup(own, genes, "stable_id", ["chromosome", "gene_start", "gene_end", "strand"])
    placed = joins.fallback_lookup(placed, spans, "stable_id", ["transcript_start", "transcript_end"])
    parts = joins.explode_parents(features.where((kind != "gene") & ~kind.isin(*TRANSCRIPT_FEATURES)))
    owned = parts.join(transcript_ids.withColumnRenamed("id", "parent"), ["species_id", "parent"])
    measured = intervals.structure_metrics(owned, "stable_id")
    counts = [c for c in measured.columns if c not in ("stable_id", "mean_exon_length", "mean_intron_length", "structure_qc")]
    labels = members.select("stable_id", *[c for c in ("subfamily",) if c in members.columns])
    joined = placed.drop("cds_length").join(labels, "stable_id", "left").join(measured, "stable_id", "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts}).withColumns(
        {
            "mean_intron_length": F.coalesce("mean_intron_length", F.lit(0.0)),
            "structure_qc": F.coalesce("structure_qc", F.lit("MISSING_EXON_OR_CDS")),
            "gene_length": closed_length("gene_start", "gene_end"),
            "transcript_span": closed_length("transcript_start", "transcript_end"),
        }
    )
    return filled.select(
        "species_id", "gene_id", "transcript_id", "stable_id", *labels.columns[1:], "group", "chromosome", "strand",
        "gene_length", "transcript_span", "protein_length", "cds_length", "exon_count", "total_exon_length", "mean_exon_length",
        "intron_count", "total_intron_length", "mean_intron_length", *intervals.UTR_FEATURES, "structure_qc",
    )


def structure_summary(metrics: DataFrame, group_fields: Sequence[str] = LABELS) -> DataFrame:
    """n, mean, sd, quartiles and range of each metric per subfamily and per group; empty ones are left out."""
    long = describe.stratified_metrics(metrics, {g: g for g in group_fields}, {m: m for m in STRUCTURE_SUMMARY_METRICS})
    table = describe.describe(long, ["stratification", "stratum", "metric"], keep_empty=False)
    names = {"stratification": "group_field", "stratum": "group_value", "minimum": "min", "maximum": "max"}
    return renamed(table, names)


def group_tests(
    table: DataFrame, group_fields: Sequence[str], metrics: Sequence[str], min_units: int = 2, alpha: float = 0.05, check: bool = True
) -> dict[str, DataFrame]:
    """Global, pairwise and quality tables stacked over the group fields."""
    stacked: dict[str, list[DataFrame]] = {"global": [], "pairwise": [], "quality": []}
    for field in group_fields:
        comparison = GroupComparison(table, field, metrics, min_units=min_units, alpha=alpha)
        if check:
            enforce([comparison.violations()], f"{field} comparison")
        overall = comparison.global_tests()
        stacked["global"].append(overall.drop("low_power_warning"))
        stacked["pairwise"].append(comparison.pairwise_tests(overall))
        stacked["quality"].append(comparison.quality(overall))
    return {name: distribution.stack(frames) for name, frames in stacked.items()}


# The column names of gene tables for those of the comparison tables.
TEST_COLUMNS = {
    "n_items": "n_genes", "n_units": "n_species", "n_unit_group_cells": "n_species_group_units",
    "n_items_1": "n_genes_1", "n_items_2": "n_genes_2", "n_units_1": "n_species_1", "n_units_2": "n_species_2",
    "median_item_1": "median_gene_1", "median_item_2": "median_gene_2",
    "median_unit_1": "median_species_unit_1", "median_unit_2": "median_species_unit_2",
    "median_unit_difference": "median_species_unit_difference",
    "input_item_rows": "input_gene_rows", "eligible_item_rows": "eligible_gene_rows", "excluded_item_rows": "excluded_gene_rows",
    "eligible_unit_group_cells": "eligible_species_group_units",
}


def gene_group_tests(
    table: DataFrame, group_fields: Sequence[str] = LABELS, metrics: Sequence[str] = STRUCTURE_SUMMARY_METRICS, **options
) -> dict[str, DataFrame]:
    """:func:`group_tests` on a gene table: genes are the items, species the units, and columns are named so."""
    return {name: renamed(found, TEST_COLUMNS) for name, found in group_tests(table, group_fields, metrics, **options).items()}


def chromosome_positions(
    members: DataFrame, lengths: DataFrame, representatives: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(positions, density per chromosome); ``lengths``: ``species_id, chromosome, chromosome_length``."""
    rows = members if representatives is None else members.where(F.col("species_id").isin(*representatives))
    placed = intervals.positions_on_sequences(rows, lengths, ["species_id", "chromosome"], "gene_start", "gene_end")
    density = intervals.density_per_sequence(placed, ["species_id", "chromosome"], "stable_id")
    return placed, renamed(density, {"item_count": "gene_count", "density": "gene_density_per_mb"})


def promoters(
    canonical: DataFrame, members: DataFrame, genome: DataFrame, genes: DataFrame, upstream: int = 2000, downstream: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(coordinates with overlapping genes, sequences).

    ``genome``: ``species_id, chromosome`` and either ``tile, residues`` (tiles of the standard width)
    or ``sequence``, which is cut into tiles; ``genes``: ``species_id, chromosome, gene_id, start, end``.
    """
    own = canonical.join(members.select("stable_id"), "stable_id", "left_semi")
    items = own.select("species_id", "gene_id", "stable_id", "chromosome", "gene_start", "gene_end", "strand")
    place = ["species_id", "chromosome"]
    tiled = genome if "tile" in genome.columns else tiles.tile_sequences(genome, place)
    windows = intervals.start_windows(items, tiles.tile_lengths(tiled, place), upstream, downstream, place)
    cut = tiles.cut_intervals(windows, tiled, place, "window_start", "window_end", name="plus")
    plus = F.when(F.col("window_start").isNotNull(), F.coalesce("plus", F.lit("")))
    cut = cut.withColumn("promoter", F.when(F.col("strand") == "-", reverse_complement(plus)).otherwise(plus)).drop("plus")
    place = F.concat_ws("\t", "species_id", "chromosome")
    usable = cut.where("window_start is not null").select("stable_id", "gene_id", place.alias("place"), F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    others = genes.select(place.alias("place"), "gene_id", "start", "end")
    overlaps = intervals.overlap_lists(usable, others, "place", "stable_id", "gene_id").select("stable_id", "overlap_count", "overlap_ids")
    joined = cut.join(overlaps, "stable_id", "left")
    usable_row = F.col("window_start").isNotNull()
    coordinates = joined.select(
        "species_id", "gene_id", "stable_id", "chromosome", F.when(usable_row, F.col("strand")).alias("strand"), "tss_1based",
        F.col("window_start").alias("promoter_start_1based"), F.col("window_end").alias("promoter_end_1based"),
        F.col("window_length").alias("promoter_length"),
        F.when(usable_row, F.lit(upstream)).alias("requested_upstream_bp"), F.when(usable_row, F.lit(downstream)).alias("requested_downstream_bp"),
        F.col("truncated").alias("truncated_at_chr_boundary"), F.col("overlap_count").alias("overlap_gene_count"),
        F.col("overlap_ids").alias("overlap_gene_ids"), F.col("window_qc").alias("promoter_qc"),
    )
    sequences = cut.where("window_start is not null").select(F.col("stable_id").alias("seq_id"), F.col("promoter").alias("sequence"))
    return coordinates, sequences


DISTRIBUTION_COLUMNS = {
    "hit_count": "motif_hit_count",
    "carriers_with_hit": "genes_with_hit",
    "n_carriers": "n_genes",
    "total_length": "total_promoter_bp",
    "hits_per_carrier": "hits_per_gene",
    "zscore_hit_count": "zscore_motif_hit_count",
}
DISTRIBUTION_QC_COLUMNS = {
    "total_carriers": "total_genes",
    "eligible_carriers": "eligible_genes",
    "excluded_missing_annotation": "excluded_genes_missing_annotation",
    "cells_zero_length": "cells_zero_promoter_bp",
}


def promoter_distributions(hits: DataFrame, coordinates: DataFrame, members: DataFrame, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(zero-complete distributions at five levels, quality per level)."""
    require_columns(hits, ("stable_id", "element"), "promoter elements")
    require_columns(coordinates, ("stable_id", "species_id", "gene_id", "promoter_length"), "promoter coordinates")
    if check:
        rules = [
            expect.duplicate_keys(coordinates, ["stable_id"], "COORDINATE_ID_UNIQUE"),
            expect.duplicate_keys(members, ["stable_id"], "MEMBER_ID_UNIQUE"),
            expect.outside_domain(coordinates, "promoter_length", "stable_id", "PROMOTER_LENGTH", nullable=False),
            expect.unknown_keys(hits, coordinates, "stable_id", "HIT_HAS_PROMOTER"),
        ]
        enforce(rules, "promoter distributions")
    labels = members.select("stable_id", *[c for c in LABELS if c in members.columns])
    carriers = coordinates.select("stable_id", "species_id", "promoter_length").join(labels, "stable_id", "left")
    for name in LABELS:
        if name not in carriers.columns:
            carriers = carriers.withColumn(name, F.lit(None).cast("string"))
    tables = distribution.ElementDistribution(
        hits, carriers, "stable_id", "element", "promoter_length", ("species_id", "subfamily", "group"), PROMOTER_LEVELS
    )
    return renamed(tables.distribution(), DISTRIBUTION_COLUMNS), renamed(tables.quality(), DISTRIBUTION_QC_COLUMNS)


def promoter_profile(
    hits: DataFrame, coordinates: DataFrame, members: DataFrame, categories: DataFrame | None = None, top_n: int = 30, check: bool = True
) -> dict[str, DataFrame]:
    """Classified hits, counts per gene, distributions and the chart tables."""
    classed = evidence.classify_elements(hits, categories)
    columns = [c for c in ("species_id", "gene_id", "promoter_length", "promoter_qc") if c in coordinates.columns]
    placed = classed.drop(*columns).join(coordinates.select("stable_id", *columns), "stable_id", "left")
    keys = ["stable_id", "species_id", "gene_id", "major_class"]
    cells, quality = promoter_distributions(hits, coordinates, members, check)
    return {
        "elements": placed,
        "summary": placed.groupBy(*keys, "element").agg(F.count("*").alias("element_count")),
        "per_gene": placed.groupBy(*keys).agg(F.count("*").alias("element_count")),
        "distributions": cells,
        "distribution_qc": quality,
        "class_counts": distribution.label_counts(placed, "major_class"),
        "top_elements": ranking.top_labels(placed, "element", top_n),
    }


# --- duplication, pairs, expression, wide table --------------------------------------------------


def duplication_summary(modes: DataFrame, members: DataFrame, membership: DataFrame, classes: DataFrame, check: bool = True) -> DataFrame:
    """Modes by species, subfamily and class, zero-complete."""
    require_columns(modes, ("stable_id", "species_id", "duplication_mode"), "duplication modes")
    if check:
        enforce([expect.duplicate_keys(modes, ["stable_id"], "MODE_ID_UNIQUE")], "duplication")
    labels = joined_membership(membership, classes, members, check).select("stable_id", "subfamily", "pan_family_class")
    rows = modes.select("stable_id", "species_id", "duplication_mode").join(labels, "stable_id", "left")
    levels = {"SPECIES": "species_id", "SUBFAMILY": "subfamily", "PAN_CLASS": "pan_family_class"}
    table = distribution.mode_by_strata(rows, "stable_id", "duplication_mode", levels)
    return renamed(table, {"member_count": "gene_count", "stratum_total": "stratum_gene_total"})


def duplication_modes(members: DataFrame, assignments: DataFrame, partners: DataFrame, check: bool = True) -> DataFrame:
    """Mode and packed partners of every member, from pair and singleton files."""
    if check:
        enforce([evidence.mode_conflicts(assignments.join(members, "stable_id", "left_semi"), "stable_id", "duplication_mode")], "duplication")
    modes = evidence.assign_modes(members.select("species_id", "gene_id", "stable_id"), assignments, "stable_id", "duplication_mode")
    rows = evidence.partner_rows(partners, "stable_id_1", "stable_id_2", "stable_id", "partner")
    return modes.join(evidence.pack_partners(rows, "stable_id", "partner"), "stable_id", "left")


def substitution_pairs(
    members: DataFrame, membership: DataFrame | None, duplicates: DataFrame | None, reference: str, max_per_group: int | None = None
) -> DataFrame:
    """Unordered pairs of members from single-copy groups and from duplication pairs."""
    sources = []
    if membership is not None:
        sources.append(pairs.single_copy_pairs(membership, "HOG_ID", "species_id", "stable_id", reference))
    if duplicates is not None:
        sources.append(pairs.listed_pairs(duplicates, "stable_id_1", "stable_id_2", "duplication_mode", "species_id", "ordinal"))
    return pairs.merge_pairs(sources, members, max_per_group=max_per_group)


def annotated_estimates(
    wanted: DataFrame, estimates: DataFrame, labels: DataFrame, modes: DataFrame, saturation: float = 2.0, separator: str = SEPARATOR
) -> tuple[DataFrame, DataFrame]:
    """(pairs with estimates, flags and strata; summary per stratum).

    ``estimates``: ``stable_id_1, stable_id_2, Ka, Ks, Ka_Ks`` and optionally ``qc_message`` of failed
    pairs. ``labels`` comes from :func:`joined_membership`.
    """
    ends = ["stable_id_1", "stable_id_2"]
    joined = wanted.join(estimates, ends, "left")
    failed = F.col("Ka").isNull() | F.col("Ks").isNull()
    status = F.when(failed, "FAILED").otherwise(substitution_flags("Ks", "Ka_Ks", saturation))
    parts = {}
    for n in ("1", "2"):
        parts[f"species_id_{n}"] = key_unit(f"stable_id_{n}", separator)
        parts[f"gene_id_{n}"] = key_item(f"stable_id_{n}", separator)
    flagged = joined.withColumns({"qc_status": status, **parts})
    meta = labels.select("stable_id", "subfamily", "group", "pan_family_class").join(
        modes.select("stable_id", "duplication_mode"), "stable_id", "left"
    )
    full = pairs.with_strata(flagged, meta, "stable_id", PAIR_STRATA)
    strata = {"SUBFAMILY": "subfamily_stratum", "GROUP": "group_stratum", "PAN_CLASS": "pan_class_stratum", "DUPLICATION_MODE": "duplication_mode_stratum"}
    return full, pairs.summarize_strata(full, strata, ("Ka", "Ks", "Ka_Ks"))


MEMBER_COLUMNS = ("stable_id", "species_id", "gene_id", "subfamily")


def imported_expression(matrix: DataFrame, samples: Sequence[str], members: DataFrame, threshold: float = 1.0, check: bool = True) -> dict[str, DataFrame]:
    if check:
        rules = [expect.duplicate_keys(matrix, ["stable_id"], "EXPRESSION_ID_UNIQUE")]
        rules += [expect.outside_domain(matrix, f"`{s}`" if "." in s else s, "stable_id", "EXPRESSION_VALUE") for s in samples]
        enforce(rules, "expression")
    wide = expression.wide_with_status(members.select(*MEMBER_COLUMNS), matrix, "stable_id", samples)
    long = expression.long_from_wide(wide, [*MEMBER_COLUMNS, "expression_data_status"], samples, threshold)
    return {
        "matrix": wide,
        "long": long,
        "summary": expression.summarize(long, MEMBER_COLUMNS[:3]),
        "heatmap": expression.row_zscores(long, "stable_id"),
    }


def abundance_expression(
    abundance: DataFrame, samples: DataFrame, canonical: DataFrame, members: DataFrame, sample_ids: Sequence[str], threshold: float = 1.0, check: bool = True
) -> dict[str, DataFrame]:
    # genes without a canonical member leave before their values are judged
    placed = abundance.join(samples.select("sample_id", "species_id").distinct(), "sample_id")
    mapped = placed.join(canonical.select("species_id", "gene_id"), ["species_id", "gene_id"], "left_semi")
    if check:
        enforce(
            [
                expect.duplicate_keys(samples, ["sample_id"], "SAMPLE_ID_UNIQUE"),
                expect.duplicate_keys(canonical, ["species_id", "gene_id"], "GENE_UNIQUE_IN_SPECIES"),
                expect.duplicate_keys(members, ["stable_id"], "MEMBER_ID_UNIQUE"),
                expect.unknown_keys(samples, canonical.select("species_id").distinct(), "species_id", "SAMPLE_SPECIES_MAPPED"),
                expect.outside_domain(mapped, "tpm", "gene_id", "ABUNDANCE_VALUE", nullable=False),
            ],
            "abundance",
        )
    long = expression.long_from_abundance(members.select(*MEMBER_COLUMNS), samples, abundance, canonical, threshold)
    wide = long.groupBy(*MEMBER_COLUMNS).agg(
        *[F.max(F.when(F.col("sample_id") == s, F.col("expression_value"))).alias(s) for s in sample_ids]
    )
    return {
        "matrix": wide,
        "long": renamed(long, {"sample_unit": "sample_species_id"}),
        "summary": expression.summarize(long, MEMBER_COLUMNS[:3], with_assay_counts=True),
        "heatmap": expression.row_zscores(long, "stable_id"),
    }


def master_table(
    members: DataFrame, *, structure: DataFrame | None = None, chromosome: DataFrame | None = None, modes: DataFrame | None = None,
    membership: DataFrame | None = None, classes: DataFrame | None = None, promoter_per_gene: DataFrame | None = None,
    expression_summary: DataFrame | None = None, kaks: DataFrame | None = None,
) -> DataFrame:
    """One row per member with the columns of every analysis that was run."""
    pan = None
    if membership is not None and classes is not None:
        extra = [c for c in classes.columns if c == "HOG_ID" or c not in membership.columns]
        pan = membership.join(classes.select(*extra), "HOG_ID", "left")
    totals = None
    if promoter_per_gene is not None:
        per_class = promoter_per_gene.groupBy("stable_id", "major_class").agg(F.sum("element_count").alias("_n"))
        totals = per_class.groupBy("stable_id").agg(
            F.sum("_n").alias("cis_element_total"),
            F.array_join(F.array_sort(F.collect_set("major_class")), ";").alias("cis_element_major_classes"),
        )
    rolled = None
    if kaks is not None:
        rolled = describe.per_end_medians(kaks, ("stable_id_1", "stable_id_2"), "stable_id", ("Ka", "Ks", "Ka_Ks"), "Ka_Ks")
        rolled = rolled.withColumnRenamed("pair_count", "kaks_pair_count")
    tables = [
        (structure, "_structure", ["gene_id"]), (chromosome, "_chromosome", ["gene_id"]), (modes, "_duplication", ["duplication_mode"]),
        (pan, "_pan_family", ["HOG_ID"]), (totals, "", []), (expression_summary, "_expression", ["gene_id"]), (rolled, "", []),
    ]
    return joins.integrate(members, tables, "stable_id")


