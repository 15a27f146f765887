"""Readiness checks of a study: one row per check, file states, and an overall status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.operators.expect import TRANSCRIPT_FEATURES, union_all
from cladegrid.sources.delimited import flag_value
from cladegrid.sources.fasta import fasta_violations, read_records
from cladegrid.sources.gff import gff_violations, read_gff
from cladegrid.sources.sinks import read_files

CHECK_COLUMNS = ("check_id", "scope", "item_id", "severity", "status", "message", "evidence", "remediation")
FILE_FIELDS = ("genome", "gff3", "protein", "cds")

# Panel columns, allowed labels and patterns.
PANEL_COLUMNS = (
    "species_id", "species_name", "group", "include", "representative", "input_kind", "assembly_accession",
    "assembly_level", "annotation_version", "coordinate_system", "genome", "genome_sha256", "gff3", "gff3_sha256",
    "protein", "protein_sha256", "cds", "cds_sha256", "source_uri", "outgroup_species_id", "notes",
)
INPUT_KINDS = ("assembled_genome", "reference_aligned_sample")
ASSEMBLY_LEVELS = ("chromosome", "scaffold", "contig", "unknown")
TRUTH_STATUSES = ("POSITIVE", "NEGATIVE", "UNCERTAIN", "NOT_ASSESSABLE")
TRUTH_REQUIRED = ("species_id", "gene_id", "expected_status", "evidence", "reviewer")
ID_PATTERN = "^[A-Za-z][A-Za-z0-9_.-]*$"
SHA256_PATTERN = "^[0-9a-fA-F]{64}$"


def check_rows(
    df: DataFrame, check_id: str, scope: Column | str, item: Column | str, severity: Column | str, status: Column,
    message: str, evidence: Column | None = None, remediation: str = "",
) -> DataFrame:
    """Check rows of a table of checked things; the remediation is shown only where a check did not pass."""

    def text(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return df.select(
        F.lit(check_id).alias("check_id"),
        text(scope).alias("scope"),
        text(item).alias("item_id"),
        text(severity).alias("severity"),
        status.alias("status"),
        F.lit(message).alias("message"),
        F.coalesce(evidence if evidence is not None else F.lit(""), F.lit("")).alias("evidence"),
        F.when(status == "PASS", F.lit("")).otherwise(F.lit(remediation)).alias("remediation"),
    )


def rule_check(violations: DataFrame, check_id: str, scope: str, severity: str, message: str) -> DataFrame:
    """One check row for a violation table: FAIL (or WARN) with the number of violations, else PASS."""
    bad = "WARN" if severity == "WARN" else "FAIL"
    counted = violations.agg(F.count("*").alias("_n"))
    status = F.when(F.col("_n") == 0, "PASS").otherwise(bad)
    return check_rows(counted, check_id, scope, scope, severity, status, message, F.concat(F.lit("violations="), F.col("_n").cast("string")))


def overall_status(checks: DataFrame) -> DataFrame:
    """BLOCKED for any blocking failure, else REVIEW for any warning, else READY, with the counters."""
    failures = F.count_if((F.col("severity") == "BLOCK") & (F.col("status") == "FAIL"))
    warnings = F.count_if(F.col("status") == "WARN")
    counted = checks.agg(
        failures.alias("blocking_failures"),
        warnings.alias("warnings"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
    )
    status = (
        F.when(F.col("blocking_failures") > 0, "BLOCKED").when(F.col("warnings") > 0, "REVIEW").otherwise("READY")
    )
    return counted.select(status.alias("overall_status"), "blocking_failures", "warnings", "passed")


@dataclass(frozen=True)
class Acceptance:
    """Gates agreed on before a study."""

    min_genomes: int = 5
    max_genomes: int = 10
    require_sha256: bool = True
    require_truth_set: bool = True
    min_positive: int = 5
    min_negative: int = 5
    require_representative: bool = True
    require_annotation_version: bool = True
    chromosome_level_policy: str = "warn"


def parse_panel(raw: DataFrame) -> DataFrame:
    """Typed panel rows with ``problems``, the list of what is wrong with the row.

    ``raw`` has all columns as trimmed text (NULL for empty) and ``row_number`` of the file line.
    """
    unknown = [c for c in raw.columns if c not in (*PANEL_COLUMNS, "row_number")]
    for column in PANEL_COLUMNS:
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast("string"))
    c = F.col
    checks: list[tuple[Column, str]] = [
        (c("species_id").isNull() | ~c("species_id").rlike(ID_PATTERN) | (F.length("species_id") > 100), "species_id"),
        (F.contains("species_id", F.lit("__")), "species_id uses the reserved separator"),
        (c("species_name").isNull(), "species_name"),
        (c("outgroup_species_id").isNotNull() & ~c("outgroup_species_id").rlike(ID_PATTERN), "outgroup_species_id"),
        (c("input_kind").isNotNull() & ~c("input_kind").isin(*INPUT_KINDS), "input_kind"),
        (c("assembly_level").isNotNull() & ~c("assembly_level").isin(*ASSEMBLY_LEVELS), "assembly_level"),
    ]
    checks += [(c(f).isNotNull() & flag_value(c(f)).isNull(), f) for f in ("include", "representative")]
    checks += [(c(f"{f}_sha256").isNotNull() & ~c(f"{f}_sha256").rlike(SHA256_PATTERN), f"{f}_sha256") for f in FILE_FIELDS]
    found = F.array(*[F.when(bad, F.lit(name)) for bad, name in checks], *[F.lit(f"unknown column {u}") for u in unknown])
    return raw.select("row_number", *PANEL_COLUMNS).withColumns(
        {
            "problems": F.array_compact(found),
            "include": F.coalesce(flag_value(c("include")), F.lit(True)),
            "representative": F.coalesce(flag_value(c("representative")), F.lit(False)),
            "input_kind": F.coalesce(c("input_kind"), F.lit("assembled_genome")),
            "assembly_level": F.coalesce(c("assembly_level"), F.lit("unknown")),
        }
    )


def panel_checks(panel: DataFrame, gates: Acceptance) -> DataFrame:
    """Checks of the panel table as a whole (``panel`` from :func:`parse_panel`)."""
    broken = panel.where(F.size("problems") > 0)
    rows = panel.where(F.size("problems") == 0)
    present = panel.agg(F.count("*").alias("_n"))
    twice = rows.groupBy("species_id").agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = twice.agg(F.array_join(F.array_sort(F.collect_list("species_id")), ", ").alias("_ids"))
    included = rows.where("include")
    counts = included.agg(
        F.count("*").alias("_included"),
        F.count_if(F.col("input_kind") == "assembled_genome").alias("_assembled"),
        F.count_if("representative").alias("_representatives"),
        F.countDistinct("group").alias("_groups"),
    )
    size_ok = F.col("_assembled").between(gates.min_genomes, gates.max_genomes) & (F.col("_assembled") == F.col("_included"))

    def verdict(good: Column, bad: str = "FAIL") -> Column:
        return F.when(good, "PASS").otherwise(bad)

    number = F.concat(F.lit("count="), F.col("_representatives").cast("string"))
    checks = [
        check_rows(present, "BMG030", "panel", "species_table", "BLOCK", verdict(F.col("_n") > 0), "panel table is present and not empty", remediation="provide the panel table"),
        check_rows(broken, "BMG031", "species_row", F.concat(F.lit("row_"), F.col("row_number").cast("string")), "BLOCK", F.lit("FAIL"), "row breaks the panel schema", F.array_join("problems", ", "), "correct the row"),
        check_rows(repeated, "BMG032", "panel", "species_id", "BLOCK", verdict(F.col("_ids") == ""), "species ids are unique", F.col("_ids"), "correct repeated ids"),
        check_rows(counts, "BMG040", "panel", "panel_size", "BLOCK", verdict(size_ok), "panel size is within bounds and all are assembled genomes", F.concat_ws("/", F.col("_assembled").cast("string"), F.col("_included").cast("string")), "include only assembled genomes"),
        check_rows(counts, "BMG042", "panel", "group_diversity", "WARN", verdict(F.col("_groups") >= 2, "WARN"), "at least two groups are defined", F.concat(F.lit("groups="), F.col("_groups").cast("string")), "define two groups for group comparisons"),
    ]
    if gates.require_representative:
        checks.append(check_rows(counts, "BMG041", "panel", "representative", "BLOCK", verdict(F.col("_representatives") == 1), "exactly one representative genome", number, "choose one representative"))
    return union_all(checks)


def species_checks(panel: DataFrame, gates: Acceptance) -> DataFrame:
    """Checks of every included panel row: kind, metadata, assembly level, outgroup."""
    rows = panel.where(F.size("problems") == 0)
    included = rows.where("include")
    item = F.col("species_id")
    required = ["annotation_version"] if gates.require_annotation_version else []
    required = sorted([*required, "assembly_accession", "coordinate_system"])
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    kind_ok = F.col("input_kind") == "assembled_genome"
    on_chromosomes = F.col("assembly_level") == "chromosome"
    blocks = gates.chromosome_level_policy == "block"
    level_rows = included if gates.chromosome_level_policy != "ignore" else included.where(on_chromosomes)
    level_status = F.when(on_chromosomes, "PASS").otherwise("FAIL" if blocks else "WARN")
    level_severity = F.when(on_chromosomes | F.lit(not blocks), "WARN").otherwise("BLOCK")
    known = rows.select(F.col("species_id").alias("outgroup_species_id"))
    lost = included.where("outgroup_species_id is not null").join(known, "outgroup_species_id", "left_anti")
    return union_all(
        [
            check_rows(included, "BMG100", "species", item, "BLOCK", F.when(kind_ok, "PASS").otherwise("FAIL"), "item is an independent assembled genome", F.concat(F.lit("input_kind="), F.col("input_kind")), "move aligned samples out of the panel"),
            check_rows(included, "BMG101", "species", item, "BLOCK", F.when(missing == "", "PASS").otherwise("FAIL"), "version and coordinate metadata are complete", missing, "fill in the missing metadata"),
            check_rows(level_rows, "BMG102", "species", item, level_severity, level_status, "assembly is at chromosome level", F.concat(F.lit("assembly_level="), F.col("assembly_level")), "prefer a chromosome-level assembly"),
            check_rows(lost, "BMG103", "species", item, "BLOCK", F.lit("FAIL"), "outgroup is defined in the panel", F.col("outgroup_species_id"), "add the outgroup or correct its id"),
        ]
    )


def file_states(panel: DataFrame, files: DataFrame) -> DataFrame:
    """Declared files of included rows against observed ones.

    ``files``: ``path, size_bytes, sha256, format_state`` of the files that exist.
    """
    included = panel.where((F.size("problems") == 0) & F.col("include"))
    declared = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(f).alias("configured_path"), F.coalesce(F.col(f"{f}_sha256"), F.lit("")).alias("expected_sha256"))
            for f in FILE_FIELDS
        ]
    )
    rows = included.select("species_id", F.inline(declared))
    seen = files.select(F.col("path").alias("configured_path"), "size_bytes", F.col("sha256").alias("observed_sha256"), "format_state")
    joined = rows.join(seen, "configured_path", "left")
    both = (F.col("expected_sha256") != "") & (F.col("observed_sha256") != "")
    return joined.select(
        "species_id",
        "field",
        F.coalesce("configured_path", F.lit("")).alias("configured_path"),
        F.col("size_bytes").isNotNull().alias("exists"),
        "size_bytes",
        "expected_sha256",
        F.coalesce("observed_sha256", F.lit("")).alias("observed_sha256"),
        F.when(both, F.lower("expected_sha256") == F.lower("observed_sha256")).alias("checksum_match"),
        F.coalesce("format_state", F.lit("MISSING")).alias("format_state"),
    )


def file_checks(states: DataFrame, gates: Acceptance) -> DataFrame:
    scope, item = F.concat(F.lit("species."), F.col("field")), F.col("species_id")

    def verdict(good: Column) -> Column:
        return F.when(good, "PASS").otherwise("FAIL")

    checks = [
        check_rows(states, "BMG110", scope, item, "BLOCK", verdict(F.coalesce(F.col("size_bytes") > 0, F.lit(False))), "file exists and is not empty", F.col("configured_path"), "provide the file"),
        check_rows(states.where("exists"), "BMG113", scope, item, "BLOCK", verdict(F.startswith("format_state", F.lit("PASS"))), "file has the expected format", F.col("format_state"), "check the file type"),
    ]
    if gates.require_sha256:
        compared = states.where("checksum_match is not null")
        evidence = F.concat(F.lit("expected="), F.col("expected_sha256"), F.lit("; observed="), F.col("observed_sha256"))
        checks += [
            check_rows(states, "BMG111", scope, item, "BLOCK", verdict(F.col("expected_sha256") != ""), "expected checksum is registered", F.col("expected_sha256"), "register the checksum"),
            check_rows(compared, "BMG112", scope, item, "BLOCK", verdict(F.col("checksum_match")), "checksum matches", evidence, "verify the file version"),
        ]
    return union_all(checks)


def truth_checks(truth: DataFrame | None, panel: DataFrame, gates: Acceptance) -> DataFrame:
    """Checks of the reviewed positive and negative controls; ``truth`` has trimmed text columns."""
    spark = panel.sparkSession
    one = spark.range(1)
    where = ("family", "manual_truth_set")
    if not gates.require_truth_set:
        return check_rows(one, "BMG060", *where, "INFO", F.lit("INFO"), "no truth set is required")
    if truth is None:
        return check_rows(one, "BMG060", *where, "BLOCK", F.lit("FAIL"), "truth set is present", remediation="provide the truth set")
    missing = sorted(set(TRUTH_REQUIRED) - set(truth.columns))
    if missing:
        return check_rows(one, "BMG061", *where, "BLOCK", F.lit("FAIL"), "truth set has its required columns", F.lit(", ".join(missing)), "restore the columns")
    known = panel.where(F.size("problems") == 0).select("species_id", F.lit(True).alias("_known")).distinct()
    gene = F.col("gene_id")
    rows = truth.where(F.col("species_id").isNotNull() & gene.isNotNull() & ~F.startswith(F.upper(gene), F.lit("TODO")))
    status = F.coalesce(F.upper("expected_status"), F.lit("<EMPTY>"))
    judged = rows.withColumn("_status", status).join(known, "species_id", "left")
    counted = judged.agg(
        F.count_if(F.col("_status") == "POSITIVE").alias("_positive"),
        F.count_if(F.col("_status") == "NEGATIVE").alias("_negative"),
        F.count_if(~F.col("_status").isin(*TRUTH_STATUSES)).alias("_invalid"),
        F.count_if(F.col("_known").isNull()).alias("_unknown"),
    )

    def check(check_id: str, good: Column, message: str, shown: str, remediation: str) -> DataFrame:
        verdict = F.when(good, "PASS").otherwise("FAIL")
        evidence = F.concat(F.lit("rows="), F.col(shown).cast("string"))
        return check_rows(counted, check_id, *where, "BLOCK", verdict, message, evidence, remediation)

    return union_all(
        [
            check("BMG062", F.col("_invalid") == 0, "expected statuses are allowed", "_invalid", "use only the allowed statuses"),
            check("BMG063", F.col("_unknown") == 0, "species of controls are in the panel", "_unknown", "use the panel's species ids"),
            check("BMG064", F.col("_positive") >= gates.min_positive, "enough positive controls", "_positive", "add reviewed controls"),
            check("BMG065", F.col("_negative") >= gates.min_negative, "enough negative controls", "_negative", "add reviewed controls"),
        ]
    )


def format_states(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """Format of each existing file (path -> field) from its first content lines, read line by line."""
    declared = spark.createDataFrame(list(files.items()), "path string, field string")
    raw = spark.read.text(list(files)).select(
        F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"),
        F.regexp_replace("value", "^﻿", "").alias("line"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("_at"),
    )
    content = F.trim("line", F.lit(" \t\r\n")) != ""
    feature = content & ~F.startswith("line", F.lit("#"))
    version = F.startswith("line", F.lit("##gff-version"))
    firsts = raw.groupBy("path").agg(
        F.min_by("line", F.when(content, F.col("_at"))).alias("_line"),
        F.min_by("line", F.when(feature, F.col("_at"))).alias("_feature"),
        F.min(F.when(feature, F.col("_at"))).alias("_feature_at"),
        F.min(F.when(version, F.col("_at"))).alias("_version_at"),
        F.count_if(content).alias("_content"),
        F.count_if(feature).alias("_features"),
    )
    columns = F.size(F.split("_feature", "\t"))
    versioned = F.coalesce(F.col("_version_at") < F.col("_feature_at"), F.lit(False))
    gff = (
        F.when(F.coalesce(F.col("_features"), F.lit(0)) == 0, "FAIL_NO_FEATURE_ROWS")
        .when(columns < 9, "FAIL_NOT_9_COLUMN_GFF")
        .when(versioned, "PASS_GFF3")
        .otherwise("PASS_9_COLUMN_GFF")
    )
    fasta = (
        F.when(F.coalesce(F.col("_content"), F.lit(0)) == 0, "FAIL_EMPTY_TEXT")
        .when(F.startswith(F.ltrim("_line"), F.lit(">")), "PASS")
        .otherwise("FAIL_NOT_FASTA")
    )
    return declared.join(firsts, "path", "left").select(
        "path", "field", F.when(F.col("field") == "gff3", gff).otherwise(fasta).alias("format_state")
    )


def readiness(panel: DataFrame, truth: DataFrame | None, files: DataFrame, gates: Acceptance) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(check rows, file states, overall status)."""
    states = file_states(panel, files)
    checks = union_all(
        [panel_checks(panel, gates), species_checks(panel, gates), file_checks(states, gates), truth_checks(truth, panel, gates)]
    )
    return checks, states, overall_status(checks)


# Roles whose files hold sequences.
SEQUENCE_ROLES = ("genome", "protein", "cds", "reference_proteins")


def audit_files(spark: SparkSession, records: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (species, role, path): size, hash, record and feature counts, status and notes."""
    declared = spark.createDataFrame(list(records), "species_id string, role string, path string")
    paths = sorted({p for _, _, p in records})
    sequence_paths = sorted({p for _, r, p in records if r in SEQUENCE_ROLES})
    gff_paths = sorted({p for _, r, p in records if r == "gff3"})
    result = declared.join(read_files(spark, paths), "path", "left")
    problems = []
    if sequence_paths:
        seqs = read_records(spark, sequence_paths)
        length = F.length("sequence").cast("long")
        stats = seqs.groupBy(F.col("file").alias("path")).agg(
            F.count("*").alias("_records"),
            F.sum(length).alias("total_length"),
            F.min(length).alias("min_length"),
            F.max(length).alias("max_length"),
            F.avg(length).alias("mean_length"),
        )
        result = result.join(stats, "path", "left")
        problems.append(fasta_violations(spark, sequence_paths).select(F.substring_index("key", "|", 1).alias("path"), "rule"))
    if gff_paths:
        kind = F.lower("feature")
        counts = read_gff(spark, gff_paths).groupBy(F.col("file").alias("path")).agg(
            F.count("*").alias("_features"),
            F.countDistinct("seqid").alias("gff_seqid_count"),
            F.count_if(kind == "gene").alias("gff_gene_count"),
            F.count_if(kind.isin(*TRANSCRIPT_FEATURES)).alias("gff_transcript_count"),
            F.count_if(kind == "cds").alias("gff_cds_count"),
        )
        result = result.join(counts, "path", "left")
        bad = gff_violations(spark, gff_paths).where("rule <> 'EMBEDDED_SEQUENCES'")
        problems.append(bad.select(F.col("key").alias("path"), "rule"))
    empty = {"_records": "long", "total_length": "long", "min_length": "long", "max_length": "long", "mean_length": "double"}
    empty |= {c: "long" for c in ("_features", "gff_seqid_count", "gff_gene_count", "gff_transcript_count", "gff_cds_count")}
    result = result.withColumns({c: F.lit(None).cast(t) for c, t in empty.items() if c not in result.columns})
    if problems:
        rules = reduce(lambda a, b: a.unionByName(b), problems)
        noted = rules.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("rule")), ", ").alias("_rules"))
        result = result.join(noted, "path", "left")
    else:
        result = result.withColumn("_rules", F.lit(None).cast("string"))
    is_sequence, is_gff = F.col("role").isin(*SEQUENCE_ROLES), F.col("role") == "gff3"
    none = is_sequence & (F.coalesce(F.col("_records"), F.lit(0)) == 0)
    no_gene = is_gff & (F.coalesce(F.col("gff_gene_count"), F.lit(0)) == 0)
    failed = F.col("_rules").isNotNull() | F.col("size_bytes").isNull()
    status = F.when(failed | none, "FAIL").when(no_gene, "WARN").otherwise("PASS")
    notes = (
        F.when(F.col("size_bytes").isNull(), "file is missing")
        .when(F.col("_rules").isNotNull(), F.col("_rules"))
        .when(none, "No FASTA records")
        .when(no_gene, "no gene features; mapping may need review")
        .otherwise("")
    )
    return result.select(
        "species_id", "role", "path", "size_bytes", "sha256",
        F.when(is_gff, F.col("_features")).when(is_sequence, F.col("_records")).alias("record_count"),
        "total_length", "min_length", "max_length", "mean_length",
        "gff_seqid_count", "gff_gene_count", "gff_transcript_count", "gff_cds_count",
        status.alias("status"), notes.alias("notes"),
    )
