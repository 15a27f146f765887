"""Result tables of search, motif, duplication and completeness programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.functions.scalars import resolve_column, strip
from cladegrid.sources.delimited import read_table, with_mapped_id, with_stable_id
from cladegrid.sources.fasta import local_path
from cladegrid.sources.order import with_file_order

# Columns of the tabular alignment format, in file order.
ALIGNMENT_SCHEMA = (
    "query_id string, stable_id string, identity double, alignment_length long, mismatch long, gapopen long, "
    "qstart long, qend long, sstart long, send long, evalue double, bitscore double, query_length long, subject_length long"
)


def read_domain_hits(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """White-space separated per-domain table; short and comment lines are skipped. ``ordinal`` follows files and lines."""
    raw = with_file_order(spark.read.text(path), path).where((strip("value") != "") & ~F.startswith("value", F.lit("#")))
    fields = F.split(strip("value"), "\\s+", 23)
    rows = raw.select(fields.alias("f"), "ordinal").where(F.size("f") >= 22)
    return rows.select(
        F.get("f", F.lit(0)).alias("stable_id"),
        F.get("f", F.lit(3)).alias("query"),
        F.get("f", F.lit(6)).cast("double").alias("full_evalue"),
        F.get("f", F.lit(12)).cast("double").alias("domain_ievalue"),
        F.get("f", F.lit(13)).cast("double").alias("domain_score"),
        F.get("f", F.lit(17)).cast("long").alias("ali_from"),
        F.get("f", F.lit(18)).cast("long").alias("ali_to"),
        "ordinal",
    )


def read_alignment_hits(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Tabular alignments; ``ordinal`` follows the order of files and lines."""
    scan = spark.read.schema(ALIGNMENT_SCHEMA).options(sep="\t", comment="#", mode="FAILFAST").csv(path)
    rows = with_file_order(scan, path)
    coverage = F.try_divide(F.col("alignment_length"), F.col("query_length")) * F.lit(100.0)
    return rows.withColumn("query_coverage", coverage)


# Motif hit columns kept, under their common names, and the scanner's names for them.
MOTIF_COLUMNS = {
    "motif_alt_id": ("motif_alt_id", "string"),
    "sequence_start": ("start", "long"),
    "sequence_stop": ("stop", "long"),
    "strand": ("strand", "string"),
    "score": ("score", "double"),
    "p_value": ("p-value", "double"),
    "q_value": ("q-value", "double"),
    "matched_sequence": ("matched_sequence", "string"),
}


def read_motif_hits(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Motif scanner table under common names; columns it lacks are NULL."""
    table = read_table(spark, path, comment="#", sep="\t")
    sequence = resolve_column(table.columns, ("sequence_name", "sequence"))
    motif = resolve_column(table.columns, ("motif_id", "motif"))

    def column(name: str, source: str, kind: str):
        found = source if source in table.columns else None
        return (F.col(f"`{found}`").cast(kind) if found else F.lit(None).cast(kind)).alias(name)

    return table.select(
        F.col(sequence).alias("stable_id"), F.col(motif).alias("element"), *[column(n, *s) for n, s in MOTIF_COLUMNS.items()]
    )


def imported_motif_hits(df: DataFrame, coordinates: DataFrame, separator: str = "__") -> DataFrame:
    """Motif hits of another program: ids from an id column, unit and item, or a uniquely mapped item."""
    element = resolve_column(df.columns, ("element", "motif_id", "cis_element"))
    named = df.withColumnRenamed(element, "element")
    keyed = with_stable_id(named, separator, aliases=("stable_id", "sequence_id"))
    if keyed is None:
        item = resolve_column(df.columns, ("gene_id", "gene"))
        keyed = with_mapped_id(named, item, coordinates)
    return keyed


# Duplication modes by file suffix.
MODE_BY_SUFFIX = {
    "wgd": "WGD", "tandem": "Tandem", "proximal": "Proximal", "transposed": "Transposed", "dispersed": "Dispersed",
}


def read_duplication_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """``species_id, stable_id_1, stable_id_2, duplication_mode, source_file, ordinal`` from ``*.pairs`` files.

    ``ordinal`` follows the paths of the files, then their lines.
    """
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pairs").text(directory)
    name = F.regexp_extract("source_file", "([^/]+)\\.([^./]+)\\.pairs$", 1)
    suffix = F.regexp_extract("source_file", "([^/]+)\\.([^./]+)\\.pairs$", 2)
    modes = F.create_map(*[F.lit(x) for pair in MODE_BY_SUFFIX.items() for x in pair])
    rows = with_file_order(raw.select("value", F.col("_metadata.file_path").alias("file_path"), "_metadata"), directory)
    fields = rows.select(local_path().alias("source_file"), F.split("value", "\t").alias("f"), "ordinal")
    kept = fields.where((F.size("f") >= 3) & ~F.startswith(F.lower(F.get("f", F.lit(0))), F.lit("duplicate")))
    return kept.select(
        name.alias("species_id"), F.get("f", F.lit(0)).alias("stable_id_1"), F.get("f", F.lit(2)).alias("stable_id_2"),
        modes[suffix].alias("duplication_mode"), "source_file", "ordinal",
    ).where("duplication_mode is not null")


def read_singletons(spark: SparkSession, directory: str) -> DataFrame:
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.singletons").text(directory)
    first = F.split("value", "\t")[0]
    kept = raw.select(first.alias("stable_id")).where((F.col("stable_id") != "") & ~F.startswith(F.lower("stable_id"), F.lit("gene")))
    return kept.withColumn("duplication_mode", F.lit("Singleton"))


def duplication_assignments(pairs: DataFrame, singletons: DataFrame) -> DataFrame:
    """Distinct (id, mode) rows from both ends of all pairs and from the singletons."""
    ends = pairs.select(F.explode(F.array("stable_id_1", "stable_id_2")).alias("stable_id"), "duplication_mode")
    return ends.unionByName(singletons.select("stable_id", "duplication_mode")).distinct()


# The one-line completeness notation, blanks removed, and the names of its numbers.
COMPLETENESS = "C:([0-9.]+)%\\[S:([0-9.]+)%,D:([0-9.]+)%\\],F:([0-9.]+)%,M:([0-9.]+)%,n:([0-9]+)"
COMPLETENESS_COLUMNS = ("complete_pct", "single_copy_pct", "duplicated_pct", "fragmented_pct", "missing_pct", "busco_n")


def parse_completeness(df: DataFrame, text: str = "value") -> DataFrame:
    """Six numbers from the completeness line of a summary text, NULL when there is none."""
    squeezed = F.translate(text, " ", "")

    def number(i: int, name: str):
        kind = "long" if name == "busco_n" else "double"
        return F.regexp_extract(squeezed, COMPLETENESS, i).try_cast(kind)

    return df.withColumns({name: number(i, name) for i, name in enumerate(COMPLETENESS_COLUMNS, start=1)})


def read_completeness(spark: SparkSession, paths: dict[str, str], lineage: str) -> DataFrame:
    """One row per species from its summary file."""
    listed = spark.createDataFrame(list(paths.items()), "species_id string, summary_path string")
    if not paths:
        return parse_completeness(listed.withColumn("value", F.lit(""))).drop("value")
    texts = spark.read.text(list(paths.values()), wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    keyed = texts.select("value", local_path().alias("summary_path"))
    joined = listed.withColumn("lineage", F.lit(lineage)).join(keyed, "summary_path", "left")
    return parse_completeness(joined).drop("value").select("species_id", "lineage", *COMPLETENESS_COLUMNS, "summary_path")
