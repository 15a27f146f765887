"""Delimited tables: separator choice, all-string reads, id and column aliases, packed imports."""

from __future__ import annotations

import gzip
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.functions.scalars import number_strict, resolve_column, split_multi, stable_key
from cladegrid.operators.expect import QualityError

# Cell texts read as missing, besides the empty cell.
MISSING_CELLS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Accepted spellings of the two flags.
TRUE_WORDS = ("1", "true", "yes", "y")
FALSE_WORDS = ("0", "false", "no", "n")

ID_ALIASES = ("stable_id", "protein_id")
UNIT_ALIASES = ("species_id", "species")
ITEM_ALIASES = ("gene_id", "gene")


def separator_of(spark: SparkSession, path: str) -> str:
    """By suffix; otherwise tab when the first content line has a tab or has no comma."""
    name = path.lower()
    if name.endswith(".csv"):
        return ","
    if name.endswith((".tsv", ".tab")):
        return "\t"
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.startswith("value", F.lit("#")))
    first = lines.head(1)
    text = first[0]["value"] if first else ""
    return "\t" if "\t" in text or "," not in text else ","


def read_table(
    spark: SparkSession, path: str | Sequence[str], *, missing: bool = True, comment: str | None = None, sep: str | None = None
) -> DataFrame:
    """All columns as text (declared by the header, nothing inferred); missing cells become NULL.

    Files with the same header are read by one scan; the scans are put together by column name, with NULL
    where a file lacks a column. gz files are read whole by one task each, so spread their rows afterwards
    if they are large.
    """
    alike: dict[tuple, list[str]] = {}
    for one in [path] if isinstance(path, str) else list(path):
        options = {"header": "true", "sep": sep or separator_of(spark, one), "inferSchema": "false", "encoding": "UTF-8"}
        if comment:
            options["comment"] = comment
        columns = tuple(c.lstrip("﻿") for c in spark.read.options(**options).csv(one).columns)
        alike.setdefault((columns, *options.items()), []).append(one)
    scans = [spark.read.options(**dict(options)).csv(paths).toDF(*columns) for (columns, *options), paths in alike.items()]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    if not missing:
        return df
    return df.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING_CELLS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def with_stable_id(df: DataFrame, separator: str = "__", aliases: Sequence[str] = ID_ALIASES) -> DataFrame | None:
    """Add ``stable_id`` from an id column, or from unit and item columns; None when neither exists."""
    own = resolve_column(df.columns, aliases, required=False)
    if own is not None:
        return df.withColumnRenamed(own, "stable_id")
    unit = resolve_column(df.columns, UNIT_ALIASES, required=False)
    item = resolve_column(df.columns, ITEM_ALIASES, required=False)
    if unit is None or item is None:
        return None
    return df.withColumn("stable_id", stable_key(unit, item, separator))


def with_mapped_id(df: DataFrame, item: str, mapping: DataFrame, target: str = "stable_id") -> DataFrame:
    """Add the id of items that map to exactly one; check with ``expect.ambiguous_mapping`` first."""
    unique = mapping.groupBy("gene_id").agg(F.min(target).alias(target), F.countDistinct(target).alias("_n"))
    side = unique.where("_n = 1").select(F.col("gene_id").alias(item), target)
    return df.join(side, item, "left")


def member_list(df: DataFrame, separator: str = "__") -> DataFrame:
    """Distinct ids of an imported member list."""
    keyed = with_stable_id(df, separator)
    if keyed is None:
        raise QualityError("member list has neither an id column nor unit and item columns")
    return keyed.where(F.col("stable_id").isNotNull()).select("stable_id").distinct()


# Numeric columns of a gene/transcript map.
MAP_NUMBERS = (
    "gene_start", "gene_end", "transcript_start", "transcript_end", "protein_length", "cds_length", "transcript_length", "cds_modulo_3",
)


def canonical_maps(spark: SparkSession, paths: Sequence[str], ids: DataFrame | None = None) -> DataFrame:
    """Gene/transcript maps of several species, put together by column name, restricted to ``ids`` when given."""
    table = read_table(spark, list(paths))
    if "stable_id" not in table.columns:
        raise QualityError("canonical map lacks stable_id")
    typed = table.withColumns({c: F.col(c).try_cast("long") for c in MAP_NUMBERS if c in table.columns})
    return typed if ids is None else typed.join(ids.select("stable_id"), "stable_id", "left_semi")


def duplication_table(df: DataFrame, members: DataFrame, separator: str = "__") -> tuple[DataFrame, DataFrame]:
    """Imported modes restricted to members: (modes with one row per id and mode, one row per partner)."""
    keyed = with_stable_id(df, separator)
    if keyed is None:
        raise QualityError("duplication table has neither an id column nor unit and item columns")
    mode = resolve_column(df.columns, ("duplication_mode", "mode", "type"))
    partner = resolve_column(df.columns, ("partner_stable_id", "partner_gene_id", "partner"), required=False)
    rows = keyed.join(members.select("stable_id"), "stable_id", "left_semi")
    unit = F.when(F.contains("stable_id", F.lit(separator)), F.substring_index("stable_id", separator, 1)).otherwise("")
    cells = split_multi(partner) if partner else F.array().cast("array<string>")
    ids = F.transform(
        cells, lambda p: F.when(F.contains(p, F.lit(separator)), p).otherwise(F.concat(unit, F.lit(separator), p))
    )
    shaped = rows.select("stable_id", F.col(mode).alias("duplication_mode"), unit.alias("species_id"), ids.alias("_partners"))
    packed = F.nullif(F.array_join(F.array_sort(F.array_distinct("_partners")), ";"), F.lit(""))
    modes = shaped.select("stable_id", "duplication_mode", packed.alias("partner_stable_ids"))
    pairs = shaped.select(
        "species_id",
        F.col("stable_id").alias("stable_id_1"),
        F.explode("_partners").alias("stable_id_2"),
        "duplication_mode",
    )
    return modes.dropDuplicates(["stable_id", "duplication_mode"]), pairs


# Lower-case names that are labels, not samples, in an expression matrix.
MATRIX_LABELS = ("stable_id", "species_id", "species", "gene_id", "gene", "transcript_id", "protein_id")


def expression_matrix(df: DataFrame, members: DataFrame, separator: str = "__") -> tuple[DataFrame, list[str]]:
    """(id + numeric sample columns, sample names) of an imported matrix.

    Text that is no number fails the job; NULL stays NULL. Ids come from an id column, from unit and
    item columns, or by unique mapping of the first column.
    """
    keyed = with_stable_id(df, separator)
    first = df.columns[0]
    if keyed is None:
        keyed = with_mapped_id(df, first, members)
    samples = [c for c in keyed.columns if c.lower() not in MATRIX_LABELS]
    if not samples:
        raise QualityError("expression matrix has no sample columns")
    return keyed.select("stable_id", *[number_strict(f"`{c}`").alias(c) for c in samples]), samples


def abundance_tables(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Per-sample abundance files (sample id -> path) as ``sample_id, gene_id, tpm``.

    Files are grouped by header, so files with the same columns are read by one scan.
    """
    frames = []
    for sample, path in paths.items():
        table = read_table(spark, path)
        item = resolve_column(table.columns, ("Gene ID", "gene_id", "gene"))
        value = resolve_column(table.columns, ("TPM", "tpm"))
        frames.append(
            table.select(F.lit(sample).alias("sample_id"), F.col(f"`{item}`").alias("gene_id"), number_strict(f"`{value}`").alias("tpm"))
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def substitution_estimates(df: DataFrame, pair: str = "pair_id", ordinal: str | None = None) -> DataFrame:
    """Ka/Ks table under its usual header variants: ``pair, Ka, Ks, Ka_Ks``; first row per pair."""
    from cladegrid.operators.pairs import with_ratio
    from cladegrid.operators.ranking import first_per_key

    normal = {c.lower().replace("/", "_").replace(" ", "_"): c for c in df.columns}
    if "ka" not in normal or "ks" not in normal:
        raise QualityError(f"no Ka and Ks columns in: {', '.join(df.columns)}")
    ratio = normal.get("ka_ks") or normal.get("ka_ks_ratio")

    def number(name: str):
        return F.col(f"`{name}`").try_cast("double")

    picked = df.select(
        pair,
        *([ordinal] if ordinal else []),
        number(normal["ka"]).alias("Ka"),
        number(normal["ks"]).alias("Ks"),
        (number(ratio) if ratio else F.lit(None).cast("double")).alias("_ratio"),
    )
    full = with_ratio(picked, "Ka", "Ks", "_ratio").drop("_ratio")
    return first_per_key(full, [pair], [ordinal]).drop(ordinal) if ordinal else full


def flag_value(c) -> F.Column:
    """Boolean of an accepted flag word, else NULL."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def read_review_table(spark: SparkSession, path: str) -> DataFrame:
    """Panel or truth-set table: all text, trimmed, empty cells NULL, with ``row_number`` of the file line.

    Such tables have a row per genome or reviewed gene and are read by one task, so that line numbers hold.
    """
    raw = trimmed_or_null(read_table(spark, path, missing=False).coalesce(1))
    return raw.withColumn("row_number", (F.monotonically_increasing_id() + 2).cast("int"))


def trimmed_or_null(df: DataFrame) -> DataFrame:
    """Every text column trimmed, empty cells as NULL."""
    return df.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c.strip()) for c in df.columns])
