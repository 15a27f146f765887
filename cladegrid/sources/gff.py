"""Annotation files with nine tab-separated columns and 1-based closed intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.functions.scalars import strip
from cladegrid.sources.fasta import local_path

COLUMNS = ("seqid", "source", "feature", "start", "end", "score", "strand", "phase", "attributes")


def with_attributes(df: DataFrame, text: str, name: str = "attributes") -> DataFrame:
    """``key=value;...`` or ``key "value"; ...`` -> map; the last of repeated keys wins.

    Entries and keys are columns of their own, so that they are computed once per row.
    """
    separated = F.filter(
        F.transform(F.split(F.col(text), ";"), strip), lambda i: F.contains(i, F.lit("=")) | F.contains(i, F.lit(" "))
    )

    def entry(item: Column) -> Column:
        with_equals = F.contains(item, F.lit("="))
        mark = F.when(with_equals, F.instr(item, "=")).otherwise(F.instr(item, " "))
        value = strip(F.substr(item, mark + 1))
        plain = F.when(with_equals, value).otherwise(F.trim(value, F.lit('"')))
        return F.struct(strip(F.substr(item, F.lit(1), mark - 1)).alias("key"), plain.alias("value"))

    split = df.withColumn("_items", separated).withColumn("_entries", F.transform("_items", entry))
    keyed = split.withColumn("_keys", F.transform("_entries", lambda e: e["key"]))
    last = F.filter(
        "_entries",
        lambda e, i: ~F.array_contains(F.slice(F.col("_keys"), i + 2, F.size("_keys")), e["key"]),
    )
    repeated = F.size(F.array_distinct("_keys")) < F.size("_keys")
    chosen = F.when(repeated, last).otherwise(F.col("_entries"))
    return keyed.withColumn("_chosen", chosen).withColumn(name, F.map_from_entries("_chosen")).drop(
        "_items", "_entries", "_keys", "_chosen"
    )


def first_parent(parent: Column | str) -> Column:
    return F.split(F.col(parent) if isinstance(parent, str) else parent, ",")[0]


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(paths).select(F.col("value"), F.col("_metadata.file_path").alias("file_path"))
    kept = raw.where((strip("value") != "") & ~F.startswith("value", F.lit("#")))
    return kept.select(local_path().alias("file"), "value", F.split("value", "\t").alias("_f"))


def _problem() -> Column:
    start, end = F.try_element_at("_f", F.lit(4)), F.try_element_at("_f", F.lit(5))
    first, last = start.try_cast("long"), end.try_cast("long")
    return (
        F.when(F.size("_f") != 9, F.lit("NINE_COLUMNS"))
        .when((start != strip(start)) | (end != strip(end)), F.lit("PADDED_COORDINATE"))
        .when(first.isNull() | last.isNull(), F.lit("INTEGER_COORDINATE"))
        .when((first < 1) | (last < first), F.lit("VALID_INTERVAL"))
    )


def read_gff(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Features of all well-formed lines; see :func:`gff_violations` for the others."""
    good = _lines(spark, path).where(_problem().isNull())
    fields = {name: F.get("_f", F.lit(i)) for i, name in enumerate(COLUMNS)}
    typed = good.select(
        "file",
        *[fields[c].try_cast("long").alias(c) if c in ("start", "end") else fields[c].alias(c) for c in COLUMNS],
        "value",
    )
    return with_attributes(typed, "attributes")


def gff_violations(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Malformed lines with their file and text, and embedded sequence sections."""
    paths = [path] if isinstance(path, str) else list(path)
    bad = _lines(spark, paths).withColumn("rule", _problem()).where("rule is not null")
    raw = spark.read.text(paths).where(strip("value") == "##FASTA")
    embedded = raw.select(
        F.lit("EMBEDDED_SEQUENCES").alias("rule"), F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("key"), F.col("value").alias("detail")
    )
    return bad.select("rule", F.col("file").alias("key"), F.col("value").alias("detail")).unionByName(embedded)


def _attribute(*names: str) -> Column:
    return F.coalesce(*[F.nullif(F.try_element_at("attributes", F.lit(n)), F.lit("")) for n in names])


def with_hierarchy(features: DataFrame) -> DataFrame:
    """Add ``id`` and ``parent`` (whole cell) from the attributes."""
    kind = F.lower("feature")
    own = F.when(kind == "gene", _attribute("ID", "gene_id", "Name")).otherwise(_attribute("ID", "transcript_id"))
    return features.withColumns({"id": own, "parent": _attribute("Parent", "transcript_id")})
