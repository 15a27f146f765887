"""Sequence files: one row per record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.operators.expect import duplicate_keys, union_all


def local_path(uri: str = "file_path"):
    """File URI of a scan as a plain path."""
    return F.regexp_replace(F.col(uri), "^file:/+", "/")


def _raw_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text between line-initial ``>``, split by the reader itself; also of files larger than a block."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("lineSep", "\n>").text(paths)
    return raw.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_block"))


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, seq_id, sequence``, one row per record, blank lines and line ends removed."""
    raw = _raw_records(spark, path).where(F.trim("value", F.lit(" \t\r\n")) != "")
    lines = F.split(F.regexp_replace("value", "^\\s*>", ""), "\r?\n", 2)
    body = F.coalesce(F.try_element_at("_lines", F.lit(2)), F.lit(""))
    return raw.withColumn("_lines", lines).select(
        local_path().alias("file"),
        F.split(F.ltrim(F.col("_lines")[0]), "\\s+")[0].alias("seq_id"),
        F.regexp_replace(body, "[ \\t]*[\\r\\n]+[ \\t]*|^[ \\t]+|[ \\t]+$", "").alias("sequence"),
    )


def read_fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_records(spark, path).select("seq_id", "sequence")


def fasta_lengths(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_records(spark, path).select("seq_id", F.length("sequence").cast("long").alias("length"))


def fasta_violations(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Repeated ids within a file, and text before the first header (``key`` starts with the file)."""
    opening = _raw_records(spark, path).where("_block = 0").withColumn("_row", F.monotonically_increasing_id())
    first = opening.groupBy("file_path").agg(F.min_by("value", "_row").alias("_first"))
    text = F.trim("_first", F.lit(" \t\r\n"))
    headless = first.where((text != "") & ~F.startswith(text, F.lit(">"))).select(
        F.lit("SEQUENCE_BEFORE_HEADER").alias("rule"), local_path().alias("key"), F.lit("").alias("detail")
    )
    return union_all([headless, duplicate_keys(read_records(spark, path), ["file", "seq_id"], "UNIQUE_SEQUENCE_ID")])


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """Wrapped records sorted by id; a range-partitioned sort, so several part files in order."""
    wrapped = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    text = F.when(F.length("sequence") > 0, F.concat(F.lit(">"), F.col("seq_id"), F.lit("\n"), wrapped))
    record = F.coalesce(text, F.concat(F.lit(">"), F.col("seq_id")))
    df.orderBy("seq_id").select(record.alias("value")).write.mode("overwrite").text(path)


def concat_fastas(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(all records, violations for ids that occur in more than one place)."""
    records = read_fasta(spark, list(paths))
    return records, duplicate_keys(records, ["seq_id"], "UNIQUE_SEQUENCE_ID")
