"""Writers for the edges of a study, and the manifest of what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.sources import ranges


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Tab-separated with header; NULL is written as ``NA``. ``order`` gives part files in total order."""
    df = df.orderBy(*order) if order else df
    options = {"sep": "\t", "header": "true", "nullValue": "NA", "emptyValue": ""}
    df.write.mode("overwrite").options(**options).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _exists(spark: SparkSession, text: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def file_facts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, size_bytes, sha256, n_lines, n_records, n_content_lines, first_line`` of files at or below paths.

    Each file is read once, in blocks, by one task, as a digest must; a file of any size fits.
    """
    ranges.register(spark)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("file_facts").option("paths", "\n".join(paths)).load()


def read_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Size and sha256 of the existing files at or below paths, hashed where they are read."""
    paths = [path] if isinstance(path, str) else list(path)
    present = [p for p in paths if _exists(spark, p)]
    if not present:
        return spark.createDataFrame([], "path string, size_bytes long, sha256 string")
    return file_facts(spark, present).select("path", "size_bytes", "sha256")


def result_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """``relative_path, size_bytes, sha256, suffix`` of every file below a folder."""
    root = directory.rstrip("/") + "/"
    relative = F.substr(F.col("path"), F.lit(len(root) + 1))
    suffix = F.lower(F.regexp_extract("path", "[^/](\\.[^./]+)$", 1))
    return read_files(spark, directory).select(relative.alias("relative_path"), "size_bytes", "sha256", suffix.alias("suffix"))
