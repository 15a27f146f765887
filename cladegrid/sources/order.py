"""The order of rows across files: a global ordinal for rules in which the first or the last row wins."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain_path(uri: str) -> str:
    """A local file's URI as its path; other URIs stay."""
    return re.sub("^file:/+", "/", uri)


def ranked_files(scan: DataFrame, paths: Sequence[str]) -> list[tuple[str, int]]:
    """(path, rank) of the files of a scan: by the given path they are or lie below, then by their own path.

    A pattern that names no file itself ranks after the paths that do. Only names are handled, which Spark has
    listed on the driver already.
    """
    given: dict[str, int] = {}
    for k, path in enumerate(paths):
        given.setdefault(plain_path(path).rstrip("/"), k)

    def place(uri: str) -> int:
        file = unquote(uri)  # scans name files by encoded URIs
        while file:
            if file in given:
                return given[file]
            file = file.rpartition("/")[0]
        return len(given)

    files = sorted({plain_path(f) for f in scan.inputFiles()}, key=lambda f: (place(f), f))
    return [(f, k) for k, f in enumerate(files)]


def with_file_order(scan: DataFrame, paths: str | Sequence[str], name: str = "ordinal") -> DataFrame:
    """Add the place of each row: a struct of the file's rank, the start of the block read, and the row in it.

    ``scan`` is a file scan on which no rows were moved yet. However files are cut into blocks and blocks dealt to
    tasks, the struct sorts by the order of ``paths``, then of files below a path, then of lines: rows of a block are
    read by one task, one after the other. It is unique per row; its numbers are no line numbers. No second scan and
    no window is needed.
    """
    files = ranked_files(scan, [paths] if isinstance(paths, str) else list(paths))
    placed = scan.select(
        "*",
        F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    if len(files) <= 1:
        ranked = placed.withColumn("_rank", F.lit(0))
    else:
        # one row per file, sent to all tasks: rows would else be sorted by file, and a file is one key
        ranked = placed.join(F.broadcast(scan.sparkSession.createDataFrame(files, "_file string, _rank int")), "_file")
    ordinal = F.struct(F.col("_rank").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
    return ranked.withColumn(name, ordinal).drop("_file", "_block", "_row", "_rank")
