"""Session settings the operators are written for, and lineage cutting that survives lost executors."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that change plans, not results. Skewed sort-merge joins are split at run time even when
# that costs one more exchange; NULL division and bad casts are handled by try_* functions, so ANSI
# mode stays on. Session-level ones can be applied to a session somebody else made.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Upper bounds of the bytes a task starts from; a session's smaller values stay. Columns of keys compress well and
# take tens of times their shuffled bytes in the hash map or sort of a task, so the usual 64 and 128 MB are too many.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
}


def byte_count(text: str) -> int:
    """The number of bytes of a setting such as ``64MB``, ``16m`` or ``8388608b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def apply_plan_settings(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if byte_count(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cladegrid")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in PLAN_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder that ``spark.checkpoint.dir`` names.

    Only where it is unset and the session is a single JVM (tests) does it become a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the reliable checkpoint folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
