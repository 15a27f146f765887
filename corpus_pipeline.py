"""Training-data pipeline over ``documents``: language, near-duplicates, benchmark leaks, secrets, source weights.

Every stage works on all rows that its predecessor kept and returns the columns of documents; its result is written as
Parquet in the folder shared by the cluster and read again. ``run`` returns the mix of the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.llm import decontaminate, language, mixing, neardup, secrets
from cladegrid.session import apply_plan_settings, shared_folder

# Predictions below this share are no decision for a language.
LEAST_SCORE = 0.5
# Similarity of near-duplicates in percent, over shingles of five words.
SIMILAR = 80
# Rows and bytes of an Arrow batch; stages share Python workers, whose memory follows the batches.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def _small_batches(spark: SparkSession) -> None:
    apply_plan_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter or without a clear language go. Missing labels are filled."""
    _small_batches(spark)
    found = language.predict(docs, language.fit(docs))
    known = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return known.select(F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred")).alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    _small_batches(spark)
    return neardup.drop_near_duplicates(docs, percent=SIMILAR)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    _small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"), drop=True)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` follows the text."""
    _small_batches(spark)
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for."""
    _small_batches(spark)
    return mixing.mix(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Near-duplicates and the language model have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
