"""Registry of the queries on the benchmark tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.session import apply_plan_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Callable[["Tables"], DataFrame]], Query]:
    """Register a query function of the tables, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(apply_plan_settings(spark), sf_dir))

        key = name or fn.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


class Tables:
    """Tables of one scale directory as attributes: ``tables.lineitem`` and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that the order of summation does not show."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def day(column: str) -> Column:
    """Days since 1970-01-01 as a long coordinate."""
    return F.unix_date(F.to_date(column)).cast("long")
