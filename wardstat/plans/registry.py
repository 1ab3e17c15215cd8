"""Named queries: a Spark function over the tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy readers of the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "events":
            df = df.withColumn("ts", df["ts"].cast("timestamp"))     # stored without a zone, meant as UTC
        return df


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under a name."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"repeated query name: {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add
