"""Outputs: metric tables, point files, sharded JSON and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.operators.checks import METRIC_COLUMNS, METRIC_TYPES, metrics_problems

# Records per shard file. A busy shard is split into more parts, so no task
# ever collects an unbounded group.
SHARD_ROWS = 20_000


def write_metrics(m: DataFrame, path: str, fmt: str = "csv") -> None:
    """Check the output contract, then write one folder per geography type, as CSV with a header unless told otherwise."""
    bad = metrics_problems(m).collect()      # at most nine rows
    if bad:
        raise ValueError("metrics table invalid: " + "; ".join(f"{r['problem']} ({r['rows']})" for r in bad))
    m.write.mode("errorifexists").partitionBy("geo_type").option("header", True).format(fmt).save(path)


def read_metrics(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A metrics table that ``write_metrics`` wrote, with the contract's columns and types."""
    schema = ", ".join(f"{c} {METRIC_TYPES[c]}" for c in METRIC_COLUMNS)
    return spark.read.schema(schema).option("header", True).option("positiveInf", "Infinity").format(fmt).load(path).select(*METRIC_COLUMNS)


def points_geojson(points: DataFrame, fields: list[str]) -> DataFrame:
    """One GeoJSON feature per located point (GeoJSONSeq lines), coordinates to 6 decimals."""
    props = F.struct(*fields, "match_quality")
    geom = F.struct(F.lit("Point").alias("type"),
                    F.array(F.round("lon", 6), F.round("lat", 6)).alias("coordinates"))
    return points.where("lon is not null and lat is not null").select(
        F.to_json(F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"), props.alias("properties"))).alias("value"))


def compact(m: DataFrame, cols: list[str]) -> DataFrame:
    """The columns the front end reads; an infinite upper bound is coded -1."""
    top = F.when(F.col("ci_high") == float("inf"), -1.0).otherwise(F.col("ci_high"))
    return m.withColumn("ci_high", top).select(*cols)


def shard_documents(rows: DataFrame, shard: str, order: list[str], cols: list[str], per_file: int = SHARD_ROWS) -> DataFrame:
    """shard, part, n, document: column-major JSON of each shard's rows, in order.

    Small shards are one part. A shard with more than ``per_file`` rows is cut
    into parts by a hash of its order key; parts hold disjoint rows, together
    all of them.
    """
    size = rows.groupBy(shard).agg(F.ceil(F.count(F.lit(1)) / per_file).alias("_parts"))
    d = rows.join(size, shard).withColumn("part", F.when(F.col("_parts") == 1, 0).otherwise(
        F.pmod(F.xxhash64(*order), F.col("_parts"))).cast("int"))
    line = F.struct(*order, *[c for c in cols if c not in order])
    g = d.groupBy(shard, "part").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(line)).alias("_r"))
    by_col = F.struct(*[F.col("_r")[c].alias(c) for c in cols])
    return g.select(shard, "part", "n", F.to_json(by_col).alias("document"))


def report_document(checks: DataFrame) -> DataFrame:
    """A validation report as one JSON text; checks are a short fixed list."""
    return checks.agg(F.to_json(F.struct(
        F.when(F.count_if(~F.col("passed") & (F.col("severity") == "error")) > 0, "fail").otherwise("pass").alias("status"),
        F.count(F.lit(1)).alias("checks_run"),
        F.sort_array(F.collect_list(F.struct("name", "kind", "passed", "severity", "detail"))).alias("checks"))).alias("document"))


def seeded_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """n rows in hash order of a seeded key: a top-k per task, stable under repartitioning."""
    return df.withColumn("_h", key).orderBy("_h").limit(n).drop("_h")


def write_tables(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("errorifexists").option("header", True).csv(f"{path}/{name}")
