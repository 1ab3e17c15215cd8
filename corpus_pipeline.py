"""A corpus pipeline: every stage takes all that the one before it kept and writes it as Parquet.

Toxic documents go; frequent lines go except in their last document; of each group of near-duplicates the first document
stays; documents that hold a benchmark item go; the rest is mixed to target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm import decontamination, line_dedup, minhash_dedup, mixing, toxicity
from wardstat.session import scratch_path, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a lexicon learned from the labels scores below 0.3."""
    lexicon = toxicity.learn_on_training_part(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, lexicon)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three hold, except in the one with the largest id."""
    out = line_dedup.dedupe_lines(docs).select(docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five words are similar by 0.8 or more, the one with the smallest id."""
    gone = minhash_dedup.near_duplicates(docs, size=5, percent=80).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.remove_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document that is taken, and for how many epochs."""
    domain, weights = mixing.stage_settings()
    return mixing.mix(docs, domain, weights, share=(1, 1), max_epochs=4, seed=7).filter("copies > 0")


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near dedup", drop_near_duplicates), ("decontamination", drop_leaks), ("mixing", mix_sources)]

#: SQL cannot express the learned lexicon; tests hold each stage against a brute-force form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), scratch_path(spark, f"corpus-{i}"))
    return docs
