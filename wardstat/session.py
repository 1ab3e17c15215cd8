"""Session, shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a side that may be broadcast. At ~100 bytes a row this stays far
# below the executor heap; anything larger is joined by shuffle instead.
MAX_BROADCAST_ROWS = 200_000


def build_session(app: str, master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings every job here relies on."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false"))
    if master:
        b = b.master(master).config("spark.driver.memory", "12g")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    path would live on one machine and be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wardstat-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table written and read back in one job."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A step that several branches read: written once, pruned by each reader, and safe from lost executors."""
    return stored(df, scratch_path(df.sparkSession, "step"))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a step of an iteration to the shared folder and go on from the table.

    Like a checkpoint it outlives lost executors; unlike one it has file
    statistics, so Catalyst can see when a step has become small.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it is counted to be small, else leave the join to shuffle.

    The count stops at ``max_rows + 1`` rows, so checking a large table is cheap.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def literal_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A config table written in code; its size is fixed, so it may be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (totals, thresholds) through a scalar subquery."""
    row = one_row.select(F.struct("*").alias("s")).scalar()
    return df.withColumn("_one", row).select(*df.columns, "_one.*")
