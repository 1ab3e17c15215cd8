"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.session import scratch_path, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), component being the least node reachable.

    Each round hangs nodes under smaller ones until every edge is (node, least node); their number grows with the
    logarithm of the largest component's diameter. A node with many edges is combined map-side and joined with skew
    splitting. Each round is a table in the shared folder.
    """
    spark = edges.sparkSession
    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), scratch_path(spark, "edges"))
    while True:
        both = now.union(now.select("m", "v"))
        least = both.groupBy("v").agg(F.min("m").alias("to")).select("v", F.least("v", "to").alias("to"))
        large = both.join(least, "v").filter(F.col("m") > F.col("v")).select(F.col("m").alias("v"), F.col("to").alias("m")).filter("v != m").distinct()
        large = stored(large, scratch_path(spark, "edges"))
        least = large.groupBy("v").agg(F.min("m").alias("to"))
        hung = large.join(least, "v").select(F.col("m").alias("v"), F.col("to").alias("m")).union(least.select("v", F.col("to").alias("m")))
        after = stored(hung.filter("v != m").distinct(), scratch_path(spark, "edges"))
        # a fixed point has the same edges as before: compare sums that do not depend on order
        seal = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % 1_000_000_007), F.sum(F.xxhash64("m", "v") % 998_244_353)).first()
        if seal(now) == seal(after):
            break
        now = after
    return now.select(F.col("v").alias("node"), F.col("m").alias("component")).union(now.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct())
