"""Connected components of a link table by alternating large-star and small-star steps (DataFrame joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fedlake.session import scratch_path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link between different nodes.

    A round hangs every node's larger neighbours on its smallest neighbour (large star), then every node and its
    smaller neighbours on the smallest of them (small star), until the links no longer change. Each round's links are
    written, so a lost executor costs one round, and counted and hashed in the same job. Links of one node that many others
    share are joined with Spark's skew handling.
    """
    edges, mark = _written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges, now = _written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))))
        if now == mark:
            break
        mark = now
    return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct links between different nodes, as a table in the shared folder, and their number and hash."""
    spark = edges.sparkSession
    seen = Observation()
    path = scratch_path(spark, "links")
    edges = edges.where("u <> v").distinct()
    edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["h"])
