"""Connected components of an edge table by alternating large-star and small-star steps, every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, saved, scope


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v) that isn't its component's smallest node itself.

    Each step keeps at most as many edges as there were; the number of steps grows with the logarithm of the longest
    path. Nothing is collected but the count and a hash sum that tell when nothing changes any more.
    """
    with scope():
        now = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        before, mark = None, _mark(now)
        while mark != before and mark[0]:
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("m", F.least("u", "least")).select("u", "m")
            large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = large.filter("u <> v").distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            now = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
            before, mark = mark, _mark(now)
        return kept(now.select(F.col("u").alias("node"), F.col("v").alias("root")), "components")
