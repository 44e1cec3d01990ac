"""Derived tables that are kept between runs and rebuilt only where their inputs changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stored import saved


@dataclass
class Reused:
    """The table in force, and how many of its keys were rebuilt, kept and removed."""

    table: DataFrame
    rebuilt: int
    kept: int
    removed: int


def fingerprints(inputs: DataFrame, key: str, build: str) -> DataFrame:
    """(key, _print): count and order-free hash sum of a key's input rows, with the name of the code and settings that build from them."""
    others = sorted(c for c in inputs.columns if c != key)
    return inputs.groupBy(key).agg(F.concat_ws(":", F.lit(build), F.count("*").cast("string"), F.sum(F.xxhash64(*others).cast("decimal(38,0)")).cast("string")).alias("_print"))


def reused(inputs: DataFrame, derive: Callable[[DataFrame], DataFrame], path: str, key: str, build: str = "1", buckets: int = 64) -> Reused:
    """derive(inputs), by keys, from the table under path where a key's inputs are those it was built from.

    derive must give rows of a key from that key's input rows alone. Rows are stored by buckets of keys, each with the
    fingerprint it was built from; only buckets with a changed, new or removed key are written again, from their unchanged rows
    and what is built anew. Another ``build`` (code or settings) rebuilds everything. Null keys take no part.
    """
    spark = inputs.sparkSession
    own = inputs.filter(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    now = saved(fingerprints(own, key, build), "fingerprints")
    try:
        known = spark.read.parquet(f"{path}/fingerprints").select(key, F.col("_print").alias("_old"))
    except AnalysisException:  # the first run
        known = now.select(key, F.col("_print").alias("_old")).limit(0)
    state = F.when(F.col("_print").isNull(), "removed").when(F.col("_print").eqNullSafe(F.col("_old")), "kept").otherwise("rebuilt")
    both = saved(now.join(known, key, "full_outer").withColumn("_state", state), "states")
    counts = {r["_state"]: r["count"] for r in both.groupBy("_state").count().collect()}
    if counts.get("rebuilt") or counts.get("removed"):
        anew = both.filter("_state = 'rebuilt'").select(key, "_print")
        rows = derive(own.join(anew.select(key), key, "left_semi")).join(anew, key).withColumn("_bucket", bucket)
        if counts.get("kept"):
            touched = both.filter("_state <> 'kept'").select(bucket).distinct()
            old = spark.read.parquet(f"{path}/rows").join(F.broadcast(touched), "_bucket", "left_semi")
            rows = rows.unionByName(old.join(both.filter("_state = 'kept'").select(key, "_print"), [key, "_print"], "left_semi"))
        rows = saved(rows, "rebuilt")  # what is read is written over
        rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{path}/rows")
        now.write.mode("overwrite").parquet(f"{path}/fingerprints")
    # A bucket that nothing is written to keeps its folder: rows in force are those of the fingerprints in force.
    table = spark.read.parquet(f"{path}/rows").join(now, [key, "_print"], "left_semi").drop("_bucket", "_print")
    return Reused(table, counts.get("rebuilt", 0), counts.get("kept", 0), counts.get("removed", 0))
