"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import stored
from ..sources.stored import scope, shared_dir

__all__ = ["documents", "kept", "modest_batches", "picked", "pieces", "saved", "scope", "shared_dir", "whole_text", "without"]


#: Bytes of one batch between Spark and Python: a task holds a few of them on both sides, so memory stays small.
BATCH_BYTES = 4 << 20


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once and read again, with small batches to and from Python meanwhile."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_BYTES))
    try:
        return stored.saved(df, name)
    finally:
        conf.set(key, before)


def modest_batches(spark: SparkSession) -> None:
    """Batches of BATCH_BYTES between Spark and Python for whatever the session works out from now on, unless it sets another size.

    For results that the caller writes: an executor holds two batches for each task outside its heap, in either direction.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def kept(df: DataFrame, name: str) -> DataFrame:
    """df saved so that it outlives the scope around it, whose own tables it is made from."""
    with stored.outside():
        return saved(df, name)


def pieces(df: DataFrame, piece_mb: int = 64) -> int:
    """How many partitions a shuffle of df should have: grows with the planner's estimate of its size."""
    conf = df.sparkSession.conf
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(conf.get("spark.sql.shuffle.partitions")), min(size // (piece_mb << 20), 200_000))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text"):
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


#: Ids that are sent to every executor to pick rows by; more are joined by a shuffle.
BROADCAST_IDS = 300_000


def picked(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in ids, with its columns; ids are broadcast only where counted as few."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key)


def without(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in ids, with its columns; rows move only where ids are counted as too many to broadcast."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_anti")
