"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables written in each open scope, the innermost last.
_scopes: contextvars.ContextVar[tuple[list, ...]] = contextvars.ContextVar("scopes", default=())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir; where that is unset, one is set for a single machine, and a cluster is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once and read again: what follows reads it instead of working it out for every use."""
    path = shared_dir(df.sparkSession, name)
    if _scopes.get():
        _scopes.get()[-1].append((df.sparkSession, path, df.schema))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope():
    """Tables saved inside lose their files at the end: what is to outlive them is written by ``outside`` before.

    Until then a lost executor's work is done again from them.
    """
    mine: list = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        for spark, path, schema in mine:
            spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


@contextlib.contextmanager
def outside():
    """Tables saved inside belong to the scope around the innermost one, or to none."""
    token = _scopes.set(_scopes.get()[:-1])
    try:
        yield
    finally:
        _scopes.reset(token)


def replace_vintages(df: DataFrame, path: str, by: str = "vintage_id") -> None:
    """The vintages of df take the place of those stored under path; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
