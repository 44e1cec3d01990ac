"""The corpus pipeline: documents are judged, deduplicated, masked, mixed and packed; each stage's result is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import modest_batches, saved
from tidemark.llm.mixing import sample
from tidemark.llm.near_duplicates import one_of_each
from tidemark.llm.packing import pack
from tidemark.llm.pii import mask
from tidemark.llm.quality import keep_good, learned


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score under 0.3 go. A null text is judged as the empty one, repeated rows and null ids by their
    texts; an empty table stays empty; other columns stay as they are."""
    modest_batches(spark)
    return keep_good(docs, learned(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group stays, and every one with a null id; null, empty and blank texts are in no group; of rows
    that repeat an id one of each text stays; an empty table stays empty; other columns stay as they are."""
    modest_batches(spark)
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked in the texts; n_chars follows. Every row stays, a null text stays null, an empty table empty."""
    modest_batches(spark)
    masked = mask(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in the fitted mix of sources, languages and topics stays, by a hash of the id: repeated ids stay or go together, null
    ones too; null sources and languages are a kind of their own; a null text weighs one word; an empty table stays empty."""
    modest_batches(spark)
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens. A null text is the empty one, of one token; repeated rows and null ids are packed like
    others; an empty table gives no rows; other columns go."""
    modest_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]

#: Learned scores, components and greedy packing aren't SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Nulls, repeats, empty texts and tables, and other columns are as each stage's operator says."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
