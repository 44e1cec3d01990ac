"""Token counts by a digest cache: content digest and tokenizer digest join to stored counts; only distinct misses are encoded."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_IDS, saved, shared_dir, whole_text
from .tokens import small_batches, texts_of

CACHE = T.StructType([T.StructField("digest", T.StringType()), T.StructField("tokenizer", T.StringType()), T.StructField("n_tokens", T.LongType())])


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's content, so a changed file never meets counts of the old one."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:32]


def _encoder(path: str):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens) for every row of docs, and the cache at cache_path with the misses appended.

    A null text counts as the empty text (0 bytes, 0 tokens); repeated rows and equal texts are encoded once and each
    returned; rows with a null id are counted too; an empty table gives an empty result; other columns are ignored.
    The digest is sha-256 over the UTF-8 bytes with null made empty: no further folding, since it would change counts.
    Equal texts meet in an aggregation with map-side combine, so a text that a third of all rows have is one row a task;
    counts are joined to rows by a join that Spark may split. Where few digests are missing, only their texts move at all.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    keyed = saved(rows.select("id", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    known = lambda: cache(spark, cache_path).filter(F.col("tokenizer") == version)
    misses = saved(keyed.select("digest").distinct().join(known(), "digest", "left_anti"), "misses")
    few = misses.count() <= BROADCAST_IDS
    texts = rows.select(F.sha2("text", 256).alias("digest"), "text")
    if few:
        texts = texts.join(F.broadcast(misses), "digest", "left_semi")
    texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if not few:
        texts = texts.join(misses, "digest", "left_semi")

    def encode(batches):
        count = _encoder(tokenizer_path)
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_pydict({"digest": batch.column("digest"), "n_tokens": pa.array(count([t.decode() for t in texts_of(batch)]), pa.int64())})

    new = texts.select("digest", "text").mapInArrow(encode, "digest string, n_tokens long")
    new.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    # Written once more, each digest once, so that the join below is of two plain shuffles and can be split.
    stored = saved(known().groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "counts")
    return keyed.join(stored, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; empty where nothing has been stored yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens, through a cache that starts empty; nulls and repeats as in token_counts()."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), shared_dir(spark, "token-count-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
