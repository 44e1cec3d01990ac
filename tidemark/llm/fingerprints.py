"""Canonical exact digests: Unicode, case and white-space folding, a 128-bit xxhash, and byte comparison in equal buckets."""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import picked, pieces, saved, whole_text
from .tokens import small_batches


def canonical(text: str) -> bytes:
    """The folded text: NFKC, full case folding, NFKC again, white-space runs as one blank, none at the ends."""
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.split()).encode()


def fingerprint(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(canonical(text))


def likeness(a: str, b: str) -> float:
    """An exact digest tells equal from unequal and nothing between."""
    return 1.0 if a == b else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) for every row; a null text is the empty text; null and repeated ids keep their rows.

    An empty table gives no rows; other columns are ignored, whatever their names. Texts are digested whole. No shuffle.
    """

    def digest(batches):
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.string())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(digest, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


def same_text(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=fingerprint) -> DataFrame:
    """(id, fingerprint, class_id): the smallest id whose canonical bytes are equal, for every id and fingerprint of prints.

    Buckets of equal fingerprints are compared byte by byte with their first document; those that differ (a collision of
    the digest) form buckets of their own and are compared again, until none differs. Only documents that share a bucket
    move their texts, and the join on the bucket is one that Spark may split when a bucket is huge. A repeated id has a row
    for each of its fingerprints (rows that repeat both count once, by their smallest text); null ids have none; an empty
    table gives no rows; other columns are ignored. ``digest`` is what made the fingerprints.
    """
    kind = prints.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    left = prints.select(F.col(id_col).alias("id"), "fingerprint").filter("id is not null").distinct().withColumn("bucket", F.col("fingerprint"))
    key, done = ["id", "fingerprint", "bucket", "leader"], None

    def own_text(batches):  # of a repeated id only the texts of that fingerprint
        for batch in small_batches(batches):
            yield batch.filter(pa.array([digest(t) == f for t, f in zip(batch.column("text").to_pylist(), batch.column("fingerprint").to_pylist())], pa.bool_()))

    def compare(batches):
        for batch in small_batches(batches):
            same = [canonical(a) == canonical(b) for a, b in zip(batch.column("text").to_pylist(), batch.column("first_text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), pa.array(same, pa.bool_())], names=[*key, "same"])

    while True:
        leaders = left.groupBy("bucket").agg(F.min("id").alias("leader"), F.count("*").alias("n"))
        members = left.join(leaders, "bucket").select(*key, "n")
        shared = saved(members.filter("n > 1").drop("n"), "shared-buckets")
        shape = f"id {kind}, fingerprint string, bucket string, leader {kind}"
        own = picked(texts, shared).select(*key, "text").mapInArrow(own_text, f"{shape}, text string").groupBy(*key).agg(F.min("text").alias("text"))
        first = own.filter("id = leader").select("bucket", F.col("text").alias("first_text"))
        pairs = own.filter("id <> leader").join(first, "bucket").select(*key, "text", "first_text")
        compared = saved(pairs.mapInArrow(compare, f"{shape}, same boolean"), "same-text")
        settled = members.filter("id = leader").unionByName(compared.filter("same"), allowMissingColumns=True).select("id", "fingerprint", "leader")
        done = settled if done is None else done.unionByName(settled)
        left = compared.filter("not same").select("id", "fingerprint", F.concat("bucket", F.lit("+")).alias("bucket"))
        if left.isEmpty():
            return done.select(F.col("id").alias(id_col), "fingerprint", F.col("leader").alias("class_id"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint beside that of its edited text: the last quarter replaced by the start of the next row's text.

    Rows are put in id order by range (equal ids in one range, nulls first); each range is read once, front to back, and
    only its first and last texts are kept for the joins between ranges. After the last row comes the first. A null text is
    the empty text; null and repeated ids keep their rows; an empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    rows = rows.repartitionByRange(pieces(rows), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    shape = f"edge string, part int, id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string, text string"
    names = [f.split()[0] for f in shape.split(", ")]

    def edited(text: str, following: str) -> tuple[str, str]:
        cut = len(text) // 4
        text = text[: len(text) - cut] + following[:cut]
        return hashlib.sha256(text.encode()).hexdigest(), fingerprint(text)

    def batch_of(rows, id_type):
        columns = list(zip(*rows))
        types = [pa.string(), pa.int32(), id_type, pa.int64(), *[pa.string()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def walk(batches):
        part, before, id_type = TaskContext.get().partitionId(), None, None
        for batch in small_batches(batches):
            out, id_type = [], batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                own = fingerprint(text)
                if before is None:
                    out.append(("first", part, None, None, None, own, None, None, text))
                else:
                    out.append(("", part, before[0], len(before[1]), *(e := edited(before[1], text))[:1], before[2], e[1], own, None))
                before = key, text, own
            if out:
                yield batch_of(out, id_type)
        if before:
            yield batch_of([("last", part, before[0], len(before[1]), None, before[2], None, None, before[1])], id_type)

    walked = saved(rows.mapInArrow(walk, shape), "edited")
    by_part = Window.orderBy("part")  # one row per range
    firsts = walked.filter("edge = 'first'").select(
        F.coalesce(F.lag("part").over(by_part), F.max("part").over(Window.partitionBy())).alias("part"), F.col("text").alias("following"), F.col("fingerprint").alias("following_print")
    )
    lasts = walked.filter("edge = 'last'").join(firsts, "part")

    def close(batches):
        for batch in small_batches(batches):
            out = [(e := edited(t, f))[:2] for t, f in zip(batch.column("text").to_pylist(), batch.column("following").to_pylist())]
            keep = [batch.column(c) for c in ("id", "n_chars", "fingerprint", "following_print")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([e[0] for e in out], pa.string()), pa.array([e[1] for e in out], pa.string())], names=["id", "n_chars", "fingerprint", "next_fingerprint", "edited_sha256", "edited_fingerprint"])

    closed = lasts.mapInArrow(close, f"id {kind}, n_chars long, fingerprint string, next_fingerprint string, edited_sha256 string, edited_fingerprint string")
    whole = walked.filter("edge = ''").select(*closed.columns).unionByName(closed)
    near = lambda a, b: F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.lit(0.0))  # noqa: E731  what likeness() says
    return whole.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("fingerprint", "edited_fingerprint").alias("near_edited"), near("fingerprint", "next_fingerprint").alias("near_next"),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprints and class; nulls, repeats, empty texts and tables as edited_fingerprints() and same_text() say."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = saved(edited_fingerprints(docs), "fingerprints")
    return rows.join(same_text(docs, rows), ["doc_id", "fingerprint"], "left")
