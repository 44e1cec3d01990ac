"""Token-id shards with keyed access through minimal perfect hashes.

Layout of a store: ``payload/*.bin`` holds raw little-endian ids of documents one after another; ``manifest`` (Parquet)
lists what was committed; ``index`` (Parquet) has one row per key bucket: a minimal perfect hash over the bucket's
keys, and by slot a stored fingerprint, shard, offset, length and global start.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, shared_dir, whole_text
from .tokens import ChunkEncoder, id_dtype, small_batches, texts_of

#: Buckets of the index in one folder, and up to how many folders a lookup names to Spark instead of reading them all.
SPAN, NAMED = 16, 1000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Levels of bit arrays: a key sits at the first level where it collided with no other; its slot is that bit's rank."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes.astype(np.int64), words
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @staticmethod
    def _at(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(h1 ^ _mix(h2 + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, gamma: float = 1.6) -> "PerfectHash":
        left, sizes, words = np.arange(len(h1)), [], []
        while len(left):
            if len(sizes) == 200:
                raise ValueError("two keys have the same 128-bit hash")
            size = 64 * max(1, -(-int(len(left) * gamma) // 64))
            at = cls._at(h1[left], h2[left], len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has it. A key never built in may get any slot: compare fingerprints."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self._at(h1[left], h2[left], level, size) + self.first[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.ranks[at >> 6] + below)[hit]
            left = left[~hit]
        return out


INDEX = "bucket int, n_keys long, sizes binary, words binary, fingerprints binary, files array<string>, file binary, at binary, n_tokens binary, start binary"


def _hashes(key: str, nth: str):
    """Two 64-bit hashes of a key (a document's id and its occurrence among rows with that id)."""
    k = F.col(key).cast("string")
    return F.xxhash64(k, F.col(nth)).alias("h1"), F.xxhash64(F.lit("fp"), F.col(nth), k).alias("h2")


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = 1 << 25, bucket_keys: int = 20_000) -> None:
    """Encode every row, append end_id, and write shards in ascending id order, a manifest and the index.

    A null text is the empty text (one id: the end id). Rows with the same id are kept, in any order among themselves,
    and keyed by (id, occurrence from 0). A null id sorts first and is a key like others. An empty table gives a store
    without shards. Other columns are ignored. Texts are streamed: a task holds a few texts and a buffer of 1 MB. A task
    that is run again writes files of new names, and only those of the attempt that was committed are in the manifest.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))
    ordered = rows.repartitionByRange(pieces(rows), F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
    payload = f"{path}/payload"

    def write(batches):
        task = TaskContext.get()
        coder = ChunkEncoder.of(tokenizer_path)
        end = np.array([end_id], coder.dtype).tobytes()
        files, root = fs.FileSystem.from_uri(payload)
        files.create_dir(root, recursive=True)
        shard, out, at, last, nth = 0, None, 0, object(), 0
        try:
            for batch in small_batches(batches):
                got = {n: [] for n in ("part", "shard", "file", "nth", "at", "n_tokens")}
                for key, ids in zip(batch.column("key").to_pylist(), coder.encode(texts_of(batch))):
                    if out is None or at >= shard_ids:
                        if out is not None:
                            out.close()
                            shard += 1
                        name, at = f"{task.partitionId():06d}-{shard:04d}-{task.taskAttemptId()}.bin", 0
                        out = files.open_output_stream(f"{root}/{name}", buffer_size=1 << 20)
                    out.write(ids + end)
                    nth, last = (nth + 1 if key == last else 0), key
                    n = len(ids) // coder.dtype.itemsize + 1
                    for k, v in zip(got, (task.partitionId(), shard, name, nth, at, n)):
                        got[k].append(v)
                    at += n
                types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(v, t) for v, t in zip(got.values(), types))], names=["key", *got])
        finally:
            if out is not None:
                out.close()
            coder.rest()

    key_type = rows.schema["key"].dataType.simpleString()
    ordered.mapInArrow(write, f"key {key_type}, part int, shard int, file string, nth long, at long, n_tokens long").write.parquet(f"{path}/manifest")
    manifest = spark.read.parquet(f"{path}/manifest")
    # One row per shard: few, and their running sum gives each document its global start.
    shards = manifest.groupBy("part", "shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("part", "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    buckets = -(-manifest.count() // bucket_keys)
    keyed = (
        manifest.select("*", *_hashes("key", "nth"))
        .join(shards, ["part", "shard"])
        .select(F.pmod("h1", F.lit(max(1, buckets))).cast("int").alias("bucket"), "h1", "h2", "file", "at", "n_tokens", (F.col("base") + F.col("at")).alias("start"))
    )

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64)
        mph = PerfectHash.build(h1, h2)
        order = np.argsort(mph.slots(h1, h2))
        names, file = np.unique(rows["file"].to_numpy(), return_inverse=True)
        column = lambda v, t: np.asarray(v)[order].astype(t).tobytes()
        return pd.DataFrame({
            "bucket": [rows["bucket"].iloc[0]], "n_keys": [len(rows)], "sizes": [mph.sizes.tobytes()], "words": [mph.words.tobytes()], "fingerprints": [column(h2 >> np.uint64(32), "<u4")],
            "files": [list(names)], "file": [column(file, "<u4")], "at": [column(rows["at"], "<i8")], "n_tokens": [column(rows["n_tokens"], "<i8")], "start": [column(rows["start"], "<i8")],
        })

    keyed.groupBy("bucket").applyInPandas(index, INDEX).withColumn("span", F.floor(F.col("bucket") / SPAN)).write.partitionBy("span").parquet(f"{path}/index")
    meta = spark.createDataFrame([(buckets, id_dtype(tokenizer_path), key_type)], "buckets int, dtype string, key_type string")
    meta.coalesce(1).write.parquet(f"{path}/meta")


def find(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Where the rows of keys (key, nth) lie: (key, nth, file, at, n_tokens, start). A key that is not stored gives no row.

    Each key costs one slot and one fingerprint comparison; a key that was never stored passes with a chance of 2^-32. Keys
    that fall into few folders of the index have only those read. A repeated key counts once; a null key is one like others.
    """
    buckets = spark.read.parquet(f"{path}/meta").first()["buckets"]
    stored = spark.read.schema(f"{INDEX}, span long").parquet(f"{path}/index") if buckets else spark.createDataFrame([], f"{INDEX}, span long")
    asked = keys.distinct().select("key", "nth", *_hashes("key", "nth")).withColumn("bucket", F.pmod("h1", F.lit(max(1, buckets))).cast("int"))
    if buckets > SPAN:
        spans = asked.select(F.floor(F.col("bucket") / SPAN).alias("span")).distinct().limit(NAMED + 1).collect()
        if len(spans) <= NAMED:
            stored = stored.filter(F.col("span").isin([r["span"] for r in spans]))

    def look(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(index):
            none = pd.Series([], dtype=np.int64)
            return pd.DataFrame({"key": asked["key"][:0], "nth": none, "file": pd.Series([], dtype=object), "at": none, "n_tokens": none, "start": none})
        row = index.iloc[0]
        h1, h2 = asked["h1"].to_numpy().view(np.uint64), asked["h2"].to_numpy().view(np.uint64)
        slots = PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], "<u8")).slots(h1, h2)
        prints = np.frombuffer(row["fingerprints"], "<u4")
        here = (slots >= 0) & (prints[np.maximum(slots, 0)] == (h2 >> np.uint64(32)).astype("<u4"))
        slots = slots[here]
        column = lambda n, t: np.frombuffer(row[n], t)[slots]
        files = np.array(list(row["files"]), object)[column("file", "<u4")]
        return pd.DataFrame({"key": asked["key"][here], "nth": asked["nth"][here], "file": files, "at": column("at", "<i8"), "n_tokens": column("n_tokens", "<i8"), "start": column("start", "<i8")})

    kind = keys.schema["key"].dataType.simpleString()
    return asked.groupBy("bucket").cogroup(stored.drop("span").groupBy("bucket")).applyInPandas(look, f"key {kind}, nth long, file string, at long, n_tokens long, start long")


def get(spark: SparkSession, path: str, key, nth: int = 0) -> np.ndarray | None:
    """The ids of one key, or None: one bucket of the index and one range of one payload file are read, however large the store.

    The key is cast to the type of the stored ids, so that it is hashed as they were; one that has no such value isn't there.
    """
    meta = spark.read.parquet(f"{path}/meta").first()
    if not meta["buckets"]:
        return None
    key = key.item() if isinstance(key, np.generic) else key
    asked = spark.createDataFrame([(key, nth)], ["key", "nth"] if key is not None else f"key {meta['key_type']}, nth long")
    asked = asked.select(F.col("key").try_cast(meta["key_type"]).alias("key"), F.col("nth").cast("long").alias("nth"))
    h = asked.select("key", *_hashes("key", "nth")).first()
    if key is not None and h["key"] is None:
        return None
    bucket = h["h1"] % meta["buckets"]
    row = spark.read.schema(INDEX).parquet(f"{path}/index/span={bucket // SPAN}").filter(F.col("bucket") == bucket).first()
    h1, h2 = np.array([h["h1"]], np.int64).view(np.uint64), np.array([h["h2"]], np.int64).view(np.uint64)
    slot = PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], "<u8")).slots(h1, h2)[0] if row else -1
    entry = lambda n, t: np.frombuffer(row[n], t)[slot]
    if slot < 0 or entry("fingerprints", "<u4") != (h2 >> np.uint64(32)).astype("<u4")[0]:
        return None
    files, root = fs.FileSystem.from_uri(f"{path}/payload")
    dtype = np.dtype(meta["dtype"])
    with files.open_input_file(f"{root}/{row['files'][entry('file', '<u4')]}") as source:
        held = source.read_at(int(entry("n_tokens", "<i8")) * dtype.itemsize, int(entry("at", "<i8")) * dtype.itemsize)
    return np.frombuffer(held, dtype)


def read(spark: SparkSession, path: str, found: DataFrame, window: int = 1 << 21) -> DataFrame:
    """The ids of found rows, from the payload files: adds ids (binary, unsigned little-endian 32-bit).

    Rows of one shard are read in one task in offset order through a window, so a shard is read once, front to back.
    No rows give none; columns of found stay as they are, whatever their names but for ids; rows that repeat a place and rows with null
    keys are read like others.
    """
    dtype = np.dtype(spark.read.parquet(f"{path}/meta").first()["dtype"])
    payload = f"{path}/payload"
    placed = found.repartition("file").sortWithinPartitions("file", "at")

    def load(batches):
        files, root = fs.FileSystem.from_uri(payload)
        name, source, first, held = None, None, 0, b""
        for batch in small_batches(batches):
            ids = []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if file != name:
                    name, source, first, held = file, files.open_input_file(f"{root}/{file}"), 0, b""
                lo, size = at * dtype.itemsize, n * dtype.itemsize
                if not first <= lo <= lo + size <= first + len(held):
                    first, held = lo, source.read_at(max(size, min(window, source.size() - lo)), lo)
                ids.append(np.frombuffer(held, dtype, n, lo - first).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, "ids"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    return placed.mapInArrow(load, f"{columns}, ids binary")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the store, asked for by its key; nulls and repeats as in write_store()."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = shared_dir(spark, "token-store")
    write_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    # Every stored key is asked for through the index: each id, and each occurrence of it.
    keys = docs.groupBy(F.col("doc_id").alias("key")).count().select("key", F.explode(F.expr("sequence(0L, count - 1)")).alias("nth"))
    rows = read(spark, path, find(spark, path, keys))

    def digest(batches):
        for batch in batches:
            crc = pa.array([zlib.crc32(x) for x in batch.column("ids").to_pylist()], pa.int64())
            size = pa.array([len(x) // 4 for x in batch.column("ids").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("start"), size, crc], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("key", "start", "ids").mapInArrow(digest, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")
