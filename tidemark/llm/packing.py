"""Lexical retrieval packing: BM25 over sharded inverted indexes finds unused neighbours that fill each seed's window.

Documents are encoded once; document frequencies and lengths are counted over all of them; rows are range-partitioned by
their most telling term (of the highest tf * idf in this corpus), so lexically close documents share a shard and a hot
term is split by document. Each shard holds an inverted index of at most ``shard_tokens`` tokens and is packed greedily.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, saved, whole_text
from .tokens import ChunkEncoder, give_back, id_dtype, small_batches, term_runs, texts_of

OUT = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, ids): each text's ids and end_id as little-endian bytes.

    A null text is the empty one and has end_id alone; null and repeated ids keep their rows; an empty table gives none; other
    columns are ignored. A text is encoded whole.
    """

    def encode(batches):
        coder = ChunkEncoder.of(tokenizer_path)
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in small_batches(batches, rows=1024):  # the more texts at once, the fewer pieces are looked up again
            out = pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x + end for x in coder.encode(texts_of(batch))], pa.binary())], names=["id", "ids"])
            yield from (out.slice(at, 256) for at in range(0, out.num_rows, 256))
        coder.rest()

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


def term_counts(ids: DataFrame, dtype: str) -> tuple[int, int, np.ndarray]:
    """Documents, tokens and document frequencies over all rows; the vocabulary bounds what reaches the driver."""

    def count(batches):
        ChunkEncoder.forget()
        df, n, tokens = np.zeros(1 << 16, np.int64), 0, 0
        for batch in small_batches(batches):
            found = [np.frombuffer(x, dtype) for x in batch.column("ids").to_pylist()]
            terms = np.bincount(term_runs(found)[1], minlength=len(df))
            terms[: len(df)] += df
            df, n, tokens = terms, n + len(found), tokens + sum(map(len, found))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array([-2, -1, *seen], pa.int64()), "n": pa.array([n, tokens, *df[seen]], pa.int64())})

    total = {r["term"]: r["n"] for r in ids.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(max([0, *total]) + 1, np.int64)
    for term, n in total.items():
        if term >= 0:
            df[term] = n
    return total.get(-2, 0), total.get(-1, 0), df


#: Bytes of postings a shard keeps as whole rows, its longest lists first; the others are kept as lists. No result depends on it.
ROWS = 16 << 20


class Shard:
    """An inverted index with BM25 weights, and which of its documents are unused.

    Used documents are dropped from the postings whenever they are a quarter of those indexed, so later searches read less.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float, k1: float = 1.2, b: float = 0.75):
        self.n = len(docs)
        self.size = np.array([len(d) for d in docs])
        parts, at = [], 0
        for end in [*np.flatnonzero(np.diff(np.cumsum(self.size) >> 18)) + 1, self.n]:  # about 2^18 tokens at once
            of, term, tf = term_runs(docs[at:end])
            keep = idf[term] > 0  # a term of most documents has weight 0
            of, term, tf = of[keep], term[keep], tf[keep].astype(np.int32)
            weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * self.size[of + at] / mean_length))
            parts.append(((of + at).astype(np.int32), term.astype(np.uint16 if len(idf) <= 1 << 16 else np.int32), weight))  # 16 bits are sorted fastest
            at = end
        parts = [list(p) for p in zip(*parts)]
        of, self.slot, weight = (np.concatenate(parts.pop(0)) for _ in range(3))
        del parts, term, tf, keep  # what is done with is dropped at once: a shard's postings are most of what a task holds
        # per (document, term) self.slot is the term, which is the number of its posting list
        self.bounds = np.searchsorted(of, np.arange(self.n + 1))
        count = np.bincount(self.slot, minlength=len(idf))
        order = np.argsort(self.slot, kind="stable").astype(np.int32)
        docs_of, weights = of[order], weight[order]
        del of, weight, order
        self.indexed = np.arange(self.n)  # documents of the index, in order
        longest = np.argsort(-count, kind="stable")[: ROWS // (8 * max(1, self.n))]
        longest = longest[count[longest] * 16 >= self.n]
        self.row = np.full(len(idf), -1, np.int32)
        self.row[longest] = np.arange(len(longest))
        ends = np.cumsum(count)
        self.rows = []
        for end, size in zip(ends[longest].tolist(), count[longest].tolist()):
            self.rows.append(np.zeros(self.n))
            self.rows[-1][docs_of[end - size : end]] = weights[end - size : end]
        whole = np.repeat(self.row, count)
        self.docs, self.weights = docs_of[whole < 0], weights[whole < 0]
        self.lists = np.concatenate([[0], np.cumsum(np.where(self.row < 0, count, 0))])
        self.unused = np.ones(self.n, bool)

    def drop_used(self) -> None:
        left = self.unused[self.indexed]
        kept = left[self.docs]
        self.lists = np.concatenate([[0], np.cumsum(kept)])[self.lists]
        self.docs, self.weights = (np.cumsum(left) - 1)[self.docs[kept]].astype(np.int32), self.weights[kept]
        for i, row in enumerate(self.rows):
            self.rows[i] = row[left]
        self.indexed = self.indexed[left]

    def neighbours(self, seed: int, need: int | None = None) -> np.ndarray:
        """Unused documents by BM25 score for the seed's terms, best first, ties to the earlier; those without a shared term last.

        With ``need``, only as many of them as hold that many tokens, or all.
        """
        if 4 * np.count_nonzero(self.unused) <= 3 * len(self.indexed):
            self.drop_used()
        slots = self.slot[self.bounds[seed] : self.bounds[seed + 1]]
        first, size = self.lists[slots], self.lists[slots + 1] - self.lists[slots]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)
        score = np.bincount(self.docs[at], self.weights[at], len(self.indexed)).astype(np.float64, copy=False)
        rows = self.row[slots]
        for row in rows[rows >= 0].tolist():
            score += self.rows[row]
        left = np.flatnonzero(self.unused[self.indexed])
        score, k = -score[left], 16
        while need is not None and k < len(left):
            best = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])  # with all that tie with the last
            best = self.indexed[left[best[np.argsort(score[best], kind="stable")]]]
            if self.size[best].sum() >= need:
                return best
            k *= 8
        return self.indexed[left[np.argsort(score, kind="stable")]]


def fill(docs: list[np.ndarray], shard: Shard, window: int):
    """Sequences as lists of (document, start, length); a cut document's rest opens the next one and is its seed.

    Every sequence is full, but those of a shard's rest: they have lengths that are powers of two and so need no padding.
    """
    at, queue, seed = 0, [], None
    sequence, room = [], window
    following = 0
    while True:
        if not queue:
            if seed is None or not sequence:
                while following < shard.n and not shard.unused[following]:
                    following += 1
                if following == shard.n:
                    break
                seed, at = following, 0
                queue = [seed]
                shard.unused[seed] = False
            else:
                need, queue = room, []
                for doc in shard.neighbours(seed, need):
                    queue.append(int(doc))
                    shard.unused[doc] = False
                    need -= len(docs[doc])
                    if need <= 0:
                        break
                at = 0
                if not queue:
                    break
        doc = queue[0]
        take = min(room, len(docs[doc]) - at)
        sequence.append((doc, at, take))
        room, at = room - take, at + take
        if at == len(docs[doc]):
            queue.pop(0)
            at = 0
        if not room:
            yield sequence
            sequence, room = [], window
            seed = queue[0] if queue else None
    size = window - room
    while size:  # the rest, cut at powers of two
        part = 1 << (size.bit_length() - 1)
        out, left = [], part
        while left:
            doc, start, length = sequence.pop(0)
            take = min(left, length)
            out.append((doc, start, take))
            if take < length:
                sequence.insert(0, (doc, start + take, length - take))
            left -= take
        yield out
        size -= part


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 2048, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 22) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every row's ids.

    A null text is the empty text (its one id is end_id); rows with a null or repeated id are packed like others, each for
    itself; an empty table gives no rows; other columns are ignored. Windows are cut wherever they are full, so only the
    rest of a shard makes shorter sequences, of lengths that are powers of two. ``shard_tokens`` bounds what a task holds.
    """
    spark = docs.sparkSession
    dtype = id_dtype(tokenizer_path)
    ids = saved(encoded(docs, tokenizer_path, end_id, id_col, text_col), "packing-ids")
    n, tokens, df = term_counts(ids, dtype)
    idf = spark.sparkContext.broadcast(np.maximum(0, np.log((n - df + 0.5) / (df + 0.5))).astype(np.float32))
    mean_length = max(1.0, tokens / max(1, n))

    def place(batches):
        ChunkEncoder.forget()
        for batch in small_batches(batches):
            of, term, tf = term_runs([np.frombuffer(x, dtype) for x in batch.column("ids").to_pylist()])
            weight = tf * idf.value[term] / (tf + 1.2)
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))  # every row has a term, its end id at least
            most = np.repeat(np.maximum.reduceat(weight, first), np.diff(np.concatenate([first, [len(of)]])))
            best = np.flatnonzero(weight == most)
            keys = term[best[np.unique(of[best], return_index=True)[1]]]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *batch.columns], names=["place", *batch.schema.names])

    kind = ids.schema["id"].dataType.simpleString()
    placed = ids.mapInArrow(place, f"place int, id {kind}, ids binary")
    parts = max(1, -(-tokens // shard_tokens))  # not more, so that no shard is smaller for the sake of more tasks
    placed = placed.repartitionByRange(parts, "place", "id").sortWithinPartitions("place", "id", F.xxhash64("ids"))

    def sequences(batches):
        ChunkEncoder.forget()
        number = TaskContext.get().partitionId() << 32

        def packed(keys, held):
            nonlocal number
            rows = []
            for sequence in fill(held, Shard(held, idf.value, mean_length), window):
                offset = 0
                for doc, start, length in sequence:
                    rows.append((keys[doc], start, length, zlib.crc32(held[doc][start : start + length].astype("<u4").tobytes()), len(held[doc]), number, offset))
                    offset += length
                number += 1
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["id", *(f.split()[0] for f in OUT.split(", "))])

        keys, held, size, id_type = [], [], 0, None
        for batch in small_batches(batches):
            id_type = batch.schema.field("id").type
            for key, x in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                doc = np.frombuffer(x, dtype)
                if held and size + len(doc) > shard_tokens:
                    yield packed(keys, held)
                    keys, held, size = [], [], 0
                    give_back()
                keys.append(key)
                held.append(doc)
                size += len(doc)
        if held:
            yield packed(keys, held)
            keys = held = None
        give_back()

    out = placed.select("id", "ids").mapInArrow(sequences, f"id {kind}, {OUT}")
    return out.withColumnRenamed("id", id_col)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of sequences of at most 2048 tokens; nulls, repeats, empty texts and tables as pack() says."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
