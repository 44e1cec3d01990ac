"""Quality classifier of supervised subword embeddings.

Features of a text: its words, their character n-grams and its word bigrams, hashed into buckets. A document is the mean of
its features' learned vectors, a softmax over it gives the classes, and numpy stochastic gradient descent learns both.
As the output is linear in the mean, a trained model reduces to one number per bucket, which is what executors hold.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import whole_text
from .tokens import small_batches, texts_of

BITS = 18
BUCKETS = 1 << BITS
GRAMS = (2, 3, 4)
_MASK = np.uint64(BUCKETS - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Words remembered per worker; forgotten when full.
WORDS = 80_000


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their character n-grams, in the first half of the table's range, and each one's word."""
    points = np.frombuffer("\n".join(f"<{w.decode('utf-8', 'replace')}>" for w in words).encode("utf-32-le", "replace"), np.uint32)
    between = points == 10
    word, points = np.cumsum(between), points.astype(np.uint64)
    out, of = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))], [np.arange(len(words))]
    for n in GRAMS:
        size = len(points) - n + 1
        if size > 0:
            inside = np.flatnonzero((word[:size] == word[n - 1 :]) & ~between[:size])
            h = np.full(len(inside), n, np.uint64)
            for j in range(n):
                h = (h ^ points[inside + j]) * _MULTIPLIER
                h ^= h >> np.uint64(29)
            out.append(h)
            of.append(word[inside])
    return (np.concatenate(out) & _MASK).astype(np.int64), np.concatenate(of)


def bigram_features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words, in the second half of the range; a word that follows itself is one feature for all words."""
    a, b = hashes[:-1], hashes[1:]
    h = (a * _MULTIPLIER) ^ b
    h ^= h >> np.uint64(31)
    return np.where(a == b, 0, (h & _MASK).astype(np.int64)) + BUCKETS


@dataclass
class Model:
    """What a bucket adds to the log odds of the last class against the first, and the bias with the prior."""

    weights: np.ndarray
    bias: float


class Scorer:
    """Scores texts; a word's hash, sum of weights and number of features are worked out once while it is remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.hashes, self.sums, self.counts = np.zeros(WORDS * 2, np.uint64), np.zeros(WORDS * 2), np.zeros(WORDS * 2, np.int64)

    def scores(self, texts: list[bytes]) -> list[float]:
        return [self.score(text.split()) for text in texts]

    def score(self, words: list[bytes]) -> float:
        total, n, last = 0.0, 0, None
        for first in range(0, len(words), WORDS):  # a very long text in parts that fit the memory
            part = words[first : first + WORDS]
            if len(self.at) > WORDS:
                self.forget()
            at = self.at
            try:
                rows = np.fromiter(map(at.__getitem__, part), np.int64, len(part))
            except KeyError:
                new = [w for w in set(part) if w not in at]
                k = slice(len(at), len(at) + len(new))
                at.update(zip(new, range(k.start, k.stop)))
                features, of = word_features(new)
                self.hashes[k] = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
                self.sums[k], self.counts[k] = np.bincount(of, self.model.weights[features], len(new)), np.bincount(of, minlength=len(new))
                rows = np.fromiter(map(at.__getitem__, part), np.int64, len(part))
            hashes = self.hashes[rows]
            if last is not None:
                hashes = np.concatenate([[last], hashes])
            pairs = bigram_features(hashes)
            total += self.sums[rows].sum() + self.model.weights[pairs].sum()
            n += int(self.counts[rows].sum()) + len(pairs)
            last = hashes[-1]
        return float(1 / (1 + np.exp(-np.clip(self.model.bias + total / max(1, n), -30, 30))))


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share each has among its features."""
    words = text.split()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    times = Counter(words)
    own, of = word_features(list(times))
    flat = np.concatenate([own, bigram_features(hashes)])
    weight = np.concatenate([np.fromiter(times.values(), np.float64, len(times))[of], np.ones(len(hashes) - 1)])
    found, slot = np.unique(flat, return_inverse=True)
    share = np.bincount(slot, weight)
    return found, (share / share.sum()).astype(np.float32)


@dataclass
class Learned:
    """Vectors of the buckets, the output layer, its bias, and what the true shares of the labels add to the second class."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    shift: float

    def reduced(self) -> Model:
        """The same scores from one number for each bucket, as the output is linear in the mean of vectors."""
        both = self.output[:, 1] - self.output[:, 0]
        return Model((self.vectors @ both).astype(np.float64), float(self.bias[1] - self.bias[0]) + self.shift)


def train(texts: list[bytes], labels: np.ndarray, prior: float, dim: int = 8, epochs: int = 6, rate: float = 1.0, seed: int = 17) -> Learned:
    """Learn vectors and output by one pass per epoch over the texts in random order, the rate falling to 0.

    Classes weigh alike while learning; ``prior`` (the share of label 1 among all labels) then moves the bias, so a score
    is a probability under the true shares.
    """
    random = np.random.default_rng(seed)
    rows = [features(t) for t in texts]
    vectors = random.uniform(-1 / dim, 1 / dim, (2 * BUCKETS, dim)).astype(np.float32)
    output = np.zeros((dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    weight = len(labels) / (2 * np.maximum(1, np.bincount(labels, minlength=2)))
    done, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at, share = rows[i]
            step = rate * (1 - done / steps)
            done += 1
            held = vectors[at]
            mean = share @ held
            logit = mean @ output + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weight[labels[i]]
            back = output @ p
            output -= step * np.outer(mean, p)
            bias -= 0.1 * step * p
            # The share is small for each feature: vectors move by the document's gradient, scaled to its features.
            vectors[at] = held - step * 20 * np.outer(share, back)
    return Learned(vectors, output, bias, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 2500, class_bytes: int = 64 << 20) -> Model:
    """Fit on at most ``per_class`` labelled documents and ``class_bytes`` of their texts in each class, the first by a hash of the id.

    A document with several texts counts by one of them, the first by a hash; one labelled twice by its smallest label; rows
    without a label, an id or a text take no part. Texts are taken whole until the next would pass ``class_bytes``, but for
    the first, which is taken whatever its length. Where only one class is labelled, every score is that class's; with no labels, or no
    labelled texts, it is one half. Other columns are ignored.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(2 * BUCKETS), 0.0 if not shares else 60.0 * next(iter(shares)) - 30.0)
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class) for k in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null").join(F.broadcast(parts[0].unionByName(parts[1])), "id")
    one = texts.groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    # At most per_class rows of a label: the running sum of their lengths.
    before = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    one = one.withColumn("nth", F.row_number().over(before)).withColumn("bytes", F.sum(F.octet_length("text")).over(before))
    rows = one.filter(f"nth = 1 or bytes <= {int(class_bytes)}").select("id", "label", "text").collect()
    rows.sort(key=lambda r: (r["id"], r["text"]))
    if not rows:
        return Model(np.zeros(2 * BUCKETS), 0.0)
    return train([r["text"].encode() for r in rows], np.array([r["label"] for r in rows], np.int64), shares[1] / (shares[0] + shares[1])).reduced()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row: a null text scores as the empty one, whose score is the prior with the bias.

    Null and repeated ids keep their rows, an empty table gives none, other columns are ignored; a text is read whole, in
    parts that fit the memory. No shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(held.value)
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scorer.scores(texts_of(batch)), pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, at_least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs that score at_least or more, with all their columns, whatever their names.

    A null text scores as the empty one; repeated rows and null ids are judged by their texts like others; an empty table
    stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(held.value)
        for batch in small_batches(batches):
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array([s >= at_least for s in scorer.scores(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def crc_fold(column: str, folds: int = 5):
    return F.crc32(F.col(column).cast("string")) % folds


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """A model from the labels of sf_dir but for those held out; nulls, repeats and missing labels as fit() says."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return fit(docs, labels.filter(crc_fold("doc_id") != 0))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; nulls, repeats, empty texts and tables as score() and fit() say."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, learned(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
