"""Approximate nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one of each full-dimensional codebook. Codebooks are learned on the
residuals of the ones before and refitted together by least squares; a beam search encodes; a search adds, for each code,
table entries of the query against codewords to the stored norm of the approximation, and reranks the best exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, saved, scope


@dataclass
class Codebooks:
    words: np.ndarray  # (codebooks, codewords, dimensions), float32


def _kmeans(x: np.ndarray, k: int, random, rounds: int = 6) -> np.ndarray:
    centre = x[random.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        own = np.argmin((centre * centre).sum(1) - 2 * (x @ centre.T), axis=1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre[n > 0] = total[n > 0] / n[n > 0, None]
    return centre


def encode(x: np.ndarray, books: Codebooks, beam: int = 8) -> np.ndarray:
    """Codes (n, codebooks) by beam search: the ``beam`` best partial sums are carried from codebook to codebook."""
    m, k, _ = books.words.shape
    n = len(x)
    residual, codes = x[:, None, :], np.zeros((n, 1, 0), np.uint8)
    cost = (x * x).sum(1)[:, None]
    for words in books.words:
        squared = (words * words).sum(1)
        new = cost[:, :, None] + squared - 2 * (residual @ words.T)
        flat = new.reshape(n, -1)
        b = min(beam, flat.shape[1])
        best = np.argpartition(flat, b - 1, axis=1)[:, :b]
        came, word = best // k, best % k
        cost = np.take_along_axis(flat, best, 1)
        residual = np.take_along_axis(residual, came[:, :, None], 1) - words[word]
        codes = np.concatenate([np.take_along_axis(codes, came[:, :, None], 1), word[:, :, None].astype(np.uint8)], axis=2)
    return codes[np.arange(n), np.argmin(cost, axis=1)]


def decode(codes: np.ndarray, books: Codebooks) -> np.ndarray:
    return sum(books.words[j][codes[:, j]] for j in range(len(books.words)))


def learn(x: np.ndarray, m: int = 16, k: int = 256, rounds: int = 1, seed: int = 5) -> Codebooks:
    """Residual k-means, then ``rounds`` of beam encoding and a joint least-squares refit of all codewords."""
    random = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    residual, words = x.astype(np.float32).copy(), []
    for _ in range(m):
        centre = _kmeans(residual, k, random)
        words.append(centre)
        residual -= centre[np.argmin((centre * centre).sum(1) - 2 * (residual @ centre.T), axis=1)]
    books = Codebooks(np.stack(words).astype(np.float32))
    for _ in range(rounds):
        flat = encode(x, books) + np.arange(m) * k
        gram, right = np.zeros((m * k, m * k), np.float32), np.zeros((m * k, x.shape[1]), np.float32)
        for i in range(m):
            np.add.at(right, flat[:, i], x)
            for j in range(m):
                np.add.at(gram, (flat[:, i], flat[:, j]), 1.0)
        gram[np.diag_indices(m * k)] += 1e-2
        right += 1e-2 * books.words.reshape(m * k, -1)
        books = Codebooks(np.linalg.solve(gram, right).astype(np.float32).reshape(m, k, -1))
    return books


def narrowed(vectors) -> np.ndarray:
    """Vectors for the quantiser in single precision, whose sums of squares mustn't overflow."""
    return np.clip(np.array(vectors, np.float64), -1e15, 1e15).astype(np.float32)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v) that take part: an id, and a vector of finite components that aren't all zero."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("id is not null and v is not null").filter(finite & F.exists("v", lambda x: x != 0))


#: Bytes of the query vectors of one round, rows that a task scores at once and queries that it scores them for.
ROUND_BYTES, BLOCK, CHUNK = 32 << 20, 4096, 64


def search(vectors: DataFrame, queries: DataFrame, top: int = 10, rerank: int | None = None, sample: int = 8192, block: int = BLOCK, round_bytes: int = ROUND_BYTES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row of queries its ``top`` nearest others in vectors by Euclidean distance.

    Codebooks are learned on at most ``sample`` rows, the first by a hash of their place; every row is encoded and every row is
    scored for every query, where its codes lie: queries go to the tasks in rounds of at most ``round_bytes`` of vectors. A first scan
    finds for each query a table score that at least ``rerank`` rows (where it is not given, 800 or four times the root of the number of rows, whichever is more) reach, from scores at the ranks 1, 2, 4 and so on of each
    task, and so at most about twice as many; a second scan picks them, and they are scored exactly, in double precision,
    on the original vectors. With ``rerank`` at least the number of rows the result is exact.

    Ids are of any type that Spark sorts; ties go to the smaller id. Vectors that are null, zero or not finite, and null ids, take
    no part; a row never meets a query of its own id; repeated rows of an id count once, by the smallest vector; fewer candidates
    than top give fewer rows; only vectors of the most frequent length (of equally frequent ones the greatest) take part; an
    empty table gives no rows; other columns are ignored, whatever their names. Copies of one vector beyond the top + 1 smallest ids can't be among any query's best and are
    not scored. Magnitudes over 1e15 are searched as 1e15 and scored as they are. The rows are written once; what they were worked
    out from is removed.
    """
    with scope():
        return kept(_search(vectors, queries, top, rerank, sample, block, round_bytes, id_col, vector_col), "nearest")


def _search(vectors: DataFrame, queries: DataFrame, top: int, rerank: int | None, sample: int, block: int, round_bytes: int, id_col: str, vector_col: str) -> DataFrame:
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = saved(usable(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    length = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score double")
    if length is None:
        return empty
    # Numbers in the order of ids stand for them: the partitions are ranges of ids.
    ordered = rows.filter(F.size("v") == length["dim"]).repartitionByRange("id").sortWithinPartitions("id")
    rows = saved(ordered.select(F.monotonically_increasing_id().alias("row"), "id", "v"), "numbered")
    rerank = rerank or max(800, math.ceil(4 * math.sqrt(rows.count())))
    taken = rows.orderBy(F.xxhash64("row"), "row").limit(sample).collect()
    books = spark.sparkContext.broadcast(learn(narrowed([r["v"] for r in taken])))
    copy = F.row_number().over(Window.partitionBy("v").orderBy("row"))
    distinct = rows.select("row", "v", copy.alias("copy")).filter(F.col("copy") <= top + 1).select("row", "v")

    def quantise(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                codes = encode(narrowed(part.column("v").to_pylist()), books.value)
                norms = (decode(codes, books.value).astype(np.float64) ** 2).sum(1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms)], names=["row", "code", "norm"])

    codes = saved(distinct.mapInArrow(quantise, "row long, code binary, norm float"), "codes")
    asked = saved(queries.select(F.col(id_col).alias("id")).distinct().join(rows, "id").select("row", "id", "v"), "queries")
    n_round, last, out = max(1, round_bytes // max(8 * length["dim"], 4 * rerank)), -1, []  # a task holds rerank scores a query
    while taken := asked.filter(F.col("row") > last).orderBy("row").limit(n_round).select("row", "v").collect():
        last = taken[-1]["row"]
        held = spark.sparkContext.broadcast((np.array([r["row"] for r in taken], np.int64), narrowed([r["v"] for r in taken])))
        out.append(saved(_picked(codes, held, books, rerank, block), "picked"))
    if not out:
        return empty
    found = reduce(DataFrame.unionByName, out)
    exact = found.join(rows.select("row", "id", "v"), "row").join(asked.select(F.col("row").alias("q"), F.col("id").alias("query_id"), F.col("v").alias("w")), "q")
    distance = F.sqrt(F.aggregate(F.zip_with("v", "w", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b))
    ranked = exact.select("query_id", "id", "row", distance.alias("score")).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "row")))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _picked(codes: DataFrame, held, books, rerank: int, block: int) -> DataFrame:
    """(q, row) for one round of queries: two scans of the codes."""
    spark = codes.sparkSession
    steps = [2**i for i in range(64) if 2**i < rerank] + [rerank]  # ranks whose scores a task tells

    def scored(batches):
        """Blocks of rows, each with chunks of queries and the table scores of the two."""
        asked, vectors = held.value
        words = books.value.words
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                rows, norms = part.column("row").to_numpy(zero_copy_only=False), part.column("norm").to_numpy(zero_copy_only=False)
                code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(rows), -1)
                for first in range(0, len(asked), CHUNK):
                    tables = np.einsum("mkd,qd->mqk", words, vectors[first : first + CHUNK], optimize=True)
                    score = norms - 2 * sum(tables[j][:, code[:, j]] for j in range(code.shape[1]))
                    score[asked[first : first + CHUNK, None] == rows[None, :]] = np.inf  # a query doesn't find itself
                    yield rows, first, score

    def floors(batches):
        asked = held.value[0]
        best = np.full((len(asked), rerank), np.inf, np.float32)
        for _, first, score in scored(batches):
            both = np.concatenate([best[first : first + CHUNK], score], axis=1)
            best[first : first + CHUNK] = np.partition(both, rerank - 1, axis=1)[:, :rerank]
        best.sort(axis=1)
        q, rank = np.repeat(asked, len(steps)), np.tile(steps, len(asked))
        score = best[:, np.array(steps) - 1].ravel().astype(np.float64)
        weight = np.tile(np.diff([0, *steps]), len(asked))
        yield pa.RecordBatch.from_pydict({"q": q[score < np.inf], "bound": score[score < np.inf], "weight": pa.array(weight[score < np.inf], pa.int64())})

    told = codes.mapInArrow(floors, "q long, bound double, weight long")
    reached = F.sum("weight").over(Window.partitionBy("q").orderBy("bound"))
    enough = told.withColumn("reached", reached).filter(F.col("reached") >= rerank).groupBy("q").agg(F.min("bound").alias("bound"))
    least = {r["q"]: r["bound"] for r in enough.collect()}  # one for each query of the round
    known = spark.sparkContext.broadcast(np.array([least.get(int(q), np.inf) for q in held.value[0]]))

    def pick(batches):
        asked, bound = held.value[0], known.value
        for rows, first, score in scored(batches):
            q, j = np.nonzero((score <= bound[first : first + CHUNK, None]) & np.isfinite(score))
            yield pa.RecordBatch.from_arrays([pa.array(asked[first + q], pa.int64()), pa.array(rows[j], pa.int64())], names=["q", "row"])

    return codes.mapInArrow(pick, "q long, row long")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest others of every hundredth vector; nulls, zeros, repeats and ties as search() says."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
