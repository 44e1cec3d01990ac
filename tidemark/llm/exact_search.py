"""Exact search of the greatest inner products by a vector-approximation file.

Each dimension is cut into cells, and the file holds for every vector the number of its cell in each dimension, one byte
each. A cell's two edges bound a component, so the file alone bounds every score from both sides. A first scan takes for
each query the k-th greatest lower bound: what stays under it can't be among the k best. A second scan reads the exact
vectors of the others, in the order of their upper bounds, until the k-th exact score is above what is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, saved, scope

#: Cells of a dimension, at most 256; and rows that a task bounds at once.
CELLS, BLOCK = 64, 4096
#: Bytes of the query vectors that one round sends to the tasks, and queries that are bounded at once.
ROUND_BYTES, CHUNK = 32 << 20, 256
LEAST, MOST = -(2**63), 2**63 - 1


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v): one vector of whole numbers, floor(scale * x) of each component, for each id with a usable one.

    Vectors that are null or hold null or non-finite components (also after scaling) and null ids take no part; of an id's
    repeated rows the smallest vector counts; only vectors of the most frequent length (of equally frequent ones the
    greatest) take part.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: _floor(x * scale)).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("id is not null and v is not null").filter(finite).groupBy("id").agg(F.min("v").alias("v"))


def _floor(x):
    """The whole number under x as a double, beyond the range of a long as well, where doubles are whole."""
    return F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)


class Bounds:
    """Lower and upper bounds of scores from cells. Exact in the float type that holds every sum, else widened by what rounding may do."""

    def __init__(self, edges: np.ndarray, high: np.ndarray):
        self.edges, self.high = edges, high  # (dimensions, cells): the smallest value of a cell, and the greatest
        widest = np.maximum(np.abs(edges), np.abs(high)).max(initial=0.0)
        worst = float(edges.shape[0]) * float(widest) ** 2
        self.kind = np.float32 if worst < 2**24 else np.float64
        self.slack = 0.0 if worst < 2**53 else 1e-15 * (edges.shape[0] + 4)

    def corners(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(codes.shape[1])
        return self.edges[at, codes].astype(self.kind), self.high[at, codes].astype(self.kind)

    def _sums(self, queries, positive, negative):
        with np.errstate(over="ignore", invalid="ignore"):
            out = np.maximum(queries, 0).astype(self.kind) @ positive.T + np.minimum(queries, 0).astype(self.kind) @ negative.T
            out = out.astype(np.float64)
            return out, self.slack * (np.abs(queries) @ np.maximum(np.abs(positive), np.abs(negative)).T) if self.slack else 0.0

    def lower(self, queries: np.ndarray, corners) -> np.ndarray:
        out, slack = self._sums(queries, *corners)
        return self._held(out - slack, -np.inf)

    def upper(self, queries: np.ndarray, corners) -> np.ndarray:
        out, slack = self._sums(queries, *corners[::-1])
        return self._held(out + slack, np.inf)

    def _held(self, bound, unknown):
        return np.clip(np.nan_to_num(bound, nan=unknown, posinf=np.inf, neginf=-np.inf), LEAST, MOST) if self.slack else bound

    def scores(self, query: np.ndarray, vectors: np.ndarray) -> list[int]:
        """Exact inner products, held at the limits of a long."""
        if not self.slack:
            return (vectors @ query).astype(np.int64).tolist()
        q = [int(x) for x in query]
        return [min(MOST, max(LEAST, sum(a * int(b) for a, b in zip(q, v)))) for v in vectors]


def _cells(rows: DataFrame, cells: int, sample: int) -> Bounds:
    """Cells of even content on a sample; their outermost edges, and so every bound, are those of all rows."""

    def extent(batches):
        least = most = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = np.array(batch.slice(at, BLOCK).column("v").to_pylist(), np.float64)
                least = x.min(0) if least is None else np.minimum(least, x.min(0))
                most = x.max(0) if most is None else np.maximum(most, x.max(0))
        if least is not None:
            yield pa.RecordBatch.from_pydict({"d": np.arange(len(least)), "least": least, "most": most})

    found = rows.select("v").mapInArrow(extent, "d long, least double, most double").groupBy("d").agg(F.min("least"), F.max("most")).orderBy("d").collect()
    least, most = np.array([r[1] for r in found]), np.array([r[2] for r in found])
    taken = np.sort(np.array([r["v"] for r in rows.select("v").orderBy(F.xxhash64("row")).limit(sample).collect()]), axis=0)
    inner = np.stack([taken[(len(taken) * c) // cells] for c in range(1, cells)], axis=1) if cells > 1 else np.zeros((len(least), 0))
    edges = np.concatenate([least[:, None], np.clip(inner, least[:, None], most[:, None])], axis=1)
    # Components are whole numbers: a cell ends one before the next begins. Beyond 2^53 that one makes no difference.
    high = np.concatenate([np.maximum(edges[:, 1:] - 1, edges[:, :-1]), most[:, None]], axis=1)
    return Bounds(edges, high)


def exact_search(vectors: DataFrame, queries: DataFrame, top: int = 5, scale: float = 256.0, cells: int = CELLS, sample: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(query_id, rank, id, score): for each id of queries that takes part, its ``top`` others of the greatest inner product.

    Scores are exact inner products of floor(scale * x), ties go to the smaller id, ids may be of any type that Spark
    sorts. Vectors that are null or hold null or non-finite components (also after scaling), and null ids, take no part;
    zero vectors do; of an id's repeated rows the smallest vector counts; only vectors of the most frequent length (of equally
    frequent ones the greatest) take part; fewer candidates than top give fewer rows; an empty table gives no rows; other
    columns are ignored. A score beyond a long is held, and ranked, at the limit that it passes.

    Copies of one vector beyond the top + 1 smallest ids can't be among any query's best, so they are left out of the file
    before it is scanned. The cells' inner edges come from at most ``sample`` rows and change no result. Queries go to
    the tasks in rounds of at most ``round_bytes`` of vectors; a task holds a block of rows and ``top`` rows a query. The rows are
    written once; what they were worked out from is removed.
    """
    with scope():
        return kept(_exact_search(vectors, queries, top, scale, cells, sample, id_col, vector_col, round_bytes), "exact")


def _exact_search(vectors: DataFrame, queries: DataFrame, top: int, scale: float, cells: int, sample: int, id_col: str, vector_col: str, round_bytes: int) -> DataFrame:
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = saved(scaled(vectors, id_col, vector_col, scale), "whole-vectors")
    length = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score long")
    if length is None:
        return empty
    # A number for each id in the ids' order: ties and own rows are told by numbers, whatever the ids are.
    rows = rows.filter(F.size("v") == length["dim"])
    numbered = saved(rows.repartitionByRange("id").sortWithinPartitions("id").withColumn("row", F.monotonically_increasing_id()), "numbered-vectors")
    asked = saved(numbered.join(queries.select(F.col(id_col).alias("id")).distinct(), "id").select("row", "id", "v"), "queries")
    if length["dim"] == 0:
        bounds = Bounds(np.zeros((0, 1)), np.zeros((0, 1)))
    else:
        bounds = _cells(numbered, max(1, min(cells, 256)), sample)
    first = F.row_number().over(Window.partitionBy("v").orderBy("row"))
    distinct = numbered.select("row", "v", first.alias("copy")).filter(F.col("copy") <= top + 1).select("row", "v")

    def approximate(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                v = np.array(part.column("v").to_pylist(), np.float64).reshape(part.num_rows, -1)
                code = np.stack([np.searchsorted(e, x, side="right") - 1 for e, x in zip(bounds.edges, v.T)], axis=1).astype(np.uint8) if v.shape[1] else np.zeros(v.shape, np.uint8)
                exact = v.astype(np.int32) if not bounds.slack and np.abs(v).max(initial=0) < 2**31 else v
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array([x.tobytes() for x in exact], pa.binary())], names=["row", "code", "exact"])

    file = saved(distinct.mapInArrow(approximate, "row long, code binary, exact binary"), "approximations")
    n_round, last, out = max(1, round_bytes // (8 * max(1, length["dim"]))), -1, []
    while taken := asked.filter(F.col("row") > last).orderBy("row").limit(n_round).collect():
        last = taken[-1]["row"]
        block = np.array([r["row"] for r in taken], np.int64), np.array([r["v"] for r in taken], np.float64).reshape(len(taken), -1)
        out.append(saved(_best(file, spark.sparkContext.broadcast(block), spark.sparkContext.broadcast(bounds), top), "best"))
    if not out:
        return empty
    best = out[0]
    for more in out[1:]:
        best = best.unionByName(more)
    ids = numbered.select("row", "id")
    named = best.join(asked.select(F.col("row").alias("q"), F.col("id").alias("query_id")), "q").join(ids, "row")
    return named.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _blocks(batches, columns: list[str]):
    """Rows of Arrow batches, at most BLOCK at a time: their numbers, and the named binary columns."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column("row").to_numpy(zero_copy_only=False), *(part.column(c).to_pylist() for c in columns)


def _own(bound: np.ndarray, asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """bound (queries x rows) with a query's own row out of the question."""
    at = np.searchsorted(asked, rows)
    own = np.flatnonzero((at < len(asked)) & (asked[np.minimum(at, len(asked) - 1)] == rows))
    bound[at[own], own] = -np.inf
    return bound


def _greatest(held: np.ndarray, new: np.ndarray, k: int) -> np.ndarray:
    both = np.concatenate([held, new], axis=1)
    return np.partition(both, both.shape[1] - k, axis=1)[:, -k:]


def _best(file: DataFrame, block, shared, top: int) -> DataFrame:
    """(q, rank, row, score) for one round of queries: two scans of the file."""
    spark = file.sparkSession

    def floors(batches):
        (asked, vectors), bounds = block.value, shared.value
        held = np.full((len(asked), top), -np.inf)
        for rows, codes in _blocks(batches, ["code"]):
            corners = bounds.corners(np.frombuffer(b"".join(codes), np.uint8).reshape(len(rows), -1))
            for at in range(0, len(asked), CHUNK):
                part = slice(at, at + CHUNK)
                held[part] = _greatest(held[part], _own(bounds.lower(vectors[part], corners), asked[part], rows), top)
        q, j = np.nonzero(held > -np.inf)
        yield pa.RecordBatch.from_pydict({"q": asked[q], "bound": held[q, j]})

    bound = file.select("row", "code").mapInArrow(floors, "q long, bound double")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound")))
    sure = bound.withColumn("r", order).filter(F.col("r") <= top).groupBy("q").agg(F.count("*").alias("n"), F.min("bound").alias("bound"))
    # As many rows as a round has queries: what is sure of each goes back to all tasks.
    floor = {r["q"]: r["bound"] for r in sure.filter(F.col("n") == top).collect()}
    known = spark.sparkContext.broadcast(np.array([floor.get(int(q), -np.inf) for q in block.value[0]]))

    def exact(batches):
        (asked, vectors), bounds, least = block.value, shared.value, known.value.copy()
        best: list[list[tuple[int, int]]] = [[] for _ in asked]  # (-score, row), ascending
        for rows, codes, values in _blocks(batches, ["code", "exact"]):
            corners = bounds.corners(np.frombuffer(b"".join(codes), np.uint8).reshape(len(rows), -1))
            kind = np.int32 if corners[0].shape[1] and len(values[0]) == 4 * corners[0].shape[1] else np.float64
            for at in range(0, len(asked), CHUNK):
                part = slice(at, at + CHUNK)
                upper = _own(bounds.upper(vectors[part], corners), asked[part], rows)
                near = (upper >= least[part, None]) & (upper > -np.inf)
                for i in np.flatnonzero(near.any(1)):
                    found = np.flatnonzero(near[i])
                    found = found[np.argsort(-upper[i, found], kind="stable")]
                    q, step = at + int(i), max(16, top)
                    for x in range(0, len(found), step):
                        if upper[i, found[x]] < least[q]:
                            break  # so are all that follow
                        some = found[x : x + step]
                        v = np.frombuffer(b"".join(values[j] for j in some), kind).reshape(len(some), -1).astype(np.float64)
                        scores = bounds.scores(vectors[q], v)
                        best[q] = sorted(best[q] + [(-s, r) for s, r in zip(scores, rows[some].tolist())])[:top]
                        if len(best[q]) == top:
                            least[q] = max(least[q], np.nextafter(float(-best[q][-1][0]), -np.inf) if bounds.slack else -best[q][-1][0])
        q = np.repeat(asked, [len(b) for b in best])
        score, row = ([x[k] for b in best for x in b] for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(row, pa.int64()), pa.array([-s for s in score], pa.int64())], names=["q", "row", "score"])

    found = file.mapInArrow(exact, "q long, row long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "row")))
    return ranked.filter(F.col("rank") <= top).select("q", "rank", "row", "score")


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest whole-number inner products of every fiftieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return exact_search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def exact_search_sql() -> str:
    return """
    WITH usable AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
