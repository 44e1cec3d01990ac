"""Exact search against all pairs and against the SQL."""

import math
import random

import duckdb
import pytest

from tidemark.llm.exact_search import exact_search
from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def brute(rows, asked, top, scale=256):
    v = {}
    for k, x in rows:
        if k is not None and x is not None and all(c is not None and math.isfinite(c * scale) for c in x):
            whole = [math.floor(c * scale) for c in x]
            v[k] = min(v.get(k, whole), whole)
    lengths = [len(x) for x in v.values()]
    best = max(set(lengths), key=lambda n: (lengths.count(n), n)) if v else 0
    v = {k: x for k, x in v.items() if len(x) == best}
    out = []
    for q in sorted(k for k in v if k in asked):
        score = lambda c: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v[q], v[c]))))
        near = sorted((-score(c), c) for c in v if c != q)[:top]
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(near)]
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries()["op13_exact_search"](spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert rows_of(got) == sorted(duck.execute(oracle_sql()["op13_exact_search"]).fetchall())


@pytest.mark.parametrize("kind", ["gauss", "copies", "wide", "huge", "whole"])
def test_search_equals_all_pairs(spark, kind):
    random.seed(4)
    draw = {
        "gauss": lambda: [random.gauss(0, 0.3) for _ in range(6)],
        "copies": lambda: [random.choice((-0.25, 0.25))] * 3 + [0.125] * 3,
        "wide": lambda: [random.gauss(0, 10 ** random.randrange(0, 7)) for _ in range(6)],
        "huge": lambda: [random.choice((-1, 1)) * 10.0 ** random.randrange(0, 120) for _ in range(6)],
        "whole": lambda: [float(random.randrange(-3, 4)) for _ in range(6)],
    }[kind]
    rows = [(i * 3 - 200, draw()) for i in range(300)]
    asked = {k for k, _ in rows if k % 5 == 0}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = exact_search(df, df.filter("vec_id % 5 = 0"), top=4, cells=8, sample=50, round_bytes=6 * 8 * 25)
    assert rows_of(got) == brute(rows, asked, 4)


def test_search_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("b", [1.0, 2.0], 1), ("b", [1.0, 1.0], 2), ("a", [0.0, 0.0], 3), ("c", None, 4), ("d", [1.0, None], 5), ("e", [nan, 1.0], 6), ("f", [inf, 1.0], 7), ("g", [1e308, 1.0], 8),
            (None, [1.0, 1.0], 9), ("h", [1.0], 10), ("i", [], 11), ("j", [-1.0, 0.5], 12), ("k", [1.0, 1.0], 13)]
    df = spark.createDataFrame(rows, "name string, v array<double>, score long").withColumnRenamed("score", "row")
    asked = {"a", "b", "c", "h", "nobody", "k"}
    queries_ = spark.createDataFrame([(k,) for k in [*asked, "a"]], "name string")
    got = exact_search(df, queries_, top=3, id_col="name", vector_col="v")
    assert got.columns == ["query_id", "rank", "name", "score"]
    assert rows_of(got) == brute([r[:2] for r in rows], asked, 3)
    assert exact_search(df.limit(0), queries_, id_col="name", vector_col="v").count() == 0
    assert exact_search(df, queries_.limit(0), id_col="name", vector_col="v").count() == 0
    one = df.filter("name = 'a'")
    assert exact_search(one, one, id_col="name", vector_col="v").count() == 0
    none = spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<double>")
    assert rows_of(exact_search(none, none)) == [(1, 1, 2, 0), (2, 1, 1, 0)]
