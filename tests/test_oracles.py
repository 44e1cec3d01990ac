"""Every registered query with SQL returns DuckDB's rows over the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from tidemark.plans import all_oracles, all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return float(f"{float(v):.9g}")
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_rows_equal(spark, duck, name):
    got = all_queries()[name](spark, SF)
    cursor = duck.execute(all_oracles()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    wanted = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=str) == wanted


def test_every_query_is_checked():
    assert set(all_queries()) == set(all_oracles())
