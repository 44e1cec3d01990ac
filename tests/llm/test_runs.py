"""Periodic runs against a plain search of every start and period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm.queries import queries
from tidemark.llm.runs import find_runs, kept_words, looped, periodic_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=24, times=3):
    """Maximal stretches for each period, without those whose smallest period is another."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and not any(s <= i and i + (j + q - i) <= s + m and q % p == 0 for s, m, p in found):
                found[(i, j + q - i, q)] = True
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    random.seed(3)
    docs = []
    for _ in range(400):
        words = []
        while len(words) < random.choice((0, 30, 120, 400)):
            if random.random() < 0.5:
                words += [random.randrange(random.choice((2, 3, 50))) for _ in range(random.randrange(1, 30))]
            else:
                period = [random.randrange(random.choice((1, 2, 3, 40))) for _ in range(random.randrange(1, 40))]
                words += (period * 12)[: random.randrange(1, 9 * len(period) + 30)]
        docs.append(words)
    got = find_runs([np.array(d, np.int64) for d in docs])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(d) for d in docs]
    assert sum(map(len, got)) > 200
    for d, g in zip(docs, got):
        held = {i for s, m, q in g.tolist() for i in range(s + q, s + m)}
        assert [i for i in range(len(d)) if i not in held] == np.flatnonzero(kept_words(len(d), g)).tolist()
    with pytest.raises(ValueError):
        find_runs([np.zeros(9, np.int64)], least=9)


def test_runs_at_the_limits():
    ones = np.zeros(40, np.int64)
    assert [len(x) for x in find_runs([ones[:23], ones[:24], ones[:0], ones])] == [0, 1, 0, 1]
    for q in (1, 7, 8, 9, 16, 17, 31, 32, 33, 64, 65):
        period = np.arange(q, dtype=np.int64)
        for n in (3 * q - 1, 3 * q, 3 * q + 1, 24, 25):
            d = np.concatenate([[900], np.resize(period, n), [901]])
            assert [tuple(r) for r in find_runs([d])[0].tolist()] == ([(1, n, q)] if n >= max(24, 3 * q) else []), (q, n)
    assert find_runs([]) == []


def test_query_equals_plain(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries()["op12_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    shaped = 0
    for k, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(k).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            shaped += 1
        runs = [tuple(r) for r in find_runs([np.array([hash(w) & 0x7FFFFFFF for w in words], np.int64)])[0].tolist()] if n > 1500 else plain_runs(words)
        held = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        wanted = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in held)))
        row = got[k]
        assert tuple(row[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) == wanted, k
        assert row["n_words"] == n
    assert shaped > 5 and sum(r["n_runs"] > 0 for r in got.values()) > 5


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    found = periodic_runs(odd_docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"] and found.count() == odd_docs.count() and periodic_runs(no_docs).count() == 0
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert (by_id[4]["n_words"], by_id[4]["runs"], by_id[4]["collapsed"]) == (0, [], "") and by_id[6]["collapsed"] == ""
    assert by_id[7]["n_words"] == 30_000 and by_id[9]["n_words"] in (3, 6)
    assert looped(odd_docs).schema == odd_docs.schema and looped(odd_docs).count() == odd_docs.count()
    long = spark.createDataFrame([("a", "x " * 50_000), ("b", " ".join(["one two"] * 12) + " three")], "name string, body string")
    got = {r["name"]: r for r in periodic_runs(long, "name", "body").collect()}
    assert got["a"]["runs"] == [(0, 50_000, 1)] and got["a"]["collapsed"] == "x"
    assert got["b"]["runs"] == [(0, 24, 2)] and got["b"]["collapsed"] == "one two three"
