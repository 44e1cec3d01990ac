"""The n-gram join and the nearest-neighbour search against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import near_duplicates as nd
from tidemark.llm.components import components
from tidemark.llm.nearest import search


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(docs):
    """(n_shingles, component) by id, from all pairs."""
    sets = {}
    for k, text in docs:
        sets.setdefault(k, []).append(shingles(text))
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((k, len(s), find(k)) for k in sets for s in sets[k])


def rows(found):
    return sorted(tuple(r) for r in found.filter("doc_id is not null").collect())


def test_join_equals_all_pairs(sf_docs, texts):
    assert rows(nd.near_duplicates(sf_docs)) == brute(texts.items())


def test_join_of_frequent_text(spark):
    """Near copies in the hundreds, boilerplate that is most of many texts, and sets around the size limits."""
    random.seed(7)
    word = lambda: f"x{random.randrange(10**6)}"
    stock = [word() for _ in range(60)]
    shared = [[word() for _ in range(40)] for _ in range(3)]
    docs = []
    for _ in range(90):
        text = list(stock)
        for _ in range(random.choice((0, 1, 1, 2, 3))):
            text[random.randrange(60)] = word()
        docs.append(text)
    for _ in range(120):
        docs.append(random.choice(shared) + [word() for _ in range(random.randrange(0, 25))])
    for n in range(1, 14):
        base = [word() for _ in range(n)]
        docs += [base, base + [word()], base[:-1], base + [word(), word()], base]
    docs = [(i, " ".join(t)) for i, t in enumerate(docs)]
    random.shuffle(docs)
    assert rows(nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_join_of_odd_rows(spark, odd_docs, no_docs):
    wanted = brute([(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] is not None])
    assert rows(nd.near_duplicates(odd_docs)) == wanted
    assert nd.near_duplicates(odd_docs).count() == odd_docs.count() and nd.near_duplicates(no_docs).count() == 0
    kept = nd.one_of_each(odd_docs)
    assert kept.schema.names == odd_docs.schema.names
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 4, 5, 6, 7, 8, 9, 9]
    again = spark.createDataFrame([(1, "A b  c"), (1, "a b c"), (1, "d e f"), (2, "x"), (None, "x"), (None, "x")], "doc_id long, text string")
    assert sorted((r[0] or 0, r[1].lower().split()) for r in nd.one_of_each(again).collect()) == [(0, ["x"]), (0, ["x"]), (1, ["a", "b", "c"]), (1, ["d", "e", "f"]), (2, ["x"])]


def test_keys_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    tried = 0
    for _ in range(900):
        n = int(rng.integers(3, 120))
        pool = np.unique(rng.integers(0, 2**63, n + 40).astype(np.uint64))
        a = np.sort(rng.permutation(pool)[:n])
        drop = int(rng.integers(0, n // 4 + 1))
        b = np.sort(np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)])))
        tier = rng.choice(4, len(pool), p=[(1, 0, 0, 0), (0.4, 0.2, 0.2, 0.2), (0, 0.4, 0.6, 0), (0, 0.1, 0.3, 0.6), (0, 0, 0, 1)][rng.integers(5)])
        order = {t: (k, int(t)) for t, k in zip(pool, tier)}

        def keys(x):
            frequent = sorted((t for t in x if order.get(t, (0,))[0]), key=order.get)
            count = [sum(order[t][0] == k for t in frequent) for k in (1, 3)]
            return nd.prefix_keys(x, np.array(frequent, np.uint64), *count)

        if nd.similar(a, b) and len(a) != len(np.intersect1d(a, b)):
            tried += 1
            x, y = keys(a), keys(b)
            # At the first common key of some kind the pair is possible by what MAY_LINK asks.
            assert any(first_meeting(p, q, len(a), len(b)) for p in x for q in y)
            if common := np.intersect1d(x[0][0], y[0][0]).tolist():
                assert first_meeting(x[0], y[0], len(a), len(b)), common
    assert tried > 200


def first_meeting(x, y, n, m):
    (keys, places, own), (others, places_there, owned) = x, y
    common = set(keys.tolist()) & set(others.tolist())
    if not common or not (own or owned):
        return False
    at, there = (min(i for i, k in enumerate(z.tolist()) if k in common) for z in (keys, others))
    assert keys[at] == others[there]
    return 7 * places[at] <= 4 * n - 3 * m and 7 * places_there[there] <= 4 * m - 3 * n


@pytest.mark.parametrize("tiers", [None, (2, 40, 100)])
def test_candidates_of_shared_passages_grow_linearly(spark, monkeypatch, tiers):
    """A passage in every document, a section that 24 share, and one own word: groups don't meet each other."""
    for name, value in zip(("LIGHT", "FEW", "MANY"), tiers or ()):
        monkeypatch.setattr(nd, name, value)
    random.seed(9)
    word = lambda: f"z{random.randrange(10**7)}"
    passage, verify, made = [word() for _ in range(100)], nd._verify, []

    def counted(pairs, sets):
        made.append(pairs.count())
        return verify(pairs, sets)

    monkeypatch.setattr(nd, "_verify", counted)
    for n in (240, 600, 1200) if tiers is None else (240,):
        sections = [[word() for _ in range(30)] for _ in range(n // 24)]
        docs = [(i, " ".join(passage + sections[i // 24] + [word()])) for i in range(n)]
        made.clear()
        got = rows(nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
        assert [r[2] for r in got] == [i - i % 24 for i in range(n)]
        assert sum(made) <= 4 * n


def test_spaces():
    for x in range(1, 3000):
        low, need = nd.spaces(x)[0]
        for y in range(x, 4 * x // 3 + 1):
            met = dict(nd.spaces(y))
            assert low in met
            # Of y's tokens x may lack as many as the need of y says, less one; and the other way about.
            overlap = -(-3 * (x + y) // 7)
            assert y - overlap < met[low] and x - overlap < need


def test_join_of_one_passage(spark):
    """A passage in most texts: in some nearly all of the text, in others a part that is too small, or just large enough."""
    random.seed(3)
    word = lambda: f"y{random.randrange(10**6)}"
    passage = [word() for _ in range(80)]
    docs = []
    for i in range(700):
        own = [word() for _ in range(random.choice((0, 1, 3, 6, 9, 10, 11, 12, 14, 20, 27, 60)))]
        text = own + passage if i % 2 else passage + own
        for _ in range(random.choice((0, 0, 1, 2, 4))):
            text[random.randrange(len(text))] = word()
        docs.append((i, " ".join(text)))
    assert rows(nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_join_of_named_documents(spark, texts):
    some = {f"d{k:03d}": t for k, t in texts.items() if k < 80}
    assert rows(nd.near_duplicates(spark.createDataFrame(list(some.items()), "doc_id string, text string"))) == brute(some.items())


def test_one_row_stays_whatever_the_order(spark):
    docs = [(1, "a b c", "x"), (1, "a b c", "w"), (1, "a b c", None)]
    for order in itertools.permutations(docs):
        kept = nd.one_of_each(spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(2)).collect()
        assert [tuple(r) for r in kept] == [(1, "a b c", "w")]


def test_tables_are_removed(spark, sf_docs):
    """What stays written is the result; the tables that it was made from have no rows."""
    import os

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    found = nd.near_duplicates(sf_docs)
    stays = [d for d in set(os.listdir(base)) - before if not spark.read.parquet(f"file://{base}/{d}").isEmpty()]
    assert [d.rsplit("-", 1)[0] for d in stays] == ["near-duplicates"] and found.count() == sf_docs.count()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 101), (105, 105)] + [(200, 201 + i) for i in range(50)]
    random.seed(1)
    random.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 105: 100, **{201 + i: 200 for i in range(50)}}


@pytest.mark.parametrize("size", [3, 400])
def test_search(spark, size):
    rng = np.random.default_rng(size)
    vectors = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(size)]
    vectors += [(size + i, vectors[0][1]) for i in range(15)]  # copies: ties go to the smaller id
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, [float("inf")] * 16), (None, vectors[1][1]), (2, vectors[2][1])]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in search(table, table.filter("vec_id % 5 = 0 or vec_id >= 1000")).collect()]
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors])
    wanted, hits = [], 0
    for i in np.flatnonzero(ids % 5 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:10]
        wanted += [(int(ids[i]), r + 1, int(ids[j]), d[j]) for r, j in enumerate(order)]
    hits = len({g[:3] for g in got} & {w[:3] for w in wanted})
    assert len(got) == len(wanted) and hits >= 0.95 * len(wanted)
    scores = {(g[0], g[2]): g[3] for g in got}
    assert all(abs(scores.get(w[:1] + w[2:3], w[3]) - w[3]) < 1e-9 for w in wanted)


def test_search_of_named_vectors(spark):
    """Ids are text, copies are more than are asked for, and queries go in rounds."""
    rng = np.random.default_rng(5)
    rows = [(f"n{i:03d}", [float(x) for x in rng.normal(size=6)]) for i in range(90)]
    rows += [(f"c{i:03d}", rows[0][1]) for i in range(40)]
    table = spark.createDataFrame(rows, "name string, v array<double>").repartition(5)
    got = sorted(map(tuple, search(table, table, top=4, rerank=200, round_bytes=6 * 8 * 50, id_col="name", vector_col="v").select("query_id", "rank", "name").collect()))
    x, wanted = dict(rows), []
    for q in x:
        d = {n: sum((a - b) ** 2 for a, b in zip(x[q], x[n])) for n in x if n != q}
        wanted += [(q, i + 1, n) for i, n in enumerate(sorted(d, key=lambda n: (d[n], n))[:4])]
    assert got == sorted(wanted)


def test_search_of_nothing(spark):
    table = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert search(table, table).count() == 0


def test_search_by_the_quantiser(spark):
    """Far fewer candidates are reranked than there are: what is found is up to the codes."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 4000)] + 0.6 * rng.normal(size=(4000, 32))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]) for r in search(table, table.filter("vec_id % 100 = 0"), rerank=100, block=1024).collect()}
    wanted = set()
    for q in range(0, 4000, 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        wanted |= {(q, int(j)) for j in np.argsort(d, kind="stable")[:10]}
    assert len(got) == len(wanted) and len(got & wanted) >= 0.9 * len(wanted)


def test_search_of_odd_lengths(spark):
    """One vector of another length, whatever its place, and huge components."""
    for odd in (0, 3, 7, 49):
        rows = [(i, [float(i), 1.0] if i != odd else [1.0, 2.0, 3.0]) for i in range(50)] + [(60, [1e300, 1.0]), (61, [-1e300, 1.0])]
        got = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame([(20,), (60,), (odd,)], "vec_id long")).collect()
        assert {r["vec_id"] for r in got if r["query_id"] == 20} <= set(range(14, 27)) - {20, odd}
        assert sorted({r["query_id"] for r in got}) == sorted({20, 60} - {odd}) and len(got) == 20
