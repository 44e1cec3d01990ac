"""Collocations against plain counting, against the SQL, and the index against a search of the text."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import WordIndex, collocations, phrase_counts, score_of
from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def plain(docs, top=2000, least=10, share=50):
    counts = defaultdict(Counter)
    for lang, text in docs:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        within = defaultdict(int)
        for p, a in often.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    within[part] = max(within[part], a)
        rows = []
        for p, a in often.items():
            if 100 * within.get(p, 0) < share * a or p not in within:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def test_index_counts_every_phrase():
    random.seed(2)
    for symbols in (2, 5, 60):
        text = np.array([random.randrange(symbols) for _ in range(700)] + [0], np.int32)
        index, t = WordIndex.of(text), text.tolist()
        first, second, low, high = index.pairs()
        wanted = Counter((a, b) for a, b in zip(t, t[1:]) if a and b)
        assert dict(zip(zip(first.tolist(), second.tolist()), (high - low).tolist())) == wanted
        assert all((x == y).all() for x, y in zip(index.pairs(), index.pairs_to_the_left()))
        chosen = np.array([random.random() < 0.7 for _ in first], bool)
        before, pair, count = index.triples(low, high, chosen)
        got = {(a, int(first[p]), int(second[p])): c for a, p, c in zip(before.tolist(), pair.tolist(), count.tolist())}
        picked = {p for p, c in zip(zip(first.tolist(), second.tolist()), chosen) if c}
        assert got == {p: c for p, c in Counter(zip(t, t[1:], t[2:])).items() if all(p) and p[:2] in picked and p[1:] in picked}


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries()["op11_collocations"](spark, SF)
    assert got.columns == COLUMNS and {f.dataType.simpleString() for f in got.schema if f.name not in ("lang", "phrase")} == {"bigint"}
    found = rows_of(got)
    assert found == sorted(duck.execute(oracle_sql()["op11_collocations"]).fetchall())
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found == plain(docs)


@pytest.mark.parametrize("bits", [None, 6])
def test_many_small_shards(spark, bits, monkeypatch):
    """Shards of some 300 words, texts read in parts, and codes so short that most words share one."""
    monkeypatch.setattr(phrases, "TEXT", 200)
    random.seed(5)
    words = ["The", "a", "a.", "of", "to,", "ünï", "Ünï", "x;y", "go\tgo", "a\x1cb", "\x00", "no\nno", "w!?"] + [f"v{i}" for i in range(30)]
    docs = [(random.choice(("en", "fr", None)), " ".join(random.choice(words) for _ in range(random.randrange(0, 200)))) for _ in range(150)]
    df = spark.createDataFrame([(i, *d, "x", 1) for i, d in enumerate(docs)], "doc_id long, lang string, text string, phrase string, n int").repartition(5)
    found = collocations(df, least=4, share=40, top=60, shard=300, bits=bits)
    assert rows_of(found) == plain(docs, 60, 4, 40)
    if bits:
        words, _, _ = phrase_counts(df, least=4, shard=300, bits=bits)
        assert words.groupBy("lang", "code").count().filter("count > 1").isEmpty()


def test_extensions_and_overlaps(spark):
    docs = [("en", "a a a a")] * 6 + [("en", "p q r, p q, z q r")] * 5 + [("en", "p q")] * 7
    df = spark.createDataFrame(docs, "lang string, text string")
    got = {r["phrase"]: r for r in collocations(df, least=5).collect()}
    assert rows_of(collocations(df, least=5)) == plain(docs, least=5)
    assert got["a a a"]["a"] == 12 and "a a" not in got and got["p q"]["a"] == 17 and got["p q"]["right"] == 5 and got["p q"]["left"] is None


def test_collocations_of_odd_rows(spark, odd_docs, no_docs):
    docs = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(collocations(odd_docs, least=2)) == plain(docs, least=2)
    assert collocations(no_docs).count() == 0
    blank = spark.createDataFrame([(None, None), ("en", ""), ("en", " .,\n")], "lang string, text string")
    assert collocations(blank, least=1).count() == 0


def test_large_counts(spark):
    """Products beyond 64 bits and a floor just under a whole number."""
    f, part = 3_000_000_007, 3_000_000_011
    row = spark.createDataFrame([(f, part, part)], "f long, l long, r long")
    assert row.select(score_of("l", "r")).first()[0] == 10**6 * f * f // (part * part)
