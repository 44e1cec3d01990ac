import pytest

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS[i * 7 % 400] + str(i % 911) for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated ids and rows, equal texts, clashing extra columns."""
    base = " ".join(WORDS[:60])
    rows = [
        (1, base, "en", "s0", 1, 7, "x"),
        (2, base, "en", "s0", 1, 7, "x"),
        (2, base, "en", "s0", 1, 7, "x"),
        (3, base + " end", None, "s0", None, 7, "x"),
        (4, None, "en", None, 1, None, None),
        (5, "", "fr", "s1", 0, 7, "x"),
        (6, " \t\n ", "fr", "s1", 3, 7, "x"),
        (None, "mail a@b.co or +1 (413) 555-2866", "en", "s1", 1, 7, "x"),
        (None, None, None, None, None, None, None),
        (7, LONG, "de", "s1", 1, 7, "x"),
        (8, "Hello  WORLD Ünï", "de", "s1", 1, 7, "x"),
        (9, "hello world ünï", "de", "s1", 1, 7, "x"),
        (9, "another text of the same id", "de", "s1", 1, 7, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, digest string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(sf_docs):
    return {r["doc_id"]: r["text"] or "" for r in sf_docs.select("doc_id", "text").collect()}
