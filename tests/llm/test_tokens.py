"""Encoding, packing, the keyed store and the digest cache against whole-text encoding."""

import gc
import os
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.common import shared_dir
from tidemark.llm.packing import Shard, pack
from tidemark.llm.token_counts import cache, token_counts
from tidemark.llm.token_store import PerfectHash, find, get, read, write_store
from tidemark.llm.tokens import ChunkEncoder, term_runs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_chunks_equal_whole_texts(whole):
    random.seed(3)
    parts = [*"aZé’'stdrelvm 0129.,!\n\t\x0b\x1c\x85\xa0 ß中ñΣσİ", "<|endoftext|>", "<|", "'s", "́", "​", "😀", "ﬁ"]
    coder = ChunkEncoder.of(PATH)
    for _ in range(5000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        assert np.frombuffer(coder.encode([text.encode()])[0], coder.dtype).tolist() == whole(text), repr(text)


def test_chunks_of_a_batch_equal_whole_texts(whole):
    """Texts are cut together: white space, Latin-1 letters, signs beside them, special strings and apostrophes at every text's ends."""
    random.seed(7)
    parts = [*"aZé'st 019.<\n\x0b\x0c\r\x1c\x7f\x85 ß×÷ÀÞÿºσ", "<|endoftext|>", "<|ENDOFTEXT|>", "word", "Été", "'LL"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 9))) for _ in range(3000)]
    coder = ChunkEncoder(PATH)
    for some in ([], [""], [" ", ""], texts):
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in some])] == [whole(t) for t in some]


def test_a_piece_is_read_once_whatever_stands_around_it():
    coder, read = ChunkEncoder(PATH), []
    tokenize = coder.tokenize
    coder.tokenize = lambda piece: read.append(piece) or tokenize(piece)
    coder.encode([b"Zanzibo zanzibo, ZANZIBO; (zanzibo) zanzibo-zanzibo7", b"7zanzibo."])
    assert read.count("zanzibo") == 1 and len(read) == len(set(read))


def test_a_forgotten_encoder_is_gone():
    """Its memory goes back when the steps after the encoding begin, not when Python next looks for cycles."""
    coder = weakref.ref(ChunkEncoder.of(PATH))
    coder().encode([b"some words"])
    gc.disable()
    try:
        ChunkEncoder.forget()
        assert coder() is None
    finally:
        gc.enable()


def test_term_runs_of_many_documents_and_wide_terms():
    for docs in ([np.array([5, 3, 5], "<u2")] * 65_537, [np.array([70_000, 3, 70_000], "<u4"), np.array([65_535], "<u4")]):
        of, term, times = term_runs(docs)
        wanted = [(i, t, n) for i, d in enumerate(docs) for t, n in sorted(Counter(d.tolist()).items())]
        assert list(zip(of.tolist(), term.tolist(), times.tolist())) == wanted


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def assert_packed(rows, docs, whole):
    """docs: (id, text). Every id in one piece, offsets without gaps, no padding but at powers of two."""
    wanted = sorted((k is None, k or 0, tuple(whole(t) + [1])) for k, t in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    ids = defaultdict(list)
    for _, k, x in wanted:
        ids[k].append(x)
    for k, pieces in by_doc.items():
        own = ids[k or 0]
        assert sum(p["length"] for p in pieces) == sum(len(x) for x in own)
        for p in pieces:
            assert any(len(x) == p["doc_tokens"] and crc(x[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for x in own)
        if len(own) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(len(x) for _, _, x in wanted)


def test_packing(sf_docs, texts, whole):
    assert_packed(pack(sf_docs, PATH, 1, shard_tokens=50_000).collect(), texts.items(), whole)


def test_packing_odd_rows(odd_docs, no_docs, whole):
    assert_packed(pack(odd_docs, PATH, 1).collect(), [(r["doc_id"], r["text"]) for r in odd_docs.collect()], whole)
    assert pack(no_docs, PATH, 1).count() == 0


def test_bm25_neighbours_equal_brute_force():
    random = np.random.default_rng(1)
    docs = [random.integers(0, 50, random.integers(1, 30)) for _ in range(40)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=50)
    idf = np.maximum(0, np.log((40 - df + 0.5) / (df + 0.5)))
    shard = Shard(docs, idf, 15.0)
    for seed in range(40):
        score = [sum(idf[t] * (tf := (d == t).sum()) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / 15.0)) for t in np.unique(docs[seed])) for d in docs]
        order = shard.neighbours(seed)
        assert np.allclose(np.array(score)[order], np.sort(score)[::-1])


def test_neighbours_among_the_unused_equal_brute_force():
    random = np.random.default_rng(4)
    docs = [(random.zipf(1.3, random.integers(1, 60)) - 1) % 300 for _ in range(200)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=300)
    idf = np.maximum(0, np.log((200 - df + 0.5) / (df + 0.5)))
    shard, left = Shard(docs, idf, 15.0), np.ones(200, bool)
    while left.any():
        seed = int(np.flatnonzero(left)[0])
        shard.unused[seed] = left[seed] = False
        score = np.array([sum(idf[t] * (tf := (d == t).sum()) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / 15.0)) for t in np.unique(docs[seed])) for d in docs])
        order = shard.neighbours(seed)
        assert sorted(order) == np.flatnonzero(left).tolist() and np.allclose(score[order], np.sort(score[left])[::-1])
        some = shard.neighbours(seed, 100)
        assert some.tolist() == order[: len(some)].tolist() and (len(some) == len(order) or sum(len(docs[i]) for i in some) >= 100)
        shard.unused[some[:2]] = left[some[:2]] = False


def test_packing_finds_partners_far_apart(spark):
    """Pairs that repeat a word of their own, among 2^20 tokens and more: the largest id of each text tells nothing."""
    random = np.random.default_rng(5)
    vocabulary = {w: i for w, i in Tokenizer.from_file(PATH).get_vocab().items() if w.isascii() and w.isalpha() and w.islower() and len(w) > 2}
    coder = ChunkEncoder.of(PATH)
    single = [w for w in sorted(vocabulary, key=vocabulary.get) if len(coder.encode([w.encode()])[0]) == coder.dtype.itemsize]
    common, topics, rare = single[:50], single[2000:2520], random.permutation(single[-1040:])
    texts = [" ".join([rare[i]] + [topics[i % 520]] * 200 + [*random.choice(common, 822)]) for i in range(1040)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sequences = defaultdict(set)
    for r in pack(docs, PATH, 1).collect():
        sequences[r["sequence_id"]].add(r["doc_id"])
    assert sorted(map(sorted, sequences.values())) == [[i, i + 520] for i in range(520)]


def test_perfect_hash():
    random = np.random.default_rng(2)
    h1, h2 = random.integers(0, 2**63, 5000).astype(np.uint64), random.integers(0, 2**63, 5000).astype(np.uint64)
    h1[:9] = h1[0]  # equal first hashes are told apart by the second
    assert sorted(PerfectHash.build(h1, h2).slots(h1, h2)) == list(range(5000))


@pytest.mark.parametrize("which", ["sf_docs", "odd_docs"])
def test_store_round_trip(spark, request, whole, which):
    docs = request.getfixturevalue(which)
    path = shared_dir(spark, "store")
    write_store(docs, path, PATH, 2, shard_ids=20_000, bucket_keys=50)
    rows = docs.select("doc_id", "text").collect()
    nth, keys = defaultdict(int), []
    for r in rows:
        keys.append((r["doc_id"], nth[r["doc_id"]]))
        nth[r["doc_id"]] += 1
    absent = [(10**9 + i, 0) for i in range(300)]
    found = read(spark, path, find(spark, path, spark.createDataFrame(keys + absent, "key long, nth long"))).collect()
    assert sorted((f["key"] is None, f["key"], f["nth"]) for f in found) == sorted((k is None, k, n) for k, n in keys)
    stored = defaultdict(list)
    for f in sorted(found, key=lambda f: f["start"]):
        stored[f["key"]].append(np.frombuffer(f["ids"], "<u4").tolist())
    for key in nth:
        assert sorted(stored[key]) == sorted(whole(r["text"]) + [2] for r in rows if r["doc_id"] == key)
    at = 0
    for f in sorted(found, key=lambda f: f["start"]):
        assert f["start"] == at
        at += f["n_tokens"]
    order = [f["key"] for f in sorted(found, key=lambda f: f["start"]) if f["key"] is not None]
    assert order == sorted(order)


def test_store_of_nothing(spark, no_docs):
    path = shared_dir(spark, "store")
    write_store(no_docs, path, PATH, 2)
    keys = spark.createDataFrame([(1, 0)], "key long, nth long")
    assert find(spark, path, keys).count() == read(spark, path, find(spark, path, keys)).count() == 0 and get(spark, path, 1) is None


def test_a_lookup_reads_its_bucket_alone(spark, whole, sf_docs, texts):
    path = shared_dir(spark, "store")
    write_store(sf_docs, path, PATH, 2, bucket_keys=2)
    few = spark.createDataFrame([(k, 0) for k in sorted(texts)[:2]], "key long, nth long")
    found = find(spark, path, few)
    plan = found._jdf.queryExecution().toString()
    assert found.count() == 2 and "PartitionFilters: [span" in plan
    for k in sorted(texts)[:9]:
        assert get(spark, path, k).tolist() == whole(texts[k]) + [2]
    assert get(spark, path, 10**9) is None and get(spark, path, None) is None
    kept = sorted(texts)[0]
    # Without all other folders of the index the key is still found.
    buckets = spark.read.parquet(f"{path}/meta").first()["buckets"]
    assert buckets > 16
    local = path.removeprefix("file://")
    spans = {int(d.split("=")[1]) for d in os.listdir(f"{local}/index") if d.startswith("span=")}
    own = [s for s in spans if spark.read.parquet(f"{path}/index/span={s}").count()]
    assert len(own) == len(spans) > 1
    aside = f"{local}/aside"
    os.makedirs(aside)
    moved = 0
    for s in spans:
        os.rename(f"{local}/index/span={s}", f"{aside}/span={s}")
        try:
            hit = get(spark, path, kept)
        except Exception:  # the folder of its bucket is the one that is away
            moved += 1
        else:
            assert hit.tolist() == whole(texts[kept]) + [2]
        os.rename(f"{aside}/span={s}", f"{local}/index/span={s}")
    assert moved == 1


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, odd_docs, no_docs, name):
    path, store = public_tokenizers.path(name), shared_dir(spark, "cache")
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t, m=sentencepiece.SentencePieceProcessor(model_file=path): len(m.encode(t))
    else:
        count = lambda t, m=Tokenizer.from_file(path): len(m.encode(t, add_special_tokens=False).ids)
    assert token_counts(no_docs, path, store).count() == 0
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    wanted = sorted(((r["doc_id"], len((r["text"] or "").encode()), count(r["text"] or "")) for r in odd_docs.collect()), key=key)
    assert sorted(map(tuple, token_counts(odd_docs, path, store).collect()), key=key) == wanted
    stored = cache(spark, store).count()
    assert sorted(map(tuple, token_counts(odd_docs, path, store).collect()), key=key) == wanted
    assert cache(spark, store).count() == stored == odd_docs.na.fill({"text": ""}).select("text").distinct().count()


def test_repeated_texts_are_encoded_once(spark, monkeypatch):
    """500 copies of a row and 500 rows without an id: two texts, and none the second time."""
    from tidemark.llm import token_counts as module

    docs = spark.createDataFrame([(1, "one text")] * 500 + [(None, "another")] * 500, "doc_id long, text string").repartition(7)
    log = shared_dir(spark, "log").removeprefix("file://")
    os.makedirs(log)
    plain = module._encoder

    def counted(path):
        count = plain(path)

        def run(texts):
            with open(f"{log}/{os.getpid()}", "a") as f:
                f.write("x" * len(texts))
            return count(texts)

        return run

    monkeypatch.setattr(module, "_encoder", counted)
    path, store = public_tokenizers.path("piece_bpe_32k.model"), shared_dir(spark, "cache")
    for _ in range(2):
        assert token_counts(docs, path, store).groupBy("doc_id").count().count() == 2
        assert sum(os.path.getsize(f"{log}/{f}") for f in os.listdir(log)) == 2


def test_keys_of_other_types(spark, whole):
    """A key is found by its value, however Spark writes it as text."""
    import datetime
    import decimal

    day, moment = datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 1, 2, 3)
    for kind, keys, absent in [
        ("double", [1e10, -0.5, 1e-7, 12345678901234.0], 2.0),
        ("boolean", [True, False], None),
        ("date", [day, datetime.date(1, 1, 1)], datetime.date(2024, 3, 1)),
        ("timestamp", [moment], datetime.datetime(2024, 2, 29)),
        ("string", ["", "é x", "1"], "2"),
        ("decimal(20,4)", [decimal.Decimal("1.5000"), decimal.Decimal("100")], decimal.Decimal("2")),
        ("long", [5, -(2**62)], 6),
    ]:
        path = shared_dir(spark, "keys")
        docs = spark.createDataFrame([(k, f"text of {i}") for i, k in enumerate(keys)] + [(None, "none")], f"key {kind}, text string")
        write_store(docs, path, PATH, 2, id_col="key")
        for i, k in enumerate(keys):
            assert get(spark, path, k).tolist() == whole(f"text of {i}") + [2], (kind, k)
        assert get(spark, path, None).tolist() == whole("none") + [2]
        assert absent is None or get(spark, path, absent) is None
    assert get(spark, path, "5").tolist() == whole("text of 0") + [2] and get(spark, path, "no number") is None
