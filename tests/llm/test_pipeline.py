"""The pipeline over a whole small corpus: every stage's rows against a plain version of that stage."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_pairs import brute
from test_texts import plain_spans
from test_tokens import assert_packed
from tokenizers import Tokenizer

from tidemark.llm import pii
from tidemark.llm.common import saved
from tidemark.llm.mixing import mixed
from tidemark.llm.quality import features, learned

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, columns, results = [n for n, _ in corpus_pipeline.STAGES], docs.columns, {}
    assert names == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        results[name] = (now, saved(stage(spark, now, SF), f"test-{name}"))
        now = results[name][1]
        assert name == "packing" or now.columns == columns

    before, after = results["quality"]
    model = learned(spark, before, SF)
    good = set()
    for r in before.collect():
        at, share = features((r["text"] or "").encode())
        score = 1 / (1 + np.exp(-(model.bias + float(model.weights[at] @ share.astype(float)))))
        assert abs(score - 0.3) > 1e-6
        if score >= 0.3:
            good.add(r["doc_id"])
    assert as_rows(after) == [r for r in as_rows(before) if r[columns.index("doc_id")] in good] and 0 < len(good) < before.count()

    before, after = results["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    stay = {k for k, _, component in brute(texts.items()) if k == component}
    assert as_rows(after) == [r for r in as_rows(before) if r[columns.index("doc_id")] in stay] and len(stay) < len(texts)

    before, after = results["personal_data"]
    masked, some = {r["doc_id"]: r for r in after.collect()}, 0
    for r in before.collect():
        text, got = r["text"] or "", masked.pop(r["doc_id"])
        added = pii.find(text)[1]
        spans = sorted([*plain_spans(text), *added], key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
        out, last = "", 0
        for kind, a, b in spans:
            if a >= last:
                out += text[last:a] + f"[{kind.upper()}]"
            last = max(last, b)
        assert (got["text"] or "") == out + text[last:] and got["n_chars"] == len(out + text[last:]) and got["source"] == r["source"]
        some += bool(spans)
    assert not masked and some

    before, after = results["mixing"]
    kept = {r["doc_id"] for r in after.collect()}
    for r in mixed(before).collect():
        u = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:8], 16) / 2**32
        assert (r["doc_id"] in kept) == (u < r["probability"])
    assert as_rows(after) == [r for r in as_rows(before) if r[columns.index("doc_id")] in kept] and 0 < len(kept) < before.count()

    before, after = results["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert_packed(after.collect(), [(r["doc_id"], r["text"]) for r in before.collect()], lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids)


def test_run_of_nothing_and_of_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        now = docs
        for name, stage in corpus_pipeline.STAGES[1:]:  # labels are those of other documents
            now = saved(stage(spark, now, SF), f"odd-{name}")
        assert (now.count() > 0) == (docs is odd_docs)
