"""Fingerprints, personal data, licenses, quality and mixing against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.fingerprints import edited_fingerprints, fingerprint, fingerprints, same_text
from tidemark.llm.licenses import TEMPLATES, aligned, license_matches, winnowed
from tidemark.llm.mixing import mixed, sample
from tidemark.llm.quality import Model, Scorer, fit, keep_good, score, word_features


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_edited_fingerprints(spark, sf_docs, texts, parts):
    rows = {r["doc_id"]: r for r in edited_fingerprints(sf_docs.repartition(parts)).collect()}
    ids = sorted(texts)
    for i, k in enumerate(ids):
        text, following = texts[k], texts[ids[(i + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = rows[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint(text), fingerprint(edited))
        assert (r["near_edited"], r["near_next"]) == (float(fingerprint(text) == fingerprint(edited)), float(fingerprint(text) == fingerprint(following)))


def test_one_document_follows_itself(sf_docs):
    row = edited_fingerprints(sf_docs.filter("doc_id = 5")).first()
    assert row["near_next"] == 1.0


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count() == edited_fingerprints(odd_docs).count()
    assert fingerprints(no_docs).count() == edited_fingerprints(no_docs).count() == 0
    by_id = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert by_id[4] == by_id[5] == by_id[6] == fingerprint("") and by_id[1] == by_id[2] != by_id[3]
    assert fingerprint("Straße ① x") == fingerprint("STRASSE 1 X ")


def test_buckets_are_compared_by_bytes(odd_docs):
    # One digest for all: the classes must come from the bytes alone.
    forced = odd_docs.select("doc_id", F.lit("same").alias("fingerprint"))
    got = sorted((r["doc_id"], r["class_id"]) for r in same_text(odd_docs, forced, digest=lambda text: "same").collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 4), (7, 7), (8, 8), (9, 9)]


def test_classes_of_repeated_ids(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "B "), (3, "a"), (3, "a"), (4, "b"), (None, "a")], "doc_id long, text string")
    got = sorted(map(tuple, same_text(docs, fingerprints(docs)).collect()))
    a, b = fingerprint("a"), fingerprint("b")
    assert got == sorted([(1, a, 1), (1, b, 1), (2, b, 1), (3, a, 1), (4, b, 1)])
    assert same_text(no_docs, fingerprints(no_docs)).count() == 0
    classes = same_text(odd_docs, fingerprints(odd_docs))
    assert classes.count() == classes.distinct().count() == 10
    assert edited_fingerprints(odd_docs).join(classes, ["doc_id", "fingerprint"], "left").count() == odd_docs.count()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return sorted(out + [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15])


def test_base_spans(texts):
    random.seed(4)
    for _ in range(20_000):
        text = "".join(random.choice("ab1204.@+-- ()%_ 99..") for _ in range(random.randint(0, 40)))
        assert sorted(pii.detect(text)) == plain_spans(text), repr(text)
    for text in texts.values():
        assert sorted(pii.detect(text)) == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("mail joe [at] example [dot] com now", "email", "joe [at] example [dot] com"),
        ("write joe at example dot com", "email", "joe at example dot com"),
        ("x jоe@exаmple.com y", "email", "jоe@exаmple.com"),
        ("host １９２．１６８．１．１", "ip", "１９２．１６８．１．１"),
        ("call plus one four one three five five five two eight six six ok", "phone", "plus one four one three five five five two eight six six"),
        ("four six three four nine zero four four nine nine nine seven one zero seven four", "card", "four six three four nine zero four four nine nine nine seven one zero seven four"),
        ("a​b@c​.org", "email", "a​b@c​.org"),
    ],
)
def test_disguises(text, kind, shown):
    base, added = pii.find(text)
    assert (kind, text.index(shown), text.index(shown) + len(shown)) in added and not [b for b in base if b[0] == kind]


@pytest.mark.parametrize(
    "shown",
    [
        "joe at example.com",
        "joe at mail.example.co",
        "JOE AT EXAMPLE.COM",
        "joe at mail.example dot com",
        "joe at example [dot] com",
        "john dot smith at example dot com",
        "john dot q dot smith at example.com",
        "john dot smith [at] example dot com",
        "john [dot] smith at example.com",
        "john dot smith@example dot com",
        "joe@example dot com",
    ],
)
def test_at_and_dot_forms(shown):
    signs = [("mail ", " now"), ("to: ", ". Then"), ("(", ")"), ("Write to ", "!"), ("Contact ", ""), ("e-mail: ", "")]
    if " dot " in shown or "[dot]" in shown:  # a disguised dot is a sign itself
        signs += [("", ""), ("I think ", " is it")]
    for before, behind in signs:
        text = before + shown + behind
        base, added = pii.find(text)
        assert base == [] and added == [("email", len(before), len(before) + len(shown))], text
        assert pii.masked(text) == before + "[EMAIL]" + behind


def test_at_and_dot_in_prose():
    for text in [
        "We met at noon.Then we left at 5.30 or at 3.x",
        "look at www.example.com or at example.com/at.html",
        "it is available at example.com, and I look at example.org",
        "the dot product at hand. A dot at the end",
        "one dot two dot three",
        "version 2 at v1.2",
        "based at acme.org",
        "us at example.com",
        "Contact us at example.com",
        "shop at amazon.com",
        "hosting at host.net",
        "we mail them at example.com",
    ]:
        assert pii.find(text) == ([], []), text


def test_local_parts_with_marks():
    for local in ("joe.smith", "joe_smith", "joe2", "j.q+x"):
        text = f"ask {local} at example.com about it"
        assert pii.find(text)[1] == [("email", 4, 4 + len(local) + len(" at example.com"))], text


def test_letters_that_case_equates():
    equal = [(chr(c), a) for c in range(128, 0x110000) for a in "abcdefghijklmnopqrstuvwxyz" if re.fullmatch(a, chr(c), re.I)]
    assert {ord(c): ord(a) for c, a in equal} == pii.SAME_LETTER
    for c, a in equal:
        for word in "zero one two three four five six seven eight nine at dot plus".split():
            if a in word:
                text = f"{word.replace(a, c, 1)} one two three four five six seven [{word.replace(a, c)}] b.co"
                pii.find(text), pii.masked(text)
    assert pii.find("four ſıx three four nine zero four four nine nine nine seven one zero seven four")[1]


def test_long_at_and_dot_runs_are_linear():
    for text in ["a at " * 80_000 + "b.co", "a dot " * 80_000 + "a at b.co", "a at b.c" * 50_000, "x at " + "a." * 200_000 + "co", "a dot b@" * 50_000]:
        pii.find(text)


def test_clean_text_has_no_spans(texts):
    for text in ["We met at noon. Dot the i at once.", "uno dos tres al sol", "один два", "point] at [1]", "3 . 4 at 5"]:
        assert pii.find(text) == ([], [])


def test_long_runs_are_linear():
    for text in ["a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 400_000, "+" * 400_000, "+1" + " (" * 200_000, "a@" * 200_000, "one " * 50_000]:
        pii.find(text)


def test_pii_rows(odd_docs, no_docs):
    rows = pii.pii_spans(odd_docs).collect()
    assert len(rows) == odd_docs.count() and pii.pii_spans(no_docs).count() == 0
    spans = next(r["spans"] for r in rows if r["doc_id"] is None and r["spans"])
    assert [(s["kind"], s["added"]) for s in spans] == [("email", False), ("phone", False)]
    masked = pii.mask(odd_docs)
    assert masked.schema == odd_docs.schema and masked.filter("text like '%[EMAIL] or [PHONE]%'").count() == 1
    assert masked.filter("text is null").count() == odd_docs.filter("text is null").count()


def test_licenses(spark, sf_docs, texts, odd_docs, no_docs):
    rows = license_matches(sf_docs).collect()
    lines = {k: v for k, v in TEMPLATES.items() if k.endswith("/line")}
    planted = sorted((k, m.start(), name) for k, t in texts.items() for name, line in lines.items() for m in re.finditer(re.escape(line), t))
    assert planted and sorted((r["doc_id"], r["start"], r["license"]) for r in rows if r["coverage"] == 1.0) == planted
    assert license_matches(odd_docs).count() == license_matches(no_docs).count() == 0


def test_changed_license_is_aligned(spark):
    words = TEMPLATES["MIT/grant"].split()
    changed = [*words[:20], "very", "much", *words[20:40], *words[43:]]
    docs = spark.createDataFrame([(1, "intro words here " + " ".join(changed) + " and then more")], "doc_id long, text string")
    row = next(r for r in license_matches(docs).collect() if r["license"] == "MIT/grant")
    assert row["matched_words"] == len([w for w in words if re.sub(r"\W", "", w)]) - 3
    assert docs.first()["text"][row["start"] : row["end"]].startswith("Permission") and row["coverage"] > 0.95


def test_license_with_one_odd_word_anywhere(spark):
    """Every template with one word changed, or one more, at every place, and with every fourth changed."""
    docs, wanted = [], []
    for name, text in TEMPLATES.items():
        words = [w for w in text.split() if re.sub(r"\W", "", w)]
        cases = [([*words[:i], "qqq", *words[i + 1 :]], len(words) - 1) for i in range(len(words))]
        cases += [([*words[:i], "qqq", *words[i:]], len(words)) for i in range(1, len(words))]
        cases.append((["qqq" if i % 4 == 3 else w for i, w in enumerate(words)], len(words) - len(words) // 4))
        cases.append((" qqq ".join(words).split(), len(words)) if len(words) < 16 else (words, len(words)))
        for changed, matched in cases:
            if matched >= 0.75 * len(words):
                wanted.append((len(docs), name, matched))
                docs.append((len(docs), " ".join(["some", "text", "here", *changed, "and", "more"])))
    rows = license_matches(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert set(wanted) <= {(r["doc_id"], r["license"], r["matched_words"]) for r in rows}


def test_repeated_license_lines_are_told_apart(spark):
    line = TEMPLATES["MIT/line"]
    rows = license_matches(spark.createDataFrame([(1, " ".join([line, "Released under a MIT License.", line]))], "doc_id long, text string")).collect()
    assert [(r["license"], r["matched_words"], r["start"]) for r in rows] == [("MIT/line", 5, 0), ("MIT/line", 4, 32), ("MIT/line", 5, 62)]
    assert license_matches(spark.createDataFrame([(1, "license mit the file under that mit the license released it")], "doc_id long, text string")).count() == 0


def test_alignment_equals_full_dynamic_programme():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(1, 4, 12).astype(np.uint64), rng.integers(1, 4, 6).astype(np.uint64)
        table, best = np.zeros((13, 7)), 0
        for j in range(1, 13):
            for i in range(1, 7):
                table[j, i] = max(0, table[j - 1, i - 1] + (2 if a[j - 1] == b[i - 1] else -1), table[j - 1, i] - 1, table[j, i - 1] - 1)
                best = max(best, table[j, i])
        text = np.concatenate([np.zeros(12, np.uint64), a, np.zeros(12, np.uint64)])
        matched, first, last = aligned(text, b, 15)
        assert (best > 0) == (matched > 0) and matched <= 6 and best <= 2 * matched


def full_alignment(text, template):
    """(score, matched, first, last) of the best local alignment, the earliest of equals."""
    before, best = [(0, 0, -1)] * (len(text) + 1), (0, 0, -1, -1)
    for word in template:
        row = [(0, 0, -1)]
        for j, other in enumerate(text):
            same = word == other
            s = before[j][0] + (2 if same else -1)
            cell = (s, before[j][1] + same, before[j][2] if before[j][2] >= 0 else j) if s > 0 else (0, 0, -1)
            for c in (before[j + 1], row[j]):
                if c[0] - 1 > cell[0]:
                    cell = (c[0] - 1, c[1], c[2])
            row.append(cell)
            if same and (cell[0], -j) > (best[0], -best[3]):
                best = (*cell, j)
        before = row
    return best


def every_occurrence(text, template, need):
    """The best stretch of the whole text, then those before and after it."""
    score, matched, first, last = full_alignment(text, template)
    if matched < need:
        return set()
    return {(matched, first, last)} | every_occurrence(text[:first], template, need) | {(m, a + last + 1, b + last + 1) for m, a, b in every_occurrence(text[last + 1 :], template, need)}


def test_matches_equal_full_alignment(spark):
    """Random texts with templates that lost, gained or changed words: nothing is missed and nothing is made up."""
    random.seed(12)
    fold = lambda t: [re.sub(r"[\W_]+", "", w).lower() for w in t.split()]
    docs = []
    for i in range(120):
        words = [random.choice("the license of a work version public under rights is 2 4 0 mit general".split()) for _ in range(random.randrange(5, 40))]
        for _ in range(random.randrange(1, 3)):
            name = random.choice([n for n in TEMPLATES if len(TEMPLATES[n].split()) < 30])
            part = TEMPLATES[name].split()
            for _ in range(random.randrange(0, 1 + len(part) // 6)):
                at = random.randrange(len(part))
                part[at : at + random.choice((0, 1))] = random.choice(([], ["zz"]))
            words += part + [f"q{j}" for j in range(20)]
        docs.append((i, " ".join(words)))
    got = {}
    for r in license_matches(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got.setdefault((r["doc_id"], r["license"]), set()).add((r["matched_words"], r["start"], r["end"]))
    wanted = {}
    for i, text in docs:
        spans = [m.span() for m in re.finditer(r"[^ \t-\r]+", text)]
        words = fold(text)
        for name, template in TEMPLATES.items():
            t = [w for w in fold(template) if w]
            need = next(n for n in range(len(t) + 1) if n >= 0.75 * len(t))
            if found := every_occurrence(words, t, need):
                wanted[(i, name)] = {(m, spans[a][0], spans[b][1]) for m, a, b in found}
    assert sum(map(len, wanted.values())) > 100 and got == wanted


def test_winnowing_meets_every_window():
    rng = np.random.default_rng(0)
    for n in range(0, 30):
        g = rng.integers(0, 9, n).astype(np.uint64)
        at = set(winnowed(g, 4).tolist())
        assert all(at & set(range(i, i + 4)) for i in range(n - 3)) and (not n or at)


def test_quality_held_out(spark, sf_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = fit(docs, labels.filter(fold != 0))
    held = score(docs, model).join(labels.filter(fold == 0), "doc_id").select("quality", "score").collect()
    right = [(r["score"] >= 0.3) == bool(r["quality"]) for r in held]
    assert sum(right) / len(right) > 0.95
    kept = keep_good(docs, model).select("doc_id").collect()
    assert len(kept) == score(docs, model).filter("score >= 0.3").count()


def test_quality_odd_rows(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    blank = fit(odd_docs, nothing)
    assert {r["score"] for r in score(odd_docs, blank).collect()} == {0.5}
    only = fit(odd_docs, spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int"))
    assert min(r["score"] for r in score(odd_docs, only).collect()) > 0.99
    model = fit(odd_docs, spark.createDataFrame([(1, 1), (7, 0), (7, 1), (99, 0)], "doc_id long, quality int"))
    rows = score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert score(no_docs, model).count() == 0 and keep_good(odd_docs, model, 0.0).count() == odd_docs.count()


def test_scores_equal_a_softmax_over_means(texts):
    """A small model as it was trained: the mean of the features' vectors, the output layer, a softmax with the shares of labels."""
    from tidemark.llm.quality import features, train

    some = [texts[k].encode() for k in sorted(texts)]
    model = train(some[:40], np.arange(40) % 2, prior=0.3, epochs=2)
    got = Scorer(model.reduced()).scores(some)
    assert len(set(np.round(got, 6))) > 50
    for text, p in zip(some, got):
        words = text.split()
        at, share = features(text)
        own, of = word_features(words)
        assert sum(np.bincount(own)) == len(own) and abs(share.sum() - 1) < 1e-4 or not words
        mean = sum((s * model.vectors[a].astype(float) for a, s in zip(at, share)), np.zeros(8))
        logit = mean @ model.output + model.bias + np.array([0, model.shift])
        soft = np.exp(logit - logit.max())
        assert abs(soft[1] / soft.sum() - p) < 1e-5


def test_fit_is_bounded(spark, monkeypatch):
    """Repeated ids give one text each, and long texts end the sample."""
    from tidemark.llm import quality

    held = []
    monkeypatch.setattr(quality, "train", lambda texts, labels, prior: held.append((texts, labels.tolist())) or quality.Learned(np.zeros((2 * quality.BUCKETS, 1), np.float32), np.zeros((1, 2)), np.zeros(2), 0.0))
    docs = spark.createDataFrame([(i % 4, f"text {i} " + "x" * 100) for i in range(100)] + [(5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    fit(docs, labels, per_class=1)
    assert len(held[0][0]) == 2
    fit(docs.repartition(7), labels, per_class=1)
    assert held[0] == held[1]
    fit(docs, labels, class_bytes=1)
    assert len(held[2][0]) == 2 and sorted(held[2][1]) == [0, 1]
    fit(docs, labels)
    assert len(held[3][0]) == 4
    assert fit(docs.filter("doc_id = 77"), labels).bias == 0.0


def test_scorer_parts_equal_one_pass(monkeypatch):
    from tidemark.llm import quality

    rng = np.random.default_rng(0)
    model = Model(rng.normal(size=2 * quality.BUCKETS), 0.1)
    text = b" ".join(rng.choice([b"aa", b"bb", b"cc", b"dd"], 1000))
    whole = Scorer(model).scores([text])[0]
    monkeypatch.setattr(quality, "WORDS", 64)
    assert abs(Scorer(model).scores([text])[0] - whole) < 1e-9
    assert len(word_features(["é".encode()])[0]) == 4


def test_mixing(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = {"lang": {"en": 0.25, "fr": 0.25, "de": 0.25, "es": 0.25}}
    got = mixed(docs, wanted, keep=0.1, rounds=30)
    total = got.agg(F.sum(F.col("_tokens") * F.col("probability"))).first()[0]
    shares = {r["lang"]: r["s"] / total for r in got.groupBy("lang").agg(F.sum(F.col("_tokens") * F.col("probability")).alias("s")).collect()}
    assert all(abs(v - 0.25) < 0.01 for v in shares.values())
    by_join = mixed(docs, wanted, keep=0.1, rounds=30, driver_cells=0).select("doc_id", F.col("probability").alias("p"))
    assert got.join(by_join, "doc_id").filter(F.abs(F.col("p") - F.col("probability")) > 1e-9).count() == 0
    assert sample(no_docs).count() == 0
    kept = sample(odd_docs, keep=1.0)
    assert kept.schema.names == odd_docs.schema.names and kept.count() == odd_docs.count()
    clashing = odd_docs.select("*", *(F.lit(7).alias(c) for c in ("probability", "selected", "_u", "_tokens", "_source", "_lang", "_topic", "_doc", "mass", "n", "u", "node", "key", "nth", "place", "ids")))
    kept = sample(clashing, keep=1.0)
    assert kept.schema.names == clashing.schema.names and kept.filter("probability = 7 and _u = 7").count() == odd_docs.count()
    assert mixed(clashing).filter("probability <= 1 and _u <= 1 and mass = 7").count() == odd_docs.count()
    heavy = mixed(odd_docs, tokens_col="n_chars")
    assert heavy.filter("_tokens <> greatest(coalesce(n_chars, 1), 1)").count() == 0


def test_fit_converges(spark):
    """The marginals of the fit: the distance from the targets falls with the rounds, and is small after those that are made."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wanted = {"lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}}
    off = []
    for rounds in (1, 10):
        got = mixed(docs, wanted, keep=0.05, rounds=rounds)
        whole = got.agg(F.sum(F.col("_tokens") * F.col("probability"))).first()[0]
        shares = {r["lang"]: r["s"] / whole for r in got.groupBy("lang").agg(F.sum(F.col("_tokens") * F.col("probability")).alias("s")).collect()}
        off.append(max(abs(shares[k] - v) for k, v in wanted["lang"].items()))
    assert off[1] <= off[0] and off[1] < 0.002
