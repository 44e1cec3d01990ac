"""Personal data in disguise: transducers undo homoglyphs, spelled digits and at/dot disguises, detectors run on the result,
and normalised spans are mapped back to source characters. Everything runs in linear time in the text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_text
from .tokens import small_batches

KINDS = ("email", "ip", "card", "phone")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str):
    """Matches from each @: the local part is the run before it, as far as no earlier match has used it."""
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end and at > end and _LOCAL_END.match(text, at - 1) and (m := _DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > end and _LOCAL_END.match(text, start - 1):
                start -= 1
            end = m.end()
            yield start, end
        at = text.find("@", at + 1)


def detect(text: str) -> list[tuple[str, int, int]]:
    """The base spans (kind, start, end), by kind and start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x) <= 3 and int(x) <= 255 or int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


# Letters of other scripts that look like ASCII ones, paired in order.
LOOKALIKES = dict(zip("аеорсухіѕјһԁԛԝАВЕКМНОРСТХІЅЈοναικρτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxisjhdqwABEKMHOPCTXISJovaikptABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
#: Other forms of the marks that identifiers are made of.
MARKS = {"﹫": "@", "․": ".", "。": ".", "‐": "-", "‑": "-", "−": "-", "﹢": "+", "·": "."}
# Digit words of the four languages of the corpus.
DIGITS = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "oh",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "null eins zwei drei vier fünf sechs sieben acht neun",
    )
    for value, word in enumerate(words.split())
}
#: The characters beyond ASCII that an expression without regard to case takes for these letters.
SAME_LETTER = str.maketrans("ſıİ\u212a", "siik")
_ODD = re.compile("[" + "".join(map(re.escape, [*LOOKALIKES, *MARKS, *INVISIBLE])) + "！-～٠-٩۰-۹०-९]")
_WORD = "|".join(sorted(DIGITS, key=len, reverse=True))
_SPELLED = re.compile(rf"\b(?:(?:plus|más|mas)\s)?(?:(?:{_WORD})[ ,.-]{{1,2}}|[0-9][ ,.-]{{0,2}}){{6,}}(?:{_WORD}|[0-9])\b", re.I)
_HAS_SPELLED = re.compile(rf"\b(?:{_WORD})[ ,.-]{{1,2}}(?:(?:{_WORD})\b|[0-9])", re.I)
_SPELLED_PART = re.compile(rf"(plus|más|mas)\s|({_WORD})|([0-9])|([ ,.-]+)", re.I)
_AT = re.compile(r"\s?[\[({<]\s?(?:at|@|arroba)\s?[\])}>]\s?", re.I)
_DOT = re.compile(r"\s?[\[({<]\s?(?:dot|\.|punto|punkt|point)\s?[\])}>]\s?", re.I)
_BARE_AT = re.compile(r"(?<=[A-Za-z0-9]) at (?=[A-Za-z0-9-])", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9]) dot (?=[A-Za-z0-9-])", re.I)
#: A domain whose dots may be words or in brackets; group 1 is the last of those.
_LABELS = re.compile(rf"[A-Za-z0-9-]++(?:(?:( dot |{_DOT.pattern})|\.)[A-Za-z0-9-]++)*+", re.I)
_DISGUISED = re.compile(r"(?:at|@|arroba|dot|\.|punto|punkt|point)\s?[\])}>]|\sdot\s| at [A-Za-z0-9-]+\.[A-Za-z0-9-]", re.I)
_TOP_LEVEL = re.compile(r"[a-z]{2,}|[A-Z]{2,}")
# Words before an address, and pronouns that are nobody's local part, in the four languages of the corpus.
_CONTACT = re.compile(r"(?:\b(?:e-?mails?|mail|mailto|write|contact|reach|addresse?s?|correo|escriba|escribir|direcci[oó]n|courriel|[ée]crire|[ée]crivez|adresse|kontakt|schreiben|schreib)(?: (?:is|to|an|à|a|es|est|ist))? *:? *|[(\[{<\"':] ?)$", re.I)
_PRONOUN = frozenset("us me him her them it you uns mich nous moi nosotros".split())
_LOCAL_MARK = re.compile(r"[A-Za-z][._+0-9]|[._+0-9][A-Za-z]")
_DOT_BEFORE = re.compile(rf"(?:[A-Za-z0-9] dot |[A-Za-z0-9]{_DOT.pattern})$", re.I)


def _is_at(text: str, start: int, end: int) -> bool:
    """Whether a bare ' at ' is one of an address: a disguised dot goes with it, or it stands before a plain domain and shows a sign of one.

    Signs are a mark or digit within the local part, and a word of contact, a colon, a quote or an opening bracket before it. Without one
    'based at acme.org' is prose, and so is what a path follows.
    """
    m = _LABELS.match(text, end)
    if m[1]:
        return True
    labels = m[0].split(".")
    if len(labels) < 2 or labels[0].lower() == "www" or not _TOP_LEVEL.fullmatch(labels[-1]) or text[m.end() : m.end() + 1] == "/":
        return False
    first = start
    while first > max(0, start - 64) and _LOCAL_END.match(text, first - 1):
        first -= 1
    before, local = text[max(0, first - 24) : first], text[first:start]
    if _LOCAL_MARK.search(local) or _DOT_BEFORE.search(before):
        return True
    return local.lower() not in _PRONOUN and bool(_CONTACT.search(before))


def _dots_beside(text: str, start: int, end: int):
    """The bare ' dot 's of the local part before an at and of the domain behind it."""
    while True:
        last = start
        while start > 0 and _LOCAL_END.match(text, start - 1):
            start -= 1
        if start == last or start < 6 or text[start - 5 : start].lower() != " dot " or not _LOCAL_END.match(text, start - 6):
            break
        start -= 5
        yield start, start + 5, "."
    if m := _LABELS.match(text, end):
        for d in _BARE_DOT.finditer(text, end, m.end()):
            yield *d.span(), "."


def edits(text: str) -> list[tuple[int, int, str]]:
    """Source spans and what they stand for, in order and without overlap."""
    out: list[tuple[int, int, str]] = []
    if not text.isascii():
        for m in _ODD.finditer(text):
            c = m[0]
            plain = "" if c in INVISIBLE else LOOKALIKES.get(c) or MARKS.get(c) or (str(unicodedata.decimal(c)) if c.isdecimal() else chr(ord(c) - 0xFEE0))
            out.append((m.start(), m.end(), plain))
    if _DISGUISED.search(text):
        at = [(m.start(), m.end(), "@") for m in _AT.finditer(text)]
        dot = [(m.start(), m.end(), ".") for m in _DOT.finditer(text)]
        near = sorted(a[1] for a in at)
        for m in _BARE_DOT.finditer(text):
            if (k := bisect_left(near, m.start() - 80)) < len(near) and near[k] <= m.start():
                dot.append((*m.span(), "."))  # behind a bracketed at
        at += [(*m.span(), "@") for m in _BARE_AT.finditer(text) if _is_at(text, *m.span())]
        for start, end in [*(a[:2] for a in at), *(m.span() for m in re.finditer("@", text))]:
            dot += _dots_beside(text, start, end)
        out += at + dot
    if _HAS_SPELLED.search(text):
        for m in _SPELLED.finditer(text):
            if _HAS_SPELLED.search(m[0]):
                for p in _SPELLED_PART.finditer(text, m.start(), m.end()):
                    if not p[3]:
                        out.append((p.start(), p.end(), "+" if p[1] else DIGITS[p[2].translate(SAME_LETTER).lower()] if p[2] else ""))
    out.sort()
    kept, end = [], 0
    for e in out:
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    return kept


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and spans that only show once disguises are undone and that touch no base span of their kind."""
    base = detect(text)
    changed = edits(text)
    added: list[tuple[str, int, int]] = []
    if changed:
        parts, begins, ends, touched, last = [], [], [], [], 0
        for start, end, plain in changed:
            parts.append(text[last:start] + plain)
            begins += [*range(last, start), *[start] * len(plain)]
            ends += [*range(last + 1, start + 1), *[end] * len(plain)]
            last = end
            touched.append((start, end))
        parts.append(text[last:])
        begins += range(last, len(text))
        ends += range(last + 1, len(text) + 1)
        starts = [t[0] for t in touched]
        by_kind = {k: sorted((a, b) for kk, a, b in base if kk == k) for k in KINDS}
        for kind, a, b in detect("".join(parts)):
            a, b = begins[a], ends[b - 1]
            k = bisect_left(starts, a)
            inside = k < len(starts) and starts[k] < b
            own = by_kind[kind]
            j = bisect_left(own, (a, 0))
            if inside and not (j < len(own) and own[j][0] < b) and not (j and own[j - 1][1] > a):
                added.append((kind, a, b))
    return base, added


def ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = "array<struct<kind string, start long, end long, added boolean>>"


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every span as (kind, start, end, added) in code points of the source, by start and kind.

    ``added`` marks spans that only undone disguises show. A null or empty text has none; null and repeated ids keep
    their rows; an empty table gives no rows; other columns are ignored. No shuffle, one text at a time.
    """

    def scan(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
        for batch in small_batches(batches):
            out = []
            for text in batch.column("text").to_pylist():
                base, added = find(text)
                new = set(added)
                out.append([{"kind": k, "start": a, "end": b, "added": (k, a, b) in new} for k, a, b in ordered(base + added)])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, kind)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPAN}").withColumnRenamed("id", id_col)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for kind, a, b in ordered(sum(find(text), [])):
        if a >= last:
            out.append(text[last:a] + f"[{kind.upper()}]")
        last = max(last, b)
    return "".join(out) + text[last:]


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the personal data in text_col masked; null stays null, other columns are kept as they are, whatever their names.

    Every row is kept, repeated ones and those with null ids too; an empty table stays empty. A text is masked whole.
    """
    at = docs.columns.index(text_col)

    def scan(batches):
        for batch in small_batches(batches):
            texts = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(texts, pa.string()))

    return docs.mapInArrow(scan, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_* and base_sha256 are of the base spans, spans of all; n_added counts what the transducers add."""
    found = pii_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: ~x["added"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda x: x["added"])).cast("long").alias("n_added"))
