"""Periodic runs of words by a dictionary of basic factors.

Words get numbers, and every stretch of 2^k words (a basic factor) gets a name from the names of its halves. Within
twice a factor's length its occurrences form arithmetic progressions, so a step to the next occurrence of at most its
length proposes a period: inside a run of period q, a factor of L >= q words first occurs again exactly q words on.
Neighbouring places with one step belong to one run, which begins at the first of them and ends L + q words after the
last. A factor that doesn't occur again in its document is dropped, and so are all longer ones that hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, whole_text
from .tokens import small_batches, texts_of

#: Length of the shortest basic factors that propose periods.
FIRST = 8
#: Numbers of words that a Python worker remembers.
WORDS = 200_000


class Numbers(dict):
    """A number for each word, given when it is first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for each different pair."""
    key = (first << 32) | second
    order = np.argsort(key, kind="stable")
    key = key[order]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else key
    return name


def _again(place: np.ndarray, name: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (ascending) whose name occurs elsewhere in their document, their names, and the step to the next occurrence (0: none)."""
    order = np.argsort(name, kind="stable")
    at, of = place[order], name[order]
    follows = (of[1:] == of[:-1]) & (doc[at[1:]] == doc[at[:-1]])
    step = np.zeros(len(place), np.int64)
    step[order[:-1][follows]] = (at[1:] - at[:-1])[follows]
    kept = np.zeros(len(place), bool)
    kept[order[:-1][follows]] = True
    kept[order[1:][follows]] = True
    return place[kept], name[kept], step[kept]


def find_runs(docs: list[np.ndarray], least: int = 24, times: int = 3) -> list[np.ndarray]:
    """For each document (word numbers under 2^31) its runs (start, length, period) by start, then period.

    A run has at least max(least, times * period) words, is extended by no neighbouring word, and its period is its
    smallest one. least is at least 16 and times at least 3, which the lengths of the factors rely on.
    """
    if least < 2 * FIRST or times < 3:
        raise ValueError("runs of fewer than 16 words or 3 periods can't be found")
    size = np.array([len(d) for d in docs], np.int64)
    end = np.cumsum(size)
    doc = np.repeat(np.arange(len(docs)), size)
    found = []
    place, name, _ = _again(np.arange(end[-1] if len(docs) else 0), np.concatenate(docs) if docs else np.zeros(0, np.int64), doc)
    length = 1
    while len(place):
        # The factor of twice the length at a place is the one there and the one that follows it, both known to occur again.
        at = np.searchsorted(place, place + length)
        at[at == len(place)] = 0
        whole = (place[at] == place + length) & (place + 2 * length <= end[doc[place]])
        place, name, length = place[whole], _names(name[whole], name[at[whole]]), 2 * length
        place, name, step = _again(place, name, doc)
        if length < FIRST:
            continue
        near = (step > (length // 2 if length > FIRST else 0)) & (step <= length)
        start, period = place[near], step[near]
        if not len(start):
            continue
        first = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(period) != 0) | (np.diff(doc[start]) != 0)]))
        last = np.concatenate([first[1:], [len(start)]]) - 1
        start, period, words = start[first], period[first], start[last] - start[first] + length + period[first]
        enough = words >= np.maximum(least, times * period)
        found.append(np.stack([start, words, period], axis=1)[enough])
    found = np.concatenate([np.zeros((0, 3), np.int64), *found])
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    of = doc[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    found[:, 0] -= (end - size)[of]
    return np.split(found, np.searchsorted(of, np.arange(1, len(docs)))) if docs else []


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words are in no run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row: its runs (start, length, period) by start, then period, and its text
    without what repeats, the words that no run holds after its first period, joined by single spaces.

    Words are separated by ASCII white space and compared as they are. A null, empty or blank text has no words, no runs
    and an empty collapsed text; rows with a null id and repeated rows keep their rows; an empty table gives no rows;
    other columns are ignored, whatever their names. A text is worked on whole: a task holds a few MB of texts, or the
    longest one, and some 100 bytes for each of its words. No shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    def measure(batches):
        numbers = Numbers()
        for batch in small_batches(batches):
            if len(numbers) > WORDS:
                numbers.clear()
            words = [t.split() for t in texts_of(batch)]
            runs = find_runs([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words], least, times)
            collapsed = [b" ".join(w if not len(r) else [w[i] for i in np.flatnonzero(kept_words(len(w), r)).tolist()]) for w, r in zip(words, runs)]
            flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], names=["start", "length", "period"])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
            columns = [batch.column("id"), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, spans), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(measure, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text of every tenth id, by crc32, replaced by its first words followed by repeats of the next few."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(whole_text(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = docs.select(*docs.columns, F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).alias("_g"))
    n = F.size("_words")
    shaped = parts.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn("_p", F.expr("1 + floor((size(_words) - _a) / (3 + _g % 8))"))
    looped_text = F.expr("array_join(transform(_words, (w, i) -> if(i < _a, w, _words[cast(_a + (i - _a) % _p as int)])), ' ')")
    return shaped.withColumn(text_col, F.when(F.col("_p").isNotNull(), looped_text).otherwise(F.col(text_col))).select(*docs.columns)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document of the contract's texts: its number of runs, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    found = periodic_runs(looped(documents(spark, sf_dir).select("doc_id", "text")))
    # Of two runs the greater exact length / period, the smaller start, the smaller period.
    better = "case when x.length * y.period <> y.length * x.period then x.length * y.period > y.length * x.period when x.start <> y.start then x.start < y.start else x.period < y.period end"
    best = F.expr(f"aggregate(runs, runs[0], (x, y) -> if({better}, x, y))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"), lines.alias("lines"), "collapsed", "n_words")
    return out.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
