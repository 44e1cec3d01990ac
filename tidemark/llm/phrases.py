"""Collocations from FM-indexes over word numbers, one for each shard of a language's text.

A shard's text is a row of word numbers with 0 between pieces. Its index is the Burrows-Wheeler transform of that row and
of the reversed row, with rotations sorted by as many symbols as a phrase may have words, which is all that intervals of
phrases need. An interval of rotations stands for a phrase and its size for the count; the reverse transform extends a
word to the right, the forward one a pair to the left. Counts of all shards are summed by buckets of phrases; a pair goes
on to three words only in the shards that hold it and only if it is frequent in its language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, kept, saved, scope, whole_text
from .runs import Numbers
from .tokens import small_batches, texts_of

#: Symbols that a task holds before it closes a shard, bytes of a text that it reads at once, and words of phrases in a bucket.
SHARD, TEXT, BUCKET = 1 << 21, 4 << 20, 1 << 20
#: Words of the longest phrase.
DEPTH = 3
#: What ends a piece becomes a byte that no text has, tabs become spaces.
ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\xff" * 10 + b" ")
#: Bits of a word's code; wider where a language has so many words that exceptions would become many.
SMALL, LARGE, MANY_WORDS, SEED = 48, 64, 1 << 30, 42


def _rotated(text: np.ndarray) -> np.ndarray:
    """Symbols before the rotations of text, which are sorted by their first DEPTH symbols."""
    keys = [np.roll(text, -i).astype(np.int64) for i in range(DEPTH)]
    if int(text.max(initial=0)) < 1 << 21:
        order = np.argsort((keys[0] << 42) | (keys[1] << 21) | keys[2], kind="stable")
    else:
        order = np.lexsort(keys[::-1])
    return np.roll(text, 1)[order]


@dataclass
class WordIndex:
    """Bidirectional index of a text of word numbers that begins or ends with 0; phrases of up to DEPTH words."""

    forward: np.ndarray
    backward: np.ndarray | None
    symbols: int

    @classmethod
    def of(cls, text: np.ndarray) -> "WordIndex":
        return cls(_rotated(text), _rotated(text[::-1]), int(text.max(initial=0)) + 1)

    def counts(self) -> np.ndarray:
        return np.bincount(self.forward, minlength=self.symbols)

    def extended(self, transform: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, low, high): every symbol that stands before an interval, and the rotations that begin with it.

        Intervals are disjoint and ascending. Rotations that begin with a symbol are in the order of what follows it, so
        those that extend one interval by one symbol stand together.
        """
        of = np.full(len(transform), -1, np.int32)
        size = high - low
        of[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.repeat(np.arange(len(low), dtype=np.int32), size)
        along = of[np.argsort(transform, kind="stable")]
        first = np.repeat(np.arange(self.symbols, dtype=np.int32), self.counts())
        begins = np.flatnonzero(np.concatenate([[True], (along[1:] != along[:-1]) | (first[1:] != first[:-1])])) if len(along) else np.zeros(0, np.int64)
        ends = np.concatenate([begins[1:], [len(along)]]).astype(np.int64)[: len(begins)]
        kept = along[begins] >= 0
        begins, ends = begins[kept], ends[kept]
        return along[begins], first[begins], begins, ends

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the symbols, that of the 0 included."""
        high = np.cumsum(self.counts())
        return high - self.counts(), high

    def pairs(self) -> tuple[np.ndarray, ...]:
        """(first, second, low, high) of all pairs of words, by their place: words extended to the right.

        The extension gives places in the reversed text; a word's pairs have their forward places within the word's, in
        the order of the second word.
        """
        low, high = self.words()
        first, second, begins, ends = self.extended(self.backward, low, high)
        order = np.lexsort((second, first))
        first, second, size = first[order], second[order], (ends - begins)[order]
        end = np.cumsum(size)  # words cover all rotations, so the places of all pairs follow each other
        kept = (first > 0) & (second > 0)
        return first[kept], second[kept], (end - size)[kept], end[kept]

    def pairs_to_the_left(self) -> tuple[np.ndarray, ...]:
        """The same pairs in the same order, from the forward transform alone."""
        second, first, low, high = self.extended(self.forward, *self.words())
        kept = (first > 0) & (second > 0)
        return first[kept], second[kept], low[kept], high[kept]

    def triples(self, low: np.ndarray, high: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first, pair, count): words before the chosen pairs, where they make a chosen pair with the pair's first word."""
        own = np.flatnonzero(chosen)
        pair, first, begins, ends = self.extended(self.forward, low[own], high[own])
        pair = own[pair]
        prefix = np.searchsorted(low, begins, side="right") - 1
        kept = (first > 0) & (prefix >= 0)
        kept[kept] = (begins[kept] < high[prefix[kept]]) & chosen[prefix[kept]]
        return first[kept], pair[kept], (ends - begins)[kept]


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array, np.uint32).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32).astype(np.int32)


def word_indexes(docs: DataFrame, lang_col: str, text_col: str, shard: int = SHARD) -> DataFrame:
    """(shard, lang, n, words, counts, forward, backward): the indexes of all texts; a shard is of one task and language.

    Of the languages that a task holds the largest is closed when all have ``shard`` symbols. Longer texts are cut at
    ends of pieces, so a shard is larger only by what is read at once, or by its longest piece.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))

    def parts(text: bytes):
        text, at = text.lower().translate(ENDS), 0
        while at < len(text):
            end = text.find(b"\xff", at + TEXT) + 1 or len(text)
            yield text[at:end].replace(b"\xff", b" \xff ").split()
            at = end

    def build(batches):
        held, closed = {}, 0

        def close(lang):
            nonlocal closed
            numbers, texts, _ = held.pop(lang)
            index = WordIndex.of(np.concatenate([*texts, np.zeros(1, np.int32)]))
            counts = index.counts()
            closed += 1
            row = ((TaskContext.get().partitionId() << 24) + closed, lang, int(counts[1:].sum()), [list(numbers)[1:]], [counts[1 : len(numbers)]], _packed(index.forward), _packed(index.backward))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            arrays = [pa.array(x if isinstance(x, list) else [x], k) for x, k in zip(row, kinds)]
            arrays[3] = arrays[3].cast(pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "lang", "n", "words", "counts", "forward", "backward"])

        total = 0
        for batch in small_batches(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                for words in parts(text):
                    if lang not in held:
                        held[lang] = [Numbers({b"\xff": 0}), [], 0]
                    numbers, texts, _ = held[lang]
                    texts.append(np.fromiter(map(numbers.__getitem__, [*words, b"\xff"]), np.int32, len(words) + 1))
                    held[lang][2] += len(texts[-1])
                    total += len(texts[-1])
                    if total > shard:
                        largest = max(held, key=lambda k: held[k][2])
                        total -= held[largest][2]
                        yield close(largest)
        for lang in list(held):
            yield close(lang)

    return rows.mapInArrow(build, "shard long, lang string, n long, words array<string>, counts array<long>, forward binary, backward binary")


@dataclass
class Codes:
    """Codes of words, their low ``bits`` of a 64-bit hash; words that share one with another get a further hash."""

    bits: int
    exceptions: dict[tuple[str, str], int]

    def of(self, lang: str, words: list[str]) -> np.ndarray:
        """Codes by word number; 0 for the separator."""
        mask, other = (1 << self.bits) - 1, {w: seed for (own, w), seed in self.exceptions.items() if own == lang}
        out = np.fromiter((xxhash.xxh64_intdigest(w.encode(), SEED) & mask for w in words), np.uint64, len(words))
        if other:
            for i, w in enumerate(words):
                if w in other:
                    out[i] = xxhash.xxh64_intdigest(w.encode(), other[w]) & mask
        return np.concatenate([np.zeros(1, np.uint64), out])


def _coded(words: DataFrame, codes: Codes) -> DataFrame:
    """words with their code, by Spark's own hash, which is the same function."""
    spark, mask = words.sparkSession, F.lit((1 << codes.bits) - 1 if codes.bits < 64 else -1).cast("long")
    out = words.withColumn("code", F.xxhash64("word").bitwiseAND(mask))
    if not codes.exceptions:
        return out
    wide = [(lang, w, int(np.uint64(xxhash.xxh64_intdigest(w.encode(), seed) & ((1 << codes.bits) - 1)).astype(np.int64))) for (lang, w), seed in codes.exceptions.items()]
    other = spark.createDataFrame(wide, "lang string, word string, other long")
    return out.join(F.broadcast(other), ["lang", "word"], "left").withColumn("code", F.coalesce("other", "code")).drop("other")


def word_codes(words: DataFrame, bits: int | None = None) -> Codes:
    """Codes under which no two words of a language are one. The exceptions are as many as words that share a hash: some
    17 of 10^8 words, and with 64 bits less than one of 10^9."""
    bits = bits or (SMALL if words.count() < MANY_WORDS else LARGE)
    codes, seed = Codes(bits, {}), SEED
    while True:
        seed += 1
        coded = _coded(words, codes)
        shared = coded.groupBy("lang", "code").agg(F.count("*").alias("c"), F.min("word").alias("least")).filter("c > 1")
        again = coded.join(shared, ["lang", "code"]).filter("word <> least").select("lang", "word").collect()
        if not again:
            return codes
        codes.exceptions |= {(r["lang"], r["word"]): seed for r in again}


def _deal(keys: np.ndarray, counts: np.ndarray, lang: str, shard: int, buckets: int, width: int):
    """Rows (bucket, lang, shard, keys, counts) of a shard's phrases; keys (n, words) are codes, and their order stays within a bucket."""
    order, bucket = _bucketed(keys, lang, buckets)
    keys, counts = keys[order], counts[order].astype(np.uint32)
    data = np.ascontiguousarray(keys).view(np.uint8).reshape(len(keys), keys.shape[1], 8)[:, :, :width] if len(keys) else np.zeros((0, 1, 1), np.uint8)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    last = [*first.tolist()[1:], len(bucket)]
    for at in range(0, len(first), 1024):
        some = list(zip(first[at : at + 1024].tolist(), last[at : at + 1024]))
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(bucket[first[at : at + 1024]], pa.int64()), "lang": pa.array([lang] * len(some)), "shard": pa.array([shard] * len(some), pa.int64()),
            "keys": pa.array([data[a:b].tobytes() for a, b in some], pa.binary()), "counts": pa.array([counts[a:b].tobytes() for a, b in some], pa.binary()),
        })


def _bucketed(keys: np.ndarray, lang: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    h = np.full(len(keys), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for column in keys.T:
        h = (h ^ column ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _summed(rows: pd.DataFrame, words: int, width: int, least: int):
    """For each language of a bucket: (lang, codes, counts) of its phrases that occur ``least`` times, and where they stand in the rows."""
    for lang, part in rows.groupby("lang"):
        size = [len(c) // 4 for c in part["counts"]]
        raw = np.zeros((sum(size), words, 8), np.uint8)
        raw[:, :, :width] = np.frombuffer(b"".join(part["keys"]), np.uint8).reshape(-1, words, width)
        keys = raw.view(np.uint64)[:, :, 0]
        counts = np.frombuffer(b"".join(part["counts"]), np.uint32).astype(np.int64)
        order = np.lexsort(keys.T[::-1])
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        total = np.add.reduceat(counts, first)
        often = total >= least
        chosen = np.zeros(len(order), bool)
        chosen[order] = np.repeat(often, np.diff(np.concatenate([first, [len(order)]])))
        yield lang, keys[first[often]], total[often], [(shard, np.flatnonzero(c)) for shard, c in zip(part["shard"], np.split(chosen, np.cumsum(size)[:-1]))]


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, shard: int = SHARD, bits: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, code, f) with all counts, and pairs (lang, c1, c2, f) and triples (lang, c1, c2, c3, f) that occur at least ``least`` times."""
    spark = docs.sparkSession
    indexes = saved(word_indexes(docs, lang_col, text_col, shard), "word-indexes")
    each = indexes.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = saved(each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")), "words")
    codes = spark.sparkContext.broadcast(word_codes(words, bits))
    width = -(-codes.value.bits // 8)
    total = indexes.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET)
    dealt = "bucket long, lang string, shard long, keys binary, counts binary"

    def deal_pairs(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, lang, local, forward, backward = (batch.column(c)[i].as_py() for c in ("shard", "lang", "words", "forward", "backward"))
                index, code = WordIndex(_unpacked(forward), _unpacked(backward), len(local) + 1), codes.value.of(lang, local)
                first, second, low, high = index.pairs()
                yield from _deal(np.stack([code[first], code[second]], axis=1), high - low, lang, name, buckets, width)

    def sum_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        bucket, out = rows["bucket"].iloc[0], []
        for lang, keys, total, places in _summed(rows, 2, width, least):
            k = keys.view(np.int64)
            out.append(pd.DataFrame({"lang": lang, "c1": k[:, 0], "c2": k[:, 1], "f": total, "shard": -1, "bucket": bucket, "places": None}))
            held = [(s, p.astype(np.uint32).tobytes()) for s, p in places if len(p)]
            out.append(pd.DataFrame({"lang": lang, "c1": 0, "c2": 0, "f": 0, "shard": [s for s, _ in held], "bucket": bucket, "places": [p for _, p in held]}))
        return pd.concat(out)

    found = indexes.select("shard", "lang", "words", "forward", "backward").mapInArrow(deal_pairs, dealt)
    found = saved(found.groupBy("bucket").applyInPandas(sum_pairs, "lang string, c1 long, c2 long, f long, shard long, bucket long, places binary"), "pairs")
    # Where a shard has frequent pairs: at most one number for each pair that it has.
    places = found.filter("shard >= 0").groupBy("shard").agg(F.collect_list(F.struct("bucket", "places")).alias("places"))

    def deal_triples(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, lang, local, forward, places = (batch.column(c)[i].as_py() for c in ("shard", "lang", "words", "forward", "places"))
                index, code = WordIndex(_unpacked(forward), None, len(local) + 1), codes.value.of(lang, local)
                first, second, low, high = index.pairs_to_the_left()
                order, bucket = _bucketed(np.stack([code[first], code[second]], axis=1), lang, buckets)
                chosen = np.zeros(len(first), bool)
                for p in places:
                    chosen[order[np.searchsorted(bucket, p["bucket"]) + np.frombuffer(p["places"], np.uint32)]] = True
                before, pair, count = index.triples(low, high, chosen)
                yield from _deal(np.stack([code[before], code[first[pair]], code[second[pair]]], axis=1), count, lang, name, buckets, width)

    def sum_triples(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, keys, total, _ in _summed(rows, 3, width, least):
            k = keys.view(np.int64)
            out.append(pd.DataFrame({"lang": lang, "c1": k[:, 0], "c2": k[:, 1], "c3": k[:, 2], "f": total}))
        return pd.concat(out)

    longer = indexes.select("shard", "lang", "words", "forward").join(places, "shard").mapInArrow(deal_triples, dealt)
    triples = saved(longer.groupBy("bucket").applyInPandas(sum_triples, "lang string, c1 long, c2 long, c3 long, f long"), "triples")
    return _coded(words, codes.value), found.filter("shard < 0").select("lang", "c1", "c2", "f"), triples


def score_of(l: str, r: str):  # noqa: E741
    """floor(10^6 f^2 / (l r)) of whole-number columns, by division of whole decimals."""
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast(f as decimal(16,0)) * cast(f as decimal(15,0))) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))")


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, lang_col: str = "lang", text_col: str = "text", shard: int = SHARD, bits: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, left, right): of each language the ``top`` phrases of two and three words.

    Texts are lower-cased (A to Z), cut into pieces at . , ; : ! ? and line ends, and pieces into words at spaces and tabs.
    a is a phrase's count in its language, n that of all words. A phrase of at least ``least`` has a score of
    floor(10^6 a^2 / (l r)) by the cut into two parts, of counts l and r, that makes it lowest, ties to the earliest
    cut; left and right are the counts of its most frequent extensions by one word that are themselves phrases (null: none).
    Phrases with 100 * left or 100 * right of at least ``share`` * a are left out. Order: score, then a, descending, then the
    phrase by its bytes. A null language is ``und``, a null or empty text has no words; ids and other columns are not
    read; an empty table gives no rows. Whole texts are counted; products are decimals of 38 digits, exact up to counts of 10^15. The
    rows are written once; what they were worked out from is removed.
    """
    with scope():
        return kept(_collocations(docs, top, least, share, lang_col, text_col, shard, bits), "collocations")


def _collocations(docs: DataFrame, top: int, least: int, share: int, lang_col: str, text_col: str, shard: int, bits: int | None) -> DataFrame:
    words, pairs, triples = phrase_counts(docs, lang_col, text_col, least, shard, bits)
    often = saved(words.filter(F.col("f") >= least).select("lang", "code", "word", "f"), "frequent-words")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    word = lambda i: often.select("lang", F.col("code").alias(f"c{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"))
    named = saved(pairs.join(word(1), ["lang", "c1"]).join(word(2), ["lang", "c2"]), "named-pairs")
    longer = named.select("lang", F.col("c1").alias("c2"), F.col("c2").alias("c3"), F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("f").alias("f23"))
    head = named.select("lang", "c1", "c2", "w1", "f1", F.col("f").alias("f12"))
    three = saved(triples.join(longer, ["lang", "c2", "c3"]).join(head, ["lang", "c1", "c2"]), "named-triples")
    left = three.groupBy("lang", F.col("c2").alias("c1"), F.col("c3").alias("c2")).agg(F.max("f").alias("left"))
    right = three.groupBy("lang", "c1", "c2").agg(F.max("f").alias("right"))
    two = named.join(left, ["lang", "c1", "c2"], "left").join(right, ["lang", "c1", "c2"], "left")
    two = two.filter(f"100 * coalesce(greatest(left, right), 0) < {int(share)} * f")
    cut = lambda l, r, k: F.struct(score_of(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))  # noqa: E731, E741
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), cut("f1", "f2", 1).alias("cut"), "left", "right")
    none = F.lit(None).cast("long")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), F.least(cut("f1", "f23", 1), cut("f12", "f3", 2)).alias("cut"), none.alias("left"), none.alias("right"))
    both = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "left", "right")
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left", "right")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two and three words."""
    return collocations(documents(spark, sf_dir)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql() -> str:
    upper, lower = (bytes(range(x, x + 26)).decode() for x in (65, 97))
    return rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
    placed AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded WHERE len(w) > 0),
    one AS (SELECT lang, w[i] AS w1, count(*) AS f FROM placed GROUP BY ALL),
    two AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM placed WHERE i + 1 <= len(w) GROUP BY ALL),
    three AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM placed WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
    cuts AS (
      SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
      FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
      WHERE t.f >= 10 AND NOT EXISTS (SELECT 1 FROM three z WHERE z.lang = t.lang AND ((z.w1 = t.w1 AND z.w2 = t.w2) OR (z.w2 = t.w1 AND z.w3 = t.w2)) AND 100 * z.f >= 50 * t.f)
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
      FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
      FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
    scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
