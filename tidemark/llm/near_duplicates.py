"""N-gram Jaccard join by token-combination prefixes.

A document is its set of word shingles (hashed to 64 bits), linked with another where the sets' Jaccard similarity reaches
3/4. A set of n tokens may lack at most (4 n - 3 m) / 7 of them in a set of m that it links to, n // 4 at most; so of the
first n // 4 + 1 tokens in any order one must be shared. Three steps keep that lossless without pairing all of a group:

1. Documents with one set are one node. Among nodes, tokens of a fixed hash range (the universe) are counted exactly where
   they meet; a token that is already frequent within a task's own rows travels as one mark. Light tokens (few nodes) are
   the first of the order, so each pair that shares one is a candidate; a node with enough light tokens needs no others.
2. The rest are nodes whose sets are mostly frequent text. They are joined among themselves with counts of all their
   tokens, which are ordered by count, rare ones first. Light tokens and those in few nodes are indexed alone, frequent ones in
   combinations of k = 2 and very frequent ones of k = 3 tokens of one class. A prefix is extended until what it has alone
   plus the sum over classes (tokens - (k - 1)) reaches the number that one of must be shared: then two linked sets share
   a token of those or k tokens of one class. The number of classes follows the set's size band, so a set has a number of
   combinations in proportion to its size. Linked sets lie in one band or in neighbours, so of two that meet in a band at
   least one must be of that band itself.
3. Candidates are verified exactly on whole sets: first one partner a node and a star for each key; then, with the
   components of what was linked, candidates across components. At the first key that two nodes share, each lacks all
   tokens that the other has before it, which rules out most near misses (text that many share is last in the order);
   and only nodes outside the component of a key's centre look for partners in it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, picked, saved, scope, whole_text, without
from .components import components
from .tokens import small_batches, texts_of

#: Tokens of at most this many nodes are light.
LIGHT = 16
#: Frequent tokens of at most so many nodes are indexed alone, of more than MANY combined by three, the others by two.
FEW, MANY = 4096, 65536
#: The universe of step 1: 3/8 of all hashes.
UNIVERSE = np.uint64(3 << 61)
BUCKET_TOKENS = 500_000
#: Keys that a row of step 2 knows before its own.
BEFORE = 8
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles: A-Z lowered, words between ASCII white space."""

    def __init__(self, words: int = 5, bound: int = 80_000):
        self.words, self.bound, self.known = words, bound, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words, known = text.lower().split(), self.known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > self.bound:
            known.clear()
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(words))
        out = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            out = (out ^ (out >> np.uint64(32))) * _M[0] + h[j : len(words) - k + 1 + j]
        out = (out ^ (out >> np.uint64(29))) * _M[3]
        out.sort()
        # The multiplication above leaves weak low bits alone; order and equality are all that is used below.
        return out[np.concatenate([[True], out[1:] != out[:-1]])]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b)
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")
    shared = int((merged[1:] == merged[:-1]).sum())
    return 100 * shared >= 75 * (both - shared)


def spaces(n: int) -> list[tuple[int, int]]:
    """(low, need): the size bands, by their lower end, in which a set of n meets its partners, and how many tokens one of must be shared there.

    Linked sets lie in one band or in neighbours; they meet in the band of the smaller. In its own band a set meets sets
    from that band's lower end on, in the band below sets from 3/4 of its size on.
    """
    low, below = 1, None
    while (following := max(low + 1, -(-4 * low // 3))) <= n:
        low, below = following, low
    least = -(-3 * n // 4)
    own = [(low, (4 * n - 3 * max(low, least)) // 7 + 1)]
    return own if below is None else [*own, (below, (4 * n - 3 * least) // 7 + 1)]


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, few: int, many: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """[(keys, places, own)] of a set: its light tokens, then its keys in each of its size bands.

    ``frequent`` are the set's frequent tokens, rare ones first: ``few`` of them are indexed alone, the last ``many`` in threes. A
    key's place is the number of tokens that a set lacks which shares this key and none before, own tells whether the band is the set's own.
    """
    n = len(tokens)
    if n <= 2:
        return []  # such sets link to equal ones only
    light = tokens[~np.isin(tokens, frequent, assume_unique=True)][: n // 4 + 1]
    out = [(light, np.arange(len(light)), True)]
    rest = frequent[few:]
    for own, (low, need) in zip((True, False), spaces(n)):
        missing, seen = need - len(light), {}
        if missing <= 0:
            continue
        alone = frequent[:few][:missing]
        keys, places = [_mixed(low, alone[:, None])], [len(light) + np.arange(len(alone))]
        missing -= len(alone)
        if missing:
            # So many that a class needs few tokens more than it combines; a prefix loses at most low // 4 + 2 (low // 6) to them.
            # In bands under 15 tokens two kinds of combinations would ask for more tokens than a set has.
            kind = np.where(np.arange(len(rest)) < len(rest) - (many if low >= 15 else 0), 2, 3)
            classes = np.where(kind == 2, max(1, low // 4), max(1, low // 6)).astype(np.uint64)
            of = ((rest ^ (rest >> np.uint64(32))) * _M[1] >> np.uint64(33)) % classes
            for t, c, k in zip(rest.tolist(), of.tolist(), kind.tolist()):
                members = seen.setdefault((k, c), [])
                members.append(t)
                missing -= len(members) >= k
                if not missing:
                    break
        place = len(light) + few
        for k in (2, 3):
            of_k = [sorted(x) for (kk, _), members in seen.items() if kk == k for x in combinations(members, k)]
            if of_k:
                keys.append(np.unique(_mixed(low, np.array(of_k, np.uint64))))
                places.append(np.full(len(keys[-1]), place))
            # Of a class that shares no combination all tokens but k - 1 are missing.
            place += sum(len(members) - k + 1 for (kk, _), members in seen.items() if kk == k and len(members) >= k)
        out.append((np.concatenate(keys), np.concatenate(places), own))
    return out


def _mixed(low: int, members: np.ndarray) -> np.ndarray:
    """One key for each row of members (tokens) in a band."""
    key = np.full(len(members), (0x9E3779B97F4A7C15 * (4 * low + members.shape[1])) % 2**64, np.uint64)
    for member in members.T:
        key = (key ^ (key >> np.uint64(31)) ^ member) * _M[1]
    return (key ^ (key >> np.uint64(31))) * _M[3]


def _tokens(value) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _universe_pairs(sets: DataFrame, buckets: int) -> DataFrame:
    """(a, b, n) with a < b: candidates by light tokens of the universe; (a, null, n): frequent tokens of a node.

    A task deals its rows in parts. Tokens that several nodes of a part have are counted over all parts of the task, and
    once they are frequent only their nodes' counts go on, so a bucket gets a few rows of a token from each task.
    """

    def deal(batches):
        held, size, known, seen, marked = [], 0, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def flush():
            ids, sizes = np.array([h[0] for h in held], np.int64), np.array([len(h[1]) // 8 for h in held], np.int32)
            own = [h[2] for h in held]
            tokens, of = np.concatenate(own), np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in own])
            order = np.argsort(tokens, kind="stable")
            tokens, of = tokens[order], of[order]
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            count = np.diff(np.concatenate([first, [len(tokens)]]))
            # Tokens that are frequent here are frequent: their nodes are counted here, and one mark (slot -1) of a task goes on.
            nonlocal known, seen, marked
            several = count > 1
            both = np.concatenate([known, tokens[first[several]]])
            order = np.argsort(both, kind="stable")
            times = np.concatenate([seen, count[several]])[order]
            at = np.flatnonzero(np.concatenate([[True], both[order][1:] != both[order][:-1]])) if len(both) else np.zeros(0, np.int64)
            known, seen = both[order][at], np.add.reduceat(times, at) if len(at) else times
            frequent = np.isin(tokens[first], known[seen > LIGHT], assume_unique=True)
            many = np.repeat(frequent, count)
            node, times = np.unique(of[many], return_counts=True)
            rows = [(int(ids[0] % buckets), b"", b"", ids[node].tobytes(), times.astype(np.int32).tobytes())] if len(node) else []
            marks = np.setdiff1d(tokens[first[frequent]], marked, assume_unique=True)
            marked = np.union1d(marked, marks)
            tokens, of = np.concatenate([tokens[~many], marks]), np.concatenate([of[~many], np.full(len(marks), -1, np.int32)])
            bucket = ((tokens * _M[1]) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            tokens, of, bucket = tokens[order], of[order], bucket[order].astype(np.int64)
            found, first = np.unique(bucket, return_index=True)
            for b, x, y in zip(found.tolist(), first.tolist(), [*first.tolist()[1:], len(tokens)]):
                nodes, slot = np.unique(of[x:y], return_inverse=True)
                if len(nodes) and nodes[0] < 0:
                    nodes, slot = nodes[1:], slot - 1
                rows.append((b, tokens[x:y].tobytes(), slot.astype(np.int32).tobytes(), ids[nodes].tobytes(), sizes[nodes].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 4))], names=["bucket", "tokens", "slots", "ids", "sizes"])

        for batch in small_batches(batches):
            for key, value in zip(batch.column("node").to_pylist(), batch.column("tokens").to_pylist()):
                tokens = _tokens(value)
                own = tokens[: int(np.searchsorted(tokens, UNIVERSE))]
                if len(own):
                    held.append((key, value, own))
                    size += len(own)
                    if size > BUCKET_TOKENS // 2:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        ids, sizes, slots, tokens, base, counted = [], [], [], [], 0, []
        for t, s, i, n in zip(rows["tokens"], rows["slots"], rows["ids"], rows["sizes"]):
            if not t:
                counted.append((np.frombuffer(i, np.int64), np.frombuffer(n, np.int32)))
                continue
            ids.append(np.frombuffer(i, np.int64))
            sizes.append(np.frombuffer(n, np.int32))
            slot = np.frombuffer(s, np.int32).astype(np.int64)
            slots.append(np.where(slot < 0, -1, slot + base))
            tokens.append(_tokens(t))
            base += len(ids[-1])
        a, b, n = [x[0] for x in counted], [np.zeros(0, np.int64)], [x[1] for x in counted]
        missing = [len(x[0]) for x in counted]
        if tokens:
            ids, sizes, slots, tokens = np.concatenate(ids), np.concatenate(sizes).astype(np.int64), np.concatenate(slots), np.concatenate(tokens)
            marks = np.unique(tokens[slots < 0])
            tokens, slots = tokens[slots >= 0], slots[slots >= 0]
            order = np.lexsort((ids[slots], tokens))
            tokens, slots = tokens[order], slots[order]
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
            count = np.diff(np.concatenate([first, [len(tokens)]]))
            heavy = (count > LIGHT) | np.isin(tokens[first], marks, assume_unique=True)
            pairs = []  # two slots in one number, the smaller id's first: a node has one slot here
            for c in np.unique(count[(count > 1) & ~heavy]).tolist():
                runs = slots[first[(count == c) & ~heavy][:, None] + np.arange(c)]
                for i in range(c):
                    for j in range(i + 1, c):
                        u, v = runs[:, i], runs[:, j]
                        ok = 4 * np.minimum(sizes[u], sizes[v]) >= 3 * np.maximum(sizes[u], sizes[v])
                        pairs.append((u[ok] << 32) | v[ok])
            pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            pairs.sort()
            start = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
            met, times = pairs[start], np.diff(np.concatenate([start, [len(pairs)]]))
            a, b, n = [ids[met >> 32], *a], [ids[met & 0xFFFFFFFF]], [times, *n]
            nodes, times = np.unique(ids[slots[np.repeat(heavy, count)]], return_counts=True)
            a, n, missing = [a[0], nodes, *a[1:]], [n[0], times, *n[1:]], [len(nodes), *missing]
        a, b, n = np.concatenate(a), np.concatenate(b), np.concatenate(n)
        b = pd.array(np.concatenate([b, np.zeros(sum(missing), np.int64)]), dtype="Int64")
        b[len(a) - sum(missing) :] = pd.NA
        return pd.DataFrame({"a": a, "b": b, "n": n})

    dealt = sets.select("node", "tokens").mapInArrow(deal, "bucket long, tokens binary, slots binary, ids binary, sizes binary")
    return dealt.groupBy("bucket").applyInPandas(meet, "a long, b long, n long")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar."""
    pairs = saved(pairs, "candidates")
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    own = saved(picked(sets, wanted, "node").select("node", "tokens"), "candidate-sets")
    both = pairs.join(own.select(F.col("node").alias("u"), F.col("tokens").alias("a")), "u").join(own.select(F.col("node").alias("v"), F.col("tokens").alias("b")), "v")

    def check(batches):
        for batch in small_batches(batches):
            keep = [similar(_tokens(a.as_buffer()), _tokens(b.as_buffer())) for a, b in zip(batch.column("a"), batch.column("b"))]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return saved(both.select("u", "v", "a", "b").mapInArrow(check, "u long, v long").distinct(), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row; ids are of any type that Spark sorts.

    component_id is the smallest id that links reach; a null, empty or blank text has no shingles and links with nothing;
    rows that repeat an id are one document, linked to all that any of its texts links to; a row with a null id gets its
    n_shingles, a null component and no links; an empty table gives no rows; other columns are ignored, whatever their names.
    The rows are written once; what they were worked out from is removed.
    """
    with scope():
        return kept(_near_duplicates(docs, id_col, text_col), "near-duplicates")


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))

    def measure(batches):
        shingles = Shingler()
        for batch in small_batches(batches):
            sets = [shingles(t) for t in texts_of(batch)]
            known = batch.column("id").is_valid().to_pylist()
            columns = [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([int(np.searchsorted(s, UNIVERSE)) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_hexdigest(s) if len(s) else None for s in sets], pa.string()),
                pa.array([s.tobytes() if k and len(s) > 2 else None for k, s in zip(known, sets)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *columns], names=["row", "id", "n", "u", "digest", "tokens"])

    sized = saved(rows.mapInArrow(measure, f"row long, id {kind}, n long, u long, digest string, tokens binary"), "sets")
    told = sized.filter("id is not null and digest is not null")
    nodes = saved(told.groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("id"), F.first("n").alias("n"), F.first("u").alias("u")), "nodes")
    total = nodes.filter("n > 2").agg(F.sum("u").alias("u"), F.count("*").alias("n")).first()
    links = _same_id(told, nodes)
    if total["n"]:
        sets = sized.select(F.col("row").alias("node"), "n", "tokens")
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total["u"] or 0) // BUCKET_TOKENS)
        met = saved(_universe_pairs(picked(sets, nodes.filter("n > 2").select("node"), "node"), buckets), "met")
        light = met.filter("b is not null").groupBy(F.col("a").alias("u"), F.col("b").alias("v")).agg(F.sum("n").alias("n"))
        heavy = saved(met.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("heavy")), "heavy")
        light = saved(_possible(light, nodes, heavy), "possible-pairs")
        lacking = nodes.filter("n > 2").join(heavy, "node", "left").filter("u - coalesce(heavy, 0) < floor(n / 4) + 1")
        lacking = saved(lacking.select("node"), "lacking")
        links = links.unionByName(_link(sets, light, _combination_keys(picked(sets, lacking, "node"))))
    of = components(links)
    members = of.unionByName(of.select(F.col("root").alias("node"), "root").distinct()).join(nodes.select("node", "id"), "node")
    least = members.groupBy("root").agg(F.min("id").alias("component"))
    placed = nodes.join(members.join(least, "root").select("node", "component"), "node", "left")
    placed = saved(placed.select("digest", F.coalesce("component", "id").alias("component")), "placed")
    out = sized.join(placed, "digest", "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _possible(pairs: DataFrame, nodes: DataFrame, heavy: DataFrame) -> DataFrame:
    """The pairs (u, v, n) that may link, by n: the light tokens of the universe that they share.

    Of a's tokens at most n_a - o are missing in b, where o = 3 (n_a + n_b) / 7 is the overlap that a link needs; its light
    tokens of the universe that b lacks are among them.
    """
    size = nodes.join(heavy, "node", "left").select("node", F.col("n").alias("size"), (F.col("u") - F.coalesce("heavy", F.lit(0))).alias("light"))
    of = lambda c: size.select(F.col("node").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("size", "light")))
    spare = lambda c: F.col(f"{c}_light") - F.col("n") <= F.col(f"{c}_size") - F.ceil(3 * (F.col("u_size") + F.col("v_size")) / 7)
    return pairs.join(of("u"), "u").join(of("v"), "v").filter(spare("u") & spare("v")).select("u", "v", "n")


def _same_id(told: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (u, v) between the nodes of rows that repeat an id with different sets."""
    several = told.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("id")
    of = told.select("id", "digest").join(several, "id", "left_semi").distinct().join(nodes.select("digest", "node"), "digest")
    of = saved(of.select("id", "node"), "same-id")
    return of.join(of.groupBy("id").agg(F.min("node").alias("u")), "id").select("u", F.col("node").alias("v")).filter("u <> v")


def _combination_keys(sets: DataFrame) -> DataFrame:
    """(key, node, n, light, before) of step 2; light is 0 at keys of a single token."""
    sets = saved(sets.select("node", "tokens"), "lacking-sets")

    def tokens_of(batches):
        for batch in small_batches(batches):
            found = [_tokens(t) for t in batch.column("tokens").to_pylist()]
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), [len(s) for s in found])
            yield pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate(found).view(np.int64)), "node": pa.array(nodes, pa.int64())})

    tokens = saved(sets.mapInArrow(tokens_of, "token long, node long"), "lacking-tokens")
    frequent = tokens.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > LIGHT)
    # Rare ones first, in one order for all nodes.
    by_node = tokens.join(frequent, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("f"))
    of = lambda low, high: F.size(F.filter("f", lambda x: (x["c"] > low) & (x["c"] <= high)))
    by_node = by_node.select("node", F.transform("f", lambda x: x["token"]).alias("frequent"), of(LIGHT, FEW).alias("few"), of(MANY, 1 << 62).alias("many"))

    def sign(batches):
        for batch in small_batches(batches, 64):
            out = []
            for node, own, frequent, few, many in zip(*(batch.column(c).to_pylist() for c in ("node", "tokens", "frequent", "few", "many"))):
                own = _tokens(own)
                for keys, places, mine in prefix_keys(own, np.array(frequent or [], np.int64).view(np.uint64), few or 0, many or 0):
                    # What is known before a key: keys of the same kind, in an order that two nodes share.
                    at = np.arange(len(keys))[:, None] + np.arange(-BEFORE, 0)
                    keys = keys.view(np.int64)
                    out.append((keys, np.full(len(keys), node), np.full(len(keys), len(own)), places, np.full(len(keys), mine), keys[at[at >= 0]], np.minimum(np.arange(len(keys)), BEFORE)))
            if not out:
                continue
            keys, nodes, n, places, mine, before, held = (np.concatenate(x) for x in zip(*out))
            before = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32()), pa.array(before, pa.int64()))
            columns = [pa.array(keys), *(pa.array(x, pa.int64()) for x in (nodes, n, places)), pa.array(mine, pa.bool_()), before]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "n", "place", "own", "before"])

    return saved(sets.join(by_node, "node", "left").mapInArrow(sign, "key long, node long, n long, place long, own boolean, before array<long>"), "keys")


#: Whether two rows of a key, the first that they share, can be linked: what is before it on one side is missing on the other.
MAY_LINK = "(own or owned) and 4 * least(n, m) >= 3 * greatest(n, m) and 7 * place <= 4 * n - 3 * m and 7 * placed <= 4 * m - 3 * n"


def _link(sets: DataFrame, light: DataFrame, keyed: DataFrame) -> DataFrame:
    """Verified links that connect whatever any link connects."""
    centre = F.min_by(F.struct("node", "n", "place", "own"), F.struct(~F.col("own"), "place", "node")).alias("centre")
    counts = keyed.groupBy("key").agg(F.count("*").alias("c"), centre, F.min("n").alias("least"), F.max(4 * F.col("n") - 7 * F.col("place")).alias("reach"))
    counts = saved(counts.filter("c > 1 and centre.own"), "counts")
    # A row that no other of its key suits is out: it has more before the key than it may lack of the smallest set there, or no set may lack so little.
    of_key = counts.select("key", "least", "reach", F.col("centre.node").alias("centre"), F.col("centre.n").alias("m"), F.col("centre.place").alias("placed"), F.col("centre.own").alias("owned"))
    known = keyed.join(of_key, "key").filter("7 * place <= 4 * n - 3 * least and 3 * n <= reach")
    star = known.filter(f"node <> centre and {MAY_LINK}").groupBy(F.col("centre").alias("u"), F.col("node").alias("v")).agg(F.count("*").alias("n"))
    # One partner a node: the one with which it shares most, the smaller of equals.
    best = light.unionByName(star).groupBy("v").agg(F.max_by("u", F.struct("n", -F.col("u"))).alias("u")).select("u", "v")
    links = _verify(best, sets)
    of = saved(components(links), "first-components")
    rooted = lambda pairs, c: pairs.join(of.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    apart = rooted(rooted(light.select("u", "v"), "u"), "v").filter("u_root <> v_root").select("u", "v")
    # Keys whose nodes are in several components: pairs of a node outside the centre's component with any node of another.
    # A pair that shares many keys is made at few of them: not where both know a common key just before, and so always at
    # its first.
    placed = saved(rooted(known.select("key", F.col("node").alias("u"), "n", "place", "own", "before"), "u"), "placed-keys")
    mixed = placed.groupBy("key").agg(F.min("u_root").alias("a"), F.max("u_root").alias("b")).filter("a <> b").select("key")
    centres = rooted(mixed.join(counts.select("key", F.col("centre.node").alias("centre")), "key"), "centre").select("key", "centre_root")
    placed = saved(placed.join(centres, "key"), "mixed-keys")
    right = placed.select("key", F.col("u").alias("v"), F.col("n").alias("m"), F.col("place").alias("placed"), F.col("own").alias("owned"), F.col("before").alias("earlier"), F.col("u_root").alias("v_root"))
    outside = placed.filter("u_root <> centre_root")
    across = outside.join(right, "key").filter(f"u_root <> v_root and (v_root = centre_root or u < v) and {MAY_LINK} and not arrays_overlap(before, earlier)")
    across = across.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    tried = best.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    rest = apart.unionByName(across).distinct().join(tried, ["u", "v"], "left_anti")
    return links.unionByName(_verify(rest, sets))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id, with all its columns; and every row with a null id.

    Ids are of any type that Spark sorts. Rows that repeat an id are one document; of those with the same words one stays,
    the first by a hash of its text, then by its columns as JSON, so that the choice doesn't depend on the order of rows. A null, empty
    or blank text is in no group and stays. An empty table stays empty. Only the ids that go, and repeated ones, stay written.
    """
    with scope():
        found = near_duplicates(docs, id_col, text_col)
        gone = kept(found.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), "gone-ids")
        again = kept(found.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("c")).filter("c > 1").select(id_col), "repeated-ids")
    kept_rows = without(docs, gone, id_col).select(*docs.columns)
    if again.isEmpty():
        return kept_rows
    upper, lower = (bytes(range(x, x + 26)).decode() for x in (65, 97))
    words = F.trim(F.regexp_replace(F.translate(whole_text(text_col), upper, lower), r"[\x20\x09-\x0D]+", " "))
    one = kept_rows.join(again, id_col, "left_semi").select(F.struct(*docs.columns).alias("all"), F.col(id_col).alias("by"), F.sha2(words, 256).alias("same"), F.xxhash64(text_col).alias("h"))
    one = one.groupBy("by", "same").agg(F.min_by("all", F.struct("h", F.to_json("all"))).alias("all")).select("all.*")
    return without(kept_rows, again, id_col).select(*docs.columns).unionByName(one)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the smallest id that links reach; nulls, blanks and repeats as near_duplicates says."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
