"""N-gram Jaccard join: a size-aware join of the documents' sets of word shingles, with light and heavy sets.

Documents with equal sets are one set first. Small sets list their subsets of the size that a partner of each possible
size must share, and two sets that list one subset are candidates. Large sets, and small ones near the boundary, are
entered in inverted lists. The boundary is the one with the least estimated number of entries. Of a large set only as
many of its rarest shingles are entered as a similar set may lack, and one more; the counts are those of a share
of all shingles chosen by hash, which still suffices (sets with too few shingles of that share enter all of theirs into
lists of their own). Lists are kept per range of set sizes.

Candidates are joined to groups along the lists, not in pairs. Each group is then joined exactly: every set scans the
inverted lists of its whole set within the group, and overlaps decide. A group over ``max_block`` sets or ``max_shingles``
shingles is cut by size ranges and hash, and each pair of pieces whose sizes allow a link is joined in a task of its own, so
the memory of a task depends on neither the number nor the length of the texts of a group.

Cases: null or blank texts have an empty set and no links. A text with fewer words than ``words`` has one shingle, all
its words. Repeated rows and other copies link with each other. Rows with a null id get a size, but link with nothing and
have no component. Rows that share an id are one document of the graph. Empty tables give empty results. Other columns
are kept, but for those named as a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.graph import connected_components
from passagework.llm.words import LOWER, NOT_BLANK, Texts, find_words, hash_runs, hash_words, mix, pieces, released
from passagework.session import write_once

WORDS = 5
PERCENT = 80
SHARE = 0.3
MAX_BROADCAST = 500_000
MAX_BLOCK = 4096
#: Shingles of the sets that are joined at a time, of 8 bytes and some 40 more while they are; one set may have more.
MAX_SHINGLES = 2_000_000
#: Largest size of a set that is thought of as small, and entries in lists that weigh as much as a subset.
MOST_SMALL, LIST_WEIGHT = 24, 4

_OWN = np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: Texts, words: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data = LOWER[texts.data]
    found = find_words(Texts(data, texts.offsets), NOT_BLANK)
    symbols = hash_words(data, found)
    runs = hash_runs(symbols, words)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(runs[a:b - words + 1]))
        else:
            out.append(hash_runs(symbols[a:b], b - a) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def set_key(tokens: np.ndarray) -> int:
    """A hash of a whole set, as a signed number."""
    if not len(tokens):
        return 0
    total = np.sum(mix(tokens ^ _OWN), dtype=np.uint64, keepdims=True) ^ np.bitwise_xor.reduce(mix(tokens), keepdims=True)
    return int(mix(total * np.uint64(3) + np.uint64(len(tokens))).view(np.int64)[0])


def overlap(n: int, m: int, percent: int) -> int:
    """Least number of shared members of similar sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes of sets that can be similar to one of n."""
    return range(max(1, -(-percent * n // 100)), 100 * n // percent + 1)


def missing(n: int, percent: int) -> int:
    """Most members of a set of n that a similar set may lack."""
    return n - -(-percent * n // 100)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest small size with the least entries; ``sizes``: number of sets by size."""

    def subsets(n: int) -> int:
        return sum(math.comb(n, overlap(n, m, percent)) for m in partners(n, percent))

    def cost(x: int) -> int:
        listed = -(-percent * (x + 1) // 100)
        return sum(k * subsets(n) for n, k in sizes.items() if n <= x) + sum(
            2 * LIST_WEIGHT * k * (missing(n, percent) + 1) for n, k in sizes.items() if n >= listed)

    return min(range(MOST_SMALL + 1), key=cost)


def size_range(n, percent: int):
    """Ranges of sizes such that similar sets lie in one or in neighbours."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(100.01 / percent)).astype(np.int64)


def _sample(tokens: np.ndarray, share: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles whose counts a set needs: those of the share, and in a space of their own all, if those are few.

    The last bit of a name tells the space.
    """
    some = tokens[tokens <= np.uint64(min(int(share * 2**64), 2**64 - 1))]
    few = len(some) <= missing(len(tokens), percent)
    return some & ~np.uint64(1), mix(tokens ^ _OWN) | np.uint64(1) if few else tokens[:0]


def _listed(n: int, repeated: np.ndarray, counts: np.ndarray, alone: int, percent: int) -> np.ndarray:
    """List keys of a set of ``n``: its rarest shingles but for the ``alone`` that no other set has."""
    order = np.lexsort((repeated, counts))[:max(0, missing(n, percent) + 1 - alone)]
    b = int(size_range(n, percent))
    near = repeated[order]
    return np.concatenate([mix(near + mix(np.array([i], dtype=np.int64).view(np.uint64) ^ _OWN)) for i in (b, b + 1)])


def _is_listed(n: int, x: int, percent: int) -> bool:
    """Whether sets of ``n`` can be similar to one larger than ``x``."""
    return n >= -(-percent * (x + 1) // 100)


def _subsets(tokens: np.ndarray, x: int, percent: int) -> list[np.ndarray]:
    """Keys of the subsets that a small set may share with sets of every similar size."""
    n, keys = len(tokens), []
    if n <= x:
        names = mix(tokens)
        for m in partners(n, percent):
            c = overlap(n, m, percent)
            if c <= min(n, m):
                seed = np.uint64((min(n, m) << 32 | max(n, m)) * 2 + 1)
                of = np.array([names[list(s)].sum(dtype=np.uint64) for s in combinations(range(n), c)], dtype=np.uint64)
                keys.append(mix(of * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([seed]))))
    return keys


def _entered(found: list[tuple[int, list[np.ndarray]]]) -> pa.RecordBatch:
    """Rows of the keys of each node, every key once."""
    made = [(node, np.unique(np.concatenate(keys))) for node, keys in found if keys]
    keys = np.concatenate([k for _, k in made] + [np.zeros(0, dtype=np.uint64)]).view(np.int64)
    nodes = np.repeat(np.array([node for node, _ in made], dtype=np.int64), [len(k) for _, k in made])
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])


def _unique(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct set of a piece once, with its key."""
    seen = set()
    for tokens in sets:
        key = set_key(tokens)
        if len(tokens) and key not in seen:
            seen.add(key)
            yield key, tokens


def _count_shingles(docs: DataFrame, words: int, share: float, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                spaces = [s for _, t in _unique(shingle_sets(texts, words)) for s in _sample(t, share, percent)]
                if spaces:
                    token, n = np.unique(np.concatenate(spaces), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

    counts = docs.select("text").mapInArrow(released(run), "token long, n long")
    return counts.groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1")


def _keys_of(docs: DataFrame, sets: DataFrame, x: int, words: int, share: float, percent: int) -> DataFrame:
    """``key`` and ``node``: the entries of all sets, of shingles counted over all documents."""
    counted = _count_shingles(docs, words, share, percent)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                yield _entered([(node, _subsets(t, x, percent)) for node, t in _unique(shingle_sets(texts, words))])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                made = [(node, np.concatenate(_sample(t, share, percent)))
                        for node, t in _unique(shingle_sets(texts, words)) if _is_listed(len(t), x, percent)]
                if made:
                    nodes = np.repeat(np.array([node for node, _ in made]), [len(t) for _, t in made])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([t for _, t in made]).view(np.int64)), pa.array(nodes)], ["token", "node"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for node, n, some, found in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "some", "found"))):
                token = np.array([f["token"] for f in found], dtype=np.int64).view(np.uint64)
                count, second = np.array([f["n"] for f in found]), (token & np.uint64(1)).astype(bool)
                of = [(some, ~second)] + ([(n, second)] if some <= missing(n, percent) else [])
                made.append((node, [_listed(n, token[at], count[at], size - int(at.sum()), percent) for size, at in of]))
            yield _entered(made)

    # only shingles found twice come out of the join, so what is gathered per set is little
    places = docs.select("text").mapInArrow(released(spread), "token long, node long").join(counted, "token")
    found = places.groupBy("node").agg(F.collect_set(F.struct("token", "n")).alias("found"))
    found = found.join(sets.select("node", "n", "some"), "node").select("node", "n", "some", "found")
    subsets = docs.select("text").mapInArrow(released(small), "key long, node long")
    return subsets.unionByName(found.mapInArrow(released(lists), "key long, node long")).distinct()


def sizes_of(docs: DataFrame, words: int, share: float, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``some`` (those of the share) and ``node``, the key of the set, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                sets = shingle_sets(texts, words)
                numbers = ([len(s) for s in sets], [len(_sample(s, share, percent)[0]) for s in sets], map(set_key, sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(list(x), type=pa.int64()) for x in numbers)],
                    ["doc_id", "n_shingles", "some", "node"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, n_shingles long, some long, node long")


def _join_block(nodes: np.ndarray, weights: np.ndarray, sides: np.ndarray, tokens: list[np.ndarray], percent: int):
    """Exact join of the sets of one block by scanning inverted lists: links of each set, and edges that connect them.

    ``sides``: 0 for sets that meet all others; 1 and 2 for sets that meet only those of the other side.
    """
    size = np.array([len(t) for t in tokens])
    flat, code = np.unique(np.concatenate(tokens), return_inverse=True)
    code = code.astype(np.int32)
    order = np.argsort(code, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(flat)))])
    listed = np.repeat(np.arange(len(tokens), dtype=np.int32), size)[order]
    del flat, order
    edge = np.concatenate([[0], np.cumsum(size)])
    root = list(range(len(tokens)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = np.zeros(len(tokens), dtype=np.int64)
    for i in range(len(tokens)):
        if sides[i] == 2:
            continue
        mine = code[edge[i]:edge[i + 1]]
        lengths = first[mine + 1] - first[mine]
        many = lengths > 1
        mine, lengths = mine[many], lengths[many]
        at = np.repeat(first[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        shared = np.bincount(listed[at], minlength=len(tokens))
        both = 100 * shared >= percent * (size[i] + size - shared)
        both[i] = False
        if sides[i]:
            both &= sides == 2
        found = np.flatnonzero(both)
        links[i] += weights[found].sum()
        if sides[i]:
            links[found] += weights[i]
        for j in found.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return links, [nodes[find(i)] for i in range(len(tokens))]


def _blocks(percent: int):
    """Task over sets sorted by block: ``node``, ``root`` in the block and ``links``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: list[tuple]) -> pa.RecordBatch:
            nodes, weights, sides = (np.array([r[i] for r in rows]) for i in range(3))
            links, roots = _join_block(nodes, weights, sides, [np.frombuffer(r[3], dtype=np.uint64) for r in rows], percent)
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.array(roots, dtype=np.int64)), pa.array(links)], ["node", "root", "links"])

        key, rows = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "node", "weight", "side", "tokens"))
            for block, *row in zip(*columns):
                if block != key and rows:
                    yield solve(rows)
                    rows = []
                key = block
                rows.append(row)
        if rows:
            yield solve(rows)

    return run


def _deal(members: DataFrame, percent: int, max_block: int, max_shingles: int) -> DataFrame:
    """``node``, ``block`` and ``side``: one block per group, or the pairs of pieces of a large group."""
    spread = F.floor(F.log(F.col("n").cast("double")) / math.log(100.01 / percent)).cast("int")
    members = members.withColumn("range", spread)
    counts = members.groupBy("group", "range").agg(F.count("*").alias("k"), F.sum("n").alias("shingles"))
    total = counts.groupBy("group").agg(F.sum("k").alias("total"), F.sum("shingles").alias("shingles"))
    large = total.filter((F.col("total") > max_block) | (F.col("shingles") > max_shingles)).select("group")
    cuts = F.greatest(F.ceil(F.col("k") / (max_block // 2)), F.ceil(F.col("shingles") / (max_shingles // 2)))
    pieces_of = counts.join(large, "group").select("group", "range", F.least(cuts, F.col("k")).cast("int").alias("pieces"))
    one = members.join(large, "group", "left_anti").select(
        "node", "n", "weight", F.concat_ws(":", "group").alias("block"), F.lit(0).alias("side"))
    hot = members.join(pieces_of, ["group", "range"]).withColumn(
        "piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    after = pieces_of.select("group", (F.col("range") - 1).alias("range"), F.col("pieces").alias("next"))
    before = pieces_of.select("group", (F.col("range") + 1).alias("range"), F.col("pieces").alias("last"))
    hot = hot.join(after, ["group", "range"], "left").join(before, ["group", "range"], "left")

    def block(range_a, piece_a, range_b, piece_b):
        return F.concat_ws(":", "group", range_a, piece_a, range_b, piece_b)

    own = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(
        block(F.col("range"), F.least("piece", p), F.col("range"), F.greatest("piece", p)).alias("block"),
        F.when(p == F.col("piece"), 0).when(p > F.col("piece"), 1).otherwise(2).alias("side")))
    up = F.transform(F.sequence(F.lit(0), F.col("next") - 1), lambda p: F.struct(
        block(F.col("range"), F.col("piece"), F.col("range") + 1, p).alias("block"), F.lit(1).alias("side")))
    down = F.transform(F.sequence(F.lit(0), F.col("last") - 1), lambda p: F.struct(
        block(F.col("range") - 1, p, F.col("range"), F.col("piece")).alias("block"), F.lit(2).alias("side")))
    none = F.array().cast("array<struct<block:string,side:int>>")
    every = F.concat(own, F.coalesce(up, none), F.coalesce(down, none))
    dealt = hot.select("node", "n", "weight", F.explode(every).alias("e")).select("node", "n", "weight", "e.block", "e.side")
    return one.unionByName(dealt)


def similar_documents(
    docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT, share: float = SHARE,
    max_broadcast: int = MAX_BROADCAST, max_block: int = MAX_BLOCK, max_shingles: int = MAX_SHINGLES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, ``n_shingles``, ``n_links`` (other documents linked) and ``component_id``."""
    if not percent / 100 > 0.5 or not 1 - percent / 100 < share <= 1:
        raise ValueError("percent over 50, and a share of shingles above 1 - percent / 100, are needed")
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(text).alias("text"))
    sized = write_once(sizes_of(docs, words, share, percent))
    known = sized.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = known.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.max("some").alias("some"),
        F.count("*").alias("weight"))
    small = sets.filter(F.col("n") <= 2 * MOST_SMALL).groupBy("n").count().collect()
    x = boundary({r["n"]: r["count"] for r in small}, percent)
    keys = write_once(_keys_of(docs.filter("doc_id IS NOT NULL"), sets, x, words, share, percent))
    least = keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first <> last")
    edges = keys.join(least.select("key", "first"), "key").select(F.col("node").alias("a"), F.col("first").alias("b"))
    edges = write_once(edges.distinct())
    groups = write_once(connected_components(edges)).withColumnRenamed("component", "group")
    members = write_once(groups.join(sets, "node"))
    dealt = _deal(members.select("node", "group", "n", "weight"), percent, max_block, max_shingles)
    chosen = members.select("doc_id", "node")
    chosen = F.broadcast(chosen) if chosen.count() <= max_broadcast else chosen
    bodies = docs.join(chosen, "doc_id")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                found = shingle_sets(texts, words)
                mine = [i for i, (s, k) in enumerate(zip(found, part.column("node").to_pylist())) if set_key(s) == k]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(pa.array(mine, type=pa.int64())),
                     pa.array([found[i].tobytes() for i in mine], type=pa.binary())], ["node", "tokens"])

    whole = bodies.select("node", "text").mapInArrow(released(tokens), "node long, tokens binary").dropDuplicates(["node"])
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ready = dealt.join(whole, "node").repartition(parts, "block").sortWithinPartitions("block")
    solved = write_once(ready.select("block", "node", "weight", "side", "tokens").mapInArrow(
        released(_blocks(percent)), "node long, root long, links long"))
    components = connected_components(solved.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = solved.groupBy("node").agg(F.sum("links").alias("links"))
    found = write_once(components.join(links, "node"))
    classed = known.select("doc_id", "node").join(found, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component"))
    # rows that share an id are one document: their sets' components are joined, too
    ids = classed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    shared = classed.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    if shared.limit(1).count():
        joined = connected_components(classed.join(shared.select("doc_id", "a"), "doc_id").select(
            "a", F.col("component").alias("b")))
        ids = ids.join(joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
        whole_ids = ids.groupBy(F.coalesce("to", "component").alias("to")).agg(F.min("component_id").alias("component_id"))
        ids = ids.select("component", F.coalesce("to", "component").alias("to")).join(whole_ids, "to").drop("to")
    weights = sets.select("node", (F.col("weight") - 1).alias("copies"))
    named = sized.join(weights, "node", "left").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node")).join(ids, "component", "left")
    has = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return named.select(
        "doc_id", "n_shingles",
        F.when(has, F.coalesce("copies", F.lit(0)) + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
