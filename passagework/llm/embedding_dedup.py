"""Embedding near-dedup on a robust-pruned flat graph.

Vectors of one label (and one length) are dealt to overlapping cluster shards: each belongs to its nearest centres. Every
shard builds a flat graph whose lists are thinned by robust pruning, and the lists of a vector are united over its
shards. Each vector then searches the shards of its ``probes`` nearest centres, but for those that can hold nothing in
range: greedily from the shard's medoid, then on
from everything found within the range until nothing new lies in it. Cosines are verified in double precision. A
vector is counted by the one shard that is its nearest, so links are counted once without any list of pairs; what
leaves a task are counts and the edges of a spanning forest. At last recall is audited against all vectors for
``audit`` of them, and the search is repeated with twice the probes while recall is below ``least_recall``.

The centres are fitted on at most ``sample`` vectors, chosen by hash; all vectors are indexed. There are at most
``max_centres`` centres, which bounds what is broadcast. A shard that outgrows ``max_shard``, such as copies of one
vector with noise, is cut by hash, and its queries search every piece.

Cases: a vector that is null, empty, zero or has null or non-finite components, and one without a label, has no links.
Equal vectors of one label are one node of the graph with a weight, and link with each other. Rows with one vec_id are vectors of
their own in ``n_links``, and one vertex in ``component_id``; rows with a null vec_id have no links, no component and are
kept. Empty tables give empty results. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.llm.graph import connected_components
from passagework.session import write_once

THRESHOLD = 0.98
SHARD, MAX_SHARD, MAX_CENTRES, SAMPLE = 1000, 4096, 20_000, 100_000
OVERLAP, PROBES = 2, 3
DEGREE, POOL, SLACK = 24, 64, 1.2
BEAM, STRIDE, LANES = 32, 4, 256
AUDIT, LEAST_RECALL = 1000, 0.9
#: Cells of a matrix of vectors against centres that is held at a time.
CELLS = 4_000_000


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; safe for very large and very small components."""
    rows = rows.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centres of unit vectors by Lloyd's rounds; never more than there are vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        height = max(1, CELLS // max(1, len(centres)))
        nearest = np.concatenate([(sample[at:at + height] @ centres.T).argmax(1) for at in range(0, len(sample), height)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def robust_prune(points: np.ndarray, own: np.ndarray, pool: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """For each of ``own`` up to ``degree`` of its ``pool``, nearest first; one that is ``slack`` times nearer to a chosen
    one than to the point is passed over. -1 fills up."""
    near = np.take_along_axis(pool, np.argsort(-np.einsum("pjk,pk->pj", points[pool], points[own]), axis=1), 1)
    to_own = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("pjk,pk->pj", points[near], points[own])))
    among = np.sqrt(np.maximum(0, 2 - 2 * np.matmul(points[near], points[near].transpose(0, 2, 1))))
    alive = near != own[:, None]
    out = np.full((len(own), degree), -1, dtype=np.int64)
    filled = np.zeros(len(own), dtype=np.int64)
    for j in range(near.shape[1]):
        take = alive[:, j] & (filled < degree)
        out[np.flatnonzero(take), filled[take]] = near[take, j]
        filled += take
        alive &= ~(take[:, None] & (slack * among[:, j] <= to_own))
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, pool: int = POOL, slack: float = SLACK) -> list[np.ndarray]:
    """Neighbours of every point of a shard, both ways."""
    n = len(points)
    rng = np.random.default_rng(n)
    small = points.astype(np.float32)
    starts, ends = [], []
    for at in range(0, n, 128):
        own = np.arange(at, min(n, at + 128))
        alike = small[own] @ small.T
        near = np.argpartition(-alike, min(pool, n - 1), axis=1)[:, :pool + 1]
        far = rng.integers(0, n, (len(own), 16))
        found = robust_prune(small, own, np.concatenate([near, far], axis=1), degree, slack)
        row, col = np.nonzero(found >= 0)
        starts.append(own[row])
        ends.append(found[row, col])
    a, b = np.concatenate(starts), np.concatenate(ends)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return (np.concatenate(lists) if edges[-1] else np.zeros(0, dtype=np.int64)), edges


def _neighbours(flat, edges, of) -> tuple[np.ndarray, np.ndarray]:
    count = edges[of + 1] - edges[of]
    at = np.repeat(edges[of] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return np.repeat(np.arange(len(of)), count), flat[at]


def range_search(
    points: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, own: np.ndarray, threshold: float, beam: int = BEAM,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) with a cosine of ``threshold`` or more that the graph leads to.

    ``own``: the query's place among the points, or -1. Queries move on side by side; each keeps its ``beam`` best and
    follows the ``STRIDE`` best of them that are new.
    """
    n, m = len(points), len(queries)
    flat, edges = _flat(graph)
    medoid = int((points @ points.mean(0)).argmax())
    single = points.astype(np.float32), queries.astype(np.float32)
    seen = np.zeros((m, n), dtype=bool)
    best = np.full((m, beam), -1, dtype=np.int64)
    score = np.full((m, beam), -9.0)
    done = np.ones((m, beam), dtype=bool)
    rows_found, points_found = [], []

    def look(lane: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cosines of pairs not seen before."""
        fresh = ~seen[lane, node]
        keys = np.unique(lane[fresh] * n + node[fresh])
        lane, node = keys // n, keys % n
        seen[lane, node] = True
        alike = np.einsum("ik,ik->i", single[1][lane], single[0][node])  # to find the way
        close = np.flatnonzero(alike >= threshold - 1e-4)
        exact = np.einsum("ik,ik->i", queries[lane[close]], points[node[close]])
        close = close[exact >= threshold]
        rows_found.append(lane[close])
        points_found.append(node[close])
        return lane, node, alike

    def enter(lane: np.ndarray, node: np.ndarray, alike: np.ndarray) -> None:
        nonlocal best, score, done
        order = np.lexsort((-alike, lane))
        lane, node, alike = lane[order], node[order], alike[order]
        rank = np.arange(len(lane)) - np.searchsorted(lane, lane)
        keep = rank < beam
        lane, node, alike, rank = lane[keep], node[keep], alike[keep], rank[keep]
        new, new_score = np.full((m, beam), -1, dtype=np.int64), np.full((m, beam), -9.0)
        new[lane, rank], new_score[lane, rank] = node, alike
        best, score = np.concatenate([best, new], 1), np.concatenate([score, new_score], 1)
        done = np.concatenate([done, new < 0], 1)
        top = np.argsort(-score, axis=1, kind="stable")[:, :beam]
        best, score, done = (np.take_along_axis(x, top, 1) for x in (best, score, done))

    enter(*look(np.arange(m), np.full(m, medoid)))
    members = np.flatnonzero(own >= 0)
    if len(members):
        enter(*look(members, own[members]))
    while True:
        lane = np.flatnonzero(~done.all(1))
        if not len(lane):
            break
        new = ~done[lane]
        row, pick = np.nonzero(new & (np.cumsum(new, axis=1) <= STRIDE))
        done[lane[row], pick] = True
        which, node = _neighbours(flat, edges, best[lane[row], pick])
        found = look(lane[row[which]], node)
        if len(found[0]):
            enter(*found)
    # go on from all that lies in range
    at = 0
    while at < len(rows_found):
        which, node = _neighbours(flat, edges, points_found[at])
        if len(node):
            look(rows_found[at][which], node)
        at += 1
    return np.concatenate(rows_found), np.concatenate(points_found)


class Centres:
    """Centres of each group of vectors; ``base`` numbers the shards of a group."""

    def __init__(self, of: dict[tuple, np.ndarray]):
        self.of, self.base, total = of, {}, 0
        for key, centres in sorted(of.items(), key=str):
            self.base[key] = total
            total += len(centres)
        self.total = total


def make_nodes(df: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows with the node of their vector, and the nodes: distinct vectors of a label, with their weights."""
    v = F.col("v")
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    fine = F.coalesce(fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("node", F.when(fine, F.xxhash64("label", "v")))
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("weight"), F.first("v").alias("v"), F.first("label").cast("string").alias("label"))
    return rows.select("vec_id", "node"), nodes.withColumn("dim", F.size("v"))


def make_centres(nodes: DataFrame, shard: int, max_centres: int, sample: int) -> Centres:
    """Centres of every group, fitted on at most ``sample`` nodes chosen by hash and at least one of each group."""
    groups = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min("node").alias("one")).orderBy("label", "dim")
    sizes = groups.limit(max_centres).collect()
    total = sum(r["n"] for r in sizes)
    share = min(1.0, sample / max(total, 1) / 2)
    picked = nodes.filter((F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)))
    found: dict[tuple, list] = {(r["label"], r["dim"]): [] for r in sizes}
    for r in picked.select("label", "dim", "v").limit(sample).toLocalIterator():
        if (r["label"], r["dim"]) in found:
            found[r["label"], r["dim"]].append(r["v"])
    scale = max(1.0, total / shard / max(max_centres - len(sizes), 1))
    centres = {}
    for r in sizes:
        rows = found[r["label"], r["dim"]]
        if rows:
            centres[r["label"], r["dim"]] = fit_centres(unit(np.array(rows)), max(1, round(r["n"] / shard / scale)))
    return Centres(centres)


def reachable(alike: np.ndarray, near: np.ndarray, centres: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the nearest centres can be the nearest one of a vector in range.

    A vector nearer to centre c than to c' lies on c's side of the plane between them. So a query that is further than
    the range from that plane, on the other side, has nothing in range there. Loses nothing but rounding.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    gap = alike[:, :1] - alike
    apart = np.sqrt(np.maximum(0, ((centres[near] - centres[near[:, :1]]) ** 2).sum(2)))
    return gap <= reach * apart + 1e-9


def _assigned(nodes: DataFrame, centres: Centres, overlap: int, probes: int, threshold: float) -> DataFrame:
    """``shard``, ``node``, its rank (0: nearest) among the shards it belongs to or searches, and whether it searches it."""
    sent = nodes.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist()))
            for key in sorted(set(keys), key=str):
                every = np.array([i for i, k in enumerate(keys) if k == key])
                height = max(1, CELLS // len(of.of[key])) if key in of.of else len(every)
                yield from (placed(of, key, batch.take(pa.array(every[i:i + height]))) for i in range(0, len(every), height))

    def placed(of: Centres, key: tuple, part: pa.RecordBatch) -> pa.RecordBatch:
        at = np.arange(part.num_rows)
        if key in of.of:
            alike = unit(_matrix(part.column("v"))) @ of.of[key].T
            ranks = min(max(overlap, probes), alike.shape[1])
            near = np.argsort(-alike, axis=1, kind="stable")[:, :ranks]
            asks = reachable(np.take_along_axis(alike, near, 1), near, of.of[key], threshold)
            asks &= np.arange(ranks) < probes
            near = near + of.base[key]
        else:  # a group without centres is a shard of its own
            ranks = 1
            near = np.full((len(at), 1), -1 - (hash_text(key) % (1 << 40)))
            asks = np.ones((len(at), 1), dtype=bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(near.ravel()), part.column("node").take(pa.array(np.repeat(np.arange(len(at)), ranks))),
             pa.array(np.tile(np.arange(ranks), len(at))), pa.array(asks.ravel())], ["shard", "node", "rank", "asks"])

    return nodes.select("label", "dim", "v", "node").mapInArrow(run, "shard long, node long, rank long, asks boolean")


def hash_text(key: tuple) -> int:
    import zlib

    return zlib.crc32(str(key).encode()) | (zlib.adler32(str(key).encode()) << 32)


def _by_group(keys: list[str], solve):
    """Task over rows sorted by ``keys``: ``solve`` gets the rows of one group as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, last = [], None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            cut = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                cut[1:] |= c[1:] != c[:-1]
            edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                key = tuple(c[a] for c in columns)
                if key != last and waiting:
                    yield from solve(pa.Table.from_batches(waiting).combine_chunks())
                    waiting = []
                last = key
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield from solve(pa.Table.from_batches(waiting).combine_chunks())

    return run


def _column(table: pa.Table, name: str):
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _build(table: pa.Table) -> Iterator[pa.RecordBatch]:
    node = table.column("node").to_numpy()
    flat, edges = _flat([node[x] for x in build_graph(unit(_matrix(_column(table, "v"))))])
    yield pa.RecordBatch.from_arrays(
        [pa.array(node), pa.ListArray.from_arrays(pa.array(edges, type=pa.int32()), pa.array(flat))], ["node", "near"])


def _search(threshold: float):
    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        member, primary, asks = (table.column(c).to_numpy() for c in ("member", "primary", "asks"))
        vectors = unit(_matrix(_column(table, "v")))
        inside = np.flatnonzero(member)
        place = np.full(len(node), -1)
        place[inside] = np.arange(len(inside))
        order = np.argsort(node[inside])
        ids = node[inside][order]
        near = _column(table, "near")
        offsets, values = near.offsets.to_numpy(), near.values.to_numpy(zero_copy_only=False)
        graph = []
        for i in inside.tolist():
            own = values[offsets[i]:offsets[i + 1]]
            at = np.minimum(np.searchsorted(ids, own), max(len(ids) - 1, 0))
            graph.append(order[at[ids[at] == own]])
        root = list(range(len(node)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = np.zeros(len(node), dtype=np.int64)
        queries = np.flatnonzero(asks)
        for at in range(0, len(queries) if len(inside) else 0, LANES):
            some = queries[at:at + LANES]
            row, point = range_search(vectors[inside], graph, vectors[some], place[some], threshold)
            a, b = some[row], inside[point]
            other = (a != b) & primary[b]
            np.add.at(links, a[other], weight[b[other]])
            for i, j in np.unique(np.stack([a[a != b], b[a != b]], 1), axis=0).tolist():
                p, q = find(i), find(j)
                if p != q:
                    root[max(p, q)] = min(p, q)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(links), pa.array(node[[find(i) for i in range(len(node))]])], ["node", "links", "root"])

    return solve


def _audit(nodes: DataFrame, found: DataFrame, threshold: float, audit: int) -> tuple[int, int]:
    """Links of ``audit`` nodes, chosen by hash, as found and as compared with all nodes."""
    total = max(nodes.count(), 1)
    share = int(1_000_000 * min(1.0, audit / total / 2)) + 1
    picked = nodes.filter(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1_000_000)) < share).limit(audit)
    asked: dict[tuple, list] = {}
    for r in picked.select("label", "dim", "node", "v").collect():
        asked.setdefault((r["label"], r["dim"]), []).append((r["node"], r["v"]))
    sent = nodes.sparkSession.sparkContext.broadcast(
        {k: (np.array([n for n, _ in x]), unit(np.array([v for _, v in x]))) for k, x in asked.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist()))
            node, weight = batch.column("node").to_numpy(), batch.column("weight").to_numpy()
            for key in sorted(set(keys) & set(sent.value), key=str):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                names, queries = sent.value[key]
                close = queries @ unit(_matrix(batch.take(pa.array(at)).column("v"))).T >= threshold
                close &= names[:, None] != node[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array((close * weight[at]).sum(1))], ["node", "exact"])

    exact = nodes.select("label", "dim", "node", "weight", "v").mapInArrow(run, "node long, exact long")
    both = exact.groupBy("node").agg(F.sum("exact").alias("exact")).join(
        found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    row = both.agg(F.sum(F.coalesce("links", F.lit(0))), F.sum("exact")).first()
    return int(row[0] or 0), int(row[1] or 0)


def search_graph(
    nodes: DataFrame, centres: Centres, threshold: float, overlap: int, probes: int, max_shard: int,
) -> DataFrame:
    """``node``, ``links`` and ``root`` of every node in every shard it searched."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    near = write_once(_assigned(nodes, centres, overlap, probes, threshold))
    sizes = near.filter(F.col("rank") < overlap).groupBy("shard").agg(
        F.ceil(F.count("*") / max_shard).cast("int").alias("cuts"))
    dealt = near.join(sizes, "shard")
    mine = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    members = dealt.filter(F.col("rank") < overlap).select("shard", mine.alias("cut"), "node")
    with_vectors = members.join(nodes.select("node", "v"), "node").repartition(parts, "shard", "cut")
    lists = with_vectors.sortWithinPartitions("shard", "cut", "node").mapInArrow(
        _by_group(["shard", "cut"], _build), "node long, near array<long>")
    united = write_once(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    every = dealt.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    every = every.withColumn("member", (F.col("rank") < overlap) & (mine == F.col("cut")))
    every = every.filter("member OR asks")
    every = every.withColumn("primary", F.col("member") & (F.col("rank") == 0))
    rows = every.select("shard", "cut", "node", "member", "asks", "primary").join(nodes.select("node", "v", "weight"), "node")
    rows = rows.join(united, "node").repartition(parts, "shard", "cut").sortWithinPartitions("shard", "cut", "node")
    return write_once(rows.mapInArrow(
        _by_group(["shard", "cut"], _search(threshold)), "node long, links long, root long"))


def link_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD,
    overlap: int = OVERLAP, probes: int = PROBES, shard: int = SHARD, max_shard: int = MAX_SHARD,
    max_centres: int = MAX_CENTRES, sample: int = SAMPLE, audit: int = AUDIT, least_recall: float = LEAST_RECALL,
) -> DataFrame:
    """One row per row of ``df``: vec_id, ``n_links``, ``component_id`` (least vec_id reachable), ``kept``, ``recall``.

    The search widens until the audited recall reaches ``least_recall``, and fails if it does not with all shards searched.
    """
    rows, nodes = make_nodes(df, vec_id, vector, label)
    nodes = write_once(nodes)
    centres = make_centres(nodes, shard, max_centres, sample)
    while True:
        found = search_graph(nodes, centres, threshold, overlap, probes, max_shard)
        have, exact = _audit(nodes, found, threshold, audit)
        recall = have / exact if exact else 1.0
        if recall >= least_recall:
            break
        if probes >= max([len(c) for c in centres.of.values()], default=1):
            raise RuntimeError(f"all shards were searched, and of {exact} links of the audit only {have} were found")
        probes *= 2
    classes = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rows = rows.join(classes, "node", "left").join(links, "node", "left").join(nodes.select("node", "weight"), "node", "left")
    rows = write_once(rows.select("vec_id", "component", (
        F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links")))
    least = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    # rows that share an id are one vertex: the components of their vectors are joined
    shared = rows.filter("component IS NOT NULL").groupBy("vec_id").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    if shared.limit(1).count():
        joined = connected_components(rows.join(shared.select("vec_id", "a"), "vec_id").filter(
            "component IS NOT NULL").select("a", F.col("component").alias("b"))).withColumnRenamed("component", "to")
        least = least.join(joined.withColumnRenamed("node", "component"), "component", "left").withColumn(
            "to", F.coalesce("to", "component"))
        least = least.select("component", "to").join(
            least.groupBy("to").agg(F.min("component_id").alias("component_id")), "to").drop("to")
    out = rows.join(least, "component", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(recall).alias("recall"))
