"""Similarity search over a vector table, exact or through inverted lists, and keyword search."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.functions.text import clean_text
from passagework.functions.vectors import norm
from passagework.operators.ranking import BLOCK_BYTES, MATRIX_CELLS, best_matches
from passagework.session import SMALL_TABLE_ROWS, scratch_dir, write_once

# Digits of a cosine that count for the ranking.
SCORE_DIGITS = 6


class CosineScorer:
    """Cosine of vectors in DOUBLE. Vectors of length zero match nothing."""

    digits = SCORE_DIGITS

    def unit(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of length one, and which of them had a length."""
        lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        usable = lengths > 0
        return vectors / np.where(usable, lengths, 1.0)[:, None], usable

    def rows(self, features: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(features):
            return np.empty((0, 0)), np.empty(0, dtype=bool)
        lengths = pc.unique(pc.list_value_length(features)).to_pylist()
        if len(lengths) != 1:
            raise ValueError(f"vectors of different lengths: {sorted(lengths)[:5]}")
        flat = features.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return self.unit(flat.reshape(len(features), lengths[0]))

    queries = rows

    def usable(self, prepared: Any) -> np.ndarray:
        return prepared[1]

    def scores(self, rows: Any, row_at: np.ndarray, queries: Any, query_at: np.ndarray) -> np.ndarray:
        x, q = rows[0], queries[0]
        if not len(row_at) or not len(query_at):
            return np.empty((len(row_at), len(query_at)))
        if x.shape[1] != q.shape[1]:
            raise ValueError(f"index vectors have {x.shape[1]} dimensions, query vectors {q.shape[1]}")
        return x[row_at] @ q[query_at].T

    def rough(self, rows: Any, row_at: np.ndarray, queries: Any, query_at: np.ndarray) -> tuple[np.ndarray, float]:
        """Scores in single precision, and how far they may be off: vectors have length one, so n products add up to
        n + 2 roundings at most. Twice that is allowed."""
        x, q = rows[0][row_at].astype(np.float32), queries[0][query_at].astype(np.float32)
        if len(x) and len(q) and x.shape[1] != q.shape[1]:
            raise ValueError(f"index vectors have {x.shape[1]} dimensions, query vectors {q.shape[1]}")
        scores = x @ q.T if len(x) and len(q) else np.empty((len(x), len(q)), dtype=np.float32)
        return scores, (x.shape[1] + 4) * 2.0 ** -23

    def pairs(self, rows: Any, row: np.ndarray, queries: Any, query: np.ndarray) -> np.ndarray:
        """Scores of pairs in double precision, a bounded number at a time."""
        step = max(1, MATRIX_CELLS // max(1, rows[0].shape[1]))
        return np.concatenate([np.zeros(0), *[
            np.einsum("ij,ij->i", rows[0][row[at:at + step]], queries[0][query[at:at + step]])
            for at in range(0, len(row), step)]])


class SharedTokenScorer:
    """Number of distinct tokens that two texts share. Features are cleaned lower-case texts."""

    digits = 0

    def _tokens(self, features: pa.Array) -> tuple[pa.Array, np.ndarray]:
        # large lists: the tokens of one batch may exceed 32-bit offsets
        lists = pc.split_pattern(features.cast(pa.large_string()), " ")
        return lists.flatten(), np.repeat(np.arange(len(features)), pc.list_value_length(lists).to_numpy())

    def queries(self, features: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
        """Vocabulary of the block, and per token the queries that have it."""
        tokens, owner = self._tokens(features)
        filled = pc.not_equal(tokens, "")
        tokens, owner = tokens.filter(filled), owner[filled.to_numpy(zero_copy_only=False)]
        vocabulary = pc.unique(tokens)
        codes = pc.index_in(tokens, value_set=vocabulary).to_numpy()
        pairs = np.unique(codes.astype(np.int64) * len(features) + owner)
        codes, owner = np.divmod(pairs, max(1, len(features)))
        return vocabulary, np.searchsorted(codes, np.arange(len(vocabulary) + 1)), owner, len(features)

    def rows(self, features: pa.Array) -> tuple[pa.Array, np.ndarray, int]:
        return *self._tokens(features), len(features)

    def usable(self, prepared: Any) -> np.ndarray:
        return np.ones(prepared[-1], dtype=bool)

    def scores(self, rows: Any, row_at: np.ndarray, queries: Any, query_at: np.ndarray) -> np.ndarray:
        (tokens, doc, _), (vocabulary, first, owner, width) = rows, queries
        low, high = np.searchsorted(doc, [row_at[0], row_at[-1] + 1])
        found = pc.index_in(tokens.slice(low, high - low), value_set=vocabulary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        codes, lines = found.drop_null().to_numpy().astype(np.int64), np.searchsorted(row_at, doc[low:high][known])
        pairs = np.unique(lines * len(vocabulary) + codes)
        lines, codes = np.divmod(pairs, max(1, len(vocabulary)))

        # every token of a row counts once for each query that has it, a bounded number of counts at a time
        counts = first[codes + 1] - first[codes]
        ends = np.cumsum(counts)
        shared = np.zeros(len(row_at) * width)
        start = 0
        while start < len(codes):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + MATRIX_CELLS, side="right")))
            n = counts[start:stop]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cells = np.repeat(lines[start:stop] * width, n) + owner[np.repeat(first[codes[start:stop]], n) + within]
            shared += np.bincount(cells, minlength=len(shared))
            start = stop
        shared = shared.reshape(len(row_at), width)[:, query_at]
        return np.where(shared > 0, shared, -np.inf)


def _key(df: DataFrame, name: str) -> Column:
    """A key as it is if it is text, else as BIGINT."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name).cast("bigint")


def _side(df: DataFrame, key: str, name: str, feature: Column, match_col: str | None) -> DataFrame:
    columns = [_key(df, key).alias(name), feature.alias("feature")]
    if match_col:
        columns.append(F.col(match_col).alias("match"))
    out = df.select(*columns)
    return out.filter(F.col("match").isNotNull()) if match_col else out


def _with_columns(
    found: tuple[DataFrame, int], index: DataFrame, id_col: str, columns: list[str]
) -> DataFrame:
    """Fetch the wanted columns of the hits only: the scoring scan reads no more than key, feature and match.

    Few hits, rows of four numbers, are broadcast against the index, which is not shuffled. Many are written and joined
    by key; Spark splits a key that many queries hit.
    """
    hits, at_most = found
    extra = [c for c in columns if c not in (id_col, "id")]
    if not extra:
        return hits
    details = index.select(_key(index, id_col).alias("id"), *extra)
    if at_most <= SMALL_TABLE_ROWS:
        joined = details.join(F.broadcast(hits), "id")
    else:
        joined = write_once(hits).join(details, "id")
    return joined.select("query_id", "rank", "id", *extra, "score")


def similarity_search(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    columns: list[str] | None = None,
    where: Column | str | None = None,
    match: tuple[str, str] | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    query_id_col: str = "query_id",
    query_vector_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k nearest index rows per query by cosine: ``query_id, rank, id, <columns>, score``.

    ``where`` restricts the index before scoring, and reaches the scan. ``match`` names an index and a query column
    that must be equal, for queries that carry their own permissions; a query with several allowed values has one
    row for each.
    """
    kept = index if where is None else index.filter(where)
    rows = _side(kept, id_col, "id", F.col(vector_col), match[0] if match else None)
    asked = _side(queries, query_id_col, "query_id", F.col(query_vector_col), match[1] if match else None)
    size = F.size("feature") * F.lit(8)
    found = best_matches(rows, asked, k, CosineScorer(), size, block_bytes)
    return _with_columns(found, kept, id_col, columns or [])


def keyword_search(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    columns: list[str] | None = None,
    id_col: str = "id",
    text_col: str = "content",
    query_id_col: str = "query_id",
    query_text_col: str = "query_text",
    block_bytes: int = BLOCK_BYTES // 8,
) -> DataFrame:
    """The k index rows that share most distinct tokens with each query; rows that share none are no hits.

    Whole texts are compared. A join on the token would pair every query with every row over each common word;
    here the tokens of a block are matched as matrices.
    """
    def tokens(name: str) -> Column:
        return F.lower(clean_text(F.col(name)))

    rows = _side(index, id_col, "id", tokens(text_col), None)
    asked = _side(queries, query_id_col, "query_id", tokens(query_text_col), None)
    found = best_matches(rows, asked, k, SharedTokenScorer(), F.octet_length("feature"), block_bytes)
    return _with_columns(found, index, id_col, columns or [])


def train_lists(
    index: DataFrame, n_lists: int, vector_col: str = "embedding", seed: int = 7, max_iter: int = 20,
) -> np.ndarray:
    """Centres of inverted lists, one row each: k-means by cosine over all non-zero vectors."""
    usable = index.filter(norm(F.col(vector_col)) > 0)
    means = KMeans(k=n_lists, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="_vector")
    return np.array(means.fit(usable.select(array_to_vector(F.col(vector_col)).alias("_vector"))).clusterCenters())


def refine_centres(index: DataFrame, centres: np.ndarray, rounds: int = 1, vector_col: str = "embedding") -> np.ndarray:
    """Centres after ``rounds`` steps of k-means by cosine from the given ones: the mean of the unit vectors of each list.

    Tasks add up their vectors per list; sums meet per list and dimension, so the driver gets one number for each cell of
    the centres, whatever the size of the index. A list without vectors keeps its centre.
    """
    centres = np.asarray(centres, dtype=np.float64)
    vectors = index.select(F.col(vector_col).cast("array<double>").alias("v")).filter(norm(F.col("v")) > 0)
    for _ in range(rounds):
        sent = index.sparkSession.sparkContext.broadcast(centres)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer, table = CosineScorer(), sent.value
            lists = scorer.unit(table)
            total, count = np.zeros_like(table), np.zeros(len(table))
            height = max(1, MATRIX_CELLS // max(1, len(table)))
            for whole in batches:
                for start in range(0, whole.num_rows, height):
                    rows = scorer.rows(whole.slice(start, height).column("v"))
                    scores = np.round(scorer.scores(rows, np.arange(len(rows[0])), lists, np.arange(len(table))), scorer.digits)
                    best = scores.argmax(axis=1)
                    np.add.at(total, best, rows[0])
                    np.add.at(count, best, 1)
            at, dim = np.nonzero(np.broadcast_to(count[:, None] > 0, table.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(dim), pa.array(total[at, dim]), pa.array(count[at])], ["list", "dim", "x", "n"])

        sums = vectors.mapInArrow(add, "list long, dim long, x double, n double")
        found = sums.groupBy("list", "dim").agg((F.sum("x") / F.sum("n")).alias("x")).toArrow()
        centres = centres.copy()
        centres[found.column("list").to_numpy(), found.column("dim").to_numpy()] = found.column("x").to_numpy()
    return centres


class CentreTree:
    """Centres of lists below some top centres: a vector meets the tops, then only the centres below its nearest tops.

    With n centres and their square root as tops that are two short scans instead of n scores. ``beam`` tops are followed;
    with all of them the nearest centres are exact.
    """

    def __init__(self, centres: np.ndarray, n_tops: int | None = None, beam: int = 8, rounds: int = 0):
        self.centres = np.asarray(centres, dtype=np.float64)
        scorer, n = CosineScorer(), len(self.centres)
        n_tops = min(n, n_tops or max(1, int(np.sqrt(n))))
        unit = scorer.unit(self.centres)[0]
        self.tops = self.centres[np.arange(n_tops) * n // max(1, n_tops)]
        for number in range(rounds + 1):
            of = np.round(unit @ scorer.unit(self.tops)[0].T, scorer.digits).argmax(axis=1) if n else np.zeros(0, int)
            if number < rounds:
                self.tops = np.array([unit[of == t].mean(axis=0) if (of == t).any() else self.tops[t] for t in range(n_tops)])
        self.below = [np.flatnonzero(of == t) for t in range(n_tops)]
        self.beam = min(beam, n_tops)

    def nearest(self, rows: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each vector of length one below its nearest tops, -1 where there are fewer."""
        scorer = CosineScorer()
        leaves, tops = scorer.unit(self.centres)[0], scorer.unit(self.tops)[0]
        score = np.full((len(rows), n), -np.inf)
        best = np.full((len(rows), n), -1)
        nearest = np.argsort(-np.round(rows @ tops.T, scorer.digits), axis=1, kind="stable")[:, :self.beam]
        for top, below in enumerate(self.below):
            at = np.flatnonzero((nearest == top).any(axis=1))
            height = max(1, MATRIX_CELLS // max(1, len(below)))
            for start in range(0, len(at) if len(below) else 0, height):
                some = at[start:start + height]
                scores = np.round(rows[some] @ leaves[below].T, scorer.digits)
                every = np.concatenate([score[some], scores], axis=1)
                lists = np.concatenate([best[some], np.broadcast_to(below, scores.shape)], axis=1)
                order = np.lexsort((lists, -every), axis=1)[:, :n]
                score[some] = np.take_along_axis(every, order, axis=1)
                best[some] = np.take_along_axis(lists, order, axis=1)
        return np.where(score > -np.inf, best, -1)


def _nearest_lists(rows: DataFrame, vector_col: str, centres: np.ndarray | CentreTree, n: int) -> DataFrame:
    """The rows, each once for every one of its ``n`` nearest lists, ties by lower number. Zero vectors have none.

    The centres are an input of the caller and go to the rows: no shuffle. Scores are built in pieces of bounded size.
    """
    tree = isinstance(centres, CentreTree)
    parts = (centres.centres, centres.tops, centres.below, centres.beam) if tree else np.asarray(centres, dtype=np.float64)
    sent = rows.sparkSession.sparkContext.broadcast(parts)
    schema = T.StructType([*rows.schema.fields, T.StructField("list_id", T.IntegerType())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = CosineScorer()
        if tree:
            known = CentreTree.__new__(CentreTree)
            known.centres, known.tops, known.below, known.beam = sent.value
            width = len(known.tops)
        else:
            lists = scorer.unit(sent.value)
            width = len(sent.value)
        height = max(1, MATRIX_CELLS // max(1, width))
        for whole in batches:
            for start in range(0, whole.num_rows, height):
                batch = whole.slice(start, height)
                batch = batch.filter(pc.is_valid(batch.column(vector_col)))
                vectors = scorer.rows(batch.column(vector_col))
                at = np.nonzero(vectors[1])[0]
                if len(at):
                    if tree:
                        order = known.nearest(vectors[0][at], n)
                    else:
                        scores = np.round(scorer.scores(vectors, at, lists, np.arange(width)), scorer.digits)
                        order = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                    found = order.ravel() >= 0
                    out = batch.take(pa.array(np.repeat(at, order.shape[1])[found]))
                    yield out.append_column("list_id", pa.array(order.ravel()[found].astype(np.int32)))

    return rows.mapInArrow(nearest, schema)


def assign_lists(
    index: DataFrame, centres: np.ndarray | CentreTree, vector_col: str = "embedding", path: str | None = None
) -> DataFrame:
    """Write the index with a ``list_id``, one folder per list, so that a search reads only probed lists.

    Rebalancing gathers a list in few files and still splits a list that holds a large share of the rows.
    """
    table = _nearest_lists(index, vector_col, centres, 1).hint("rebalance", "list_id")
    path = path or f"{scratch_dir(index.sparkSession)}/lists"
    table.write.mode("overwrite").partitionBy("list_id").parquet(path)
    return index.sparkSession.read.schema(table.schema).parquet(path)


def probe_lists(
    queries: DataFrame, centres: np.ndarray | CentreTree, n_probe: int, query_id_col: str = "query_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``n_probe`` nearest lists of each query: ``query_id, embedding, list_id``."""
    asked = queries.select(
        F.col(query_id_col).cast("bigint").alias("query_id"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    return _nearest_lists(asked, "embedding", centres, n_probe)


def approximate_search(
    listed: DataFrame,
    centres: np.ndarray | CentreTree,
    queries: DataFrame,
    k: int,
    n_probe: int,
    columns: list[str] | None = None,
    id_col: str = "id",
    vector_col: str = "embedding",
    query_id_col: str = "query_id",
    query_vector_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Search the ``n_probe`` nearest lists of each query only; scores of the hits are exact.

    The numbers of the probed lists, at most as many as there are centres, are joined to the folder column, and Spark
    opens only the folders that they name.
    """
    probes = write_once(probe_lists(queries, centres, n_probe, query_id_col, query_vector_col))
    # the comparison, true of all, tells Spark that pruning the folders by the join is worth while
    wanted = F.broadcast(probes.select("list_id").filter("list_id >= 0").distinct())
    return similarity_search(
        listed.join(wanted, "list_id"), probes, k, columns, match=("list_id", "list_id"), id_col=id_col,
        vector_col=vector_col, block_bytes=block_bytes,
    )


def list_bounds(listed: DataFrame, centres: np.ndarray, vector_col: str = "embedding") -> np.ndarray:
    """The least cosine of the vectors of each list to its centre, 2 where a list is empty. One scan, one number per list."""
    sent = listed.sparkSession.sparkContext.broadcast(np.asarray(centres, dtype=np.float64))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = CosineScorer()
        lists = scorer.unit(sent.value)[0]
        for batch in batches:
            rows = scorer.rows(batch.column(vector_col))[0]
            of = batch.column("list_id").to_numpy()
            found = np.full(len(lists), 2.0)
            np.minimum.at(found, of, np.einsum("ij,ij->i", rows, lists[of]) if len(of) else np.zeros(0))
            at = np.flatnonzero(found < 2)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], ["list_id", "least"])

    least = listed.select("list_id", vector_col).mapInArrow(measure, "list_id int, least double")
    found = least.groupBy("list_id").agg(F.min("least").alias("least")).toArrow()
    out = np.full(len(centres), 2.0)
    out[found.column("list_id").to_numpy()] = found.column("least").to_numpy()
    return out


def _reachable_lists(asked: DataFrame, centres: np.ndarray, bounds: np.ndarray) -> DataFrame:
    """``query_id, embedding, list_id``: the lists that can hold a vector with a cosine of ``least`` or more to the query.

    A vector within an angle b of its centre has, to a query at an angle a from the centre, an angle of a - b at least.
    """
    sent = asked.sparkSession.sparkContext.broadcast((np.asarray(centres, dtype=np.float64), np.asarray(bounds)))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, (table, least) = CosineScorer(), sent.value
        lists = scorer.unit(table)[0]
        width = np.arccos(np.clip(least, -1, 1))
        height = max(1, MATRIX_CELLS // max(1, len(lists)))
        for whole in batches:
            for start in range(0, whole.num_rows, height):
                batch = whole.slice(start, height)
                rows, usable = scorer.rows(batch.column("embedding"))
                angle = np.arccos(np.clip(rows @ lists.T, -1, 1)) if len(rows) else np.zeros((0, len(lists)))
                best = np.cos(np.maximum(angle - width, 0))
                # scores are compared after rounding; a list is left out only if it stays clearly below
                wanted = batch.column("least").to_numpy()[:, None] - 2 * 10.0 ** -scorer.digits
                row, col = np.nonzero((best >= wanted) & (least < 2) & usable[:, None])
                out = batch.take(pa.array(row)).drop_columns(["least"])
                yield out.append_column("list_id", pa.array(col.astype(np.int32)))

    return asked.mapInArrow(reach, "query_id bigint, embedding array<double>, list_id int")


def clustered_search(
    listed: DataFrame, centres: np.ndarray, bounds: np.ndarray, queries: DataFrame, k: int,
    columns: list[str] | None = None, id_col: str = "id", vector_col: str = "embedding", query_id_col: str = "query_id",
    query_vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES, n_probe: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Exact search that opens only the lists that can hold hits; and the pairs ``query_id, list_id`` that it scores.

    ``listed`` is an index written by ``assign_lists`` and ``bounds`` its ``list_bounds``. The nearest lists of a query give a score
    that its k-th hit reaches at least; other lists are read only if their angle to the query allows that score. Results
    equal those of ``similarity_search``.
    """
    first = approximate_search(
        listed, centres, queries, k, n_probe, None, id_col, vector_col, query_id_col, query_vector_col, block_bytes)
    kth = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    asked = queries.select(
        F.col(query_id_col).cast("bigint").alias("query_id"), F.col(query_vector_col).cast("array<double>").alias("embedding"))
    asked = asked.filter("embedding IS NOT NULL").join(write_once(kth), "query_id", "left").withColumn(
        "least", F.coalesce("least", F.lit(-2.0)))
    pairs = write_once(_reachable_lists(asked.select("query_id", "embedding", "least"), centres, bounds))
    wanted = F.broadcast(pairs.select("list_id").filter("list_id >= 0").distinct())
    found = similarity_search(
        listed.join(wanted, "list_id"), pairs, k, columns, match=("list_id", "list_id"), id_col=id_col, vector_col=vector_col,
        block_bytes=block_bytes)
    return found, pairs.select("query_id", "list_id")


def share_scored(listed: DataFrame, probes: DataFrame) -> float:
    """Share of all query-vector pairs that a search of the probed lists scores."""
    sizes = listed.groupBy("list_id").agg(F.count("*").alias("n"))
    asked = probes.groupBy("list_id").agg(F.count("*").alias("asked"))
    counted = sizes.join(asked, "list_id", "left").agg(
        F.sum(F.col("n") * F.coalesce("asked", F.lit(0))).alias("scored"), F.sum("n").alias("rows")
    ).first()
    queries = probes.agg(F.count_distinct("query_id")).first()[0]
    return counted["scored"] / (counted["rows"] * queries)
