"""Exact top-k of an index for many queries at once, without joining every query to every row.

Each task scores its index rows against a block of queries as a matrix and keeps the best k per query, so pairs never
become Spark rows: a task emits at most k rows per query. Few queries are broadcast: the index is scanned in place, once, and
never shuffled or copied; only hits move. More queries than ``BROADCAST_BYTES`` by measured size, or than a caller's block, do
not pass through the driver: index and queries are dealt to the cells of a grid, and a task holds one part of each, of about
``PART_BYTES`` at most. With a match column a query only meets index rows that carry its value, however many rows share it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.session import is_small, write_once

# Measured size of a block of queries or index rows that one task holds.
BLOCK_BYTES = 64 << 20

# Measured size of the queries that are broadcast at most.
BROADCAST_BYTES = 8 << 20

# Measured size of a part of the index or of the queries in a cell of the grid, at most and at least.
PART_BYTES = 24 << 20
LEAST_PART_BYTES = 256 << 10

# Cells of the grid per core, so that those of a hash meet in tasks of similar length.
CELLS_PER_CORE = 6

# Tasks of the grid, at most.
MOST_TASKS = 10_000

# Bytes of the features of index rows that are prepared at once.
SLICE_BYTES = 4 << 20

# Cells of a score matrix computed at once: few enough for the cache of a core.
MATRIX_CELLS = 1 << 20

# Rows that a block of queries meets first.
FIRST_ROWS = 128

# Queries whose scores are computed at once in a cell of the grid.
QUERY_ROWS = 1024


def hits_schema(index: DataFrame) -> str:
    return f"query_id bigint, id {index.schema['id'].dataType.simpleString()}, score double"


def _ids(column: pa.Array) -> np.ndarray:
    """Keys of a batch: numbers, or the bytes of texts, which sort as the texts do."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.array([v.encode() for v in column.to_pylist()], dtype=np.bytes_)
    return column.to_numpy()


def _id_type(text: bool) -> pa.DataType:
    return pa.string() if text else pa.int64()


class Scorer(Protocol):
    """Scores index rows against a fixed block of queries."""

    # Scores are rounded to this many digits before ranking, so that ties do not depend on summation order.
    digits: int

    def queries(self, features: pa.Array) -> Any:
        """Prepare the query features."""

    def rows(self, features: pa.Array) -> Any:
        """Prepare the features of one batch of index rows."""

    def usable(self, prepared: Any) -> np.ndarray:
        """Which of the prepared queries or rows can be part of a hit."""

    def scores(self, rows: Any, row_at: np.ndarray, queries: Any, query_at: np.ndarray) -> np.ndarray:
        """Unrounded score matrix of the given rows and queries. A pair that must not be a hit gets -inf.

        A scorer may also have ``rough``, which returns a cheaper matrix and a bound of its error, and ``pairs``, which
        returns the scores of single pairs of rows and queries: only pairs that may be hits are then scored exactly.
        """


class BestHits:
    """The k best hits per query so far: higher rounded score first, then lower id."""

    def __init__(self, n_queries: int, k: int, digits: int = 0) -> None:
        self.k, self.digits = k, digits
        self.slack = 10.0 ** -digits
        self.score = np.full((n_queries, k), -np.inf)
        self.id = np.zeros((n_queries, k), dtype=np.int64)  # of no meaning where the score is -inf

    def offer(
        self, ids: np.ndarray, scores: np.ndarray, query_at: np.ndarray, error: float = 0.0,
        exact: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    ) -> None:
        """Merge a score matrix of shape (rows, queries).

        Only pairs that may reach the k best are rounded and sorted. The slack keeps those whose rounded score
        could tie. The partition per query is needed while the known hits are few, then hardly ever. Scores that
        are right up to ``error`` are replaced by those of ``exact`` for the pairs that are kept.
        """
        slack = self.slack + 2 * error
        least = np.maximum(self.score[query_at, -1] - slack, np.finfo(scores.dtype).min).astype(scores.dtype)
        keep = scores >= least
        if len(ids) > self.k and np.count_nonzero(keep) > 8 * self.k * len(query_at):
            kth = np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k]
            keep &= scores >= kth - scores.dtype.type(slack)
        flat = np.flatnonzero(keep)
        if not len(flat):
            return
        row, col = np.divmod(flat, scores.shape[1])
        found = exact(row, col) if exact else scores[row, col]
        if ids.dtype.kind == "S" and (self.id.dtype.kind != "S" or self.id.dtype.itemsize < ids.dtype.itemsize):
            self.id = self.id.astype(ids.dtype)
        touched, slot = np.unique(col, return_inverse=True)
        held = query_at[touched]
        slots = np.concatenate([np.repeat(np.arange(len(held)), self.k), slot])
        new_score = np.concatenate([self.score[held].ravel(), np.round(found, self.digits)])
        new_id = np.concatenate([self.id[held].ravel(), ids[row]])
        order = np.lexsort((new_id, -new_score, slots))
        first = np.searchsorted(slots[order], np.arange(len(held)))
        picked = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.score[held] = new_score[picked].reshape(-1, self.k)
        self.id[held] = new_id[picked].reshape(-1, self.k)

    def table(self, query_ids: np.ndarray, text: bool = False) -> pa.Table:
        row, col = np.nonzero(self.score > -np.inf)
        found = self.id[row, col]
        if text:
            ids = pa.array([v.decode() for v in found.tolist()] if len(found) else [], type=pa.string())
        else:
            ids = pa.array(found)
        return pa.table([pa.array(query_ids[row]), ids, pa.array(self.score[row, col])], names=["query_id", "id", "score"])


class _Block:
    """A prepared block of queries together with their best hits."""

    def __init__(self, table: pa.Table, scorer: Scorer, k: int) -> None:
        table = table.filter(pc.is_valid(table.column("feature"))).combine_chunks()
        self.ids = table.column("query_id").to_numpy()
        self.scorer = scorer
        self.features = scorer.queries(_one(table.column("feature")))
        self.best = BestHits(len(self.ids), k, scorer.digits)
        self.usable = np.nonzero(scorer.usable(self.features))[0]
        self.by_match: dict[Any, np.ndarray] | None = None
        if "match" in table.column_names:
            positions = _positions(_one(table.column("match")), self.usable)
            self.by_match = {value: at for value, at in positions.items() if len(at)}

    def add(self, batch: pa.RecordBatch) -> None:
        """Score a batch of index rows, a bounded number of bytes at a time."""
        height = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.column("feature").get_total_buffer_size()))
        for start in range(0, batch.num_rows, height):
            self._add(batch.slice(start, height))

    def _add(self, batch: pa.RecordBatch) -> None:
        """Rows without feature are left out here: a filter on a computed feature would be pushed down and compute it twice."""
        batch = batch.filter(pc.is_valid(batch.column("feature")))
        ids = _ids(batch.column("id"))
        rows = self.scorer.rows(batch.column("feature"))
        usable = np.nonzero(self.scorer.usable(rows))[0]
        if self.by_match is None:
            self.score(ids, rows, usable, self.usable)
            return
        for value, row_at in _positions(batch.column("match"), usable).items():
            query_at = self.by_match.get(value)
            if query_at is not None:
                self.score(ids, rows, row_at, query_at)

    def score(self, ids: np.ndarray, rows: Any, row_at: np.ndarray, query_at: np.ndarray) -> None:
        most = max(1, MATRIX_CELLS // max(1, len(query_at)))
        rough = getattr(self.scorer, "rough", None)
        start = 0
        while start < len(row_at):
            # few rows first: what they score leaves few of the pairs of the next, three times as many, to be sorted
            height = most if rough is None else min(most, max(FIRST_ROWS, 3 * start))
            at = row_at[start:start + height]
            start += height
            if rough is None:
                self.best.offer(ids[at], self.scorer.scores(rows, at, self.features, query_at), query_at)
                continue
            scores, error = rough(rows, at, self.features, query_at)
            self.best.offer(ids[at], scores, query_at, error, lambda row, col, at=at: self.scorer.pairs(
                rows, at[row], self.features, query_at[col]))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _positions(values: pa.Array, at: np.ndarray) -> dict[Any, np.ndarray]:
    """The given row numbers per distinct non-null value, in ascending order."""
    encoded = _one(pc.dictionary_encode(values))
    codes = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False)[at]
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(encoded.dictionary) + 1))
    return {
        value: at[order[bounds[i]:bounds[i + 1]]] for i, value in enumerate(encoded.dictionary.to_pylist())
    }


def _scan(index: DataFrame, queries: DataFrame, k: int, scorer: Scorer) -> DataFrame:
    """Score the whole index in place against one broadcast block of queries."""
    block = index.sparkSession.sparkContext.broadcast(queries.toArrow())
    text = index.schema["id"].dataType.simpleString() == "string"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Block(block.value, scorer, k)
        for batch in batches:
            state.add(batch)
        yield from state.best.table(state.ids, text).to_batches()

    return index.mapInArrow(score, hits_schema(index))


def _in_cells(
    index: DataFrame, queries: DataFrame, k: int, scorer: Scorer, size: Column, block_bytes: int, part_bytes: int
) -> DataFrame:
    """Score the index against the queries in cells of one part of each, which a shuffle brings together.

    Every match value has as many parts of its index rows and of its queries as their bytes ask for, so a frequent value is many
    cells and no task holds more than two parts; rare values share cells. A row is sent to as many cells as the other side has
    parts. Each query of a cell keeps its k best rows there. Nothing passes through the driver but three sums.
    """
    spark = index.sparkSession
    if "match" not in queries.columns:
        index, queries = index.withColumn("match", F.lit(0)), queries.withColumn("match", F.lit(0))
    elif index.schema["match"].dataType != queries.schema["match"].dataType:
        kind = index.select("match").union(queries.select("match")).schema["match"].dataType
        index, queries = (df.withColumn("match", F.col("match").cast(kind)) for df in (index, queries))
    queries = write_once(queries)

    def sizes(rows: DataFrame, name: str) -> DataFrame:
        feature = F.coalesce(size, F.lit(0)) + F.lit(16)
        return rows.groupBy("match").agg(F.sum(feature.cast("double")).alias(name))

    both = write_once(sizes(index, "rows").join(sizes(queries, "asked"), "match"))
    pairs = both.agg(F.sum(F.col("rows") * F.col("asked"))).first()[0] or 0.0
    tasks = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    part = min(part_bytes, max(min(LEAST_PART_BYTES, part_bytes), int((pairs / tasks) ** 0.5)))
    parts = both.withColumns({f"{c}_parts": F.ceil(F.col(c) / part).cast("int") for c in ("rows", "asked")})
    rare = (F.col("rows_parts") == 1) & (F.col("asked_parts") == 1)
    found = parts.agg(
        F.sum(F.when(~rare, F.col("rows_parts").cast("long") * F.col("asked_parts"))).alias("cells"),
        F.sum(F.when(rare, F.greatest("rows", "asked"))).alias("bytes")).first()
    shared = max(1, int((found["bytes"] or 0) // part))
    cells = min(MOST_TASKS, (found["cells"] or 0) + shared)
    hashed = F.xxhash64("match")
    parts = parts.select(
        "match", "rows_parts", "asked_parts", F.when(rare, F.pmod(hashed, F.lit(shared))).otherwise(hashed).alias("group"))
    parts = F.broadcast(parts) if is_small(parts) else parts
    at = ["group", "row_part", "asked_part"]

    def dealt(rows: DataFrame, key: str, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        known = rows.join(parts, "match").withColumn(own, F.pmod(F.xxhash64(key), F.col(own_parts)).cast("int"))
        sent = known.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)))
        # both sides have columns of the same parts: new names for the cogroup
        return sent.select(*[F.col(c).alias(c) for c in at], key, "feature", "match").repartition(cells, *at)

    left = dealt(index, "id", "row_part", "rows_parts", "asked_part", "asked_parts")
    right = dealt(queries, "query_id", "asked_part", "asked_parts", "row_part", "rows_parts")
    text = index.schema["id"].dataType.simpleString() == "string"
    kinds = pa.schema([("query_id", pa.int64()), ("id", _id_type(text)), ("score", pa.float64())])

    def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = rows.filter(pc.is_valid(rows.column("feature")))
        out = [kinds.empty_table()]
        if not rows.num_rows or not asked.num_rows:
            return out[0]
        ids, prepared = _ids(_one(rows.column("id"))), scorer.rows(_one(rows.column("feature")))
        row_at = _positions(_one(rows.column("match")), np.nonzero(scorer.usable(prepared))[0])
        height = min(QUERY_ROWS, max(1, asked.num_rows * block_bytes // max(1, asked.nbytes)))
        for start in range(0, asked.num_rows, height):
            block = _Block(asked.slice(start, height), scorer, k)
            for value, query_at in block.by_match.items():
                block.score(ids, prepared, row_at.get(value, ()), query_at)
            out.append(block.best.table(block.ids, text).cast(kinds))
        return pa.concat_tables(out)

    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(score, hits_schema(index))


def best_matches(
    index: DataFrame, queries: DataFrame, k: int, scorer: Scorer, size: Column, block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
) -> tuple[DataFrame, int]:
    """The k best index rows per query, ``query_id, rank, id, score``, ties by lower id; and an upper bound of hits.

    ``index`` has ``id, feature`` and ``queries`` has ``query_id, feature``, both perhaps with ``match``; a
    query's key is BIGINT, an index row's BIGINT or STRING. A query may come with several match values, one row each. ``size`` gives
    the bytes of a feature, and a task scores at most ``block_bytes`` of queries at once. Rows with a NULL feature have no hits and are none.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    hit_bytes, features = 16 * k, size
    if "match" in queries.columns:
        size = size + F.octet_length(F.col("match").cast("string"))
    measured = queries.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.coalesce(size, F.lit(0)) + F.lit(hit_bytes)), F.lit(0)).alias("bytes")
    ).first()
    if measured["bytes"] <= min(block_bytes, BROADCAST_BYTES):
        found = _scan(index, queries, k, scorer)
    else:
        found = _in_cells(index, queries, k, scorer, features, block_bytes, part_bytes)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score"), measured["rows"] * k
