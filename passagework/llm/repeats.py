"""Repeated windows of units (bytes or words) in all texts: what the two substring operators share.

A window is ``length`` consecutive units of one text. Among the grams of ``gram`` units that lie in it, the one with
the least hash (the rightmost of equals) is its anchor. Equal windows have equal anchors at the same place, so:

1. anchors are counted over all texts, pre-aggregated per batch; those found once are done with;
2. for the rest, the stretch of units of all windows with that anchor goes to the anchor's group. If the repeated
   anchors are few enough to be broadcast (``max_broadcast``), that is a second pass over the texts; otherwise anchors
   are joined, and the texts with the anchors of each;
3. a task resolves a block of groups and marks the windows that start at two places or more. An anchor found more than
   ``max_members`` times is dealt to as many chunks as it needs; what each chunk has left over meets again by window
   hash, in buckets as many as chunks, so no task holds a whole hot group;
4. marked windows are gathered per text.

Each step covers all texts; a limit only changes how the work is spread. A text is known by ``doc_id`` and 128 bits of hash of
the whole text: rows that share both are copies, and what is found for one holds for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.words import Texts, mix, pieces, released
from passagework.session import write_once

MAX_BROADCAST = 2_000_000
MAX_MEMBERS = 8192
BLOCK_BYTES = 4 << 20

_C = np.uint64(0xD6E8FEB86659FD93)


class Stretches:
    """Segments of one block: the units of all windows of an anchor occurrence."""

    def __init__(self, f, s1, run, anchor, bodies):
        self.f, self.s1, self.run, self.anchor, self.bodies = f, s1, run, anchor, bodies


@dataclass
class Kind:
    """How texts become units, and how a block of stretches is resolved.

    ``units``: texts to (symbols, first unit of each text, function from unit ranges to bytes). ``resolve``: stretches to
    (marks, function to hashes): whether each window starts twice or more here, and two hashes of its units.
    """

    length: int
    gram: int
    units: Callable
    resolve: Callable[[Stretches], tuple[np.ndarray, Callable]]


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` symbols, from hashes of runs of 1, 2, 4, ... symbols."""
    n = max(0, len(symbols) - gram + 1)
    level, size, at, out = symbols, 1, 0, None
    while n:
        if gram & size:
            part = level[at:at + n]
            out = part.copy() if out is None else out * _C + part
            out ^= out >> np.uint64(29)
            at += size
        size *= 2
        if size > gram:
            return mix(out)
        level = level[:-(size // 2)] * _C + level[size // 2:]
        level ^= level >> np.uint64(32)
    return np.zeros(0, dtype=np.uint64)


def least_ahead(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` keys in a row."""
    size = 1
    n = max(0, len(keys) - width + 1)
    while size * 2 <= width and n:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:n], keys[width - size:width - size + n])


def anchors(symbols: np.ndarray, first: np.ndarray, kind: Kind) -> dict[str, np.ndarray]:
    """Runs of window starts with one anchor: text, first start (in the text), number, anchor's place after it, hash."""
    width = kind.length - kind.gram + 1
    grams = gram_hashes(symbols, kind.gram)
    bits = np.uint64(max(1, len(symbols).bit_length()))
    place = np.uint64((1 << int(bits)) - 1)
    keys = (grams >> bits << bits) | (place - np.arange(len(grams), dtype=np.uint64))
    best = (place - (least_ahead(keys, width) & place)).astype(np.int64)
    # the high bits mostly tell; where they tie, the whole hash decides, so equal windows agree whatever text they lie in
    for i in np.flatnonzero(grams[best] != least_ahead(grams, width)).tolist():
        own = grams[i:i + width]
        best[i] = i + int(np.flatnonzero(own == own.min())[-1])
    count = np.maximum(0, np.diff(first) - kind.length + 1)
    doc = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    at = best[start]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(new)
    row = doc[begins]
    return {
        "row": row, "s1": start[begins] - first[row], "run": np.diff(np.concatenate([begins, [len(doc)]])),
        "anchor": at[begins] - start[begins], "f": grams[at[begins]].view(np.int64),
    }


def _text_key(text: str) -> list[Column]:
    """Two numbers that stand for a text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole), F.xxhash64(F.lit(1), whole)]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    ta, tb = _text_key(text)
    return docs.select("doc_id", ta.alias("ta"), tb.alias("tb"), F.coalesce(text, F.lit("")).alias("text"))


def count_anchors(docs: DataFrame, kind: Kind) -> DataFrame:
    """``f`` and ``n`` of the anchors found twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                symbols, first, _ = kind.units(texts)
                f, n = np.unique(anchors(symbols, first, kind)["f"], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n)], ["f", "n"])

    return docs.select("text").mapInArrow(released(run), "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).filter("n > 1")


STRETCH = T.StructType([
    T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("ta", T.LongType()), ("tb", T.LongType()), ("s1", T.IntegerType()),
        ("run", T.IntegerType()), ("anchor", T.IntegerType()), ("f", T.LongType()), ("chunk", T.IntegerType()), ("chunks", T.IntegerType()),
        ("body", T.BinaryType()))])


def _stretches(kind: Kind, wanted: Callable, max_members: int) -> Callable:
    """Task that cuts out the stretches of wanted anchors. ``wanted``: batch to (function of rows and hashes to counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                symbols, first, cut = kind.units(texts)
                found = anchors(symbols, first, kind)
                n = wanted(part)(found["row"], found["f"])
                keep = np.flatnonzero(n > 1)
                found = {k: v[keep] for k, v in found.items()}
                chunks = -(-n[keep] // max_members)
                doc_id = part.column("doc_id").take(pa.array(found["row"]))
                ta, tb = (part.column(c).take(pa.array(found["row"])) for c in ("ta", "tb"))
                salt = mix(ta.to_numpy(zero_copy_only=False).view(np.uint64) + found["s1"].astype(np.uint64) * _C
                           + doc_id.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(3))
                chunk = (salt % np.maximum(chunks, 1).astype(np.uint64)).astype(np.int32)
                at = first[found["row"]] + found["s1"]
                for i in range(0, len(keep), 4096):
                    to = slice(i, i + 4096)
                    bodies = cut(at[to], (at + found["run"] + kind.length - 1)[to])
                    ints = [pa.array(x[to].astype(np.int32)) for x in (found["s1"], found["run"], found["anchor"])]
                    yield pa.RecordBatch.from_arrays(
                        [doc_id[i:i + 4096], ta[i:i + 4096], tb[i:i + 4096], *ints, pa.array(found["f"][to]), pa.array(chunk[to]),
                         pa.array(chunks[to].astype(np.int32)), pa.array(bodies, type=pa.binary())], STRETCH.names)

    return run


def repeated_stretches(docs: DataFrame, kind: Kind, max_broadcast: int, max_members: int) -> DataFrame:
    """The stretches of all anchors found twice or more; ``docs`` has doc_id, ta, tb and text."""
    repeated = write_once(count_anchors(docs, kind))
    if repeated.count() <= max_broadcast:
        table = repeated.toArrow()
        f, n = (table.column(c).to_numpy().astype(np.int64) for c in ("f", "n"))
        order = np.argsort(f)
        sent = docs.sparkSession.sparkContext.broadcast((f[order], n[order]))

        def lookup(_):
            f, n = sent.value

            def counts(rows, hashes):
                if not len(f):
                    return np.zeros(len(hashes), dtype=np.int64)
                at = np.minimum(np.searchsorted(f, hashes), len(f) - 1)
                return np.where(f[at] == hashes, n[at], 0)

            return counts

        return docs.mapInArrow(released(_stretches(kind, lookup, max_members)), STRETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                symbols, first, _ = kind.units(texts)
                found = anchors(symbols, first, kind)
                rows = pa.array(found["row"])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(rows) for c in ("doc_id", "ta", "tb")), pa.array(found["f"])],
                    ["doc_id", "ta", "tb", "f"])

    places = docs.mapInArrow(released(run), "doc_id long, ta long, tb long, f long").distinct().join(repeated, "f")
    lists = places.groupBy("doc_id", "ta", "tb").agg(F.sort_array(F.collect_list(F.struct("f", "n"))).alias("found"))
    lists = lists.select(F.col("doc_id").alias("_id"), F.col("ta").alias("_ta"), F.col("tb").alias("_tb"), "found")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("ta") == F.col("_ta")) & (F.col("tb") == F.col("_tb"))
    both = docs.join(lists, same).select(
        "doc_id", "ta", "tb", "text", F.col("found.f").alias("f"), F.col("found.n").alias("n"))

    def own(part):
        f, n = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("f", "n"))
        row = np.repeat(np.arange(part.num_rows), np.diff(part.column("f").offsets.to_numpy()))
        where = {(r, x): c for r, x, c in zip(row.tolist(), f.tolist(), n.tolist())}

        def counts(rows, hashes):
            return np.array([where.get(k, 0) for k in zip(rows.tolist(), hashes.tolist())], dtype=np.int64)

        return counts

    return both.mapInArrow(released(_stretches(kind, own, max_members)), STRETCH)


FOUND = T.StructType([
    T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("ta", T.LongType()), ("tb", T.LongType()), ("at", T.ArrayType(T.IntegerType())),
        ("n", T.ArrayType(T.IntegerType())), ("f", T.LongType()), ("bucket", T.IntegerType()),
        ("left", T.BinaryType()))])


def _runs(starts: np.ndarray) -> tuple[list, list]:
    """Rising numbers as (first, count) of their runs."""
    new = np.flatnonzero(np.concatenate([[True], np.diff(starts) != 1]))
    return starts[new].tolist(), np.diff(np.concatenate([new, [len(starts)]])).tolist()


_LEFT = np.dtype([
    ("hash", "<u8"), ("more", "<u8"), ("doc_id", "<i8"), ("ta", "<i8"), ("tb", "<i8"), ("start", "<i4"), ("open", "?"), ("no_id", "?")])


def _resolver(kind: Kind, block_bytes: int) -> Callable:
    """Task over stretches sorted by group: windows that start twice, and what is left over of chunked groups."""

    def solve(rows: pa.Table) -> Iterator[tuple]:
        get = {c: rows.column(c).to_numpy() for c in ("f", "chunks", "s1", "run", "anchor", "ta", "tb")}
        ids = rows.column("doc_id").combine_chunks()
        no_id, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        bodies = rows.column("body").to_pylist()
        run = get["run"].astype(np.int64)
        marks, hashed = kind.resolve(Stretches(get["f"], get["s1"], run, get["anchor"].astype(np.int64), bodies))
        edges = np.concatenate([[0], np.cumsum(run)])
        start = np.arange(edges[-1]) - np.repeat(edges[:-1], run) + np.repeat(get["s1"], run)
        total = np.concatenate([[0], np.cumsum(marks)])
        for i in np.flatnonzero(total[edges[1:]] > total[edges[:-1]]).tolist():
            own = slice(edges[i], edges[i + 1])
            key = (None if no_id[i] else int(ids[i]), int(get["ta"][i]), int(get["tb"][i]))
            yield (*key, *_runs(start[own][marks[own]]), None, None, None)
        chunked = np.unique(get["f"][get["chunks"] > 1]).tolist()
        hashes = hashed() if chunked else ()
        for f in chunked:
            mine = np.flatnonzero(get["f"] == f)
            at = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in mine])
            owner = np.repeat(mine, run[mine])
            # each distinct window of the chunk once
            both = np.empty(len(at), dtype=[("hash", "<u8"), ("more", "<u8")])
            both["hash"], both["more"] = hashes[0][at], hashes[1][at]
            both, where = np.unique(both, return_index=True)
            one, who = both["hash"], owner[where]
            left = np.zeros(len(one), dtype=_LEFT)
            left["hash"], left["more"], left["doc_id"], left["no_id"] = one, both["more"], ids[who], no_id[who]
            left["ta"], left["tb"], left["start"], left["open"] = get["ta"][who], get["tb"][who], start[at[where]], ~marks[at[where]]
            n = int(get["chunks"][mine[0]])
            bucket = (mix(one) % np.uint64(n)).astype(np.int64)
            for b in np.unique(bucket).tolist():
                yield (None, None, None, None, None, f, b, left[bucket == b].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            group = batch.column("f").to_numpy()
            chunk = batch.column("chunk").to_numpy()
            lengths = pa.compute.binary_length(batch.column("body")).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.concatenate([(group[1:] != group[:-1]) | (chunk[1:] != chunk[:-1]), [True]])) + 1
            at = 0
            for end in ends.tolist():
                part = batch.slice(at, end - at)
                key = (group[at], chunk[at])
                if waiting and size >= block_bytes and key != waiting[-1][0]:
                    yield from _batches(solve(pa.Table.from_batches([w[1] for w in waiting])), FOUND)
                    waiting, size = [], 0
                waiting.append((key, part))
                size += int(lengths[at:end].sum())
                at = end
        if waiting:
            yield from _batches(solve(pa.Table.from_batches([w[1] for w in waiting])), FOUND)

    return run


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 2000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    buffer: list[tuple] = []

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in buffer], type=f.type) for i, f in enumerate(arrow)], schema=arrow)

    for row in rows:
        buffer.append(row)
        if len(buffer) == size:
            yield made()
            buffer = []
    if buffer:
        yield made()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leftovers of one bucket of an anchor, sorted by both: a window that two chunks have starts twice."""

    def solve(rows: list[bytes]) -> Iterator[tuple]:
        left = np.frombuffer(b"".join(rows), dtype=_LEFT)
        _, which, count = np.unique(left[["hash", "more"]], return_inverse=True, return_counts=True)
        again = left[(count[which] > 1) & left["open"]]
        again = again[np.lexsort((again["start"], again["tb"], again["ta"], again["doc_id"], again["no_id"]))]
        keys = again[["no_id", "doc_id", "ta", "tb"]]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if len(again) else []
        for part in np.split(again, cuts) if len(again) else []:
            one = part[0]
            key = (None if one["no_id"] else int(one["doc_id"]), int(one["ta"]), int(one["tb"]))
            yield (*key, *_runs(part["start"]), None, None, None)

    def groups() -> Iterator[tuple]:
        key, rows = None, []
        for batch in batches:
            for f, bucket, body in zip(*(batch.column(c).to_pylist() for c in ("f", "bucket", "left"))):
                if (f, bucket) != key and rows:
                    yield from solve(rows)
                    rows = []
                key = (f, bucket)
                rows.append(body)
        if rows:
            yield from solve(rows)

    yield from _batches(groups(), FOUND)


def repeated_windows(
    docs: DataFrame, kind: Kind, text: str = "text", max_broadcast: int = MAX_BROADCAST,
    max_members: int = MAX_MEMBERS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per text with any: ``doc_id``, ``ta``, ``tb``, and ``at``, ``n``: runs of starts of windows that start anywhere else too."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    found = repeated_stretches(_keyed(docs, text), kind, max_broadcast, max_members)
    groups = found.repartition(parts, "f", "chunk").sortWithinPartitions("f", "chunk")
    solved = write_once(groups.mapInArrow(released(_resolver(kind, block_bytes)), FOUND))
    leftover = solved.filter("left IS NOT NULL").select("f", "bucket", "left")
    met = leftover.repartition(parts, "f", "bucket").sortWithinPartitions("f", "bucket").mapInArrow(released(_meet), FOUND)
    every = solved.filter("left IS NULL").unionByName(met)
    return every.groupBy("doc_id", "ta", "tb").agg(
        F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("n")).alias("n"))


def covered(at: np.ndarray, n: np.ndarray, length: int, size: int) -> np.ndarray:
    """Whether each of ``size`` units lies in a window of ``length`` units that starts in one of the runs."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n + length - 1, -1)
    return np.cumsum(edge)[:size] > 0


#: Columns that ``with_windows`` adds: runs of starts of repeated windows.
AT, COUNT = "_repeat_at", "_repeat_n"


def with_windows(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the runs of their repeated windows, null where they have none."""
    ta, tb = _text_key(text)
    docs = docs.withColumns({"_repeat_ta": ta, "_repeat_tb": tb})
    windows = windows.select(
        F.col("doc_id").alias("_repeat_id"), F.col("ta").alias("_own_ta"), F.col("tb").alias("_own_tb"), F.col("at").alias(AT),
        F.col("n").alias(COUNT))
    same = F.col("doc_id").eqNullSafe(F.col("_repeat_id"))
    same = same & (F.col("_repeat_ta") == F.col("_own_ta")) & (F.col("_repeat_tb") == F.col("_own_tb"))
    return docs.join(windows, same, "left").drop("_repeat_id", "_own_ta", "_own_tb", "_repeat_ta", "_repeat_tb")
