"""Benchmark decontamination: multi-pattern search of benchmark windows in whole documents, after Wu and Manber.

The patterns are the distinct windows of ``size`` consecutive words of the benchmark items; an item with fewer words,
but not none, is one window. Symbols are words. For each window length a shift table over blocks of two words tells how
far a position can be moved on without missing a window; where the shift is zero, the block's bucket lists the windows
that end in it, and a direct comparison of all words and bytes confirms the occurrence.

Cases: a null or empty text has no words and no hits. Items without words have no windows. Overlapping occurrences count
each word once. Repeated documents get a row each; repeated items with one id count once; a null item id marks words as
hit but is no item. Empty tables give empty results; other columns of the documents are kept as they are unless a
result column has the same name, which then wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from passagework.llm.words import ALNUM, LOWER, Texts, Words, find_words, hash_runs, hash_words, pieces, released

WINDOW = 10
BLOCK = 2
LANE = 512
BLOCK_BYTES = 32 << 20
#: Bytes of text that a task gathers before it goes through several blocks.
ROUND_BYTES = 16 << 20

FOUND = {
    "n_words": T.LongType(), "n_hit": T.LongType(), "items": T.ArrayType(T.StringType()),
    "hits": T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("n", T.LongType())])),
}


def as_words(texts: Texts) -> tuple[np.ndarray, Words, np.ndarray]:
    data = LOWER[texts.data]
    words = find_words(Texts(data, texts.offsets), ALNUM)
    return data, words, hash_words(data, words)


class Patterns:
    """Search tables of one window length. ``windows``: words of each, ``owners``: item ids of each."""

    def __init__(self, length: int, windows: list[bytes], owners: list[list[str]]):
        self.length, self.block = length, min(BLOCK, length)
        self.bytes, self.owners = windows, owners
        data = b" ".join(windows)
        ends = np.cumsum([len(w) + 1 for w in windows])
        texts = Texts(np.frombuffer(data + b" ", dtype=np.uint8), np.concatenate([[0], ends]))
        _, _, symbols = as_words(texts)
        self.symbols = symbols.reshape(len(windows), length)
        self.bits = max(12, int(np.ceil(np.log2(len(windows) * length * 4 + 1))))
        blocks = np.stack([self._block(self.symbols[:, j:j + self.block]) for j in range(length - self.block + 1)], 1)
        self.far = length - self.block + 1
        self.shift = np.full(1 << self.bits, self.far, dtype=np.int32)
        for j in range(blocks.shape[1]):
            np.minimum.at(self.shift, blocks[:, j], length - self.block - j)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.by_suffix = order
        self.bucket = np.searchsorted(blocks[order, -1], np.arange((1 << self.bits) + 1))

    def _block(self, symbols: np.ndarray) -> np.ndarray:
        key = hash_runs(symbols.ravel(), self.block)[::self.block]
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, words: Words, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first words of all candidate occurrences, and their windows."""
        m, back = self.length, self.length - self.block
        block_at = (hash_runs(symbols, self.block) >> np.uint64(64 - self.bits)).astype(np.int64)
        # lanes: pieces of documents that overlap by a window less one word, all moved on in step
        n_docs = len(words.first) - 1
        count = np.diff(words.first)
        lanes = np.maximum(0, -(-(count - m + 1) // LANE)) * (count >= m)
        doc = np.repeat(np.arange(n_docs), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = words.first[doc] + nth * LANE
        last = np.minimum(words.first[doc + 1] - m, at + LANE - 1)
        places, windows = [], []
        while len(at):
            step = self.shift[block_at[at + back]]
            hit = at[step == 0]
            if len(hit):
                key = block_at[hit + back]
                n = self.bucket[key + 1] - self.bucket[key]
                place = np.repeat(hit, n)
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.bucket[key], n)
                window = self.by_suffix[entry]
                same = np.ones(len(place), dtype=bool)
                for j in range(m):
                    same &= symbols[place + j] == self.symbols[window, j]
                places.append(place[same])
                windows.append(window[same])
            at = at + np.maximum(step, 1)
            on = at <= last
            at, last = at[on], last[on]
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(windows)


def pattern_blocks(benchmark: DataFrame, id_column: str, column: str, size: int, most: int = BLOCK_BYTES) -> Iterator[list]:
    """Windows of the items by length, in blocks of bounded size; one block at a time is in the driver."""
    found: dict[int, dict[bytes, set]] = {}
    used = 0
    rows = benchmark.select(benchmark[id_column].cast("string").alias("id"), benchmark[column].alias("text"))
    for row in rows.toLocalIterator():
        body = (row["text"] or "").encode()
        data, words, _ = as_words(Texts(np.frombuffer(body, dtype=np.uint8), np.array([0, len(body)])))
        low = data.tobytes()
        parts = [low[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        m = min(size, len(parts))
        for i in range(len(parts) - m + 1 if parts else 0):
            key = b" ".join(parts[i:i + m])
            found.setdefault(m, {}).setdefault(key, set()).add(row["id"])
            used += len(key) + 8 * m + 200
        if used > most:
            yield [(m, list(x), [sorted(i for i in ids if i is not None) for ids in x.values()]) for m, x in found.items()]
            found, used = {}, 0
    if found:
        yield [(m, list(x), [sorted(i for i in ids if i is not None) for ids in x.values()]) for m, x in found.items()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = WINDOW, block_bytes: int = BLOCK_BYTES, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """Per document ``n_words``, ``n_hit`` (words inside any occurrence), ``items`` (ids, as sorted strings) and ``hits``.

    ``hits`` lists the maximal runs of hit words. One pass over the texts and no shuffle. The search tables are
    broadcast in blocks of at most ``block_bytes`` of windows; a task holds the tables of one block at a time. With
    several blocks it gathers ``round_bytes`` of text before it goes through them, as building the tables of a block takes a while.
    """
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in pattern_blocks(benchmark, item_id, item_text, size, block_bytes)]
    kept = [f for f in docs.schema.fields if f.name not in FOUND]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in FOUND.items()])
    names = [f.name for f in kept]
    table = docs.select("*") if text in names else docs

    def finish(part: pa.RecordBatch, words: Words, hit: np.ndarray, items: list[set]) -> pa.RecordBatch:
        inside = np.cumsum(hit)[:-1] > 0
        doc_start = np.zeros(len(inside), dtype=bool)
        doc_start[words.first[:-1][words.first[:-1] < words.first[1:]]] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | doc_start[1:]
        stops[:-1] &= ~inside[1:] | doc_start[1:]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        total = np.concatenate([[0], np.cumsum(inside)])
        runs = np.searchsorted(starts, words.first)
        spans = pa.StructArray.from_arrays(
            [pa.array(starts - words.first[words.doc[starts]]), pa.array(ends - starts)], ["first_word", "n"])
        result = {
            "n_words": pa.array(np.diff(words.first)),
            "n_hit": pa.array(total[words.first[1:]] - total[words.first[:-1]]),
            "items": pa.array([sorted(x) for x in items], type=pa.list_(pa.string())),
            "hits": pa.ListArray.from_arrays(pa.array(runs, type=pa.int32()), spans),
        }
        return pa.RecordBatch.from_arrays([part.column(n) for n in names] + list(result.values()), [*names, *result])

    def search(tables: Patterns, data: np.ndarray, words: Words, symbols: np.ndarray, hit: np.ndarray, items: list[set]) -> None:
        for place, window in zip(*(x.tolist() for x in tables.search(words, symbols))):
            to = place + tables.length
            at = zip(words.starts[place:to].tolist(), words.ends[place:to].tolist())
            if b" ".join(data[a:b].tobytes() for a, b in at) == tables.bytes[window]:
                hit[place] += 1
                hit[to] -= 1
                items[int(words.doc[place])].update(tables.owners[window])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: tuple = (None, [])

        def solved(waiting: list[tuple]) -> Iterator[pa.RecordBatch]:
            """The waiting pieces against one block after the other; tables are built once per block and round."""
            nonlocal loaded
            for block in blocks:
                if loaded[0] is not block:
                    loaded = (block, [Patterns(*group) for group in block.value])
                for tables in loaded[1]:
                    for piece in waiting:
                        search(tables, *piece[1:])
            for part, _, words, _, hit, items in waiting:
                yield finish(part, words, hit, items)

        waiting, size = [], 0
        for batch in batches:
            for part, texts in pieces(batch, text):
                data, words, symbols = as_words(texts)
                items: list[set] = [set() for _ in range(part.num_rows)]
                waiting.append((part, data, words, symbols, np.zeros(len(symbols) + 1, dtype=np.int64), items))
                size += len(data)
                if len(blocks) < 2 or size >= round_bytes:
                    yield from solved(waiting)
                    waiting, size = [], 0
        yield from solved(waiting)

    return table.mapInArrow(released(run), schema)
