"""Substring dedup by seed and extend: words inside a window of ``length`` words that also starts anywhere else go.

Seeds are winnowed anchors; documents meet at the anchors they share (see ``repeats``). All members of a group are
extended at once, a word at a time to the right and to the left of the anchor: members stay in one class as long as
their words agree, and leave when no other member agrees. A window starts twice when two members share both the class
of its words to the left and that of its words to the right; windows that overlap join to maximal repeats.

Cases: a null text has no words; texts with fewer words than ``length`` lose nothing. Rows with one text are copies of
each other. A window may overlap its own repetition. Empty tables give empty results. Columns of the
input are kept, but for those named as a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from passagework.llm.repeats import AT, COUNT, Kind, Stretches, covered, gram_hashes, repeated_windows, with_windows
from passagework.llm.words import NOT_BLANK, OTHER, Texts, Words, find_words, hash_words, pieces, released

LENGTH = 35
SEED_WORDS = 6


def joined(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words, each followed by one blank, as bytes; where each begins and ends there."""
    size = words.ends - words.starts
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, dtype=np.uint8)
    if len(size):
        inside = np.ones(len(out), dtype=bool)
        inside[ends] = False
        edge = np.zeros(len(data) + 1, dtype=np.int8)
        edge[words.starts] += 1
        np.subtract.at(edge, words.ends, 1)
        out[inside] = data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    return out, begins, ends


def word_units(texts: Texts):
    words = find_words(texts, NOT_BLANK)

    def cut(begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
        flat, starts, stops = joined(texts.data, words)
        return [flat[starts[a]:stops[b - 1]].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]

    return hash_words(texts.data, words), words.first, cut


def _classes(old: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Split classes by a word; members that are alone get -1, as do those that had it."""
    out = np.full(len(old), -1, dtype=np.int64)
    on = np.flatnonzero((old >= 0) & (word >= 0))
    if len(on):
        key = old[on] * (int(word[on].max()) + 1) + word[on]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        out[on] = np.where(count[which] > 1, which, -1)
    return out


def resolve(length: int, seed_words: int, blocks: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """Marks and, on demand, hashes of all windows of the stretches, see ``Kind``."""
    run, anchor = blocks.run, blocks.anchor
    edges = np.concatenate([[0], np.cumsum(run)])
    split = pc.split_pattern(pa.array(blocks.bodies, type=pa.binary()).cast(pa.large_binary()), b" ")
    words = split.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    base = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)

    def word(offset: int, on: np.ndarray) -> np.ndarray:
        """The word at an offset from each member's anchor, -1 outside of its stretch."""
        at = base[:-1] + anchor + offset
        fits = on & (at >= base[:-1]) & (at < base[1:])
        return np.where(fits, codes[np.where(fits, at, 0)], -1)

    seeds = np.unique(blocks.f, return_inverse=True)[1]
    most = int(anchor.max())
    right = [_classes(seeds, np.zeros(len(seeds), dtype=np.int64))]
    for j in range(length):
        right.append(_classes(right[-1], word(j, right[-1] >= 0)))
    left = [right[seed_words]]
    for j in range(1, most + 1):
        left.append(_classes(left[-1], word(-j, left[-1] >= 0)))
    marks = np.zeros(edges[-1], dtype=bool)
    for back in range(most + 1):
        mine = np.flatnonzero((anchor - back >= 0) & (anchor - back < run))
        a, b = left[back][mine], right[length - back][mine]
        on = (a >= 0) & (b >= 0)
        both = _classes(np.where(on, a, -1), b)
        marks[edges[mine] + anchor[mine] - back] = both >= 0

    def hashed() -> tuple[np.ndarray, np.ndarray]:
        letters = words.dictionary.cast(pa.large_binary())
        offsets = np.frombuffer(letters.buffers()[1], dtype=np.int64)[letters.offset:letters.offset + len(letters) + 1]
        data = np.frombuffer(letters.buffers()[2], dtype=np.uint8)
        spans = Words(offsets[:-1], offsets[1:], offsets, offsets)
        start = np.repeat(base[:-1], run) + np.arange(edges[-1]) - np.repeat(edges[:-1], run)
        return tuple(gram_hashes(hash_words(d, spans)[codes], length)[start] for d in (data, OTHER[data]))

    return marks, hashed


def kind(length: int = LENGTH, seed_words: int = SEED_WORDS) -> Kind:
    if not 0 < seed_words < length:
        raise ValueError("a seed has fewer words than a window")
    return Kind(length, seed_words, word_units, lambda blocks: resolve(length, seed_words, blocks))


def remove_repeated_words(
    docs: DataFrame, text: str = "text", length: int = LENGTH, seed_words: int = SEED_WORDS, **limits: int
) -> DataFrame:
    """Add ``n_words``, ``n_removed``, ``repeats`` (removed runs of words, end exclusive), ``kept`` (joined by a blank)."""
    new = {
        "n_words": T.LongType(), "n_removed": T.LongType(), "kept": T.StringType(),
        "repeats": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
    }
    both = with_windows(docs, repeated_windows(docs, kind(length, seed_words), text, **limits), text)
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, text):
                words = find_words(texts, NOT_BLANK)
                flat, starts, ends = joined(texts.data, words)
                rows = []
                for i, (at, n) in enumerate(zip(part.column(AT).to_pylist(), part.column(COUNT).to_pylist())):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    gone = covered(np.array(at or [], dtype=int), np.array(n or [], dtype=int), length, b - a)
                    runs = np.flatnonzero(np.diff(~gone, prepend=False, append=False)).reshape(-1, 2).tolist()
                    removed = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).tolist()
                    body = b" ".join(flat[starts[a + x]:ends[a + y - 1]].tobytes() for x, y in runs)
                    rows.append((b - a, int(gone.sum()), body, [{"start": x, "end": y} for x, y in removed]))
                types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                columns = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + columns, [*names, *new])

    return both.mapInArrow(released(run), T.StructType(kept + [T.StructField(n, t) for n, t in new.items()]))
