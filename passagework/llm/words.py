"""Words of many texts at once, as numpy arrays: places in one byte buffer and 64-bit hashes.

Used inside Arrow tasks. A batch is cut into pieces of bounded size first, so memory does not depend on the length of
a batch; one text is never cut, its memory is a small multiple of its own length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_U = np.uint64
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between white space, `[^\x20\x09-\x0D]`.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of letters and digits, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`; upper case is meant to be lowered before.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


#: Another name for every byte: hashes of so renamed texts are a second opinion on equal hashes.
OTHER = np.random.default_rng(1).permutation(256).astype(np.uint8)


class Texts(NamedTuple):
    data: np.ndarray  # bytes of all texts, one after the other
    offsets: np.ndarray  # where each begins, and the end of the last


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # row of each word
    first: np.ndarray  # number of the first word of each row, and of all words


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch with at most ``most`` bytes of text, or one row. A null text counts as empty."""
    text = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    body = text.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at), Texts(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def released(task):
    """The task, which gives the memory it used back to the system at its end.

    Workers live on between tasks and stages. What their allocators keep for later adds up on an executor whose next
    stage needs it for something else.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library, which has no such call
                pass

    return run


def find_words(texts: Texts, kind: np.ndarray) -> Words:
    """Maximal runs of the bytes that ``kind`` marks, within each text."""
    data, offsets = texts
    inside = kind[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[full] = inside[full]
    stops[full[1:] - 1] = inside[full[1:] - 1]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, np.flatnonzero(stops) + 1, doc, first)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all bits; one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    at, left = words.starts, words.ends - words.starts
    out = mix(eight[at] & _MASKS[np.minimum(left, 8)] ^ (left.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    more = np.flatnonzero(left > 8)
    at, left = at[more] + 8, left[more] - 8
    while len(more):
        out[more] = mix(out[more] * _U(0xD6E8FEB86659FD93) + (eight[at] & _MASKS[np.minimum(left, 8)]))
        go = left > 8
        more, at, left = more[go], at[go] + 8, left[go] - 8
    return out


def hash_runs(symbols: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` symbols, by the number of its first one."""
    n = max(0, len(symbols) - length + 1)
    out = np.full(n, length, dtype=np.uint64)
    for j in range(length):
        out = mix(out * _U(0xD6E8FEB86659FD93) + symbols[j:j + n])
    return out
