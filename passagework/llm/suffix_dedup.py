"""Suffix-array dedup: bytes inside a string of ``length`` bytes that also starts anywhere else are removed.

Stretches around repeated anchors meet in groups (see ``repeats``). A block of groups is written as a string of symbols,
one per ``STEP`` bytes counted from the anchor. Its suffixes are sorted by linear grouping: groups of suffixes with
one Lyndon prefix are processed from the highest to the lowest with previous-smaller pointers, then each group's order
is emitted from the order of what follows its Lyndon prefix, with no recursion and no renaming (after Baier). Neighbours in
the order that share the whole symbols of a window make a class. Its members are extended to the left and to the right, a byte
at a time, less than a symbol each way, and leave when no other member agrees: a window starts twice when two members
share the class of the bytes to the left and that of the bytes to the right. Only bytes decide; hashes merely name symbols, and
the bytes behind a name are compared.

Cases: a null text is empty and has nothing to remove, as has every text shorter than ``length``. Rows with one text,
also under one or no id, are copies of each other, so all their strings of that length go. Matches may overlap in one
text. Empty tables give empty results. Columns of the input are kept, but for those named as a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from passagework.llm.repeats import AT, COUNT, Kind, Stretches, covered, gram_hashes, repeated_windows, with_windows
from passagework.llm.words import OTHER, Texts, mix, pieces, released

LENGTH = 400
STEP = 64

_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64))


def suffix_order(symbols: list[int]) -> list[int]:
    """Suffix array of ``symbols``, of which the last must be the least and occur once."""
    n = len(symbols)
    order = np.argsort(np.array(symbols, dtype=np.int64), kind="stable")
    values = np.array(symbols, dtype=np.int64)[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    starts = np.flatnonzero(new)
    group_of = np.empty(n, dtype=np.int64)
    group_of[order] = starts[np.cumsum(new) - 1]
    place_of = np.empty(n, dtype=np.int64)
    place_of[order] = np.arange(n)
    size = np.zeros(n, dtype=np.int64)
    size[starts] = np.diff(np.concatenate([starts, [n]]))
    at, group, place, size = order.tolist(), group_of.tolist(), place_of.tolist(), size.tolist()
    before = [-1] * n  # the nearest suffix to the left in a lower group
    end = n
    while end > 1:
        begin = group[at[end - 1]]
        children: dict[int, int] = {}
        for i in sorted(at[begin:end]):
            j = i - 1
            while j >= 0 and group[j] >= begin:
                j = before[j]
            before[i] = j
            if j >= 0:
                children[j] = children.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in children.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):  # those with more of this group after them are higher
            moved: dict[int, int] = {}
            for j in by_count[count]:
                g = group[j]
                done = moved.get(g, 0)
                moved[g] = done + 1
                to = g + size[g] - 1 - done
                other, here = at[to], place[j]
                at[to], at[here] = j, other
                place[j], place[other] = to, here
            for g, many in moved.items():
                if many < size[g]:
                    size[g] -= many
                    fresh = g + size[g]
                    size[fresh] = many
                    for k in range(fresh, fresh + many):
                        group[at[k]] = fresh
        end = begin
    # every group in order: a suffix is emitted when what follows its Lyndon prefix has been
    out = [-1] * n
    free = {}
    out[0] = n - 1
    emitted = bytearray(n)
    emitted[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not emitted[j]:
            g = group[j]
            slot = free.get(g, g)
            free[g] = slot + 1
            out[slot] = j
            emitted[j] = 1
            j = before[j]
    return out


def byte_units(texts: Texts):
    data = texts.data

    def cut(begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
        return [data[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]

    return _SYMBOL[data], texts.offsets, cut


def _named(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """A number from 2 on for every symbol of ``STEP`` bytes, the same for equal bytes."""
    if not len(where):
        return np.zeros(0, dtype=np.int64)
    names = gram_hashes(_SYMBOL[data], STEP)[where]
    _, first, names = np.unique(names, return_index=True, return_inverse=True)
    bodies = data[where[:, None] + np.arange(STEP)]
    if (bodies[first][names] != bodies).any():  # other bytes under one hash
        names = np.unique(bodies, axis=0, return_inverse=True)[1].ravel()
    return names + 2


def _split(old: np.ndarray, byte: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Split classes by a byte. Members whose weights do not add up to two get -1, as do those that had it or have no byte."""
    out = np.full(len(old), -1, dtype=np.int32)
    on = np.flatnonzero((old >= 0) & (byte >= 0))
    if len(on):
        _, which = np.unique(old[on].astype(np.int64) * 257 + byte[on], return_inverse=True)
        total = np.bincount(which, weights=weight[on])
        out[on] = np.where(total[which] > 1, which, -1)
    return out


def resolve(length: int, blocks: Stretches) -> tuple[np.ndarray, Callable]:
    """Marks and, on demand, hashes of all windows of the stretches, see ``Kind``."""
    run = blocks.run
    edges = np.concatenate([[0], np.cumsum(run)])
    distinct: dict[tuple, int] = {}
    of = np.array([distinct.setdefault(k, len(distinct)) for k in zip(blocks.f.tolist(), blocks.anchor.tolist(), blocks.bodies)])
    first = np.full(len(distinct), -1)
    first[of[::-1]] = np.arange(len(of))[::-1]
    copies = np.bincount(of, minlength=len(distinct))
    sizes = np.array([len(blocks.bodies[i]) for i in first])
    base = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(blocks.bodies[i] for i in first), dtype=np.uint8)
    # symbols of STEP bytes, in step with the anchor
    need = (length - STEP + 1) // STEP
    phase = blocks.anchor[first] % STEP
    count = np.maximum(0, sizes - phase) // STEP
    owner = np.repeat(np.arange(len(first)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    where = base[owner] + phase[owner] + nth * STEP
    names = _named(data, where)
    line = np.ones(len(names) + len(first) + 1, dtype=np.int64)  # 1 between stretches, 0 at the end
    line[np.arange(len(names)) + owner] = names
    line[-1] = 0
    order = np.array(suffix_order(line.tolist()))
    number = np.full(len(line), -1)
    number[np.arange(len(names)) + owner] = np.arange(len(names))
    block = number[order]
    block = block[block >= 0]
    block = block[nth[block] + need <= count[owner[block]]]  # suffixes with enough symbols, in order
    new = np.ones(len(block), dtype=bool)
    if len(block) > 1:
        new[1:] = False
        for j in range(need):
            new[1:] |= names[block[1:] + j] != names[block[:-1] + j]
    weight = copies[owner[block]]
    classes = np.cumsum(new) - 1
    again = np.bincount(classes, weights=weight, minlength=1)[classes] > 1 if len(block) else new
    block, classes, weight = block[again], classes[again], weight[again]
    # bytes to both sides of the shared symbols
    begin, low, high = where[block], base[owner[block]], base[owner[block] + 1]
    end, rest = begin + need * STEP, length - need * STEP

    def byte(at: np.ndarray, on: np.ndarray) -> np.ndarray:
        fits = on & (at >= low) & (at < high)
        return np.where(fits, data[np.where(fits, at, 0)] if len(data) else 0, -1).astype(np.int64)

    right = [classes]
    for j in range(rest):
        right.append(_split(right[-1], byte(end + j, right[-1] >= 0), weight))
    windows = run[first]
    at = np.concatenate([[0], np.cumsum(windows)])
    marks = np.zeros(at[-1], dtype=bool)
    left = classes
    for back in range(min(STEP, rest + 1)):
        if back:
            left = _split(left, byte(begin - back, left >= 0), weight)
        if not (left >= 0).any():
            break
        other = right[rest - back]
        some = np.flatnonzero((left >= 0) & (other >= 0))
        _, which = np.unique(left[some].astype(np.int64) * (len(block) + 1) + other[some], return_inverse=True)
        some = some[np.bincount(which, weights=weight[some])[which] > 1]
        start = begin[some] - back - low[some]
        inside = (start >= 0) & (start < windows[owner[block[some]]])
        marks[at[owner[block[some]]][inside] + start[inside]] = True

    def hashed() -> tuple[np.ndarray, np.ndarray]:
        of_window = np.repeat(np.arange(len(first)), windows)
        place = base[of_window] + np.arange(at[-1]) - at[of_window]
        return tuple(gram_hashes(_SYMBOL[d], length)[place][back_to] for d in (data, OTHER[data]))

    back_to = np.arange(edges[-1]) - np.repeat(edges[:-1], run) + np.repeat(at[of], run)
    return marks[back_to], hashed


def kind(length: int = LENGTH) -> Kind:
    if length < 2 * STEP:
        raise ValueError(f"length must be {2 * STEP} or more")
    return Kind(length, length // 4, byte_units, lambda blocks: resolve(length, blocks))


def remove_repeated_bytes(
    docs: DataFrame, text: str = "text", length: int = LENGTH, **limits: int
) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``spans`` (removed runs of bytes, end exclusive) and ``kept`` (binary)."""
    new = {
        "n_bytes": T.LongType(), "n_removed": T.LongType(), "kept": T.BinaryType(),
        "spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
    }
    both = with_windows(docs, repeated_windows(docs, kind(length), text, **limits), text)
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, text):
                rows = []
                for i, (at, n) in enumerate(zip(part.column(AT).to_pylist(), part.column(COUNT).to_pylist())):
                    data = texts.data[texts.offsets[i]:texts.offsets[i + 1]]
                    if not at:
                        rows.append((len(data), 0, data.tobytes(), []))
                        continue
                    gone = covered(np.array(at), np.array(n), length, len(data))
                    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
                    rows.append((len(data), int(gone.sum()), data[~gone].tobytes(),
                                 [{"start": a, "end": b} for a, b in edge]))
                types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                columns = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + columns, [*names, *new])

    return both.mapInArrow(released(run), T.StructType(kept + [T.StructField(n, t) for n, t in new.items()]))
