"""Periodic runs: maximal stretches of words that repeat with a period, found by suffix trees and Lyndon roots.

A run is a stretch of words with smallest period ``q`` and a length of at least ``max(least, 2 * q)`` that no neighbouring word
extends. Suffix trees of a sequence and of its reversal (after Ukkonen) with an Euler tour give the longest common
extension of two places in constant time. Each run has a Lyndon root in one of the two orders of the alphabet (a word and its
inverse), and that root is the longest Lyndon word at its start, that is up to the next smaller suffix. So each place proposes
two roots; extending them to both sides gives all runs, at most as many as words.

Only words that can be part of a run reach the trees: two words of one run, a period apart, lie in equal stretches of
``ceil(least / 2)`` words, so words outside every such stretch that starts twice in the text are no part of any run, and no
run reaches over them. That screening is done for many texts at once; equal words are then compared as they are, not by hash.

Cases: a null or empty text has no words and no runs; its collapsed text is empty. Repeated rows are searched each; ties, that
is several runs at one place, are all listed. Empty tables give empty results; other columns are kept, and result columns replace
columns with their names. Whole texts are searched; the memory of a task is about 2 kB per word of the longest periodic stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from passagework.llm.words import NOT_BLANK, Texts, find_words, hash_runs, hash_words, mix, pieces

LEAST = 12

_OWN = np.uint64(0x9E3779B97F4A7C15)


class SuffixTree:
    """Suffix tree of numbers of at least 1, with 0 as end mark, and what an Euler tour tells of it."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        n = self.n = len(text)
        width = max(text) + 1
        begin, end, link = [-1], [-1], [0]  # edges into the nodes; node 0 is the root
        edge: dict[int, int] = {}  # node * width + first symbol of the edge -> node below
        leaf = n + 1
        node, first, length, waiting = 0, 0, 0, 0  # active node, edge (by the place of its symbol), characters on it
        for i, c in enumerate(text):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    first = i
                key = node * width + text[first]
                below = edge.get(key)
                if below is None:
                    edge[key] = len(begin)
                    begin.append(i)
                    end.append(leaf)
                    link.append(0)
                    if last:
                        link[last] = node
                    last = 0
                else:
                    size = (end[below] if end[below] != leaf else i + 1) - begin[below]
                    if length >= size:
                        first += size
                        length -= size
                        node = below
                        continue
                    at = begin[below] + length
                    if text[at] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(begin)  # cut the edge and hang a leaf on it
                    begin += [begin[below], i]
                    end += [at, leaf]
                    link += [0, 0]
                    edge[key] = middle
                    edge[middle * width + c] = middle + 1
                    begin[below] = at
                    edge[middle * width + text[at]] = below
                    if last:
                        link[last] = middle
                    last = middle
                waiting -= 1
                if not node and length:
                    length -= 1
                    first = i - waiting + 1
                elif node:
                    node = link[node]
        self._tour(edge, width, begin, end, leaf)

    def _tour(self, edge: dict[int, int], width: int, begin: list[int], end: list[int], leaf: int) -> None:
        """Walk over all edges, lower symbols first: depths on the way, the first visit of each leaf, and suffixes in order."""
        n = self.n
        keys = np.fromiter(edge.keys(), dtype=np.int64, count=len(edge))
        below = np.fromiter(edge.values(), dtype=np.int64, count=len(edge))
        order = np.argsort(keys)
        child = below[order].tolist()
        low = np.searchsorted(keys[order] // width, np.arange(len(begin) + 1)).tolist()
        depths, visits = [0], [0] * n
        suffixes, stack = [], [(0, low[0], 0)]
        of_leaf, depth_of = [-1] * len(begin), [0] * len(begin)
        while stack:
            node, at, depth = stack.pop()
            if at == low[node + 1]:
                if stack:
                    depths.append(stack[-1][2])
                continue
            stack.append((node, at + 1, depth))
            down = child[at]
            if end[down] == leaf:
                suffix = begin[down] - depth
                visits[suffix] = len(depths)
                suffixes.append(suffix)
                of_leaf[down] = suffix
                depths += [n - suffix, depth]
            else:
                deeper = depth + end[down] - begin[down]
                depths.append(deeper)
                depth_of[down] = deeper
                stack.append((down, low[down], deeper))
        # the same tree with higher symbols first, the end mark still before all of them
        turned, stack = [], [0]
        while stack:
            node = stack.pop()
            if of_leaf[node] >= 0:
                turned.append(of_leaf[node])
                continue
            down = child[low[node]:low[node + 1]]
            if of_leaf[down[0]] >= 0 and of_leaf[down[0]] + depth_of[node] == n - 1:
                down = down[1:] + down[:1]
            stack += down
        self.suffixes, self.turned = np.array(suffixes), np.array(turned)
        self.visits = np.array(visits)
        level = np.array(depths, dtype=np.int32)
        self.levels = [level]  # least depth of 1, 2, 4, ... steps of the tour
        size = 1
        while 2 * size <= len(depths):
            level = np.minimum(level[:-size], level[size:])
            self.levels.append(level)
            size *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extensions of the suffixes at ``a`` and ``b``: depths of their lowest common ancestors."""
        x, y = self.visits[a], self.visits[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            least = self.levels[k]
            out[some] = np.minimum(least[low[some]], least[high[some] - (1 << k) + 1])
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """The next place with a smaller value, or the number of places."""
    out, stack = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        mine = rank[i]
        while stack and rank[stack[-1]] > mine:
            stack.pop()
        out[i] = stack[-1] if stack else len(rank)
        stack.append(i)
    return np.array(out)


def runs_of(symbols: list[int], least: int = LEAST) -> np.ndarray:
    """Rows of start, length and period of all runs of ``symbols``, by start, then period."""
    n = len(symbols)
    if n < least:
        return np.zeros((0, 3), dtype=np.int64)
    known = {s: k for k, s in enumerate(sorted(set(symbols)), 1)}
    codes = [known[s] for s in symbols]
    forward = SuffixTree(codes)
    found = []
    for order in (forward.suffixes, forward.turned):
        rank = np.empty(n + 1, dtype=np.int64)
        rank[order] = np.arange(n + 1)
        after = _next_smaller(rank.tolist())[:n]
        at = np.flatnonzero(after < n)
        found.append(at * (n + 1) + after[at])
    i, j = np.divmod(np.unique(np.concatenate(found)), n + 1)
    right = forward.common(i, j)
    fine = j + right >= 2 * (j - i)  # even with all words to the left
    i, j, right = i[fine], j[fine], right[fine]
    del forward
    left = SuffixTree(codes[::-1]).common(n - i, n - j) if len(i) else right
    start, period = i - left, j - i
    length = j + right - start
    good = length >= np.maximum(least, 2 * period)
    return np.unique(np.stack([start[good], period[good], length[good]], axis=1), axis=0)[:, [0, 2, 1]]


def _periodic_stretches(texts: Texts, least: int):
    """The words of the texts, and (row, first word, words) of the stretches that can hold runs."""
    words = find_words(texts, NOT_BLANK)
    gram = -(-least // 2)
    hashes = hash_runs(hash_words(texts.data, words), gram)
    inside = np.flatnonzero(words.doc[:len(hashes)] == words.doc[gram - 1:]) if len(hashes) else np.zeros(0, dtype=np.int64)
    keys = mix(hashes[inside] ^ mix(words.doc[inside].astype(np.uint64) + _OWN))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(inside), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    depth = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(depth, inside[again], 1)
    np.add.at(depth, inside[again] + gram, -1)
    covered = np.cumsum(depth)[:-1] > 0
    begins, ends = covered.copy(), covered.copy()
    if len(covered):
        other = words.doc[1:] != words.doc[:-1]
        begins[1:] &= ~covered[:-1] | other
        ends[:-1] &= ~covered[1:] | other
    at, to = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = to - at >= least
    return words, words.doc[at[long]], at[long], to[long]


def _found(texts: Texts, least: int) -> list[pa.Array]:
    """Runs and collapsed text of each text."""
    words, rows, at, to = _periodic_stretches(texts, least)
    body = texts.data.tobytes()
    kept = np.ones(len(words.starts), dtype=bool)
    none = np.zeros((0, 3), dtype=np.int64)
    runs, owner = [none], [np.zeros(0, dtype=np.int64)]
    for row, a, b in zip(rows.tolist(), at.tolist(), to.tolist()):
        known: dict[bytes, int] = {}
        codes = [known.setdefault(body[x:y], len(known)) for x, y in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist())]
        mine = runs_of(codes, least)
        if len(mine):
            edge = np.zeros(b - a + 1, dtype=np.int64)
            np.add.at(edge, mine[:, 0] + mine[:, 2], 1)
            np.add.at(edge, mine[:, 0] + mine[:, 1], -1)
            kept[a:b] = np.cumsum(edge)[:-1] == 0
            runs.append(mine + np.array([a - words.first[row], 0, 0]))
            owner.append(np.full(len(mine), row))
    flat, owner = np.concatenate(runs), np.concatenate(owner)
    count = len(texts.offsets) - 1
    edges = np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)
    struct = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return [pa.ListArray.from_arrays(pa.array(edges), struct), _joined(texts, words, kept)]


def _joined(texts: Texts, words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, with one blank between two."""
    data = np.concatenate([texts.data, np.zeros(1, dtype=np.uint8)])
    at = np.flatnonzero(kept)
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[words.starts[at]] += 1
    edge[words.ends[at]] -= 1
    inside = np.cumsum(edge[:-1]).astype(bool)
    followed = at[:-1][words.doc[at[1:]] == words.doc[at[:-1]]]
    inside[words.ends[followed]] = True  # white space, as another word of the text comes after
    data[words.ends[followed]] = 0x20
    sizes = np.concatenate([[0], np.cumsum(inside)])
    offsets = sizes[texts.offsets].astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data[inside]))


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """Add ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    ``collapsed`` has the words that no run holds after its first period, joined by one blank.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")
    new = {"runs": RUNS, "collapsed": T.StringType()}
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + _found(texts, least), [*names, *new])

    return docs.mapInArrow(run, T.StructType(kept + [T.StructField(n, t) for n, t in new.items()]))
