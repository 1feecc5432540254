"""Token counts by prefix dynamic programming: the exact count at every prefix of a text, kept as a column.

``counts[i]`` is the number of tokens that the tokenizer gives to the first ``i + 1`` characters alone. With it, truncation
and budget questions are answered by column expressions (``tokens_of_first``, ``longest_within``, ``budget_cuts``) and no
text is encoded again.

Within a match of the split pattern, the last token of a prefix is the one vocabulary entry that ends there and may follow
the last token of the prefix before it: two neighbours are right if undoing their merges, the latest first, never meets
an earlier merge across their border. So ``count[end] = count[end - length] + 1``, one step per byte. Matches are those of the
library's own splitter. A prefix may be split in another way than the whole text only in a run of white space (which is
one match at the end of a text) and inside ``'re``, ``'ve`` and ``'ll``; such ends are counted as matches of their own. Strings of
special tokens are one token, as the library has it, and prefixes that end inside one are split anew from the match before.

Texts are cut where no match crosses, as in ``bpe``, and every distinct chunk is counted once per worker.

Cases: a null or empty text has no counts and no tokens. Repeated rows are counted each; empty tables give empty results; other
columns are kept, and ``counts`` replaces a column with its name. Very long texts are counted whole. The vocabulary file is read by the
driver and must be a byte-level BPE of the ``tokenizers`` library without normalizer, else it is refused.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.bpe import VOCABULARY_BYTES, byte_characters, chunk_starts, spread
from passagework.llm.words import Texts, pieces

#: Distinct chunks whose counts a worker remembers in a generation, and the characters that they may have in all.
REMEMBERED, REMEMBERED_CHARACTERS = 200_000, 4 << 20

#: Letters before this character are the same in every version of the character tables.
_LATIN_END = "\u0250"

#: White space for Python, but not for the splitter.
_NOT_WHITE = "\x1c\x1d\x1e\x1f"


def _is_white(text: str) -> bool:
    return text.isspace() and not any(c in text for c in _NOT_WHITE)


def read_vocabulary(path: str) -> str:
    """The content of a vocabulary file, checked for what the counting relies on."""
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    with open(path, encoding="utf-8") as file:
        content = file.read()
    parts = json.loads(content)
    model, split = parts["model"], parts.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    flags = any(t[k] for t in parts.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))
    if model["type"] != "BPE" or not plain or parts.get("normalizer") or model.get("ignore_merges") or flags:
        raise ValueError(f"{path} is no plain byte-level BPE")
    return content


class PrefixCounter:
    """Counts of all prefixes of the matches of a vocabulary; one per Python worker, kept from task to task."""

    kept: tuple[str, PrefixCounter] | None = None

    def __init__(self, content: str):
        import ahocorasick
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        parts = json.loads(content)
        self.letter = byte_characters()
        self.split = Tokenizer.from_str(content).pre_tokenizer.pre_tokenize_str
        self.special = sorted((t["content"] for t in parts.get("added_tokens", [])), key=len, reverse=True)
        # merges by their order; single bytes come before all of them
        rank = {c: byte - 256 for byte, c in enumerate(self.letter)}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for order, pair in enumerate(parts["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if left + right in rank:
                raise ValueError("two merges of the vocabulary make one token")
            rank[left + right] = order
            self.halves[order] = (rank[left], rank[right])
            self.merged[rank[left], rank[right]] = order
        automaton = ahocorasick.Automaton()
        for token, order in rank.items():
            automaton.add_word(token, (order, len(token)))
        automaton.make_automaton()
        self.found_in = automaton.iter
        self.may_follow: dict[int, bool] = {}

    @classmethod
    def of(cls, content: str) -> PrefixCounter:
        if cls.kept is None or cls.kept[0] != content:
            cls.kept = None
            cls.kept = (content, cls(content))
        return cls.kept[1]

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of tokens ``a`` and ``b``, encoded together, are those two tokens."""
        key = (a << 32) + b
        known = self.may_follow.get(key)
        if known is not None:
            return known
        left, right, before, out = a, b, len(self.merged), None
        while out is None:
            whole = self.merged.get((left, right))
            if whole is not None and whole < before:
                out = False  # this merge across the border comes before those that made its sides
            elif left < 0 and right < 0:
                out = True
            elif left > right:  # undo the later of the merges that made the two sides
                before, left = left, self.halves[left][1]
            else:
                # of two merges of one order the left one comes first, so the same order may still cross the border
                before, right = right + 1, self.halves[right][0]
        if len(self.may_follow) > REMEMBERED:
            self.may_follow.clear()
        self.may_follow[key] = out
        return out

    def byte_counts(self, letters: str) -> list[int]:
        """Tokens of the first i bytes for every i; bytes come as the characters that stand for them."""
        counts, last, done, known = [0], [0], 0, self.may_follow.get
        for end, (token, size) in self.found_in(letters):  # all entries that end at a place, longest first
            if end < done:
                continue
            begin = end + 1 - size
            if begin:
                fine = known((last[begin] << 32) + token)
                if fine is None:
                    fine = self.fits(last[begin], token)
                if not fine:
                    continue
            counts.append(counts[begin] + 1)
            last.append(token)
            done += 1
        if done != len(letters):
            raise ValueError("the merges of the vocabulary leave a prefix without a last token")
        return counts

    def spelled(self, text: str) -> str:
        """The bytes of a text as the characters that stand for them."""
        return "".join(map(self.letter.__getitem__, text.encode()))

    def total(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        return sum(self.byte_counts(letters)[-1] for letters, _ in self.split(text)) if text else 0

    def plain_counts(self, text: str) -> list[int]:
        """Tokens of every prefix of a text without special tokens, one number per character."""
        word = text[1:] if text[:1] == " " else text
        if word.isalpha() and max(word) < _LATIN_END:  # one match of the splitter: a word and the blank before it
            if word.isascii():
                return self.byte_counts(text if word is text else self.letter[0x20] + word)[1:]
            counts = self.byte_counts(self.spelled(text))
            return [n for n, byte in zip(counts, text.encode() + b"a") if byte & 0xC0 != 0x80][1:]
        out: list[int] = []
        done = blank_at = 0  # tokens before the match, and before the run of white space that the last matches belong to
        blank: list[str] = []
        for letters, (a, b) in self.split(text):
            body = text[a:b]
            counts = self.byte_counts(letters)
            if len(letters) == len(body):
                own = [done + n for n in counts[1:]]
            else:
                own, at = [], 0
                for c in body:
                    at += len(c.encode())
                    own.append(done + counts[at])
            white = _is_white(body)
            if white or (blank and body[0] == " "):
                # a prefix that ends in a run of white space has the whole run so far as its last match
                if not blank:
                    blank_at = done
                for i, c in enumerate(body):
                    if not _is_white(c):
                        break
                    blank.append(c)
                    own[i] = blank_at + self.byte_counts(self.spelled("".join(blank)))[-1]
            if not white:
                blank = []
            if len(body) == 3 and body in ("'re", "'ve", "'ll"):
                own[1] = done + self.byte_counts("'")[-1] + self.byte_counts(body[1])[-1]
            out += own
            done += counts[-1]
        return out

    def counts(self, text: str) -> list[int]:
        """Tokens of every prefix of any text."""
        out: list[int] = []
        begin = done = 0
        while True:
            found = [(at, -len(s), s) for s in self.special if (at := text.find(s, begin)) >= 0]
            at, _, name = min(found, default=(len(text), 0, ""))
            segment = text[begin:at]
            out += [done + n for n in self.plain_counts(segment)]
            if not name:
                return out
            matches = self.split(segment) if segment else []
            from_ = matches[-1][1][0] if matches else 0
            before = done + sum(self.byte_counts(letters)[-1] for letters, _ in matches[:-1])
            done = out[-1] if segment else done
            for k in range(1, len(name)):
                out.append(before + self.total(segment[from_:] + name[:k]))
            done += 1
            out.append(done)
            begin = at + len(name)


class _Memory:
    """Counts of chunks seen before, one flat array per worker; a full one is kept until the next one is full."""

    kept: tuple[str, _Memory] | None = None

    def __init__(self, content: str):
        self.counter = PrefixCounter.of(content)
        self.clear()
        self.before = (self.slots, self.first, self.stored)

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.first = np.zeros(1, dtype=np.int64)
        self.stored = np.zeros(0, dtype=np.int32)

    @classmethod
    def of(cls, content: str) -> _Memory:
        if cls.kept is None or cls.kept[0] != content:
            cls.kept = (content, cls(content))
        return cls.kept[1]

    def add(self, chunks: list[bytes], values: np.ndarray, edges: np.ndarray) -> None:
        self.slots.update(zip(chunks, range(len(self.slots), len(self.slots) + len(chunks))))
        self.stored = np.concatenate([self.stored, values])
        self.first = np.concatenate([self.first, self.first[-1] + edges])

    def remember(self, chunks: list[bytes]) -> np.ndarray:
        if len(self.slots) > REMEMBERED or len(self.stored) > REMEMBERED_CHARACTERS:
            self.before = (self.slots, self.first, self.stored)
            self.clear()
        missing = [c for c in chunks if c not in self.slots]
        slots, first, stored = self.before
        known = [c for c in missing if c in slots]
        if known:
            values, edges = spread(stored, first, np.array([slots[c] for c in known], dtype=np.int64))
            self.add(known, values, edges[1:])
        fresh = [c for c in missing if c not in slots]
        if fresh:
            found = [self.counter.plain_counts(c.decode()) for c in fresh]
            self.add(fresh, np.array([n for x in found for n in x], dtype=np.int32), np.cumsum([len(x) for x in found]))
        return np.array([self.slots[c] for c in chunks], dtype=np.int64)

    def lists(self, texts: Texts) -> pa.ListArray:
        """The counts of each text, none of which has a special token."""
        starts = chunk_starts(texts)
        edges = np.concatenate([starts, [len(texts.data)]]).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(texts.data))])
        codes = chunks.dictionary_encode()
        which = self.remember(codes.dictionary.to_pylist())[codes.indices.to_numpy(zero_copy_only=False)]
        values, ends = spread(self.stored, self.first, which)
        total = values[ends[1:] - 1].astype(np.int64)  # of each chunk
        before = np.concatenate([[0], np.cumsum(total)])
        row = np.searchsorted(texts.offsets, starts, side="right") - 1
        first_chunk = np.searchsorted(starts, texts.offsets)
        base = before[:-1] - before[first_chunk[row]]
        values = values + np.repeat(base, np.diff(ends)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends[first_chunk], type=pa.int32()), pa.array(values, type=pa.int32()))


def prefix_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``counts``: tokens of the first character, of the first two, and so on to the whole text."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    kept = [f for f in df.schema.fields if f.name != "counts"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory.of(content.value)
        special = [s.encode() for s in memory.counter.special]
        for batch in batches:
            for part, texts in pieces(batch, text):
                body = texts.data.tobytes()
                if any(s in body for s in special):
                    rows = [body[a:b].decode() for a, b in zip(texts.offsets.tolist(), texts.offsets[1:].tolist())]
                    lists = pa.array([memory.counter.counts(r) for r in rows], type=pa.list_(pa.int32()))
                else:
                    lists = memory.lists(texts)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [lists], [*names, "counts"])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField("counts", T.ArrayType(T.IntegerType(), False))]))


def total_tokens(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.get(counts, F.size(counts) - 1), F.lit(0)).cast("bigint")


def tokens_of_first(counts: Column, characters: Column | int) -> Column:
    """Tokens of the text cut to its first ``characters``; of the whole text if it is shorter."""
    n = F.least(F.lit(characters) if isinstance(characters, int) else characters, F.size(counts))
    return F.coalesce(F.get(counts, n - 1), F.lit(0)).cast("bigint")


def longest_within(counts: Column, tokens: Column | int) -> Column:
    """Characters of the longest prefix of at most ``tokens`` tokens. Counts may fall again, so the last such end counts."""
    limit = F.lit(tokens) if isinstance(tokens, int) else tokens
    ends = F.transform(counts, lambda n, i: F.when(n <= limit, i + 1).otherwise(0))
    return F.coalesce(F.array_max(ends), F.lit(0)).cast("bigint")


def budget_cuts(counts: Column, tokens: Column | int) -> Column:
    """Ends, in characters, of consecutive parts whose counts rise by at most ``tokens`` each, as long as possible.

    A part ends before the count would pass the budget; a single character of more tokens than that is a part alone. The
    counts are those of the prefix, so a part encoded on its own may differ by the tokens at its two edges.
    """
    limit = F.lit(tokens) if isinstance(tokens, int) else tokens
    none = F.array().cast("array<int>")
    state = F.struct(F.lit(0).alias("i"), F.lit(0).alias("begin"), F.lit(0).alias("base"), F.lit(0).alias("last"), none.alias("ends"))

    def step(s: Column, n: Column) -> Column:
        over = (n - s["base"] > limit) & (s["i"] > s["begin"])
        return F.struct(
            (s["i"] + 1).alias("i"), F.when(over, s["i"]).otherwise(s["begin"]).alias("begin"),
            F.when(over, s["last"]).otherwise(s["base"]).alias("base"), n.alias("last"),
            F.when(over, F.array_append(s["ends"], s["i"])).otherwise(s["ends"]).alias("ends"))

    def close(s: Column) -> Column:
        return F.when(s["i"] > 0, F.array_append(s["ends"], s["i"])).otherwise(s["ends"])

    return F.aggregate(counts, state, step, close)
