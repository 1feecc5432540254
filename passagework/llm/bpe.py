"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding through the byte table.

The ranks of a vocabulary file are turned into merges: every way to cut a token in two tokens is a merge, in the order
of the rank of the whole. Texts are cut before a blank or line feed that follows a character other than white space,
and between an ASCII letter and a mark: no match of the split pattern crosses such a place and the pattern never looks
back, so each chunk has the same ids alone as in its text. That holds for patterns that, as the usual ones, match runs
of letters, of marks and of white space apart. Each distinct chunk of a piece of a batch is encoded once and its ids are dealt to all its places.

Cases: a null or empty text has no tokens. Every string is encoded, also those that look like special tokens. Decoding
joins the bytes of the ids; characters that were split over tokens are whole again in ``bytes``, and ``decoded`` puts
U+FFFD where the bytes of the ids form no character. Null ids decode to no bytes; an id outside the vocabulary is an
error. Rows that repeat are encoded each; empty tables give empty results; other columns are kept, and a result column
replaces a column with its name.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from passagework.llm.words import Texts, pieces, released

#: Most bytes of a vocabulary file; it is sent to every executor.
VOCABULARY_BYTES = 16 << 20
#: Distinct chunks whose ids a task remembers.
REMEMBERED = 200_000
PIECE_BYTES = 1 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable bytes for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def read_ranks(path: str) -> bytes:
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def make_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizer of the ``tokenizers`` library with the same ids as the ranks."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    letter = byte_characters()
    shown = {token: "".join(map(letter.__getitem__, token)) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        merges += [(shown[a], shown[b]) for a, b in sorted(cuts, key=lambda c: (ranks[c[0]], ranks[c[1]]))]
    model = models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    tokenizer.encode_special_tokens = True
    return tokenizer


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[0x21:0x7F] = True
_MARK[48:58] = _MARK[65:91] = _MARK[97:123] = False


def chunk_starts(texts: Texts) -> np.ndarray:
    """Where chunks begin: the texts' own starts, blanks or line feeds after a character that is no white space, and
    ASCII marks after an ASCII letter.

    After a character of several bytes that may be white space there is no cut.
    """
    data, offsets = texts
    mark = np.zeros(len(data), dtype=bool)
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    one, two = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    blank = (one <= 0x20) | (one == 0x7F) | (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (one >= 0x80) & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
    mark[at[~blank]] = True
    mark[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    mark[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(mark)


def spread(values: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``values[first[i]:first[i + 1]]`` for each i of ``which``, joined, and the edges between them."""
    count = np.diff(first)[which]
    edges = np.concatenate([[0], np.cumsum(count)])
    return values[np.arange(edges[-1]) + np.repeat(first[which] - edges[:-1], count)], edges


class _Encoder:
    """A tokenizer and the ids of chunks it has seen; one per Python worker, kept from task to task."""

    kept: tuple[tuple, _Encoder] | None = None

    def __init__(self, content: bytes, pattern: str, offsets: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.offsets = make_tokenizer(parse_ranks(content), pattern), offsets
        self.slots: dict[bytes, int] = {}
        self.first = np.zeros(1, dtype=np.int64)
        self.stored = [np.zeros(0, dtype=np.int32) for _ in range(3 if offsets else 1)]  # ids, starts and ends

    @classmethod
    def of(cls, content: bytes, pattern: str, offsets: bool) -> _Encoder:
        key = (content, pattern, offsets)
        if cls.kept is None or cls.kept[0] != key:
            cls.kept = None
            cls.kept = (key, cls(*key))
        return cls.kept[1]

    def remember(self, chunks: list[bytes]) -> np.ndarray:
        """Slots of the chunks; those not known are encoded."""
        if len(self.slots) > REMEMBERED:  # go on with what this piece has
            kept = [c for c in chunks if c in self.slots]
            which = np.array([self.slots[c] for c in kept], dtype=np.int64)
            found = [spread(values, self.first, which) for values in self.stored]
            self.stored, self.first = [x[0] for x in found], found[0][1]
            self.slots = {c: i for i, c in enumerate(kept)}
        fresh = [c for c in chunks if c not in self.slots]
        new: list[list[np.ndarray]] = [[x] for x in self.stored]
        sizes = [self.first]
        for at in range(0, len(fresh), 4096):
            some = self.tokenizer.encode_batch([c.decode() for c in fresh[at:at + 4096]], add_special_tokens=False)
            ids = [e.ids for e in some]
            new[0].append(np.array([i for x in ids for i in x], dtype=np.int32))
            if self.offsets:
                where = np.array([o for e in some for o in e.offsets], dtype=np.int32).reshape(-1, 2)
                new[1].append(where[:, 0])
                new[2].append(where[:, 1])
            sizes.append(sizes[-1][-1] + np.cumsum([len(x) for x in ids]))
        self.stored, self.first = [np.concatenate(x) for x in new], np.concatenate(sizes)
        self.slots.update(zip(fresh, range(len(self.slots), len(self.slots) + len(fresh))))
        return np.array([self.slots[c] for c in chunks], dtype=np.int64)

    def lists(self, texts: Texts) -> list[pa.ListArray]:
        """Ids, and with offsets starts and ends, of each text."""
        starts = chunk_starts(texts)
        edges = np.concatenate([starts, [len(texts.data)]]).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(texts.data)])
        codes = chunks.dictionary_encode()
        which = self.remember(codes.dictionary.to_pylist())[codes.indices.to_numpy(zero_copy_only=False)]
        out = []
        for k, flat in enumerate(self.stored):
            values, ends = spread(flat, self.first, which)
            row_edges = ends[np.searchsorted(starts, texts.offsets)]
            if k:  # places within the text
                letters = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
                row = np.searchsorted(texts.offsets, starts, side="right") - 1
                values = values + np.repeat(letters[starts] - letters[texts.offsets[row]], np.diff(ends))
            out.append(pa.ListArray.from_arrays(pa.array(row_edges, type=pa.int32()), pa.array(values, type=pa.int32())))
        return out


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _replace(schema: T.StructType, new: dict[str, T.DataType]) -> tuple[list[str], T.StructType]:
    kept = [f for f in schema.fields if f.name not in new]
    return [f.name for f in kept], T.StructType(kept + [T.StructField(n, t) for n, t in new.items()])


def _encoding(schema: T.StructType, content: Broadcast, pattern: str, text: str, offsets: bool) -> tuple[Task, T.StructType]:
    ints = T.ArrayType(T.IntegerType(), False)
    new = {"ids": ints} | ({"starts": ints, "ends": ints} if offsets else {})
    names, out = _replace(schema, new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder.of(content.value, pattern, offsets)
        for batch in batches:
            for part, texts in pieces(batch, text, PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + encoder.lists(texts), [*names, *new])

    return run, out


def _decoding(schema: T.StructType, content: Broadcast, ids: str) -> tuple[Task, T.StructType]:
    names, out = _replace(schema, {"bytes": T.BinaryType(), "decoded": T.StringType()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # tokens as the vocabulary shows them, then back through the byte table
        letter = byte_characters()
        byte_of = {c: b for b, c in enumerate(letter)}
        ranks = parse_ranks(content.value)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = bytes(byte_of[c] for c in "".join(map(letter.__getitem__, token)))
        flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        first = np.concatenate([[0], np.cumsum([len(x) for x in table])])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(ids)
                numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(table) or not np.diff(first)[numbers].all()):
                    raise ValueError("an id is not in the vocabulary")
                count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                body, edges = spread(flat, first, numbers)
                ends = edges[np.concatenate([[0], np.cumsum(count)])].tolist()
                rows = [body[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                decoded = [r.decode(errors="replace") for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(rows, type=pa.binary()), pa.array(decoded, type=pa.string())],
                    [*names, "bytes", "decoded"])

    return run, out


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """Add ``ids``; with ``offsets`` also ``starts`` and ``ends``, the characters that each token touches.

    A character that is split over several tokens is in the range of each of them. ``path`` is read once by the driver.
    """
    content = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    return df.mapInArrow(*_encoding(df.schema, content, pattern, text, offsets))


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``bytes``, the joined bytes of the ids, and ``decoded``, their text."""
    content = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    return df.mapInArrow(*_decoding(df.schema, content, ids))


def encode_and_decode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``decode`` of ``encode`` in one Python worker per task."""
    content = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    encoder, schema = _encoding(df.schema, content, pattern, text, offsets)
    decoder, schema = _decoding(schema, content, "ids")
    return df.mapInArrow(released(lambda batches: decoder(encoder(batches))), schema)
