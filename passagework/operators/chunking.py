"""Splitting texts into chunks of a bounded number of tokens."""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.text import bind, clean_text, sentences, split_pages, stable_id, word_count, words

# From texts to the places (start, end) of the tokens of each.
Encoder = Callable[[list[str]], list[list[tuple[int, int]]]]

# Defaults of the splitter and of the model that reads the chunks.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 10
CONTEXT_TOKENS = 4096

# Characters of the texts that an encoder gets at once.
CALL_CHARS = 500_000


def _check(size: int, overlap: int) -> None:
    if not size > overlap >= 0:
        raise ValueError(f"need size > overlap >= 0, got size={size}, overlap={overlap}")


def text_sentences(text: Column) -> Column:
    """Sentences of a raw text. A page break ends a sentence, and pages are cleaned one by one."""
    return F.flatten(F.transform(split_pages(text), lambda page: sentences(clean_text(page))))


def _cut(sentence: Column, limit: int) -> Column:
    """Pieces of at most ``limit`` tokens of one sentence."""
    return bind(
        words(sentence),
        lambda ws: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(ws) - 1) / limit).cast("int")),
            lambda i: F.array_join(F.slice(ws, i * limit + 1, limit), " "),
        ),
    )


def _counts(pieces: Column) -> Column:
    return F.transform(pieces, word_count)


def _starts(counts: Column, limit: int) -> Column:
    """Position of the first piece of every chunk. Only counts travel through the fold, no text."""
    state = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("pos"), F.lit(limit + 1).alias("filled")
    )

    def add(acc: Column, count: Column) -> Column:
        opens = acc["filled"] + count > limit
        return F.struct(
            F.when(opens, F.array_append(acc["starts"], acc["pos"])).otherwise(acc["starts"]).alias("starts"),
            (acc["pos"] + 1).alias("pos"),
            F.when(opens, count).otherwise(acc["filled"] + count).alias("filled"),
        )

    return F.aggregate(counts, state, add, lambda acc: acc["starts"])


def chunk_text(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Sentence-respecting chunks of a raw text, ARRAY<STRING>, each of at most ``size`` tokens.

    Sentences are packed in order up to ``size - overlap`` tokens; a longer sentence is cut first. Every chunk
    but the first starts with the last ``overlap`` tokens of the packed chunk before it.
    """
    _check(size, overlap)
    limit = size - overlap

    def cut_long(found: Column) -> Column:
        return F.flatten(
            F.transform(found, lambda s: F.when(word_count(s) <= limit, F.array(s)).otherwise(_cut(s, limit)))
        )

    def sized(pieces: Column, counts: Column) -> Column:
        return F.struct(pieces.alias("pieces"), counts.alias("counts"))

    def split_long(found: Column) -> Column:
        return bind(
            _counts(found),
            lambda counts: F.when(
                F.exists(counts, lambda n: n > limit), bind(cut_long(found), lambda cut: sized(cut, _counts(cut)))
            ).otherwise(sized(found, counts)),
        )

    def pack(units: Column) -> Column:
        pieces = units["pieces"]
        return bind(
            _starts(units["counts"], limit),
            lambda starts: F.transform(
                starts,
                lambda first, i: F.array_join(
                    F.slice(pieces, first + 1, F.coalesce(F.get(starts, i + 1), F.size(pieces)) - first), " "
                ),
            ),
        )

    def with_overlap(packed: Column) -> Column:
        if overlap == 0:
            return packed
        return F.transform(
            packed,
            lambda body, i: F.when(i == 0, body).otherwise(
                F.concat(F.substring_index(F.get(packed, i - 1), " ", -overlap), F.lit(" "), body)
            ),
        )

    return bind(bind(bind(text_sentences(text), split_long), pack), with_overlap)


def tokenizer_splitter(
    load_tokenizer: Callable[[], Callable[[str], int]], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> Callable[[Column], Column]:
    """Splitter that counts with a real tokenizer instead of blanks; pass it as ``splitter`` to ``chunk_rows``.

    ``load_tokenizer`` runs once per Python task and returns a function from a text to its token count. The rules are
    those of ``chunk_text``. No chunk counts more than ``size``, measured as a whole with its overlap, unless a single
    character does: longer words are cut.
    """
    _check(size, overlap)

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = load_tokenizer()

        def cut(word: str, limit: int) -> list[str]:
            """Parts of a word within the limit, each as long as halving finds."""
            out = []
            while count(word) > limit and len(word) > 1:
                n = len(word)
                while n > 1 and count(word[:n]) > limit:
                    n = (n + 1) // 2
                out.append(word[:n])
                word = word[n:]
            return [*out, word] if word else out

        def pack(pieces: list[str], limit: int) -> list[str]:
            out: list[str] = []
            for piece in pieces:
                if out and count(f"{out[-1]} {piece}") <= limit:
                    out[-1] += f" {piece}"
                else:
                    out.append(piece)
            return out

        def one(found: list[str] | None) -> list[str] | None:
            if found is None:
                return None
            limit = size - overlap
            pieces: list[str] = []
            for s in found:
                if count(s) <= limit:
                    pieces.append(s)
                else:
                    pieces += pack([part for word in s.split(" ") for part in cut(word, limit)], limit)
            packed = pack(pieces, limit)
            out = packed[:1]
            for before, body in zip(packed, packed[1:]):
                tail: list[str] = []
                for word in reversed(before.split(" ")):
                    longer = [word, *tail]
                    if count(" ".join(longer)) > overlap or count(" ".join([*longer, body])) > size:
                        break
                    tail = longer
                out.append(" ".join([*tail, body]))
            return out

        for found in batches:
            yield found.map(one)

    return lambda text: split(text_sentences(text))


def encoder_splitter(
    load_encoder: Callable[[], Encoder], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, call_chars: int = CALL_CHARS
) -> Callable[[Column], Column]:
    """Splitter over a real tokenizer that encodes every text once; pass it as ``splitter`` to ``chunk_rows``.

    ``load_encoder`` runs once per Python task and returns a function from texts to the places of their tokens, one list of
    (start, end) in characters per text, ordered by start. It is called with many texts at a time, of at most ``call_chars`` characters
    unless one text alone has more, so that the places of few texts are held at once. The rules are those of ``chunk_text``;
    a word of more than the limit is cut between tokens. The end of each chunk is found by binary search in the places.

    A chunk alone may count differently from its stretch of the text, by the tokens at its edges. All chunks of a call are
    therefore encoded once more, together; a text with a chunk that counts more than ``size`` is split anew with room for the
    difference. So calls grow with the text, and no chunk exceeds ``size`` unless a single character does.
    """
    _check(size, overlap)

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_encoder()

        def some(found: pd.Series) -> list[list[str] | None]:
            out: list[list[str] | None] = [None] * len(found)
            texts = {i: " ".join(s) for i, s in enumerate(found) if s is not None}
            rooms = dict.fromkeys(texts, 0)
            starts = {
                i: array("q", [a for a, _ in places])
                for i, places in zip(texts, encode(list(texts.values())) if texts else [])}
            while rooms:
                for i, room in rooms.items():
                    out[i] = _token_chunks(texts[i], found.iat[i], starts[i], max(size - room, overlap + 1), overlap)
                chunks = [(i, c) for i in rooms for c in out[i]]
                excess: dict[int, int] = {}
                for (i, chunk), places in zip(chunks, encode([c for _, c in chunks]) if chunks else []):
                    if len(places) > size and len(chunk) > 1:
                        excess[i] = max(excess.get(i, 0), len(places) - size)
                rooms = {i: 2 * rooms[i] + more for i, more in excess.items() if size - rooms[i] > overlap + 1}
            return out

        for found in batches:
            lengths = [0 if s is None else sum(map(len, s)) for s in found]
            out: list[list[str] | None] = []
            for start, stop in _runs(lengths, call_chars):
                out += some(found.iloc[start:stop])
            yield pd.Series(out, dtype=object)

    return lambda text: split(text_sentences(text))


def _runs(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Stretches of neighbours whose lengths add up to at most ``most``; a greater one stands alone."""
    start = total = 0
    for at, length in enumerate(lengths):
        if at > start and total + length > most:
            yield start, at
            start, total = at, 0
        total += length
    if lengths:
        yield start, len(lengths)


def _token_chunks(text: str, parts: list[str], starts: Sequence[int], size: int, overlap: int) -> list[str]:
    """Chunks of a text of ``parts``, joined by blanks, whose tokens start at ``starts``."""
    limit = size - overlap

    def tokens_to(place: int) -> int:
        return bisect_left(starts, place)

    def tokens_from(place: int) -> int:
        """The first token of a stretch; it may start with the blank before it."""
        return bisect_left(starts, place - 1 if place and text[place - 1] == " " else place)

    # ends of pieces: parts, or words and stretches of words of a part that is too long
    ends: list[int] = []
    at = 0
    for part in parts:
        end = at + len(part)
        begin = at
        while tokens_to(end) - tokens_from(begin) > limit:
            furthest = starts[tokens_from(begin) + limit]  # where the first token too many starts
            cut = text.rfind(" ", begin + 1, furthest + 1)
            cut = cut if cut > begin else max(furthest, begin + 1)
            ends.append(cut)
            begin = cut + (text[cut] == " ")
        ends.append(end)
        at = end + 1
    packed: list[tuple[int, int]] = []
    at = first = 0
    while first < len(ends):
        allowed = tokens_from(at) + limit
        furthest = starts[allowed] if allowed < len(starts) else len(text)
        last = max(bisect_right(ends, furthest), first + 1)
        packed.append((at, ends[last - 1]))
        at = ends[last - 1] + (text[ends[last - 1]:ends[last - 1] + 1] == " ")
        first = last
    out = [text[a:b] for a, b in packed[:1]]
    for (a, b), (c, d) in zip(packed, packed[1:]):
        wanted = max(tokens_to(b) - overlap, 0)
        begin = starts[wanted] if overlap and wanted < len(starts) else b
        if begin > a:  # whole words only
            begin = text.find(" ", begin - 1, b) + 1 or b
        out.append(text[max(begin, a):b] + " " + text[c:d] if max(begin, a) < b else text[c:d])
    return out


def token_windows(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Fixed windows of ``size`` tokens that advance by ``size - overlap``, ARRAY<STRING>."""
    _check(size, overlap)

    def cut(ws: Column) -> Column:
        last = F.greatest(F.size(ws) - overlap - 1, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(size - overlap))
        found = F.transform(starts, lambda first: F.array_join(F.slice(ws, first + 1, size), " "))
        return F.when(F.size(ws) > 0, found).otherwise(F.array().cast("array<string>"))

    return bind(words(clean_text(text)), cut)


def chunk_rows(
    df: DataFrame,
    text_col: str,
    url_col: str,
    splitter: Callable[[Column], Column] = chunk_text,
    content_col: str = "content",
) -> DataFrame:
    """One row per chunk: ``id``, ``chunk_pos`` and the chunk in ``content_col``; other columns are kept.

    A NULL text or an empty chunk list gives no row. The explode is narrow: no shuffle, and the text is dropped.
    The splitter stands inside the explode: over a column, Catalyst would add a non-empty filter and split twice.
    """
    kept = [c for c in df.columns if c not in (text_col, content_col, "id", "chunk_pos")]
    if url_col not in kept:
        raise ValueError(f"{url_col!r} must be a column apart from the text")
    rows = df.select(*kept, F.posexplode(splitter(F.col(text_col))).alias("chunk_pos", content_col))
    return rows.select(stable_id(F.col(url_col), F.col("chunk_pos")).alias("id"), *kept, "chunk_pos", content_col)


def chunk_report(chunks: DataFrame, by: str, content_col: str = "content") -> DataFrame:
    """Number of chunks and least, median and greatest token count per value of ``by``.

    Partial aggregation runs before the shuffle, and the median keeps one counter per distinct token count, of
    which there are at most as many as the chunk size: a group that holds most rows costs no more than others.
    """
    counted = chunks.select(by, word_count(F.col(content_col)).cast("bigint").alias("n"))
    return counted.groupBy(by).agg(
        F.count("*").alias("n_chunks"),
        F.min("n").alias("min_tokens"),
        F.percentile("n", F.lit(0.5)).alias("median_tokens"),
        F.max("n").alias("max_tokens"),
    )
