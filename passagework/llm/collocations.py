"""Phrase collocations by top-order marginalisation: only the longest windows are counted, shorter ones are their sums.

Every word starts one window of three words: itself and the next two of its piece as lead columns, padded with an empty word at the
end of the piece. The lead columns are taken inside the task that holds the text; a window function over all words would
shuffle and sort each of them. Only counts of distinct windows are shuffled, dealt by their first two words, so that windows
that begin with one pair lie together and are summed where they are. ``ROLLUP`` then sums pairs to words and words to
languages. Each phrase starts exactly where its window does, so these sums are the exact counts of pairs, words and
occurrences, and nothing is exploded per length.

A pair that begins a large share of the windows, each with another third word, would gather in one task. Such pairs, at most
``1 / HOT`` of them, are found in the windows of at most about ``SAMPLE`` texts chosen by hash, and dealt by their third word, too; their
partial sums meet in the roll-up. The sample decides only how work is spread.

To keep the windows narrow, words travel as numbers. A first pass counts words; those with ``least`` occurrences in some
language get a number, by frequency, at most ``most_codes`` of them. If that is all of them, other words are too rare to be in any
candidate: they stand as padding, so windows end before them and only the sum of the language counts them, and a window is two
numbers. If not, windows are texts: words with a number as one character, others spelled out. The results are the same either
way. Words are found in the code table by 128 bits of hash.

A phrase of two or three words with a count ``a`` of ``least`` or more is a candidate. Cutting it after its first k words gives the
counts ``l`` and ``r`` of its two parts and the score ``floor(1000000 * a * a / (l * r))``; the lowest cut counts, ties to the smallest k.
A candidate that lies inside a longer one with at least ``percent`` of its count is dropped. Of each language the first ``top`` by
score, count and phrase come out, ranked in buckets by hash before they meet, so no task ranks all phrases of a language.

Counts of words and pairs meet the candidates by joins on phrases of at least ``least`` occurrences only; a word that a large
share of the candidates hold makes a skewed join, which adaptive execution splits on the candidates' side. Products are DECIMAL(38, 0),
exact for counts up to 10^16.

Cases: a null or empty text has no words, a null language is ``und``. Upper case is lowered for A to Z only. Repeated rows
count each time. Empty tables give empty results; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.llm.words import LOWER, OTHER, Texts, Words, find_words, hash_words, pieces
from passagework.session import write_once

LEAST, PERCENT, TOP = 10, 50, 2000
SCALE = 1_000_000
#: Most words that get a number, below 2 ** BITS; their hashes and spellings are sent to every executor (24 bytes and the word each).
MOST_CODES, BITS = 1_000_000, 20
#: Most languages that get a number.
MOST_LANGS = 4096
_FIRST_CODE = 0x100
#: Texts whose windows tell which pairs are hot, the share of those windows that makes a pair hot, and parts of a hot pair.
SAMPLE, HOT, PARTS = 20_000, 0.001, 64

#: Bytes of words `[^\x20\x09]+` inside pieces, and those between pieces.
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_BETWEEN
_IN_WORD[[0x20, 0x09]] = False


def _character(code: int) -> str:
    """The character of a code; surrogates are none."""
    code += _FIRST_CODE
    return chr(code + 0x800 if code >= 0xD800 else code)


def _code(character: str) -> int:
    code = ord(character)
    return (code - 0x800 if code >= 0xE000 else code) - _FIRST_CODE


def _hashes(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    return hash_words(data, words), hash_words(OTHER[data], words)


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct word, and which of them each word is."""
    _, first, which = np.unique(one, return_index=True, return_inverse=True)
    if (two[first][which] != two).any():  # words that share 64 bits
        _, first, which = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
    return first, which


class _Piece:
    """The words of some texts: which distinct word each is, the language of each, and whether the next one is of its piece."""

    def __init__(self, part: pa.RecordBatch, texts: Texts):
        self.data = LOWER[texts.data]
        self.words = words = find_words(Texts(self.data, texts.offsets), _IN_WORD)
        langs = part.column("lang").dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.doc]
        self.one, self.two = _hashes(self.data, words)
        self.first, self.which = _distinct(self.one, self.two)
        between = np.concatenate([[0], np.cumsum(_BETWEEN[self.data])])
        self.follows = np.zeros(len(words.doc), dtype=bool)  # whether a word goes on the piece of the one before
        self.follows[1:] = (words.doc[1:] == words.doc[:-1]) & (between[words.starts[1:]] == between[words.ends[:-1]])

    def spelled(self, some: np.ndarray) -> list[str]:
        """The given distinct words."""
        body, at = self.data.tobytes(), self.first[some]
        return [body[a:b].decode() for a, b in zip(self.words.starts[at].tolist(), self.words.ends[at].tolist())]


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def frequent_words(docs: DataFrame, text: str, lang: str, least: int) -> DataFrame:
    """``word, f``: words with ``least`` occurrences in some language, and their occurrences in such languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                piece = _Piece(part, texts)
                key, n = np.unique(piece.lang * max(1, len(piece.first)) + piece.which, return_counts=True)
                of, word = np.divmod(key, max(1, len(piece.first)))
                names = pa.array(piece.spelled(np.arange(len(piece.first))), type=pa.string())
                yield pa.RecordBatch.from_arrays(
                    [piece.langs.take(pa.array(of)), names.take(pa.array(word)), pa.array(n)], ["lang", "word", "n"])

    counted = _rows(docs, text, lang).mapInArrow(run, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return counted.groupBy("word").agg(F.sum("f").alias("f"))


class Codes:
    """Words that travel as a number: their spellings by number, and their hashes, sorted, with the number of each.

    ``langs``: the languages by number, if these and all words that matter have one; then windows are numbers.
    """

    def __init__(self, names: pa.Array, langs: list[str] | None, one: np.ndarray, two: np.ndarray, order: np.ndarray):
        self.names, self.langs, self.one, self.two, self.order = self.parts = names, langs, one, two, order

    @classmethod
    def of(cls, names: pa.Array, langs: list[str] | None) -> Codes:
        names = names.cast(pa.large_string())
        offsets = np.frombuffer(names.buffers()[1], dtype=np.int64)[names.offset:names.offset + len(names) + 1]
        body = names.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
        spans = Words(offsets[:-1], offsets[1:], np.zeros(len(names), dtype=np.int64), np.zeros(2, dtype=np.int64))
        one, two = _hashes(data, spans)
        order = np.lexsort((two, one))
        return cls(names, langs, one[order], two[order], order)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The code of each word, or -1."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        while len(more := np.flatnonzero((self.one[at] == one) & (self.two[at] != two) & (at + 1 < len(self.one)))):
            step = more[self.one[at[more] + 1] == one[more]]  # another word with these 64 bits
            if not len(step):
                break
            at[step] += 1
        return np.where((self.one[at] == one) & (self.two[at] == two), self.order[at], -1)


def make_codes(words: DataFrame, langs: DataFrame, most: int = MOST_CODES) -> Codes:
    """Codes of at most ``most`` words, the most frequent first; ``words`` is a written table, ``langs`` all languages."""
    step = F.floor(8 * F.log2("f")).cast("int")
    steps = sorted((tuple(r) for r in words.groupBy(step.alias("step")).count().collect()), reverse=True)
    total, least = 0, None
    for at, n in steps:  # whole steps of frequency, so the bound needs no sort of all words
        if total + n > most:
            break
        total, least = total + n, at
    chosen = words.filter(step >= (least if least is not None else 1 << 30)).toArrow()
    names = chosen.sort_by([("f", "descending"), ("word", "ascending")]).column("word").combine_chunks()
    known = None
    if total == sum(n for _, n in steps):
        known = sorted(r[0] for r in langs.select("lang").distinct().limit(MOST_LANGS + 1).collect())
    return Codes.of(names, known if known is not None and len(known) <= MOST_LANGS else None)


def windows(docs: DataFrame, codes: Codes, text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts ``c`` of the windows of a piece of a task: ``lang, w1, w2, w3`` as texts, or ``p`` for the first three and ``w3`` as numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(codes.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Codes(*sent.value)
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                piece = _Piece(part, texts)
                code = known.find(piece.one[piece.first], piece.two[piece.first])
                if known.langs is not None:  # words without a number are too rare for any candidate
                    number = np.array([known.langs.index(x) for x in piece.langs.to_pylist()], dtype=np.int64)
                    use, width = code + 1, 1 << BITS
                else:
                    alone = np.flatnonzero(code < 0)
                    shown = np.array(["", *(_character(c) if c >= 0 else "" for c in code.tolist())], dtype=object)
                    shown[alone + 1] = [" " + word for word in piece.spelled(alone)]
                    use, width = np.arange(1, len(code) + 1), len(shown)
                first = use[piece.which]
                second = np.zeros_like(first)
                third = np.zeros_like(first)
                second[:-1] = np.where(piece.follows[1:], first[1:], 0)
                second[first == 0] = 0
                third[:-2] = np.where(piece.follows[2:] & (second[:-2] > 0), first[2:], 0)
                head, of_head = np.unique(piece.lang * width + first, return_inverse=True)
                pair, of_pair = np.unique(of_head * width + second, return_inverse=True)
                key, n = np.unique(of_pair * width + third, return_counts=True)
                at, third = np.divmod(key, width)
                at, second = np.divmod(pair[at], width)
                of, first = np.divmod(head[at], width)
                if known.langs is not None:
                    columns = {"p": pa.array(number[of] << 2 * BITS | first << BITS | second), "w3": pa.array(third.astype(np.int32))}
                else:
                    names = pa.array(shown, type=pa.string())
                    columns = {"lang": piece.langs.take(pa.array(of))}
                    columns |= {w: names.take(pa.array(x)) for w, x in (("w1", first), ("w2", second), ("w3", third))}
                yield pa.RecordBatch.from_pydict(columns | {"c": pa.array(n)})

    schema = "p long, w3 int, c long" if codes.langs is not None else "lang string, w1 string, w2 string, w3 string, c long"
    return _rows(docs, text, lang).mapInArrow(run, schema)


def hot_pairs(docs: DataFrame, codes: Codes, text: str, lang: str) -> list:
    """Pairs, as ``_pair`` shows them, that begin a large share of the distinct windows of a sample."""
    share = min(1_000_000, int(1_000_000 * SAMPLE / max(docs.count(), 1)) + 1)
    some = windows(docs.filter(F.pmod(F.xxhash64(text), F.lit(1_000_000)) < share), codes, text, lang)
    counts = some.groupBy(_pair(codes).alias("pair")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.filter(F.col("n") > max(HOT * total, PARTS)).select("pair").collect()]


def _pair(codes: Codes) -> Column:
    return F.col("p") if codes.langs is not None else F.concat_ws("\n", "w1", "w2", "lang")


def count_windows(docs: DataFrame, codes: Codes, hot: list, text: str = "text", lang: str = "lang") -> tuple[DataFrame, list[str]]:
    """The number of times ``c`` that each window occurs, in the form of ``windows``; and the columns by which windows are dealt.

    These are those of the pair, and if there are hot pairs ``part``, which is not negative for them.
    """
    found = windows(docs, codes, text, lang)
    pair = found.columns[:-2]
    if hot:
        of_third = F.pmod(F.xxhash64("w3"), F.lit(PARTS)).cast("int")
        found = found.withColumn("part", F.when(_pair(codes).isin(hot), of_third).otherwise(-1))
        pair.append("part")
    return found.repartition(*pair).groupBy(*pair, "w3").agg(F.sum("c").alias("c")), pair


def _named(counted: DataFrame, codes: Codes) -> DataFrame:
    """``lang, w1, w2`` in place of their number."""
    if codes.langs is None:
        return counted

    def bits(shift: int, mask: int) -> Column:
        return F.shiftright("p", shift).bitwiseAND(F.lit(mask)).cast("int")

    word = (1 << BITS) - 1
    return counted.withColumns({
        "lang": bits(2 * BITS, MOST_LANGS - 1), "w1": bits(BITS, word), "w2": bits(0, word)}).drop("p")


def _decoded(counts: DataFrame, codes: Codes) -> DataFrame:
    """Languages and words in place of what they travel as."""
    sent = counts.sparkSession.sparkContext.broadcast(codes.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Codes(*sent.value)

        def word(w: int | str | None) -> str | None:
            if not w or (isinstance(w, str) and w[0] == " "):
                return w[1:] if w else None
            return known.names[_code(w) if isinstance(w, str) else w - 1].as_py()

        for batch in batches:
            columns = {}
            for name in batch.schema.names:
                column = batch.column(name)
                if name in ("w1", "w2", "w3") or (name == "lang" and known.langs is not None):
                    column = column.dictionary_encode()
                    change = word if name != "lang" else known.langs.__getitem__
                    plain = pa.array([change(w) for w in column.dictionary.to_pylist()], type=pa.string())
                    column = plain.take(column.indices)
                columns[name] = column
            yield pa.RecordBatch.from_pydict(columns)

    return counts.mapInArrow(run, "lang string, words int, w1 string, w2 string, w3 string, f long")


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_codes: int = MOST_CODES,
) -> DataFrame:
    """``lang, words, w1, w2, w3, f``: counts of phrases of 1 to 3 words found ``least`` times, and with 0 words the sum of all."""
    words = write_once(frequent_words(docs, text, lang, least))
    codes = make_codes(words, _rows(docs, text, lang), min(most_codes, MOST_CODES))
    hot = hot_pairs(docs, codes, text, lang)
    counted, dealt = count_windows(docs, codes, hot, text, lang)
    none = F.lit(0 if codes.langs is not None else "")
    # one condition on count and word: one on the word alone would go below the count, which both branches share
    longest = _named(counted.filter(F.when(F.col("w3") != none, F.col("c")).otherwise(0) >= least), codes)
    longest = longest.select("lang", F.lit(3).alias("words"), "w1", "w2", "w3", F.col("c").alias("f"))
    pairs = counted.groupBy(*dealt).agg(F.sum("c").alias("f"))  # where they lie, without a shuffle
    # pairs that are too rare go on as words only; the condition on keys reaches below the sums
    known = (F.col("f") >= least) | (F.col("part") >= 0) if hot else F.col("f") >= least
    pairs = _named(pairs, codes).withColumn("w2", F.when((F.col("w2") != none) & known, F.col("w2")).otherwise(none))
    rolled = pairs.rollup("lang", "w1", "w2").agg(F.grouping_id().alias("without"), F.sum("f").alias("f"))
    rolled = rolled.filter(
        ((F.col("without") == 0) & (F.col("w2") != none)) | ((F.col("without") == 1) & (F.col("w1") != none)) | (F.col("without") == 3))
    rolled = rolled.filter((F.col("without") == 3) | (F.col("f") >= least))
    size = F.when(F.col("without") == 0, 2).when(F.col("without") == 1, 1).otherwise(0)
    last = F.lit(None).cast("int" if codes.langs is not None else "string")
    shorter = rolled.select("lang", size.alias("words"), "w1", "w2", last.alias("w3"), "f")
    return _decoded(longest.unionByName(shorter), codes)


def _score(left: str, right: str) -> Column:
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in ("a", left, right))
    return F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)"), l * r)


def find_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, percent: int = PERCENT, top: int = TOP,
    most_codes: int = MOST_CODES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of each language."""
    counts = write_once(phrase_counts(docs, text, lang, least, most_codes))
    words = counts.filter("words = 1").select("lang", "w1", "f")
    pairs = counts.filter("words = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    triples = counts.filter("words = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def word(column: str, name: str) -> DataFrame:
        return words.select("lang", F.col("w1").alias(column), F.col("f").alias(name))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))

    # pairs inside a triple that is found often enough
    inside = triples.select("lang", F.explode(F.array(
        F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    inside = inside.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer"))
    free = pairs.join(inside, ["lang", "w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    two = free.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("l", "r").alias("score"))
    three = (
        triples.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
        .withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    )
    late = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    found = two.unionByName(three).withColumn("_bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    first = found.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order)))
    first = first.filter(F.col("_place") <= top).drop("_place", "_bucket")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    total = F.broadcast(counts.filter("words = 0").select("lang", F.col("f").alias("n")))
    return ranked.filter(F.col("rank") <= top).join(total, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
