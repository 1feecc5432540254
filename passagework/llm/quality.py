"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic fit.

``document_stats`` measures each whole text. ``fit`` scales the statistics by the training rows, draws cosine features
whose inner products approximate a Gaussian kernel, sums the normal equations per partition and over the partitions,
and solves them; rows set aside calibrate the scores by pooling adjacent violators over fine bins of the raw score. Only
sums of fixed size reach the driver, whatever the number of rows. Every labelled row is used; nothing is sampled.

Cases: a null text counts as empty and has statistics of zero, so it gets the score of an empty text. Labels that are
null are left out; a document with several labels counts with their mean. Without training rows every score is 0.5;
without rows set aside the raw score is clipped to 0..1. Repeated rows are scored each. Empty tables give empty results.
A result column replaces a column with its name; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.llm.words import NOT_BLANK, Texts, find_words, hash_words, pieces, released

FEATURES = 128
RIDGE = 1e-4
SEED = 7
BIN = 0.002

_KINDS = {
    "upper": lambda b: (b >= 65) & (b <= 90),
    "digit": lambda b: (b >= 48) & (b <= 57),
    "wide": lambda b: b >= 128,
    "blank": lambda b: ~NOT_BLANK[b],
    "line": lambda b: b == 10,
    "stop": lambda b: np.isin(b, np.frombuffer(b".,;:?", dtype=np.uint8)),
    "mark": lambda b: np.isin(b, np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~", dtype=np.uint8)),
}
_BYTES = np.arange(256, dtype=np.uint8)
_TABLES = {name: kind(_BYTES) for name, kind in _KINDS.items()}
_IN_LINE = _BYTES != 10

STATS = [
    *_TABLES, "log_bytes", "log_words", "word_length", "word_length_spread", "long_words", "distinct_words",
    "repeated_neighbours", "most_frequent_word", "words_that_end_in_a_mark", "single_characters", "repeated_lines",
    "worst_part_marks", "worst_part_upper", "worst_part_repeats",
]

PART_WORDS = 64


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[edges[1:]] - total[edges[:-1]]


def _frequencies(symbols: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct symbols and the count of the most frequent one."""
    distinct, most = np.zeros(n), np.zeros(n)
    if len(symbols):
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        rest = np.uint64(64) - bits
        keys = np.sort((doc.astype(np.uint64) << rest) | (symbols >> bits))
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.concatenate([begins, [len(keys)]]))
        of = (keys[begins] >> rest).astype(np.int64)
        distinct += np.bincount(of, minlength=n)
        np.maximum.at(most, of, count)
    return distinct, most


def measure(texts: Texts) -> np.ndarray:
    """One row of ``STATS`` per text."""
    data, offsets = texts
    n, size = len(offsets) - 1, np.maximum(np.diff(offsets), 1).astype(np.float64)
    places = {name: np.flatnonzero(table[data]) for name, table in _TABLES.items()}
    kinds = {name: np.diff(np.searchsorted(at, offsets)) / size for name, at in places.items()}
    words = find_words(texts, NOT_BLANK)
    symbols = hash_words(data, words)
    count = np.diff(words.first)
    per_word = np.maximum(count, 1).astype(np.float64)
    length = (words.ends - words.starts).astype(np.float64)
    mean = _sums(length, words.first) / per_word
    marked = _TABLES["mark"][data[words.ends - 1]]
    again = np.zeros(len(symbols), dtype=bool)
    again[1:] = (symbols[1:] == symbols[:-1]) & (words.doc[1:] == words.doc[:-1])
    capitals = np.bincount(np.searchsorted(words.starts, places["upper"], side="right") - 1, minlength=len(symbols))
    loud = (capitals > 0.7 * length) & (length > 1)
    distinct, most = _frequencies(symbols, words.doc, n)
    lines = find_words(texts, _IN_LINE)
    line_count = np.maximum(np.diff(lines.first), 1)
    line_distinct, _ = _frequencies(hash_words(data, lines), lines.doc, n)
    # the worst stretch of PART_WORDS words: junk inside a long clean text
    parts = -(-count // PART_WORDS)
    doc = np.repeat(np.arange(n), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    edges = np.concatenate([words.first[doc] + nth * PART_WORDS, [len(symbols)]])
    in_part = np.maximum(np.diff(edges), 8)
    worst = []
    for values in (marked, loud, again):
        top = np.zeros(n)
        np.maximum.at(top, doc, np.diff(np.searchsorted(np.flatnonzero(values), edges)) / in_part)
        worst.append(top)

    def share(values: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(values), words.first)) / per_word

    columns = [
        *kinds.values(), np.log1p(np.diff(offsets)), np.log1p(count), np.minimum(mean, 40),
        np.minimum(np.sqrt(np.maximum(_sums(length**2, words.first) / per_word - mean**2, 0)), 40),
        share(length > 20), distinct / per_word, share(again), most / per_word, share(marked), share(length == 1),
        1 - line_distinct / line_count, *worst,
    ]
    return np.stack(columns, 1)


def document_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``stats``, an array of the values of ``STATS``. No shuffle."""
    return _with(df, "stats", T.ArrayType(T.DoubleType(), False), text, lambda x: pa.FixedSizeListArray.from_arrays(
        pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())))


def _with(df: DataFrame, name: str, kind: T.DataType, text: str, make) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != name]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [make(measure(texts))], [*names, name])

    return df.mapInArrow(released(run), T.StructType([*kept, T.StructField(name, kind)]))


@dataclass
class QualityModel:
    """Everything a task needs to score; a few hundred KB at most."""

    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, rising
    values: np.ndarray  # calibrated scores at the knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -5, 5)
        wave = np.cos(scaled @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([wave, np.ones((len(stats), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pool_adjacent(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and values of the blocks of a rising step function that fits best."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    found = np.array(blocks)
    return found[:, 0] / found[:, 2], found[:, 1] / found[:, 2]


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> QualityModel:
    """Fit on ``stats``, ``label`` (0..1) and ``aside`` (true: only for calibration)."""
    train = rows.filter(~F.col("aside"))
    n_stats = len(STATS)
    moments = train.agg(F.count("*"), *[
        f(F.col("stats")[i]) for i in range(n_stats) for f in (F.avg, F.stddev_pop)]).first()
    rng = np.random.default_rng(seed)
    frequency = rng.normal(0, 1 / np.sqrt(n_stats), (n_stats, features))
    model = QualityModel(
        np.array([m or 0.0 for m in moments[1::2]]), np.array([max(s or 0.0, 1e-3) for s in moments[2::2]]),
        frequency, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    if not moments[0]:
        return model
    upper = np.triu_indices(features + 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, side = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch.column("stats")))
                square += z.T @ z
                side += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        values = np.concatenate([square[upper], side])
        if values.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    summed = train.select("stats", "label").mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value"))
    values = np.zeros(len(upper[0]) + features + 1)
    for at, value in summed.collect():
        values[at] = value
    square = np.zeros((features + 1, features + 1))
    square[upper] = values[:len(upper[0])]
    square = square + np.triu(square, 1).T
    model.weights = np.linalg.solve(square + ridge * moments[0] * np.eye(features + 1), values[len(upper[0]):])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.raw(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(scores), batch.column("label")], ["raw", "label"])

    held = rows.filter("aside").select("stats", "label").mapInArrow(raw, "raw double, label double")
    place = F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0))
    bins = held.groupBy(F.floor(place / BIN).alias("bin")).agg(F.avg("raw"), F.avg("label"), F.count("*")).collect()
    model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    if bins:
        table = np.array(sorted(tuple(map(float, b)) for b in bins))
        model.knots, model.values = pool_adjacent(table[:, 1], table[:, 2], table[:, 3])
    return model


def score_stats(df: DataFrame, model: QualityModel) -> DataFrame:
    """``stats`` replaced by ``score``."""
    kept = [f for f in df.schema.fields if f.name not in ("stats", "score")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(scores)], [*names, "score"])

    return df.mapInArrow(released(run), T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def score_documents(df: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Add ``score`` to documents in one pass over their texts."""
    return _with(df, "score", T.DoubleType(), text, lambda stats: pa.array(model.score(stats)))


def fold(doc_id) -> F.Column:
    """Remainder of the CRC-32 of the id's text by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows of ``fit``: folds 1 to 3 to learn, fold 4 to calibrate; fold 0 stays out."""
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    learn = stats.filter(fold("doc_id") != 0).join(known, "doc_id")
    return learn.select("stats", F.col("label").cast("double").alias("label"), (fold("doc_id") == 4).alias("aside"))
