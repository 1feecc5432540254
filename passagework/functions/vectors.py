"""Vector expressions and the deterministic stand-in embedder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from passagework.functions.text import bind, tokens

# One dimension of the stand-in embedder per hex digit.
HEX_DIGITS = "0123456789abcdef"


def norm(vector: Column) -> Column:
    """Euclidean length, in DOUBLE."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def digit_embedding(text: Column) -> Column:
    """Stand-in for an embedding model, as a native expression: ARRAY<FLOAT> of 16 counts.

    Tokens are runs of characters that are not white space; the dimension of a token is the first hex digit of
    the MD5 of its lower-case form.
    """
    digits = F.array_join(F.transform(tokens(text), lambda w: F.left(F.md5(F.lower(w)), F.lit(1))), "")
    return bind(
        digits,
        lambda d: F.array(*[
            (F.length(d) - F.length(F.replace(d, F.lit(h), F.lit("")))).cast("float") for h in HEX_DIGITS
        ]),
    )


def load_digit_embedder() -> Callable[[list[str]], list[list[float]]]:
    """The same embedder as a model function from texts to vectors."""

    @lru_cache(maxsize=100_000)
    def dimension(token: str) -> int:
        return int(hashlib.md5(token.lower().encode()).hexdigest()[0], 16)

    def embed(texts: list[str]) -> list[list[float]]:
        vectors = []
        for text in texts:
            vector = [0.0] * len(HEX_DIGITS)
            for token in text.split():
                vector[dimension(token)] += 1.0
            vectors.append(vector)
        return vectors

    return embed
