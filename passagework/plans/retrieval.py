"""From documents and query texts to the nearest chunks, as one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.operators.chunking import chunk_rows, chunk_text
from passagework.operators.embedding import Embedder, embed
from passagework.operators.search import similarity_search
from passagework.session import write_once

# Adds ``embedding`` for a text column of a table. Documents and queries must get the same one.
Embedding = Callable[[DataFrame, str], DataFrame]


def expression_embedding(vector: Callable[[Column], Column]) -> Embedding:
    """Embedding by a native expression."""
    return lambda df, text_col: df.withColumn("embedding", vector(F.col(text_col)))


def model_embedding(load_embedder: Callable[[], Embedder]) -> Embedding:
    """Embedding by a model of the caller. Written at once: later steps use the vectors more than once."""
    return lambda df, text_col: write_once(embed(df, text_col, load_embedder))


def embedded_chunks(
    documents: DataFrame,
    text_col: str,
    url_col: str,
    embedding: Embedding,
    splitter: Callable[[Column], Column] = chunk_text,
) -> DataFrame:
    """Chunks with vectors, written once: scoring and fetching the hits both read them."""
    chunks = chunk_rows(documents.select(url_col, text_col), text_col, url_col, splitter)
    return write_once(embedding(chunks, "content"))


def nearest_chunks(
    chunks: DataFrame,
    queries: DataFrame,
    query_id_col: str,
    query_text_col: str,
    embedding: Embedding,
    k: int = 3,
    columns: list[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """The k chunks nearest to each query text, among those that ``where`` lets through."""
    asked = queries.select(F.col(query_id_col).alias("query_id"), F.col(query_text_col).alias("query_text"))
    return similarity_search(chunks, embedding(asked, "query_text"), k, columns, where)
