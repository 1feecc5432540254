"""Embedding a text column through a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passagework.functions.text import hash_bucket
from passagework.session import scratch_dir, write_once

Embedder = Callable[[list[str]], list[list[float]]]

# Most texts one call of the model takes.
MAX_CALL = 150


def embed(
    df: DataFrame,
    text_col: str,
    load_embedder: Callable[[], Embedder],
    out_col: str = "embedding",
    max_call: int = MAX_CALL,
    on_error: str = "raise",
) -> DataFrame:
    """Add ``out_col`` ARRAY<FLOAT>. Only the text goes to Python, in Arrow batches.

    ``load_embedder`` runs once per Python task and returns the model function, which gets at most ``max_call``
    texts at a time and must return as many vectors. A failing call fails the job, or gives NULL vectors with
    ``on_error="null"``. NULL texts are not sent. Write the result before using it twice: the model is outside
    of Spark, and a recomputed plan calls it again.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', got {on_error!r}")
    if max_call < 1:
        raise ValueError("max_call must be at least 1")

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_embedder()
        for texts in batches:
            out: list[list[float] | None] = [None] * len(texts)
            present = [i for i, known in enumerate(texts.notna()) if known]
            for start in range(0, len(present), max_call):
                rows = present[start:start + max_call]
                try:
                    got = list(model([texts.iat[i] for i in rows]))
                except Exception:
                    if on_error == "raise":
                        raise
                    continue
                if len(got) != len(rows):
                    raise ValueError(
                        f"the model returned {len(got)} vectors for {len(rows)} texts (call at row {start})"
                    )
                for i, vector in zip(rows, got):
                    out[i] = vector
            yield pd.Series(out, dtype=object)

    return df.withColumn(out_col, vectors.asNondeterministic()(F.col(text_col)))


def embed_distinct(
    df: DataFrame,
    text_col: str,
    load_embedder: Callable[[], Embedder],
    store: str | None = None,
    out_col: str = "embedding",
    max_call: int = MAX_CALL,
) -> DataFrame:
    """``embed``, where equal texts go to the model once: over all rows and, with a ``store``, over all runs.

    Vectors are kept under the 128-bit hash of their text. Texts whose hash the store lacks are made distinct, before the shuffle
    where they meet in a task, and embedded; every row then gets its vector by hash. A text that many rows share makes a
    skewed join, which adaptive execution splits on the side of the rows. ``store`` is a Parquet table that one run at a
    time appends to; a run that fails adds nothing, and the next one embeds what is missing.
    """
    spark = df.sparkSession
    store = store or f"{scratch_dir(spark)}/vectors"
    schema = "_hash string, _vector array<float>"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(store)
    texts = df.select(F.md5(text_col).alias("_hash"), F.col(text_col).alias("_text")).filter("_text IS NOT NULL")
    missing = texts.join(spark.read.schema(schema).parquet(store).select("_hash"), "_hash", "left_anti").distinct()
    embed(missing, "_text", load_embedder, "_vector", max_call).select("_hash", "_vector").write.mode("append").parquet(store)
    vectors = spark.read.schema(schema).parquet(store).withColumnRenamed("_vector", out_col)
    return df.drop(out_col).withColumn("_hash", F.md5(text_col)).join(vectors, "_hash", "left").drop("_hash")


def request_payloads(df: DataFrame, key_col: str, text_col: str, max_call: int = MAX_CALL) -> DataFrame:
    """Texts shaped as JSON requests ``{"columns": [..], "index": [..], "data": [[..]]}`` of ``max_call`` rows.

    Batches are cut inside hash buckets of about ``16 * max_call`` keys, so that no task orders the whole table. The
    input is evaluated once and written; its rows are then counted from the files. Keys must be unique.
    """
    rows = write_once(df.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")))
    buckets = F.lit(max(1, -(-rows.count() // (16 * max_call))))
    numbered = (
        rows.withColumn("bucket", hash_bucket(F.col("key"), buckets))
        .withColumn("pos", F.row_number().over(Window.partitionBy("bucket").orderBy("key")) - 1)
        .withColumn("batch", F.floor(F.col("pos") / max_call))
    )
    rows = F.array_sort(F.collect_list(F.struct("pos", "key", "text")))
    grouped = numbered.groupBy("bucket", "batch").agg(rows.alias("rows"))
    payload = F.to_json(F.struct(
        F.array(F.lit(text_col)).alias("columns"),
        F.transform("rows", lambda r: r["key"]).alias("index"),
        F.transform("rows", lambda r: F.array(r["text"])).alias("data"),
    ))
    return grouped.select("bucket", "batch", F.size("rows").cast("bigint").alias("n_rows"), payload.alias("payload"))
