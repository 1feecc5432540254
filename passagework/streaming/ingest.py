"""Incremental ingest: each file once, run to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from passagework.sources.files import stream_files


def append_stream(
    rows: DataFrame, checkpoint: str, table: str | None = None, path: str | None = None
) -> StreamingQuery:
    """Append all rows available now to a table, or to Parquet files at a path, and stop.

    The checkpoint makes a rerun continue where the last run ended.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    writer = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet")
    query = writer.toTable(table) if table else writer.start(path)
    query.awaitTermination()
    return query


def ingest_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    glob: str = "*",
    excluded: str | None = None,
    table: str | None = None,
    path: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the files that earlier runs have not seen. Keep the checkpoint outside the scanned folder."""
    return append_stream(stream_files(spark, folder, glob, excluded, files_per_batch), checkpoint, table, path)
