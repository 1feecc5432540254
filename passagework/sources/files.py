"""Scans of file folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.schemas import RAW_FILES


def without_name(name: Column, excluded: str) -> Column:
    """Condition that keeps names without the given part."""
    return ~F.contains(name, F.lit(excluded))


def scan_files(spark: SparkSession, folder: str, glob: str = "*", excluded: str | None = None) -> DataFrame:
    """Files of a folder whose name matches ``glob``: ``path, modificationTime, length, content``.

    The glob works at listing. The bytes are read only if ``content`` is used.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.filter(without_name(F.element_at(F.split("path", "/"), -1), excluded)) if excluded else files


def stream_files(
    spark: SparkSession, folder: str, glob: str = "*", excluded: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """The same as a stream that reports every path once. A changed file under an old path is not read again.

    ``files_per_batch`` cuts a large backlog into several commits, so that a failure repeats only the last one.
    """
    reader = spark.readStream.schema(RAW_FILES).format("binaryFile").option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(folder)
    return files.filter(without_name(F.element_at(F.split("path", "/"), -1), excluded)) if excluded else files
