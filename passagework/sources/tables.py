"""Tables: creation, writes that keep or replace history, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema if it does not exist, with its tables below ``location`` or the warehouse."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty Parquet table with declared columns if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace the content of a table."""
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Add rows and keep the history; ``latest_rows`` gives the current view."""
    df.write.mode("append").saveAsTable(name)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for costly work over a scan that has fewer splits than the session has cores.

    A scan of many files already has more splits than cores and is returned as it is, without a shuffle.
    ``key`` is unique, so the parts are even.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores, key) if df.rdd.getNumPartitions() < cores else df
