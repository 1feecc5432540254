"""Latest versions and changes between two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_version(df: DataFrame, key: str, version_col: str) -> DataFrame:
    """Greatest version per key, compared as integers: ``10`` is later than ``9``. Other texts do not count."""
    version = F.expr(f"try_cast(`{version_col}` AS BIGINT)")
    return df.groupBy(key).agg(F.max(version).alias("latest_version"))


def latest_rows(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """The last row per key by ``order_cols``, whole; of rows that tie in all of them one stays, the same one each time.

    Only keys, order columns and a hash of the row are aggregated; the rows come by joins on the key, whose partitioning serves
    all of them. Ties are broken by the hash, so what is left per key is one row or copies of it.
    """
    found = df.withColumn("_row", F.xxhash64(*df.columns))
    for col in [*order_cols, "_row"]:
        last = found.groupBy(F.col(key).alias("_key")).agg(F.max(col).alias("_last"))
        same = F.col(key).eqNullSafe(F.col("_key")) & F.col(col).eqNullSafe(F.col("_last"))
        found = found.join(last, same, "left_semi")
    return found.select(*df.columns).distinct()


def content_hash(*columns: str) -> Column:
    """MD5 over several columns; NULL differs from an empty text."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def hash_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``key, change`` of two tables of ``key, content_hash``: ``insert``, ``update`` or ``delete``.

    Keys are unique on each side, so none can skew; only keys and hashes are shuffled, once per side.
    """
    old = before.select(key, F.col("content_hash").alias("_old"))
    new = after.select(key, F.col("content_hash").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return old.join(new, key, "full").select(key, change.alias("change")).filter(F.col("change").isNotNull())


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, change`` between two states of a table, by the hash of ``columns``."""
    return hash_changes(*[df.select(key, content_hash(*columns).alias("content_hash")) for df in (before, after)], key)


def write_state(df: DataFrame, path: str, key: str, columns: list[str], n_buckets: int = 256) -> None:
    """Write a state of a table in buckets of its unique keys, with a digest of each bucket.

    A row carries the hash of ``columns``; the digest of a bucket is made of the keys and hashes of its rows alone, so it needs no
    texts and does not depend on the order of rows. States are compared by ``state_changes``.
    """
    if {"_bucket", "_hash"} & set(df.columns):
        raise ValueError("columns _bucket and _hash are added")
    rows = df.withColumns({"_bucket": F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int"), "_hash": content_hash(*columns)})
    rows.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
    row = F.xxhash64(key, "_hash")
    again = F.xxhash64(F.lit(1), F.col(key), "_hash").cast("decimal(38,0)")
    digests = written.groupBy("_bucket").agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(again).alias("s"))
    digests.select("*", F.lit(n_buckets).alias("n_buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def touched_buckets(spark: SparkSession, before: str, after: str) -> list[int]:
    """Buckets whose digests differ between two states, of which each has one row; a state without rows has none."""
    sides = [spark.read.parquet(f"{path}/digests") for path in (before, after)]
    if sides[0].select("n_buckets").unionByName(sides[1].select("n_buckets")).distinct().count() > 1:
        raise ValueError("the states have different numbers of buckets")
    same = ["_bucket", "n", "x", "s"]
    only = sides[0].select(same).exceptAll(sides[1].select(same)).unionByName(sides[1].select(same).exceptAll(sides[0].select(same)))
    return sorted(r[0] for r in only.select("_bucket").distinct().collect())


def _schema(spark: SparkSession, *paths: str) -> T.StructType:
    """The schema of the first state that has rows."""
    for path in paths:
        if not spark.read.parquet(f"{path}/digests").isEmpty():
            return spark.read.parquet(f"{path}/rows").schema
    raise ValueError("two states without rows have no columns to compare")


def state_changes(spark: SparkSession, before: str, after: str, key: str) -> DataFrame:
    """``key, change`` and the columns of the later state between two written states, NULL where a row is gone.

    Only buckets with different digests are opened; of the earlier state only keys and hashes are read there.
    """
    touched = touched_buckets(spark, before, after)
    schema = _schema(spark, before, after)
    old, new = (
        spark.read.schema(schema).parquet(f"{path}/rows").filter(F.col("_bucket").isin(touched)) for path in (before, after))
    found = hash_changes(
        *[side.select(key, F.col("_hash").alias("content_hash")) for side in (old, new)], key)
    return found.join(new.drop("_bucket", "_hash"), key, "left")
