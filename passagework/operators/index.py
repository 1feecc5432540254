"""A vector table that follows its source: built once, refreshed by the changes alone.

The index is an ordinary table partitioned by ``version`` with the rows that changed: new and updated rows with their vectors and
the hash of their content, and a mark for deleted keys. The newest row of a key counts. A second small table has one row per
version that was written to its end, so readers never see half a version and a failed refresh changes nothing; its next
run replaces what it left.

Reading merges by the keys that later versions changed: older rows with such a key are left out by an anti-join, and keys that
never changed are neither aggregated nor joined on their versions. Few changed keys are broadcast. Many are first sent as
a bitmap of their hashes: rows whose bit is not set pass where they are scanned, and only the others are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.functions.vectors import norm
from passagework.operators.changes import content_hash, hash_changes
from passagework.operators.embedding import Embedder, embed
from passagework.session import SMALL_TABLE_ROWS, write_once

_COMMITS = "version bigint, n_rows bigint, whole boolean"
#: Bits of the bitmap per changed key, and the most changed keys that a bitmap is sent for: 32 MB.
BITS_PER_KEY, MOST_BITMAP_KEYS = 8, 32 << 20
_PAGE_BITS = 32_768  # of Spark's bitmap functions


def _commits(spark: SparkSession, path: str) -> list:
    """The versions that readers see, ascending: the last one that holds the whole index and those after it."""
    try:
        rows = spark.read.schema(_COMMITS).parquet(f"{path}/commits").orderBy("version").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    last = max((i for i, row in enumerate(rows) if row["whole"]), default=0)
    return rows[last:]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that readers see, ascending."""
    return [row["version"] for row in _commits(spark, path)]


def _bit(key: str, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_bits))


def without_changed(
    rows: DataFrame, changed: DataFrame, n_changed: int, max_broadcast: int = SMALL_TABLE_ROWS,
    max_bitmap: int = MOST_BITMAP_KEYS,
) -> DataFrame:
    """``rows`` without those that ``changed`` (``id``, ``last``) has in a later version; ``n_changed`` bounds its rows."""
    last = changed.select(F.col("id").alias("_id"), F.col("last").alias("_last"))

    def kept(df: DataFrame, side: DataFrame) -> DataFrame:
        return df.join(side, (F.col("id") == F.col("_id")) & (F.col("version") < F.col("_last")), "left_anti")

    if n_changed <= max_broadcast:
        return kept(rows, F.broadcast(last))
    if n_changed > max_bitmap:
        return kept(rows, last)
    n_bits = -(-n_changed * BITS_PER_KEY // _PAGE_BITS) * _PAGE_BITS
    bits = changed.select(_bit("id", n_bits).alias("bit"))
    pages = bits.groupBy(F.bitmap_bucket_number("bit").alias("_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    pages = F.broadcast(write_once(pages))
    bit = _bit("id", n_bits)
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    marked = rows.join(pages, F.bitmap_bucket_number(bit) == F.col("_page"), "left").withColumn("_maybe", is_set)
    sure, maybe = (marked.filter(f).select(*rows.columns) for f in (~F.col("_maybe"), F.col("_maybe")))
    return sure.unionByName(kept(maybe, last))


def _newest(spark: SparkSession, path: str, *columns: str, **limits: int) -> DataFrame:
    """The newest row of every key that is not deleted, with ``columns`` only."""
    seen = _commits(spark, path)
    if not seen:
        raise FileNotFoundError(f"no complete index version below {path}")
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("version").isin([row["version"] for row in seen]))
    rows = rows.select("id", "version", "deleted", *columns)
    later = rows.filter(F.col("version") > seen[0]["version"])
    if len(seen) > 1:
        changed = later.groupBy("id").agg(F.max("version").alias("last"))
        rows = without_changed(rows, changed, sum(row["n_rows"] for row in seen[1:]), **limits)
    return rows.filter("NOT deleted").select("id", *columns)


def read_index(spark: SparkSession, path: str, **limits: int) -> DataFrame:
    """The index as its latest complete version leaves it. ``limits`` are those of ``without_changed``."""
    return _newest(spark, path, "url", "content", "embedding", "norm", **limits)


def _write_version(rows: DataFrame, path: str, number: int, whole: bool = False) -> None:
    spark = rows.sparkSession
    rows = rows.withColumns({"norm": norm(F.col("embedding")), "content_hash": content_hash("url", "content")})
    folder = f"{path}/rows/version={number}"
    rows.write.mode("overwrite").parquet(folder)
    n_rows = spark.read.schema(rows.schema).parquet(folder).count()  # from the files' footers
    commit = spark.createDataFrame([(number, n_rows, whole)], _COMMITS)
    commit.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _vectors(rows: DataFrame, embedding_col: str | None, load_embedder: Callable[[], Embedder] | None) -> DataFrame:
    if (embedding_col is None) == (load_embedder is None):
        raise ValueError("give either a column of vectors or a model that computes them")
    if load_embedder is not None:
        rows = embed(rows, "content", load_embedder)
    elif embedding_col != "embedding":
        rows = rows.withColumnRenamed(embedding_col, "embedding")
    return rows.select("id", "url", "content", "embedding")


def build_index(
    source: DataFrame,
    path: str,
    embedding_col: str | None = None,
    load_embedder: Callable[[], Embedder] | None = None,
) -> DataFrame:
    """Write version 1 from a table ``id, url, content`` and either its vectors or an embedding model."""
    spark = source.sparkSession
    if versions(spark, path):
        raise FileExistsError(f"{path} already holds an index")
    rows = _vectors(source, embedding_col, load_embedder)
    _write_version(rows.withColumn("deleted", F.lit(False)), path, 1, whole=True)
    return read_index(spark, path)


def refresh_index(
    source: DataFrame,
    path: str,
    embedding_col: str | None = None,
    load_embedder: Callable[[], Embedder] | None = None,
) -> DataFrame:
    """Bring an index in line with its source; returns the changes ``id, change``.

    Only inserted and updated rows are embedded and written, deleted keys are marked; other rows stay in their files.
    Of the index only keys and stored hashes are read. Without changes no version is written.
    """
    spark = source.sparkSession
    known = _newest(spark, path, "content_hash")
    changes = write_once(hash_changes(known, source.select("id", content_hash("url", "content").alias("content_hash")), "id"))
    if changes.isEmpty():
        return changes
    fresh = source.join(changes.filter(F.col("change") != "delete").select("id"), "id", "left_semi")
    new = _vectors(fresh, embedding_col, load_embedder)
    gone = changes.filter(F.col("change") == "delete").select(
        "id", *[F.lit(None).cast(new.schema[c].dataType).alias(c) for c in ("url", "content", "embedding")])
    rows = new.withColumn("deleted", F.lit(False)).unionByName(gone.withColumn("deleted", F.lit(True)))
    _write_version(rows, path, versions(spark, path)[-1] + 1)
    return changes


def compact_index(spark: SparkSession, path: str) -> None:
    """Write the whole index as one new version, after many refreshes. Older versions are then read no more."""
    rows = read_index(spark, path).drop("norm").withColumn("deleted", F.lit(False))
    _write_version(rows, path, versions(spark, path)[-1] + 1, whole=True)
