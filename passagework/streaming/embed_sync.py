"""Incremental embedding: streams of chunks to the sync table.

What a stream has embedded is kept as state: order and content hash of the newest row of every key, in the state store of the
query's checkpoint. Keys are kept in ``BUCKETS`` by their hash, since a call of Python for every key takes longer than its work. A batch
meets the state of the buckets of its own keys only, and no stored table is read.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from passagework.functions.text import stable_id
from passagework.operators.embedding import Embedder, embed
from passagework.schemas import SYNC_TABLE

_CHANGED = "id string, url string, content string, content_hash string, order bigint"
_STORED = f"{_CHANGED}, embedding array<float>, version bigint"
_ROW = ["id", "url", "content", "content_hash", "order"]
_STATE = "ids array<string>, orders array<bigint>, content_hashes array<string>"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BEFORE_ALL = -(2**63)

# Groups of keys whose state is one row. The number is part of a checkpoint.
BUCKETS = 4096


def _content_hash() -> Column:
    return F.md5(F.coalesce("content", F.lit("")))


def _changed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest row of each key in this batch, if it is as new as the known one and its content differs from that."""
    newest: dict[str, tuple] = {}
    for frame in frames:
        for row in zip(*(frame[c] for c in _ROW)):
            # order, then hash
            if row[0] not in newest or row[:2:-1] > newest[row[0]][:2:-1]:
                newest[row[0]] = row
    known = dict(zip(state.get[0], zip(*state.get[1:]))) if state.exists else {}
    changed = []
    for name, row in newest.items():
        before = known.get(name)
        if before is None or row[-1] >= before[0]:
            if before is None or row[-2] != before[1]:
                changed.append(row)
            known[name] = (int(row[-1]), row[-2])
    orders, hashes = zip(*known.values())
    state.update(([*known], [*orders], [*hashes]))
    if changed:
        yield pd.DataFrame(changed, columns=_ROW)


def changed_rows(rows: DataFrame) -> DataFrame:
    """Of a stream of ``id, url, content, order``: the rows that are new or bring a newer content for their key.

    Of several contents of a key the one with the greatest ``order`` counts, of those that tie in a batch the one with the greatest
    hash, and of those that tie over batches the later one. An older content that arrives late is left out; a null order
    is before all others.
    """
    hashed = rows.withColumns({"content_hash": _content_hash(), "order": F.coalesce("order", F.lit(_BEFORE_ALL))})
    hashed = hashed.select(*_ROW, F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).alias("bucket"))
    return hashed.groupBy("bucket").applyInPandasWithState(_changed, _CHANGED, _STATE, "update", GroupStateTimeout.NoTimeout)


def _order(chunks: DataFrame, order_col: str | None) -> Column:
    """The order column as BIGINT, or the modification time of the file that a row comes from."""
    if order_col is None:
        try:
            chunks.select("_metadata.file_modification_time")
        except AnalysisException as error:
            raise ValueError("the stream has no file times: name an order column") from error
        return F.unix_micros("_metadata.file_modification_time")
    kind = chunks.schema[order_col].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(order_col)
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"an order column holds whole numbers or timestamps, {order_col} is {kind}")
    return F.col(order_col).cast("bigint")


def sync_embeddings(
    chunks: DataFrame, path: str, checkpoint: str, load_embedder: Callable[[], Embedder], url_col: str = "path",
    order_col: str | None = None,
) -> None:
    """Embed the chunks that arrived since the last run and append them to the Parquet table at ``path``.

    The key is made from address and position. A row reaches the model if its key is new to the query or its content is newer
    than, and other than, the one known (see ``changed_rows``), by ``order_col`` or else by the modification time of the file, which
    does not tell rows of one file or of one clock tick apart. Every query (a checkpoint that is started anew is another one)
    and batch owns the folder ``source=Q/batch=N``, which a repeated batch replaces: a retry leaves no duplicates, and
    several sources can feed one table. The order is stored, so the newest row of a key wins when the table is read, whichever
    source or batch brought it. The state lies on disk (RocksDB) unless the session names another store.
    """
    spark = chunks.sparkSession
    rows = chunks.select(
        stable_id(F.col(url_col), F.col("chunk_pos")).alias("id"), F.col(url_col).cast("string").alias("url"), "content",
        _order(chunks, order_col).alias("order"),
    )

    def write(batch: DataFrame, number: int) -> None:
        # the id of the query, the same over its restarts, is a local property of every batch
        source = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        version = time.time_ns() // 1000 * 1000 + zlib.crc32(source.encode()) % 1000  # of two sources at once, too, only one
        fresh = embed(batch, "content", load_embedder).withColumn("version", F.lit(version))
        fresh.write.mode("overwrite").parquet(f"{path}/source={source}/batch={number}")

    spark.createDataFrame([], _STORED).write.mode("ignore").parquet(f"{path}/source=none/batch=-1")
    named = spark.conf.get(_STATE_STORE, None)
    if named is None or named.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_STORE, _ON_DISK)
    try:
        stream = changed_rows(rows).writeStream.outputMode("update").trigger(availableNow=True)
        query = stream.option("checkpointLocation", checkpoint).foreachBatch(write).start()
    finally:
        if named is not None:
            spark.conf.set(_STATE_STORE, named)
        else:
            spark.conf.unset(_STATE_STORE)
    query.awaitTermination()


def read_sync_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every key, by order, then by the time it was written, with the source and batch that wrote it.

    Keys and two numbers are aggregated, by hash; rows come by a join on them.
    """
    stored = spark.read.schema(f"{_STORED}, source string, batch bigint").option("basePath", path).parquet(path)
    rank = F.col("order").cast("decimal(19,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col("version").cast("decimal(19,0)")
    stored = stored.withColumn("rank", rank.cast("decimal(38,0)"))
    last = stored.groupBy("id").agg(F.max("rank").alias("rank"))
    return stored.join(last, ["id", "rank"]).select(*SYNC_TABLE.names, "source", "batch")
