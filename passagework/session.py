"""What jobs need from the session: a folder all executors share, and size-checked join choices."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row limit below which a table of a few plain columns is sent to every executor.
SMALL_TABLE_ROWS = 200_000


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, for intermediate tables and stream checkpoints.

    A local session without the setting gets a temporary folder that goes when the process ends; on a cluster it is an
    error, since executors would not see each other's files.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="passagework-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/passagework-{uuid.uuid4().hex}"


def write_once(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a result and read it back: cuts the lineage, so lost executors or reuse repeat no model call."""
    path = path or f"{scratch_dir(df.sparkSession)}/table"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> bool:
    """Whether a table has at most ``max_rows`` rows. Reads no more rows than that."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Send batches of at most ``rows`` rows, and of one row beyond ``size`` bytes, to Python while the block runs its jobs.

    For tables whose rows are large, such as whole files on their way to an extractor. The settings are restored after.
    """
    wanted = {"maxRecordsPerBatch": rows, "maxBytesPerBatch": size}
    before = {key: spark.conf.get(f"spark.sql.execution.arrow.{key}", None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(f"spark.sql.execution.arrow.{key}")
            else:
                spark.conf.set(f"spark.sql.execution.arrow.{key}", value)
