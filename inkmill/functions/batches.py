"""Arrow batches of texts that stay small, and memory that workers give back."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch; a longer row is a batch by itself.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession | None = None) -> None:
    """Arrow batches of the session (or the active one) have at most BATCH_BYTES: rows are whole texts, and a batch is held by the JVM and by Python."""
    spark = spark or SparkSession.getActiveSession()
    if spark and int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system: a worker lives on for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
