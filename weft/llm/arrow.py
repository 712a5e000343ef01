"""Arrow batches of bounded bytes, and Python workers that give memory back when a task is done."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from weft.llm import textops

#: Rows hold whole texts or sets, so batches are bounded by bytes; a larger row is a batch of its own.
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def release() -> None:
    """Return freed memory to the system; workers are reused and would keep a task's peak otherwise."""
    textops.forget_tables()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow with both. The batch size is a setting of the session, which plans read when they run; one that the
    session or the cluster has set itself is left alone."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    if BATCH_SETTING not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(released, schema)
