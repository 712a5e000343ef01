"""Sums of arrays by key: what every task counts for itself becomes one array per key.

Arrays are summed within a task, then in SUM_GROUPS groups of tasks, then over the groups, so that no task holds more
than one array of each of its keys and one more, however many tasks there were.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow

SUM_GROUPS = 64


def pack(x: np.ndarray) -> bytes:
    """Bytes of an array for a table; most of what a small task counts is zero and takes no room."""
    return zlib.compress(x.tobytes(), 1)


def unpack(data, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def add_up(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    """Rows (key, values) to one row for each key; values are arrays of one length and kind, as pack gives them."""
    sums: dict = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for key, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = unpack(values.as_buffer(), kind)
            sums[key] = sums[key] + x if key in sums else x
    for key, values in sums.items():
        yield pa.record_batch([pa.array([key], schema.field(0).type), pa.array([pack(values)], pa.binary())], names=["key", "values"])


def summed(parts: DataFrame, kind: type, finish: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """One row (key, values) for each key of parts (key, values), with `finish` of the sum if it is given; all values are packed."""
    schema = f"key {parts.schema['key'].dataType.simpleString()}, values binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add_up(batches, kind)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add_up(batches, kind):
            done = batch.column(1) if finish is None else pa.array([pack(finish(unpack(x.as_buffer(), kind))) for x in batch.column(1)], pa.binary())
            yield pa.record_batch([batch.column(0), done], names=["key", "values"])

    own = parts.select("key", "values").transform(map_arrow, run, schema)
    grouped = own.repartition(F.col("key"), F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS))).transform(map_arrow, run, schema)
    return grouped.repartition("key").transform(map_arrow, last, schema)
