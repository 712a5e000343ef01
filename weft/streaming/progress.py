"""Event streams: the same functions run on batches and on streams.

Columns: ts (timestamp), key, value, event_id. Parquet times without a zone are cast to timestamps, which
watermarks need; the session's zone is UTC.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from weft.functions.text import uniform
from weft.sources.files import exists
from weft.workspace import Workspace

COLUMNS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

#: Files of a slice that is one micro-batch.
FILES = 4


def read_stream(spark: SparkSession, root: str, name: str, files: int = 16) -> DataFrame:
    """A file stream over the files of one table; at most so many new files per micro-batch, which holds back load."""
    stream = spark.readStream.schema(COLUMNS).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(root)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _written(workspace: Workspace, schema: StructType, out: str, keys: tuple[str, ...]) -> DataFrame:
    """What foreachBatch has written under out: of each key (of all rows without keys) the rows of its last batch."""
    spark = workspace.spark
    whole = StructType([*schema.fields, StructField("batch", LongType())])
    found = spark.read.schema(whole).parquet(out) if exists(spark, out) else spark.createDataFrame([], whole)
    last = found.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max("batch").alias("__last"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], F.col("batch") == F.col("__last"))
    return found.join(last if keys else F.broadcast(last), same).select(*schema.names)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def rocks_db(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which timers need; the session's own setting comes back after.

    A stream has a copy of its session's settings from its start on.
    """
    before = spark.conf.getAll.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def finish(stream: DataFrame, workspace: Workspace, name: str, mode: str = "append", keys: tuple[str, ...] = (), until: Column | None = None) -> DataFrame:
    """Run a stream over all that is there and return what it wrote.

    Append goes to files, exactly once thanks to the checkpoint: a restart continues behind what is written.
    Complete and update results are written per micro-batch, under the batch's number, so that a repeated batch replaces itself.
    Of complete results the last batch counts; of update results the last one of each key, which `keys` names.
    The first batch with a row for which `until` holds is the last one that is written: the stream is stopped, and a batch that
    has begun meanwhile writes nothing.
    """
    if mode == "update" and not keys:
        raise ValueError("an update stream needs the columns of its keys")
    out, at = workspace.path(name), workspace.path(f"{name}-checkpoint")
    writer = stream.writeStream.option("checkpointLocation", at).trigger(availableNow=True)
    if mode == "append" and until is None:
        writer.outputMode("append").format("parquet").option("path", out).start().awaitTermination()
        return workspace.spark.read.schema(stream.schema).parquet(out)
    reached = threading.Event()

    def write(df: DataFrame, n: int) -> None:
        if reached.is_set():
            df.write.format("noop").mode("overwrite").save()  # state is committed only when all of it is read
            return
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")
        if until is not None and df.sparkSession.read.schema(stream.schema).parquet(f"{out}/batch={n}").where(until).limit(1).count():
            reached.set()

    with rocks_db(stream.sparkSession):
        query = writer.outputMode(mode).foreachBatch(write).start()
    while not query.awaitTermination(0.2):
        if reached.is_set():
            query.stop()
            break
    if mode == "append":
        return workspace.spark.read.schema(stream.schema).parquet(f"{out}/batch=*")
    return _written(workspace, stream.schema, out, keys if mode == "update" else ())


def tumbling(events: DataFrame, width: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts, successes and rate per window and key; with a watermark, events later than that are dropped."""
    if late:
        events = events.withWatermark("ts", late)
    wins = F.count_if(F.col("value") > 50)
    found = events.groupBy(F.window("ts", width, slide), "event_type").agg(
        F.count(F.lit(1)).alias("n"), wins.alias("successes"), F.round(wins / F.count(F.lit(1)), 6).alias("rate")
    )
    return found.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "successes", "rate")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of a user: events with pauses of the gap at most."""
    if late:
        events = events.withWatermark("ts", late)
    found = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return found.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "value")


def reservoirs(events: DataFrame, size: int) -> DataFrame:
    """Per event type the `size` events of the largest u ** (1 / weight), kept in state; weight is the value."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, scores = state.get if state.exists else ([], [])
        for frame in frames:
            both = sorted(zip([*scores, *frame["score"].tolist()], [*ids, *frame["event_id"].tolist()], strict=True), reverse=True)[:size]
            scores, ids = [float(s) for s, _ in both], [int(i) for _, i in both]
        state.update((ids, scores))
        yield pd.DataFrame({"event_type": [key[0]] * len(ids), "event_id": ids, "score": scores})

    score = F.pow(uniform(F.lit("e"), F.col("event_id").cast("string")), 1.0 / F.greatest(F.col("value"), F.lit(0.01)))
    return events.select("event_type", "event_id", score.alias("score")).groupBy("event_type").applyInPandasWithState(
        step, "event_type string, event_id long, score double", "ids array<long>, scores array<double>", "update", GroupStateTimeout.NoTimeout
    )
