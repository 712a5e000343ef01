"""Shared work as a stream: house batches that are handed out once each, and a watch on how far the work is."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQueryListener

from weft.streaming.progress import finish
from weft.workspace import Workspace


class WorkReader(SimpleDataSourceStreamReader):
    """Numbers 0 .. total - 1, `size` of them a batch; the offset is the first number that is not handed out yet."""

    def __init__(self, total: int, size: int):
        self.total, self.size = total, size

    def initialOffset(self) -> dict:
        return {"next": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"next": min(start["next"] + self.size, self.total)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(i,) for i in range(start["next"], end["next"])])


class WorkItems(DataSource):
    """Options: total, size."""

    @classmethod
    def name(cls) -> str:
        return "work_items"

    def schema(self) -> str:
        return "work long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return WorkReader(int(self.options["total"]), int(self.options.get("size", "1")))


def hand_out(spark: SparkSession, total: int, size: int) -> DataFrame:
    """The stream of work numbers; only these pass the driver."""
    spark.dataSource.register(WorkItems)
    return spark.readStream.format("work_items").option("total", total).option("size", size).load()


def work_through(stream: DataFrame, workspace: Workspace, name: str, process: Callable[[DataFrame], DataFrame]) -> str:
    """Process each batch of work and write what comes of it, one folder for each batch, until all is done; returns the folder of folders.

    A folder has the number of its batch, so that a batch that is repeated after a crash replaces what it had begun; the checkpoint
    keeps what is handed out. Called again with the same workspace and name it goes on where it was.
    """
    out = workspace.path(name)

    def write(df: DataFrame, n: int) -> None:
        process(df).write.mode("overwrite").parquet(f"{out}/batch={n}")

    query = stream.writeStream.option("checkpointLocation", workspace.path(f"{name}-checkpoint")).foreachBatch(write).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return out


OBSERVED = "episodes"


class Watch(StreamingQueryListener):
    """Keeps the observed counts of the queries that run while it listens; `ended` is set when one has ended."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(OBSERVED)
        if found is not None and found["episodes"]:
            self.rows.append((event.progress.batchId, found["episodes"], found["successes"], event.progress.batchDuration / 1000))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def watched(stream: DataFrame, success: Column, workspace: Workspace, name: str, total: int) -> DataFrame:
    """Run an append stream and return its progress, a row for each batch:

    batch, episodes, successes, done (episodes so far), completion (percent of total), seconds, per_second.
    """
    spark = stream.sparkSession
    watch = Watch()
    spark.streams.addListener(watch)
    try:
        counted = stream.observe(OBSERVED, F.count(F.lit(1)).alias("episodes"), F.count_if(success).alias("successes"))
        finish(counted, workspace, name)
        watch.ended.wait(60)
    finally:
        spark.streams.removeListener(watch)
    rows, done = [], 0
    for batch, episodes, successes, seconds in sorted(watch.rows):
        done += episodes
        rows.append((batch, episodes, successes, done, 100.0 * done / total if total else 100.0, seconds, episodes / max(seconds, 1e-3)))
    table = spark.createDataFrame(rows, "batch long, episodes long, successes long, done long, completion double, seconds double, per_second double")
    return workspace.save(table, f"{name}-progress")
