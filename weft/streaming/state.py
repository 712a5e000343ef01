"""Stateful operators in event time: what they answer does not depend on how the rows are cut into micro-batches.

Rows wait in state until the watermark has passed them, are then settled in the order of their times, and a timer sees to that when a
key gets no more rows. Each batch emits a snapshot of the keys it touches, in which the waiting rows already count, so
the last snapshot is the batch answer over all rows that were not late. State is bounded by the rows within the watermark's delay
(and the grace of weights) and by the size of a reservoir.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

def _frame(found: Iterator[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(list(found), columns=columns)


def _together(*parts: pd.DataFrame) -> pd.DataFrame:
    """Rows of all parts; parts without rows have no types to offer."""
    return pd.concat([p for p in parts if len(p)] or [parts[0]], ignore_index=True)


class FailureRuns(StatefulProcessor):
    """Longest and open run of failures of a key; `waiting` rows (at, id, failed) are ordered by time and id when they settle."""

    WAITING = ["at", "id", "failed"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, id long, failed boolean")
        self.settled = handle.getValueState("settled", "run long, most long")

    def _step(self, key: tuple, new: list[pd.DataFrame], watermark: int) -> Iterator[pd.DataFrame]:
        rows = [(int(a), int(i), bool(f)) for a, i, f in self.waiting.get()]  # plain tuples: most keys have a few rows
        for part in new:
            rows += zip(part["at"].tolist(), part["id"].tolist(), part["failed"].astype(bool).tolist(), strict=True)
        rows.sort(key=lambda r: r[:2])
        due = bisect_left(rows, watermark, key=lambda r: r[0])
        if not new and not due:  # settled by the rows of this batch
            return
        run, most = _runs(*(self.settled.get() if self.settled.exists() else (0, 0)), [r[2] for r in rows[:due]])
        self.settled.update((run, most))
        left = rows[due:]
        self.waiting.clear()
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(left[0][0] + 1)
        now, top = _runs(run, most, [r[2] for r in left])
        yield pd.DataFrame({"key": [key[0]], "longest": [top], "open": [now]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._step(key, [r[self.WAITING] for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _runs(run: int, most: int, failed: Iterable[bool]) -> tuple[int, int]:
    """The open run and the longest one behind some more rows in order."""
    for f in failed:
        run = run + 1 if f else 0
        most = max(most, run)
    return run, most


def failure_runs(events: DataFrame, key: str, failed: Column, delay: str) -> DataFrame:
    """(key, longest, open) of runs of failures by event time; rows later than the delay are dropped."""
    rows = events.withWatermark("ts", delay).select(F.col(key).alias("key"), "ts", F.unix_millis("ts").alias("at"), F.col("event_id").alias("id"), failed.alias("failed"))
    kind = events.schema[key].dataType.simpleString()
    return rows.groupBy("key").transformWithStateInPandas(FailureRuns(), f"key {kind}, longest long, open long", "Update", "EventTime")


class Reservoir(StatefulProcessor):
    """The `size` items of a key with the largest u ** (1 / weight), where weights may change for `grace` milliseconds.

    A row inserts an item or gives it another weight; u is the item's own number. An item waits until the watermark has passed its
    grace, then its last weight within it is final and it competes for the reservoir. A weight without an item is dropped when the
    item can no more come.
    """

    WAITING = ["item", "at", "weight", "u", "inserts"]
    KEPT = ["item", "weight", "score"]

    def __init__(self, size: int, grace: int):
        self.size, self.grace = size, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "item long, at long, weight double, u double, inserts boolean")
        self.kept = handle.getListState("kept", "item long, weight double, score double")

    def _scored(self, rows: pd.DataFrame) -> pd.DataFrame:
        """item, weight, score and due (end of grace) of the items that are inserted by rows."""
        first = rows[rows["inserts"]].sort_values(["at", "weight"]).drop_duplicates("item")
        both = rows.merge(first[["item", "at"]], on="item", suffixes=("", "_in"))
        inside = both[(both["at"] >= both["at_in"]) & (both["at"] <= both["at_in"] + self.grace)]
        # of equal times the insertion comes first
        last = inside.assign(changes=~inside["inserts"].astype(bool)).sort_values(["at", "changes", "weight"]).drop_duplicates("item", keep="last")
        return pd.DataFrame({"item": last["item"], "weight": last["weight"], "score": last["u"] ** (1 / last["weight"]), "due": last["at_in"] + self.grace})

    def _best(self, *parts: pd.DataFrame) -> pd.DataFrame:
        return _together(*[p[self.KEPT] for p in parts]).sort_values(["score", "item"], ascending=False).head(self.size)

    def _step(self, key: tuple, new: list[pd.DataFrame], watermark: int) -> Iterator[pd.DataFrame]:
        rows = _together(_frame(self.waiting.get(), self.WAITING), *new)
        items = self._scored(rows)
        due = items["due"] < watermark
        if not new and not due.any():  # settled by the rows of this batch
            return
        kept = self._best(_frame(self.kept.get(), self.KEPT), items[due])
        open_ = items[~due]
        left = rows[rows["item"].isin(open_["item"]) | (~rows["item"].isin(items["item"]) & (rows["at"] >= watermark))]
        self.kept.clear()
        if len(kept):
            self.kept.put([(int(i), float(w), float(s)) for i, w, s in kept.itertuples(index=False)])
        self.waiting.clear()
        if len(left):
            self.waiting.put([(int(i), int(a), float(w), float(u), bool(n)) for i, a, w, u, n in left.itertuples(index=False)])
            self.handle.registerTimer(int(left["at"].min()) + self.grace + 1)
        now = self._best(kept, open_)
        yield now.assign(key=key[0], bucket=key[1])[["key", "bucket", *self.KEPT]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._step(key, [r[self.WAITING] for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def reservoirs(rows: DataFrame, size: int, grace_seconds: int, delay: str, buckets: int = 1) -> DataFrame:
    """(key, bucket, item, weight, score): weighted reservoirs of rows (key, ts, item, weight, u, inserts); rows later than the delay are dropped.

    A key's items are dealt to buckets, each with a reservoir of its own, so that no task takes a key's rows alone. The reservoir of a key
    is the best of its buckets' ones (`best_of_buckets`).
    """
    bucket = F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int").alias("bucket")
    own = rows.withWatermark("ts", delay).select("key", bucket, "ts", F.unix_millis("ts").alias("at"), "item", "weight", "u", "inserts")
    kind = rows.schema["key"].dataType.simpleString()
    processor = Reservoir(size, 1000 * grace_seconds)
    return own.groupBy("key", "bucket").transformWithStateInPandas(processor, f"key {kind}, bucket int, item long, weight double, score double", "Update", "EventTime")


def best_of_buckets(found: DataFrame, size: int) -> DataFrame:
    """(key, item, weight, score): the reservoirs of the keys from those of their buckets, `size` rows of each."""
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.desc("item")))
    return found.withColumn("__n", nth).where(F.col("__n") <= size).drop("__n", "bucket")
