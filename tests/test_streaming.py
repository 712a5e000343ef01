"""Streams: late and repeated events, state across micro-batches, restarts."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weft.streaming import progress, state, work
from weft.workspace import Workspace

START = dt.datetime(2024, 1, 1)


def event(i, minutes, user=1, value=60.0, kind="a"):
    return (i, START + dt.timedelta(minutes=minutes), user, kind, value, "{}")


def land(spark, root, name, *events):
    """One more file of events.parquet in a folder of its own."""
    df = spark.createDataFrame(list(events), progress.COLUMNS)
    df.coalesce(1).write.parquet(f"{root}/{name}")


def stream(spark, root):
    return spark.readStream.schema(progress.COLUMNS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(root).withColumn("ts", F.col("ts").cast("timestamp"))


def test_events_beyond_the_watermark_are_dropped(spark, tmp_path):
    root, place = str(tmp_path / "in"), Workspace(spark, "t")
    land(spark, root, "1", event(1, 0), event(2, 200))
    windows = progress.tumbling(stream(spark, root), "1 hour", late="30 minutes")
    progress.finish(windows, place, "out")
    land(spark, root, "2", event(3, 190), event(4, 5))  # within the watermark, and two windows behind it
    land(spark, root, "3", event(5, 600))
    got = {r.start: r.n for r in progress.finish(windows, place, "out").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-01 03:00:00": 2}


def test_a_restart_continues_behind_what_is_written(spark, tmp_path):
    root, place = str(tmp_path / "in"), Workspace(spark, "t")
    land(spark, root, "1", event(1, 0), event(2, 1))
    plain = stream(spark, root).select("event_id")
    assert progress.finish(plain, place, "out").count() == 2
    land(spark, root, "2", event(3, 2))
    assert sorted(r.event_id for r in progress.finish(plain, place, "out").collect()) == [1, 2, 3]
    assert progress.finish(plain, place, "out").count() == 3


def test_repeated_events_stay_once(spark, tmp_path):
    root, place = str(tmp_path / "in"), Workspace(spark, "t")
    land(spark, root, "1", event(1, 0), event(1, 0), event(2, 1))
    land(spark, root, "2", event(2, 1), event(3, 2))
    once = stream(spark, root).withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"]).select("event_id")
    assert sorted(r.event_id for r in progress.finish(once, place, "out").collect()) == [1, 2, 3]


def runs_of(spark, root, name, delay="1 hour", until=None):
    found = state.failure_runs(stream(spark, root), "user_id", F.col("value") <= 50, delay)
    return {r.key: (r.longest, r.open) for r in progress.finish(found, Workspace(spark, "t"), name, "update", ("key",), until).collect()}


def plain_runs(events, user):
    run = most = 0
    for e in sorted((e for e in events if e[2] == user), key=lambda e: (e[1], e[0])):
        run = run + 1 if e[4] <= 50 else 0
        most = max(most, run)
    return most, run


def test_runs_of_failures_go_by_event_time_however_rows_arrive(spark, tmp_path):
    rng = random.Random(2)
    events = [event(i, 7 * i + rng.randrange(20), user=rng.randrange(3), value=rng.choice([10.0, 10.0, 90.0])) for i in range(60)]
    shuffled = [e for at in range(0, 60, 6) for e in rng.sample(events[at : at + 6], 6)]  # out of order within the watermark
    want = {u: plain_runs(events, u) for u in {e[2] for e in events}}
    for n, cuts in (("one", [60]), ("three", [13, 14, 60]), ("many", list(range(10, 61, 10)))):
        root, last = str(tmp_path / n), 0
        for cut in cuts:
            land(spark, root, f"{cut:03}", *shuffled[last:cut])
            last = cut
        assert runs_of(spark, root, n, "3 hours") == want


def test_keys_that_the_last_batch_does_not_touch_stay(spark, tmp_path):
    root = str(tmp_path / "in")
    before = spark.conf.get(progress.STATE_STORE)
    land(spark, root, "1", event(1, 0, user=0, value=10.0))
    land(spark, root, "2", event(2, 1, user=1, value=10.0), event(3, 2, user=1, value=10.0))
    assert runs_of(spark, root, "a") == {0: (1, 1), 1: (2, 2)}
    assert spark.conf.get(progress.STATE_STORE) == before
    assert progress.finish(state.failure_runs(stream(spark, root).where("false"), "user_id", F.lit(True), "1 hour"), Workspace(spark, "t"), "none", "update", ("key",)).count() == 0
    with pytest.raises(ValueError):
        progress.finish(stream(spark, root), Workspace(spark, "t"), "x", "update")


def test_a_stream_ends_at_so_many_failures(spark, tmp_path):
    root = str(tmp_path / "in")
    for n in range(6):
        land(spark, root, str(n), event(n, n, value=10.0))
    assert runs_of(spark, root, "a", until=F.col("longest") >= 3) == {1: (3, 3)}
    assert runs_of(spark, root, "b", until=F.col("longest") >= 30) == {1: (6, 6)}


def plain_reservoir(rows, size, grace):
    score = {}
    for item in {r["item"] for r in rows if r["inserts"]}:
        own = [r for r in rows if r["item"] == item]
        at = min(r["at"] for r in own if r["inserts"])
        last = max((r for r in own if at <= r["at"] <= at + grace), key=lambda r: (r["at"], not r["inserts"], r["weight"]))
        score[item] = (last["u"] ** (1 / last["weight"]), item, last["weight"])
    return sorted(((i, w) for _, i, w in sorted(score.values(), reverse=True)[:size]))


def test_reservoirs_follow_weights_that_change(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(50):
        u = rng.random()
        rows.append({"item": i, "at": 10 * i, "weight": rng.choice([0.5, 1.0, 4.0]), "u": u, "inserts": True})
        for _ in range(rng.randrange(3)):
            rows.append({"item": i, "at": 10 * i + rng.randrange(1, 90), "weight": rng.choice([0.1, 9.0]), "u": u, "inserts": False})
    rows.append({"item": 99, "at": 100, "weight": 50.0, "u": 0.99, "inserts": False})  # never inserted
    rows.sort(key=lambda r: r["at"])
    want = plain_reservoir(rows, 8, 60)
    assert want != plain_reservoir([r for r in rows if r["inserts"]], 8, 60)
    schema = "key string, ts timestamp, item long, weight double, u double, inserts boolean"
    for n, cuts in (("one", [len(rows)]), ("two", [30, len(rows)]), ("many", [*range(9, len(rows), 9), len(rows)])):
        root, last = str(tmp_path / n), 0
        for cut in cuts:
            own = [("k", START + dt.timedelta(minutes=r["at"]), r["item"], r["weight"], r["u"], r["inserts"]) for r in rows[last:cut]]
            spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{root}/{cut:03}")
            last = cut
        source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(root)
        found = progress.finish(state.reservoirs(source, 8, 3600, "30 minutes"), Workspace(spark, "t"), "out", "update", ("key",))
        assert sorted((r.item, r.weight) for r in found.collect()) == want, n


def test_work_that_was_broken_off_goes_on_without_a_gap_or_a_repeat(spark):
    place, calls = Workspace(spark, "t"), []

    def process(df, fail_at=None):
        calls.append(df.count())
        out = df.select((F.col("work") * 10).alias("x"))
        return out.withColumn("x", F.when(F.col("x") == fail_at, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("x"))) if fail_at is not None else out

    with pytest.raises(StreamingQueryException):
        work.work_through(work.hand_out(spark, 23, 5), place, "out", lambda df: process(df, 120))
    assert sum(calls) < 23
    out = work.work_through(work.hand_out(spark, 23, 5), place, "out", process)
    got = [(r.batch, r.x) for r in spark.read.parquet(out).collect()]
    assert sorted(x for _, x in got) == [10 * i for i in range(23)]
    assert {b: sum(1 for c, _ in got if c == b) for b in range(5)} == {0: 5, 1: 5, 2: 5, 3: 5, 4: 3}
    before = len(calls)
    work.work_through(work.hand_out(spark, 23, 5), place, "out", process)
    assert len(calls) == before  # nothing is left to hand out


def test_progress_counts_batches_against_the_total(spark, tmp_path):
    root, place = str(tmp_path / "in"), Workspace(spark, "t")
    land(spark, root, "1", event(1, 0), event(2, 1, value=10.0))
    land(spark, root, "2", event(3, 2))
    got = sorted(work.watched(stream(spark, root).select("event_id", "value"), F.col("value") > 50, place, "out", 4).collect())
    assert [(r.batch, r.episodes, r.successes, r.done, r.completion) for r in got] == [(0, 2, 1, 2, 50.0), (1, 1, 1, 3, 75.0)]
    assert all(r.seconds > 0 and abs(r.per_second - r.episodes / r.seconds) < 1e-6 for r in got)


def test_reservoirs_do_not_depend_on_batches(spark, tmp_path):
    one, two, workspace = str(tmp_path / "one"), str(tmp_path / "two"), Workspace(spark, "t")
    events = [event(i, i, value=float(i % 7 + 1)) for i in range(40)]
    land(spark, one, "1", *events)
    land(spark, two, "1", *events[:13])
    land(spark, two, "2", *events[13:])
    whole = {r.event_id for r in progress.finish(progress.reservoirs(stream(spark, one), 5), workspace, "a", "update", ("event_type",)).collect()}
    parts = {r.event_id for r in progress.finish(progress.reservoirs(stream(spark, two), 5), workspace, "b", "update", ("event_type",)).collect()}
    assert whole == parts and len(whole) == 5


def test_batch_sessions_close_at_the_gap(spark):
    rows = [event(1, 0), event(2, 29), event(3, 59), event(5, 90), event(4, 89, user=2)]
    df = spark.createDataFrame(rows, progress.COLUMNS).withColumn("ts", F.col("ts").cast("timestamp"))
    got = sorted((r.user_id, r.n) for r in progress.sessions(df, "30 minutes").collect())
    assert got == [(1, 1), (1, 3), (2, 1)]  # a pause of just the gap does not end a session
