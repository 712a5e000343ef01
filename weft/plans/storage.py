"""Queries that go through files: discovery, layouts, writers and streams."""

from __future__ import annotations

import contextlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.functions.text import uniform
from weft.plans.registry import query
from weft.plans.standins import STEPS, dealt_parts, house_of, steps
from weft.sources import array_files, files
from weft.sources import trajectory_files as trajectory_files_
from weft.sources.tables import table
from weft.streaming import progress, state, work
from weft.workspace import Workspace


@query("house_partitions", """SELECT c_mktsegment AS split, c_nationkey AS house, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY ALL""")
def house_partitions(spark, sf_dir):
    """Written by split and house, read with the partitions as columns."""
    work = Workspace(spark, "houses")
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("split"), F.col("c_nationkey").alias("house"), "c_acctbal")
    files.write_partitioned(c, work.path("t"), "split", "house")
    back = spark.read.parquet(work.path("t"))
    return back.groupBy("split", "house").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("replaced_partitions", """SELECT s_nationkey, CASE WHEN s_nationkey < 5 THEN 'new' ELSE 'old' END AS version, count(*) AS n FROM supplier GROUP BY ALL""")
def replaced_partitions(spark, sf_dir):
    """Some partitions replaced in place, others untouched."""
    work = Workspace(spark, "replace")
    s = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey")
    files.write_partitioned(s.withColumn("version", F.lit("old")), work.path("t"), "s_nationkey")
    files.replace_partitions(s.where("s_nationkey < 5").withColumn("version", F.lit("new")), work.path("t"), "s_nationkey")
    return spark.read.parquet(work.path("t")).groupBy("s_nationkey", "version").agg(F.count(F.lit(1)).alias("n"))


@query("staged_write", "SELECT r_regionkey, r_name FROM region")
def staged_write(spark, sf_dir):
    """Written beside the target and renamed; a failed second write changes nothing."""
    work = Workspace(spark, "staged")
    r = table(spark, sf_dir, "region")
    files.write_staged(r, work.path("t"))
    try:
        files.write_staged(r.select("r_regionkey", F.raise_error(F.lit("broken")).cast("string").alias("r_name")), work.path("t"))
    except Exception as e:  # noqa: BLE001
        if "broken" not in str(e):
            raise
    return spark.read.parquet(work.path("t"))


@query("report_with_notes", "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def report_with_notes(spark, sf_dir):
    """A CSV with comment lines, read back."""
    work = Workspace(spark, "report")
    found = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    files.write_report(found, work.path("t"), ["success condition: end", "run: test"])
    return files.read_report(spark, work.path("t"), "n_regionkey int, nations long")


@query("benchmark_layouts", "SELECT item_id, length(text) AS size, layout FROM benchmark, (SELECT unnest(['list', 'files']) AS layout)")
def benchmark_layouts(spark, sf_dir):
    """Documents as one list or a file per episode."""
    work = Workspace(spark, "layouts")
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    whole = b.agg(F.to_json(F.collect_list(F.struct("item_id", "text"))).alias("value"))
    whole.coalesce(1).write.text(work.path("one/benchmark.json"))
    for i in range(3):
        part = b.where(F.col("item_id") % 3 == i).agg(F.to_json(F.collect_list(F.struct("item_id", "text"))).alias("value"))
        part.coalesce(1).write.text(work.path(f"many/house_{i}/episode_0.json"))
    parts = [files.documents(spark, work.path(d), "item_id long, text string").withColumn("layout", F.lit(n)) for d, n in (("one", "list"), ("many", "files"))]
    return parts[0].unionByName(parts[1]).select("item_id", F.length("text").cast("long").alias("size"), "layout")


@query("gzipped_lines", "SELECT p_partkey, p_size, CASE WHEN vec_id IS NULL THEN 0 ELSE 64 END::INT AS dims FROM part LEFT JOIN embeddings ON vec_id = p_partkey")
def gzipped_lines(spark, sf_dir):
    """Gzipped lines of JSON, joined with feature vectors by their key (not by position)."""
    work = Workspace(spark, "lines")
    table(spark, sf_dir, "part").select("p_partkey", "p_size").write.option("compression", "gzip").json(work.path("t"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("dims"))
    lines = files.json_lines(spark, work.path("t"), "p_partkey long, p_size int")
    return lines.join(vectors, F.col("p_partkey") == F.col("vec_id"), "left").select("p_partkey", "p_size", F.coalesce("dims", F.lit(0)).alias("dims"))


@query(
    "capped_houses",
    """WITH h AS (SELECT c_mktsegment AS split, c_custkey AS house, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer) SELECT split, house FROM h WHERE n <= 7""",
)
def capped_houses(spark, sf_dir):
    """The first houses of each split's gzipped lines, as many as a cap on rows of a split says."""
    work = Workspace(spark, "splits")
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("split"), F.col("c_custkey").alias("house"))
    c.write.partitionBy("split").option("compression", "gzip").json(work.path("t"))
    return files.first_of_each(spark.read.schema("house long, split string").json(work.path("t")), "split", "house", 7).select("split", "house")


@query("manifest_parts", "SELECT p_partkey % 3 AS shard, count(*) AS n, sum(CASE WHEN p_partkey % 2 = 0 THEN p_size END)::BIGINT AS inflated FROM part GROUP BY 1")
def manifest_parts(spark, sf_dir):
    """Parts of a manifest, some without a column."""
    work = Workspace(spark, "manifest")
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 3).alias("shard"), "p_partkey", "p_size")
    work.save(p.where("p_partkey % 2 = 0"), "a")
    work.save(p.where("p_partkey % 2 = 1").drop("p_size"), "b")
    return files.manifests(spark, work.path("a"), work.path("b")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("inflated"))


@query("key_values", """SELECT c_custkey AS key, c_name AS value, (SELECT count(*) FROM customer) AS stored, c_custkey IN (7, 100) AS known, (SELECT sum(length(c_name))::BIGINT FROM customer) AS letters FROM customer WHERE c_custkey IN (1, 7, 100)""")
def key_values(spark, sf_dir):
    """A key-value table with a codec and a completion marker: get, length, contains, values through an iterator."""
    store = files.KeyValues(spark, Workspace(spark, "kv").path("t"), codec=files.json_codec("name string"))
    store.put(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.struct(F.col("c_name").alias("name")).alias("value")))
    if not store.complete:
        raise OSError("the store was not written whole")

    def letters(frames):
        for frame in frames:
            yield frame[[]].assign(letters=[len(v["name"]) for v in frame["value"]])

    total = store.iterator(letters, "letters long").agg(F.sum("letters").alias("letters"))
    known = F.lit(False)
    for key in (7, 100):
        known = known | ((F.col("key") == key) & F.lit(key in store))
    found = store.get(1, 7, 100).select("key", F.col("value.name").alias("value"), F.lit(len(store)).cast("long").alias("stored"), known.alias("known"))
    return found.join(F.broadcast(total))


@query("file_discovery", "SELECT c_nationkey::VARCHAR AS house, 1::BIGINT AS files FROM customer GROUP BY c_nationkey")
def file_discovery(spark, sf_dir):
    """Files found below a root, without reading them."""
    work = Workspace(spark, "discovery")
    files.write_partitioned(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), work.path("t"), "c_nationkey")
    found = files.discover(spark, work.path("t"), "part-*.parquet")
    house = F.regexp_extract("path", r"c_nationkey=(\d+)/", 1)
    return found.groupBy(house.alias("house")).agg(F.count(F.lit(1)).alias("files"))


@query(
    "scene_prefixes",
    """WITH k AS (SELECT DISTINCT replace(p_name, ' ', '_') AS key FROM part), n AS (SELECT DISTINCT split_part(replace(p_name, ' ', '_'), '_', 1) AS name FROM part WHERE p_partkey % 2 = 0)
    SELECT key, arg_max(name, length(name)) AS name FROM k LEFT JOIN n ON key = name OR starts_with(key, name || '_') GROUP BY key""",
)
def scene_prefixes(spark, sf_dir):
    """Metadata under the longest known start of a name."""
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    p = table(spark, sf_dir, "part")
    keys = p.select(name.alias("key")).distinct()
    known = p.where("p_partkey % 2 = 0").select(F.split_part(name, F.lit("_"), F.lit(1)).alias("name")).distinct()
    return files.longest_prefix(keys, "key", known, "name").select("key", "name")


@query("written_once", "SELECT s_nationkey, count(*) AS n, false AS second_wrote FROM supplier GROUP BY s_nationkey")
def written_once(spark, sf_dir):
    """A table that is there whole is not written again."""
    work = Workspace(spark, "once")
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    files.write_once(s, work.path("t"))
    again = files.write_once(s.withColumn("n", F.lit(-1).cast("long")), work.path("t"))
    return spark.read.parquet(work.path("t")).withColumn("second_wrote", F.lit(again))


@query("appended_blacklist", "SELECT s_suppkey AS uid, CASE WHEN s_acctbal < 0 THEN 'first' ELSE 'second' END AS reason FROM supplier WHERE s_acctbal < 2000")
def appended_blacklist(spark, sf_dir):
    """Entries are appended under a lock, if they are absent."""
    work = Workspace(spark, "black")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("uid"), "s_acctbal")
    for most, reason in ((0, "first"), (2000, "second")):
        files.append_absent(s.where(F.col("s_acctbal") < most).select("uid", F.lit(reason).alias("reason")), work.path("t"), "uid")
    return spark.read.parquet(work.path("t"))


@query(
    "listed_houses",
    """WITH r AS (SELECT i, v FROM range(0, 30) AS r(i), (SELECT unnest(['', '_ceiling']) AS v))
    SELECT i, v AS variant, EXISTS (SELECT 1 FROM nation WHERE n_nationkey = i) AND (v = '' OR i % 2 = 0) AS found FROM r""",
)
def listed_houses(spark, sf_dir):
    """The files of a range of houses in both variants, whether they are there, without those whose names are to be skipped."""
    work = Workspace(spark, "houses")
    keys = [r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect()]
    fs, at = files.folder(spark, work.path("t"))
    for k in keys:
        for name in (f"house_{k}.json", f"house_{k}.json.tmp", *([f"house_{k}_ceiling.json"] if k % 2 == 0 else [])):
            with contextlib.closing(fs.create(at(name))) as file:
                file.writeBytes("{}")
    found = files.numbered_paths(spark, work.path("t"), "house_%d%s.json", 0, 29, r"\.tmp$", ("", "_ceiling"))
    return found.select("i", "variant", F.col("path").isNotNull().alias("found"))


@query("resumed_work", "SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderstatus = 'F'")
def resumed_work(spark, sf_dir):
    """Only shards without a record of completion are processed."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return files.pending(o, o.where("o_orderkey % 10 = 3"), "o_orderkey")


WINDOW = """SELECT strftime(time_bucket(INTERVAL {0}, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, count(*) FILTER (value > 50) AS successes,
  round(count(*) FILTER (value > 50) / count(*), 6) AS rate FROM events GROUP BY ALL"""


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark, sf_dir):
    return progress.read_stream(spark, sf_dir, "events.parquet")


@query("tumbling_events", WINDOW.format("1 hour"))
def tumbling_events(spark, sf_dir):
    """Counts and success rate per hour."""
    return progress.tumbling(events(spark, sf_dir), "1 hour")


@query("sliding_events", """SELECT strftime(time_bucket(INTERVAL 1 hour, ts) - i * INTERVAL 1 hour, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, count(*) FILTER (value > 50) AS successes,
  round(count(*) FILTER (value > 50) / count(*), 6) AS rate FROM events, range(0, 3) AS r(i) GROUP BY ALL""")
def sliding_events(spark, sf_dir):
    """Sliding windows of three hours."""
    return progress.tumbling(events(spark, sf_dir), "3 hours", "1 hour")


@query("session_events", """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 hour THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 4) AS value FROM s GROUP BY user_id, session""")
def session_events(spark, sf_dir):
    """Sessions with pauses of six hours at most."""
    return progress.sessions(events(spark, sf_dir), "6 hours")


RUNS = """WITH f AS (SELECT user_id, ts, value <= 50 AS failed, sum((value > 50)::INT) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM events),
  r AS (SELECT user_id, island, count(*) FILTER (failed) AS run FROM f GROUP BY ALL) SELECT user_id, max(run) AS longest, arg_max(run, island) AS open FROM r GROUP BY user_id"""


@query("consecutive_failures", RUNS)
def consecutive_failures(spark, sf_dir):
    """Longest and open run of failures, by islands between successes."""
    w = Window.partitionBy("user_id").orderBy("ts")
    f = events(spark, sf_dir).withColumn("island", F.sum((F.col("value") > 50).cast("int")).over(w))
    r = f.groupBy("user_id", "island").agg(F.count_if(F.col("value") <= 50).alias("run"))
    return r.groupBy("user_id").agg(F.max("run").alias("longest"), F.max_by("run", "island").alias("open"))


@query("stream_progress", WINDOW.format("1 day"))
def stream_progress(spark, sf_dir):
    """The windows as a stream over files, from a checkpoint."""
    return progress.finish(progress.tumbling(event_stream(spark, sf_dir), "1 day"), Workspace(spark, "stream-progress"), "out", "complete")


DAYS = 5
SLICE = f"date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) // {DAYS}"


def sliced_stream(spark, sf_dir, workspace):
    """Events by time, written slice by slice (DAYS days each) as FILES files, and read a slice a micro-batch."""
    found = events(spark, sf_dir).withColumn("slice", F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / DAYS))
    for (n,) in sorted(found.select("slice").distinct().collect()):
        own = found.where(F.col("slice") == n).drop("slice").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        own.repartition(progress.FILES).write.parquet(workspace.path(f"events/slice-{n:04d}"))
    stream = spark.readStream.schema(progress.COLUMNS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", progress.FILES)
    return stream.parquet(workspace.path("events")).withColumn("ts", F.col("ts").cast("timestamp"))


def failed():
    return F.col("value") <= 50


@query("stream_failures", RUNS)
def stream_failures(spark, sf_dir):
    """Runs of failures in event time, kept as state of a stream until the watermark has passed them."""
    work_ = Workspace(spark, "stream-failures")
    found = state.failure_runs(sliced_stream(spark, sf_dir, work_), "user_id", failed(), "1 hour")
    return progress.finish(found, work_, "out", "update", ("key",)).withColumnRenamed("key", "user_id")


STOP = 9


@query(
    "stream_stopped",
    f"""WITH e AS (SELECT *, {SLICE} AS slice FROM events), s AS (SELECT DISTINCT slice AS upto FROM e),
  f AS (SELECT upto, user_id, value <= 50 AS failed, sum((value > 50)::INT) OVER (PARTITION BY upto, user_id ORDER BY ts) AS island FROM e JOIN s ON slice <= upto),
  r AS (SELECT upto, user_id, island, count(*) FILTER (failed) AS run FROM f GROUP BY ALL),
  l AS (SELECT upto, user_id, max(run) AS longest, arg_max(run, island) AS open FROM r GROUP BY ALL),
  stop AS (SELECT coalesce(min(upto) FILTER (longest >= {STOP}), max(upto)) AS upto FROM l)
  SELECT user_id, longest, open FROM l WHERE upto = (SELECT upto FROM stop)""",
)
def stream_stopped(spark, sf_dir):
    """The stream ends itself when anyone has failed STOP times in a row; what had been found until then."""
    work_ = Workspace(spark, "stream-stopped")
    found = state.failure_runs(sliced_stream(spark, sf_dir, work_), "user_id", failed(), "1 hour")
    return progress.finish(found, work_, "out", "update", ("key",), until=F.col("longest") >= STOP).withColumnRenamed("key", "user_id")


@query(
    "stream_metrics",
    f"""WITH s AS (SELECT {SLICE} AS slice, count(*) AS episodes, count(*) FILTER (value > 50) AS successes FROM events GROUP BY ALL)
  SELECT row_number() OVER (ORDER BY slice) - 1 AS batch, episodes, successes, (sum(episodes) OVER (ORDER BY slice))::BIGINT AS done,
    round(100.0::DOUBLE * sum(episodes) OVER (ORDER BY slice) / sum(episodes) OVER (), 6) AS completion FROM s""",
)
def stream_metrics(spark, sf_dir):
    """What a listener saw of each micro-batch: episodes, successes and completion against the known total."""
    work_ = Workspace(spark, "stream-metrics")
    total = table(spark, sf_dir, "events").count()
    found = work.watched(sliced_stream(spark, sf_dir, work_).select("event_id", "value"), F.col("value") > 50, work_, "out", total)
    return spark.read.schema(found.schema).parquet(work_.path("out-progress")).select("batch", "episodes", "successes", "done", F.round("completion", 6).alias("completion"))


@query("shared_work", "SELECT s_suppkey AS house, s_suppkey // (SELECT greatest(1, count(*) // 5) FROM supplier) AS batch, count(l_orderkey) AS n, coalesce(sum(l_quantity), 0) AS quantity FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY ALL")
def shared_work(spark, sf_dir):
    """Houses handed out in batches, each processed and written once, one folder for each batch."""
    work_ = Workspace(spark, "shared-work")
    houses = table(spark, sf_dir, "supplier").agg(F.min("s_suppkey").alias("low"), F.count(F.lit(1)).alias("n")).first()
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("house"), "l_orderkey", "l_quantity")

    def process(handed):
        own = handed.select((F.col("work") + houses["low"]).alias("house"))
        return own.join(lines, "house", "left").groupBy("house").agg(F.count("l_orderkey").alias("n"), F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("quantity"))

    out = work.work_through(work.hand_out(spark, houses["n"], max(1, houses["n"] // 5)), work_, "out", process)
    return spark.read.parquet(out).select("house", F.col("batch").cast("long").alias("batch"), "n", "quantity")


@query("stream_blacklist", """SELECT user_id, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) >= 10""")
def stream_blacklist(spark, sf_dir):
    """Users with too many errors, counted by a stream."""
    failed = event_stream(spark, sf_dir).where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("failures"))
    return progress.finish(failed.where("failures >= 10"), Workspace(spark, "stream-blacklist"), "out", "complete")


@query("stream_dedup", """SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice; a stream keeps one within its watermark."""
    twice = event_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    once = twice.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"]).select("event_type", "event_id")
    kept = progress.finish(once, Workspace(spark, "stream-dedup"), "out")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_static_join", """SELECT c_mktsegment, count(*) AS n, round(sum(value), 2) AS value FROM events JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment""")
def stream_static_join(spark, sf_dir):
    """A stream joined with a table."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = event_stream(spark, sf_dir).join(c, F.col("user_id") == F.col("c_custkey"))
    found = joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))
    return progress.finish(found, Workspace(spark, "stream-join"), "out", "complete")


@query("stream_reservoirs", """WITH s AS (SELECT event_type, event_id, pow(('0x' || substr(md5('e|' || event_id), 1, 12))::BIGINT / 281474976710656.0::DOUBLE, 1.0::DOUBLE / greatest(value, 0.01)) AS score FROM events)
  SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, event_id DESC) AS r FROM s) WHERE r <= 20""")
def stream_reservoirs(spark, sf_dir):
    """Bounded weighted reservoirs as state of a stream."""
    found = progress.finish(progress.reservoirs(event_stream(spark, sf_dir), 20), Workspace(spark, "stream-reservoirs"), "out", "update", ("event_type",))
    return found.select("event_type", "event_id")


GRACE, BUCKETS = 3600, 8


@query(
    "stream_reweighted",
    f"""WITH w AS (SELECT *, (props->>'$.k')::INT AS k, greatest(value, 0.01) AS first FROM events),
  f AS (SELECT event_type, event_id, CASE WHEN k % 5 = 0 AND k + 20 <= {GRACE // 60} THEN first * 2 WHEN k % 3 = 0 AND k <= {GRACE // 60} THEN first / 10 ELSE first END AS weight FROM w),
  s AS (SELECT *, pow(('0x' || substr(md5('e|' || event_id), 1, 12))::BIGINT / 281474976710656.0::DOUBLE, 1 / weight) AS score FROM f)
  SELECT event_type, event_id, round(weight, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, event_id DESC) AS r FROM s) WHERE r <= 20""",
)
def stream_reweighted(spark, sf_dir):
    """Weighted reservoirs whose items' weights change for an hour: some get a tenth k minutes later, some the double after k + 20."""
    work_ = Workspace(spark, "stream-reweighted")
    k = F.get_json_object("props", "$.k").cast("int")
    first = F.greatest(F.col("value"), F.lit(0.01))
    later = lambda minutes, weight: F.struct((F.col("ts") + F.make_interval(mins=minutes)).alias("ts"), weight.alias("weight"), F.lit(False).alias("inserts"))
    changes = F.array(F.struct("ts", first.alias("weight"), F.lit(True).alias("inserts")), F.when(k % 3 == 0, later(k, first / 10)), F.when(k % 5 == 0, later(k + 20, first * 2)))
    rows = sliced_stream(spark, sf_dir, work_).select(
        F.col("event_type").alias("key"), F.col("event_id").alias("item"), uniform(F.lit("e"), F.col("event_id").cast("string")).alias("u"), F.explode(F.array_compact(changes)).alias("c")
    )
    rows = rows.select("key", "item", "u", "c.ts", "c.weight", "c.inserts")
    found = progress.finish(state.reservoirs(rows, 20, GRACE, "2 hours", BUCKETS), work_, "out", "update", ("key", "bucket"))
    found = state.best_of_buckets(found, 20)
    return found.select(F.col("key").alias("event_type"), F.col("item").alias("event_id"), F.round("weight", 6).alias("weight"))


@query("steps_after_first", f"""WITH {STEPS} SELECT episode, count(*) AS kept FROM steps WHERE t >= 1 GROUP BY episode""")
def steps_after_first(spark, sf_dir):
    """steps from the first on (what a consumer sees that skips the dummy)."""
    return steps(spark, sf_dir).where("t >= 1").groupBy("episode").agg(F.count(F.lit(1)).alias("kept"))


@query(
    "episode_rows",
    f"""WITH {STEPS} SELECT episode, count(*) AS n_steps, max(t) + 1 AS length, coalesce(min(t) FILTER (success), 0) AS first_success, bool_or(success) AS success,
      lower(arg_min(p_name, t)) AS object_name, 'Handle the ' || lower(arg_min(p_type, t)) AS description FROM steps JOIN part ON part = p_partkey GROUP BY episode""",
)
def episode_rows(spark, sf_dir):
    """One row per trajectory of a file, from its step arrays and its scene document."""
    s = steps(spark, sf_dir).join(table(spark, sf_dir, "part"), F.col("part") == F.col("p_partkey"))
    return s.groupBy("episode").agg(
        F.count(F.lit(1)).alias("n_steps"), (F.max("t") + 1).alias("length"), F.coalesce(F.min(F.when(F.col("success"), F.col("t"))), F.lit(0)).cast("long").alias("first_success"),
        F.bool_or("success").alias("success"), F.lower(F.min_by("p_name", "t")).alias("object_name"), F.concat(F.lit("Handle the "), F.lower(F.min_by("p_type", "t"))).alias("description"),
    )


HOUSE = 500
#: Names of so many parts are broadcast.
BROADCAST_PARTS = 1_500_000


def housed_steps(spark, sf_dir, *columns):
    """Steps with their parts' names and types, dealt by house. Beyond BROADCAST_PARTS the steps go to the parts and back, in these columns alone."""
    s = steps(spark, sf_dir, HOUSE).select("house", "episode", "t", "part", *columns)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    on = F.col("part") == F.col("p_partkey")
    if part.count() <= BROADCAST_PARTS:
        return s.join(F.broadcast(part), on).drop("part", "p_partkey")
    s = s.drop("house").join(part.hint("merge"), on).drop("part", "p_partkey").withColumn("house", house_of("episode", HOUSE))
    return s.repartition(dealt_parts(table(spark, sf_dir, "lineitem")), "house")


@query(
    "trajectory_files",
    f"""WITH {STEPS} SELECT 'batch_' || episode // {HOUSE} AS file, (episode % {HOUSE})::INT AS traj_idx, count(*) AS n_steps, coalesce(min(t) FILTER (success), 0) AS first_success,
      arg_max(success, t) AS success, lower(arg_min(p_name, t)) AS object_name, 'Handle the ' || lower(arg_min(p_type, t)) AS task_description,
      round(sum(q), 2) AS moved, count(*) FILTER (status = 'O') AS open FROM steps JOIN part ON part = p_partkey GROUP BY episode""",
)
def trajectory_files(spark, sf_dir):
    """Episodes written as trajectory files of HOUSE episodes each, with padded JSON rows, flags and a scene document, found, opened and read.

    Steps are dealt once, by file; files are compressed as a whole.
    """
    work_ = Workspace(spark, "trajectories")
    s = housed_steps(spark, sf_dir, "success", "q", "status")
    row = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("t", x.alias("v")))), lambda r: r["v"])
    arm = F.to_json(F.struct(F.array("q").alias("arm"), F.col("status").alias("state")))
    scene = F.to_json(F.struct(F.lower(F.min_by("p_name", "t")).alias("object_name"), F.concat(F.lit("Handle the "), F.lower(F.min_by("p_type", "t"))).alias("task_description")))
    e = s.groupBy("house", "episode").agg(row(F.col("success").cast("string")).alias("success"), row(arm).alias("qpos"), scene.alias("scene"))
    name = lambda leaf: F.concat(F.lit("traj_"), F.col("episode") % HOUSE, F.lit(leaf))
    member = lambda leaf, kind, texts: F.struct(name(leaf).alias("name"), F.lit(kind).alias("kind"), texts.alias("texts"))
    members = F.array(member("/success", "json", F.col("success")), member("/obs/agent/qpos", "text", F.col("qpos")), member("/obs_scene", "scalar", F.array("scene")))
    trajectory_files_.write_trajectories(e.select(F.concat(F.lit("batch_"), "house").alias("file"), "house", F.inline(members)), work_.path("files"), "house", compression="zstd")
    leaves = trajectory_files_.read_trajectories(spark, work_.path("files"))
    arm = F.when(F.col("key") == "obs/agent/qpos", F.from_json("value", "arm array<double>, state string"))
    more = F.round(F.sum(F.get(arm["arm"], F.lit(0))), 2).alias("moved"), F.count_if(arm["state"] == "O").alias("open")
    found = trajectory_files_.episode_rows(leaves, *more)  # the files are read once
    file = F.regexp_extract("h5_file", r"(batch_\d+)\.npz\.zst$", 1)
    return found.select(file.alias("file"), "traj_idx", "n_steps", F.col("first_success").cast("long").alias("first_success"), "success", "object_name", "task_description", "moved", "open")


@query("connector_roundtrip", "SELECT kind, count(*) AS n, round(sum(s_acctbal), 2) AS balance FROM supplier, (SELECT unnest(['orc', 'csv', 'json', 'parquet']) AS kind) GROUP BY kind")
def connector_roundtrip(spark, sf_dir):
    """The same rows through several formats."""
    work = Workspace(spark, "formats")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    out = None
    for kind in ("orc", "csv", "json", "parquet"):
        s.write.format(kind).save(work.path(kind))
        back = spark.read.schema(s.schema).format(kind).load(work.path(kind)).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
        back = back.select(F.lit(kind).alias("kind"), "n", "balance")
        out = back if out is None else out.unionByName(back)
    return out


@query("join_strategies", "SELECT strategy, c_nationkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey, (SELECT unnest(['broadcast', 'merge', 'shuffle_hash']) AS strategy) GROUP BY ALL")
def join_strategies(spark, sf_dir):
    """The same join by three physical strategies."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    parts = [c.join(n.hint(s), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).withColumn("strategy", F.lit(s)) for s in ("broadcast", "merge", "shuffle_hash")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


MEMBER, DRAW = "transforms", 5
WRITTEN = 1024
GRASPS = """SELECT p_partkey, 'droid' AS source, 0 AS priority, p_size % 7 AS n FROM part WHERE p_size % 3 = 0
  UNION ALL SELECT p_partkey, 'droid_objaverse', 1, p_size % 11 FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'rum', 2, 8 FROM part WHERE p_partkey % 11 <> 0"""


def written_grasps(spark, sf_dir, work_):
    """Array files of three sources, written from the parts: npz of two, JSON of the third; some are empty, some are not there."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    p = p.repartition(1 + p.count() // WRITTEN, "p_partkey")  # the table is small for its files: one task would write them all
    kinds = [("droid", "npz", F.col("p_size") % 3 == 0, F.col("p_size") % 7), ("droid_objaverse", "npz", F.col("p_partkey") % 2 == 0, F.col("p_size") % 11), ("rum", "json", F.col("p_partkey") % 11 != 0, F.lit(8))]
    each = F.array_compact(F.array(*[F.when(there, F.struct(F.lit(s).alias("source"), F.lit(k).alias("kind"), n.alias("n"))) for s, k, there, n in kinds]))
    rows = p.select("p_partkey", "p_size", F.explode(each).alias("f")).select(F.concat(F.lit("part_"), F.col("p_partkey")).alias("object"), "p_size", "f.*")
    places = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    values = F.transform(places, lambda i: F.transform(F.sequence(F.lit(0), F.lit(15)), lambda j: (F.col("p_size") + i * 16 + j).cast("double")))
    array_files.save_arrays(rows.withColumn("value", values), work_.path("grasps"), MEMBER)
    return array_files.load_arrays(spark, work_.path("grasps"), ["droid", "droid_objaverse", "rum"], MEMBER)


@query(
    "grasp_files",
    f"""WITH g AS ({GRASPS}), f AS (SELECT p_partkey, arg_min(source, priority) AS source, arg_min(n, priority) AS n FROM g WHERE n > 0 GROUP BY p_partkey),
  d AS (SELECT f.*, i, row_number() OVER (PARTITION BY p_partkey ORDER BY md5('7|part_' || p_partkey || '|' || i)) AS r FROM f, unnest(range(n)) AS u(i))
  SELECT 'part_' || p_partkey AS object, source, n::BIGINT AS n, string_agg(i::VARCHAR, ',' ORDER BY i) AS places, sum(p_size + i * 16 + 15)::DOUBLE AS last FROM d JOIN part USING (p_partkey) WHERE r <= {DRAW} GROUP BY ALL""",
)
def grasp_files(spark, sf_dir):
    """Grasps of npz and JSON files, of the first source that has any, and a seeded draw of at most DRAW of them."""
    found = array_files.first_source(written_grasps(spark, sf_dir, Workspace(spark, "grasps")))
    some = array_files.drawn(found, DRAW, "7")
    places = F.array_join(F.transform(F.array_sort(F.collect_list("place")), lambda x: x.cast("string")), ",")
    return some.groupBy("object", "source", "n").agg(places.alias("places"), F.sum(F.get("value", F.lit(15))).alias("last"))


CHUNK = 64


@query(
    "feature_files",
    f"""SELECT vec_id, label, (vec_id % {CHUNK})::INT AS place, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)), 6) AS norm FROM embeddings""",
)
def feature_files(spark, sf_dir):
    """Gzipped JSON lines of ids joined by chunk and place with the rows of feature files."""
    work_ = Workspace(spark, "features")
    e = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("chunk_"), F.floor(F.col("vec_id") / CHUNK)).alias("object"), (F.col("vec_id") % CHUNK).cast("int").alias("place"), "vec_id", "label", "embedding")
    names = e.select("object", "place", "vec_id", "label")
    names.write.option("compression", "gzip").json(work_.path("names"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("embedding").cast("array<double>").alias("v")))), lambda x: x["v"])
    chunks = e.groupBy("object").agg(ordered.alias("value")).select("object", F.lit("clip").alias("source"), F.lit("npz").alias("kind"), "value")
    array_files.save_arrays(chunks, work_.path("arrays"), "features")
    rows = array_files.load_arrays(spark, work_.path("arrays"), ["clip"], "features").select("object", "place", "value")
    norm = F.aggregate("value", F.lit(0.0), lambda s, x: s + x * x)
    back = spark.read.schema(names.schema).json(work_.path("names"))
    # vec_ids of a chunk have no gaps, so the place in the file is that in the chunk
    return back.join(rows, ["object", "place"]).select("vec_id", "label", "place", F.round(norm, 6).alias("norm"))


@query("bucketed_join", "SELECT o_orderpriority, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority")
def bucketed_join(spark, sf_dir):
    """Two tables written once in buckets of their key, joined bucket by bucket without a shuffle of either."""
    work_ = Workspace(spark, "buckets")
    o = files.bucketed(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), work_.path("orders"), "o_orderkey")
    li = files.bucketed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), work_.path("lineitem"), "l_orderkey")
    joined = o.join(li.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
