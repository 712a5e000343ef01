"""Queries along sequences, and on distributions of values."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.operators import distributions as dist
from weft.operators import sequences as seq
from weft.plans.registry import query
from weft.plans.standins import SIGNALS, STEPS, signals, steps
from weft.sources.tables import table
from weft.workspace import Workspace

STATS = """round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max,
  count(value) AS count, round(sum(value), 4) AS sum, round(sum(value * value), 4) AS sum_sq"""
RATIOS = f"""{SIGNALS}, r AS (SELECT episode, t, key, value, lead(value) OVER (PARTITION BY episode ORDER BY t) AS next FROM signals),
  ratios AS (SELECT episode, t, key, abs(next - value) / abs(value) AS ratio FROM r WHERE abs(value) >= 0.5 AND t >= 2 AND next IS NOT NULL)"""
BOUNDS = """bounds AS (SELECT key, avg(ratio) AS mean, stddev_pop(ratio) AS std, count(ratio) AS n FROM ratios GROUP BY key HAVING count(ratio) >= 10)"""


def rounded(df, places):
    return df.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in df.columns])


def ratios(spark, sf_dir):
    return seq.tracking_ratios(signals(spark, sf_dir), "value", "value", "value", 0.5, 2)


@query("signal_stats", f"WITH {SIGNALS} SELECT episode, key, {STATS} FROM signals GROUP BY episode, key")
def signal_stats(spark, sf_dir):
    """Statistics per episode and key."""
    found = signals(spark, sf_dir).groupBy("episode", "key").agg(*dist.vector_stats("value")).drop("m2")
    return rounded(found, {"mean": 6, "std": 6, "min": 6, "max": 6, "sum": 4, "sum_sq": 4})


@query(
    "merged_stats",
    f"""WITH {SIGNALS} SELECT key, count(value) AS count, round(sum(value), 3) AS sum, round(sum(value * value), 4) AS sum_sq,
      round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 5) AS std
    FROM signals GROUP BY key""",
)
def merged_stats(spark, sf_dir):
    """Episode statistics merged to those of the dataset."""
    parts = signals(spark, sf_dir).groupBy("episode", "key").agg(*dist.vector_stats("value"))
    return rounded(dist.merged(parts, "key").drop("m2"), {"sum": 3, "sum_sq": 4, "min": 6, "max": 6, "mean": 6, "std": 5})


@query(
    "group_leaf_stats",
    """SELECT 'supplier/' || s_nationkey AS leaf, count(*) AS n, round(avg(s_acctbal), 6) AS mean FROM supplier GROUP BY 1
    UNION ALL SELECT 'customer/' || c_nationkey, count(*), round(avg(c_acctbal), 6) FROM customer WHERE 'customer/' || c_nationkey LIKE 'customer/%' GROUP BY 1""",
)
def group_leaf_stats(spark, sf_dir):
    """A group key stands for all leaves below it."""
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier/"), "s_nationkey").alias("leaf"), F.col("s_acctbal").alias("v"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer/"), "c_nationkey").alias("leaf"), F.col("c_acctbal").alias("v"))
    every = s.unionByName(c)
    return every.where(F.col("leaf").startswith("supplier/") | F.col("leaf").startswith("customer/")).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 6).alias("mean")
    )


@query(
    "jerk",
    f"""WITH {STEPS}, j AS (SELECT episode, sqrt(pow(q - 3 * lag(q, 1) OVER w + 3 * lag(q, 2) OVER w - lag(q, 3) OVER w, 2)
        + pow(d - 3 * lag(d, 1) OVER w + 3 * lag(d, 2) OVER w - lag(d, 3) OVER w, 2)) / 0.001 AS jerk FROM steps
        WINDOW w AS (PARTITION BY episode ORDER BY t))
    SELECT episode, round(avg(jerk), 4) AS jerk FROM j GROUP BY episode""",
)
def jerk(spark, sf_dir):
    """Mean jerk of an episode; null under four steps."""
    return seq.mean_jerk(steps(spark, sf_dir), ["q", "d"], 0.1).select("episode", F.round("jerk", 4).alias("jerk"))


@query("tracking_bounds", f"WITH {RATIOS}, {BOUNDS} SELECT key, round(mean, 6) AS mean, round(std, 6) AS std, n, round(mean - 2 * std, 6) AS lower, round(mean + 2 * std, 6) AS upper FROM bounds")
def tracking_bounds(spark, sf_dir):
    """Bounds of the tracking error per key."""
    return rounded(seq.deviation_bounds(ratios(spark, sf_dir), "key", "ratio", 2.0), {"mean": 6, "std": 6, "lower": 6, "upper": 6})


@query(
    "tracking_ratio_outliers",
    f"""WITH {RATIOS}, {BOUNDS} SELECT episode, count(*) AS outliers, round(max(ratio), 6) AS worst, string_agg(t::VARCHAR, ',' ORDER BY t) AS at
    FROM ratios JOIN bounds USING (key) WHERE ratio < mean - 2 * std OR ratio > mean + 2 * std GROUP BY episode""",
)
def tracking_ratio_outliers(spark, sf_dir):
    """Outliers grouped by episode."""
    r = ratios(spark, sf_dir)
    found = seq.outside(r, seq.deviation_bounds(r, "key", "ratio", 2.0), "key", "ratio")
    return found.groupBy("episode").agg(
        F.count(F.lit(1)).alias("outliers"), F.round(F.max("ratio"), 6).alias("worst"),
        F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t.cast("string")), ",").alias("at"),
    )


@query(
    "gap_segments",
    f"""WITH {RATIOS}, {BOUNDS}, p AS (SELECT episode, t, max(ratio) AS value FROM ratios JOIN bounds USING (key) WHERE ratio > mean + 1.5 * std GROUP BY episode, t),
    g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY episode ORDER BY t) <= 20 THEN 0 ELSE 1 END AS new FROM p),
    s AS (SELECT *, sum(new) OVER (PARTITION BY episode ORDER BY t) AS segment FROM g), n AS (SELECT episode, count(*) AS length FROM signals GROUP BY episode)
    SELECT episode, segment::BIGINT AS segment, greatest(min(t) - 5, 0) AS from_t, least(max(t) + 5, length - 1) AS to_t, round(max(value), 6) AS worst, count(*) AS points
    FROM s JOIN n USING (episode) GROUP BY episode, segment, length""",
)
def gap_segments(spark, sf_dir):
    """Outlier steps merged across gaps of 20, padded by 5."""
    r = ratios(spark, sf_dir)
    bounds = seq.deviation_bounds(r, "key", "ratio", 1.5)
    points = r.join(bounds, "key").where("ratio > upper").groupBy("episode", "t").agg(F.max("ratio").alias("value"))
    lengths = signals(spark, sf_dir).groupBy("episode").agg(F.count(F.lit(1)).alias("length"))
    return rounded(seq.merge_gaps(points, 20, 5, lengths), {"worst": 6})


@query(
    "cumulative_phase",
    f"""WITH {SIGNALS}, c AS (SELECT episode, t, key, sum(value) OVER (PARTITION BY episode ORDER BY t) AS upto FROM signals)
    SELECT episode, min(t) AS phase, round(min(upto), 6) AS reached FROM c WHERE upto >= 300 GROUP BY episode""",
)
def cumulative_phase(spark, sf_dir):
    """Cumulative durations, and the first phase that reaches a time."""
    upto = F.sum("value").over(Window.partitionBy("episode").orderBy("t"))
    return (
        signals(spark, sf_dir).withColumn("upto", upto).where("upto >= 300").groupBy("episode")
        .agg(F.min("t").alias("phase"), F.round(F.min("upto"), 6).alias("reached"))
    )


@query(
    "first_differences",
    f"""WITH {STEPS} SELECT episode, t, round(q - lag(q) OVER w, 6) AS dq, round(sum(abs(d)) OVER w, 6) AS travelled FROM steps WINDOW w AS (PARTITION BY episode ORDER BY t)""",
)
def first_differences(spark, sf_dir):
    """First differences and running lengths."""
    w = Window.partitionBy("episode").orderBy("t")
    return steps(spark, sf_dir).select(
        "episode", "t", F.round(F.col("q") - F.lag("q").over(w), 6).alias("dq"), F.round(F.sum(F.abs("d")).over(w), 6).alias("travelled")
    )


@query(
    "canonical_choice",
    f"""WITH {STEPS} SELECT part, episode, t FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY md5(episode || '/' || t), episode, t) AS r FROM steps) WHERE r = 1""",
)
def canonical_choice(spark, sf_dir):
    """One instance of each duplicate, by a stable key."""
    order = F.md5(F.concat_ws("/", "episode", "t"))
    w = Window.partitionBy("part").orderBy(order, "episode", "t")
    return steps(spark, sf_dir).withColumn("r", F.row_number().over(w)).where("r = 1").select("part", "episode", "t")


@query(
    "priority_choice",
    """SELECT uid, arg_min(source, rank) AS source, arg_min(n, rank) AS n FROM (
      SELECT l_partkey AS uid, 'returned' AS source, 1 AS rank, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
      UNION ALL SELECT l_partkey, 'open', 2, count(*) FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1
      UNION ALL SELECT p_partkey, 'none', 3, 0 FROM part) GROUP BY uid""",
)
def priority_choice(spark, sf_dir):
    """The first source that has something wins."""
    items = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1)).alias("n")
    one = items.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("uid")).agg(n).select("uid", F.lit("returned").alias("source"), F.lit(1).alias("rank"), "n")
    two = items.where("l_linestatus = 'O'").groupBy(F.col("l_partkey").alias("uid")).agg(n).select("uid", F.lit("open").alias("source"), F.lit(2).alias("rank"), "n")
    last = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), F.lit("none").alias("source"), F.lit(3).alias("rank"), F.lit(0).cast("long").alias("n"))
    return one.unionByName(two).unionByName(last).groupBy("uid").agg(F.min_by("source", "rank").alias("source"), F.min_by("n", "rank").alias("n"))


@query(
    "round_robin",
    f"""WITH {STEPS} SELECT episode, t, (t % 3)::BIGINT AS pick, ntile(4) OVER (PARTITION BY episode ORDER BY t)::BIGINT AS shard, t // 2 AS batch FROM steps""",
)
def round_robin(spark, sf_dir):
    """Round-robin picks, shards and batches."""
    w = Window.partitionBy("episode").orderBy("t")
    return steps(spark, sf_dir).select(
        "episode", "t", F.pmod(F.row_number().over(w) - 1, F.lit(3)).cast("long").alias("pick"),
        F.ntile(4).over(w).cast("long").alias("shard"), F.floor(F.col("t") / 2).alias("batch"),
    )


@query(
    "stride_subsample",
    f"""WITH {SIGNALS}, n AS (SELECT episode, t, value, count(*) OVER (PARTITION BY episode) AS n FROM signals)
    SELECT episode, t, value FROM n WHERE t >= 3 AND t <= n - 2 AND ((t - 3) % 7 = 0 OR t = n - 2)""",
)
def stride_subsample(spark, sf_dir):
    """Every seventh step and the last useful one."""
    return seq.stride(signals(spark, sf_dir), 3, 7).select("episode", "t", "value")


@query(
    "supported_pose_carry",
    f"""WITH {STEPS} SELECT episode, t, last_value(CASE WHEN success THEN q END IGNORE NULLS) OVER (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS supported,
      coalesce(abs(q - last_value(CASE WHEN success THEN q END IGNORE NULLS) OVER (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) <= 5, false) AS near FROM steps""",
)
def supported_pose_carry(spark, sf_dir):
    """The last supported pose is carried forward and compared with the present one."""
    w = Window.partitionBy("episode").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last(F.when(F.col("success"), F.col("q")), ignorenulls=True).over(w)
    return steps(spark, sf_dir).select(
        "episode", "t", carried.alias("supported"), F.coalesce(F.abs(F.col("q") - carried) <= 5, F.lit(False)).alias("near")
    )


@query(
    "earlier_pose_match",
    f"""WITH {STEPS} SELECT a.episode, a.t, count(b.t) AS matches FROM steps a LEFT JOIN steps b ON a.episode = b.episode AND b.t <= a.t AND b.success AND abs(a.q - b.q) <= 3 GROUP BY a.episode, a.t""",
)
def earlier_pose_match(spark, sf_dir):
    """How many earlier supported poses the present one matches."""
    s = steps(spark, sf_dir).select("episode", "t", "q", "success")
    cell = F.floor(F.col("q") / 3)
    near = s.where("success").select("episode", F.col("t").alias("t0"), F.col("q").alias("q0"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    pairs = s.withColumn("cell", cell).join(near, ["episode", "cell"]).where((F.col("t0") <= F.col("t")) & (F.abs(F.col("q0") - F.col("q")) <= 3))
    found = pairs.groupBy("episode", "t").agg(F.count(F.lit(1)).alias("matches"))
    return s.select("episode", "t").join(found, ["episode", "t"], "left").select("episode", "t", F.coalesce("matches", F.lit(0)).cast("long").alias("matches"))


@query("running_max", f"WITH {STEPS} SELECT episode, t, max(d) OVER (PARTITION BY episode ORDER BY t) >= 0.08 AS opened FROM steps")
def running_max(spark, sf_dir):
    """A door counts as open from the step at which it was open far enough."""
    w = Window.partitionBy("episode").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps(spark, sf_dir).select("episode", "t", (F.max("d").over(w) >= 0.08).alias("opened"))


@query(
    "history_buffer",
    f"""WITH {STEPS} SELECT episode, t, list_aggregate(list(q::INT) OVER w, 'string_agg', ',') AS history, count(*) OVER (PARTITION BY episode) - t AS to_end
    FROM steps WINDOW w AS (PARTITION BY episode ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def history_buffer(spark, sf_dir):
    """A buffer of the last three observations, and steps to the end."""
    w = Window.partitionBy("episode").orderBy("t")
    past = F.collect_list(F.col("q").cast("int").cast("string")).over(w.rowsBetween(-2, 0))
    return steps(spark, sf_dir).select(
        "episode", "t", F.array_join(past, ",").alias("history"),
        (F.count(F.lit(1)).over(Window.partitionBy("episode")) - F.row_number().over(w) + 1).alias("to_end"),
    )


@query("first_appearance", f"WITH {STEPS} SELECT robot, strftime(min(shipped), '%Y-%m-%d') AS first_seen, count(*) AS visible FROM steps GROUP BY robot")
def first_appearance(spark, sf_dir):
    """Where a point is first seen."""
    return steps(spark, sf_dir).groupBy("robot").agg(F.date_format(F.min("shipped"), "yyyy-MM-dd").alias("first_seen"), F.count(F.lit(1)).alias("visible"))


@query(
    "rank_functions",
    """SELECT p_partkey, rank() OVER w AS rank, dense_rank() OVER w AS dense, round(percent_rank() OVER w, 9) AS percent, round(cume_dist() OVER w, 9) AS cume,
      count(*) OVER (PARTITION BY p_type ORDER BY p_size RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near FROM part WINDOW w AS (PARTITION BY p_type ORDER BY p_size)""",
)
def rank_functions(spark, sf_dir):
    """Ranks and range frames."""
    w = Window.partitionBy("p_type").orderBy("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.rank().over(w).cast("long").alias("rank"), F.dense_rank().over(w).cast("long").alias("dense"),
        F.round(F.percent_rank().over(w), 9).alias("percent"), F.round(F.cume_dist().over(w), 9).alias("cume"),
        F.count(F.lit(1)).over(w.rangeBetween(-3, 3)).alias("near"),
    )


@query(
    "timing_rollup",
    f"""WITH {SIGNALS} SELECT key, (episode % 10)::VARCHAR AS worker, grouping_id(key, (episode % 10)::VARCHAR)::BIGINT AS level, round(avg(value), 6) AS mean, count(*) AS n, round(sum(value), 3) AS total,
      round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, round(median(value), 6) AS median
    FROM signals GROUP BY ROLLUP (key, (episode % 10)::VARCHAR)""",
)
def timing_rollup(spark, sf_dir):
    """A timing profile by operation and worker."""
    s = signals(spark, sf_dir).withColumn("worker", (F.col("episode") % 10).cast("string"))
    return s.rollup("key", "worker").agg(
        F.grouping_id().cast("long").alias("level"), F.round(F.avg("value"), 6).alias("mean"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum("value"), 3).alias("total"), F.round(F.stddev_pop("value"), 6).alias("std"), F.round(F.min("value"), 6).alias("min"),
        F.round(F.max("value"), 6).alias("max"), F.round(F.median("value"), 6).alias("median"),
    )


@query(
    "running_profile",
    f"""WITH {SIGNALS}, p AS (SELECT episode % 10 AS worker, episode AS house, t, value, floor(t / 5)::BIGINT AS episode FROM signals)
    SELECT worker, house, episode, t, round(avg(value) OVER w, 6) AS mean, count(*) OVER w AS n FROM p WINDOW w AS (PARTITION BY worker, house, episode ORDER BY t ROWS UNBOUNDED PRECEDING)""",
)
def running_profile(spark, sf_dir):
    """The running mean of a profile that is reset with every episode of a house."""
    s = signals(spark, sf_dir).select((F.col("episode") % 10).alias("worker"), F.col("episode").alias("house"), "t", "value", F.floor(F.col("t") / 5).alias("episode"))
    w = Window.partitionBy("worker", "house", "episode").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return s.select("worker", "house", "episode", "t", F.round(F.avg("value").over(w), 6).alias("mean"), F.count(F.lit(1)).over(w).alias("n"))


@query(
    "profile_levels",
    f"""WITH {SIGNALS}, p AS (SELECT (episode % 10)::VARCHAR AS worker, episode::VARCHAR AS house, (t // 5)::VARCHAR AS episode, value FROM signals)
    SELECT worker, house, episode, grouping_id(worker, house, episode)::BIGINT AS level, count(*) AS n, round(avg(value), 6) AS mean, round(sum(value), 3) AS total FROM p GROUP BY ROLLUP (worker, house, episode)""",
)
def profile_levels(spark, sf_dir):
    """Timings by episode, house, worker and over all; each level starts anew, so nothing of another house is in it."""
    s = signals(spark, sf_dir).select(*[c.cast("string").alias(n) for c, n in ((F.col("episode") % 10, "worker"), (F.col("episode"), "house"), (F.floor(F.col("t") / 5), "episode"))], "value")
    return s.rollup("worker", "house", "episode").agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.sum("value"), 3).alias("total")
    )


@query(
    "latency_percentiles",
    """SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99,
      round(quantile_cont(value, 0.0025), 6) AS low, round(quantile_cont(value, 0.9975), 6) AS high, max(value) AS max, round(count(*) / 30.0, 6) AS per_day FROM events GROUP BY event_type""",
)
def latency_percentiles(spark, sf_dir):
    """Percentiles with linear interpolation, exact without a group in one place, and throughput."""
    names = {0.5: "p50", 0.95: "p95", 0.99: "p99", 0.0025: "low", 0.9975: "high"}
    e = table(spark, sf_dir, "events")
    found = e.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("max"), F.round(F.count(F.lit(1)) / 30.0, 6).alias("per_day"))
    cuts = dist.exact_quantiles(e, "event_type", "value", list(names), Workspace(spark, "latency")).withColumnRenamed("event_type", "of")
    wide = cuts.groupBy("of").agg(*[F.round(F.max(F.when(F.col("p") == p, F.col("quantile"))), 6).alias(n) for p, n in names.items()])
    return found.join(wide, F.col("event_type").eqNullSafe(F.col("of"))).select("event_type", "mean", *names.values(), "max", "per_day")


@query("merged_quantiles", """SELECT event_type, p, count(value) AS n, count(DISTINCT user_id) AS users, true AS rank_close, true AS users_close
    FROM events, (SELECT unnest([0.05, 0.25, 0.5, 0.95, 0.99])::DOUBLE AS p) GROUP BY ALL""")
def merged_quantiles(spark, sf_dir):
    """Quantile and distinct sketches of each file (user) merged to those of the dataset; their ranks and counts are within the stated errors."""
    work = Workspace(spark, "sketches")
    e = table(spark, sf_dir, "events")
    files = work.save(dist.file_sketches(e, "value", "user_id", "event_type", distinct="user_id"), "files")
    whole = dist.merged_sketches(files, "event_type")
    cuts = [F.struct(F.lit(p).alias("p"), dist.sketched_quantile(p).alias("q")) for p in (0.05, 0.25, 0.5, 0.95, 0.99)]
    cuts = work.save(whole.select("event_type", "count", F.hll_sketch_estimate("distincts").alias("estimate"), F.explode(F.array(*cuts)).alias("c")).select("event_type", "count", "estimate", "c.p", "c.q"), "cuts")
    ranked = e.join(F.broadcast(cuts), "event_type").groupBy("event_type", "p", "count", "estimate").agg(
        F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto"), F.count_distinct("user_id").alias("users")
    )
    margin = F.greatest(F.lit(dist.SKETCH_ERROR) * F.col("count"), F.lit(1.0))
    close = (F.col("below") - margin <= F.col("p") * F.col("count")) & (F.col("p") * F.col("count") <= F.col("upto") + margin)
    return ranked.select("event_type", "p", F.col("count").alias("n"), "users", close.alias("rank_close"), (F.abs(F.col("estimate") - F.col("users")) <= 0.05 * F.col("users") + 1).alias("users_close"))


@query(
    "histogram_1d",
    """SELECT CASE WHEN value BETWEEN 0 AND 100 THEN least(floor(value / 2.5), 39)::BIGINT ELSE -1 END AS bin, count(*) AS n FROM events GROUP BY 1""",
)
def histogram_1d(spark, sf_dir):
    """Counts by bin, and those outside."""
    return dist.histogram(table(spark, sf_dir, "events"), "value", 0.0, 100.0, 40)


@query(
    "histogram_2d",
    """SELECT least(floor((l_quantity - 1) / 7), 6)::BIGINT AS bin_x, least(floor(l_extendedprice / 10000), 4)::BIGINT AS bin_y, count(*) AS n FROM lineitem
    WHERE l_quantity BETWEEN 1 AND 50 AND l_extendedprice BETWEEN 0 AND 50000 GROUP BY 1, 2""",
)
def histogram_2d(spark, sf_dir):
    """Counts on a grid."""
    return dist.histogram_2d(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", (1.0, 50.0, 7), (0.0, 50000.0, 5))


@query(
    "identity_r2",
    """SELECT round(1 - sum(pow(l_quantity - l_extendedprice / 1500, 2)) / (var_pop(l_quantity) * count(*)), 9) AS r2, count(*) AS n FROM lineitem""",
)
def identity_r2(spark, sf_dir):
    """Agreement of two measures with the diagonal."""
    pairs = table(spark, sf_dir, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1500).alias("y"))
    return rounded(dist.identity_r2(pairs, "l_quantity", "y"), {"r2": 9})


@query("describe_values", """WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place FROM events WHERE value IS NOT NULL),
  t AS (SELECT event_type, string_agg(event_id::VARCHAR, ',' ORDER BY place) AS top FROM r WHERE place <= 10 GROUP BY event_type)
  SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, arg_max(event_id, value) AS at_max, arg_min(event_id, value) AS at_min, any_value(top) AS top FROM events JOIN t USING (event_type) GROUP BY event_type""")
def describe_values(spark, sf_dir):
    """A summary with the sample deviation, where the extremes are (of equal ones the smallest key), and the ten largest."""
    top = dist.largest(table(spark, sf_dir, "events"), "event_type", "value", "event_id", 10).select("event_type", F.array_join(F.transform("top", lambda x: x.cast("string")), ",").alias("top"))
    summary = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("std"),
        dist.key_at_most("value", "event_id").alias("at_max"), dist.key_at_least("value", "event_id").alias("at_min"),
    )
    return summary.join(top, "event_type")


def clip_sql(passes: int = 8) -> str:
    parts, last = [RATIOS], "(SELECT key, -1e300 AS lower, 1e300 AS upper FROM ratios GROUP BY key)"
    for k in range(passes):
        parts.append(
            f"c{k} AS (SELECT r.key, greatest(b.lower, avg(ratio) - 2 * stddev_pop(ratio)) AS lower, least(b.upper, avg(ratio) + 2 * stddev_pop(ratio)) AS upper FROM ratios r JOIN {last} b USING (key) WHERE ratio BETWEEN b.lower AND b.upper GROUP BY r.key, b.lower, b.upper)"
        )
        last = f"c{k}"
    return f"WITH {', '.join(parts)} SELECT key, round(avg(ratio), 6) AS mean, round(stddev_pop(ratio), 6) AS std, count(*) AS n FROM ratios JOIN {last} USING (key) WHERE ratio BETWEEN lower AND upper GROUP BY key"


@query("sigma_clip", clip_sql(30))
def sigma_clip(spark, sf_dir):
    """Sigma clipping until nothing is dropped (the SQL unrolls more passes than that takes)."""
    work = Workspace(spark, "clip")
    values = work.save(ratios(spark, sf_dir), "ratios")
    found = seq.sigma_clip(values, "key", "ratio", 2.0, checkpoint=work.save)
    return rounded(found.select("key", "mean", "std", "n"), {"mean": 6, "std": 6})
