"""Queries on episodes: success, validity, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import episodes as ops
from weft.plans.registry import query
from weft.plans.standins import EPISODES, STEPS, episodes, steps
from weft.sources.tables import table

RATE = "CASE WHEN {n} > 0 THEN round(100.0::DOUBLE * {k} / {n}, 2) ELSE 0 END"
OUTCOMES = """outcomes AS (SELECT episode, arg_max(success, t) AS success_end, bool_or(success) AS success_any,
  coalesce(min(t) FILTER (success), 0) AS first_success, count(*) AS length, max(reward) AS best_reward FROM steps GROUP BY episode)"""
FIRST_CATEGORY = "kinds AS (SELECT episode, p_type AS category FROM steps JOIN part ON part = p_partkey WHERE t = 0)"


def by_category(spark, sf_dir):
    """Outcomes with the category of the first step's part."""
    s = steps(spark, sf_dir)
    kinds = s.where("t = 0").join(table(spark, sf_dir, "part"), F.col("part") == F.col("p_partkey"))
    return ops.outcomes(s).join(kinds.select("episode", F.col("p_type").alias("category")), "episode")


@query(
    "success_by_category",
    f"""WITH {STEPS}, {OUTCOMES}, {FIRST_CATEGORY}
    SELECT CASE WHEN grouping(category) = 1 THEN 'OVERALL' ELSE coalesce(category, 'unknown') END AS category,
      count(*) FILTER (success_end) AS successes, count(*) AS total,
      {RATE.format(k='count(*) FILTER (success_end)', n='count(*)')} AS success_rate_pct,
      count(*) FILTER (success_any) AS oracle_successes,
      {RATE.format(k='count(*) FILTER (success_any)', n='count(*)')} AS oracle_rate_pct
    FROM outcomes JOIN kinds USING (episode) GROUP BY ROLLUP (category)""",
)
def success_by_category(spark, sf_dir):
    """Success at the end and anywhere per category, with an OVERALL row."""
    return ops.success_report(by_category(spark, sf_dir), "category")


@query(
    "run_summary",
    f"""WITH {STEPS}, {OUTCOMES}, {EPISODES}
    SELECT count(*) AS episodes, count(*) FILTER (success_end) AS successes, count(*) FILTER (NOT success_end) AS failures,
      round(avg(success_end::INT), 6) AS success_rate, round(avg(success_any::INT), 6) AS oracle_rate,
      round(avg(length), 6) AS avg_length, min(length) AS min_length, max(length) AS max_length,
      count(DISTINCT house) AS houses, round(count(*) / count(DISTINCT house), 6) AS episodes_per_house,
      round(avg(length) FILTER (success_end), 6) AS avg_successful_length, median(length) AS median_length
    FROM outcomes JOIN episodes USING (episode)""",
)
def run_summary(spark, sf_dir):
    """Totals, rates and lengths of a run."""
    found = ops.outcomes(steps(spark, sf_dir)).join(episodes(spark, sf_dir), "episode")
    n, houses = F.count(F.lit(1)), F.count_distinct("house")
    return found.agg(
        n.alias("episodes"),
        F.count_if("success_end").alias("successes"),
        F.count_if(~F.col("success_end")).alias("failures"),
        F.round(F.avg(F.col("success_end").cast("int")), 6).alias("success_rate"),
        F.round(F.avg(F.col("success_any").cast("int")), 6).alias("oracle_rate"),
        F.round(F.avg("length"), 6).alias("avg_length"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        houses.alias("houses"),
        F.round(n / houses, 6).alias("episodes_per_house"),
        F.round(F.avg(F.when(F.col("success_end"), F.col("length"))), 6).alias("avg_successful_length"),
        F.median("length").alias("median_length"),
    )


@query(
    "house_success",
    f"""WITH {STEPS}, {OUTCOMES}, {EPISODES}
    SELECT house, count(*) AS total, count(*) FILTER (success_end) AS successes,
      {RATE.format(k='count(*) FILTER (success_end)', n='count(*)')} AS rate_pct
    FROM outcomes JOIN episodes USING (episode) GROUP BY house""",
)
def house_success(spark, sf_dir):
    """A10: success rate per house."""
    found = ops.outcomes(steps(spark, sf_dir)).join(episodes(spark, sf_dir), "episode")
    wins = F.count_if("success_end")
    return found.groupBy("house").agg(
        F.count(F.lit(1)).alias("total"), wins.alias("successes"), ops.rate(wins, F.count(F.lit(1))).alias("rate_pct")
    )


@query(
    "first_success",
    f"""WITH {STEPS}, {OUTCOMES}
    SELECT episode, first_success, success_any AS ever_success, success_any AND first_success > 0 AS kept FROM outcomes""",
)
def first_success(spark, sf_dir):
    """First successful step (0 if none) and the filter that needs it to be positive."""
    return ops.outcomes(steps(spark, sf_dir)).select(
        "episode", "first_success", F.col("success_any").alias("ever_success"),
        (F.col("success_any") & (F.col("first_success") > 0)).alias("kept"),
    )


@query(
    "truncated_reward_success",
    f"""WITH {STEPS} SELECT episode, coalesce(max(reward) >= 60000, bool_or(success), false) AS success
    FROM steps WHERE t < 3 GROUP BY episode""",
)
def truncated_reward_success(spark, sf_dir):
    """Success of the first three steps by a reward threshold, with flags as fallback."""
    return ops.reward_success(steps(spark, sf_dir), 60000.0, 3)


@query(
    "valid_mask",
    f"""WITH {STEPS}, n AS (SELECT episode, count(*) AS length, count(q) AS a, count(CASE WHEN d > 0 THEN d END) AS b,
        count(CASE WHEN x > 0 THEN x END) AS s FROM steps GROUP BY episode)
    SELECT episode, length, a > 0 AS has_actions, a = b AS equal_lengths, a >= 3 AS long_enough, s = length AS state_present,
      a > 0 AND a = b AND a >= 3 AND s = length AS valid FROM n""",
)
def valid_mask(spark, sf_dir):
    """Validity of each episode with its reasons; a zero discount or tax counts as a missing value."""
    s = steps(spark, sf_dir).withColumns({"b": F.when(F.col("d") > 0, F.col("d")), "state": F.when(F.col("x") > 0, F.col("x"))})
    return ops.validity(s, ["q", "b"], ["state"])


@query(
    "valid_index",
    f"""WITH {STEPS}, {EPISODES}, n AS (SELECT episode, count(*) AS length FROM steps GROUP BY episode HAVING count(*) >= 3)
    SELECT house, policy AS file, episode, length FROM n JOIN episodes USING (episode)""",
)
def valid_index(spark, sf_dir):
    """Index of valid episodes by house and file; files without one do not appear."""
    valid = ops.validity(steps(spark, sf_dir), ["q"], []).where("valid")
    return episodes(spark, sf_dir).join(valid, "episode").select("house", F.col("policy").alias("file"), "episode", "length")


@query(
    "consecutive_ids",
    f"""WITH i AS (SELECT l_orderkey, l_linenumber - 1 AS i FROM lineitem)
    SELECT l_orderkey AS episode, count(*) AS n, min(i) = 0 AND max(i) = count(*) - 1 AND count(DISTINCT i) = count(*) AS consecutive
    FROM i GROUP BY l_orderkey""",
)
def consecutive_ids(spark, sf_dir):
    """whether a file's indexes are 0 .. n - 1."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode"), (F.col("l_linenumber") - 1).alias("i"))
    return ops.consecutive_ids(items, "episode", "i")


@query(
    "parseable_rows",
    """SELECT user_id AS episode, count(*) AS rows, bool_and(json_valid(p)) AS parseable
    FROM (SELECT user_id, CASE WHEN event_id % 97 = 0 THEN '{' || props ELSE props END AS p FROM events) GROUP BY user_id""",
)
def parseable_rows(spark, sf_dir):
    """whether all of an episode's JSON rows parse (every 97th is broken here)."""
    broken = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), F.try_parse_json(broken).isNotNull().alias("ok"))
    return rows.groupBy("episode").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("ok").alias("parseable"))


@query(
    "visible_first_frame",
    f"""WITH {STEPS} SELECT episode, CASE WHEN max(CASE WHEN t = 0 THEN CASE WHEN d = 0 THEN NULL ELSE q END END) IS NULL THEN 'unknown'
      WHEN max(CASE WHEN t = 0 THEN q END) > 10 THEN 'visible' ELSE 'hidden' END AS seen,
      coalesce(max(CASE WHEN t = 0 AND d <> 0 THEN q END) > 10, true) AS passes FROM steps GROUP BY episode""",
)
def visible_first_frame(spark, sf_dir):
    """the object shows in the first frame; a missing group warns and passes."""
    points = F.max(F.when((F.col("t") == 0) & (F.col("d") != 0), F.col("q")))
    return steps(spark, sf_dir).groupBy("episode").agg(
        F.when(points.isNull(), "unknown").when(points > 10, "visible").otherwise("hidden").alias("seen"),
        F.coalesce(points > 10, F.lit(True)).alias("passes"),
    )


@query(
    "video_probe",
    f"""WITH {STEPS}, n AS (SELECT episode, count(*) AS frames FROM steps GROUP BY episode), k AS (
      SELECT episode, frames, i, round_even(i * (frames - 1) / 3.0, 0)::BIGINT AS frame FROM n, range(0, 4) AS r(i))
    SELECT k.episode, k.i AS probe, k.frame, s.t IS NOT NULL AS readable FROM k LEFT JOIN steps s ON s.episode = k.episode AND s.t = k.frame""",
)
def video_probe(spark, sf_dir):
    """Four evenly spaced frames of each video, and whether each can be read."""
    s = steps(spark, sf_dir)
    n = s.groupBy("episode").agg(F.count(F.lit(1)).alias("frames"))
    probes = n.select("episode", "frames", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("probe"))
    probes = probes.withColumn("frame", F.bround(F.col("probe") * (F.col("frames") - 1) / 3.0).cast("long"))
    there = s.select("episode", F.col("t").alias("frame"), F.lit(True).alias("there"))
    return probes.join(there, ["episode", "frame"], "left").select("episode", "probe", "frame", F.col("there").isNotNull().alias("readable"))


@query(
    "category_min_pairs",
    f"""WITH {STEPS}, {EPISODES}, p AS (SELECT p_type AS category, house, part FROM steps JOIN episodes USING (episode) JOIN part ON part = p_partkey),
    k AS (SELECT category, count(DISTINCT (house, part)) AS pairs FROM p GROUP BY category HAVING count(DISTINCT (house, part)) >= 50)
    SELECT category, pairs, count(*) AS rows FROM p JOIN k USING (category) GROUP BY ALL""",
)
def category_min_pairs(spark, sf_dir):
    """Categories with enough distinct (house, instance) pairs, by a semi join on their counts."""
    p = (
        steps(spark, sf_dir).join(episodes(spark, sf_dir), "episode")
        .join(table(spark, sf_dir, "part"), F.col("part") == F.col("p_partkey"))
        .select(F.col("p_type").alias("category"), "house", "part")
    )
    kept = p.groupBy("category").agg(F.count_distinct("house", "part").alias("pairs"), F.count(F.lit(1)).alias("rows"))
    return kept.where("pairs >= 50").select("category", "pairs", "rows")


@query(
    "length_profile",
    f"""WITH {STEPS}, n AS (SELECT episode, count(*) AS length FROM steps GROUP BY episode), {EPISODES}
    SELECT policy, count(*) AS episodes, count(DISTINCT house) AS houses, min(length) AS min, max(length) AS max,
      round(avg(length), 6) AS mean, median(length::DOUBLE) AS median FROM n JOIN episodes USING (episode) GROUP BY policy""",
)
def length_profile(spark, sf_dir):
    """Length profile by task class."""
    n = steps(spark, sf_dir).groupBy("episode").agg(F.count(F.lit(1)).alias("length"))
    return n.join(episodes(spark, sf_dir), "episode").groupBy("policy").agg(
        F.count(F.lit(1)).alias("episodes"), F.count_distinct("house").alias("houses"), F.min("length").alias("min"),
        F.max("length").alias("max"), F.round(F.avg("length"), 6).alias("mean"), F.median("length").alias("median"),
    )


@query(
    "metadata_counts",
    f"""WITH {EPISODES} SELECT 'policy' AS facet, coalesce(policy, 'unknown') AS name, count(*) AS n FROM episodes GROUP BY 2
    UNION ALL SELECT 'state', coalesce(state, 'unknown'), count(*) FROM episodes GROUP BY 2
    UNION ALL SELECT 'house', coalesce(house, 'unknown'), count(*) FROM episodes GROUP BY 2""",
)
def metadata_counts(spark, sf_dir):
    """Counts by several facets in one pass, by unpivoting them before one aggregation."""
    e = episodes(spark, sf_dir)
    facets = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.coalesce(c, F.lit("unknown")).alias("name")) for c in ("policy", "state", "house")]))
    return e.select(facets.alias("f")).select("f.facet", "f.name").groupBy("facet", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "value_frequencies",
    """SELECT p_type AS name, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS frequency FROM part GROUP BY p_type""",
)
def value_frequencies(spark, sf_dir):
    """Counts and normalised frequencies."""
    counts = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("all"))
    return counts.crossJoin(F.broadcast(total)).select("name", "n", F.round(F.col("n") / F.col("all"), 9).alias("frequency"))


@query(
    "failure_category",
    f"""WITH {STEPS} SELECT episode, CASE WHEN arg_max(success, t) THEN NULL WHEN bool_or(q > 40) THEN 'placement_failed'
      WHEN bool_or(q > 20) THEN 'failed_to_grasp' ELSE 'never_touched_target' END AS failure FROM steps GROUP BY episode""",
)
def failure_category(spark, sf_dir):
    """Why an episode failed, by what was held and touched; null for a success."""
    held, touched = F.bool_or(F.col("q") > 40), F.bool_or(F.col("q") > 20)
    return steps(spark, sf_dir).groupBy("episode").agg(
        F.when(ops.last_true("success"), F.lit(None).cast("string")).when(held, "placement_failed")
        .when(touched, "failed_to_grasp").otherwise("never_touched_target").alias("failure")
    )


@query(
    "lift_and_tilt_success",
    f"""WITH {STEPS} SELECT episode, max(q) - arg_min(q, t) >= 10 AND NOT bool_or(status = 'O' AND t > 5) AS lifted,
      round(max(abs(d) / CASE WHEN x > 0 THEN x END), 9) AS open_fraction,
      coalesce(max(abs(d) / CASE WHEN x > 0 THEN x END) >= 0.67, false) AS opened,
      round(max(greatest(0, 1 - reward / 50000)), 9) AS nearness
    FROM steps GROUP BY episode""",
)
def lift_and_tilt_success(spark, sf_dir):
    """Success from state: height gained without foreign contact, largest share of a joint's range
    (joints without a range are skipped), reward of the nearest candidate."""
    share = F.max(F.try_divide(F.abs("d"), F.when(F.col("x") > 0, F.col("x"))))
    return steps(spark, sf_dir).groupBy("episode").agg(
        ((F.max("q") - F.min_by("q", "t") >= 10) & ~F.bool_or((F.col("status") == "O") & (F.col("t") > 5))).alias("lifted"),
        F.round(share, 9).alias("open_fraction"),
        F.coalesce(share >= 0.67, F.lit(False)).alias("opened"),
        F.round(F.max(F.greatest(F.lit(0.0), 1 - F.col("reward") / 50000)), 9).alias("nearness"),
    )


@query(
    "writer_defaults",
    f"""WITH {STEPS} SELECT episode, t, t = max(t) OVER (PARTITION BY episode) AS terminated, false AS truncated,
      CASE WHEN d = 0 THEN 0 ELSE reward END AS reward, success, NOT success AS fail FROM steps""",
)
def writer_defaults(spark, sf_dir):
    """Missing fields filled in as a writer does."""
    s = steps(spark, sf_dir).select(
        "episode", "t", F.lit(None).cast("boolean").alias("terminated"), F.lit(None).cast("boolean").alias("truncated"),
        F.when(F.col("d") != 0, F.col("reward")).alias("reward"), "success",
    )
    return ops.with_defaults(s).select("episode", "t", "terminated", "truncated", "reward", "success", "fail")


@query(
    "task_horizon",
    """SELECT count(DISTINCT o_orderpriority) = 1 AND count(*) FILTER (o_orderpriority IS NULL) = 0 AS consistent, count(DISTINCT o_orderpriority) AS found,
      round_even(12.5 * 1000 / 66, 0)::BIGINT AS steps FROM orders""",
)
def task_horizon(spark, sf_dir):
    """whether all episodes agree on one value, and a horizon in steps (seconds over the step length, half to even)."""
    o = table(spark, sf_dir, "orders")
    found = F.count_distinct("o_orderpriority")
    return o.agg(
        ((found == 1) & (F.count_if(F.col("o_orderpriority").isNull()) == 0)).alias("consistent"),
        found.alias("found"),
        F.bround(F.lit(12.5) * 1000 / 66).cast("long").alias("steps"),
    )
