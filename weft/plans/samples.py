"""Queries that sample, rank and select."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.functions import text as tx
from weft.operators import candidates as cand
from weft.operators import sampling as smp
from weft.operators.sequences import global_rank
from weft.plans.registry import query
from weft.plans.standins import EPISODES, STEPS, episodes, steps
from weft.sources.tables import table
from weft.workspace import Workspace

U = "(('0x' || substr(md5({0}), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)"


@query(
    "reservoir_sample",
    f"""WITH s AS (SELECT p_partkey, pow({U.format("'r|' || p_partkey")}, 1.0::DOUBLE / p_size) AS score FROM part WHERE p_size > 0)
    SELECT p_partkey, round(score, 9) AS score FROM s ORDER BY score DESC, p_partkey LIMIT 50""",
)
def reservoir_sample(spark, sf_dir):
    """A weighted reservoir as the largest keys."""
    rows = table(spark, sf_dir, "part").where("p_size > 0").select("p_partkey", "p_size")
    return smp.reservoir(rows, "p_partkey", "p_size", 50).select("p_partkey", F.round("score", 9).alias("score"))


@query(
    "softmax_probs",
    """WITH m AS (SELECT *, exp((p_size - max(p_size) OVER (PARTITION BY p_type)) / greatest(0.02, 0.001)) AS cold, exp((p_size - max(p_size) OVER (PARTITION BY p_type)) / 10.0) AS e FROM part)
    SELECT p_type, p_partkey, round(e / sum(e) OVER (PARTITION BY p_type), 9) AS p, round(cold / sum(cold) OVER (PARTITION BY p_type), 9) AS coldest FROM m""",
)
def softmax_probs(spark, sf_dir):
    """Softmax with a temperature (0.001 at least) within each group, shifted by its maximum so that nothing overflows."""
    p = table(spark, sf_dir, "part")
    return p.select("p_type", "p_partkey", F.round(smp.softmax("p_size", 10.0, "p_type"), 9).alias("p"), F.round(smp.softmax("p_size", 0.02, "p_type"), 9).alias("coldest"))


@query(
    "gumbel_choice",
    f"""WITH s AS (SELECT p_type, p_partkey, p_size / 5.0::DOUBLE - ln(-ln(greatest({U.format("'g|' || p_type || '|' || p_partkey")}, 1e-12))) AS g FROM part)
    SELECT p_type, arg_max(p_partkey, (g, p_partkey)) AS p_partkey FROM s GROUP BY p_type""",
)
def gumbel_choice(spark, sf_dir):
    """One draw per group in proportion to a softmax."""
    return smp.gumbel_choice(table(spark, sf_dir, "part"), "p_type", "p_partkey", "p_size", 5.0)


@query(
    "hash_samples",
    f"""WITH o AS (SELECT o_orderkey, {U.format("'s|' || o_orderkey")} AS u FROM orders) SELECT o_orderkey, u < 0.01 AS kept, CASE WHEN u < 0.5 THEN 1 WHEN u < 0.8 THEN 2 ELSE 3 END AS words FROM o""",
)
def hash_samples(spark, sf_dir):
    """A one-percent sample and a discrete draw from hashes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", tx.uniform(F.lit("s"), F.col("o_orderkey").cast("string")).alias("u"))
    return o.select("o_orderkey", (F.col("u") < 0.01).alias("kept"), F.when(F.col("u") < 0.5, 1).when(F.col("u") < 0.8, 2).otherwise(3).alias("words"))


@query(
    "capped_subset",
    f"""WITH n AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('c|' || c_custkey)) AS r, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
    SELECT c_nationkey, c_custkey FROM n WHERE r <= least(6, greatest(1, floor(n * 0.1)))""",
)
def capped_subset(spark, sf_dir):
    """A share of each group, at least one row and at most six."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    return smp.capped(c, "c_nationkey", [F.md5(F.concat(F.lit("c|"), F.col("c_custkey").cast("string")))], 0.1, 6)


@query(
    "quota_sample",
    """WITH g AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS rank, count(*) OVER () AS groups FROM (SELECT DISTINCT p_type FROM part)),
    n AS (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) AS n FROM part)
    SELECT p_type, p_partkey FROM n JOIN g USING (p_type) WHERE n <= 100 // groups + (rank <= 100 % groups)::INT""",
)
def quota_sample(spark, sf_dir):
    """A budget shared by groups, the remainder to the first ones."""
    return smp.quota(table(spark, sf_dir, "part"), "p_type", ["p_size", "p_partkey"], 100).select("p_type", "p_partkey")


@query(
    "oversample",
    """SELECT p_partkey, i AS copy FROM part, range(0, 3) AS r(i) WHERE p_size > 25 OR i = 0""",
)
def oversample(spark, sf_dir):
    """Some rows three times."""
    copies = F.when(F.col("p_size") > 25, 2).otherwise(0)
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long"))).alias("copy"))


@query(
    "cluster_interleave",
    """WITH r AS (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) AS round FROM part)
    SELECT p_type, p_partkey, row_number() OVER (ORDER BY round, p_type) AS place FROM r""",
)
def cluster_interleave(spark, sf_dir):
    """The first of every cluster, then the second of every one."""
    return smp.interleave(table(spark, sf_dir, "part"), "p_type", ["p_size", "p_partkey"], Workspace(spark, "interleave")).select("p_type", "p_partkey", "place")


@query(
    "candidate_cross",
    """SELECT s_suppkey, d, r, round(s_acctbal / 1000 * d * cos(r), 6) AS quality, abs(s_acctbal) < 2000 AS colliding FROM supplier, (SELECT unnest([0.1::DOUBLE, 0.2, 0.3]) AS d), (SELECT unnest([0.0::DOUBLE, 1.0, 2.0]) AS r)
    WHERE s_acctbal / 1000 * d * cos(r) >= 0.2""",
)
def candidate_cross(spark, sf_dir):
    """Candidates from points, distances and angles, labelled and filtered by quality (both lists are constants)."""
    grid = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.explode(F.array(F.lit(0.1), F.lit(0.2), F.lit(0.3))).alias("d"))
    grid = grid.select("*", F.explode(F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))).alias("r"))
    raw = F.col("s_acctbal") / 1000 * F.col("d") * F.cos("r")
    return grid.where(raw >= 0.2).select("s_suppkey", "d", "r", F.round(raw, 6).alias("quality"), (F.abs("s_acctbal") < 2000).alias("colliding"))


@query(
    "antipodal_quality",
    f"""WITH {STEPS}, s AS (SELECT episode, arg_min(d, (abs(q - 20), t)) FILTER (q < 20) AS l, arg_min(x, (abs(q - 20), t)) FILTER (q >= 20) AS r, bool_or(q > 49) AS hit FROM steps GROUP BY episode)
    SELECT episode, CASE WHEN hit OR l IS NULL OR r IS NULL THEN 0 ELSE greatest(0, least(l, r)) END AS quality FROM s""",
)
def antipodal_quality(spark, sf_dir):
    """The nearest contact on either side, the smaller of their values, 0 for a collision."""
    near = F.struct(F.abs(F.col("q") - 20), F.col("t"))
    left = F.min_by(F.when(F.col("q") < 20, F.col("d")), F.when(F.col("q") < 20, near))
    right = F.min_by(F.when(F.col("q") >= 20, F.col("x")), F.when(F.col("q") >= 20, near))
    s = steps(spark, sf_dir).groupBy("episode").agg(left.alias("l"), right.alias("r"), F.bool_or(F.col("q") > 49).alias("hit"))
    bad = F.col("hit") | F.col("l").isNull() | F.col("r").isNull()
    return s.select("episode", F.when(bad, 0.0).otherwise(F.greatest(F.lit(0.0), F.least("l", "r"))).alias("quality"))


@query(
    "standardised_clusters",
    """WITH m AS (SELECT stddev_pop(l_quantity) AS sq, stddev_pop(l_discount) AS sd FROM lineitem)
    SELECT floor(l_quantity / (sq + 1e-6))::BIGINT AS cluster, count(*) AS n, round(avg(l_discount / (sd + 1e-6)), 6) AS mean FROM lineitem, m GROUP BY 1""",
)
def standardised_clusters(spark, sf_dir):
    """Features over their deviation, dealt to cells of one deviation."""
    items = table(spark, sf_dir, "lineitem")
    scale = items.agg(F.stddev_pop("l_quantity").alias("sq"), F.stddev_pop("l_discount").alias("sd"))
    x = items.crossJoin(F.broadcast(scale)).select(F.floor(F.col("l_quantity") / (F.col("sq") + 1e-6)).alias("cluster"), (F.col("l_discount") / (F.col("sd") + 1e-6)).alias("y"))
    return x.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("mean"))


@query(
    "weighted_permutation",
    f"""SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY -ln(greatest({U.format("'w|' || p_partkey")}, 1e-12)) / pow(1 / (abs(p_size - 25) + 0.001), 2), p_partkey) AS place FROM part""",
)
def weighted_permutation(spark, sf_dir):
    """A weighted order without replacement within each cluster."""
    weight = F.pow(1.0 / (F.abs(F.col("p_size") - 25) + 0.001), F.lit(2))
    order = Window.partitionBy("p_type").orderBy(smp.weighted_order(F.col("p_partkey"), weight, "w"), "p_partkey")
    return table(spark, sf_dir, "part").select("p_type", "p_partkey", F.row_number().over(order).cast("long").alias("place"))


@query("first_successes", f"""WITH {STEPS} SELECT episode, t, q FROM steps WHERE success ORDER BY episode, t LIMIT 100""")
def first_successes(spark, sf_dir):
    """The first hundred successes in the order of the input."""
    return steps(spark, sf_dir).where("success").orderBy("episode", "t").limit(100).select("episode", "t", "q")


@query(
    "weighted_cost_top",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(0.5 * l_quantity + 10 * l_discount + 5 * l_tax, 6) AS cost FROM lineitem ORDER BY 0.5 * l_quantity + 10 * l_discount + 5 * l_tax, l_orderkey, l_linenumber, l_partkey LIMIT 25""",
)
def weighted_cost_top(spark, sf_dir):
    """The cheapest rows by a weighted cost, ties by key."""
    cost = 0.5 * F.col("l_quantity") + 10 * F.col("l_discount") + 5 * F.col("l_tax")
    return table(spark, sf_dir, "lineitem").orderBy(cost, "l_orderkey", "l_linenumber", "l_partkey").limit(25).select("l_orderkey", "l_linenumber", "l_partkey", F.round(cost, 6).alias("cost"))


@query("class_ranking", """SELECT p_type, n, row_number() OVER (ORDER BY n DESC, p_type) AS place FROM (SELECT p_type, count(*) AS n FROM part WHERE p_type NOT LIKE 'ECONOMY%' GROUP BY p_type)""")
def class_ranking(spark, sf_dir):
    """Classes by frequency, some excluded."""
    counts = table(spark, sf_dir, "part").where(~F.col("p_type").startswith("ECONOMY")).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return global_rank(counts, [F.desc("n"), F.col("p_type")], Workspace(spark, "classes"))


@query("failure_blacklist", f"""WITH {STEPS} SELECT part, count(*) AS failures FROM steps WHERE NOT success GROUP BY part HAVING count(*) >= 22""")
def failure_blacklist(spark, sf_dir):
    """Assets with too many failures."""
    return steps(spark, sf_dir).where("NOT success").groupBy("part").agg(F.count(F.lit(1)).alias("failures")).where("failures >= 22")


@query(
    "quality_rollup",
    f"""WITH {STEPS}, {EPISODES} SELECT region::VARCHAR AS region, house, grouping_id(region, house)::BIGINT AS level, count(*) AS tested, count(*) FILTER (success) AS good, round(coalesce(count(*) FILTER (success) / nullif(count(*) FILTER (q > 10), 0), 0), 6) AS ratio
    FROM steps JOIN episodes USING (episode) GROUP BY ROLLUP (region, house)""",
)
def quality_rollup(spark, sf_dir):
    """Quality from the single test up to all, ratios guarded against empty wholes."""
    s = steps(spark, sf_dir).join(episodes(spark, sf_dir), "episode")
    good, base = F.count_if("success"), F.count_if(F.col("q") > 10)
    return s.withColumn("region", F.col("region").cast("string")).rollup("region", "house").agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("tested"), good.alias("good"), F.round(F.coalesce(F.try_divide(good, base), F.lit(0.0)), 6).alias("ratio")
    )


VECTORS = "v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)"


def asked_and_all(spark, sf_dir):
    """Query vectors (ids divisible by 20) and all vectors."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    return e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("e").alias("q")), e


@query(
    "topk_similarity",
    f"""WITH {VECTORS}, s AS (SELECT q.vec_id AS query, v.vec_id, list_dot_product(q.e, v.e) AS sim FROM v q, v WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, vec_id) AS rank FROM s WHERE sim >= 0.1)
    SELECT query, vec_id, round(sim, 6) AS sim, rank FROM r WHERE rank <= 10""",
)
def topk_similarity(spark, sf_dir):
    """The ten nearest above a threshold for each query vector."""
    asked, every = asked_and_all(spark, sf_dir)
    return cand.top_dot(asked, every, 0.1, 10)


@query(
    "runner_up_margin",
    f"""WITH {VECTORS}, s AS (SELECT q.vec_id AS query, v.label, max(list_dot_product(q.e, v.e)) AS sim FROM v q, v WHERE q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, label) AS rank FROM s)
    SELECT query, arg_min(label, rank)::INT AS label, round(max(sim) FILTER (rank = 1) - coalesce(max(sim) FILTER (rank = 2), 0), 6) AS margin FROM r GROUP BY query""",
)
def runner_up_margin(spark, sf_dir):
    """How far the best label is ahead of the next one."""
    s = cand.label_best(*asked_and_all(spark, sf_dir))
    r = s.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "label")))
    first, second = F.max(F.when(F.col("rank") == 1, F.col("sim"))), F.max(F.when(F.col("rank") == 2, F.col("sim")))
    return r.where("rank <= 2").groupBy("query").agg(F.min_by("label", "rank").alias("label"), F.round(first - F.coalesce(second, F.lit(0.0)), 6).alias("margin"))


@query("nearest_candidate", f"""WITH {STEPS} SELECT episode, arg_min(part, (abs(q - 25), t)) AS nearest, min(abs(q - 25)) AS distance FROM steps GROUP BY episode""")
def nearest_candidate(spark, sf_dir):
    """The nearest candidate of each episode."""
    distance = F.abs(F.col("q") - 25)
    return steps(spark, sf_dir).groupBy("episode").agg(F.min_by("part", F.struct(distance, F.col("t"))).alias("nearest"), F.min(distance).alias("distance"))


@query("balanced_sample")
def balanced_sample(spark, sf_dir):
    """Greedy balanced sample of 60 rows; sequential by nature, so tests check its invariants instead of SQL."""
    rows = steps(spark, sf_dir).where("t = 0").join(episodes(spark, sf_dir), "episode").join(table(spark, sf_dir, "part"), F.col("part") == F.col("p_partkey"))
    return smp.balanced(rows.select("episode", "house", F.col("p_type").alias("category"), F.col("part").alias("instance")), "house", "category", "instance", 60)


@query("farthest_points")
def farthest_points(spark, sf_dir):
    """Farthest-point sampling per label."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", *[F.col("embedding")[i].alias(f"x{i}") for i in range(64)])
    return smp.farthest_points(e, "label", "vec_id", [f"x{i}" for i in range(64)], 8, Workspace(spark, "farthest"))
