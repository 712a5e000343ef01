"""Queries that choose candidates: predicates on objects, admission by split, scores of texts and views, bands of distance."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.functions import text as tx
from weft.operators import candidates as cand
from weft.plans.registry import query
from weft.plans.standins import EPISODES, STEPS, episodes, steps
from weft.sources.tables import table
from weft.workspace import Workspace

V = """v AS (SELECT vec_id, label, embedding[1:32]::DOUBLE[] AS a, embedding[33:64]::DOUBLE[] AS b, embedding::DOUBLE[] AS e FROM embeddings)"""
NORM = "sqrt(list_dot_product({0}, {0}))"


@query(
    "fused_similarity",
    f"""WITH {V}, q AS (SELECT vec_id AS query, e AS qe, a AS qa FROM v WHERE vec_id % 20 = 0),
    s AS (SELECT query, vec_id, greatest(list_dot_product(qa, a) / ({NORM.format('qa')} * {NORM.format('a')}), list_dot_product(qa, b) / ({NORM.format('qa')} * {NORM.format('b')}))
      + 0.5 * list_dot_product(qe, e) / ({NORM.format('qe')} * {NORM.format('e')}) AS score FROM q, v),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s WHERE round(score, 9) >= 0.5)
    SELECT query, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
)
def fused_similarity(spark, sf_dir):
    """For queries with ids divisible by 20, the ten best of all vectors by the best cosine over two views plus half the cosine of the text vector."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    views = e.select("vec_id", F.slice("e", 1, 32).alias("a"), F.slice("e", 33, 32).alias("b"), "e")
    asked = views.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("a").alias("image"), F.col("e").alias("text"))
    return cand.fused_top(asked, views.select("vec_id", F.array("a", "b").alias("views"), F.col("e").alias("text")), 0.5, 0.5, 10)


@query(
    "expression_thresholds",
    """WITH q AS (SELECT l_orderkey AS object, l_linenumber AS expression, l_partkey AS part, l_discount - l_tax AS margin, l_discount AS sim FROM lineitem)
    SELECT object, expression, part, round(margin, 6) AS margin, sim FROM q WHERE round(margin, 6) >= 0.03 AND sim >= 0.1""",
)
def expression_thresholds(spark, sf_dir):
    """expressions of an object that are clear enough, by margin and by similarity."""
    items = table(spark, sf_dir, "lineitem")
    rows = items.select(
        F.col("l_orderkey").alias("object"), F.col("l_linenumber").alias("expression"), F.col("l_partkey").alias("part"),
        F.round(F.col("l_discount") - F.col("l_tax"), 6).alias("margin"), F.col("l_discount").alias("sim"),
    )
    return rows.where(cand.clear_expression(F.col("margin"), F.col("sim")))


OBJECTS = """objects AS (SELECT p_partkey AS id, lower(replace(p_name, ' ', '_')) AS name, [lower(p_type), split_part(lower(p_name), ' ', 2)] AS kinds, p_size % 3 = 0 AS site, p_size % 4 <> 0 AS free, p_size > 2 AS geoms FROM part)"""


def objects(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"),
        F.array(F.lower("p_type"), F.split_part(F.lower("p_name"), F.lit(" "), F.lit(2))).alias("kinds"),
        (F.col("p_size") % 3 == 0).alias("site"), (F.col("p_size") % 4 != 0).alias("free"), (F.col("p_size") > 2).alias("geoms"),
    )


@query(
    "object_predicates",
    f"""WITH {OBJECTS} SELECT id, site AND list_has_any(kinds, ['economy', 'ring']) AS receptacle, free AS pickup, list_has_any(kinds, ['bolt', 'gear']) AS structural,
      contains(name, 'red_') OR NOT geoms AS excluded FROM objects""",
)
def object_predicates(spark, sf_dir):
    """receptacle (a site and a type of a list), pickup (a free joint, any type), structural, excluded (the robot's name, or no geometry)."""
    o = objects(spark, sf_dir)
    return o.select(
        "id",
        cand.is_receptacle(F.col("site"), F.col("kinds"), ["economy", "ring"]).alias("receptacle"),
        cand.is_pickup(F.col("free"), F.col("kinds"), []).alias("pickup"),
        cand.has_type(F.col("kinds"), ["bolt", "gear"]).alias("structural"),
        cand.is_excluded(F.col("name"), F.col("geoms"), "red_").alias("excluded"),
    )


@query(
    "split_admission",
    """WITH a AS (SELECT p_partkey AS uid, CASE p_size % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' END AS split FROM part), w AS (SELECT unnest(['train', 'val', 'test']) AS wanted)
    SELECT wanted, uid FROM a, w WHERE (wanted = 'test' AND (split = 'test' OR split IS NULL)) OR (wanted = 'train' AND split = 'train') OR (wanted = 'val' AND split IN ('val', 'train'))""",
)
def split_admission(spark, sf_dir):
    """which assets a split admits: test takes test and none, train takes train, val takes val and train."""
    n = F.col("p_size") % 4
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), F.when(n == 0, "train").when(n == 1, "val").when(n == 2, "test").alias("split"))
    return a.select(F.explode(F.array(*map(F.lit, cand.SPLITS))).alias("wanted"), "uid", "split").where(cand.admitted(F.col("split"), F.col("wanted"))).select("wanted", "uid")


@query(
    "types_by_substring",
    """WITH a AS (SELECT p_partkey AS uid, [trim(lower(replace(x, '_', ' '))) for x in list_distinct([p_name, p_type, p_brand])] AS kinds FROM part), w AS (SELECT unnest(['bolt', 'blue w', 'econ', 'brand#2']) AS k)
    SELECT uid, min(k) AS first_match, count(DISTINCT k) AS matches FROM a, w WHERE len([x for x in kinds if contains(x, k)]) > 0 GROUP BY uid""",
)
def types_by_substring(spark, sf_dir):
    """assets one of whose possible types contains one of the wanted words (a constant list)."""
    wanted = ["bolt", "blue w", "econ", "brand#2"]
    kinds = F.array_distinct(F.array("p_name", "p_type", "p_brand"))
    found = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), cand.matches(kinds, wanted).alias("found")).where(F.size("found") > 0)
    return found.select("uid", F.array_min("found").alias("first_match"), F.size("found").cast("long").alias("matches"))


@query(
    "candidate_pipeline",
    f"""WITH o AS (SELECT l_orderkey AS scene, 'scene/' || CASE WHEN l_linenumber = 3 THEN 'added_' || l_partkey ELSE 'body_' || l_partkey || '_0' END || '/' || l_suppkey AS name, l_partkey AS uid, l_discount >= 0.02 AS free, l_quantity AS mass FROM lineitem),
    black AS (SELECT DISTINCT CASE WHEN p_size < 3 THEN p_partkey WHEN p_size = 3 THEN p_partkey END AS uid FROM part WHERE p_size <= 3), g AS (SELECT p_partkey AS uid FROM part WHERE p_size % 5 <> 0)
    SELECT scene, uid, count(*) AS bodies, round(sum(mass), 6) AS mass FROM o
    WHERE NOT (len(string_split(name, '/')) = 3 AND len(string_split(string_split(name, '/')[2], '_')) = 2) AND free AND uid NOT IN (SELECT uid FROM black) AND uid IN (SELECT uid FROM g)
    GROUP BY scene, uid HAVING sum(mass) <= 40""",
)
def candidate_pipeline(spark, sf_dir):
    """objects of a scene that can be picked: not added by hand, not static, not blacklisted by id or its hash, with a grasp, light enough."""
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    uid = F.col("l_partkey").cast("string")
    middle = F.when(F.col("l_linenumber") == 3, F.concat(F.lit("added_"), uid)).otherwise(F.concat(F.lit("body_"), uid, F.lit("_0")))
    o = items.select(
        F.col("l_orderkey").alias("scene"), F.concat_ws("/", F.lit("scene"), middle, F.col("l_suppkey").cast("string")).alias("name"),
        F.col("l_partkey").alias("uid"), (F.col("l_discount") >= 0.02).alias("free"), F.col("l_quantity").alias("mass"),
    )
    own = F.col("p_partkey").cast("string")
    black = parts.where("p_size <= 3").select(F.when(F.col("p_size") < 3, own).otherwise(F.md5(own)).alias("entry"))
    grasps = parts.where("p_size % 5 <> 0").select(F.col("p_partkey").alias("uid"))
    return cand.pickable(o, black, grasps, 40.0)


@query(
    "radius_band",
    """WITH p AS (SELECT event_id, user_id, value - 50 AS x, (event_id % 100)::DOUBLE - 50 AS y FROM events), d AS (SELECT *, sqrt(x * x + y * y) AS d FROM p WHERE x * x + y * y > 100 AND x * x + y * y < 900)
    SELECT user_id, count(*) AS n, round(min(d), 6) AS nearest, round(count(*) * 0.01 / (pi() * 800), 9) AS share FROM d GROUP BY user_id""",
)
def radius_band(spark, sf_dir):
    """Points with r0 < d < r1 of a centre, and how much of the ring's area they stand for."""
    p = table(spark, sf_dir, "events").select("user_id", (F.col("value") - 50).alias("x"), ((F.col("event_id") % 100).cast("double") - 50).alias("y"))
    inside = p.where(cand.in_band(F.col("x"), F.col("y"), 10.0, 30.0))
    n = F.count(F.lit(1))
    return inside.groupBy("user_id").agg(n.alias("n"), F.round(F.min(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))), 6).alias("nearest"), F.round(n * 0.01 / (F.pi() * 800), 9).alias("share"))


@query(
    "grasp_depths",
    """WITH g AS (SELECT s_suppkey AS grasp, CASE WHEN s_suppkey % 3 = 0 THEN abs(s_acctbal) / 10000 END AS contact_depth, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal / 10000 END AS quality FROM supplier)
    SELECT grasp, round(coalesce(quality, 1.0), 6) AS quality, 0.05::DOUBLE AS width, round(coalesce(contact_depth, 0.5), 6) AS contact_depth FROM g WHERE coalesce(contact_depth, 0.5) BETWEEN 0.2 AND 0.8""",
)
def grasp_depths(spark, sf_dir):
    """Grasps by contact depth, with defaults for values and for a whole column that are missing."""
    k = F.col("s_suppkey")
    g = table(spark, sf_dir, "supplier").select(
        k.alias("grasp"), F.when(k % 3 == 0, F.abs("s_acctbal") / 10000).alias("contact_depth"), F.when(k % 2 == 0, F.col("s_acctbal") / 10000).alias("quality")
    )
    found = cand.by_contact_depth(g, 0.2, 0.8)
    return found.select("grasp", F.round("quality", 6).alias("quality"), "width", F.round("contact_depth", 6).alias("contact_depth"))


@query(
    "moved_keys",
    """SELECT o_orderkey AS episode, CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 20 ELSE 30 END AS horizon, o_orderpriority AS task_cls, CASE WHEN o_orderkey % 2 = 0 THEN 'pick' ELSE 'open' END AS task_type, false AS still_on_top
    FROM orders""",
)
def moved_keys(spark, sf_dir):
    """A key of a document moved into one of its parts under another name; where the part has none, a default by class."""
    o = table(spark, sf_dir, "orders")
    task = F.struct(F.col("o_orderpriority").alias("task_cls"), F.lit(None).cast("int").alias("horizon"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "pick").otherwise("open")
    docs = o.select(F.col("o_orderkey").alias("episode"), task.alias("task"), kind.alias("type"))
    patched = cand.move_into(docs, "type", "task", "task_type")
    horizon = F.create_map(*[F.lit(x) for pair in {"1-URGENT": 10, "2-HIGH": 20}.items() for x in pair])
    patched = patched.withColumn("task", F.col("task").withField("horizon", F.coalesce("task.horizon", F.try_element_at(horizon, F.col("task.task_cls")), F.lit(30))))
    return patched.select("episode", "task.horizon", "task.task_cls", "task.task_type", F.lit("type" in patched.columns).alias("still_on_top"))


@query(
    "navigation_success",
    f"""WITH {STEPS}, n AS (SELECT episode, arg_min(success, (abs(q - 25), t)) AS visible, min(abs(q - 25)) AS distance FROM steps GROUP BY episode)
    SELECT episode, distance, visible, CASE WHEN visible THEN round(greatest(0, 1 - distance / 10), 6) ELSE 0 END AS reward, visible AND distance < 10 AS success FROM n""",
)
def navigation_success(spark, sf_dir):
    """the nearest candidate's distance and whether it is seen; the reward falls from 1 to 0 at the threshold."""
    return cand.navigation(steps(spark, sf_dir).select("episode", F.abs(F.col("q") - 25).alias("distance"), F.col("success").alias("visible"), "t"), 10.0)


@query(
    "placement_success",
    f"""WITH {STEPS}, p AS (SELECT episode, t, robot, q, d < 0.02 AS contact, x AS tilt, status = 'O' AS supported,
      q - first_value(q) OVER (PARTITION BY episode ORDER BY t) AS moved FROM steps),
    c AS (SELECT *, coalesce(bool_or(supported) OVER (PARTITION BY episode, floor(q / 5) ORDER BY t ROWS UNBOUNDED PRECEDING), false) AS carried FROM p)
    SELECT episode, t, carried AND NOT contact AND abs(moved) <= 15 AND tilt <= 0.06 AS success, bool_or(carried AND NOT contact AND abs(moved) <= 15 AND tilt <= 0.06) OVER (PARTITION BY episode) AS ever FROM c""",
)
def placement_success(spark, sf_dir):
    """supported (now, or earlier in the same pose), not in contact with the robot, moved and tilted within limits."""
    moved = F.col("q") - F.first("q").over(Window.partitionBy("episode").orderBy("t"))
    rows = steps(spark, sf_dir).select(
        "episode", "t", F.floor(F.col("q") / 5).alias("pose"), (F.col("d") < 0.02).alias("contact"), F.col("x").alias("tilt"), (F.col("status") == "O").alias("supported"), moved.alias("moved")
    )
    return cand.placement(rows, 15.0, 0.06)


@query(
    "quota_with_leftover",
    f"""WITH {STEPS}, p AS (SELECT episode, t, success AS foreground, md5('q|' || episode || '|' || t) AS h FROM steps),
    r AS (SELECT *, row_number() OVER (PARTITION BY episode, foreground ORDER BY h, t) AS n, count(*) FILTER (NOT foreground) OVER (PARTITION BY episode) AS back, count(*) FILTER (foreground) OVER (PARTITION BY episode) AS front FROM p)
    SELECT episode, t, foreground FROM r WHERE n <= CASE WHEN foreground THEN 3 - least(back, 2) ELSE least(back, 2) END""",
)
def quota_with_leftover(spark, sf_dir):
    """Three points an episode, two of them for the background; what it cannot fill goes back to the foreground."""
    s = steps(spark, sf_dir).select("episode", "t", F.col("success").alias("foreground"))
    order = F.md5(F.concat_ws("|", F.lit("q"), F.col("episode").cast("string"), F.col("t").cast("string")))
    return cand.two_quotas(s, "episode", "foreground", [order, F.col("t")], 3, 2)


@query(
    "keyword_classes",
    """WITH k AS (SELECT p_partkey, lower(p_type) AS category, lower(p_name) AS name FROM part)
    SELECT p_partkey, CASE WHEN contains(category, 'econ') OR contains(category, 'prom') THEN 'category' WHEN contains(name, 'ring') OR contains(name, 'widget') THEN 'name' ELSE 'none' END AS matched FROM k""",
)
def keyword_classes(spark, sf_dir):
    """Whether a keyword of a list occurs in the category, else in the name."""
    p = table(spark, sf_dir, "part")
    found = F.when(cand.any_keyword("p_type", ["econ", "prom"]), "category").when(cand.any_keyword("p_name", ["ring", "widget"]), "name")
    return p.select("p_partkey", found.otherwise("none").alias("matched"))


@query(
    "inferred_types",
    """SELECT o_orderkey AS episode, CASE WHEN o_orderkey % 5 = 0 THEN 'given' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pick' ELSE 'open' END AS task_type FROM orders""",
)
def inferred_types(spark, sf_dir):
    """An explicit type, else the one of the class, else an error (no class is unknown here; a test has one)."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), F.when(F.col("o_orderkey") % 5 == 0, "given").alias("given"), F.col("o_orderpriority").alias("cls"))
    known = {"1-URGENT": "pick", "2-HIGH": "pick", "3-MEDIUM": "open", "4-NOT SPECIFIED": "open", "5-LOW": "open"}
    return o.select("episode", cand.inferred(F.col("given"), F.col("cls"), known).alias("task_type"))


@query(
    "attributed_includes",
    """WITH i AS (SELECT l_suppkey AS scene, p_brand AS source, p_partkey AS asset, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
    d AS (SELECT DISTINCT scene, source, asset, CASE WHEN p_type = 'ECONOMY' THEN 'CC-BY 4.0' WHEN p_type = 'PROMO' THEN 'ODC-BY' ELSE 'Apache-2.0' END AS license FROM i)
    SELECT scene, source, count(*) AS assets, string_agg(DISTINCT license, '; ' ORDER BY license) AS attribution FROM d GROUP BY scene, source""",
)
def attributed_includes(spark, sf_dir):
    """What a scene includes by source, with the licenses to name; a type without a rule is an error."""
    rules = dict.fromkeys(("LARGE", "MEDIUM", "SMALL", "STANDARD"), "Apache-2.0") | {"ECONOMY": "CC-BY 4.0", "PROMO": "ODC-BY"}
    i = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("scene"), "l_partkey").distinct()
    i = i.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    licensed = i.select("scene", F.col("p_brand").alias("source"), F.col("p_partkey").alias("asset"), cand.license_of(F.col("p_type"), rules).alias("license"))
    counted = licensed.groupBy("scene", "source", "license").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("scene", "source").agg(F.sum("n").alias("assets"), F.array_join(F.array_sort(F.collect_set("license")), "; ").alias("attribution"))


@query("feature_clusters")
def feature_clusters(spark, sf_dir):
    """Standardised features by k-means with a fixed start; tests check its labels against the nearest centre, and the fallback."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(64)])
    return cand.clusters(e, "vec_id", [f"x{i}" for i in range(64)], 8, Workspace(spark, "clusters")).select("vec_id", "cluster")
