"""Queries on joins, set operations and document repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import relations as rel
from weft.operators.sequences import global_rank
from weft.plans.registry import query
from weft.plans.standins import EPISODES, STEPS, episodes, steps
from weft.sources.tables import table
from weft.workspace import Workspace


@query(
    "lookup_fallback",
    """SELECT d.doc_id, coalesce('b' || b.item_id, 'l' || l.quality, 'none') AS asset FROM documents d
    LEFT JOIN benchmark b ON b.item_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def lookup_fallback(spark, sf_dir):
    """Two lookups, the first that has the key wins, else a default."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.concat(F.lit("b"), "item_id").alias("b"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("l"), "quality").alias("l"))
    return d.join(b, "doc_id", "left").join(labels, "doc_id", "left").select("doc_id", F.coalesce("b", "l", F.lit("none")).alias("asset"))


@query("blacklist_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def blacklist_anti(spark, sf_dir):
    """Rows that are not blacklisted."""
    black = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(black, "doc_id", "left_anti")


@query("semi_keep", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_keep(spark, sf_dir):
    """Rows in a set."""
    kept = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(kept, "doc_id", "left_semi")


ASSETS = "assets AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN md5(p_partkey::VARCHAR) ELSE p_partkey::VARCHAR END AS key, p_size FROM part)"


def assets(spark, sf_dir):
    uid = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.md5(uid)).otherwise(uid).alias("key"), "p_size")


@query(
    "dual_hash_lookup",
    f"""WITH {ASSETS}, s AS (SELECT s_suppkey::VARCHAR AS uid, s_name FROM supplier)
    SELECT key, p_size, uid, s_name FROM assets JOIN s ON key = uid UNION ALL SELECT key, p_size, uid, s_name FROM assets JOIN s ON key = md5(uid)""",
)
def dual_hash_lookup(spark, sf_dir):
    """A key that is a uid or the hash of one."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("uid"), "s_name")
    return rel.by_key_or_hash(assets(spark, sf_dir), "key", s, "uid")


@query(
    "hash_blacklist",
    f"""WITH {ASSETS}, b AS (SELECT s_suppkey::VARCHAR AS uid FROM supplier WHERE s_nationkey < 12)
    SELECT key, p_size FROM assets WHERE key NOT IN (SELECT uid FROM b) AND key NOT IN (SELECT md5(uid) FROM b)""",
)
def hash_blacklist(spark, sf_dir):
    """blacklisted by uid or by its hash."""
    black = table(spark, sf_dir, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("uid"))
    return rel.without_blacklisted(assets(spark, sf_dir), "key", black, "uid")


@query(
    "camera_completeness",
    """SELECT user_id AS episode FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id HAVING count(DISTINCT event_type) = 3""",
)
def camera_completeness(spark, sf_dir):
    """Episodes that have every required camera."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), "event_type")
    return rel.having_all(e, "episode", "event_type", ["click", "view", "purchase"])


@query(
    "scene_inverse_index",
    f"""WITH {STEPS}, {EPISODES} SELECT p_type AS category, count(DISTINCT house) AS scenes, count(DISTINCT part) AS assets,
      array_to_string(list_sort(list(DISTINCT house)), ',') AS houses
    FROM steps JOIN episodes USING (episode) JOIN part ON part = p_partkey GROUP BY p_type""",
)
def scene_inverse_index(spark, sf_dir):
    """Category to the sets of scenes and assets it is in."""
    s = steps(spark, sf_dir).join(episodes(spark, sf_dir), "episode").join(table(spark, sf_dir, "part"), F.col("part") == F.col("p_partkey"))
    houses = s.select(F.col("p_type").alias("category"), "house").distinct().groupBy("category").agg(F.count(F.lit(1)).alias("scenes"), F.array_join(F.sort_array(F.collect_list("house")), ",").alias("houses"))
    parts = s.select(F.col("p_type").alias("category"), "part").distinct().groupBy("category").agg(F.count(F.lit(1)).alias("assets"))
    return houses.join(parts, "category").select("category", "scenes", "assets", "houses")


BOXES = "boxes AS (SELECT s_suppkey AS box, s_acctbal AS x0, s_acctbal + 150 AS x1, s_suppkey::DOUBLE AS y0, s_suppkey + 40.0 AS y1 FROM supplier)"
POINTS = "points AS (SELECT c_custkey AS point, c_acctbal AS px, (c_custkey % 100)::DOUBLE AS py FROM customer)"


def boxes_and_points(spark, sf_dir):
    b = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("box"), F.col("s_acctbal").alias("x0"), (F.col("s_acctbal") + 150).alias("x1"),
        F.col("s_suppkey").cast("double").alias("y0"), (F.col("s_suppkey") + 40.0).alias("y1"),
    )
    p = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("point"), F.col("c_acctbal").alias("px"), (F.col("c_custkey") % 100).cast("double").alias("py")
    )
    return b, p


@query("points_in_boxes", f"WITH {BOXES}, {POINTS} SELECT box, point FROM boxes JOIN points ON px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1")
def points_in_boxes(spark, sf_dir):
    """Containment as an equi join on grid cells with a residual comparison."""
    b, p = boxes_and_points(spark, sf_dir)
    return rel.points_in_boxes(p, b, 100.0).select("box", "point")


@query("support_below", f"WITH {BOXES}, {POINTS} SELECT point, arg_max(box, (y0, -box)) AS support FROM boxes JOIN points ON px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1 GROUP BY point")
def support_below(spark, sf_dir):
    """The highest support under a point; of equals the first."""
    b, p = boxes_and_points(spark, sf_dir)
    found = rel.points_in_boxes(p, b, 100.0)
    return found.groupBy("point").agg(F.max_by("box", F.struct("y0", -F.col("box"))).alias("support"))


@query(
    "structural_diff",
    """WITH a AS (SELECT p_partkey AS path, p_retailprice AS v FROM part WHERE p_partkey % 10 <> 1),
    b AS (SELECT p_partkey AS path, p_retailprice + CASE WHEN p_size > 45 THEN 1 ELSE 0.0005 END AS v FROM part WHERE p_partkey % 10 <> 2)
    SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'left only' WHEN a.path IS NULL THEN 'right only' ELSE 'differs' END AS state
    FROM a FULL JOIN b ON a.path = b.path WHERE a.path IS NULL OR b.path IS NULL OR abs(a.v - b.v) > 0.001 + 0.00001 * abs(b.v)""",
)
def structural_diff(spark, sf_dir):
    """Both one-sided differences, and mismatches beyond a tolerance."""
    p = table(spark, sf_dir, "part")
    a = p.where("p_partkey % 10 <> 1").select(F.col("p_partkey").alias("path"), F.col("p_retailprice").alias("v"))
    b = p.where("p_partkey % 10 <> 2").select(
        F.col("p_partkey").alias("path"), (F.col("p_retailprice") + F.when(F.col("p_size") > 45, 1.0).otherwise(0.0005)).alias("v")
    )
    return rel.structural_diff(a, b, "path", "v", 0.001, 0.00001)


@query(
    "name_candidates",
    """WITH f AS (SELECT c_custkey, c_name AS name FROM customer WHERE c_custkey % 3 <> 0), w AS (SELECT o_orderkey, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS exact,
      'Customer#' || lpad((o_custkey + 1)::VARCHAR, 9, '0') AS other FROM orders)
    SELECT o_orderkey, coalesce(a.name, b.name) AS file, CASE WHEN a.name IS NOT NULL THEN 1 WHEN b.name IS NOT NULL THEN 2 END AS rank
    FROM w LEFT JOIN f a ON a.name = exact LEFT JOIN f b ON b.name = other""",
)
def name_candidates(spark, sf_dir):
    """A computed file name, and a second one where the first is missing."""
    f = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_name").alias("name"))
    name = lambda k: F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0"))
    w = table(spark, sf_dir, "orders").select("o_orderkey", name(F.col("o_custkey")).alias("exact"), name(F.col("o_custkey") + 1).alias("other"))
    a, b = f.select(F.col("name").alias("a")), f.select(F.col("name").alias("b"))
    found = w.join(a, F.col("exact") == F.col("a"), "left").join(b, F.col("other") == F.col("b"), "left")
    rank = F.when(F.col("a").isNotNull(), 1).when(F.col("b").isNotNull(), 2)
    return found.select("o_orderkey", F.coalesce("a", "b").alias("file"), rank.alias("rank"))


@query(
    "token_index_lookup",
    """WITH i AS (SELECT DISTINCT item_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM benchmark)
    SELECT token, count(*) AS archives FROM i WHERE length(token) >= 6 GROUP BY token HAVING count(*) >= 2""",
)
def token_index_lookup(spark, sf_dir):
    """An inverted index of tokens."""
    tokens = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("token")
    index = table(spark, sf_dir, "benchmark").select("item_id", tokens).distinct().where(F.length("token") >= 6)
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("archives")).where("archives >= 2")


@query(
    "as_of_value",
    """SELECT p.event_id, v.value AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
    ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def as_of_value(spark, sf_dir):
    """Each purchase with the user's last view before it."""
    e = table(spark, sf_dir, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("last_view"))
    return rel.as_of(left, right, "user_id", "ts", "last_view").select("event_id", "last_view")


@query(
    "near_duplicate_removal",
    """WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, (c_custkey % 50)::DOUBLE AS y FROM customer)
    SELECT id, x, y FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE a.id < b.id AND abs(a.x - b.x) <= 5 AND abs(a.y - b.y) <= 5)""",
)
def near_duplicate_removal(spark, sf_dir):
    """Of points closer than a tolerance the later one stays."""
    p = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 50).cast("double").alias("y"))
    return rel.near_duplicates(p, ["x", "y"], 5.0)


CONTACTS = "contacts AS (SELECT l_partkey % 200 AS a, l_suppkey % 200 AS b, l_discount AS dist FROM lineitem WHERE l_partkey % 200 <> l_suppkey % 200)"


def contacts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 200).alias("a"), (F.col("l_suppkey") % 200).alias("b"), F.col("l_discount").alias("dist")
    ).where("a <> b")


@query("contact_pairs", f"WITH {CONTACTS} SELECT least(a, b) AS first, greatest(a, b) AS second, count(*) AS contacts FROM contacts WHERE dist < 0.03 GROUP BY 1, 2")
def contact_pairs(spark, sf_dir):
    """P10: contacts by unordered pair."""
    return contacts(spark, sf_dir).where("dist < 0.03").groupBy(F.least("a", "b").alias("first"), F.greatest("a", "b").alias("second")).agg(F.count(F.lit(1)).alias("contacts"))


@query(
    "neighbour_sets",
    f"WITH {CONTACTS}, e AS (SELECT a, b FROM contacts WHERE dist < 0.03 UNION ALL SELECT b, a FROM contacts WHERE dist < 0.03) SELECT a AS body, count(DISTINCT b) AS others, count(*) AS ends FROM e GROUP BY a",
)
def neighbour_sets(spark, sf_dir):
    """Symmetric neighbour sets."""
    c = contacts(spark, sf_dir).where("dist < 0.03")
    both = c.select("a", "b").unionByName(c.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(F.col("a").alias("body")).agg(F.count_distinct("b").alias("others"), F.count(F.lit(1)).alias("ends"))


@query(
    "union_renumbered",
    """SELECT row_number() OVER (ORDER BY file, i) AS trajectory, file, i FROM (SELECT 'a' AS file, c_custkey AS i FROM customer UNION ALL SELECT 'b', s_suppkey FROM supplier)""",
)
def union_renumbered(spark, sf_dir):
    """Episodes of several files as one, renumbered by file and their order in it."""
    a = table(spark, sf_dir, "customer").select(F.lit("a").alias("file"), F.col("c_custkey").alias("i"))
    every = a.unionByName(table(spark, sf_dir, "supplier").select(F.lit("b").alias("file"), F.col("s_suppkey").alias("i")))
    return global_rank(every, [F.col("file"), F.col("i")], Workspace(spark, "union"), "trajectory").select("trajectory", "file", "i")


@query("key_union", """SELECT user_id AS episode, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS keys, count(DISTINCT event_type) AS n FROM events GROUP BY user_id""")
def key_union(spark, sf_dir):
    """All keys that occur at any step."""
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("episode")).agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("keys"), F.count_distinct("event_type").alias("n")
    )


@query(
    "set_algebra",
    """SELECT 'both' AS part, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
    SELECT 'customers only', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL
    SELECT 'suppliers only', count(*) FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer) UNION ALL
    SELECT 'except constants', count(*) FROM (SELECT DISTINCT n_nationkey FROM nation WHERE n_nationkey NOT IN (1, 2, 3)) UNION ALL
    SELECT 'xor', count(*) FROM lineitem WHERE (l_returnflag = 'R') <> (l_linestatus = 'F')""",
)
def set_algebra(spark, sf_dir):
    """Differences, intersection, constants and exclusive or."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    constants = table(spark, sf_dir, "nation").select("n_nationkey").distinct().where(~F.col("n_nationkey").isin(1, 2, 3))
    xor = table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") != (F.col("l_linestatus") == "F"))
    parts = [("both", c.intersect(s)), ("customers only", c.subtract(s)), ("suppliers only", s.subtract(c)), ("except constants", constants), ("xor", xor)]
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


@query(
    "flipped_copies",
    """WITH g AS (SELECT s_suppkey AS i, s_acctbal AS a FROM supplier), n AS (SELECT count(*) AS n FROM supplier)
    SELECT i AS copy, i AS original, a FROM g UNION ALL SELECT i + n, i, -a FROM g, n""",
)
def flipped_copies(spark, sf_dir):
    """Originals and their mirrored copies, whose original is the number modulo half."""
    g = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("i"), F.col("s_acctbal").alias("a"))
    n = g.agg(F.count(F.lit(1)).alias("n"))
    flipped = g.crossJoin(F.broadcast(n)).select((F.col("i") + F.col("n")).alias("copy"), F.pmod(F.col("i") + F.col("n"), F.col("n")).alias("original"), (-F.col("a")).alias("a"))
    return g.select(F.col("i").alias("copy"), F.col("i").alias("original"), "a").unionByName(flipped)


@query(
    "version_mismatches",
    """WITH e AS (SELECT n_nationkey AS k, n_regionkey AS v FROM nation), g AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 7 = 0 THEN 9 ELSE n_regionkey END AS v FROM nation WHERE n_nationkey <> 3)
    SELECT coalesce(e.k, g.k) AS k, e.v::VARCHAR AS expected, g.v::VARCHAR AS found FROM e FULL JOIN g ON e.k = g.k WHERE e.v IS DISTINCT FROM g.v""",
)
def version_mismatches(spark, sf_dir):
    """F32: expected and found versions that do not agree."""
    n = table(spark, sf_dir, "nation")
    e = n.select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("expected"))
    g = n.where("n_nationkey <> 3").select(F.col("n_nationkey").alias("k"), F.when(F.col("n_nationkey") % 7 == 0, 9).otherwise(F.col("n_regionkey")).alias("found"))
    return e.join(g, "k", "full_outer").where(~F.col("expected").eqNullSafe(F.col("found"))).select("k", F.col("expected").cast("string"), F.col("found").cast("string"))


@query(
    "layer_overlay",
    """SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN p_size + 100 ELSE p_size END AS size, p_brand AS brand FROM part""",
)
def layer_overlay(spark, sf_dir):
    """Settings of a later layer replace those of an earlier one, leaf by leaf."""
    p = table(spark, sf_dir, "part")
    base = p.select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    late = p.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("k"), (F.col("p_size") + 100).alias("size"))
    return rel.overlay(base, late, key="k")


@query(
    "unknown_overrides",
    """SELECT k AS name FROM (SELECT unnest([1, 5, 999999, 1000001]) AS k) WHERE k NOT IN (SELECT p_partkey FROM part)""",
)
def unknown_overrides(spark, sf_dir):
    """P20: overrides that name nothing."""
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in (1, 5, 999999, 1000001)])).alias("name"))
    return wanted.join(table(spark, sf_dir, "part"), F.col("name") == F.col("p_partkey"), "left_anti")


@query(
    "broken_archives",
    """WITH e AS (SELECT o_orderkey AS archive, i AS leaf FROM orders, range(1, 3) AS r(i)), p AS (SELECT DISTINCT l_orderkey AS archive, l_linenumber AS leaf FROM lineitem)
    SELECT e.archive, count(*) AS missing FROM e LEFT JOIN p ON p.archive = e.archive AND p.leaf = e.leaf WHERE p.archive IS NULL GROUP BY e.archive""",
)
def broken_archives(spark, sf_dir):
    """Archives that lack an expected leaf."""
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("archive"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("leaf"))
    present = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("archive"), F.col("l_linenumber").alias("leaf")).distinct()
    return expected.join(present, ["archive", "leaf"], "left_anti").groupBy("archive").agg(F.count(F.lit(1)).alias("missing"))


@query(
    "manifest_merge",
    """SELECT c_mktsegment AS kind, c_nationkey AS source, 'v1' AS version FROM customer WHERE c_nationkey < 10 GROUP BY ALL
    UNION ALL SELECT * FROM (SELECT DISTINCT c_mktsegment, c_nationkey, 'v2' FROM customer WHERE c_nationkey >= 5) n(kind, source, version)
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = n.kind AND c.c_nationkey = n.source AND c.c_nationkey < 10)""",
)
def manifest_merge(spark, sf_dir):
    """Entries are added where they are absent."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").alias("source")).distinct()
    old = c.where("source < 10").withColumn("version", F.lit("v1"))
    new = c.where("source >= 5").withColumn("version", F.lit("v2"))
    return old.unionByName(new.join(old.select("kind", "source"), ["kind", "source"], "left_anti"))


@query("scene_index", """WITH h AS (SELECT c_custkey // 2 AS i, c_nationkey % 2 AS variant, min(c_name) AS path FROM customer WHERE c_acctbal > 0 GROUP BY 1, 2)
    SELECT r.i, max(path) FILTER (variant = 0) AS base, max(path) FILTER (variant = 1) AS ceiling FROM range(0, (SELECT max(i) + 1 FROM h)) r(i) LEFT JOIN h ON h.i = r.i GROUP BY r.i""")
def scene_index(spark, sf_dir):
    """An index over a range with gaps filled by nulls, variants side by side."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    h = c.groupBy(F.floor(F.col("c_custkey") / 2).alias("i"), (F.col("c_nationkey") % 2).alias("variant")).agg(F.min("c_name").alias("path"))
    wide = h.groupBy("i").pivot("variant", [0, 1]).agg(F.first("path")).withColumnsRenamed({"0": "base", "1": "ceiling"})
    every = h.agg(F.explode(F.sequence(F.lit(0).cast("long"), F.max("i"))).alias("i"))
    return every.join(wide, "i", "left").select("i", "base", "ceiling")


@query(
    "cube_and_pivot",
    """SELECT l_returnflag AS flag, l_linestatus AS status, grouping_id(l_returnflag, l_linestatus)::BIGINT AS level, count(*) AS n, count(*) FILTER (l_quantity <= 25) AS small, count(*) FILTER (l_quantity > 25) AS large
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def cube_and_pivot(spark, sf_dir):
    """All grouping sets of two columns, and a pivot by conditional counts."""
    small = F.col("l_quantity") <= 25
    return table(spark, sf_dir, "lineitem").cube(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.count_if(small).alias("small"), F.count_if(~small).alias("large")
    )


@query(
    "natural_and_lateral",
    """SELECT n_name, r_name, top.c_custkey AS first_customer, coalesce(top.c_acctbal, 0) AS balance FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN LATERAL (SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = n_nationkey ORDER BY c_custkey LIMIT 1) top ON true""",
)
def natural_and_lateral(spark, sf_dir):
    """A natural join by the shared name, and a lateral one that looks up the first customer of each nation."""
    n, r = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "regionkey"), table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "regionkey")
    work = {"nations": n, "regions": r, "customers": table(spark, sf_dir, "customer")}
    return spark.sql(
        """SELECT n_name, r_name, top.c_custkey AS first_customer, coalesce(top.c_acctbal, 0) AS balance FROM {nations} NATURAL JOIN {regions}
        LEFT JOIN LATERAL (SELECT min(c_custkey) AS c_custkey, min_by(c_acctbal, c_custkey) AS c_acctbal FROM {customers} WHERE c_nationkey = n_nationkey) top""",
        **work,
    )


@query("sketches", "SELECT l_returnflag, count(DISTINCT l_partkey) AS distinct_parts, true AS distinct_close, true AS median_close FROM lineitem GROUP BY l_returnflag")
def sketches(spark, sf_dir):
    """Exact distinct counts beside an approximate count and quantile, and whether these are within their bounds."""
    exact = F.count_distinct("l_partkey")
    median, close = F.percentile("l_extendedprice", F.lit(0.5)), F.approx_percentile("l_extendedprice", 0.5, 1000)
    spread = F.max("l_extendedprice") - F.min("l_extendedprice")
    found = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(exact.alias("distinct_parts"), F.approx_count_distinct("l_partkey", 0.02).alias("a"), median.alias("m"), close.alias("q"), spread.alias("s"))
    return found.select("l_returnflag", "distinct_parts", (F.abs(F.col("a") - F.col("distinct_parts")) <= 0.1 * F.col("distinct_parts")).alias("distinct_close"), (F.abs(F.col("m") - F.col("q")) <= 0.02 * F.col("s")).alias("median_close"))
