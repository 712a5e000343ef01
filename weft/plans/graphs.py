"""Queries on taxonomies, trees, grids, and numbers that need an algorithm."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.operators import episodes as eps
from weft.operators import graphs, numeric
from weft.plans.episodes import by_category
from weft.plans.registry import query
from weft.plans.standins import STEPS, steps
from weft.sources.tables import table
from weft.workspace import Workspace

EDGES = """edges AS (SELECT p_partkey::VARCHAR AS child, p_name AS parent FROM part UNION SELECT DISTINCT p_name, p_type FROM part UNION SELECT DISTINCT p_name, p_brand FROM part
  UNION SELECT DISTINCT p_type, 'ROOT' FROM part UNION SELECT DISTINCT p_brand, 'ROOT' FROM part)"""
CLOSED = f"""WITH RECURSIVE {EDGES}, walk AS (SELECT child AS node, parent AS ancestor, 1 AS distance FROM edges UNION SELECT w.node, e.parent, w.distance + 1 FROM walk w JOIN edges e ON e.child = w.ancestor),
  closed AS (SELECT node, ancestor, min(distance) AS distance FROM walk GROUP BY ALL)"""
EXCLUDED = "excluded AS (SELECT 'ROOT' AS node UNION SELECT DISTINCT p_brand FROM part WHERE p_size > 30)"


def edges(spark, sf_dir):
    """A taxonomy that grows with the table: parts below names, names below types and brands, these below the root."""
    p = table(spark, sf_dir, "part")
    leaf, name, kind, brand, root = F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type"), F.col("p_brand"), F.lit("ROOT")
    pairs = F.array(*[F.struct(a.alias("child"), b.alias("parent")) for a, b in ((leaf, name), (name, kind), (name, brand), (kind, root), (brand, root))])
    return p.select(F.inline(pairs)).distinct()


def closed(spark, sf_dir, with_self=False):
    return graphs.closure(edges(spark, sf_dir), Workspace(spark, "taxonomy"), with_self=with_self)


def excluded(spark, sf_dir):
    root = spark.range(1).select(F.lit("ROOT").alias("node"))
    return root.unionByName(table(spark, sf_dir, "part").where("p_size > 30").select(F.col("p_brand").alias("node")).distinct())


@query("hypernym_closure", f"{CLOSED} SELECT node, ancestor, distance::INT AS distance FROM closed")
def hypernym_closure(spark, sf_dir):
    """Every node with its ancestors (a node with two parents reaches the root on both ways)."""
    return closed(spark, sf_dir)


@query("hypernyms_without_excluded", f"{CLOSED}, {EXCLUDED} SELECT node, count(*) AS ancestors FROM closed WHERE ancestor NOT IN (SELECT node FROM excluded) GROUP BY node")
def hypernyms_without_excluded(spark, sf_dir):
    """Ancestors without an excluded set; leaving a node out does not leave out what lies below it."""
    kept = closed(spark, sf_dir).join(excluded(spark, sf_dir).select(F.col("node").alias("ancestor")), "ancestor", "left_anti")
    return kept.groupBy("node").agg(F.count(F.lit(1)).alias("ancestors"))


@query("hyponym_counts", f"{CLOSED}, own AS (SELECT node, ancestor FROM closed UNION SELECT child, child FROM edges UNION SELECT parent, parent FROM edges) SELECT ancestor AS root, count(*) AS descendants FROM own GROUP BY ancestor")
def hyponym_counts(spark, sf_dir):
    """Descendants of every root, itself included."""
    return closed(spark, sf_dir, with_self=True).groupBy(F.col("ancestor").alias("root")).agg(F.count(F.lit(1)).alias("descendants"))


SET = "s AS (SELECT p_partkey::VARCHAR AS node FROM part WHERE p_size > 40 UNION SELECT DISTINCT p_name FROM part WHERE p_retailprice < 950 UNION SELECT DISTINCT p_type FROM part WHERE p_type LIKE '%O%')"


def node_set(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    leaves = p.where("p_size > 40").select(F.col("p_partkey").cast("string").alias("node"))
    names = p.where("p_retailprice < 950").select(F.col("p_name").alias("node"))
    return leaves.unionByName(names).unionByName(p.where("p_type LIKE '%O%'").select(F.col("p_type").alias("node"))).distinct()


@query("drop_hyponyms", f"{CLOSED}, {SET} SELECT node FROM s WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.node = s.node AND c.ancestor IN (SELECT node FROM s))")
def drop_hyponyms(spark, sf_dir):
    """Members that have no ancestor in the set."""
    return graphs.drop_dominated(node_set(spark, sf_dir), closed(spark, sf_dir))


@query("most_concrete", f"{CLOSED}, {SET} SELECT node FROM s WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.ancestor = s.node AND c.node IN (SELECT node FROM s))")
def most_concrete(spark, sf_dir):
    """Members with no other member below them."""
    return graphs.most_concrete(node_set(spark, sf_dir), closed(spark, sf_dir))


@query("highest_hypernym", f"{CLOSED}, {EXCLUDED} SELECT node, arg_min(ancestor, (-distance, ancestor)) AS highest FROM closed WHERE ancestor NOT IN (SELECT node FROM excluded) GROUP BY node")
def highest_hypernym(spark, sf_dir):
    """The highest ancestor that counts."""
    return graphs.highest_relevant(closed(spark, sf_dir), excluded(spark, sf_dir))


@query("singleton_hypernyms", f"{CLOSED}, {EXCLUDED}, h AS (SELECT node, arg_min(ancestor, (-distance, ancestor)) AS highest FROM closed WHERE ancestor NOT IN (SELECT node FROM excluded) GROUP BY node) SELECT highest, count(*) AS n FROM h GROUP BY highest HAVING count(*) < 20")
def singleton_hypernyms(spark, sf_dir):
    """Highest ancestors with few nodes."""
    h = graphs.highest_relevant(closed(spark, sf_dir), excluded(spark, sf_dir))
    return h.groupBy("highest").agg(F.count(F.lit(1)).alias("n")).where("n < 20")


BODIES = "bodies AS (SELECT s_suppkey AS child, s_suppkey // 3 AS parent FROM supplier)"


@query("body_tree", f"WITH RECURSIVE {BODIES}, walk AS (SELECT child AS node, parent AS ancestor, 1 AS d FROM bodies WHERE child <> parent UNION ALL SELECT w.node, b.parent, d + 1 FROM walk w JOIN bodies b ON b.child = w.ancestor WHERE b.child <> b.parent) SELECT node, count(*) AS depth, string_agg(ancestor::VARCHAR, '/' ORDER BY d) AS path FROM walk GROUP BY node")
def body_tree(spark, sf_dir):
    """Ancestors of the bodies of a tree whose root is its own parent."""
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("child"), F.floor(F.col("s_suppkey") / 3).alias("parent"))
    found = graphs.closure(b, Workspace(spark, "bodies"))
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("distance", "ancestor"))), lambda x: x.ancestor.cast("string")), "/")
    return found.groupBy("node").agg(F.count(F.lit(1)).alias("depth"), path.alias("path"))


@query("support_chain", """WITH RECURSIVE b AS (SELECT s_suppkey AS box, s_acctbal AS h, s_nationkey AS room FROM supplier), up AS (SELECT a.box, arg_max(c.box, (c.h, -c.box)) AS support FROM b a JOIN b c ON a.room = c.room AND c.h < a.h GROUP BY a.box),
    walk AS (SELECT box, support, 1 AS d FROM up UNION ALL SELECT w.box, u.support, d + 1 FROM walk w JOIN up u ON u.box = w.support) SELECT box, max(d) AS links, arg_max(support, d) AS ground FROM walk GROUP BY box""")
def support_chain(spark, sf_dir):
    """The chain of best supports down to the ground. A box rests on the first box of the next lower height in its room."""
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("box"), F.col("s_acctbal").alias("h"), F.col("s_nationkey").alias("room"))
    heights = b.groupBy("room", "h").agg(F.min("box").alias("top"))
    below = heights.withColumn("support", F.lag("top").over(Window.partitionBy("room").orderBy("h"))).where("support IS NOT NULL")
    up = b.join(below, ["room", "h"]).select(F.col("box").alias("node"), F.col("support").alias("parent"))
    return graphs.roots(up, Workspace(spark, "support")).select(F.col("node").alias("box"), F.col("links").cast("int").alias("links"), F.col("root").alias("ground"))


CELLS = "cells AS (SELECT DISTINCT (c_custkey // 40)::INT AS r, (c_custkey % 40)::INT AS c FROM customer WHERE c_acctbal > 1500)"


def cells(spark, sf_dir):
    """A map of 40 columns whose rows grow with the table; customers with money are free cells."""
    k = F.col("c_custkey")
    free = table(spark, sf_dir, "customer").where("c_acctbal > 1500").select(F.floor(k / 40).cast("int").alias("r"), (k % 40).cast("int").alias("c")).distinct()
    return free.select("r", "c", (F.col("r") % 5 + F.col("c") % 3 + 1).cast("double").alias("cost"), (F.col("r") * 100 + F.col("c")).cast("long").alias("id"))


@query("grid_edges", f"WITH {CELLS}, w AS (SELECT *, (r % 5 + c % 3 + 1)::DOUBLE AS cost FROM cells) SELECT a.r, a.c, b.r AS r2, b.c AS c2, greatest(a.cost, b.cost) AS weight FROM w a JOIN w b ON (b.r = a.r + 1 AND b.c = a.c) OR (b.r = a.r AND b.c = a.c + 1)")
def grid_edges(spark, sf_dir):
    """The 4-neighbour graph of free cells."""
    return graphs.grid_edges(cells(spark, sf_dir).select("r", "c", "cost"))


@query("largest_free_area", f"""WITH RECURSIVE {CELLS}, e AS (SELECT a.r * 100 + a.c AS a, b.r * 100 + b.c AS b FROM cells a JOIN cells b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
    walk AS (SELECT r * 100 + c AS v, r * 100 + c AS u FROM cells UNION SELECT v, b FROM walk JOIN e ON a = u), l AS (SELECT v, min(u) AS component FROM walk GROUP BY v)
    SELECT component::BIGINT AS component, count(*) AS area FROM l GROUP BY component ORDER BY area DESC, component LIMIT 3""")
def largest_free_area(spark, sf_dir):
    """Connected free areas, the largest ones."""
    found = graphs.grid_components(cells(spark, sf_dir), Workspace(spark, "grid"))
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("area")).orderBy(F.desc("area"), "component").limit(3)


@query("dilated_cells", f"WITH {CELLS} SELECT DISTINCT (r + i)::INT AS r, (c + j)::INT AS c FROM cells, range(-1, 2) AS a(i), range(-1, 2) AS b(j)")
def dilated_cells(spark, sf_dir):
    """Occupied cells grown by a radius."""
    return graphs.dilate(cells(spark, sf_dir).select("r", "c"), 1)


@query("eroded_cells", f"WITH {CELLS} SELECT a.r, a.c FROM cells a JOIN cells b ON abs(a.r - b.r) <= 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY a.r, a.c HAVING count(*) = 9")
def eroded_cells(spark, sf_dir):
    """Occupied cells shrunk by a radius."""
    return graphs.erode(cells(spark, sf_dir).select("r", "c"), 1)


@query("obstacle_distances", f"""WITH {CELLS}, o AS (SELECT (c_custkey // 40)::INT AS r, (c_custkey % 40)::INT AS c FROM customer WHERE c_acctbal <= 1500)
    SELECT f.r, f.c, round(sqrt(min((f.r - o.r) ** 2 + (f.c - o.c) ** 2)), 6)::DOUBLE AS distance FROM cells f LEFT JOIN o ON true GROUP BY f.r, f.c""")
def obstacle_distances(spark, sf_dir):
    """The exact distance of free cells to the nearest obstacle, however far."""
    k = F.col("c_custkey")
    obstacles = table(spark, sf_dir, "customer").where("c_acctbal <= 1500").select(F.floor(k / 40).cast("int").alias("r"), (k % 40).cast("int").alias("c")).distinct()
    return graphs.distances(cells(spark, sf_dir).select("r", "c"), obstacles).select("r", "c", F.round("distance", 6).alias("distance"))


@query("far_obstacle_distances", """WITH p AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_size FROM part), o AS (SELECT r, c FROM p WHERE p_size = 1 AND c > 30)
    SELECT p.r::INT AS r, p.c::INT AS c, round(sqrt(min((p.r - o.r) ** 2 + (p.c - o.c) ** 2)), 6)::DOUBLE AS distance FROM p LEFT JOIN o ON true WHERE p_size <> 1 GROUP BY p.r, p.c""")
def far_obstacle_distances(spark, sf_dir):
    """Distances on a map with few obstacles on one side, so most are far away."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(F.floor(k / 50).cast("int").alias("r"), (k % 50).cast("int").alias("c"), "p_size")
    found = graphs.distances(p.where("p_size <> 1").select("r", "c"), p.where("p_size = 1 AND c > 30").select("r", "c"))
    return found.select("r", "c", F.round("distance", 6).alias("distance"))


@query("mask_overlap", f"""WITH {CELLS}, a AS (SELECT r, c FROM cells WHERE c < 25), b AS (SELECT r, c FROM cells WHERE c > 10)
    SELECT count(*) FILTER (a.r IS NOT NULL AND b.r IS NOT NULL) AS both, count(*) AS any, round(count(*) FILTER (a.r IS NOT NULL AND b.r IS NOT NULL) / count(*), 9) AS iou FROM a FULL JOIN b ON a.r = b.r AND a.c = b.c""")
def mask_overlap(spark, sf_dir):
    """Intersection over union of two masks."""
    g = cells(spark, sf_dir)
    a, b = g.where("c < 25").select("r", "c", F.lit(1).alias("a")), g.where("c > 10").select("r", "c", F.lit(1).alias("b"))
    both = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull())
    return a.join(b, ["r", "c"], "full_outer").agg(both.alias("both"), F.count(F.lit(1)).alias("any"), F.round(both / F.count(F.lit(1)), 9).alias("iou"))


@query("region_boxes", """SELECT n_regionkey AS region, round(min(s_acctbal) - 0.05, 4) AS x0, round(max(s_acctbal) + 0.05, 4) AS x1, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey""")
def region_boxes(spark, sf_dir):
    """The box around a region's members, with a margin."""
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.groupBy(F.col("n_regionkey").alias("region")).agg(F.round(F.min("s_acctbal") - 0.05, 4).alias("x0"), F.round(F.max("s_acctbal") + 0.05, 4).alias("x1"), F.count(F.lit(1)).alias("n"))


@query("shortest_paths")
def shortest_paths(spark, sf_dir):
    """A* on maps of 40 x 40 cells, as many as the table gives, with simplified paths; tests compare with a plain search."""
    g = cells(spark, sf_dir).select(F.floor(F.col("r") / 40).alias("map"), (F.col("r") % 40).alias("r"), "c", "cost")
    ends = g.select("map").distinct().select("map", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 0), (20, 20))])).alias("p")).select("map", "p.r", "p.c", F.lit(1.0).alias("cost"))
    every = g.unionByName(ends).groupBy("map", "r", "c").agg(F.max("cost").alias("cost"))
    return graphs.shortest_paths(every, (0, 0), (20, 20))


@query(
    "long_shortest_paths",
    f"""WITH RECURSIVE {CELLS}, w AS (SELECT r, c, (r % 5 + c % 3 + 1)::DOUBLE AS cost FROM cells UNION ALL SELECT g.r, g.c, 1.0 FROM (SELECT 0 AS r, 0 AS c UNION ALL SELECT 20, 20) g ANTI JOIN cells USING (r, c)),
    e AS (SELECT a.r * 100 + a.c AS a, b.r * 100 + b.c AS b, greatest(a.cost, b.cost) AS w FROM w a JOIN w b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
    walk AS (SELECT 0 AS v, 0.0::DOUBLE AS d, 0 AS n UNION ALL
      SELECT v, d, n FROM (SELECT e.b AS v, min(walk.d + e.w) AS d, min(walk.n) + 1 AS n FROM walk JOIN e ON e.a = walk.v WHERE walk.n < 120 GROUP BY e.b) x)
    SELECT 0::BIGINT AS map, min(d) AS cost FROM walk WHERE v = 2020 HAVING count(*) > 0""",
)
def long_shortest_paths(spark, sf_dir):
    """The same search over one map of the whole table, tile by tile, so that no task needs the map."""
    g = cells(spark, sf_dir).select("r", "c", "cost")
    ends = spark.createDataFrame([(0, 0), (20, 20)], "r int, c int").join(g.select("r", "c"), ["r", "c"], "left_anti").withColumn("cost", F.lit(1.0))
    every = g.unionByName(ends).withColumn("map", F.lit(0).cast("long"))
    found = graphs.long_paths(every, (0, 0), (20, 20), Workspace(spark, "long-paths"), tile=16)
    return found.where("r = 20 AND c = 20").select("map", F.col("spent").alias("cost"))


@query("beta_intervals")
def beta_intervals(spark, sf_dir):
    """Credible intervals of the success rates; tests compare with values worked out by hand."""
    report = eps.success_report(by_category(spark, sf_dir), "category").select("category", "successes", "total")
    return numeric.credible_interval(report, "successes", "total")


@query("smallest_boxes")
def smallest_boxes(spark, sf_dir):
    """Smallest oriented rectangles."""
    p = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_quantity") * 1.0).alias("px"), (F.col("l_extendedprice") / 1000).alias("py"))
    return numeric.smallest_boxes(p, "l_returnflag", "px", "py")


@query("rigid_transforms", f"""WITH {STEPS} SELECT episode, t, round(2 * acos(least(1, greatest(-1, cos(d)))), 6) AS angle, round(q, 6) AS x, 0.0::DOUBLE AS error, round(2 * d, 6) AS turn, 0.0::DOUBLE AS back FROM steps""")
def rigid_transforms(spark, sf_dir):
    """A pose as a matrix, times its inverse, the length of its rotation, its rotation vector (log) and back (exp)."""
    half = F.col("d")
    pose = F.array(F.col("q"), F.lit(1.0), F.lit(2.0), F.cos(half), F.lit(0.0), F.lit(0.0), F.sin(half))
    m = steps(spark, sf_dir).select("episode", "t", numeric.pose_matrix(pose).alias("m"))
    m = m.withColumn("product", numeric.compose(F.col("m"), numeric.inverse(F.col("m")))).withColumn("log", numeric.rotation_log(F.col("m")))
    m = m.withColumn("exp", numeric.rotation_exp(F.col("log")))
    identity = F.array(*[F.lit(1.0 if i % 5 == 0 else 0.0) for i in range(16)])
    turned = F.array(*[F.get("m", F.lit(4 * i + j)) for i in range(3) for j in range(3)])
    apart = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + v)
    return m.select(
        "episode", "t", F.round(numeric.rotation_angle(F.col("m")), 6).alias("angle"), F.round(F.get("m", F.lit(3)), 6).alias("x"), F.round(apart("product", identity), 6).alias("error"),
        F.round(F.get("log", F.lit(2)), 6).alias("turn"), F.round(apart("exp", turned), 6).alias("back"),
    )
