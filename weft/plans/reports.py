"""Queries that report on results: failures by category, pass and fail lists, totals with errors, paired runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import relations as rel
from weft.operators import reports as rep
from weft.plans.registry import query
from weft.plans.standins import STEPS, steps
from weft.sources import files
from weft.sources.tables import listing, table
from weft.workspace import Workspace

BODIES = """bodies AS (SELECT l_suppkey AS scene, lower(p_type) || '_' || p_partkey AS body, l_returnflag = 'R' AS failed FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def scene_results(spark, sf_dir):
    """One nested result per scene: counts.failed.cant_lift.names beside all its body names."""
    body = F.concat_ws("_", F.lower("p_type"), F.col("p_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_suppkey").alias("scene"), body.alias("body"), (F.col("l_returnflag") == "R").alias("failed"))
    names = F.collect_list(F.when(F.col("failed"), F.col("body")))
    nested = F.struct(F.struct(F.struct(names.alias("names")).alias("cant_lift"), F.count_if("failed").alias("num")).alias("failed"))
    return rows.groupBy("scene").agg(nested.alias("counts"), F.collect_list("body").alias("bodies"))


@query("category_failures", f"""WITH {BODIES} SELECT split_part(body, '_', 1) AS category, count(*) FILTER (failed) AS failed, count(*) AS overall FROM bodies GROUP BY 1""")
def category_failures(spark, sf_dir):
    """Failures by category from nested results, beside how often each category occurs at all."""
    results = scene_results(spark, sf_dir)
    failed = rep.by_category(results, "counts.failed.cant_lift.names", "failed")
    overall = rep.by_category(results, "bodies", "overall")
    return overall.join(failed, "category", "left").select("category", F.coalesce("failed", F.lit(0)).cast("long").alias("failed"), "overall")


@query(
    "pass_summary",
    """WITH s AS (SELECT n_regionkey AS split, 'train_' || n_nationkey AS scene, n_nationkey AS number, count(*) FILTER (s_acctbal < -800) = 0 AS ok
      FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)
    SELECT split, count(*) FILTER (ok) AS passed, coalesce(string_agg(scene, ',' ORDER BY number) FILTER (ok), '') AS passed_names,
      count(*) FILTER (NOT ok) AS failed, coalesce(string_agg(scene, ',' ORDER BY number) FILTER (NOT ok), '') AS failed_names FROM s GROUP BY split""",
)
def pass_summary(spark, sf_dir):
    """How many scenes of a split pass and which, in the order of the numbers in their names."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    failed = s.where("s_acctbal < -800").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    scenes = n.join(failed, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        F.col("n_regionkey").alias("split"), F.concat(F.lit("train_"), F.col("n_nationkey").cast("string")).alias("scene"), F.col("n").isNull().alias("ok")
    )
    return rep.pass_lists(scenes, "split", "scene", "ok", r"_(\d+)$")


@query(
    "mixture_summary",
    """WITH c AS (SELECT DISTINCT c_mktsegment AS component FROM customer UNION ALL SELECT 'NOWHERE'),
    r AS (SELECT c_mktsegment AS component, count(*) FILTER (o_orderstatus = 'F') AS success_count, count(*) AS total_count FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment NOT LIKE 'B%' GROUP BY 1),
    f AS (SELECT component, coalesce(success_count, 0)::BIGINT AS success_count, coalesce(total_count, 0)::BIGINT AS total_count,
      CASE WHEN component LIKE 'B%' THEN 'crashed: out of memory' WHEN total_count IS NULL THEN 'no result' END AS error FROM c LEFT JOIN r USING (component))
    SELECT * FROM f UNION ALL SELECT 'TOTAL', sum(success_count)::BIGINT, sum(total_count)::BIGINT, count(error) || ' of ' || count(*) || ' components failed' FROM f""",
)
def mixture_summary(spark, sf_dir):
    """Totals of a mixture's components and of all; one that crashed or gave nothing counts zero, with a message."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("component"))
    spec = c.select("component").distinct().unionByName(spark.range(1).select(F.lit("NOWHERE").alias("component")))
    runs = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).where("component NOT LIKE 'B%'")
    results = runs.groupBy("component").agg(F.count_if(F.col("o_orderstatus") == "F").alias("success_count"), F.count(F.lit(1)).alias("total_count"))
    crashes = spec.where("component LIKE 'B%'").select("component", F.lit("crashed: out of memory").alias("error"))
    return rep.mixture_totals(spec, results, crashes)


@query(
    "conversion_report",
    f"""WITH {STEPS}, r AS (SELECT episode, q <= 45 AS ok, CASE WHEN q > 45 THEN 'quantity ' || q::INT || ' is out of range' END AS error FROM steps)
    SELECT ok, count(*) AS n, coalesce(string_agg(DISTINCT error, '; ' ORDER BY error), '') AS errors FROM r GROUP BY ok""",
)
def conversion_report(spark, sf_dir):
    """Results of a conversion split into successes and failures, with the distinct messages of the latter."""
    ok = F.col("q") <= 45
    message = F.concat(F.lit("quantity "), F.col("q").cast("int").cast("string"), F.lit(" is out of range"))
    results = steps(spark, sf_dir).select(ok.alias("ok"), F.when(~ok, message).alias("error"))
    return rep.messages(results, "ok", "error")


@query(
    "paired_runs",
    """WITH a AS (SELECT l_suppkey AS scene, sum(l_extendedprice) / sum(l_quantity) AS v FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
    b AS (SELECT l_suppkey AS scene, sum(l_extendedprice) / sum(l_quantity) AS v FROM lineitem GROUP BY 1)
    SELECT scene, round(a.v / b.v, 6) AS ratio, a.v / b.v < 1 AS slower, scene = (SELECT arg_max(scene, (a.v / b.v, scene)) FROM a JOIN b USING (scene)) AS best FROM a JOIN b USING (scene)""",
)
def paired_runs(spark, sf_dir):
    """Two runs paired by scene, every scene of the first asserted in the second, with the ratio and the scene of the best one."""
    rate = F.sum("l_extendedprice") / F.sum("l_quantity")
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "scene")
    a, b = (x.groupBy("scene").agg(rate.alias("v")) for x in (items.where("l_linestatus = 'O'"), items))
    pairs = Workspace(spark, "pairs").save(rep.paired(a, b, "scene", "v"), "pairs")
    best = pairs.agg(F.max_by("scene", F.struct("ratio", "scene")).alias("best"))
    return pairs.join(F.broadcast(best)).select("scene", F.round("ratio", 6).alias("ratio"), (F.col("ratio") < 1).alias("slower"), (F.col("scene") == F.col("best")).alias("best"))


@query(
    "write_modes",
    """SELECT mode, data, index, totals, CASE WHEN totals THEN (SELECT count(*) FROM orders) ELSE 0 END AS rows FROM (VALUES ('all', true, true, true), ('dry-run', false, false, false), ('index-only', false, true, false),
    ('aggregate-only', false, false, true)) v(mode, data, index, totals)""",
)
def write_modes(spark, sf_dir):
    """What a run writes in each of its modes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    work = Workspace(spark, "modes")
    out = []
    for mode in files.MODES:
        files.publish(orders, work.path(mode), mode, "o_orderstatus")
        data, index, totals = (files.exists(spark, f"{work.path(mode)}/{part}/_SUCCESS") for part in ("data", "index", "totals"))
        rows = spark.read.parquet(f"{work.path(mode)}/totals").agg(F.sum("rows")).first()[0] if totals else 0
        out.append((mode, data, index, totals, rows))
    return spark.createDataFrame(out, "mode string, data boolean, index boolean, totals boolean, rows long")


@query(
    "schema_listing",
    """WITH c AS (SELECT table_name AS root, column_name AS key, data_type FROM information_schema.columns WHERE table_name IN ('orders', 'events', 'embeddings')),
    n AS (SELECT 'orders' AS root, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'embeddings', count(*) FROM embeddings)
    SELECT root || '/' || key AS path, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'timestamp' END AS dtype,
      '(' || n || CASE WHEN data_type LIKE '%[]' THEN ',*' ELSE '' END || ')' AS shape
    FROM c JOIN n USING (root) WHERE root = 'embeddings' OR key LIKE 'o_order%' OR key LIKE 'event%'""",
)
def schema_listing(spark, sf_dir):
    """The tree of a source's groups and leaves with shape and type, below some path prefixes."""
    roots = {name: table(spark, sf_dir, name) for name in ("orders", "events", "embeddings")}
    return listing(spark, roots, ("embeddings/", "orders/o_order", "events/event"))
