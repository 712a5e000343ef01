"""Queries on names, paths, numbers, geometry and documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.functions import geometry as geo
from weft.functions import text as tx
from weft.operators.sequences import global_rank
from weft.operators import candidates as cand
from weft.plans.registry import query
from weft.plans.standins import STEPS, steps
from weft.sources.tables import table
from weft.workspace import Workspace

NAMES = """names AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'obja' || md5(p_partkey::VARCHAR) || '_1_0_' || (p_partkey % 7)
  WHEN 1 THEN 'mug_' || p_partkey || '_1_0_2' WHEN 2 THEN 'CoffeeTable' || p_partkey ELSE replace(p_type, ' ', '_') || '_' || (p_partkey % 9) END AS name FROM part)"""


def names(spark, sf_dir):
    k = F.col("p_partkey")
    pick = (
        F.when(k % 5 == 0, F.concat(F.lit("obja"), F.md5(k.cast("string")), F.lit("_1_0_"), (k % 7).cast("string")))
        .when(k % 5 == 1, F.concat(F.lit("mug_"), k.cast("string"), F.lit("_1_0_2")))
        .when(k % 5 == 2, F.concat(F.lit("CoffeeTable"), k.cast("string")))
        .otherwise(F.concat(F.replace("p_type", F.lit(" "), F.lit("_")), F.lit("_"), (k % 9).cast("string")))
    )
    return table(spark, sf_dir, "part").select(k.alias("id"), pick.alias("name"))


@query(
    "name_parts",
    f"""WITH {NAMES} SELECT id, name, split_part(name, '_', 1) AS category, list_aggregate(string_split(name, '_')[1:greatest(len(string_split(name, '_')) - 3, 1)], 'string_agg', '_') AS model,
      string_split(name, '_')[2] AS token, nullif(regexp_extract(name, '^[a-zA-Z][a-zA-Z0-9]*_(.+)_[0-9]+_[0-9]+_[0-9]+$', 1), '') AS hash, nullif(regexp_extract(name, '([0-9a-f]{{32}})', 1), '') AS hex,
      coalesce(nullif(regexp_extract(name, '([A-Za-z]+)', 1), ''), 'unknown') AS word, coalesce(starts_with(name, 'obja'), false) AS obja FROM names""",
)
def name_parts(spark, sf_dir):
    """Parts of an identifier."""
    n = F.col("name")
    return names(spark, sf_dir).select(
        "id", "name", tx.category(n).alias("category"), tx.model_instance(n).alias("model"), tx.second_token(n).alias("token"),
        tx.object_hash(n).alias("hash"), tx.hex32(n).alias("hex"), tx.first_word(n).alias("word"), F.coalesce(n.startswith("obja"), F.lit(False)).alias("obja"),
    )


@query(
    "text_normalise",
    f"""WITH {NAMES} SELECT id, trim(translate(replace(lower(trim(name)), '_', ' '), '.;/,''"\\', '')) AS normal,
      lower(regexp_replace(name, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')) AS words,
      trim(regexp_replace(regexp_replace(regexp_replace(list_aggregate(string_split(name, '_')[1:greatest(len(string_split(name, '_')) - 4, 1)], 'string_agg', ' '), '[0-9]', '', 'g'), '^obja', ''), ' +', ' ', 'g')) AS fallback FROM names""",
)
def text_normalise(spark, sf_dir):
    """Readable expressions of identifiers."""
    n = F.col("name")
    return names(spark, sf_dir).select("id", tx.normalised(n).alias("normal"), tx.spaced(n).alias("words"), tx.fallback_name(n).alias("fallback"))


@query(
    "name_variants",
    """WITH v AS (SELECT p_type AS name, unnest([p_type, replace(p_type, ' ', ''), replace(p_type, ' ', '_')]) AS variant FROM part)
    SELECT DISTINCT name, variant, length(variant) AS size FROM v""",
)
def name_variants(spark, sf_dir):
    """Spellings of a name."""
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("name"), F.explode(tx.variants(F.col("p_type"))).alias("variant")).distinct().withColumn("size", F.length("variant").cast("long"))


FILES = "files AS (SELECT o_orderkey AS id, '/data/split/house_' || (o_custkey % 100) || '/traj_batch_' || (o_orderkey % 8) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '_of_8' END || '.h5' AS path FROM orders)"


def files(spark, sf_dir):
    k = F.col("o_orderkey")
    tail = F.when(k % 3 == 0, "").otherwise("_of_8")
    path = F.concat(F.lit("/data/split/house_"), (F.col("o_custkey") % 100).cast("string"), F.lit("/traj_batch_"), (k % 8).cast("string"), tail, F.lit(".h5"))
    return table(spark, sf_dir, "orders").select(k.alias("id"), path.alias("path"))


@query(
    "path_parts",
    f"""WITH {FILES} SELECT id, coalesce(nullif(regexp_extract(path, 'batch_([0-9]+)_of_([0-9]+)', 1), ''), '0') AS batch, coalesce(nullif(regexp_extract(path, 'batch_([0-9]+)_of_([0-9]+)', 2), ''), '1') AS batches,
      regexp_extract(path, '([^/]*)\\.[^.]*$', 1) AS stem, regexp_replace(path, '/[^/]*$', '') AS parent, substr(path, 7) AS relative, regexp_replace(path, '^/data/+', '') AS stripped FROM files""",
)
def path_parts(spark, sf_dir):
    """Batch numbers, stem, parent and relative path."""
    p = F.col("path")
    f = files(spark, sf_dir).withColumn("b", tx.batch_numbers(p))
    return f.select("id", "b.batch", "b.batches", tx.stem(p).alias("stem"), tx.parent(p).alias("parent"), tx.relative(p, "/data").alias("relative"), F.regexp_replace(p, "^/data/+", "").alias("stripped"))


@query(
    "labels_and_formats",
    """SELECT p_partkey, 'episode_' || lpad(p_partkey::VARCHAR, 8, '0') AS episode, list_aggregate(list_transform(string_split(lower(p_type), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS title,
      md5(p_name) AS md5, sha256(p_name) AS sha256, regexp_replace(p_brand, '^Brand', 'Make') AS moved, CASE WHEN p_size > 25 THEN 'Success' ELSE 'Failed' END AS outcome, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS oracle FROM part""",
)
def labels_and_formats(spark, sf_dir):
    """Titles, padded names, hashes, replaced prefixes and labels."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.format_string("episode_%08d", "p_partkey").alias("episode"), F.initcap("p_type").alias("title"), F.md5("p_name").alias("md5"),
        F.sha2("p_name", 256).alias("sha256"), F.regexp_replace("p_brand", "^Brand", "Make").alias("moved"),
        F.when(F.col("p_size") > 25, "Success").otherwise("Failed").alias("outcome"), F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("No").alias("oracle"),
    )


@query(
    "human_sizes",
    """WITH b AS (SELECT o_orderkey AS id, floor(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 0.001 WHEN 1 THEN 1 WHEN 2 THEN 1000 ELSE 100000 END) * 128 + 1 AS f FROM orders), c AS (SELECT id, f::BIGINT AS n FROM b)
    SELECT id, n, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN format('{:.2f} KiB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN format('{:.2f} MiB', n / 1048576.0::DOUBLE) WHEN n < 1099511627776 THEN format('{:.2f} GiB', n / 1073741824.0::DOUBLE) ELSE format('{:.2f} TiB', n / 1099511627776.0::DOUBLE) END AS size FROM c""",
)
def human_sizes(spark, sf_dir):
    """Readable sizes."""
    k = F.col("o_orderkey")
    factor = F.when(k % 4 == 0, 0.001).when(k % 4 == 1, 1.0).when(k % 4 == 2, 1000.0).otherwise(100000.0)
    return table(spark, sf_dir, "orders").select(k.alias("id"), (F.floor(F.col("o_totalprice") * factor) * 128 + 1).alias("n")).withColumn("size", tx.human_size(F.col("n")))


@query("task_types", """SELECT doc_id, CASE WHEN contains(lower(source), 'src1') THEN 'pick' WHEN contains(lower(source), '2') THEN 'place' WHEN contains(lower(source), 'src') THEN 'open' ELSE 'other' END AS task FROM documents""")
def task_types(spark, sf_dir):
    """A type by ordered substrings."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.task_type(F.col("source"), [("src1", "pick"), ("2", "place"), ("src", "open")], "other").alias("task"))


@query(
    "task_sentences",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Pick up the ' || lower(p_name) WHEN p_size % 3 = 1 THEN 'Put the ' || lower(p_name) || ' on the ' || lower(p_brand) ELSE 'Open the ' || lower(p_type) END AS sentence FROM part""",
)
def task_sentences(spark, sf_dir):
    """Sentences from templates by task type."""
    low = lambda c: F.lower(F.col(c))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 3 == 0, F.format_string("Pick up the %s", low("p_name")))
        .when(F.col("p_size") % 3 == 1, F.format_string("Put the %s on the %s", low("p_name"), low("p_brand")))
        .otherwise(F.format_string("Open the %s", low("p_type"))).alias("sentence"),
    )


@query(
    "natural_sort_rank",
    """WITH n AS (SELECT DISTINCT 'traj_' || (p_size) || '_' || (p_partkey % 12) AS name FROM part)
    SELECT name, row_number() OVER (ORDER BY split_part(name, '_', 2)::INT, split_part(name, '_', 3)::INT) AS place FROM n""",
)
def natural_sort_rank(spark, sf_dir):
    """Numbers in names sort as numbers."""
    n = table(spark, sf_dir, "part").select(F.concat(F.lit("traj_"), F.col("p_size").cast("string"), F.lit("_"), (F.col("p_partkey") % 12).cast("string")).alias("name")).distinct()
    ranked = global_rank(n.withColumn("key", tx.natural_key(F.col("name"))), ["key"], Workspace(spark, "natural"))
    return ranked.select("name", "place")


@query("episode_seeds", """SELECT o_orderkey, ('0x' || substr(sha256(o_orderkey || '|' || o_orderpriority || '|' || o_orderstatus), 1, 8))::BIGINT AS seed FROM orders""")
def episode_seeds(spark, sf_dir):
    """A seed from the identity of an episode."""
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.seed(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus")).alias("seed"))


@query(
    "angles",
    f"""WITH {STEPS} SELECT episode, t, round(((q + pi()) - 2 * pi() * floor((q + pi()) / (2 * pi()))) - pi(), 6) AS wrapped, round(atan2(2 * (q * x + d * x), 1 - 2 * (x * x + x * x)), 6) AS yaw,
      round(acos(greatest(-1, least(1, d * q))), 6) AS tilt, round(sqrt(q * q + d * d + x * x), 6) AS radius, round(atan2(d, q), 6) AS azimuth, round(atan2(x, sqrt(q * q + d * d)), 6) AS elevation FROM steps""",
)
def angles(spark, sf_dir):
    """Wrapped angles, yaw, tilt and spherical coordinates."""
    q, d, x = F.col("q"), F.col("d"), F.col("x")
    radius, azimuth, elevation = geo.spherical(q, d, x)
    return steps(spark, sf_dir).select(
        "episode", "t", F.round(geo.wrap_angle(q), 6).alias("wrapped"), F.round(geo.yaw(q, d, x, x), 6).alias("yaw"), F.round(geo.tilt(d * q), 6).alias("tilt"),
        F.round(radius, 6).alias("radius"), F.round(azimuth, 6).alias("azimuth"), F.round(elevation, 6).alias("elevation"),
    )


@query(
    "depth_codec_roundtrip",
    """WITH m AS (SELECT event_id, value / 150 AS metres FROM events), c AS (SELECT *, CASE WHEN metres BETWEEN 0.05 AND 0.55 THEN floor((metres - 0.05::DOUBLE) / 0.5::DOUBLE * 65534.0::DOUBLE + 1)::INT ELSE 0 END AS code FROM m)
    SELECT event_id, code // 256 AS high, code % 256 AS low, round(CASE WHEN code = 0 THEN 0 ELSE (code - 1) / 65534.0::DOUBLE * 0.5::DOUBLE + 0.05::DOUBLE END, 9) AS restored FROM c""",
)
def depth_codec_roundtrip(spark, sf_dir):
    """16-bit depth codes and back."""
    e = table(spark, sf_dir, "events").select("event_id", geo.depth_code(F.col("value") / 150).alias("code"))
    high, low = geo.depth_channels(F.col("code"))
    return e.select("event_id", high.alias("high"), low.alias("low"), F.round(geo.depth_metres(high, low), 9).alias("restored"))


#: Pixels of a depth map that is broadcast (24 bytes each); a larger one is joined by a shuffle.
PIXELS = 1 << 18


@query(
    "pinhole_roundtrip",
    f"""WITH {STEPS}, p AS (SELECT episode, t, q, 500 * d / q + 320 AS u, 500 * x / q + 240 AS v FROM steps),
    n AS (SELECT floor(u / 4)::BIGINT AS pu, floor(v / 4)::BIGINT AS pv, min(q) AS depth FROM p GROUP BY ALL)
    SELECT episode, t, round(u, 6) AS u, round(v, 6) AS v, u BETWEEN 0 AND 325 AS visible, q > depth + 0.5 AS occluded, round((u - 320) * q / 500, 6) AS back, round(u / 640, 4) AS share,
      round_even((u - 20) / 64, 3) AS metres, floor((u - 20) / 64 * 64 + 20 + 0.5)::BIGINT AS pixel FROM p JOIN n ON pu = floor(u / 4) AND pv = floor(v / 4)""",
)
def pinhole_roundtrip(spark, sf_dir):
    """Projection to pixels and back, in-frame and occlusion test against a depth map, pixels as metres and shares."""
    u, v = geo.project(F.col("d"), F.col("x"), F.col("q"), 500.0, 320.0, 240.0)
    p = steps(spark, sf_dir).select("episode", "t", "q", u.alias("u"), v.alias("v"), F.floor(u / 4).alias("pu"), F.floor(v / 4).alias("pv"))
    depths = Workspace(spark, "depths").save(p.groupBy("pu", "pv").agg(F.min("q").alias("depth")), "map")
    if depths.count() <= PIXELS:  # most rows are of few pixels, whose rows would meet in one task
        depths = F.broadcast(depths)
    back, _ = geo.unproject(F.col("u"), F.col("v"), F.col("q"), 500.0, 320.0, 240.0)
    metres = geo.to_metres(F.col("u"), 20.0, 64.0)
    return p.join(depths, ["pu", "pv"]).select(
        "episode", "t", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"), F.col("u").between(0, 325).alias("visible"), geo.occluded(F.col("q"), F.col("depth"), 0.5).alias("occluded"),
        F.round(back, 6).alias("back"), F.round(F.col("u") / 640, 4).alias("share"), F.bround(metres, 3).alias("metres"), geo.to_pixel(metres, 20.0, 64.0).alias("pixel"),
    )


@query(
    "interp_clamped",
    """SELECT event_id, round(CASE WHEN value <= 10 THEN 1.0::DOUBLE WHEN value < 40 THEN 1 + (value - 10) * (4.0::DOUBLE / 30) WHEN value < 90 THEN 5 + (value - 40) * (-3.0::DOUBLE / 50) ELSE 2 END, 9) AS y FROM events""",
)
def interp_clamped(spark, sf_dir):
    """Piecewise linear interpolation with constant ends."""
    return table(spark, sf_dir, "events").select("event_id", F.round(geo.interpolate(F.col("value"), [(10.0, 1.0), (40.0, 5.0), (90.0, 2.0)]), 9).alias("y"))


@query(
    "points_in_polygon",
    """SELECT l_orderkey, l_linenumber, l_quantity AS px, l_extendedprice AS py, l_quantity BETWEEN 5 AND 30 AND l_extendedprice >= 0 AND l_extendedprice <= 2000 * (l_quantity - 5) AS inside FROM lineitem""",
)
def points_in_polygon(spark, sf_dir):
    """Membership in a polygon (a triangle here), edges inside."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("px"), F.col("l_extendedprice").alias("py"),
        geo.inside_polygon(F.col("l_quantity"), F.col("l_extendedprice"), [(5.0, 0.0), (30.0, 0.0), (30.0, 50000.0)]).alias("inside"),
    )


@query(
    "colour_names",
    """SELECT p_partkey, CASE WHEN abs(p_size / 50.0::DOUBLE - 0.1) <= 0.1 + 0.00001 * 0.1 THEN 'dark' WHEN abs(p_size / 50.0::DOUBLE - 0.5) <= 0.1 + 0.00001 * 0.5 THEN 'grey' WHEN abs(p_size / 50.0::DOUBLE - 0.9) <= 0.1 + 0.00001 * 0.9 THEN 'light' END AS colour FROM part""",
)
def colour_names(spark, sf_dir):
    """The first colour a value is close to."""
    x = F.col("p_size") / 50.0
    close = lambda c: F.abs(x - c) <= 0.1 + 0.00001 * c
    return table(spark, sf_dir, "part").select("p_partkey", F.when(close(0.1), "dark").when(close(0.5), "grey").when(close(0.9), "light").alias("colour"))


@query(
    "json_rows",
    """SELECT event_id, (props->>'$.k')::INT AS k, coalesce(props->>'$.missing', 'none') AS missing, json_valid(props) AS ok FROM events""",
)
def json_rows(spark, sf_dir):
    """Strict and lenient decoding of JSON rows, and a path with a default."""
    strict = F.from_json("props", "k int", {"mode": "FAILFAST"})
    return table(spark, sf_dir, "events").select(
        "event_id", strict.getField("k").alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"), F.try_parse_json("props").isNotNull().alias("ok")
    )


@query("padded_names", """SELECT c_custkey, c_name AS name FROM customer""")
def padded_names(spark, sf_dir):
    """Strings in zero-padded bytes of fixed width."""
    padded = F.concat(F.encode("c_name", "UTF-8"), F.expr("cast(repeat(char(0), 80) as binary)"))
    name = F.rtrim(F.decode(F.substring(padded, 1, 100), "UTF-8"), F.lit("\0"))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


@query(
    "xml_files",
    """WITH x AS (SELECT p_partkey, unnest(['mesh/' || p_brand || '.obj', 'texture/' || p_size || '.png']) AS file FROM part) SELECT file, count(*) AS n FROM x GROUP BY file""",
)
def xml_files(spark, sf_dir):
    """Attributes of XML elements."""
    xml = F.format_string('<m><asset><mesh file="mesh/%s.obj"/><texture file="texture/%d.png"/></asset></m>', "p_brand", "p_size")
    found = F.explode(F.xpath(xml, F.lit("//asset/*/@file"))).alias("file")
    return table(spark, sf_dir, "part").select(found).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


@query(
    "commented_lines",
    """SELECT trim(split_part(s, '#', 1)) AS line, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 4 = 0 THEN '  # note' WHEN c_custkey % 4 = 1 THEN c_mktsegment || ' # note' ELSE '  ' || c_mktsegment END AS s FROM customer) WHERE trim(split_part(s, '#', 1)) <> '' GROUP BY 1""",
)
def commented_lines(spark, sf_dir):
    """Lines without comments and blanks."""
    k = F.col("c_custkey") % 4
    line = F.when(k == 0, F.lit("  # note")).when(k == 1, F.concat("c_mktsegment", F.lit(" # note"))).otherwise(F.concat(F.lit("  "), "c_mktsegment"))
    kept = table(spark, sf_dir, "customer").select(F.trim(F.split_part(line, F.lit("#"), F.lit(1))).alias("line"))
    return kept.where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "doc_patch",
    """SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN p_name END, 'part ' || p_partkey) AS name, CASE WHEN p_size % 4 = 0 THEN 99 ELSE p_size END AS size, p_size > 40 AS depth_first, true AS depth_second,
      'new.' || p_brand AS cls FROM part""",
)
def doc_patch(spark, sf_dir):
    """Missing fields filled, an array of structs updated, a field overwritten only where it is present."""
    doc = F.struct(
        F.when(F.col("p_size") % 3 == 0, F.col("p_name")).alias("name"), F.col("p_size").alias("size"),
        F.array(F.struct((F.col("p_size") > 40).alias("depth")), F.struct(F.lit(False).alias("depth"))).alias("cameras"), F.concat(F.lit("old."), "p_brand").alias("cls"),
    )
    patched = table(spark, sf_dir, "part").select("p_partkey", "p_size", doc.alias("d")).withColumn(
        "d",
        F.col("d").withField("name", F.coalesce("d.name", F.concat(F.lit("part "), F.col("p_partkey").cast("string"))))
        .withField("size", F.when(F.col("p_size") % 4 == 0, 99).otherwise(F.col("d.size")))
        .withField("cameras", F.transform("d.cameras", lambda c, i: c.withField("depth", F.when(i == 1, True).otherwise(c.depth))))
        .withField("cls", F.regexp_replace("d.cls", r"^old\.", "new.")),
    )
    return patched.select("p_partkey", "d.name", "d.size", F.col("d.cameras")[0].depth.alias("depth_first"), F.col("d.cameras")[1].depth.alias("depth_second"), "d.cls")


@query(
    "target_replacement",
    """WITH d AS (SELECT o_orderkey, o_custkey, o_orderkey % 3 = 0 AS has, 'obj_' || o_custkey AS target FROM orders)
    SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'cup=2,new=' || o_custkey || ',obj=3' ELSE 'cup=2,new=' || o_custkey END AS poses,
      CASE WHEN has THEN 'gone,' || target ELSE target END AS removed, 'new' AS task_target FROM d""",
)
def target_replacement(spark, sf_dir):
    """The target of a document is taken out of its maps and listed as removed, and a new one is put in and pointed at."""
    name, other = F.concat(F.lit("obj_"), F.col("o_custkey").cast("string")), F.col("o_custkey") % 2 == 0
    poses = F.map_filter(F.map_from_arrays(F.array(name, F.lit("cup"), F.lit("obj")), F.array(F.lit("1"), F.lit("2"), F.lit("3"))), lambda k, v: (k != "obj") | other)
    removed = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("gone"))).otherwise(F.array().cast("array<string>"))
    docs = table(spark, sf_dir, "orders").select("o_orderkey", poses.alias("poses"), removed.alias("removed"), name.alias("task_target"), F.col("o_custkey").cast("string").alias("pose"))
    done = cand.replace_target(docs, "task_target", "poses", "removed", F.lit("new"), F.col("pose"))
    flat = F.array_join(F.transform(F.array_sort(F.map_entries("poses")), lambda e: F.concat(e.key, F.lit("="), e.value)), ",")
    return done.select("o_orderkey", flat.alias("poses"), F.array_join("removed", ",").alias("removed"), "task_target")


@query(
    "sparse_doc",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '{"brand":"' || p_brand || '","size":' || p_size || '}' ELSE '{"brand":"' || p_brand || '"}' END AS doc,
      CASE WHEN p_size % 5 = 0 THEN 'robot_mounted' WHEN p_size % 5 = 1 THEN 'exocentric' END AS camera FROM part""",
)
def sparse_doc(spark, sf_dir):
    """Documents without their null fields; a union told apart by which field is present."""
    doc = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size")))
    mount, position = F.when(F.col("p_size") % 5 == 0, F.col("p_name")), F.when(F.col("p_size") % 5 == 1, F.array(F.lit(0.0)))
    return table(spark, sf_dir, "part").select("p_partkey", doc.alias("doc"), F.when(mount.isNotNull(), "robot_mounted").when(position.isNotNull(), "exocentric").alias("camera"))


@query(
    "spec_errors",
    """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice < 50000 THEN 'price' END, CASE WHEN o_orderstatus = 'P' THEN 'status' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'priority' END], lambda x: x IS NOT NULL), ',') AS errors FROM orders""",
)
def spec_errors(spark, sf_dir):
    """A message per missing or bad field."""
    checks = F.array(
        F.when(F.col("o_totalprice") < 50000, "price"), F.when(F.col("o_orderstatus") == "P", "status"), F.when(F.col("o_orderpriority").startswith("5"), "priority")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.filter(checks, lambda x: x.isNotNull()), ",").alias("errors"))


@query(
    "license_ladder",
    """SELECT source, CASE source WHEN 'src0' THEN 'CC-BY-4.0' WHEN 'src1' THEN 'MIT' ELSE CASE WHEN length(source) > 4 THEN 'Apache-2.0' ELSE 'unknown' END END AS license, count(*) AS n, count(DISTINCT lang) AS langs FROM documents GROUP BY source""",
)
def license_ladder(spark, sf_dir):
    """Licenses by source with their attributions grouped."""
    s = F.col("source")
    license = F.when(s == "src0", "CC-BY-4.0").when(s == "src1", "MIT").when(F.length(s) > 4, "Apache-2.0").otherwise("unknown")
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.first(license).alias("license"), F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("langs"))


@query("value_mapping", """SELECT c_custkey, coalesce(map {'BUILDING': 'house', 'AUTOMOBILE': 'car'}[c_mktsegment], c_mktsegment) AS kind FROM customer""")
def value_mapping(spark, sf_dir):
    """values replaced by a table, others kept."""
    names = F.create_map(*[F.lit(x) for x in ("BUILDING", "house", "AUTOMOBILE", "car")])
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(F.try_element_at(names, F.col("c_mktsegment")), F.col("c_mktsegment")).alias("kind"))


@query("conditional_exclusion", """SELECT doc_id FROM documents WHERE NOT (contains(source, '1') AND lang = 'de') AND (lang = 'en' OR lang = 'fr' OR lang IS NULL)""")
def conditional_exclusion(spark, sf_dir):
    """an exclusion that depends on the path."""
    d = table(spark, sf_dir, "documents")
    return d.where(~(F.col("source").contains("1") & (F.col("lang") == "de"))).where(F.col("lang").isin("en", "fr") | F.col("lang").isNull()).select("doc_id")


@query(
    "membership_tristate",
    """WITH w AS (SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN []::VARCHAR[] ELSE ['de', 'fr'] END AS ids FROM documents)
    SELECT doc_id, CASE WHEN ids IS NULL THEN false WHEN len(ids) = 0 THEN true ELSE list_contains(ids, lang) END AS valid FROM w""",
)
def membership_tristate(spark, sf_dir):
    """no list admits nothing, an empty one everything."""
    k = F.col("doc_id") % 3
    ids = F.when(k == 0, F.lit(None).cast("array<string>")).when(k == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("de"), F.lit("fr")))
    d = table(spark, sf_dir, "documents").withColumn("ids", ids)
    valid = F.when(F.col("ids").isNull(), False).when(F.size("ids") == 0, True).otherwise(F.arrays_overlap("ids", F.array("lang")))
    return d.select("doc_id", valid.alias("valid"))


@query(
    "indexed_selection",
    """WITH n AS (SELECT c_nationkey AS house, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
    SELECT house, c_custkey, n > 4 AS whole FROM n WHERE i BETWEEN 2 AND 4""",
)
def indexed_selection(spark, sf_dir):
    """A range of episodes of each house by index, and whether the house has all of them; a bad range is an error."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("house"), "c_custkey")
    return cand.by_index(c, "house", "c_custkey", 2, 4).select("house", "c_custkey", "whole")


@query(
    "relevant_objects",
    f"""WITH {STEPS} SELECT episode, count(DISTINCT o) AS objects, round(avg(x), 9) AS centre FROM (SELECT episode, unnest([part, robot]) AS o, x FROM steps) GROUP BY episode""",
)
def relevant_objects(spark, sf_dir):
    """Distinct objects of an episode and the mean of their positions."""
    every = steps(spark, sf_dir).select("episode", F.explode(F.array_distinct(F.array_compact(F.array("part", "robot")))).alias("o"), "x")
    per_object = every.groupBy("episode").agg(F.count_distinct("o").alias("objects"))
    centre = steps(spark, sf_dir).groupBy("episode").agg(F.round(F.avg("x"), 9).alias("centre"))
    return per_object.join(centre, "episode")




@query("half_even_rounding", """SELECT l_orderkey, l_linenumber, l_quantity AS q, round_even(l_quantity / 8, 2) AS at_two, round_even(l_quantity / 2, 0) AS at_none FROM lineitem""")
def half_even_rounding(spark, sf_dir):
    """Halves to even, on values whose halves are exact in binary."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.bround(F.col("l_quantity") / 8, 2).alias("at_two"), F.bround(F.col("l_quantity") / 2, 0).alias("at_none")
    )


@query("config_attributes", """SELECT event_id, path, coalesce(CASE path WHEN '$.k' THEN props->>'$.k' END, 'none') AS value FROM events, (SELECT unnest(['$.k', '$.a.b']) AS path)""")
def config_attributes(spark, sf_dir):
    """Attributes of JSON configurations by a list of paths."""
    paths = ("$.k", "$.a.b")
    doc = F.try_parse_json("props")
    found = F.array(*[F.struct(F.lit(p).alias("path"), F.coalesce(F.try_variant_get(doc, p, "string"), F.lit("none")).alias("value")) for p in paths])
    return table(spark, sf_dir, "events").select("event_id", F.explode(found).alias("f")).select("event_id", "f.path", "f.value")
