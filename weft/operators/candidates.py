"""Which objects, assets and vectors qualify: predicates as columns, chained filters, and scores in blocks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.sampling import first_of_each
from weft.operators.sequences import global_rank
from weft.workspace import Workspace

SPLITS = ("train", "val", "test")
MIN_MARGIN, MIN_SIMILARITY = 0.03, 0.1
QUERY_BLOCK, VECTOR_BLOCK = 2048, 8192
#: Queries of a block that are scored at once.
STRIP = 128


def clear_expression(margin: Column, similarity: Column, least_margin: float = MIN_MARGIN, least_similarity: float = MIN_SIMILARITY) -> Column:
    """Whether an expression stands out from others and fits its object."""
    return (margin >= least_margin) & (similarity >= least_similarity)


def has_type(kinds: Column, wanted: Sequence[str] | None) -> Column:
    """Whether one of an object's types is wanted; no list matches none, an empty one matches all."""
    if wanted is None:
        return F.lit(False)
    return F.arrays_overlap(kinds, F.array(*map(F.lit, wanted))) if wanted else F.lit(True)


def is_receptacle(site: Column, kinds: Column, wanted: Sequence[str] | None) -> Column:
    return site & has_type(kinds, wanted)


def is_pickup(free_joint: Column, kinds: Column, wanted: Sequence[str] | None) -> Column:
    return free_joint & has_type(kinds, wanted)


def is_excluded(name: Column, geometry: Column, robot: str) -> Column:
    """A part of the robot, or a body without geometry."""
    return F.contains(name, F.lit(robot)) | ~geometry


def admitted(split: Column, wanted: Column) -> Column:
    """Whether an asset of a split (null: of none) may be used in the wanted one; other wanted splits admit all."""
    rule = F.when(wanted == "test", split.isNull() | (split == "test")).when(wanted == "train", split == "train").when(wanted == "val", split.isin("val", "train"))
    return F.coalesce(rule, ~wanted.isin(*SPLITS))


def matches(kinds: Column, wanted: Sequence[str]) -> Column:
    """The wanted words that occur in one of the types, compared in lower case with spaces for underscores."""
    plain = F.transform(kinds, lambda k: F.trim(F.lower(F.replace(k, F.lit("_"), F.lit(" ")))))
    return F.filter(F.array(*map(F.lit, wanted)), lambda w: F.exists(plain, lambda k: F.contains(k, w)))


def any_keyword(column: str, keywords: Sequence[str]) -> Column:
    text = F.lower(F.coalesce(F.col(column), F.lit("")))
    return F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(text, k))


def inferred(given: Column, cls: Column, known: dict[str, str]) -> Column:
    """The given value, else that of the class, else an error when the row is read."""
    by_class = F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), cls)
    return F.coalesce(given, by_class, F.raise_error(F.concat(F.lit("no type for class "), F.coalesce(cls, F.lit("null")))).cast("string"))


def license_of(kind: Column, rules: dict[str, str]) -> Column:
    """The license of a kind of asset; a kind without a rule is an error when the row is read."""
    return inferred(F.lit(None).cast("string"), kind, rules)


def pickable(objects: DataFrame, blacklist: DataFrame, grasps: DataFrame, most_mass: float) -> DataFrame:
    """(scene, uid, bodies, mass) of objects (scene, name, uid, free, mass) that can be picked.

    Names of three parts whose middle has two tokens were added by hand. A blacklist's entries are uids or their md5.
    """
    parts = F.split("name", "/")
    added = (F.size(parts) == 3) & (F.size(F.split(F.get(parts, F.lit(1)), "_")) == 2)
    free = objects.where(~added & F.col("free"))
    entries = blacklist.select(F.col("entry").alias("__e")).distinct()
    uid = F.col("uid").cast("string")
    open_ = free.withColumn("__u", uid).withColumn("__h", F.md5(uid))
    open_ = open_.join(entries, F.col("__u") == F.col("__e"), "left_anti").join(entries, F.col("__h") == F.col("__e"), "left_anti")
    graspable = open_.join(grasps.select("uid").distinct(), "uid", "left_semi")
    summed = graspable.groupBy("scene", "uid").agg(F.count(F.lit(1)).alias("bodies"), F.round(F.sum("mass"), 6).alias("mass"))
    return summed.where(F.col("mass") <= most_mass)


def in_band(x: Column, y: Column, near: float, far: float) -> Column:
    """Whether a point is farther than near and nearer than far from the origin."""
    square = x * x + y * y
    return (square > near * near) & (square < far * far)


def by_contact_depth(grasps: DataFrame, least: float, most: float) -> DataFrame:
    """Grasps with a depth in the range; quality, width and contact_depth get defaults where they or their column are missing."""
    for name, default in (("quality", 1.0), ("width", 0.05), ("contact_depth", 0.5)):
        value = F.coalesce(F.col(name), F.lit(default)) if name in grasps.columns else F.lit(default)
        grasps = grasps.withColumn(name, value)
    return grasps.where(F.col("contact_depth").between(least, most))


def move_into(docs: DataFrame, key: str, part: str, name: str) -> DataFrame:
    """docs with the column `key` moved into the struct `part` under a new name, where the struct has no such value yet."""
    fields = docs.schema[part].dataType.fieldNames()
    value = F.coalesce(F.col(f"{part}.{name}"), F.col(key)) if name in fields else F.col(key)
    return docs.withColumn(part, F.col(part).withField(name, value)).drop(key)


def replace_target(docs: DataFrame, target: str, objects: str, removed: str, new: Column, value: Column) -> DataFrame:
    """docs whose target object is taken out of the map `objects` and listed as removed; a new one takes its place."""
    old = F.col(target)
    kept = F.map_filter(F.col(objects), lambda k, v: k != old)
    gone = F.when(F.map_contains_key(F.col(objects), old), F.array_union(F.col(removed), F.array(old))).otherwise(F.col(removed))
    return docs.withColumns({objects: F.map_concat(kept, F.map_from_arrays(F.array(new), F.array(value))), removed: gone, target: new})


def by_index(rows: DataFrame, group: str, order: str, first: int, last: int) -> DataFrame:
    """Rows first .. last of each group in an order, and in `whole` whether the group has as many; a range that is none is an error."""
    if not 0 <= first <= last:
        raise ValueError(f"no range of indices: {first} to {last}")
    sizes = rows.groupBy(F.col(group).alias("__g")).agg((F.count(F.lit(1)) > last).alias("whole"))
    some = first_of_each(rows, group, [order], F.lit(last + 1), last + 1, number="__i").where(F.col("__i") > first).drop("__i")
    return some.join(sizes, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")


def clusters(rows: DataFrame, key: str, dims: list[str], k: int, workspace: Workspace, seed: int = 42) -> DataFrame:
    """rows with cluster: k-means over dims / (their deviation + 1e-6).

    Features with nulls, NaN or infinities have no distances: then a row's cluster is its number in the order of the key, modulo k. Fewer
    distinct rows than k give fewer clusters. The seed fixes the start; labels are numbered by their centre, in
    order, so they do not depend on the library's numbering.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    inside = reduce(and_, [F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) for c in dims])
    if rows.where(~inside).limit(1).count():
        numbered = global_rank(rows, [F.col(key)], workspace, "__place")
        return numbered.withColumn("cluster", F.pmod(F.col("__place") - 1, F.lit(k)).cast("long")).drop("__place")
    scale = rows.agg(*[F.stddev_pop(c).alias(f"__s_{c}") for c in dims])
    scaled = rows.join(F.broadcast(scale)).select(*rows.columns, *[(F.col(c) / (F.col(f"__s_{c}") + 1e-6)).alias(f"__x_{c}") for c in dims])
    ready = VectorAssembler(inputCols=[f"__x_{c}" for c in dims], outputCol="__v", handleInvalid="error").transform(scaled)
    if not rows.limit(1).count():
        return rows.withColumn("cluster", F.lit(None).cast("long"))
    model = KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="__p", maxIter=100).fit(ready)
    order = sorted(range(len(model.clusterCenters())), key=lambda i: tuple(model.clusterCenters()[i]))
    place = F.array(*[F.lit(order.index(i)) for i in range(len(order))])
    return model.transform(ready).select(*rows.columns, F.get(place, F.col("__p")).cast("long").alias("cluster"))


def navigation(candidates: DataFrame, threshold: float) -> DataFrame:
    """distance, visible, reward and success of each episode by its nearest candidate (episode, distance, visible, t)."""
    nearest = candidates.groupBy("episode").agg(F.min_by("visible", F.struct("distance", "t")).alias("visible"), F.min("distance").alias("distance"))
    reward = F.when(F.col("visible"), F.round(F.greatest(F.lit(0.0), 1 - F.col("distance") / threshold), 6)).otherwise(F.lit(0.0))
    return nearest.select("episode", "distance", "visible", reward.alias("reward"), (F.col("visible") & (F.col("distance") < threshold)).alias("success"))


def placement(rows: DataFrame, most_moved: float, most_tilt: float) -> DataFrame:
    """(episode, t, success, ever) of steps (episode, t, pose, contact, tilt, supported, moved).

    A pose that was supported at an earlier step counts as supported when it comes again.
    """
    before = Window.partitionBy("episode", "pose").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.coalesce(F.bool_or("supported").over(before), F.lit(False))
    success = F.col("carried") & ~F.col("contact") & (F.abs("moved") <= most_moved) & (F.col("tilt") <= most_tilt)
    found = rows.withColumn("carried", carried).select("episode", "t", success.alias("success"))
    return found.withColumn("ever", F.bool_or("success").over(Window.partitionBy("episode")))


def two_quotas(rows: DataFrame, group: str, foreground: str, order: list[Column], budget: int, background: int) -> DataFrame:
    """At most `budget` rows of each group, `background` of them for the background; what it cannot fill the foreground gets."""
    back = rows.groupBy(F.col(group).alias("__g")).agg(F.least(F.count_if(~F.col(foreground)), F.lit(background)).alias("__back"))
    placed = rows.join(back, F.col(group).eqNullSafe(F.col("__g"))).drop("__g").withColumn("__of", F.struct(group, foreground))
    share = F.when(F.col(foreground), F.lit(budget) - F.col("__back")).otherwise(F.col("__back"))
    return first_of_each(placed, "__of", order, share, max(budget, background)).drop("__of", "__back")


def _blocks(queries: DataFrame, vectors: DataFrame, run, schema: str) -> DataFrame:
    """run(queries, vectors) over blocks of at most some QUERY_BLOCK by VECTOR_BLOCK rows, in which all vectors meet all queries.

    Queries are a stated set, not all rows; what a block returns must be few rows for each query.
    """
    blocks = lambda df, size: max(1, -(-df.count() // size))
    across, down = blocks(queries, QUERY_BLOCK), blocks(vectors, VECTOR_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = queries.withColumn("__q", F.pmod(F.xxhash64("query"), F.lit(across))).select("*", every(down).alias("__v"))
    v = vectors.withColumn("__v", F.pmod(F.xxhash64("vec_id"), F.lit(down))).select("*", every(across).alias("__q"))
    names = [part.split()[0] for part in schema.split(",")]

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return run(left, right) if len(left) and len(right) else pd.DataFrame({n: [] for n in names})

    return q.groupBy("__q", "__v").cogroup(v.groupBy("__q", "__v")).applyInPandas(both, schema)


def _matrix(rows) -> np.ndarray:
    return np.array([np.asarray(r, float) for r in rows])


def _unit(rows) -> np.ndarray:
    x = _matrix(rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(x / np.sqrt((x * x).sum(axis=-1, keepdims=True)))


def _best_rows(names: pd.Series, ids: np.ndarray, score: np.ndarray, least: float, most: int) -> pd.DataFrame:
    out = []
    for name, row in zip(names, score, strict=True):
        some = np.flatnonzero(row >= least)
        some = some[np.lexsort((ids[some], -row[some]))[:most]]
        out.append(pd.DataFrame({"query": name, "vec_id": ids[some], "score": row[some]}))
    return pd.concat(out)


def _in_strips(queries: pd.Series, run) -> pd.DataFrame:
    """run(names, their places) for STRIP queries at a time, so that a block's scores are never held as a whole."""
    places = [slice(i, i + STRIP) for i in range(0, len(queries), STRIP)]
    return pd.concat([run(queries.iloc[s], s) for s in places])


def _ranked(found: DataFrame, most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)


def fused_top(queries: DataFrame, vectors: DataFrame, text_weight: float, least: float, most: int) -> DataFrame:
    """(query, vec_id, score, rank): for each query (query, image, text) the best vectors (vec_id, views, text).

    The score is the best cosine of the image over the views plus text_weight times the cosine of the texts.
    """

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        image, views = _unit(left["image"]), _unit([np.stack(r) for r in right["views"]])
        asked, text, ids = _unit(left["text"]), _unit(right["text"]).T, right["vec_id"].to_numpy()

        def strip(names: pd.Series, at: slice) -> pd.DataFrame:
            score = np.max([image[at] @ views[:, k].T for k in range(views.shape[1])], axis=0) + text_weight * (asked[at] @ text)
            return _best_rows(names, ids, score.round(9), least, most)

        return _in_strips(left["query"], strip)

    found = _blocks(queries, vectors, best, "query long, vec_id long, score double")
    return _ranked(found, most).select("query", "vec_id", F.round("score", 6).alias("score"), "rank")


def top_dot(queries: DataFrame, vectors: DataFrame, least: float, most: int) -> DataFrame:
    """(query, vec_id, sim, rank): for each query (query, q) the best vectors (vec_id, e) by their dot product."""

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        asked, vectors_, ids = _matrix(left["q"]), _matrix(right["e"]).T, right["vec_id"].to_numpy()
        return _in_strips(left["query"], lambda names, at: _best_rows(names, ids, asked[at] @ vectors_, least, most))

    found = _blocks(queries, vectors, best, "query long, vec_id long, score double")
    return _ranked(found, most).select("query", "vec_id", F.round("score", 6).alias("sim"), "rank")


def label_best(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, label, sim): for each query the best dot product with another vector of each label."""

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        asked, vectors_, ids = _matrix(left["q"]), _matrix(right["e"]).T, right["vec_id"].to_numpy()
        labels, place = np.unique(right["label"].to_numpy(), return_inverse=True)

        def strip(names: pd.Series, at: slice) -> pd.DataFrame:
            score = asked[at] @ vectors_
            score[names.to_numpy()[:, None] == ids[None, :]] = -np.inf
            top = np.stack([score[:, place == k].max(axis=1) for k in range(len(labels))], axis=1)
            rows = pd.DataFrame({"query": np.repeat(names.to_numpy(), len(labels)), "label": np.tile(labels, len(names)), "sim": top.ravel()})
            return rows[np.isfinite(rows["sim"])]

        return _in_strips(left["query"], strip)

    return _blocks(queries, vectors, best, "query long, label int, sim double").groupBy("query", "label").agg(F.max("sim").alias("sim"))
