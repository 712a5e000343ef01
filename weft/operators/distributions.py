"""Profiles of values: mergeable statistics, histograms, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.workspace import Workspace


def vector_stats(value: str) -> list[Column]:
    """Statistics that can be merged: sum, sum of squares, count, extremes, and m2 (squared distances from the mean) beside mean and deviation."""
    x = F.col(value)
    return [
        F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.count(x).alias("count"), F.sum(x).alias("sum"), F.sum(x * x).alias("sum_sq"), (F.var_pop(x) * F.count(x)).alias("m2"),
    ]


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Statistics of the union of the parts that `vector_stats` described.

    The variance is that within the parts and that between their means, so nothing cancels where the mean is large; parts without values
    count for nothing.
    """
    found = parts.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.sum("sum_sq").alias("sum_sq"), F.min("min").alias("min"), F.max("max").alias("max")
    )
    means = found.select(*[F.col(k).alias(f"__{k}") for k in keys], (F.col("sum") / F.col("count")).alias("__mean"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    apart = F.col("mean") - F.col("__mean")
    spread = parts.join(means, same).groupBy(*[f"__{k}" for k in keys]).agg(
        F.max("__mean").alias("mean"), F.sum(F.col("m2") + F.col("count") * apart * apart).alias("m2")
    )
    both = found.join(spread, same).drop(*[f"__{k}" for k in keys])
    return both.withColumn("std", F.sqrt(F.col("m2") / F.col("count")))


#: Numbers that a quantile sketch keeps, and the error of its ranks that it exceeds about never.
SKETCH, SKETCH_ERROR = 4096, 0.004


def file_sketches(values: DataFrame, value: str, *keys: str, distinct: str | None = None) -> DataFrame:
    """Sketches to store beside a file's statistics: `quantiles` (KLL) of a value and, if asked for, `distincts` (HLL) of a column."""
    found = [F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH)).alias("quantiles"), F.count(value).alias("count")]
    return values.where(F.col(value).isNotNull()).groupBy(*keys).agg(*found, *([F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(14)).alias("distincts")] if distinct else []))


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of the union of files; they merge like sums, in any order."""
    found = [F.kll_merge_agg_double("quantiles", F.lit(SKETCH)).alias("quantiles"), F.sum("count").alias("count")]
    return sketches.groupBy(*keys).agg(*found, *([F.hll_union_agg("distincts").alias("distincts")] if "distincts" in sketches.columns else []))


def sketched_quantile(p: float) -> Column:
    """A value whose rank is within SKETCH_ERROR of p."""
    return F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))


#: Rows of a group whose values one buffer may hold.
SMALL_GROUP = 1_000_000


def exact_quantiles(values: DataFrame, group: str, value: str, probabilities: list[float], workspace: Workspace, name: str = "quantiles", small: int = SMALL_GROUP) -> DataFrame:
    """(group, p, quantile): exact quantiles with linear interpolation, without the values of more than `small` rows in one place.

    Groups that are all small are given to `percentile`. Otherwise a merged sketch says between which two values a quantile lies, for certain but for the sketch's error; the values below are counted and
    only those between are sorted, SKETCH_ERROR of a group on either side. Where a count shows that the quantile is not between,
    that is done again with a wider margin.
    """
    rows = values.where(F.col(value).isNotNull()).select(F.col(group).alias("__g"), F.col(value).cast("double").alias("__v"))
    if (rows.groupBy("__g").count().agg(F.max("count")).first()[0] or 0) <= small:
        cuts = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probabilities]))
        found = rows.groupBy(F.col("__g").alias(group)).agg(cuts.alias("__cuts"))
        each = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probabilities]).alias("p"), F.col("__cuts").alias("quantile"))
        return found.select(group, F.explode(each).alias("e")).select(group, "e.p", "e.quantile")
    sketches = workspace.save(merged_sketches(file_sketches(rows.withColumn("__part", F.spark_partition_id()), "__v", "__g", "__part"), "__g"), f"{name}-sketches")
    left = sketches.select("__g", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
    out, margin = None, SKETCH_ERROR
    for attempt in range(8):
        edges = [
            F.struct(
                F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("count") - 1)).alias("at"),
                (sketched_quantile(p - margin) if p > margin else F.lit(float("-inf"))).alias("low"), (sketched_quantile(p + margin) if p + margin < 1 else F.lit(float("inf"))).alias("high"),
            )
            for p in probabilities
        ]
        edges = sketches.select(F.col("__g").alias("__e"), F.explode(F.array(*edges)).alias("e"))
        bracket = left.join(edges, F.col("__g").eqNullSafe(F.col("__e")) & (F.col("p") == F.col("e.p"))).select("__g", "p", "e.at", "e.low", "e.high")
        bracket = workspace.save(bracket, f"{name}-{attempt}")
        own = bracket.select(F.col("__g").alias("__h"), "p", "at", "low", "high")
        joined = rows.join(own, F.col("__g").eqNullSafe(F.col("__h")))
        below = joined.where("__v < low").groupBy(F.col("__h").alias("__b"), F.col("p").alias("__p")).agg(F.count(F.lit(1)).alias("below"))
        between = joined.where("__v >= low AND __v <= high").withColumn("__n", F.row_number().over(Window.partitionBy("__h", "p").orderBy("__v")) - 1)
        placed = between.join(below, F.col("__h").eqNullSafe(F.col("__b")) & (F.col("p") == F.col("__p")), "left").withColumn("__n", F.col("__n") + F.coalesce("below", F.lit(0)))
        share = F.col("at") - F.floor("at")
        ends = placed.where("__n = floor(at) OR __n = ceil(at)").groupBy("__h", "p", "at").agg(
            F.max(F.when(F.col("__n") == F.floor("at"), F.col("__v"))).alias("x"), F.max(F.when(F.col("__n") == F.ceil("at"), F.col("__v"))).alias("y")
        )
        found = ends.where("x IS NOT NULL AND y IS NOT NULL").select(F.col("__h").alias("__f"), "p", (F.col("x") + share * (F.col("y") - F.col("x"))).alias("quantile"))
        found = workspace.save(found, f"{name}-found-{attempt}")
        out = found if out is None else out.unionByName(found)
        done = found.select(F.col("__f").alias("__d"), F.col("p").alias("__q"))
        left = left.join(done, F.col("__g").eqNullSafe(F.col("__d")) & (F.col("p") == F.col("__q")), "left_anti")
        if not left.limit(1).count():
            break
        margin *= 6
    return out.withColumnRenamed("__f", group)


def histogram(values: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by bin of equal width; the last bin has its right edge; values outside are counted as bin -1."""
    x = F.col(value)
    inside = (x >= low) & (x <= high)
    place = F.least(F.floor((x - low) / F.lit((high - low) / bins)), F.lit(bins - 1)).cast("long")
    return values.where(x.isNotNull()).groupBy(F.when(inside, place).otherwise(F.lit(-1).cast("long")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_2d(values: DataFrame, x: str, y: str, edges_x: tuple[float, float, int], edges_y: tuple[float, float, int]) -> DataFrame:
    """Counts on a grid; the last row and column have their right edges; values outside are left out."""
    def place(name: str, low: float, high: float, bins: int) -> Column:
        return F.least(F.floor((F.col(name) - low) / F.lit((high - low) / bins)), F.lit(bins - 1)).cast("long")

    def within(name: str, low: float, high: float, bins: int) -> Column:
        return F.col(name).between(low, high)

    kept = values.where(within(x, *edges_x) & within(y, *edges_y))
    return kept.groupBy(place(x, *edges_x).alias("bin_x"), place(y, *edges_y).alias("bin_y")).agg(F.count(F.lit(1)).alias("n"))


def identity_r2(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """1 - sum (x - y)**2 / sum (x - mean x)**2: agreement with the diagonal, not a regression."""
    return pairs.agg(
        (F.lit(1.0) - F.sum(F.pow(F.col(x) - F.col(y), F.lit(2))) / (F.var_pop(x) * F.count(x))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def key_at_most(value: str, key: str) -> Column:
    """The key of a group's largest value, the smallest of equal ones; ~ turns the order of keys around, without overflow."""
    return F.max_by(key, F.when(F.col(value).isNotNull(), F.struct(F.col(value), F.bitwise_not(key))))


def key_at_least(value: str, key: str) -> Column:
    """The key of a group's smallest value, the smallest of equal ones."""
    return F.min_by(key, F.when(F.col(value).isNotNull(), F.struct(value, key)))


def largest(df: DataFrame, group: str, value: str, key: str, most: int) -> DataFrame:
    """group and top: the keys of its largest values, ties by key.

    A row can only be among them if it is among the largest of its slice (a hash of the key), so no task sorts a whole group.
    """
    rows = df.where(F.col(value).isNotNull()).withColumn("__slice", F.pmod(F.xxhash64(key), F.lit(64)))
    order = [F.desc(value), F.col(key)]
    some = rows.withColumn("__n", F.row_number().over(Window.partitionBy(group, "__slice").orderBy(*order))).where(F.col("__n") <= most)
    best = some.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__n") <= most)
    return best.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", key))), lambda x: x[key]).alias("top"))
