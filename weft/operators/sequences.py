"""Windows along the steps of an episode: differences, ratios, segments, running values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def third_difference(x: str, over) -> Column:
    return F.col(x) - 3 * F.lag(x, 1).over(over) + 3 * F.lag(x, 2).over(over) - F.lag(x, 3).over(over)


def mean_jerk(steps: DataFrame, dims: list[str], dt: float) -> DataFrame:
    """Mean length of the third difference over dt**3 per episode; null under four steps."""
    over = Window.partitionBy("episode").orderBy("t")
    squares = sum((F.pow(third_difference(d, over), F.lit(2)) for d in dims), F.lit(0.0))
    return steps.select("episode", (F.sqrt(squares) / F.lit(dt**3)).alias("jerk")).groupBy("episode").agg(F.avg("jerk").alias("jerk"))


def tracking_ratios(steps: DataFrame, command: str, state: str, relative: str, eps: float, skip: int) -> DataFrame:
    """Error of the next state against the command over the commanded step; steps whose denominator is under eps
    and the first `skip` steps are left out, as is the last one, which has no next state."""
    over = Window.partitionBy("episode").orderBy("t")
    following = steps.withColumn("__next", F.lead(state).over(over))
    return following.where((F.abs(relative) >= eps) & (F.col("t") >= skip) & F.col("__next").isNotNull()).select(
        "episode", "t", "key", (F.abs(F.col("__next") - F.col(command)) / F.abs(relative)).alias("ratio")
    )


def deviation_bounds(values: DataFrame, key: str, value: str, times: float, least: int = 10) -> DataFrame:
    """Mean plus and minus so many population deviations per key; keys with fewer values have no bounds."""
    found = values.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"))
    return found.where(F.col("n") >= least).select(
        key, "mean", "std", "n", (F.col("mean") - times * F.col("std")).alias("lower"), (F.col("mean") + times * F.col("std")).alias("upper")
    )


def outside(values: DataFrame, bounds: DataFrame, key: str, value: str) -> DataFrame:
    """Values outside their key's bounds."""
    return values.join(bounds, key).where((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")))


def merge_gaps(points: DataFrame, gap: int, pad: int, lengths: DataFrame) -> DataFrame:
    """Points (episode, t, value) merged to segments where they are at most `gap` apart; the largest value of each
    segment; its ends padded and clamped to the episode."""
    over = Window.partitionBy("episode").orderBy("t")
    starts = F.when(F.col("t") - F.lag("t").over(over) <= gap, 0).otherwise(1)
    numbered = points.withColumn("__new", starts).withColumn("segment", F.sum("__new").over(over))
    found = numbered.groupBy("episode", "segment").agg(
        F.min("t").alias("first"), F.max("t").alias("last"), F.max("value").alias("worst"), F.count(F.lit(1)).alias("points")
    )
    return found.join(lengths, "episode").select(
        "episode",
        "segment",
        F.greatest(F.col("first") - pad, F.lit(0)).alias("from_t"),
        F.least(F.col("last") + pad, F.col("length") - 1).alias("to_t"),
        "worst",
        "points",
    )


def stride(steps: DataFrame, first: int, step: int) -> DataFrame:
    """Every step-th step from `first` on, and always the last useful one (before the sentinel)."""
    n = F.count(F.lit(1)).over(Window.partitionBy("episode"))
    return (
        steps.withColumn("__n", n)
        .where((F.col("t") >= first) & (F.col("t") <= F.col("__n") - 2))
        .where((F.pmod(F.col("t") - first, F.lit(step)) == 0) | (F.col("t") == F.col("__n") - 2))
        .drop("__n")
    )


def sigma_clip(values: DataFrame, key: str, value: str, sigmas: float = 4.0, *, checkpoint) -> DataFrame:
    """Mean, deviation and count per key after dropping what lies outside the mean plus and minus `sigmas`
    deviations until nothing does. Each pass is one aggregation; the state is one pair of bounds per key.

    checkpoint(df, name) writes a frame and reads it back, to cut the lineage of the passes. A pass that drops
    nothing is the last one; every other one drops a value, so passes end.
    """
    step = 0
    state = values.groupBy(key).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"), F.lit(False).alias("done"),
        F.lit(float("-inf")).alias("lower"), F.lit(float("inf")).alias("upper"),
    )
    while True:
        bounds = state.select(
            key,
            F.greatest("lower", F.col("mean") - sigmas * F.col("std")).alias("lower"),
            F.least("upper", F.col("mean") + sigmas * F.col("std")).alias("upper"),
            F.col("n").alias("__before"),
        )
        inside = values.join(bounds, key).where((F.col(value) >= F.col("lower")) & (F.col(value) <= F.col("upper")))
        state = inside.groupBy(key).agg(
            F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n"),
            (F.count(value) == F.first("__before")).alias("done"), F.first("lower").alias("lower"), F.first("upper").alias("upper"),
        )
        state = checkpoint(state, f"clip-{step}")
        if not state.where("NOT done").limit(1).count():
            return state.select(key, "mean", "std", "n", "lower", "upper")
        step += 1


def group_rank(df: DataFrame, group: str, order: list[Column | str], workspace, name: str = "round") -> DataFrame:
    """Number of each row in its group, from 1, without a window over a group: a group may be dealt to many parts.

    Rows are dealt by range of group and order into written parts; a row's number is its number in its part and group and the sizes of the
    group's parts before. There are at most as many sizes as groups and parts.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = workspace.save(df.repartitionByRange(parts, F.col(group).asc_nulls_first(), *order).withColumn("__part", F.spark_partition_id()), f"{name}-parts")
    sizes = dealt.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__g", "__p", before.alias("__before"))
    numbered = dealt.withColumn("__in", F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)))
    joined = numbered.join(offsets, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__part", "__before", "__in", "__g", "__p")


def global_rank(df: DataFrame, order: list[Column | str], workspace, name: str = "place") -> DataFrame:
    """Number of each row in a total order, without one window over all rows.

    Rows are dealt by range into written parts; a row's number is its number in its part and the sizes of the parts
    before, of which there are as many as shuffle partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = workspace.save(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), f"{name}-parts")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__before"))
    numbered = dealt.withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    joined = numbered.join(F.broadcast(offsets), "__part")  # one row per part
    return joined.withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__part", "__before", "__in")
