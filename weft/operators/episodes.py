"""Success, length and validity of episodes from their steps (episode, t, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_true(flag: str, t: str = "t") -> Column:
    """Value at the last step; false without steps."""
    return F.coalesce(F.max_by(flag, t), F.lit(False))


def any_true(flag: str) -> Column:
    return F.coalesce(F.bool_or(flag), F.lit(False))


def first_true(flag: str, t: str = "t") -> Column:
    """First step at which the flag holds, 0 if none does (as an argmax of booleans gives)."""
    return F.coalesce(F.min(F.when(F.col(flag), F.col(t))), F.lit(0)).cast("long")


def outcomes(steps: DataFrame, max_steps: int | None = None) -> DataFrame:
    """One row per episode: success at its end and anywhere, first success, length; steps past max_steps are cut."""
    if max_steps is not None:
        steps = steps.where(F.col("t") < max_steps)
    return steps.groupBy("episode").agg(
        last_true("success").alias("success_end"),
        any_true("success").alias("success_any"),
        first_true("success").alias("first_success"),
        F.count(F.lit(1)).alias("length"),
        F.max("reward").alias("best_reward"),
    )


def reward_success(steps: DataFrame, threshold: float, max_steps: int) -> DataFrame:
    """Success by the largest reward among the first steps; where rewards are missing, by the success flags."""
    return (
        steps.where(F.col("t") < max_steps)
        .groupBy("episode")
        .agg(F.coalesce(F.max("reward") >= threshold, F.bool_or("success"), F.lit(False)).alias("success"))
    )


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, 0 for an empty whole."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, digits)).otherwise(F.lit(0.0))


def success_report(outcomes_by_category: DataFrame, category: str) -> DataFrame:
    """Counts and rates per category with an OVERALL row."""
    n = F.count(F.lit(1))
    ends, anywhere = F.count_if("success_end"), F.count_if("success_any")
    return (
        outcomes_by_category.rollup(category)
        .agg(
            F.grouping(category).alias("__all"),
            ends.alias("successes"),
            n.alias("total"),
            rate(ends, n).alias("success_rate_pct"),
            anywhere.alias("oracle_successes"),
            rate(anywhere, n).alias("oracle_rate_pct"),
        )
        .select(
            F.when(F.col("__all") == 1, "OVERALL").otherwise(F.coalesce(category, F.lit("unknown"))).alias("category"),
            "successes", "total", "success_rate_pct", "oracle_successes", "oracle_rate_pct",
        )
    )


def validity(steps: DataFrame, arrays: list[str], required: list[str], min_steps: int = 3) -> DataFrame:
    """One row per episode: why it is invalid. Arrays are columns that must have a value at each step; equal
    lengths mean as many values in each; a required column must be present at every step."""
    counts = [F.count(a).alias(f"__n_{a}") for a in arrays]
    needs = [F.count(a).alias(f"__r_{a}") for a in required]
    found = steps.groupBy("episode").agg(F.count(F.lit(1)).alias("length"), *counts, *needs)
    lengths = [F.col(f"__n_{a}") for a in arrays]
    equal = F.lit(True)
    for other in lengths[1:]:
        equal = equal & (other == lengths[0])
    present = F.lit(True)
    for a in required:
        present = present & (F.col(f"__r_{a}") == F.col("length"))
    return found.select(
        "episode",
        "length",
        (lengths[0] > 0).alias("has_actions"),
        equal.alias("equal_lengths"),
        (lengths[0] >= min_steps).alias("long_enough"),
        present.alias("state_present"),
        ((lengths[0] > 0) & equal & (lengths[0] >= min_steps) & present).alias("valid"),
    )


def consecutive_ids(items: DataFrame, group: str, index: str) -> DataFrame:
    """Per group whether its indexes are exactly 0 .. n - 1."""
    n = F.count(F.lit(1))
    return items.groupBy(group).agg(
        n.alias("n"),
        ((F.min(index) == 0) & (F.max(index) == n - 1) & (F.count_distinct(index) == n)).alias("consecutive"),
    )


def with_defaults(steps: DataFrame) -> DataFrame:
    """Fields a writer fills in where they are missing: the last step terminates, failure is no success."""
    last = F.col("t") == F.max("t").over(Window.partitionBy("episode"))
    return steps.withColumns(
        {
            "terminated": F.coalesce(F.col("terminated"), last),
            "truncated": F.coalesce(F.col("truncated"), F.lit(False)),
            "reward": F.coalesce(F.col("reward"), F.lit(0.0)),
            "success": F.coalesce(F.col("success"), F.lit(False)),
        }
    ).withColumn("fail", ~F.col("success"))
