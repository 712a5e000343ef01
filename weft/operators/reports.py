"""Reports on results. What they collect in one row are names of scenes of a split or distinct messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_category(results: DataFrame, names: str, count: str) -> DataFrame:
    """How often each category (a name's part before its first underscore) occurs in a nested list of names."""
    return results.select(F.explode(names).alias("__name")).groupBy(F.split_part("__name", F.lit("_"), F.lit(1)).alias("category")).agg(F.count(F.lit(1)).alias(count))


def pass_lists(scenes: DataFrame, group: str, name: str, ok: str, number: str) -> DataFrame:
    """passed, passed_names, failed and failed_names of each group; names that match the pattern, by the number in it."""
    found = scenes.where(F.col(name).rlike(number))
    row = F.struct(F.regexp_extract(name, number, 1).cast("long").alias("n"), F.col(name).alias("name"))

    def names(condition) -> F.Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(condition, row))), lambda x: x["name"]), ",")

    return found.groupBy(group).agg(
        F.count_if(F.col(ok)).alias("passed"), names(F.col(ok)).alias("passed_names"),
        F.count_if(~F.col(ok)).alias("failed"), names(~F.col(ok)).alias("failed_names"),
    )


def mixture_totals(spec: DataFrame, results: DataFrame, crashes: DataFrame) -> DataFrame:
    """component, success_count, total_count and error of each component of spec, and a row TOTAL.

    A component that crashed (component, error) or has no result counts zero, with a message.
    """
    known = spec.join(results, "component", "left").join(crashes, "component", "left")
    error = F.coalesce("error", F.when(F.col("total_count").isNull(), F.lit("no result")))
    count = lambda c: F.when(error.isNull(), F.col(c)).otherwise(F.lit(0)).cast("long").alias(c)
    rows = known.select("component", count("success_count"), count("total_count"), error.alias("error"))
    failed = F.concat(F.count("error").cast("string"), F.lit(" of "), F.count(F.lit(1)).cast("string"), F.lit(" components failed"))
    total = rows.agg(F.sum("success_count").alias("success_count"), F.sum("total_count").alias("total_count"), failed.alias("error"))
    return rows.unionByName(total.select(F.lit("TOTAL").alias("component"), "success_count", "total_count", "error"))


def messages(results: DataFrame, ok: str, error: str) -> DataFrame:
    """ok, n and the distinct error messages in order; messages are counted before they meet in a row."""
    kinds = results.groupBy(ok, error).agg(F.count(F.lit(1)).alias("__n"))
    return kinds.groupBy(ok).agg(F.sum("__n").alias("n"), F.array_join(F.array_sort(F.collect_list(error)), "; ").alias("errors"))


def paired(first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """key, the two values and their ratio; a key of the first that the second lacks is an error when the rows are read."""
    a, b = first.select(F.col(key), F.col(value).alias("first")), second.select(F.col(key).alias("__k"), F.col(value).alias("second"))
    both = a.join(b, F.col(key) == F.col("__k"), "left")
    missing = F.raise_error(F.concat(F.lit(f"no {key} "), F.col(key).cast("string"), F.lit(" in the second result")))
    ratio = F.when(F.col("__k").isNotNull(), F.try_divide("first", "second")).otherwise(missing.cast("double"))
    return both.select(key, "first", "second", ratio.alias("ratio"))
