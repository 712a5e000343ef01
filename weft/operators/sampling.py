"""Samples that do not depend on partitions: every draw is a hash of keys."""

from __future__ import annotations

import heapq
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weft.functions.text import uniform
from weft.operators.sequences import global_rank, group_rank
from weft.workspace import Workspace


def reservoir(rows: DataFrame, key: str, weight: str, size: int, seed: str = "r") -> DataFrame:
    """The `size` rows with the largest u ** (1 / weight): a weighted sample without replacement."""
    score = F.pow(uniform(F.lit(seed), F.col(key).cast("string")), 1.0 / F.col(weight))
    return rows.withColumn("score", score).orderBy(F.desc("score"), key).limit(size)


def softmax(score: str, temperature: float, group: str, coldest: float = 1e-3) -> Column:
    """Share of each row of a group by exp(score / temperature); scores are taken relative to the group's largest."""
    whole = Window.partitionBy(group)
    e = F.exp((F.col(score) - F.max(score).over(whole)) / max(temperature, coldest))
    return e / F.sum(e).over(whole)


def gumbel_choice(rows: DataFrame, group: str, key: str, score: str, temperature: float, seed: str = "g") -> DataFrame:
    """One row per group with probability in proportion to exp(score / temperature)."""
    u = F.greatest(uniform(F.lit(seed), F.col(group).cast("string"), F.col(key).cast("string")), F.lit(1e-12))
    noisy = F.col(score) / temperature - F.log(-F.log(u))
    return rows.groupBy(group).agg(F.max_by(key, F.struct(noisy, F.col(key))).alias(key))


def first_of_each(rows: DataFrame, group: str, order: list, share: Column, most: int, number: str | None = None) -> DataFrame:
    """The first `share` rows of each group, `most` at most, with their numbers from 1 if a name for these is given.

    Slices of a group (a hash of the row) are cut to `most` first, so no task sorts a whole group; `most` is a bound that is known.
    """
    sliced = rows.withColumn("__slice", F.pmod(F.xxhash64(*rows.columns), F.lit(256)))
    some = sliced.withColumn("__n", F.row_number().over(Window.partitionBy(group, "__slice").orderBy(*order))).where(F.col("__n") <= most)
    found = some.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__n") <= share).drop("__slice")
    return found.withColumnRenamed("__n", number) if number else found.drop("__n")


def quota(rows: DataFrame, group: str, order: list[str], budget: int) -> DataFrame:
    """Equal shares of a budget per group; groups that come first in order get the remainder, one row each (fewer groups than the budget has rows)."""
    groups = rows.select(F.col(group).alias("__g")).distinct()
    whole, rest = divmod(budget, max(1, groups.count()))
    first = groups.orderBy("__g").limit(rest).select(F.col("__g").alias("__first"), F.lit(1).alias("__more"))
    shares = groups.join(first, F.col("__g").eqNullSafe(F.col("__first")), "left").select("__g", (F.lit(whole) + F.coalesce("__more", F.lit(0))).alias("__share"))
    placed = rows.join(shares, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
    return first_of_each(placed, group, order, F.col("__share"), budget).drop("__share")


def capped(rows: DataFrame, group: str, order: list, rate: float, most: int) -> DataFrame:
    """A share of each group, one row at least and `most` at most."""
    sizes = rows.groupBy(F.col(group).alias("__g")).agg(F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * rate))).alias("__share"))
    placed = rows.join(sizes, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
    return first_of_each(placed, group, order, F.col("__share"), most).drop("__share")


def interleave(rows: DataFrame, group: str, order: list[str], workspace: Workspace) -> DataFrame:
    """Place of each row when the first of every group comes first, then the second, and so on: the rank by round and group. No group and no
    round is in one task."""
    numbered = group_rank(rows, group, order, workspace, "round")
    return global_rank(numbered, ["round", group], workspace, "place")


def weighted_order(key: Column, weight: Column, seed: str) -> Column:
    """Ascending by this is a weighted permutation without replacement."""
    return -F.log(F.greatest(uniform(F.lit(seed), key.cast("string")), F.lit(1e-12))) / weight


def balanced(rows: DataFrame, house: str, category: str, instance: str, size: int, seed: str = "b") -> DataFrame:
    """Greedy balanced sample: again and again the row that is least covered so far.

    The score of a row is 1000 if its (house, instance) was used, plus 100 times its category's, 10 times its
    house's and once its instance's share of what is chosen; ties go to the smaller hash. The choice is sequential by
    nature, so the rows that can be chosen are found first. Rows of one (house, category, instance) class score alike. Before each
    choice fewer than `size` houses and instances have been chosen, so a class is never chosen if, with smaller hashes, there are

    - `size` classes of its category and house (one has an instance that is not chosen yet), or of its category and instance, or
    - 4 * size ** 2 classes of its category that are left by that: at most `size` of them share a house or an instance, so 2 * size have
      neither in common, and one of these has a house and an instance that are not chosen yet.

    Of a class `size` rows can be chosen, and only one where there are `size` pairs of house and instance, as an unused pair always
    scores better. What is left, some 4 * size ** 2 rows for each category whatever the number of rows and houses, is one task's.
    """
    keyed = rows.withColumn("__tie", F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in sorted(rows.columns)])))
    sliced = Window.partitionBy(house, category, instance, F.substring("__tie", -1, 1)).orderBy("__tie")
    few = keyed.withColumn("__r", F.row_number().over(sliced)).where(F.col("__r") <= size)
    within = Window.partitionBy(house, category, instance).orderBy("__tie")
    few = few.withColumn("__r", F.row_number().over(within)).where(F.col("__r") <= size)
    heads = few.where("__r = 1").select(house, category, instance, "__tie", F.struct(house, category).alias("__h"), F.struct(instance, category).alias("__i"))
    heads = first_of_each(heads, "__h", ["__tie"], F.lit(size), size)
    heads = first_of_each(heads, "__i", ["__tie"], F.lit(size), size)
    most = 4 * size * size
    heads = first_of_each(heads, category, ["__tie"], F.lit(most), most)
    pairs = rows.select(house, instance).distinct().limit(size).count()
    few = few.where(F.col("__r") <= (1 if pairs >= size else size))
    kept = heads.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate((house, category, instance))])
    same = [F.col(c).eqNullSafe(F.col(f"__k_{i}")) for i, c in enumerate((house, category, instance))]
    ranked = few.join(kept, same[0] & same[1] & same[2], "left_semi")
    schema = StructType([*rows.schema.fields, StructField("picked", LongType())])

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__tie").reset_index(drop=True)
        classes: dict[tuple, list] = {}
        for i, key in enumerate(zip(frame[house], frame[category], frame[instance], strict=True)):
            classes.setdefault(key, []).append(i)
        used: set[tuple] = set()
        counts: list[Counter] = [Counter(), Counter(), Counter()]
        # Heaps of classes that score alike; a class that moved leaves an entry behind, which is dropped when it comes up.
        alike: dict[tuple, list] = {}
        where: dict[tuple, tuple] = {}
        of_instance: dict = {}

        def place(key: tuple) -> None:
            where[key] = (key[0], key[1], counts[2][key[2]], (key[0], key[2]) in used)
            heapq.heappush(alike.setdefault(where[key], []), (classes[key][0], key))

        for key in classes:
            of_instance.setdefault(key[2], []).append(key)
            place(key)
        chosen: list = []
        while len(chosen) < size:
            for at in list(alike):
                heap = alike[at]
                while heap and (where[heap[0][1]] != at or classes[heap[0][1]][:1] != [heap[0][0]]):
                    heapq.heappop(heap)
                if not heap:
                    del alike[at]
            if not alike:
                break
            n = max(1, len(chosen))
            best = min(alike, key=lambda k: (1000 * k[3] + (100 * counts[1][k[1]] + 10 * counts[0][k[0]] + k[2]) / n, alike[k][0][0]))
            key = alike[best][0][1]
            chosen.append(classes[key].pop(0))
            used.add((key[0], key[2]))
            for count, value in zip(counts, key, strict=True):
                count[value] += 1
            for other in of_instance[key[2]]:
                if classes[other]:
                    place(other)
        return frame.loc[chosen].drop(columns=["__r", "__tie"]).assign(picked=range(len(chosen)))

    return ranked.withColumn("__one", F.lit(1)).groupBy("__one").applyInPandas(lambda f: choose(f.drop(columns="__one")), schema)


def farthest_points(points: DataFrame, group: str, key: str, dims: list[str], size: int, workspace) -> DataFrame:
    """Farthest-point sampling within each group, from the point with the smallest key on: (group, key, picked).

    A round adds to each group the point that is farthest from all chosen ones, the smallest key of equals, by one
    aggregation; points keep their distance to the chosen ones, and no group is in one task.
    """
    x = F.array(*[F.col(d).cast("double") for d in dims])
    rest = workspace.save(points.select(F.col(group).alias("g"), F.col(key).alias("k"), x.alias("x"), F.lit(float("inf")).alias("d")), "points-0")
    chosen = None
    for step in range(size):
        best = rest.groupBy("g").agg(F.max_by(F.struct("k", "x"), F.struct("d", -F.col("k"))).alias("p")) if step else rest.groupBy("g").agg(F.min_by(F.struct("k", "x"), "k").alias("p"))
        best = workspace.save(best.select(F.col("g").alias("h"), F.col("p.k").alias("pk"), F.col("p.x").alias("px"), F.lit(step).cast("long").alias("picked")), f"picked-{step}")
        chosen = best if chosen is None else chosen.unionByName(best)
        if step + 1 < size:
            square = F.aggregate(F.zip_with("x", "px", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
            moved = rest.join(best, F.col("g").eqNullSafe(F.col("h"))).where(F.col("k") != F.col("pk")).select("g", "k", "x", F.least("d", square).alias("d"))
            rest = workspace.save(moved, f"points-{step + 1}")
            workspace.drop(f"points-{step}")
    return chosen.select(F.col("h").alias(group), F.col("pk").alias(key), "picked")
