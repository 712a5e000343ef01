"""Joins and set operations with semantics of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_key_or_hash(left: DataFrame, key: str, right: DataFrame, uid: str) -> DataFrame:
    """Rows of left whose key is a uid of right or the md5 of one: two equi joins, not a join on a disjunction."""
    plain = left.join(right, left[key] == right[uid])
    hashed = left.join(right.withColumn("__h", F.md5(F.col(uid).cast("string"))), F.col(key) == F.col("__h")).drop("__h")
    return plain.unionByName(hashed)


def without_blacklisted(left: DataFrame, key: str, black: DataFrame, uid: str) -> DataFrame:
    """Rows of left whose key is neither a blacklisted uid nor the md5 of one."""
    names = black.select(F.explode(F.array(F.col(uid).cast("string"), F.md5(F.col(uid).cast("string")))).alias("__k")).distinct()
    return left.join(names, F.col(key) == F.col("__k"), "left_anti")


def having_all(items: DataFrame, group: str, member: str, wanted: list) -> DataFrame:
    """Groups that have every wanted member (relational division)."""
    return (
        items.where(F.col(member).isin(wanted)).groupBy(group)
        .agg(F.count_distinct(member).alias("__n")).where(F.col("__n") == len(set(wanted))).select(group)
    )


def cells(x: str, y: str, size: float) -> tuple[Column, Column]:
    """Grid cell of a point."""
    return F.floor(F.col(x) / size).alias("cell_x"), F.floor(F.col(y) / size).alias("cell_y")


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """Pairs of points (px, py) and boxes (x0, x1, y0, y1; borders inside) by an equi join on the grid cells that a
    box covers, then the exact comparison: no cross product of points and boxes."""
    placed = points.select("*", *cells("px", "py", size))
    covered = boxes.select(
        "*", F.explode(F.sequence(F.floor(F.col("x0") / size), F.floor(F.col("x1") / size))).alias("cell_x")
    ).select("*", F.explode(F.sequence(F.floor(F.col("y0") / size), F.floor(F.col("y1") / size))).alias("cell_y"))
    found = placed.join(covered, ["cell_x", "cell_y"]).where(F.col("px").between(F.col("x0"), F.col("x1")) & F.col("py").between(F.col("y0"), F.col("y1")))
    return found.drop("cell_x", "cell_y")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each left row with the last right value at or before it: one union and one window instead of a range join."""
    both = left.select("*", F.lit(1).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__v")).unionByName(
        right.select(key, at, F.lit(0).alias("__side"), F.col(value).alias("__v")), allowMissingColumns=True
    )
    over = Window.partitionBy(key).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(value, F.last("__v", ignorenulls=True).over(over)).where("__side = 1").drop("__side", "__v")


def structural_diff(left: DataFrame, right: DataFrame, path: str, value: str, atol: float, rtol: float) -> DataFrame:
    """Paths on one side only, and values that differ by more than the tolerances; equal paths are left out."""
    a, b = left.select(F.col(path).alias("a"), F.col(value).alias("va")), right.select(F.col(path).alias("b"), F.col(value).alias("vb"))
    both = a.join(b, F.col("a") == F.col("b"), "full_outer")
    state = (
        F.when(F.col("b").isNull(), "left only").when(F.col("a").isNull(), "right only")
        .when(F.abs(F.col("va") - F.col("vb")) > atol + rtol * F.abs("vb"), "differs")
    )
    return both.select(F.coalesce("a", "b").alias(path), state.alias("state")).where("state IS NOT NULL")


def near_duplicates(points: DataFrame, dims: list[str], atol: float) -> DataFrame:
    """Points without those that have a later point within atol in every dimension.

    Points are dealt to cells of that size. A cell's latest point has all others of the cell within atol, which therefore go; only what is
    left, about one point of a cell, is compared with the points of the cells around. So the work grows with the points, however dense.
    """
    cell = lambda x: F.floor(x / atol)
    own = points.select("*", *[cell(F.col(d)).alias(f"__c{i}") for i, d in enumerate(dims)])
    places = [F.col(f"__c{i}") for i in range(len(dims))]
    latest = own.groupBy(*places).agg(F.max_by(F.struct("id", *dims), "id").alias("__l"))
    to_latest = reduce(lambda x, y: x & y, [c.eqNullSafe(F.col(f"__d{i}")) for i, c in enumerate(places)])
    latest = latest.select(*[c.alias(f"__d{i}") for i, c in enumerate(places)], "__l")
    close_to_latest = reduce(lambda x, y: x & y, [F.abs(F.col(d) - F.col(f"__l.{d}")) <= atol for d in dims], F.col("id") < F.col("__l.id"))
    left = own.join(latest, to_latest).where(~F.coalesce(close_to_latest, F.lit(False))).select(*points.columns)
    around = left.select(*[F.col(c).alias(f"__o_{c}") for c in ["id", *dims]])
    wide = atol * (1 + 1e-9)  # differences are rounded
    for i, d in enumerate(dims):
        around = around.withColumn(f"__d{i}", F.explode(F.sequence(cell(F.col(f"__o_{d}") - wide), cell(F.col(f"__o_{d}") + wide))))
    same_cell = reduce(lambda x, y: x & y, [c == F.col(f"__d{i}") for i, c in enumerate(places)])
    close = reduce(lambda x, y: x & y, [F.abs(F.col(d) - F.col(f"__o_{d}")) <= atol for d in dims])
    gone = around.join(own, same_cell & (F.col("__o_id") < F.col("id")) & close).select("__o_id", *[f"__o_{d}" for d in dims]).distinct()
    return left.join(gone, reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__o_{c}") for c in ["id", *dims]]), "left_anti")


def overlay(*layers: DataFrame, key: str) -> DataFrame:
    """Later layers win per column; a missing or null value keeps the earlier one."""
    out = layers[0]
    for layer in layers[1:]:
        names = [c for c in layer.columns if c != key]
        renamed = layer.select(key, *[F.col(c).alias(f"__n_{c}") for c in names])
        out = out.join(renamed, key, "full_outer")
        out = out.select(
            key,
            *[F.coalesce(F.col(f"__n_{c}"), F.col(c)).alias(c) if c in names else F.col(c) for c in out.columns if c != key and not c.startswith("__n_")],
            *[F.col(f"__n_{c}").alias(c) for c in names if c not in out.columns],
        )
    return out
