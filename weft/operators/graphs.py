"""Taxonomies, trees and grids: closures and components as joins that are written round by round."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.workspace import Workspace


def closure(edges: DataFrame, workspace: Workspace, name: str = "closure", with_self: bool = False) -> DataFrame:
    """(node, ancestor, distance) of edges (child, parent): the smallest distance of each pair.

    Paths double: after k rounds all pairs up to 2 ** k links apart are known, and those at just that distance, joined with all, give the
    next, so a taxonomy of depth d takes log2(d) rounds. A round writes its new pairs only; cycles end, as no pair is found twice. Loops of a
    node to itself are left out.
    """
    edges = workspace.save(edges.select("child", "parent").where("child <> parent").distinct(), f"{name}-edges")
    known = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    reach, step = 1, 0
    while True:
        step += 1
        farthest = known.where(F.col("distance") == reach)
        onward = known.select(F.col("node").alias("__n"), F.col("ancestor").alias("__a"), F.col("distance").alias("__d"))
        further = farthest.join(onward, (F.col("ancestor") == F.col("__n")) & (F.col("node") != F.col("__a")))
        further = further.groupBy("node", F.col("__a").alias("ancestor")).agg((F.min("__d") + reach).alias("distance"))
        fresh = workspace.save(further.join(known, ["node", "ancestor"], "left_anti"), f"{name}-new-{step}")
        if not fresh.limit(1).count():
            break
        known, reach = known.unionByName(fresh), 2 * reach
    if with_self:
        nodes = edges.select(F.col("child").alias("node")).unionByName(edges.select(F.col("parent").alias("node"))).distinct()
        known = known.unionByName(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")))
    return known


def roots(parents: DataFrame, workspace: Workspace, name: str = "roots") -> DataFrame:
    """(node, root, links) of a forest (node, parent): the end of each node's chain and its length.

    Pointers are doubled, so a chain of n links takes log2(n) rounds of one row per node.
    """
    at = workspace.save(parents.select("node", F.col("parent").alias("root"), F.lit(1).cast("long").alias("links")), f"{name}-0")
    step = 0
    while True:
        step += 1
        onward = at.select(F.col("node").alias("__n"), F.col("root").alias("__r"), F.col("links").alias("__l"))
        moved = at.join(onward, F.col("root") == F.col("__n"), "left").select(
            "node", F.coalesce("__r", "root").alias("root"), (F.col("links") + F.coalesce("__l", F.lit(0))).alias("links"), F.col("__r").isNotNull().alias("moved")
        )
        saved = workspace.save(moved, f"{name}-{step}")
        at = saved.select("node", "root", "links")
        if not saved.where("moved").limit(1).count():
            return at


def drop_dominated(nodes: DataFrame, closed: DataFrame) -> DataFrame:
    """Nodes without those that have an ancestor in the set."""
    within = closed.join(nodes.select(F.col("node").alias("ancestor")), "ancestor", "left_semi")
    return nodes.join(within, "node", "left_anti")


def most_concrete(nodes: DataFrame, closed: DataFrame) -> DataFrame:
    """Nodes that no other node of the set lies below."""
    below = closed.join(nodes, "node", "left_semi").select(F.col("ancestor").alias("node")).distinct()
    return nodes.join(below, "node", "left_anti")


def highest_relevant(closed: DataFrame, excluded: DataFrame) -> DataFrame:
    """For each node the farthest ancestor that is not excluded, the first one by name of equals."""
    kept = closed.join(excluded.select(F.col("node").alias("ancestor")), "ancestor", "left_anti")
    return kept.groupBy("node").agg(F.min_by("ancestor", F.struct(-F.col("distance"), F.col("ancestor"))).alias("highest"))


def grid_edges(cells: DataFrame) -> DataFrame:
    """Edges (r, c) to the neighbours below and to the right, weighted by the larger cost of both ends."""
    to = cells.select(F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("cost").alias("cost2"))
    moves = cells.select("r", "c", "cost", F.explode(F.array(F.struct((F.col("r") + 1).alias("r2"), F.col("c").alias("c2")), F.struct(F.col("r").alias("r2"), (F.col("c") + 1).alias("c2")))).alias("m"))
    return moves.select("r", "c", "cost", "m.r2", "m.c2").join(to.hint("merge"), ["r2", "c2"]).select("r", "c", "r2", "c2", F.greatest("cost", "cost2").alias("weight"))


def grid_components(cells: DataFrame, workspace: Workspace) -> DataFrame:
    """(r, c, component) of free cells, 4-neighbours; the component is its smallest cell number.

    All joins are of the size of the map in each round; none is broadcast, so nothing of the map goes through the driver.
    """
    numbered = workspace.save(cells.select("r", "c", "cost", "id"), "cells")
    edges = grid_edges(numbered)
    ids = numbered.select("r", "c", "id")
    links = edges.join(ids.select("r", "c", F.col("id").alias("a")).hint("merge"), ["r", "c"]).join(ids.select(F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("id").alias("b")).hint("merge"), ["r2", "c2"])
    links = workspace.save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = workspace.save(numbered.select(F.col("id").alias("v"), F.col("id").alias("component")), "labels-0")
    step = 0
    while True:
        step += 1
        near = links.join(labels.hint("merge"), links["b"] == labels["v"]).groupBy("a").agg(F.min("component").alias("m"))
        low = labels.join(near.hint("merge"), labels["v"] == near["a"], "left").select("v", F.col("component").alias("was"), F.least("component", "m").alias("low"))
        jump = labels.select(F.col("v").alias("t"), F.col("component").alias("far"))
        moved = low.join(jump.hint("merge"), low["low"] == jump["t"]).select("v", F.least("low", "far").alias("component"), (F.least("low", "far") != F.col("was")).alias("moved"))
        saved = workspace.save(moved, f"labels-{step}")
        labels = saved.select("v", "component")
        if not saved.where("moved").limit(1).count():
            break
    return numbered.join(labels.hint("merge"), numbered["id"] == labels["v"]).select("r", "c", "component")


def _square(cells: DataFrame, radius: int) -> DataFrame:
    """(r, c) of the cells within the radius, in rows and columns, of each cell."""
    shift = F.sequence(F.lit(-radius), F.lit(radius))
    rows = cells.select(F.explode(F.transform(shift, lambda i: F.col("r") + i)).alias("r"), "c")
    return rows.select("r", F.explode(F.transform(shift, lambda i: F.col("c") + i)).alias("c"))


def dilate(cells: DataFrame, radius: int) -> DataFrame:
    """(r, c) of all cells within the radius (in rows and columns) of an occupied one."""
    return _square(cells, radius).distinct()


def erode(cells: DataFrame, radius: int) -> DataFrame:
    """(r, c) of the occupied cells (distinct) whose whole square of the radius is occupied."""
    whole = (2 * radius + 1) ** 2
    return _square(cells, radius).groupBy("r", "c").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == whole).select("r", "c")


#: Cells of a column that one record holds while distances along columns are taken.
COLUMN_BLOCK = 4096


def nearest_along(rows: np.ndarray, first: int, last: int, before: float, after: float) -> np.ndarray:
    """Distance of each of the rows first .. last to the nearest of the given ones (ascending), of `before` and of `after` (NaN: none)."""
    marks = np.concatenate([[-np.inf if np.isnan(before) else before], rows, [np.inf if np.isnan(after) else after]])
    at = np.arange(first, last + 1)
    right = np.searchsorted(marks, at)
    return np.minimum(marks[np.minimum(right, len(marks) - 1)] - at, at - marks[np.maximum(right - 1, 0)])


def lower_envelope(places: np.ndarray, heights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """min over k of (at - places[k]) ** 2 + heights[k], for ascending places and ascending at."""
    hull: list[int] = []  # parabolas that are lowest somewhere
    starts: list[float] = []
    for k in range(len(places)):
        while hull:
            j = hull[-1]
            cross = ((heights[k] + places[k] ** 2) - (heights[j] + places[j] ** 2)) / (2 * (places[k] - places[j]))
            if cross > starts[-1]:
                break
            hull.pop()
            starts.pop()
        hull.append(k)
        starts.append(cross if len(hull) > 1 else -np.inf)
    low = np.array(hull)[np.searchsorted(starts, at, side="right") - 1]
    return (at - places[low]) ** 2 + heights[low]


def distances(free: DataFrame, obstacles: DataFrame) -> DataFrame:
    """(r, c, distance) of free cells: the exact Euclidean distance to the nearest obstacle, null if there is none.

    Two passes. Along the long side of the map each column is cut into blocks of COLUMN_BLOCK cells, and the nearest obstacle of earlier
    and later blocks is carried into a block, so a column need not fit in a task. Along the short side the lower envelope of the
    parabolas over a line's cells gives the distance; such a line has at most as many cells as the square root of the map's box.
    """
    both = free.select("r", "c").unionByName(obstacles.select("r", "c"))
    box = both.agg(*[f(x).alias(f"{n}_{x}") for x in "rc" for n, f in (("low", F.min), ("high", F.max))]).first()
    if not obstacles.limit(1).count():
        return free.select("r", "c").withColumn("distance", F.lit(None).cast("double"))
    turned = box["high_c"] - box["low_c"] > box["high_r"] - box["low_r"]
    if turned:
        free, obstacles = (x.select(F.col("c").alias("r"), F.col("r").alias("c")) for x in (free, obstacles))
    low, high = (box["low_c"], box["high_c"]) if turned else (box["low_r"], box["high_r"])

    block = F.floor((F.col("r") - low) / COLUMN_BLOCK).cast("int")
    marked = obstacles.select("r", "c").distinct().groupBy("c", block.alias("block")).agg(F.array_sort(F.collect_list("r")).alias("rows"))
    blocks = obstacles.select("c").distinct().select("c", F.explode(F.sequence(F.lit(0), F.lit((high - low) // COLUMN_BLOCK))).alias("block"))
    column = Window.partitionBy("c").orderBy("block")
    carried = blocks.join(marked, ["c", "block"], "left").select(
        "c", "block", F.coalesce("rows", F.array().cast("array<int>")).alias("rows"),
        F.last(F.element_at("rows", -1), True).over(column.rowsBetween(Window.unboundedPreceding, -1)).cast("double").alias("before"),
        F.first(F.get("rows", F.lit(0)), True).over(column.rowsBetween(1, Window.unboundedFollowing)).cast("double").alias("after"),
    )

    def along(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for c, n, rows, before, after in frame.itertuples(index=False):
                first = low + n * COLUMN_BLOCK
                last = min(high, first + COLUMN_BLOCK - 1)
                gap = nearest_along(np.asarray(rows, float), first, last, before, after)
                yield pd.DataFrame({"r": np.arange(first, last + 1), "c": c, "gap": gap})

    gaps = carried.mapInPandas(along, "r int, c int, gap double")

    def across(key: tuple, own: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        own, cells = own.sort_values("c"), cells.sort_values("c")
        found = lower_envelope(own["c"].to_numpy(float), own["gap"].to_numpy() ** 2, cells["c"].to_numpy(float)) if len(cells) else np.zeros(0)
        return pd.DataFrame({"r": cells["r"], "c": cells["c"], "distance": np.sqrt(found)})

    wanted = free.select(F.col("r").cast("int"), F.col("c").cast("int"))
    out = gaps.groupBy("r").cogroup(wanted.groupBy("r")).applyInPandas(across, "r int, c int, distance double")
    return out.select(F.col("c").alias("r"), F.col("r").alias("c"), "distance") if turned else out


def line_cells(a: tuple[int, int], b: tuple[int, int]) -> list[tuple[int, int]]:
    """Cells of the straight line between two cells, both included."""
    n = max(abs(b[0] - a[0]), abs(b[1] - a[1]))
    return [(round(a[0] + (b[0] - a[0]) * k / n), round(a[1] + (b[1] - a[1]) * k / n)) for k in range(n + 1)] if n else [a]


def simplified(path: list[tuple[int, int]], cost: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """Waypoints of a path: each is followed by the farthest cell of the path to which the straight line is free and costs no more than
    the path's cells between them."""
    upto = np.concatenate([[0.0], np.cumsum([cost.get(p, np.inf) for p in path])])
    out, at = path[:1], 0
    while at < len(path) - 1:
        to = at + 1
        for further in range(len(path) - 1, at + 1, -1):
            if sum(cost.get(p, np.inf) for p in line_cells(path[at], path[further])) <= upto[further + 1] - upto[at]:
                to = further
                break
        out.append(path[to])
        at = to
    return out


def shortest_paths(maps: DataFrame, start: tuple[int, int], goal: tuple[int, int]) -> DataFrame:
    """Per map (column map; free cells r, c with a cost) the cheapest 4-neighbour path from start to goal by A*, and the
    waypoints ("r,c" by spaces) to which it is simplified.

    A path search is sequential: each map is one group of an applyInPandas, so a map must fit in a task.
    """

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        cost = {(r, c): w for r, c, w in zip(frame["r"], frame["c"], frame["cost"], strict=True)}
        name = frame["map"].iloc[0]
        best, queue, least = {start: 0.0}, [(0.0, start)], min(cost.values(), default=1.0)
        came: dict = {}
        while queue:
            _, at = heapq.heappop(queue)
            if at == goal:
                break
            for step in ((1, 0), (-1, 0), (0, 1), (0, -1)):
                to = (at[0] + step[0], at[1] + step[1])
                if to in cost and at in cost:
                    g = best[at] + max(cost[at], cost[to])
                    if g < best.get(to, float("inf")):
                        best[to], came[to] = g, at
                        heapq.heappush(queue, (g + least * (abs(to[0] - goal[0]) + abs(to[1] - goal[1])), to))
        found, path = goal in best, [goal]
        while found and path[-1] != start:
            path.append(came[path[-1]])
        points = " ".join(f"{r},{c}" for r, c in simplified(path[::-1], cost)) if found else None
        return pd.DataFrame({"map": [name], "reached": [found], "cost": [best.get(goal)], "steps": [len(path) - 1 if found else None], "waypoints": [points]})

    kind = maps.schema["map"].dataType.simpleString()
    return maps.groupBy("map").applyInPandas(search, f"map {kind}, reached boolean, cost double, steps long, waypoints string")


def tile_routes(maps: DataFrame, ends: list[tuple[int, int]], tile: int) -> DataFrame:
    """(map, a, b, w): cheapest ways within each tile between its border cells (and `ends`), and steps across borders; cells are structs (r, c).

    A tile is a group of tile ** 2 cells at most, so a map of any size is cut into tasks of one size.
    """
    cost_kind, kind = "double", maps.schema["map"].dataType.simpleString()
    row, column = F.floor(F.col("r") / tile), F.floor(F.col("c") / tile)

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        cost = {(r, c): w for r, c, w in zip(frame["r"], frame["c"], frame["cost"], strict=True)}
        border = [x for x in cost if x[0] % tile in (0, tile - 1) or x[1] % tile in (0, tile - 1) or x in ends]
        found = [(a, b, d) for a in border for b, d in _within(cost, a)[0].items() if b in set(border) and a != b]
        name = frame["map"].iloc[0]
        return pd.DataFrame([(name, *a, *b, d) for a, b, d in found], columns=["map", "r", "c", "r2", "c2", "weight"], dtype=object)

    inside = maps.groupBy("map", row, column).applyInPandas(within, f"map {kind}, r int, c int, r2 int, c2 int, weight {cost_kind}")
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))])).alias("s")
    leaving = maps.select("map", "r", "c", "cost", step).select("map", "r", "c", "cost", (F.col("r") + F.col("s.i")).alias("r2"), (F.col("c") + F.col("s.j")).alias("c2"))
    leaving = leaving.where((F.floor(F.col("r2") / tile) != row) | (F.floor(F.col("c2") / tile) != column))
    other = maps.select(F.col("map"), F.col("r").alias("r2"), F.col("c").alias("c2"), F.col("cost").alias("cost2"))
    across = leaving.join(other, ["map", "r2", "c2"]).select("map", "r", "c", "r2", "c2", F.greatest("cost", "cost2").alias("weight"))
    every = inside.unionByName(across)
    return every.select("map", F.struct("r", "c").alias("a"), F.struct(F.col("r2").alias("r"), F.col("c2").alias("c")).alias("b"), F.col("weight").alias("w"))


def _within(cost: dict[tuple, float], start: tuple) -> tuple[dict[tuple, float], dict[tuple, tuple]]:
    """Cheapest cost from a cell to all others of a tile, and the cell before each; a step costs the larger of its ends."""
    best, came, queue = {start: 0.0}, {}, [(0.0, start)]
    while queue:
        d, at = heapq.heappop(queue)
        if d > best[at]:
            continue
        for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1)):
            to = (at[0] + i, at[1] + j)
            if to in cost and d + max(cost[at], cost[to]) < best.get(to, float("inf")):
                best[to], came[to] = d + max(cost[at], cost[to]), at
                heapq.heappush(queue, (best[to], to))
    return best, came


def long_paths(maps: DataFrame, start: tuple[int, int], goal: tuple[int, int], workspace: Workspace, tile: int = 32, name: str = "paths") -> DataFrame:
    """(map, place, r, c, spent): the cells of a cheapest 4-neighbour path of each map (free cells map, r, c, cost), with the cost up to each.

    For maps that no task could hold. Ways between border cells are found tile by tile; over these, costs spread from the start in rounds,
    each a join of the cells that have become cheaper with the ways that leave them, written, until none does that could still matter to
    the goal. The way back is followed by doubled pointers, and only the tiles that it crosses are searched again for the cells. A map whose
    goal is not reached has no rows.
    """
    routes = workspace.save(tile_routes(maps.select("map", F.col("r").cast("int"), F.col("c").cast("int"), F.col("cost").cast("double")), [start, goal], tile), f"{name}-routes")
    cell = lambda p: F.struct(F.lit(p[0]).cast("int").alias("r"), F.lit(p[1]).cast("int").alias("c"))
    first = maps.where((F.col("r") == start[0]) & (F.col("c") == start[1])).select("map").distinct()
    reached = workspace.save(first.select("map", cell(start).alias("x"), F.lit(0.0).alias("d"), F.lit(None).cast("struct<r:int,c:int>").alias("before"), F.lit(True).alias("fresh")), f"{name}-0")
    step = 0
    while reached.where("fresh").limit(1).count():
        step += 1
        bound = reached.where(F.col("x") == cell(goal)).select(F.col("map").alias("__m"), F.col("d").alias("__bound"))
        front = reached.where("fresh").join(bound, F.col("map").eqNullSafe(F.col("__m")), "left").where("__bound IS NULL OR d < __bound").drop("__m", "__bound")
        own = routes.select(F.col("map").alias("__map"), "a", "b", "w")
        offers = front.join(own, F.col("map").eqNullSafe(F.col("__map")) & (F.col("x") == F.col("a"))).select("map", F.col("b").alias("x"), (F.col("d") + F.col("w")).alias("d"), F.col("x").alias("before"), F.lit(True).alias("fresh"))
        offers = offers.unionByName(reached.withColumn("fresh", F.lit(False)))
        # the smallest cost counts; what is known wins over an offer that is no cheaper
        best = offers.groupBy("map", "x").agg(F.min(F.struct("d", "fresh", "before")).alias("m")).select("map", "x", "m.d", "m.before", "m.fresh")
        reached = workspace.save(best, f"{name}-{step}")
        workspace.drop(f"{name}-{step - 1}")

    back = reached.select("map", "x", "before", "d")
    chain = workspace.save(back.where(F.col("x") == cell(goal)).select("map", "x", F.lit(0).cast("long").alias("nth")), f"{name}-chain-0")
    jump = workspace.save(back.where("before IS NOT NULL").select(F.col("map").alias("__map"), F.col("x").alias("at"), F.col("before").alias("to")), f"{name}-jump-0")
    hop = 0
    while True:
        found = chain.join(jump, F.col("map").eqNullSafe(F.col("__map")) & (F.col("x") == F.col("at"))).select("map", F.col("to").alias("x"), (F.col("nth") + 2**hop).alias("nth"))
        if not found.limit(1).count():
            break
        hop += 1
        chain = workspace.save(chain.unionByName(found), f"{name}-chain-{hop}")
        onward = jump.select(F.col("__map").alias("__m"), F.col("at").alias("__at"), F.col("to").alias("__to"))
        jump = workspace.save(jump.join(onward, F.col("__map").eqNullSafe(F.col("__m")) & (F.col("to") == F.col("__at"))).select("__map", "at", F.col("__to").alias("to")), f"{name}-jump-{hop}")

    legs = back.join(chain.select(F.col("map").alias("__map"), F.col("x").alias("__x"), "nth"), F.col("map").eqNullSafe(F.col("__map")) & (F.col("x") == F.col("__x"))).where("before IS NOT NULL")
    legs = legs.select("map", "nth", F.col("before").alias("a"), F.col("x").alias("b"), "d")
    tiles = lambda x: (F.floor(F.col(f"{x}.r") / tile), F.floor(F.col(f"{x}.c") / tile))
    inner = workspace.save(legs.withColumns({"tr": tiles("a")[0], "tc": tiles("a")[1], "leaves": (tiles("a")[0] != tiles("b")[0]) | (tiles("a")[1] != tiles("b")[1])}), f"{name}-legs")
    crossed = inner.select("nth", "leaves", "map", "tr", "tc", F.col("a.r").alias("ar"), F.col("a.c").alias("ac"), F.col("b.r").alias("br"), F.col("b.c").alias("bc"), "d")
    cells = maps.select("map", F.col("r").cast("int"), F.col("c").cast("int"), F.col("cost").cast("double"), F.floor(F.col("r") / tile).alias("tr"), F.floor(F.col("c") / tile).alias("tc"))
    cells = cells.join(crossed.select("map", "tr", "tc").distinct(), ["map", "tr", "tc"], "left_semi")
    kind = maps.schema["map"].dataType.simpleString()

    def expand(key: tuple, own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        cost = {(r, c): w for r, c, w in zip(given["r"], given["c"], given["cost"], strict=True)}
        out = []
        for leg in own.itertuples(index=False):
            path, goal_ = [(leg.br, leg.bc)], leg.d
            if not leg.leaves:
                best, came = _within(cost, (leg.ar, leg.ac))
                while path[-1] != (leg.ar, leg.ac):
                    path.append(came[path[-1]])
                out += [(leg.nth, i, *x, goal_ - best[path[0]] + best[x]) for i, x in enumerate(path[:-1])]
            else:
                out.append((leg.nth, 0, *path[0], goal_))
        return pd.DataFrame([(key[0], *x) for x in out], columns=["map", "nth", "i", "r", "c", "spent"], dtype=object)

    found = crossed.groupBy("map", "tr", "tc").cogroup(cells.groupBy("map", "tr", "tc")).applyInPandas(expand, f"map {kind}, nth long, i long, r int, c int, spent double")
    begun = chain.where(F.col("x") == cell(start)).select("map", "nth", F.lit(0).cast("long").alias("i"), F.col("x.r").alias("r"), F.col("x.c").alias("c"), F.lit(0.0).alias("spent"))
    found = workspace.save(found.unionByName(begun), f"{name}-cells")
    # legs are numbered from the goal, and cells within a leg, too; legs of a map are summed first, so a path is one group of numbers
    sizes = found.groupBy("map", "nth").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("n").over(Window.partitionBy("map").orderBy(F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = found.join(before, ["map", "nth"])
    return placed.select("map", (F.col("__before") + F.col("n") - 1 - F.col("i")).alias("place"), "r", "c", "spent")
