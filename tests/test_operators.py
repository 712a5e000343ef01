"""Operators that SQL does not cover, and their edges, on small tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from weft.functions import geometry, text
from weft.operators import distributions, episodes, graphs, numeric, relations, sampling, sequences
from weft.sources import files, trajectory_files
from weft.workspace import Workspace


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def steps(spark, *episodes_):
    data = [(e, t, s, 1.0) for e, flags in episodes_ for t, s in enumerate(flags)]
    return spark.createDataFrame(data, "episode long, t long, success boolean, reward double")


def test_success_arrays(spark):
    found = episodes.outcomes(steps(spark, (1, [False, False]), (2, [True, False]), (3, [False, True, False]), (4, [False, True])))
    got = {r.episode: (r.success_end, r.success_any, r.first_success) for r in found.collect()}
    assert got == {1: (False, False, 0), 2: (False, True, 0), 3: (False, True, 1), 4: (True, True, 1)}


def test_truncated_success(spark):
    s = steps(spark, (1, [False, False, True]))
    assert episodes.outcomes(s, max_steps=2).first().success_any is False
    assert episodes.reward_success(s, 0.5, 2).first().success is True
    no_reward = s.withColumn("reward", F.lit(None).cast("double"))
    assert episodes.reward_success(no_reward, 0.5, 3).first().success is True


def test_overall_row(spark):
    s = episodes.outcomes(steps(spark, (1, [True]), (2, [False]))).withColumn("category", F.when(F.col("episode") == 1, "mug"))
    got = {r.category: (r.successes, r.total, r.success_rate_pct) for r in episodes.success_report(s, "category").collect()}
    assert got == {"mug": (1, 1, 100.0), "unknown": (0, 1, 0.0), "OVERALL": (1, 2, 50.0)}


def test_consecutive_ids(spark):
    items = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 2), ("c", 0), ("c", 0)], "f string, i int")
    assert {r.f: r.consecutive for r in episodes.consecutive_ids(items, "f", "i").collect()} == {"a": True, "b": False, "c": False}


def test_jerk_of_short_and_constant_series(spark):
    data = [(1, t, float(t), 0.0) for t in range(3)] + [(2, t, float(t * t), 0.0) for t in range(6)] + [(3, 0, 0.0, 0.0), (3, 1, 0.0, 0.0), (3, 2, 0.0, 0.0), (3, 3, 1.0, 0.0)]
    df = spark.createDataFrame(data, "episode long, t long, q double, d double")
    got = {r.episode: r.jerk for r in sequences.mean_jerk(df, ["q", "d"], 0.5).collect()}
    assert got[1] is None and got[2] == pytest.approx(0) and got[3] == pytest.approx(8)


def test_gap_merge_at_its_limit(spark):
    points = spark.createDataFrame([(1, 0, 1.0), (1, 20, 5.0), (1, 41, 2.0)], "episode long, t long, value double")
    lengths = spark.createDataFrame([(1, 43)], "episode long, length long")
    got = rows(sequences.merge_gaps(points, 20, 5, lengths).select("from_t", "to_t", "worst"))
    assert got == [(0, 25, 5.0), (36, 42, 2.0)]


def test_bounds_need_ten_values(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("b", float(i)) for i in range(10)], "key string, x double")
    assert [r.key for r in sequences.deviation_bounds(df, "key", "x", 2.0).collect()] == ["b"]


def test_sigma_clip_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 400), [50.0, 500.0]])
    kept = x
    while True:
        m, s = kept.mean(), kept.std()
        inside = kept[(kept >= m - 3 * s) & (kept <= m + 3 * s)]
        if len(inside) == len(kept):
            break
        kept = inside
    df = spark.createDataFrame([("k", float(v)) for v in x], "key string, x double")
    got = sequences.sigma_clip(df, "key", "x", 3.0, checkpoint=Workspace(spark, "t").save).first()
    assert got.n == len(kept) and got["mean"] == pytest.approx(kept.mean()) and got["std"] == pytest.approx(kept.std())


def test_merged_statistics_are_those_of_the_whole(spark):
    df = spark.createDataFrame([(i % 3, float(i * i % 17)) for i in range(60)], "part int, value double")
    parts = df.groupBy("part").agg(*distributions.vector_stats("value")).withColumn("all", F.lit(1))
    merged = distributions.merged(parts, "all").first()
    whole = df.agg(*distributions.vector_stats("value")).first()
    for name in ("mean", "std", "min", "max", "count", "sum", "sum_sq"):
        assert merged[name] == pytest.approx(whole[name])


def test_merged_deviation_does_not_cancel(spark):
    df = spark.createDataFrame([(i % 4, 1e9 + i % 7) for i in range(280)] + [(9, None)], "part int, value double")
    parts = df.groupBy("part").agg(*distributions.vector_stats("value")).withColumn("all", F.lit(None).cast("string"))
    assert distributions.merged(parts, "all").first()["std"] == pytest.approx(2.0, rel=1e-7)


def test_quantiles_by_sketches_and_exactly(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    x = {"hot": np.round(rng.lognormal(0, 2, 20_000), 3), "same": np.full(5000, 3.0), "few": np.array([1.0, 2.0, 4.0]), None: rng.normal(0, 1, 700)}
    df = spark.createDataFrame([(g, float(v)) for g, own in x.items() for v in own] + [("few", None)], "g string, v double").repartition(6)
    probabilities = [0.0, 0.0025, 0.25, 0.5, 0.95, 0.9975, 1.0]
    for small in (10**6, 0):
        got = {(r.g, r.p): r.quantile for r in distributions.exact_quantiles(df, "g", "v", probabilities, Workspace(spark, "t"), small=small).collect()}
        assert got == pytest.approx({(g, p): float(np.quantile(own, p)) for g, own in x.items() for p in probabilities})
    files = distributions.file_sketches(df.withColumn("file", F.spark_partition_id()), "v", "g", "file", distinct="v")
    for r in distributions.merged_sketches(files, "g").select("g", "count", distributions.sketched_quantile(0.95).alias("q"), F.hll_sketch_estimate("distincts").alias("n")).collect():
        own = x[r.g]
        assert r["count"] == len(own) and abs(r.n - len(set(own))) <= 0.05 * len(set(own)) + 1
        assert (own < r.q).mean() - distributions.SKETCH_ERROR <= 0.95 <= (own <= r.q).mean() + distributions.SKETCH_ERROR


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (10.0,), (10.01,), (None,)], "x double")
    assert dict(rows(distributions.histogram(df, "x", 0.0, 10.0, 10))) == {0: 2, 1: 1, 9: 1, -1: 1}


def test_credible_intervals(spark):
    df = spark.createDataFrame([(0, 0), (0, 4), (4, 4), (3, 10)], "s long, n long")
    got = {(r.s, r.n): (r.ci_low, r.ci_high) for r in numeric.credible_interval(df, "s", "n").collect()}
    assert got[0, 0] == (0.0, 0.0)
    assert got[0, 4][0] == pytest.approx(100 * (1 - 0.975 ** (1 / 5))) and got[0, 4][1] == pytest.approx(100 * (1 - 0.025 ** (1 / 5)))
    assert got[4, 4][0] == pytest.approx(100 * 0.025 ** (1 / 5))
    low, high = got[3, 10]
    assert numeric.beta_cdf(low / 100, 4, 8) == pytest.approx(0.025) and numeric.beta_cdf(high / 100, 4, 8) == pytest.approx(0.975)


def test_credible_intervals_of_any_count(spark):
    def binomial_tail(x, a, b):
        n = a + b - 1
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(x) + (n - k) * math.log1p(-x)) for k in range(a, n + 1))

    rng = random.Random(3)
    for _ in range(60):
        a, b = rng.randrange(1, 300), rng.randrange(1, 300)
        x = min(max(rng.gauss(a / (a + b), 0.03), 1e-3), 1 - 1e-3)
        assert float(numeric.beta_cdf(x, a, b)) == pytest.approx(binomial_tail(x, a, b), abs=1e-10)
    for n, s in ((10**9, 5 * 10**8), (10**9, 0), (10**9, 10**9), (10**9, 7), (10**6, 999_990), (1, 1)):
        for p in (0.025, 0.5, 0.975):
            x = numeric.beta_quantile(p, 1 + s, 1 + n - s)
            ulp = math.exp(float(numeric._beta_log_density(x, 1.0 + s, 1.0 + n - s))) * 2e-15  # x itself is a double
            assert float(numeric.beta_cdf(x, 1 + s, 1 + n - s)) == pytest.approx(p, abs=1e-9 + ulp)
    assert float(numeric.beta_quantile(0.975, 1, 1 + 10**9)) == pytest.approx(-math.expm1(math.log(0.025) / (10**9 + 1)), rel=1e-9)
    middle = numeric.beta_quantile(0.975, 1 + 5 * 10**8, 1 + 5 * 10**8)
    assert float(middle) == pytest.approx(0.5 + 1.959963984540054 * 0.5 / math.sqrt(10**9 + 3), abs=1e-9)
    df = spark.createDataFrame([(None, 3), (2, None), (500, 1000)], "s long, n long")
    got = {(r.s, r.n): (r.ci_low, r.ci_high) for r in numeric.credible_interval(df, "s", "n").collect()}
    assert got[None, 3] == got[2, None] == (None, None) and got[500, 1000][0] == pytest.approx(46.906, abs=1e-2)


def plain_box(ring):
    """Smallest rectangle by turning all corners along every edge."""
    best = math.inf
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        t = math.atan2(by - ay, bx - ax)
        u = [x * math.cos(t) + y * math.sin(t) for x, y in ring]
        v = [y * math.cos(t) - x * math.sin(t) for x, y in ring]
        best = min(best, (max(u) - min(u)) * (max(v) - min(v)))
    return best


def test_smallest_boxes_keep_every_corner(spark):
    rng = random.Random(9)
    ring = [(0.4 * math.cos(2 * math.pi * i / 40), 0.4 * math.sin(2 * math.pi * i / 40)) for i in range(40)]
    sets = {"ring": ring, "line": [(float(i), 2.0 * i) for i in range(9)], "one": [(1.0, 1.0)] * 3}
    for n in range(12):
        sets[f"r{n}"] = [(rng.gauss(0, 3), rng.gauss(n, 1)) for _ in range(rng.randrange(3, 200))]
    sets["grid"] = [(float(i % 7), float(i // 7)) for i in range(49)]
    rows_ = [(g, *p) for g, points in sets.items() for p in points] + [("ring", None, 1.0), (None, 0.0, 0.0), (None, 1.0, 0.0), (None, 0.0, 1.0)]
    rng.shuffle(rows_)
    got = {r.g: r for r in numeric.smallest_boxes(spark.createDataFrame(rows_, "g string, x double, y double").repartition(7), "g", "x", "y").collect()}
    assert got["ring"].corners == 40 and got["ring"].area == pytest.approx(plain_box(ring))
    assert got["line"].area == 0 and got["one"].area == 0 and got["grid"].area == pytest.approx(36) and got["grid"].corners == 4
    assert got[None].area == pytest.approx(1) and got[None].corners == 3
    for n in range(12):
        corners = [tuple(p) for p in numeric.hull(__import__("numpy").array(sets[f"r{n}"]))]
        assert got[f"r{n}"].corners == len(corners) and got[f"r{n}"].area == pytest.approx(plain_box(corners))


def test_smallest_box_of_a_turned_square(spark):
    square = [(0.0, 10.0), (10.0, 0.0), (20.0, 10.0), (10.0, 20.0), (10.0, 10.0)]
    df = spark.createDataFrame([("a", *p) for p in square], "g string, x double, y double")
    got = numeric.smallest_boxes(df, "g", "x", "y").first()
    assert got.area == pytest.approx(200) and got.corners == 4


def test_balanced_sample_repeats_no_pair_while_others_remain(spark):
    rng = random.Random(1)
    data = [(i, f"h{rng.randrange(4)}", f"c{rng.randrange(3)}", rng.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, house string, category string, instance long")
    pairs = df.select("house", "instance").distinct().count()
    got = sampling.balanced(df, "house", "category", "instance", pairs).toPandas()
    assert len(got) == pairs and len(got[["house", "instance"]].drop_duplicates()) == pairs
    again = sampling.balanced(df.repartition(7), "house", "category", "instance", pairs).toPandas()
    assert got.sort_values("picked")["id"].tolist() == again.sort_values("picked")["id"].tolist()
    counts = got["category"].value_counts()
    assert counts.max() - counts.min() <= pairs // 3


def test_balanced_sample_against_plain_greedy(spark):
    rng = random.Random(5)
    assert_plain_greedy(spark, [(i, f"h{rng.randrange(3)}", rng.choice(["c1", "c2", None]), rng.randrange(9)) for i in range(150)], 25)
    # more houses and classes than the bounds leave
    assert_plain_greedy(spark, [(i, f"h{rng.randrange(60)}", rng.choice(["c1", "c2"]), rng.randrange(40)) for i in range(900)], 5)
    assert_plain_greedy(spark, [(i, f"h{rng.randrange(2)}", "c", rng.randrange(300)) for i in range(700)], 6)


def assert_plain_greedy(spark, data, size):
    import hashlib

    got = sampling.balanced(spark.createDataFrame(data, "id long, house string, category string, instance long"), "house", "category", "instance", size).toPandas()
    tie = {r: hashlib.md5("|".join(["b", *[str(x) for x in (r[2], r[1], r[0], r[3]) if x is not None]]).encode()).hexdigest() for r in data}
    chosen, left = [], list(data)
    while len(chosen) < size:
        n = max(1, len(chosen))

        def score(r):
            same = [sum(c[k] == r[k] for c in chosen) for k in (1, 2, 3)]
            pair = any(c[1] == r[1] and c[3] == r[3] for c in chosen)
            return (1000 * pair + (100 * same[1] + 10 * same[0] + same[2]) / n, tie[r])  # noqa: B023

        chosen.append(min(left, key=score))
        left.remove(chosen[-1])
    assert got.sort_values("picked")["id"].tolist() == [r[0] for r in chosen]


def test_farthest_points(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 10.0), ("a", 4, 6.0)], "g string, id long, x double")
    got = sampling.farthest_points(df, "g", "id", ["x"], 3, Workspace(spark, "t")).orderBy("picked").collect()
    assert [r.id for r in got] == [1, 3, 4]


def test_quota_remainder_and_small_groups(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 0)] + [("c", i) for i in range(5)], "g string, i long")
    got = sampling.quota(df, "g", ["i"], 7).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in got} == {"a": 3, "b": 1, "c": 2}


def test_closure_with_diamond_and_cycle(spark):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "a"), ("x", "y"), ("y", "x")], "child string, parent string")
    got = {(r.node, r.ancestor): r.distance for r in graphs.closure(edges, Workspace(spark, "t")).collect()}
    assert got == {("d", "b"): 1, ("d", "c"): 1, ("b", "a"): 1, ("c", "a"): 1, ("d", "a"): 2, ("x", "y"): 1, ("y", "x"): 1}


def test_path_search(spark):
    free = [(r, c) for r in range(5) for c in range(5) if not (c == 2 and r < 4)]
    df = spark.createDataFrame([("m", r, c, 1.0) for r, c in free] + [("n", 0, 0, 1.0), ("n", 4, 4, 1.0)], "map string, r int, c int, cost double")
    got = {r.map: (r.reached, r.cost, r.steps) for r in graphs.shortest_paths(df, (0, 0), (0, 4)).collect()}
    assert got["m"] == (True, 12.0, 12) and got["n"][0] is False


def plain_costs(cost, start):
    best, todo = {start: 0.0}, [start]
    while todo:
        at = todo.pop(0)
        for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1)):
            to = (at[0] + i, at[1] + j)
            if to in cost and best[at] + max(cost[at], cost[to]) < best.get(to, math.inf):
                best[to] = best[at] + max(cost[at], cost[to])
                todo.append(to)
    return best


def test_paths_over_tiles_cost_what_a_plain_search_finds(spark):
    rng = random.Random(12)
    maps = {
        "open": {(r, c): float(rng.randrange(1, 9)) for r in range(40) for c in range(40)},
        "maze": {(r, c): 1.0 for r in range(40) for c in range(40) if r % 4 != 2 or c == (39 if r % 8 == 2 else 0)},
        "cut": {(r, c): 1.0 for r in range(40) for c in range(40) if r != 20},
    }
    rows_ = [(m, r, c, w) for m, cost in maps.items() for (r, c), w in cost.items()] + [("lost", 5, 5, 1.0)]
    df = spark.createDataFrame(rows_, "map string, r int, c int, cost double")
    found = graphs.long_paths(df, (0, 0), (39, 37), Workspace(spark, "t"), tile=8)
    paths = {}
    for x in found.orderBy("map", "place").collect():
        paths.setdefault(x.map, []).append((x.place, (x.r, x.c), x.spent))
    assert paths.keys() == {"open", "maze"}
    for m, path in paths.items():
        assert [p for p, _, _ in path] == list(range(len(path))) and path[0][1:] == ((0, 0), 0.0) and path[-1][1] == (39, 37)
        spent = 0.0
        for (_, a, _), (_, b, s) in zip(path, path[1:], strict=False):
            assert abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1
            spent += max(maps[m][a], maps[m][b])
            assert s == pytest.approx(spent)
        assert spent == pytest.approx(plain_costs(maps[m], (0, 0))[39, 37])
    one = graphs.long_paths(df.where("map = 'lost'"), (5, 5), (5, 5), Workspace(spark, "t"), tile=8).collect()
    assert [(x.map, x.place, x.r, x.c, x.spent) for x in one] == [("lost", 0, 5, 5, 0.0)]


def test_ranks_and_firsts_do_not_need_a_whole_group(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot"] * 8 + ["b", None]), i, rng.random() < 0.4) for i in range(400)]
    df = spark.createDataFrame(data, "g string, i long, front boolean").repartition(5)
    groups = {g: sorted(i for h, i, _ in data if h == g) for g in {x[0] for x in data}}
    got = {r.i: r.round for r in sequences.group_rank(df, "g", ["i"], Workspace(spark, "t")).collect()}
    assert got == {i: n + 1 for own in groups.values() for n, i in enumerate(own)}
    places = {r.i: r.place for r in sampling.interleave(df, "g", ["i"], Workspace(spark, "t")).collect()}
    key = lambda x: (got[x[1]], x[0] is not None, x[0] or "")
    assert places == {x[1]: n + 1 for n, x in enumerate(sorted(data, key=key))}

    from weft.operators import candidates

    picked = {(r.g, r.i, r.whole) for r in candidates.by_index(df, "g", "i", 3, 60).collect()}
    assert picked == {(g, i, len(own) > 60) for g, own in groups.items() for i in own[3:61]}
    taken = candidates.two_quotas(df, "g", "front", [F.col("i")], 50, 20).collect()
    for g in groups:
        front, back = ([i for h, i, f in data if h == g and f == side] for side in (True, False))
        share = min(20, len(back))
        assert sorted(r.i for r in taken if r.g == g) == sorted(sorted(front)[: 50 - share] + sorted(back)[:share])
    plan = candidates.by_index(df, "g", "i", 3, 60)._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan


def test_closure_of_a_long_chain_takes_few_rounds(spark):
    import os

    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(0, 5), (7, 7)], "child long, parent long")
    place = Workspace(spark, "t")
    got = {(r.node, r.ancestor): r.distance for r in graphs.closure(chain, place).collect()}
    assert got == {(i, j): j - i - (4 if i == 0 and j >= 5 else 0) for i in range(41) for j in range(i + 1, 41)}
    assert len([x for x in os.listdir(place.root.removeprefix("file://")) if "-new-" in x]) <= 8


def test_distances_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(graphs, "COLUMN_BLOCK", 7)
    rng = random.Random(4)
    for rows_, columns, share in ((30, 9, 0.05), (6, 40, 0.02), (12, 12, 0.5), (25, 3, 0.01)):
        cells = [(r - 4, c + 2) for r in range(rows_) for c in range(columns)]
        blocked = {x for x in cells if rng.random() < share} | {cells[5]}
        free = [x for x in cells if x not in blocked]
        make = lambda some: spark.createDataFrame(list(some), "r int, c int")
        got = {(x.r, x.c): x.distance for x in graphs.distances(make(free), make(blocked)).collect()}
        assert got == pytest.approx({p: min(math.dist(p, q) for q in blocked) for p in free})
        assert {x.distance for x in graphs.distances(make(free), make(blocked).limit(0)).collect()} == {None}
    assert graphs.distances(make([]), make(blocked)).collect() == []


def test_boxes_include_their_borders(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 10.0), (3, 10.1, 10.0), (4, -5.0, 0.0)], "p long, px double, py double")
    boxes = spark.createDataFrame([(7, 0.0, 10.0, 0.0, 10.0)], "b long, x0 double, x1 double, y0 double, y1 double")
    assert rows(relations.points_in_boxes(points, boxes, 3.0).select("p", "b")) == [(1, 7), (2, 7)]


def test_as_of_with_ties_and_gaps(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5)], "k string, at long")
    right = spark.createDataFrame([("a", 2, 20.0), ("a", 5, 50.0), ("b", 6, 60.0)], "k string, at long, v double")
    assert rows(relations.as_of(left, right, "k", "at", "v").select("k", "at", F.coalesce("v", F.lit(-1.0)))) == [("a", 1, -1.0), ("a", 5, 50.0), ("b", 5, -1.0)]


def test_names(spark):
    df = spark.createDataFrame([("obja_0a_1_0_2",), ("mug_1",), ("123",), ("Éclair_9_x",)], "n string")
    n = F.col("n")
    got = df.select(text.first_word(n), text.category(n), text.model_instance(n), text.object_hash(n)).collect()
    assert [tuple(r) for r in got] == [("obja", "obja", "obja_0a", "0a"), ("mug", "mug", "mug", None), ("unknown", "123", "123", None), ("Éclair", "Éclair", "Éclair", None)]


def test_depth_codec_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.55,), (0.049,), (0.551,), (0.0,), (0.3,)], "m double")
    high, low = geometry.depth_channels(geometry.depth_code(F.col("m")))
    got = [r[0] for r in df.select(geometry.depth_metres(high, low)).collect()]
    for value, back in zip((0.05, 0.55, 0.0, 0.0, 0.0, 0.3), got, strict=True):
        assert back == pytest.approx(value, abs=1e-5)


def test_polygon_edges_are_inside(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (2.0, 2.0), (3.0, 1.0)], "x double, y double")
    inside = geometry.inside_polygon(F.col("x"), F.col("y"), [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])
    assert [r[0] for r in df.select(inside).collect()] == [True, True, True, True, False]


def test_angles_wrap(spark):
    df = spark.createDataFrame([(math.pi,), (-math.pi,), (3 * math.pi,), (0.5,)], "a double")
    got = [r[0] for r in df.select(geometry.wrap_angle(F.col("a"))).collect()]
    assert got == pytest.approx([-math.pi, -math.pi, -math.pi, 0.5])


def test_lines_and_pending_work(spark):
    work = Workspace(spark, "t")
    spark.createDataFrame([("a # x",), ("# only",), ("",), (" b ",)], "value string").coalesce(1).write.text(work.path("l"))
    assert rows(files.lines(spark, work.path("l"))) == [("a",), ("b",)]
    wanted = spark.createDataFrame([(1,), (2,)], "i int")
    assert rows(files.pending(wanted, wanted.where("i = 1"), "i")) == [(2,)]


def test_leaves_of_a_trajectory():
    import numpy as np

    tree = {"actions": {"arm": np.array([[1.0, 2.0], [3.0, 4.0]])}, "obs": {"q": np.array([list(b'{"a":1}\0\0')], np.uint8)}, "success": np.array([False, True])}
    got = list(trajectory_files.leaves(tree, "f", 3))
    assert got[0] == ("f", 3, 0, "actions/arm", "[1.0, 2.0]") and got[2] == ("f", 3, 0, "obs/q", '{"a":1}') and got[4] == ("f", 3, 1, "success", "true")


def test_trajectory_reader_on_a_file(tmp_path, monkeypatch):
    """The data source's reader over an h5-like file: a module that opens nested mappings written to disk."""
    import pickle
    import sys
    import types

    import numpy as np

    def steps_of(n):
        return {"actions": {"arm": np.arange(2.0 * n).reshape(n, 2)}, "rewards": np.linspace(0, 1, n), "success": np.arange(n) == n - 1, "obs_scene": np.array(b'{"object_name": "cup"}')}

    for name, tree in (("a.h5", {"traj_0": steps_of(3), "traj_10": steps_of(2), "stats": {}}), ("b.h5", {"traj_2": steps_of(4)})):
        (tmp_path / name).write_bytes(pickle.dumps(tree))

    class File(dict):
        def __init__(self, path, mode):
            super().__init__(pickle.loads(open(path, "rb").read()))

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

    monkeypatch.setitem(sys.modules, "h5py", types.SimpleNamespace(File=File))
    reader = trajectory_files.TrajectoryReader({"paths": f"{tmp_path}/a.h5,{tmp_path}/b.h5"})
    parts = reader.partitions()
    rows_ = [r for p in parts for r in reader.read(p)]
    assert len(parts) == 2 and {(r[0][-4:], r[1]) for r in rows_} == {("a.h5", 0), ("a.h5", 10), ("b.h5", 2)}
    assert [r[4] for r in rows_ if r[:2] == (f"{tmp_path}/b.h5", 2) and r[3] == "success"] == ["false", "false", "false", "true"]
    assert [r[4] for r in rows_ if r[3] == "obs_scene"] == ['{"object_name": "cup"}'] * 3


def test_trajectory_files_are_written_and_read(spark):
    from weft.sources import trajectory_files as tf

    scene = '{"object_name": "cup", "task_description": "pick it"}'
    data = [("f", "traj_0/success", "json", ["false", "true"]), ("f", "traj_0/obs/agent/qpos", "text", ['{"arm":[1]}', '{"arm":[1,22.5]}']), ("f", "traj_0/obs_scene", "scalar", [scene]),
            ("f", "traj_10/success", "json", []), ("f", "traj_10/obs/agent/qpos", "text", []), ("g", "traj_2/success", "json", ["true"]), ("g", "traj_2/obs_scene", "scalar", ["é"])]
    root = Workspace(spark, "t").path("files")
    tf.write_trajectories(spark.createDataFrame(data, "file string, name string, kind string, texts array<string>"), root)
    found = tf.read_trajectories(spark, root).withColumn("f", F.regexp_extract("h5_file", r"(\w)\.npz$", 1))
    assert sorted(map(tuple, found.select("f", "traj_idx", "t", "key", "value").collect())) == [
        ("f", 0, -1, "obs_scene", scene), ("f", 0, 0, "obs/agent/qpos", '{"arm":[1]}'), ("f", 0, 0, "success", "false"),
        ("f", 0, 1, "obs/agent/qpos", '{"arm":[1,22.5]}'), ("f", 0, 1, "success", "true"), ("g", 2, -1, "obs_scene", "é"), ("g", 2, 0, "success", "true"),
    ]
    episodes = {(r.traj_idx, r.n_steps, r.success, r.object_name) for r in tf.episode_rows(tf.read_trajectories(spark, root)).collect()}
    assert episodes == {(0, 2, True, "cup"), (2, 1, True, None)}
    spark.dataSource.register(tf.TrajectoryFiles)
    with pytest.raises(Exception, match="h5py"):
        spark.read.format("trajectories").option("paths", "a.h5").load().count()


def test_trajectory_rows_to_episodes(spark):
    rows_ = [("f", 0, t, "rewards", str(0.5 * t)) for t in range(3)] + [("f", 0, t, "success", "true" if t else "false") for t in range(3)]
    rows_ += [("f", 0, -1, "obs_scene", '{"object_name": "cup_1", "task_description": "pick"}'), ("f", 1, 0, "success", "false")]
    df = spark.createDataFrame(rows_, trajectory_files.SCHEMA)
    got = {r.traj_idx: tuple(r)[2:] for r in trajectory_files.episode_rows(df).collect()}
    assert got == {0: (3, 1, True, "cup_1", "pick"), 1: (1, 0, False, None, None)}


def test_errors_of_reports_and_types(spark):
    from weft.operators import candidates, reports

    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    assert rows(reports.paired(a, a, "k", "v").select("k", "ratio")) == [("x", 1.0), ("y", 1.0)]
    with pytest.raises(Exception, match="no k y in the second"):
        reports.paired(a, a.where("k = 'x'"), "k", "v").collect()
    df = spark.createDataFrame([("given", "c"), (None, "known"), (None, "odd")], "t string, cls string")
    kind = candidates.inferred(F.col("t"), F.col("cls"), {"known": "pick"})
    assert [r[0] for r in df.where("cls <> 'odd'").select(kind).collect()] == ["given", "pick"]
    with pytest.raises(Exception, match="no type for class odd"):
        df.select(kind.alias("t")).collect()
    with pytest.raises(ValueError, match="no range"):
        candidates.by_index(a, "k", "v", 3, 2)


def test_type_lists_and_splits(spark):
    from weft.operators import candidates

    df = spark.createDataFrame([(["a", "b"], None), (["c"], "val")], "kinds array<string>, split string")
    for wanted, want in ((None, [False, False]), ([], [True, True]), (["b"], [True, False])):
        assert [r[0] for r in df.select(candidates.has_type(F.col("kinds"), wanted)).collect()] == want
    got = {w: [r[0] for r in df.select(candidates.admitted(F.col("split"), F.lit(w))).collect()] for w in ("test", "train", "val", "other")}
    assert got == {"test": [True, False], "train": [False, False], "val": [None, True], "other": [True, True]} or got["val"] == [False, True]


def test_clusters_and_their_fallback(spark):
    from weft.operators import candidates

    data = [(i, float(i % 2) * 100 + i * 0.01, 5.0) for i in range(40)]
    df = spark.createDataFrame(data, "id long, x double, y double")
    got = {r.id: r.cluster for r in candidates.clusters(df, "id", ["x", "y"], 2, Workspace(spark, "t")).collect()}
    assert {got[i] for i in range(0, 40, 2)} == {0} and {got[i] for i in range(1, 40, 2)} == {1}
    for bad in (None, float("nan"), float("inf")):
        broken = df.withColumn("x", F.when(F.col("id") != 3, F.col("x")).otherwise(F.lit(bad).cast("double"))).repartition(5)
        assert {r.id: r.cluster for r in candidates.clusters(broken, "id", ["x", "y"], 3, Workspace(spark, "t")).collect()} == {i: i % 3 for i in range(40)}
    assert candidates.clusters(df.limit(0), "id", ["x", "y"], 3, Workspace(spark, "t")).collect() == []


def test_path_is_simplified(spark):
    cost = {(r, c): 1.0 for r in range(6) for c in range(6)}
    path = [(0, c) for c in range(6)] + [(r, 5) for r in range(1, 6)]
    assert graphs.simplified(path, cost)[0] == (0, 0) and graphs.simplified(path, cost)[-1] == (5, 5) and len(graphs.simplified(path, cost)) < 4
    walled = {k: v for k, v in cost.items() if not (0 < k[0] < 5 and 0 < k[1] < 5)}
    assert graphs.simplified(path, walled) == [(0, 0), (0, 5), (5, 5)]
    assert graphs.simplified(path[:1], cost) == path[:1] and graphs.simplified([], cost) == []


def test_sigma_clip_goes_on_until_nothing_is_dropped(spark):
    df = spark.createDataFrame([("k", float(2**i)) for i in range(60)] + [("k", 0.0)] * 3, "key string, x double")
    got = sequences.sigma_clip(df, "key", "x", 1.0, checkpoint=Workspace(spark, "t").save).first()
    kept = sorted([float(2**i) for i in range(60)] + [0.0] * 3)
    while True:
        m = sum(kept) / len(kept)
        s = math.sqrt(sum((x - m) ** 2 for x in kept) / len(kept))
        inside = [x for x in kept if m - s <= x <= m + s]
        if len(inside) == len(kept):
            break
        kept = inside
    assert got.n == len(kept)


def test_staged_write_restores_what_a_crash_left(spark):
    path = Workspace(spark, "t").path("s")
    files.write_staged(spark.range(3), path)
    files.write_staged(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not files.exists(spark, f"{path}.old") and not files.exists(spark, f"{path}.staged")
    fs, _ = files.folder(spark, path)
    where = spark._jvm.org.apache.hadoop.fs.Path
    fs.rename(where(path), where(f"{path}.old"))  # as if the driver had died between the renames
    with pytest.raises(Exception, match="broken"):
        files.write_staged(spark.range(1).select(F.raise_error(F.lit("broken")).cast("string").alias("x")), path)
    assert spark.read.parquet(path).count() == 5


def test_report_keeps_any_text(spark):
    values = [("a,b", 'say "hi"', 1), ("# no comment", "two\nlines", 2), (None, "", 3), ("", None, None), (" x ", "\\", -1)]
    df = spark.createDataFrame(values, "p string, q string, n int")
    path = Workspace(spark, "t").path("report")
    files.write_report(df, path, ["first note", "second, with\na line feed"])
    assert sorted(map(tuple, files.read_report(spark, path, df.schema.simpleString()[7:-1].replace(":", " ")).collect()), key=repr) == sorted(values, key=repr)


def test_a_lock_is_only_let_go_by_its_holder(spark):
    import os
    import time

    path = Workspace(spark, "t").path("held")
    first = files.Locked(spark, path).__enter__()
    local = first.lock.toUri().getPath()
    os.utime(local, (time.time() - 100, time.time() - 100))
    first.renew()
    with pytest.raises(TimeoutError), files.Locked(spark, path, patience=0.3, stale=50):
        pass
    os.utime(local, (time.time() - 100, time.time() - 100))
    second = files.Locked(spark, path, patience=2, stale=50).__enter__()
    assert second.holder() == second.token
    first.__exit__()  # the lock is another's by now
    assert files.exists(spark, f"{path}.lock")
    with pytest.raises(RuntimeError):
        first.renew()
    second.__exit__()
    assert not files.exists(spark, f"{path}.lock")


def test_array_files_by_priority_with_pushed_objects(spark):
    from weft.sources import array_files

    root = Workspace(spark, "t").path("arrays")
    data = [("cup", "a", "npz", []), ("cup", "b", "json", [[1.0, 2.0], [3.0, 4.0]]), ("pan", "a", "npz", [[5.0, 6.0]]), ("pan", "b", "json", [[0.0, 0.0]]), ("mug", "b", "npz", [])]
    array_files.save_arrays(spark.createDataFrame(data, "object string, source string, kind string, value array<array<double>>"), root, "grasps")
    for pushed in ("true", "false"):
        spark.conf.set(array_files.PUSHDOWN, pushed)
        found = array_files.load_arrays(spark, root, ["a", "b", "none"], "grasps")
        best = array_files.first_source(found)
        assert sorted((r.object, r.source, r.place, tuple(r.value), r.n) for r in best.collect()) == [("cup", "b", 0, (1.0, 2.0), 2), ("cup", "b", 1, (3.0, 4.0), 2), ("pan", "a", 0, (5.0, 6.0), 1)]
        assert found.where("object IN ('cup', 'mug')").count() == 2 and found.where("object = 'none'").count() == 0
        one = [tuple(r.value) for r in array_files.drawn(best, 1, "s").where("object = 'cup'").collect()]
        assert one == [tuple(r.value) for r in array_files.drawn(best.repartition(3), 1, "s").where("object = 'cup'").collect()] and len(one) == 1
    options = {"path": root, "sources": "a,b", "member": "grasps"}
    reader = array_files.FilteredReader(options)
    left = list(reader.pushFilters([array_files.EqualTo(("object",), "pan"), array_files.EqualTo(("source",), "a")]))
    assert [f.attribute for f in left] == [("source",)]
    assert [f[1:3] for p in reader.partitions() for f in p.files] == [("pan", "a"), ("pan", "b")]
    assert len([f for p in array_files.ArrayReader(options).partitions() for f in p.files]) == 5


def test_buckets_join_without_a_shuffle(spark):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("x"))
    b = spark.range(1500).select((F.col("id") % 900).alias("j"), "id")
    place = Workspace(spark, "t")
    left, right = files.bucketed(a, place.path("a"), "k", 4), files.bucketed(b, place.path("b"), "j", 4)
    joined = left.join(right.hint("merge"), F.col("k") == F.col("j"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == a.join(b, F.col("k") == F.col("j")).count() == 1500


def test_lock_excludes_and_appends_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = Workspace(spark, "t").path("black")
    df = spark.createDataFrame([(i, "r") for i in range(5)], "uid long, reason string")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: files.append_absent(df, path, "uid"), range(4)))
    assert rows(spark.read.parquet(path).select("uid")) == [(i,) for i in range(5)]
    with files.Locked(spark, path), pytest.raises(TimeoutError), files.Locked(spark, path, patience=0.2):
        pass
    assert not files.exists(spark, f"{path}.lock")


def test_key_value_codec_and_iterator(spark):
    store = files.KeyValues(spark, Workspace(spark, "t").path("kv"), codec=files.json_codec("a int, b string"))
    store.put(spark.createDataFrame([(k, (k, "x" * k)) for k in range(4)], "key long, value struct<a:int,b:string>"))
    assert len(store) == 4 and 2 in store and 9 not in store and store.complete
    assert [tuple(r.value) for r in store.get(2).collect()] == [(2, "xx")] and store.stored().schema["value"].dataType.simpleString() == "string"
    assert sorted(r[0].a for r in store.values().collect()) == [0, 1, 2, 3]
    assert sorted(r.n for r in store.iterator(lambda fs: (f[["key"]].rename(columns={"key": "n"}) for f in fs), "n long").collect()) == [0, 1, 2, 3]


def test_jdbc_source_and_sink(spark):
    """The database that comes with Spark, in memory: tables go out and come back, with a filter that is pushed down."""
    url = "jdbc:derby:memory:weft;create=true"
    df = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id long, name string")
    files.to_jdbc(df, url, "assets", driver="org.apache.derby.jdbc.EmbeddedDriver", createTableColumnTypes="name VARCHAR(20)")
    back = files.from_jdbc(spark, url, "assets", driver="org.apache.derby.jdbc.EmbeddedDriver", column="id", low=0, high=9, parts=3)
    assert back.rdd.getNumPartitions() == 3 and rows(back.where("id > 7")) == [(8, "n8"), (9, "n9")]
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThan(ID,7)]" in back.where("id > 7")._jdf.queryExecution().toString() or "PushedFilters" in back.where("id > 7")._jdf.queryExecution().toString()


def test_mixtures_hooks_and_column_providers(spark):
    from weft.plans import registry

    mixture = registry.mixture("nation report", ["report_with_notes", "pass_summary"])
    assert set(mixture) == {"report_with_notes", "pass_summary"} and registry.mixtures()["nation report"] == ("report_with_notes", "pass_summary")
    with pytest.raises(ValueError, match="twice"):
        registry.mixture("nation report", [])
    with pytest.raises(KeyError):
        registry.mixture("odd", ["no such query"])

    class Counting(registry.Runner):
        seen: list = []

        def select(self, names):
            return [n for n in names if n != "pass_summary"]

        def after(self, name, df):
            self.seen.append(name)
            return df.limit(2)

        def failed(self, name, error):
            self.seen.append(f"{name}: {error}")

    def broken(spark, sf_dir):
        raise OSError("no table")

    out = Counting().run(spark, "/root/testdata/sf0.001", mixture | {"broken": broken})
    assert set(out) == {"report_with_notes"} and out["report_with_notes"].count() <= 2 and "broken: no table" in Counting.seen

    @registry.column("double_reward")
    def double_reward(df):
        return F.col("reward") * 2

    found = registry.with_columns(steps(spark, (1, [True])), "double_reward")
    assert found.first().double_reward == 2.0
    with pytest.raises(ValueError, match="twice"):
        registry.column("double_reward")(double_reward)


def test_extremes_name_the_smallest_key_of_equal_values(spark):
    data = [("a", 9, 5.0), ("a", 3, 5.0), ("a", 7, 1.0), ("a", 2, 1.0), ("a", 1, None), ("b", 4, None)]
    df = spark.createDataFrame(data, "g string, k long, v double")
    for parts in (1, 4):
        found = df.repartition(parts).groupBy("g").agg(distributions.key_at_most("v", "k").alias("most"), distributions.key_at_least("v", "k").alias("least"))
        assert rows(found) == [("a", 3, 2), ("b", None, None)]


def test_objects_beyond_the_list_are_read_in_slices(spark, monkeypatch):
    from weft.sources import array_files

    root = Workspace(spark, "t").path("arrays")
    data = [(f"o{i}", s, "npz", [[float(i)]]) for i in range(40) for s in ("a", "b") if s == "b" or i % 2]
    array_files.save_arrays(spark.createDataFrame(data, "object string, source string, kind string, value array<array<double>>"), root, "m")
    assert array_files.entries(*array_files.located(root), False) and not list(array_files.entries(*array_files.located(f"{root}/_written"), False))
    options = {"path": root, "sources": "a,b,none", "member": "m"}
    whole = [r for p in array_files.ArrayReader(options).partitions() for r in array_files.ArrayReader(options).read(p)]
    monkeypatch.setattr(array_files, "LISTED", 10)
    sliced = array_files.ArrayReader(options)
    parts = sliced.partitions()
    assert len(parts) == 3 * array_files.SLICES and not any(hasattr(p, "files") for p in parts)
    assert sorted(map(str, whole)) == sorted(str(r) for p in parts for r in sliced.read(p)) and len(whole) == 60


def test_folders_of_trajectories_are_read_in_slices_of_files(spark, tmp_path):
    from weft.sources import trajectory_files as tf

    members = [("traj_3/success", "json", ["true", "false"]), ("traj_3/obs/agent/qpos", "text", ["x" * 2000, "y"]), ("traj_3/obs_scene", "scalar", ["s"]), ("traj_3/reward", "json", ["0.5", "2"])]
    for i in range(30):
        (tmp_path / f"f{i}.npz").write_bytes(tf.written(members))
    reader = tf.TrajectoryReader({"root": str(tmp_path)})
    parts = reader.partitions()
    assert 1 < len(parts) < 30  # a partition for each file was 30
    got = [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    own = [(3, 0, "success", "true"), (3, 1, "success", "false"), (3, 0, "obs/agent/qpos", "x" * 2000), (3, 1, "obs/agent/qpos", "y"), (3, -1, "obs_scene", "s"), (3, 0, "reward", "0.5"), (3, 1, "reward", "2.0")]
    assert sorted(got) == sorted((f"{tmp_path}/f{i}.npz", *r) for i in range(30) for r in own)
    import numpy as np

    with np.load(tmp_path / "f0.npz") as found:  # numpy reads what is written
        assert found["traj_3/success"].tolist() == [True, False] and found["traj_3/obs_scene"].item() == "s"
    np.savez_compressed(tmp_path / "old.npz", **{"traj_1/q": np.asfortranarray(np.arange(6.0).reshape(2, 3))})
    assert [r[4] for r in tf._npz_rows(str(tmp_path / "old.npz"))] == ["[0.0, 1.0, 2.0]", "[3.0, 4.0, 5.0]"]


def test_trajectory_files_are_compressed_as_a_whole(spark, tmp_path):
    from weft.sources import trajectory_files as tf

    data = [("f", f"traj_{i}/{leaf}", kind, texts) for i in range(100) for leaf, kind, texts in (("success", "json", ["false", "true"]), ("obs/q", "text", [f"x{i}", "y" * (i * 30)]), ("obs_scene", "scalar", [f"s{i}"]))]
    members = spark.createDataFrame(data, "file string, name string, kind string, texts array<string>")
    tf.write_trajectories(members, f"{tmp_path}/plain")
    tf.write_trajectories(members, f"{tmp_path}/whole", compression="zstd")
    plain, whole = tmp_path / "plain" / "f.npz", tmp_path / "whole" / "f.npz.zst"
    assert whole.stat().st_size * 5 < plain.stat().st_size
    leaves = ["traj_idx", "t", "key", "value"]
    found = rows(tf.read_trajectories(spark, f"{tmp_path}/whole").select(leaves))
    assert found == rows(tf.read_trajectories(spark, f"{tmp_path}/plain").select(leaves)) and len(found) == 500
    assert rows(spark.read.format("trajectories").option("paths", str(whole)).load().select(leaves)) == found


def test_trajectories_are_dealt_once_and_parts_of_any_number_are_found(spark, tmp_path, monkeypatch):
    import duckdb

    from weft.plans import storage
    from weft.plans.registry import oracles
    from weft.sources import trajectory_files as tf

    data = "/root/testdata/sf0.001"
    spark.read.parquet(f"{data}/lineitem.parquet").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{data}/part.parquet").where("p_partkey % 5 <> 0").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")  # a part of some steps is not there
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    names = "file, traj_idx, n_steps, success, object_name, task_description, moved, open"  # steps of a file are numbered without those that have no part
    wanted = sorted(con.execute(f"SELECT {names} FROM ({oracles()['trajectory_files']})").fetchall())
    write, shuffles = tf.write_trajectories, []

    def counted(members, root, *dealt, **options):
        plan = members.groupBy("file", *dealt).count()._jdf.queryExecution().executedPlan().toString()
        shuffles.append(plan.count("Exchange hashpartitioning"))
        write(members, root, *dealt, **options)

    monkeypatch.setattr(tf, "write_trajectories", counted)
    for most in (storage.BROADCAST_PARTS, 0):
        monkeypatch.setattr(storage, "BROADCAST_PARTS", most)
        assert sorted(map(tuple, storage.trajectory_files(spark, str(tmp_path)).select(names.split(", ")).collect())) == wanted and len(wanted) > 1000
    assert shuffles == [1, 4]  # of many parts: lines, both sides of the join, steps; it was 2 and 5


def test_near_duplicates_of_dense_points(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([rng.uniform(-12, 12), float(rng.randint(-12, 12)), 3.0]), float(rng.randint(-9, 9))) for i in range(300)]
    data += [(1000, -1e-20, 50.0), (1001, 5.0, 50.0), (1002, None, 0.0), (1003, None, 0.0), (None, 3.0, 0.0)]
    whole = [p for p in data if None not in p]
    kept = {p for p in data if None in p or not any(p[0] < q[0] and abs(p[1] - q[1]) <= 5 and abs(p[2] - q[2]) <= 5 for q in whole)}
    found = relations.near_duplicates(spark.createDataFrame(data, "id long, x double, y double"), ["x", "y"], 5.0)
    assert {tuple(r) for r in found.collect()} == kept and (1000, -1e-20, 50.0) not in kept
    dense = spark.range(20000).select("id", (F.col("id") % 10 / 10).alias("x"), F.lit(0.0).alias("y"))  # 2e8 pairs, if all were compared
    assert [r.id for r in relations.near_duplicates(dense, ["x", "y"], 5.0).collect()] == [19999]


def test_blocks_are_scored_in_strips(spark, monkeypatch):
    from weft.operators import candidates

    rng = random.Random(3)
    vectors = [(i, [[rng.gauss(0, 1) for _ in range(4)] for _ in range(2)], [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)]
    v = spark.createDataFrame(vectors, "vec_id long, views array<array<double>>, text array<double>")
    q = v.select(F.col("vec_id").alias("query"), F.col("views")[0].alias("image"), "text")
    whole = rows(candidates.fused_top(q, v, 0.5, -9.0, 5))
    monkeypatch.setattr(candidates, "STRIP", 7)
    import pandas as pd

    sizes = []
    candidates._in_strips(pd.Series(range(30)), lambda names, at: pd.DataFrame({"n": [sizes.append(len(names)) or len(range(30)[at])]}))
    assert sizes == [7, 7, 7, 7, 2]
    assert rows(candidates.fused_top(q, v, 0.5, -9.0, 5)) == whole and len(whole) == 150


def test_components_of_a_grid_broadcast_nothing(spark):
    cells = spark.createDataFrame([(r, c, 1.0, r * 100 + c) for r in range(4) for c in range(3) if c != 1], "r int, c int, cost double, id long")
    assert "Broadcast" not in graphs.grid_edges(cells)._jdf.queryExecution().executedPlan().toString()
    found = graphs.grid_components(cells, Workspace(spark, "t"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found.groupBy("component").count()) == [(0, 4), (2, 4)]


def test_steps_have_more_partitions_the_more_rows(spark, monkeypatch):
    from weft.plans import standins

    lines = spark.range(100).select((F.col("id") % 17).alias("l_orderkey"))
    assert standins.by_episode(lines) is lines
    monkeypatch.setattr(standins, "STEP_ROWS", 10)
    assert standins.by_episode(lines).rdd.getNumPartitions() == 10


def test_best_of_buckets_is_the_best_of_the_key(spark):
    from weft.streaming import state

    data = [("a", b, i, 1.0, float(i % 5)) for b in range(3) for i in range(b, 12, 3)] + [("b", 0, 1, 1.0, 0.5)]
    found = rows(state.best_of_buckets(spark.createDataFrame(data, "key string, bucket int, item long, weight double, score double"), 3))
    assert found == [("a", 4, 1.0, 4.0), ("a", 8, 1.0, 3.0), ("a", 9, 1.0, 4.0), ("b", 1, 1.0, 0.5)]


def test_runs_of_plain_rows():
    from weft.streaming import state

    assert state._runs(2, 2, [True, False, True, True]) == (2, 3) and state._runs(1, 4, []) == (1, 4)
