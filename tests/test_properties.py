"""Properties that hold for any input, on generated values."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weft.functions import geometry, text
from weft.operators import graphs, sequences
from weft.workspace import Workspace

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@FEW
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=20))
def test_wrapped_angles_are_the_same_direction(spark, angles):
    df = spark.createDataFrame([(a,) for a in angles], "a double")
    for a, w in df.select("a", geometry.wrap_angle(F.col("a"))).collect():
        assert -math.pi - 1e-9 <= w < math.pi + 1e-9 and math.isclose(math.cos(a), math.cos(w), abs_tol=1e-9)


@FEW
@given(st.lists(st.floats(0.05, 0.55), min_size=1, max_size=20))
def test_depth_codes_lose_less_than_a_step(spark, metres):
    df = spark.createDataFrame([(m,) for m in metres], "m double")
    high, low = geometry.depth_channels(geometry.depth_code(F.col("m")))
    for m, back in df.select("m", geometry.depth_metres(high, low)).collect():
        assert abs(m - back) <= 0.5 / 65534 + 1e-12


@FEW
@given(st.lists(st.from_regex(r"[a-c]{0,3}[0-9]{1,6}[a-c]{0,2}", fullmatch=True), min_size=2, max_size=12, unique=True))
def test_natural_keys_order_numbers_as_numbers(spark, names):
    def key(name):
        return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", name)]

    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(text.natural_key(F.col("n")), "n").collect()]
    assert [key(x) for x in got] == sorted(map(key, names))


@FEW
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=15))
def test_closure_is_reachability(spark, pairs):
    edges = spark.createDataFrame(pairs, "child long, parent long")
    got = {(r.node, r.ancestor) for r in graphs.closure(edges, Workspace(spark, "t")).collect()}
    want = {(a, b) for a, b in pairs if a != b}
    while True:
        more = {(a, d) for a, b in want for c, d in want if b == c and a != d} - want
        if not more:
            break
        want |= more
    assert got == want


@FEW
@given(st.lists(st.integers(0, 200), min_size=1, max_size=25, unique=True), st.integers(1, 30))
def test_segments_cover_their_points_and_keep_apart(spark, places, gap):
    points = spark.createDataFrame([(1, t, float(t)) for t in places], "episode long, t long, value double")
    lengths = spark.createDataFrame([(1, 201)], "episode long, length long")
    found = sorted((r.from_t, r.to_t, r.points) for r in sequences.merge_gaps(points, gap, 0, lengths).collect())
    assert sum(n for *_, n in found) == len(places)
    assert all(b[0] - a[1] > gap for a, b in zip(found, found[1:], strict=False))
