"""Numbers that need an algorithm: credible intervals, rigid transforms, bounding boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


#: Panels and nodes of the quadrature; a distribution is cut off so many deviations from its mean.
PANELS, NODES, SPREAD = 32, 16, 40.0


def _stirling_rest(n: np.ndarray) -> np.ndarray:
    """log gamma(n) minus Stirling's formula (n - 1/2) log n - n + log(2 pi) / 2, for whole n."""
    k = np.arange(1, 16)
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 15)))]) - ((k - 0.5) * np.log(k) - k + 0.5 * np.log(2 * np.pi))
    x = np.maximum(n, 16).astype(float)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return np.where(n < 16, small[np.minimum(n, 15).astype(int) - 1], series)


def _beta_log_density(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log density of Beta(a, b); large parts cancel before they are added."""
    n = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        log_x, log_y = np.log(x), np.log1p(-x)
        off = (x - a / n) * n
        near = [np.where(np.abs(t) < 0.5, np.log1p(t), far) for t, far in ((off / a, np.log(x * n / a)), (-off / b, np.log((1 - x) * n / b)))]
        main = a * near[0] + b * near[1]
        rest = _stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b) + 0.5 * (np.log(a) + np.log(b) - np.log(n) - np.log(2 * np.pi))
        return np.where((x > 0) & (x < 1), main + rest - log_x - log_y, -np.inf)


def beta_cdf(x, a, b) -> np.ndarray:
    """P(X <= x) of Beta(a, b) for whole a, b >= 1, over whole columns: the incomplete beta function as an integral.

    The density is smooth, so Gauss's rule on PANELS equal panels is exact to rounding; memory does not depend on a and b. The
    integral runs from x away from the mean, to where nothing is left.
    """
    x, a, b = (np.asarray(v, float)[..., None, None] for v in np.broadcast_arrays(x, a, b))
    mean = a / (a + b)
    reach = SPREAD * np.sqrt(a * b / (a + b + 1)) / (a + b)
    low = x <= mean
    inner = np.clip(x, 0.0, 1.0)
    outer = np.where(low, np.maximum(0.0, np.minimum(mean - reach, x)), np.minimum(1.0, np.maximum(mean + reach, x)))
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    width = (inner - outer) / PANELS
    at = outer + width * (np.arange(PANELS)[:, None] + (nodes + 1) / 2)
    area = (np.exp(_beta_log_density(at, a, b)) * weights).sum((-1, -2)) * (width / 2)[..., 0, 0]
    below = np.where(low[..., 0, 0], area, 1 + area)
    x = x[..., 0, 0]
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.clip(below, 0.0, 1.0)))


def beta_quantile(p: float, a, b) -> np.ndarray:
    """x with P(X <= x) = p, over whole columns: Newton's steps inside a bracket that each of them narrows."""
    a, b = np.broadcast_arrays(np.asarray(a, np.int64), np.asarray(b, np.int64))
    low, high = np.zeros(a.shape), np.ones(a.shape)
    x = a / (a + b)
    for _ in range(80):
        off = beta_cdf(x, a, b) - p
        low, high = np.where(off < 0, x, low), np.where(off < 0, high, x)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            step = x - off / np.exp(_beta_log_density(x, a, b))
        to = np.where((step > low) & (step < high), step, (low + high) / 2)
        still = np.abs(to - x) > 1e-15 * np.maximum(x, 1e-300)
        x = to
        if not still.any():
            break
    return x


def credible_interval(df: DataFrame, successes: str, total: str, alpha: float = 0.05) -> DataFrame:
    """df with ci_low and ci_high in percent: quantiles of Beta(1 + s, 1 + n - s); (0, 0) for n = 0, null for a null."""
    schema = StructType([*df.schema.fields, StructField("ci_low", DoubleType()), StructField("ci_high", DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            s, n = frame[successes].to_numpy(float), frame[total].to_numpy(float)
            known = np.flatnonzero(~np.isnan(s) & ~np.isnan(n) & (n > 0))
            ends = {name: np.where(n == 0, 0.0, np.nan) for name in ("ci_low", "ci_high")}
            for at in range(0, len(known), 1024):  # a node for each panel and row is in memory
                own = known[at : at + 1024]
                for name, p in (("ci_low", alpha / 2), ("ci_high", 1 - alpha / 2)):
                    ends[name][own] = 100 * beta_quantile(p, 1 + s[own].astype(np.int64), 1 + (n - s)[own].astype(np.int64))
            yield frame.assign(**{name: pd.Series(v, index=frame.index, dtype="Float64").mask(np.isnan(v)) for name, v in ends.items()})

    return df.mapInPandas(run, schema)


def pose_matrix(pose: Column) -> Column:
    """Row-major 4 x 4 matrix of a pose [x, y, z, qw, qx, qy, qz] with a unit quaternion."""
    x, y, z, w, a, b, c = (F.get(pose, F.lit(i)) for i in range(7))
    return F.array(
        1 - 2 * (b * b + c * c), 2 * (a * b - w * c), 2 * (a * c + w * b), x,
        2 * (a * b + w * c), 1 - 2 * (a * a + c * c), 2 * (b * c - w * a), y,
        2 * (a * c - w * b), 2 * (b * c + w * a), 1 - 2 * (a * a + b * b), z,
        F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0),
    )


def compose(m: Column, n: Column) -> Column:
    """Product of two row-major 4 x 4 matrices."""
    at = lambda q, i: F.get(q, F.lit(i))
    return F.array(*[sum((at(m, 4 * i + k) * at(n, 4 * k + j) for k in range(4)), F.lit(0.0)) for i in range(4) for j in range(4)])


def inverse(m: Column) -> Column:
    """Inverse of a rigid transform: the transposed rotation, and the translation turned back."""
    at = lambda i: F.get(m, F.lit(i))
    move = [-(at(i) * at(3) + at(4 + i) * at(7) + at(8 + i) * at(11)) for i in range(3)]
    return F.array(at(0), at(4), at(8), move[0], at(1), at(5), at(9), move[1], at(2), at(6), at(10), move[2], *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def rotation_angle(m: Column) -> Column:
    """Length of the rotation's logarithm."""
    trace = F.get(m, F.lit(0)) + F.get(m, F.lit(5)) + F.get(m, F.lit(10))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2)))


def rotation_log(m: Column) -> Column:
    """Rotation vector (axis times angle) of a matrix whose rotation is less than half a turn."""
    at = lambda i: F.get(m, F.lit(i))
    angle = rotation_angle(m)
    scale = F.when(angle < 1e-6, F.lit(0.5)).otherwise(angle / (2 * F.sin(angle)))
    return F.array(scale * (at(9) - at(6)), scale * (at(2) - at(8)), scale * (at(4) - at(1)))


def rotation_exp(v: Column) -> Column:
    """Row-major 3 x 3 rotation of a rotation vector (Rodrigues)."""
    x, y, z = (F.get(v, F.lit(i)) for i in range(3))
    angle = F.sqrt(x * x + y * y + z * z)
    a = F.when(angle < 1e-6, F.lit(1.0)).otherwise(F.sin(angle) / angle)
    b = F.when(angle < 1e-6, F.lit(0.5)).otherwise((1 - F.cos(angle)) / (angle * angle))
    return F.array(
        1 - b * (y * y + z * z), b * x * y - a * z, b * x * z + a * y,
        b * x * y + a * z, 1 - b * (x * x + z * z), b * y * z - a * x,
        b * x * z - a * y, b * y * z + a * x, 1 - b * (x * x + y * y),
    )


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise (Andrew's chains)."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(rows):
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]))


def smallest_box(ring: np.ndarray) -> tuple[float, float]:
    """Area and angle of the smallest rectangle around a counter-clockwise hull; one of its sides lies on an edge.

    The corner farthest in a direction is where the edges' directions pass the one at right angles to it, which is looked up.
    """
    if len(ring) < 3:
        return 0.0, 0.0
    edges = np.roll(ring, -1, axis=0) - ring
    angles = np.arctan2(edges[:, 1], edges[:, 0])
    first = int(np.argmin(angles))
    order = np.roll(np.arange(len(ring)), -first)
    rising = angles[order]

    def farthest(direction: np.ndarray) -> np.ndarray:
        turned = (direction + np.pi / 2 + np.pi) % (2 * np.pi) - np.pi
        return ring[order[np.searchsorted(rising, turned) % len(ring)]]

    size = []
    for turn in (0.0, np.pi / 2):
        along = np.stack([np.cos(angles + turn), np.sin(angles + turn)], axis=1)
        size.append(((farthest(angles + turn) - farthest(angles + turn + np.pi)) * along).sum(axis=1))
    found = np.round(size[0] * size[1], 12)
    best = np.lexsort((angles % (np.pi / 2), found))[0]
    return float(size[0][best] * size[1][best]), float(angles[best] % (np.pi / 2))


def hulls(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """(group, x, y) of points that hold all corners of each group's convex hull: the hulls of what each task has seen.

    Hulls merge: the hull of hulls of parts is that of the whole. A task holds the hulls of its groups, not their points.
    """
    kind = points.schema[group].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict = {}
        for frame in frames:
            for key, own in frame.groupby(group, dropna=False, sort=False):
                own = own[[x, y]].to_numpy(float)
                key = None if pd.isna(key) else key
                kept[key] = hull(np.concatenate([kept[key], own]) if key in kept else own)
        for key, ring in kept.items():
            yield pd.DataFrame({group: [key] * len(ring), x: ring[:, 0], y: ring[:, 1]})

    given = points.select(group, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)).dropna(subset=[x, y])
    return given.mapInPandas(run, f"`{group}` {kind}, `{x}` double, `{y}` double")


#: Tasks that share a group's partial hulls.
SLICES = 32


def smallest_boxes(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Area and angle of the smallest oriented rectangle around each group's points, and its hull's corners.

    Hulls are taken in each task, then in SLICES slices of a group, then of the whole; the last task holds corners only. Points without
    a coordinate are left out; points on one line have no area.
    """
    kind = points.schema[group].dataType.simpleString()
    parts = hulls(points, group, x, y)
    slices = hulls(parts.repartition(group, F.pmod(F.xxhash64(x, y), F.lit(SLICES))), group, x, y)

    def measure(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ring = hull(frame[[x, y]].to_numpy(float))
        area, angle = smallest_box(ring)
        return pd.DataFrame({group: [key[0]], "area": [area], "angle": [angle], "corners": [len(ring)]})

    return slices.groupBy(group).applyInPandas(measure, f"`{group}` {kind}, area double, angle double, corners long")
