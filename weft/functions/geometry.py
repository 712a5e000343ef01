"""Angles, poses, cameras and vectors as column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrap_angle(a: Column) -> Column:
    """The angle in [-pi, pi)."""
    return F.pmod(a + math.pi, F.lit(2 * math.pi)) - math.pi


def yaw(w: Column, x: Column, y: Column, z: Column) -> Column:
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def tilt(cosine: Column) -> Column:
    """Angle of a cosine that rounding may have pushed out of range."""
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def spherical(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Radius, azimuth, elevation."""
    flat = F.sqrt(x * x + y * y)
    return F.sqrt(x * x + y * y + z * z), F.atan2(y, x), F.atan2(z, flat)


def project(x: Column, y: Column, z: Column, focal: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Pixel of a camera-frame point."""
    return focal * x / z + cx, focal * y / z + cy


def unproject(u: Column, v: Column, z: Column, focal: float, cx: float, cy: float) -> tuple[Column, Column]:
    return (u - cx) * z / focal, (v - cy) * z / focal


def depth_code(metres: Column, near: float = 0.05, span: float = 0.5) -> Column:
    """16-bit code of a depth; 0 for depths out of range, fractions are cut off."""
    code = F.floor((metres - near) / span * 65534.0 + 1).cast("int")
    return F.when((metres >= near) & (metres <= near + span), code).otherwise(F.lit(0))


def depth_channels(code: Column) -> tuple[Column, Column]:
    return F.shiftright(code, 8), code.bitwiseAND(F.lit(255))


def depth_metres(high: Column, low: Column, near: float = 0.05, span: float = 0.5) -> Column:
    code = high * 256 + low
    return F.when(code == 0, F.lit(0.0)).otherwise((code - 1) / F.lit(65534.0) * span + near)


def inside_polygon(x: Column, y: Column, polygon: list[tuple[float, float]]) -> Column:
    """Whether a point lies in a simple polygon; its edges belong to it."""
    crossings, on_edge = F.lit(0), F.lit(False)
    for (x0, y0), (x1, y1) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        cross = (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)
        between = x.between(min(x0, x1), max(x0, x1)) & y.between(min(y0, y1), max(y0, y1))
        on_edge = on_edge | ((F.abs(cross) <= 1e-9) & between)
        if y0 != y1:
            at = x0 + (y - y0) * ((x1 - x0) / (y1 - y0))
            crossings = crossings + (((y >= min(y0, y1)) & (y < max(y0, y1))) & (x < at)).cast("int")
    return on_edge | (crossings % 2 == 1)


def interpolate(x: Column, knots: list[tuple[float, float]]) -> Column:
    """Piecewise linear value, constant before the first knot and behind the last."""
    out = F.lit(knots[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(knots, knots[1:], strict=False))):
        out = F.when(x < x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0))).otherwise(out)
    return F.when(x <= knots[0][0], F.lit(knots[0][1])).otherwise(out)


def occluded(depth: Column, seen: Column, slack: float) -> Column:
    """Whether a point lies behind what the depth map has at its pixel."""
    return depth > seen + slack


def to_metres(pixel: Column, origin: float, per_metre: float) -> Column:
    return (pixel - origin) / per_metre


def to_pixel(metres: Column, origin: float, per_metre: float) -> Column:
    """The nearest pixel."""
    return F.floor(metres * per_metre + origin + 0.5)
