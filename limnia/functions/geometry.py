"""Planar and map-projection formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and the conterminous-US equal-area projection.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
STD_PARALLELS = (29.5, 45.5)
ORIGIN = (23.0, -96.0)


def _authalic(sin_phi, e: float, log):
    """q(phi) of the ellipsoidal equal-area projections, on floats or columns."""
    es = sin_phi * e
    return (sin_phi / (1 - es * es) - log((1 - es) / (1 + es)) / (2 * e)) * (1 - e * e)


def albers(
    lon: Column, lat: Column, a: float = GRS80_A, f: float = GRS80_F,
    parallels=STD_PARALLELS, origin=ORIGIN,
) -> tuple[Column, Column]:
    """Longitude/latitude in degrees -> equal-area metres (x, y).

    Forward formulas for the ellipsoid (Snyder 1987, eq. 14-1 to 14-14). The projection's
    own constants are plain numbers, so only the point-dependent part reaches the plan.
    """
    e = math.sqrt(f * (2 - f))

    def q(deg):
        return _authalic(math.sin(math.radians(deg)), e, math.log)

    def m(deg):
        s = math.sin(math.radians(deg))
        return math.cos(math.radians(deg)) / math.sqrt(1 - (e * s) ** 2)

    p1, p2 = parallels
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(c - n * q(origin[0])) / n

    q_phi = _authalic(F.sin(F.radians(lat)), e, F.log)
    rho = F.sqrt(F.lit(c) - q_phi * n) * (a / n)
    theta = F.radians(lon - F.lit(origin[1])) * n
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def albers_inverse(
    x: Column, y: Column, a: float = GRS80_A, f: float = GRS80_F, parallels=STD_PARALLELS, origin=ORIGIN
) -> tuple[Column, Column]:
    """Equal-area metres -> longitude/latitude in degrees (Snyder 1987, eq. 14-8 to 14-11 and 3-18)."""
    e = math.sqrt(f * (2 - f))

    def q(deg):
        return _authalic(math.sin(math.radians(deg)), e, math.log)

    def m(deg):
        s = math.sin(math.radians(deg))
        return math.cos(math.radians(deg)) / math.sqrt(1 - (e * s) ** 2)

    p1, p2 = parallels
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(c - n * q(origin[0])) / n

    down = F.lit(rho0) - y
    theta = F.atan2(x, down)
    q_phi = (F.lit(c) - (x * x + down * down) * (n * n / (a * a))) / n
    beta = F.asin(q_phi / q(90.0))
    e2 = e * e
    phi = (
        beta + F.sin(beta * 2) * (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040)
        + F.sin(beta * 4) * (23 * e2**2 / 360 + 251 * e2**3 / 3780) + F.sin(beta * 6) * (761 * e2**3 / 45360)
    )
    return F.degrees(theta) / n + F.lit(origin[1]), F.degrees(phi)


def in_box(lon: Column, lat: Column, minx, miny, maxx, maxy) -> Column:
    """Inclusive on all four sides."""
    return lon.between(minx, maxx) & lat.between(miny, maxy)


def ray_hits(px, py, x1, y1, x2, y2) -> Column:
    """Does the ray from (px, py) towards +x cross the edge? Half-open in y, no division."""
    left = (px - x1) * (y2 - y1)
    right = (x2 - x1) * (py - y1)
    crosses = F.when(y2 > y1, left < right).otherwise(left > right)
    return ((y1 > py) != (y2 > py)) & crosses


def on_segment(px, py, x1, y1, x2, y2) -> Column:
    """Is the point on the closed segment? Exact for axis-parallel edges and vertices."""
    return (
        ((px - x1) * (y2 - y1) == (x2 - x1) * (py - y1))
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def segment_distance_sq(px, py, x1, y1, x2, y2) -> Column:
    """Squared distance from a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, length), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def edge_meets_box(x1, y1, x2, y2, minx: float, miny: float, maxx: float, maxy: float) -> Column:
    """Does the closed segment share a point with the closed box?

    Separating axes: their bounds must overlap, and the box corners must not all lie
    strictly on one side of the segment's line.
    """
    overlap = (
        (F.least(x1, x2) <= maxx) & (F.greatest(x1, x2) >= minx)
        & (F.least(y1, y2) <= maxy) & (F.greatest(y1, y2) >= miny)
    )
    sides = [
        (x2 - x1) * (F.lit(cy) - y1) - (y2 - y1) * (F.lit(cx) - x1)
        for cx, cy in ((minx, miny), (minx, maxy), (maxx, miny), (maxx, maxy))
    ]
    return overlap & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
