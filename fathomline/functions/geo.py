"""Projection and hexagonal grid as column expressions.

Metres are Lambert azimuthal equal-area (Snyder 1987) on GRS80 around 38 N 15 E. Cells are pointy-top hexagons on that
plane, so all have the same area; the id is the axial coordinate pair ``q_r``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ellipsoid, projection centre, cell side.
_A = 6378137.0
_INV_F = 298.257222101
LAT0, LON0 = 38.0, 15.0
CELL_SIDE_M = 1409.2852535992536

_f = 1 / _INV_F
E2 = _f * (2 - _f)
ECC = math.sqrt(E2)


def _q(s: float) -> float:
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


QP = _q(1.0)
_s0 = math.sin(math.radians(LAT0))
SIN_B1 = _q(_s0) / QP
COS_B1 = math.sqrt(1 - SIN_B1 * SIN_B1)
RQ = _A * math.sqrt(QP / 2)
D = _A * math.cos(math.radians(LAT0)) / math.sqrt(1 - E2 * _s0 * _s0) / (RQ * COS_B1)

#: the six neighbours of a hexagon in axial coordinates, and itself
RING1 = ((0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))
_R3 = math.sqrt(3.0)


def to_metric(lon: Column, lat: Column) -> tuple[Column, Column]:
    s = F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (s / (1 - F.lit(E2) * s * s) - F.log((1 - F.lit(ECC) * s) / (1 + F.lit(ECC) * s)) / F.lit(2 * ECC))
    sb = q / F.lit(QP)
    cb = F.sqrt(1 - sb * sb)
    lam = F.radians(lon - F.lit(LON0))
    k = F.lit(RQ) * F.sqrt(2 / (1 + F.lit(SIN_B1) * sb + F.lit(COS_B1) * cb * F.cos(lam)))
    x = k * F.lit(D) * cb * F.sin(lam)
    y = k / F.lit(D) * (F.lit(COS_B1) * sb - F.lit(SIN_B1) * cb * F.cos(lam))
    return x, y


def to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse projection; latitude by the authalic series to e^6 (below a centimetre)."""
    xs, ys = x / F.lit(D), y * F.lit(D)
    rho = F.sqrt(xs * xs + ys * ys)
    c = 2 * F.asin(rho / F.lit(2 * RQ))
    safe = F.when(rho > 0, rho).otherwise(F.lit(1.0))
    sb = F.cos(c) * F.lit(SIN_B1) + ys * F.sin(c) * F.lit(COS_B1) / safe
    b = F.asin(sb)
    e2, e4, e6 = E2, E2**2, E2**3
    lat = (
        b
        + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * b)
        + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * b)
        + F.lit(761 * e6 / 45360) * F.sin(6 * b)
    )
    lam = F.atan2(xs * F.sin(c), safe * F.lit(COS_B1) * F.cos(c) - ys * F.lit(SIN_B1) * F.sin(c))
    lon = F.lit(LON0) + F.degrees(F.when(rho > 0, lam).otherwise(F.lit(0.0)))
    return lon, F.degrees(lat)


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Spherical web-mercator metres -> degrees."""
    lon = F.degrees(x / F.lit(_A))
    lat = F.degrees(2 * F.atan(F.exp(y / F.lit(_A))) - F.lit(math.pi / 2))
    return lon, lat


def axial(x: Column, y: Column, side: float = CELL_SIDE_M) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon holding a point: round all three cube coordinates, then repair the worst."""
    fq = (F.lit(_R3 / 3) * x - y / 3) / F.lit(side)
    fr = (F.lit(2 / 3) * y) / F.lit(side)
    fs = -fq - fr
    rq, rr, rs = F.floor(fq + 0.5), F.floor(fr + 0.5), F.floor(fs + 0.5)
    dq, dr, ds = F.abs(rq - fq), F.abs(rr - fr), F.abs(rs - fs)
    q_worst = (dq > dr) & (dq > ds)
    q = F.when(q_worst, -rr - rs).otherwise(rq)
    r = F.when(~q_worst & (dr > ds), -rq - rs).otherwise(rr)
    return q, r


def cell_id(q: Column, r: Column) -> Column:
    return F.concat(q.cast("string"), F.lit("_"), r.cast("string"))


def cell_of(x: Column, y: Column, side: float = CELL_SIDE_M) -> Column:
    return cell_id(*axial(x, y, side))


def cell_axial(cell: Column) -> tuple[Column, Column]:
    parts = F.split(cell, "_")
    return parts[0].cast("bigint"), parts[1].cast("bigint")


def axial_centre(q: Column, r: Column, side: float = CELL_SIDE_M) -> tuple[Column, Column]:
    return F.lit(side * _R3) * (q + r / 2), F.lit(side * 1.5) * r


def cell_centre(cell: Column, side: float = CELL_SIDE_M) -> tuple[Column, Column]:
    """Longitude and latitude of a cell's centre."""
    return to_lonlat(*axial_centre(*cell_axial(cell), side))


def corner_offsets(side: float = CELL_SIDE_M) -> list[tuple[float, float]]:
    """The six corners relative to the centre, counter-clockwise from the lower right."""
    return [(side * math.cos(math.radians(a)), side * math.sin(math.radians(a))) for a in range(-30, 330, 60)]


def cell_boundary(cell: Column, side: float = CELL_SIDE_M) -> Column:
    """Closed ring of the cell as an array of (lon, lat) structs; the first corner is repeated at the end."""
    cx, cy = axial_centre(*cell_axial(cell), side)
    corners = []
    for dx, dy in [*corner_offsets(side), corner_offsets(side)[0]]:
        lon, lat = to_lonlat(cx + F.lit(dx), cy + F.lit(dy))
        corners.append(F.struct(lon.alias("lon"), lat.alias("lat")))
    return F.array(*corners)


def neighbours(cell: Column) -> Column:
    """The cell and the six around it."""
    q, r = cell_axial(cell)
    return F.array(*[cell_id(q + dq, r + dr) for dq, dr in RING1])
