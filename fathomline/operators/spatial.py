"""Polygons as binned edge lists, and point queries against them.

The plane is cut into square bins. For every bin a polygon touches, the index keeps what is needed to decide points of
that bin alone: whether the bin's lower left corner is inside, the heights at which the polygon crosses the bin's left
side, and the edges in the bin, cut at that side. A point is inside when the number of crossings on the way from the
corner up the left side and then right to the point, plus the corner's own state, is odd. Long polygons therefore cost no
more per point than small ones. With a ``reach`` the bins also list all edges within that distance, for buffers.

The index has one row per bin, so a point finds everything in one equi-join and stays one row. A bin that would list more than
``most`` edges is divided into halves, quarters, ... until no piece does; which bins are divided, and how often, is a table of its own
that points look up first. Divisions nest: the grid lines of a coarser grid are lines of all finer ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import geo
from ..runtime import BROADCAST_ELEMENTS, cut_lineage, elements
from .joins import lookup_join

#: shifts of the bin grid in shares of a bin, so that round coordinates and diagonals do not meet bin corners
SHIFT_X, SHIFT_Y = 0.2718281828, 0.5772156649
TINY = 1e-6
#: edges that a bin lists at most, and how often it is halved at most to get there
MOST, DEEPEST = 512, 10


# ------------------------------------------------------------------------------------------------------------- edges
def ring_vertices(polygons: DataFrame, keep: Sequence[str] = ("pid",)) -> DataFrame:
    """One row per ring vertex: pid, ring, k (position), lon, lat."""
    rings = polygons.select(*keep, F.posexplode("rings").alias("ring", "vertices"))
    return rings.select(*keep, "ring", F.posexplode("vertices").alias("k", "v")).select(
        *keep, "ring", "k", F.col("v.lon").alias("lon"), F.col("v.lat").alias("lat"))


def polygon_edges(polygons: DataFrame, keep: Sequence[str] = ("pid",)) -> DataFrame:
    """One row per edge: pid, ring, k, lon1, lat1, lon2, lat2. Rings that do not return to their start are closed.

    Polygons of several parts have a column ``parts``, the part each ring belongs to; their edges carry it as ``part``. Within a
    part, crossings of outer ring and holes cancel; parts are added up as a union.
    """
    v, part = F.col("vertices"), []
    if "parts" in polygons.columns:
        part = ["part"]
        polygons = polygons.withColumn("rings", F.arrays_zip(F.col("rings").alias("vertices"), F.col("parts").alias("part")))
        rings = polygons.select(*keep, F.posexplode("rings").alias("ring", "_r")).select(*keep, "ring", "_r.part", "_r.vertices")
    else:
        rings = polygons.select(*keep, F.posexplode("rings").alias("ring", "vertices"))
    keep, rings = [*keep, *part], rings.where(F.size(v) >= 3)
    closed = F.when(v[0] == F.element_at(v, -1), v).otherwise(F.concat(v, F.slice(v, 1, 1)))
    n = F.size("vertices") - 1
    pairs = F.arrays_zip(F.slice("vertices", F.lit(1), n).alias("a"), F.slice("vertices", F.lit(2), n).alias("b"))
    return rings.withColumn("vertices", closed).select(*keep, "ring", F.posexplode(pairs).alias("k", "e")).select(
        *keep, "ring", "k",
        F.col("e.a.lon").alias("lon1"), F.col("e.a.lat").alias("lat1"),
        F.col("e.b.lon").alias("lon2"), F.col("e.b.lat").alias("lat2"))


def consecutive_vertices(vertices: DataFrame) -> DataFrame:
    """Edges from a vertex table: each vertex with the next one of its ring."""
    w = W.partitionBy("pid", "ring").orderBy("k")
    return (
        vertices.select("pid", "ring", "k", F.col("lon").alias("lon1"), F.col("lat").alias("lat1"),
                        F.lead("lon").over(w).alias("lon2"), F.lead("lat").over(w).alias("lat2"))
        .where(F.col("lon2").isNotNull())
    )


def planar_edges(edges: DataFrame, keep: Sequence[str] = ("pid",), metric: bool = True) -> DataFrame:
    """Edges as x1, y1, x2, y2, in metres or (``metric=False``) in degrees."""
    if metric:
        x1, y1 = geo.to_metric(F.col("lon1"), F.col("lat1"))
        x2, y2 = geo.to_metric(F.col("lon2"), F.col("lat2"))
    else:
        x1, y1, x2, y2 = (F.col(c) for c in ("lon1", "lat1", "lon2", "lat2"))
    keep = [*keep, *(["part"] if "part" in edges.columns and "part" not in keep else [])]
    return edges.select(*keep, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


# ------------------------------------------------------------------------------------------------------------- index
@dataclass(frozen=True)
class PolygonIndex:
    bins: DataFrame  # _lvl, _bx, _by, _polys
    bin_size: float
    reach: float
    small: bool
    divided: DataFrame | None = None  # _ox, _oy, _lvl: undivided bins that are halved so often
    divided_small: bool = True
    edges: DataFrame | None = None  # what was indexed, as a written table

    def key(self, x: Column, y: Column, level: Column | None = None) -> tuple[Column, Column]:
        b, n = F.lit(self.bin_size), F.lit(1.0) if level is None else F.pow(F.lit(2.0), level)
        sx, sy = F.lit(SHIFT_X * self.bin_size), F.lit(SHIFT_Y * self.bin_size)
        return F.floor((x - sx) / b * n), F.floor((y - sy) / b * n)

    def size(self, level: Column) -> Column:
        return F.lit(self.bin_size) / F.pow(F.lit(2.0), level)

    def low(self, bx: Column, by: Column, level: Column) -> tuple[Column, Column]:
        return bx * self.size(level) + F.lit(SHIFT_X * self.bin_size), by * self.size(level) + F.lit(SHIFT_Y * self.bin_size)


def _span(low: Column, high: Column) -> Column:
    """Exploded integers low..high, nothing when the range is empty."""
    return F.explode(F.when(low <= high, F.sequence(low, high)))


def _share_between(start: Column, delta: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Parameters at which ``start + t * delta`` meets low and high, within 0..1; the whole range when delta is 0."""
    def at(level: Column, whole: float) -> Column:
        t = (level - start) / F.when(delta != 0, delta)
        return F.when(delta != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))).otherwise(F.lit(whole))

    return at(low, 0.0), at(high, 1.0)


class Grid:
    """The grid that halves bins ``level`` times, and what edges contribute to its bins."""

    def __init__(self, bin_size: float, level: int, reach: float, ids: Sequence[str]):
        self.whole, self.level, self.reach, self.ids = bin_size, level, reach, list(ids)
        self.size, self.parts = bin_size / 2**level, 2**level
        self.b, self.sx, self.sy = F.lit(self.size), F.lit(SHIFT_X * bin_size), F.lit(SHIFT_Y * bin_size)

    def at(self, v: Column, shift: Column) -> Column:
        return F.floor((v - shift) / self.b)

    def _within(self, low: Column, high: Column, outer: str) -> Column:
        """Exploded integers low..high, those of one undivided bin only where bins are divided."""
        if self.level:
            low = F.greatest(low, F.col(outer) * self.parts)
            high = F.least(high, F.col(outer) * self.parts + (self.parts - 1))
        return _span(low, high)

    def placed(self, edges: DataFrame, region: DataFrame | None) -> DataFrame:
        """One row per edge and bin it comes near; ``region`` (_ox, _oy) names the undivided bins to look into."""
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        if region is not None:
            outer = Grid(self.whole, 0, self.reach, self.ids).placed(edges, None)
            edges = outer.withColumnsRenamed({"_bx": "_ox", "_by": "_oy"}).join(region, ["_ox", "_oy"])
        pad = F.lit(self.reach + TINY * self.size)
        # first the rows of bins, then within a row only the part of the edge that is in it
        banded = edges.withColumn("_by", self._within(self.at(F.least(y1, y2) - pad, self.sy), self.at(F.greatest(y1, y2) + pad, self.sy), "_oy"))
        low = F.col("_by") * self.b + self.sy - pad
        ta, tb = _share_between(y1, y2 - y1, low, low + self.b + 2 * pad)
        banded = banded.withColumns({"_xa": x1 + ta * (x2 - x1), "_xb": x1 + tb * (x2 - x1)})
        return banded.withColumn("_bx", self._within(self.at(F.least("_xa", "_xb") - pad, self.sx), self.at(F.greatest("_xa", "_xb") + pad, self.sx),
                                                     "_ox")).drop("_xa", "_xb")

    def first_bin(self, level: Column) -> Column:
        """The bin right of where an edge crosses a horizontal line."""
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        return F.ceil((x1 + (level - y1) * ((x2 - x1) / F.when(y2 != y1, y2 - y1)) - self.sx) / self.b)

    def pieces(self, edges: DataFrame, region: DataFrame | None) -> DataFrame:
        """What each edge means for each bin it comes near: side crossed, wall, rim."""
        b, x1, y1, x2, y2 = self.b, *(F.col(c) for c in ("x1", "y1", "x2", "y2"))
        dx, dy = x2 - x1, y2 - y1
        placed = self.placed(edges, region).withColumns({"_x0": F.col("_bx") * b + self.sx, "_y0": F.col("_by") * b + self.sy})
        x0, y0, tiny = F.col("_x0"), F.col("_y0"), F.lit(TINY * self.size)
        crosses = (x1 > x0) != (x2 > x0)
        # whether an edge passes the corner above or below is decided once, by the bin where it crosses the lower grid line
        left_of_corner = self.first_bin(y0) <= F.col("_bx")
        above = F.when((y1 > y0) != (y2 > y0), left_of_corner == (dx * dy > 0)).otherwise(F.least(y1, y2) > y0)
        side_y = y1 + (x0 - x1) * (dy / F.when(dx != 0, dx))
        placed = placed.withColumn("_above", above).withColumns({
            "_yc": F.when(crosses, F.when(F.col("_above"), F.greatest(side_y, y0)).otherwise(F.least(side_y, y0))),
            "_near": (F.least(x1, x2) <= x0 + b + tiny) & (F.greatest(x1, x2) > x0)
            & (F.least(y1, y2) <= y0 + b + tiny) & (F.greatest(y1, y2) >= y0 - tiny),
        })
        yc = F.col("_yc")
        cut1, cut2 = yc.isNotNull() & (x1 <= x0), yc.isNotNull() & (x2 <= x0)
        wall = F.struct(
            F.when(cut1, yc).otherwise(y1).alias("ya"), F.when(cut2, yc).otherwise(y2).alias("yb"),
            x1.alias("x"), y1.alias("y"), (dx / F.when(dy != 0, dy)).alias("slope"))
        rim = edge_struct() if self.reach > 0 else F.lit(None).cast("struct<x:double,y:double,dx:double,dy:double,inv:double>")
        outer = [] if region is None else ["_ox", "_oy"]
        return placed.select(
            *self.ids, *outer, "_bx", "_by", F.lit(False).alias("corner"),
            F.when(F.col("_near") & F.col("_above") & (yc <= y0 + b), yc).alias("side"),
            F.when(F.col("_near") & (dy != 0), wall).alias("wall"), rim.alias("rim"))

    def corners(self, edges: DataFrame, region: DataFrame | None) -> DataFrame:
        """Bins whose corner is inside: along each grid line, those between an odd and the next crossing."""
        y1, y2 = F.col("y1"), F.col("y2")
        edges = edges.where(y1 != y2)
        low, high = self.at(F.least(y1, y2), self.sy), self.at(F.greatest(y1, y2), self.sy) + 1
        if region is not None:
            rows = edges.withColumn("_oy", _span(F.floor(low / self.parts), F.floor(high / self.parts)))
            edges = rows.join(region.select("_oy").distinct(), "_oy")
        on_line = edges.withColumn("_by", self._within(low, high, "_oy"))
        line = F.col("_by") * self.b + self.sy
        on_line = on_line.where((y1 > line) != (y2 > line)).withColumn("_from", self.first_bin(line))
        w = W.partitionBy(*self.ids, "_by").orderBy("_from")
        runs = on_line.groupBy(*self.ids, "_by", "_from").agg(F.count(F.lit(1)).alias("_n")).select(
            *self.ids, "_by", "_from", F.sum("_n").over(w).alias("_total"), (F.lead("_from").over(w) - 1).alias("_to"))
        runs = runs.where(F.col("_total") % 2 == 1)
        if region is not None:
            outer = runs.withColumns({"_oy": F.floor(F.col("_by") / self.parts)}).withColumn(
                "_ox", _span(F.floor(F.col("_from") / self.parts), F.floor(F.col("_to") / self.parts)))
            runs = outer.join(region, ["_ox", "_oy"])
        return runs.select(*self.ids, self._within(F.col("_from"), F.col("_to"), "_ox").alias("_bx"), "_by").withColumn("corner", F.lit(True))


def edge_struct(*attrs: str) -> Column:
    """An edge as its start, its extent and one over its squared length, for distances."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    return F.struct(x1.alias("x"), y1.alias("y"), dx.alias("dx"), dy.alias("dy"),
                    F.coalesce(1 / F.when(length2 > 0, length2), F.lit(0.0)).alias("inv"), *attrs)


def build_index(edges: DataFrame, bin_size: float, reach: float = 0.0, attrs: Sequence[str] = (),
                limit: int = BROADCAST_ELEMENTS, most: int = MOST, deepest: int = DEEPEST) -> PolygonIndex:
    """Index planar edges (pid, x1, y1, x2, y2, ``part`` of polygons of several, and per-polygon ``attrs``).

    Bins are halved no further than to the size of ``reach``: below that, each would list its neighbours' edges again.
    """
    ids = ["pid", *(["part"] if "part" in edges.columns else []), *attrs]
    # written, because filters that are pushed below the shuffle would make every edge again in the few tasks that read polygons
    edges = cut_lineage(edges.select(*ids, "x1", "y1", "x2", "y2").repartition("pid", "x1", "y1"), "edges")
    grid = Grid(bin_size, 0, reach, ids)
    pieces = cut_lineage(grid.pieces(edges, None), "pieces")
    per_bin = lambda p, *keys: p.groupBy(*keys, "_bx", "_by").agg(F.count(F.lit(1)).alias("_n"))
    # at most one row per ``most`` edges
    dense = cut_lineage(per_bin(pieces).where(F.col("_n") > most).select(F.col("_bx").alias("_ox"), F.col("_by").alias("_oy")), "dense")
    divided, parts = None, []
    corners = grid.corners(edges, None)
    level = 0
    if reach > 0:
        deepest = min(deepest, max(0, int(math.log2(bin_size / reach)) if bin_size > reach else 0))
    if deepest and not dense.isEmpty():
        here = dense.withColumnsRenamed({"_ox": "_bx", "_oy": "_by"})
        pieces, corners = (d.join(here, ["_bx", "_by"], "left_anti") for d in (pieces, corners))
    parts.append((0, pieces, corners))
    while level < deepest and not dense.isEmpty():
        level += 1
        finer = Grid(bin_size, level, reach, ids)
        pieces = cut_lineage(finer.pieces(edges, dense), "pieces")
        fullest = per_bin(pieces, "_ox", "_oy").groupBy("_ox", "_oy").agg(F.max("_n").alias("_n"))
        judged = cut_lineage(fullest.withColumn("_done", (F.col("_n") <= most) | F.lit(level == deepest)), "judged")
        settled, dense = (judged.where(F.col("_done") == done).select("_ox", "_oy") for done in (True, False))
        parts.append((level, pieces.join(settled, ["_ox", "_oy"], "left_semi").drop("_ox", "_oy"), finer.corners(edges, settled)))
        rows = settled.withColumn("_lvl", F.lit(level))
        divided = rows if divided is None else divided.unionByName(rows)

    rows = None
    for lvl, p, c in parts:
        both = p.unionByName(c, allowMissingColumns=True).withColumn("_lvl", F.lit(lvl))
        rows = both if rows is None else rows.unionByName(both)
    per_polygon = rows.groupBy(*ids, "_lvl", "_bx", "_by").agg(
        F.max("corner").alias("corner"), F.collect_list("side").alias("sides"),
        F.collect_list("wall").alias("walls"), F.collect_list("rim").alias("rim"))
    used = F.col("corner") | (F.size("sides") > 0) | (F.size("walls") > 0) | (F.size("rim") > 0)
    bins = cut_lineage(per_polygon.where(used).groupBy("_lvl", "_bx", "_by").agg(
        F.collect_list(F.struct(*ids, "corner", "sides", "walls", "rim")).alias("_polys")))
    weight = F.aggregate("_polys", F.lit(0), lambda n, p: n + F.size(p.sides) + F.size(p.walls) + F.size(p.rim) + 1)
    small = elements(bins, weight) <= limit
    if divided is None:
        return PolygonIndex(bins, bin_size, reach, small, edges=edges)
    divided = cut_lineage(divided, "divided")
    return PolygonIndex(bins, bin_size, reach, small, divided, elements(divided) <= limit, edges)


# ------------------------------------------------------------------------------------------------------ point queries
def inside(poly: Column, px: Column, py: Column) -> Column:
    """Is the point inside one indexed polygon of its bin?"""
    up = F.size(F.filter(poly.sides, lambda y: y <= py))
    right = F.size(F.filter(
        poly.walls, lambda e: ((e.ya > py) != (e.yb > py)) & (e.x + (py - e.y) * e.slope <= px)))
    return (poly.corner.cast("int") + up + right) % 2 == 1


def squared_distance(e: Column, px: Column, py: Column) -> Column:
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - e.x) * e.dx + (py - e.y) * e.dy) * e.inv))
    return F.pow(px - e.x - t * e.dx, F.lit(2)) + F.pow(py - e.y - t * e.dy, F.lit(2))


def within_reach(poly: Column, px: Column, py: Column, distance: float) -> Column:
    """Inside the polygon, or closer than ``distance`` to its outline: the polygon grown by a round buffer."""
    hit = inside(poly, px, py)
    if distance <= 0:
        return hit
    return hit | F.exists(poly.rim, lambda e: squared_distance(e, px, py) < distance * distance)


def distance_to(poly: Column, px: Column, py: Column) -> Column:
    """Distance to the polygon (0 inside) in units of the plane, at micrometre steps so that shared borders tie."""
    least = F.aggregate(poly.rim, F.lit(float("inf")), lambda m, e: F.least(m, squared_distance(e, px, py)))
    return F.when(inside(poly, px, py), F.lit(0.0)).otherwise(F.round(F.sqrt(least), 6))


def lookup(points: DataFrame, index: PolygonIndex, x: Column, y: Column, name: str,
           value: Callable[[Column, Column, Column], Column], only: Column | None = None, stored: bool = False) -> DataFrame:
    """Add ``value(polygons of the bin, x, y)`` to every point; the polygons are NULL where the index has none.

    Points for which ``only`` is false are not looked up. ``stored`` tells that points are cheaply read from a table.
    """
    asked = F.lit(True) if only is None else only
    p = points.withColumns({"_px": x, "_py": y, "_asked": asked, "_lvl": F.lit(0)})
    px, py = F.col("_px"), F.col("_py")
    when = lambda c: F.when(F.col("_asked"), c)
    if index.divided is not None:
        ox, oy = index.key(px, py)
        p = lookup_join(p.drop("_lvl").withColumns({"_ox": when(ox), "_oy": when(oy)}), index.divided, ["_ox", "_oy"], index.divided_small, stored=stored)
        stored = stored and index.divided_small
        p = p.withColumn("_lvl", F.coalesce("_lvl", F.lit(0))).drop("_ox", "_oy")
    kx, ky = index.key(px, py, F.col("_lvl") if index.divided is not None else None)
    p = p.withColumns({"_bx": when(kx), "_by": when(ky)})
    joined = lookup_join(p, index.bins, ["_lvl", "_bx", "_by"], index.small, stored=stored)
    return joined.withColumn(name, value(F.col("_polys"), px, py)).drop("_polys", "_px", "_py", "_bx", "_by", "_lvl", "_asked")


def points_in_polygons(points: DataFrame, index: PolygonIndex | None, x: Column, y: Column, buffer_m: float = 0.0,
                       name: str = "on_meadow", stored: bool = False) -> DataFrame:
    """Flag points inside any polygon grown by ``buffer_m``; no polygons means no point is. ``stored``: see ``lookup``."""
    if index is None:
        return points.withColumn(name, F.lit(False))
    if buffer_m > index.reach:
        raise ValueError(f"index reach {index.reach} is below the buffer {buffer_m}")
    return lookup(points, index, x, y, name, lambda polys, px, py: F.coalesce(
        F.exists(polys, lambda g: within_reach(g, px, py, buffer_m)), F.lit(False)), stored=stored)


# ------------------------------------------------------------------------------------------------------------- cells
def _lattice(index: PolygonIndex, step_x: Column, step_y: Column, shift_x: Callable[[Column], Column]) -> DataFrame:
    """Lattice points of every bin with polygons in their row: rows j at j * step_y, columns i at i * step_x + shift_x(j). Each lies in one
    bin. ``_runs`` holds the polygons in the row as where they are crossed (``at``) and whether their left end there is inside (``odd``)."""
    x0, y0 = index.low(F.col("_bx"), F.col("_by"), F.col("_lvl"))
    size = index.size(F.col("_lvl"))
    rows = index.bins.withColumn("_j", _span(F.ceil(y0 / step_y), F.ceil((y0 + size) / step_y) - 1))
    py = F.col("_j") * step_y
    runs = F.transform("_polys", lambda g: F.struct(
        g.pid.alias("pid"), ((g.corner.cast("int") + F.size(F.filter(g.sides, lambda y: y <= py))) % 2 == 1).alias("odd"),
        F.transform(F.filter(g.walls, lambda e: (e.ya > py) != (e.yb > py)), lambda e: e.x + (py - e.y) * e.slope).alias("at")))
    rows = rows.select("_lvl", "_bx", "_by", "_j", F.filter(runs, lambda r: r.odd | (F.size(r["at"]) > 0)).alias("_runs"))
    off = shift_x(F.col("_j"))
    at = _span(F.ceil((x0 - off) / step_x), F.ceil((x0 + size - off) / step_x) - 1)
    return rows.where(F.size("_runs") > 0).withColumn("_i", at).withColumns({"_px": F.col("_i") * step_x + off, "_py": py})


def _in_run(run: Column, px: Column) -> Column:
    """Is the point of a lattice row inside the polygon? The same crossings as ``inside`` counts."""
    return (run.odd.cast("int") + F.size(F.filter(run["at"], lambda x: x <= px))) % 2 == 1


def cells_with_centre_inside(index: PolygonIndex, side: float = geo.CELL_SIDE_M) -> DataFrame:
    """(pid, cell) of the hexagons whose centre is in a polygon. Every bin looks at the centres in it."""
    width = side * 3**0.5
    lattice = _lattice(index, F.lit(width), F.lit(1.5 * side), lambda j: j * F.lit(width / 2))
    hit = F.filter("_runs", lambda r: _in_run(r, F.col("_px")))
    rows = lattice.select("_i", "_j", F.explode(F.transform(hit, lambda r: r.pid)).alias("pid"))
    return rows.select("pid", geo.cell_id(F.col("_i"), F.col("_j")).alias("cell"))


def _point_to_segment2(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    # a segment of no length has t = NULL, which least() skips: the distance to its only point
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(n > 0, n)))
    return F.pow(px - ax - t * dx, F.lit(2)) + F.pow(py - ay - t * dy, F.lit(2))


def _side_of(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def cells_near_edges(edges: DataFrame, buffer_m: float, side: float = geo.CELL_SIDE_M) -> DataFrame:
    """(pid, cell) of the cells within ``buffer_m`` of an edge: an end lies in the hexagon, or one of its six sides is that close."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    width, height, reach = side * 3**0.5, 1.5 * side, side + buffer_m
    rows = edges.withColumn("r", _span(F.ceil((F.least(y1, y2) - reach) / height), F.floor((F.greatest(y1, y2) + reach) / height)))
    low = F.col("r") * F.lit(height) - reach
    ta, tb = _share_between(y1, y2 - y1, low, low + 2 * reach)
    xa, xb = x1 + ta * (x2 - x1), x1 + tb * (x2 - x1)
    at = lambda x: x / F.lit(width) - F.col("r") / 2
    near = rows.withColumn("q", _span(F.ceil(at(F.least(xa, xb) - reach)), F.floor(at(F.greatest(xa, xb) + reach))))
    cx, cy = geo.axial_centre(F.col("q"), F.col("r"), side)
    # most of the grid's candidates are farther than any point of the hexagon can be
    near = near.withColumns({"cx": cx, "cy": cy}).withColumn("d", _point_to_segment2(F.col("cx"), F.col("cy"), x1, y1, x2, y2)).where(
        F.col("d") <= (reach * (1 + TINY)) ** 2)
    # an edge that comes as near as this to the hexagon's inner circle needs no look at the sides
    surely = F.col("d") < ((width / 2 + buffer_m) * (1 - TINY)) ** 2

    corners = geo.corner_offsets(side)
    sides = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip((*corners[i], *corners[(i + 1) % 6]), ("ax", "ay", "bx", "by"))])
                      for i in range(6)])
    s = near.withColumns({"surely": surely, "s": F.explode(F.when(surely, F.slice(sides, 1, 1)).otherwise(sides))}).withColumns({
        "ax": F.col("cx") + F.col("s.ax"), "ay": F.col("cy") + F.col("s.ay"),
        "bx": F.col("cx") + F.col("s.bx"), "by": F.col("cy") + F.col("s.by")})
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    meets = (_side_of(x1, y1, x2, y2, ax, ay) * _side_of(x1, y1, x2, y2, bx, by) < 0) & (
        _side_of(ax, ay, bx, by, x1, y1) * _side_of(ax, ay, bx, by, x2, y2) < 0)
    close = F.least(
        _point_to_segment2(x1, y1, ax, ay, bx, by), _point_to_segment2(x2, y2, ax, ay, bx, by),
        _point_to_segment2(ax, ay, x1, y1, x2, y2), _point_to_segment2(bx, by, x1, y1, x2, y2)) <= buffer_m * buffer_m
    by_side = s.where(F.col("surely") | meets | close).select("pid", geo.cell_id(F.col("q"), F.col("r")).alias("cell"))
    by_end = edges.select("pid", geo.cell_of(x1, y1, side).alias("cell"))
    return by_side.unionByName(by_end)


def cells_covering(edges: DataFrame, index: PolygonIndex, buffer_m: float, side: float = geo.CELL_SIDE_M) -> DataFrame:
    """(pid, cell): the cells that overlap each polygon grown by ``buffer_m``; the smallest one has the cell it lies in."""
    return cells_near_edges(edges, buffer_m, side).unionByName(cells_with_centre_inside(index, side)).distinct()


def cells_touching_polygons(edges: DataFrame, index: PolygonIndex, buffer_m: float, side: float = geo.CELL_SIDE_M) -> DataFrame:
    """All cells that overlap any of the polygons grown by ``buffer_m``."""
    return cells_near_edges(edges, buffer_m, side).unionByName(cells_with_centre_inside(index, side)).select("cell").distinct()


def cell_area(index: PolygonIndex, step_m: float = 100.0, side: float = geo.CELL_SIDE_M) -> DataFrame:
    """km2 of the polygons' union per cell, by counting lattice points ``step_m`` apart.

    A bin tests each of its lattice points once against all its polygons, so overlaps count once. The error per cell is
    about outline length in the cell times half the step.
    """
    step = F.lit(float(step_m))
    lattice = _lattice(index, step, step, lambda j: F.lit(0.0))
    hit = lattice.where(F.exists("_runs", lambda r: _in_run(r, F.col("_px"))))
    counted = hit.select(geo.cell_of(F.col("_px"), F.col("_py"), side).alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("hits"))
    return counted.select("cell", "hits", (F.col("hits") * F.lit(step_m * step_m / 1e6)).alias("meadow_km2"))
