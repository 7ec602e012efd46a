"""Maritime zones: attributes, and the country of a point."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import geo
from ..runtime import BROADCAST_ELEMENTS, cut_lineage, elements
from .joins import lookup_join
from .spatial import (
    MOST, SHIFT_X, SHIFT_Y, TINY, Grid, PolygonIndex, build_index, edge_struct, inside, lookup, planar_edges, polygon_edges, squared_distance)

# Which kind of zone wins where several cover a point; any other kind comes last.
ZONE_PRIORITY = {"200NM": 0, "Joint regime": 1, "Overlapping claim": 2}
OTHER_PRIORITY = 3
UNKNOWN = "UNK"


def normalise_zones(raw: DataFrame) -> DataFrame:
    """iso3, name and priority of raw zone attributes. Enclaves have no territory code and take their sovereign's."""
    ranks = [F.when(F.col("pol_type") == kind, F.lit(rank)) for kind, rank in ZONE_PRIORITY.items()]
    holder = F.col("sovereign1") if "sovereign1" in raw.columns else F.col("territory1")
    return raw.withColumns({
        "iso3": F.coalesce("iso_ter1", "iso_sov1", F.lit(UNKNOWN)),
        "name": F.when(F.col("iso_ter1").isNull(), holder).otherwise(F.col("territory1")),
        "priority": F.coalesce(*ranks, F.lit(OTHER_PRIORITY)),
    }).drop("iso_ter1", "iso_sov1", "territory1", "sovereign1")


def zones_in_box(zones: DataFrame, p: Params) -> DataFrame:
    """Zones whose extent meets the study box, or comes as near as points are snapped; a world-wide table is cut to these."""
    flat = F.flatten("rings")
    lons, lats = F.transform(flat, lambda v: v.lon), F.transform(flat, lambda v: v.lat)
    reach = p.eez_max_distance_m / 100_000.0  # degrees of latitude, rounded up
    wide = reach / F.greatest(F.cos(F.radians(F.lit(max(abs(p.bbox[1]), abs(p.bbox[3]))))), F.lit(0.01))
    return zones.where((F.array_max(lons) >= p.bbox[0] - wide) & (F.array_min(lons) <= p.bbox[2] + wide)
                       & (F.array_max(lats) >= p.bbox[1] - reach) & (F.array_min(lats) <= p.bbox[3] + reach))


#: side of the bins that zone outlines lie in, as a share of the snapping distance, and how many rings of bins a round looks at
BIN_SHARE, ROUND_RINGS = 4, (1, 4)


@dataclass(frozen=True)
class Outlines:
    """Zone edges by the bins they run through, and no others: rows (_bx, _by, _chunk, _edges) of at most about ``MOST`` edges."""
    bins: DataFrame
    bin_size: float
    small: bool


@dataclass(frozen=True)
class ZoneIndex:
    within: PolygonIndex  # degrees
    plane: PolygonIndex | None  # metres; with ``outlines``, for points to be snapped
    outlines: Outlines | None


def index_zones(zones: DataFrame, p: Params, bin_deg: float = 0.5) -> ZoneIndex:
    """``zones``: pid, iso3, priority, rings."""
    attrs = ["priority", "iso3"]
    edges = polygon_edges(zones, ["pid", *attrs])
    within = build_index(planar_edges(edges, ["pid", *attrs], metric=False), bin_deg, attrs=attrs)
    if not p.eez_max_distance_m:
        return ZoneIndex(within, None, None)
    metric = cut_lineage(planar_edges(edges, ["pid", *attrs]), "outlines")
    bin_m = p.eez_max_distance_m / BIN_SHARE
    return ZoneIndex(within, build_index(metric, 4 * bin_m, attrs=attrs), bin_outlines(metric, bin_m, attrs))


def bin_outlines(edges: DataFrame, bin_m: float, attrs: list[str], most: int = MOST, limit: int = BROADCAST_ELEMENTS) -> Outlines:
    """Edges (x1, y1, x2, y2, ``attrs``) by bin. A bin with more than ``most`` edges is several rows."""
    placed = cut_lineage(Grid(bin_m, 0, 0.0, attrs).placed(edges, None).select("_bx", "_by", edge_struct(*attrs).alias("e")), "placed")
    # one row per ``most`` edges at most
    full = placed.groupBy("_bx", "_by").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    chunk = F.pmod(F.xxhash64("e"), F.coalesce(F.ceil(F.col("_n") / most), F.lit(1)))
    bins = placed.join(full, ["_bx", "_by"], "left").withColumn("_chunk", chunk).groupBy("_bx", "_by", "_chunk").agg(F.collect_list("e").alias("_edges"))
    bins = cut_lineage(bins, "outline-bins")
    return Outlines(bins, bin_m, elements(bins, F.size("_edges")) <= limit)


def _best(polys: Column, px: Column, py: Column) -> Column:
    """(priority, iso3) of the zone that wins among those containing the point, NULL outside every zone."""
    return F.array_min(F.transform(F.filter(polys, lambda g: inside(g, px, py)), lambda g: F.struct(g.priority, g.iso3)))


def zones_at(points: DataFrame, zones: ZoneIndex, lon: Column, lat: Column, name: str = "country", only: Column | None = None) -> DataFrame:
    """iso3 of the best zone containing each point (lowest priority, then iso3), NULL outside every zone."""
    return lookup(points, zones.within, lon, lat, name, lambda polys, px, py: _best(polys, px, py)["iso3"], only)


def nearest_zone(places: DataFrame, zones: ZoneIndex, limit_m: float) -> DataFrame:
    """(x, y, iso3) for those of the distinct places (x, y), in metres, that a zone contains or has within ``limit_m``.

    The nearest wins, then the lower priority, then iso3. A place looks at rings of bins around its own. It leaves once its best
    distance is below the distance to the next ring, so only places without a near zone look far. Candidate bins farther than the best
    so far, or than the limit, are left out before the join.
    """
    spread, b = zones.outlines, zones.outlines.bin_size
    left = cut_lineage(lookup(places.select("x", "y"), zones.plane, F.col("x"), F.col("y"), "in", _best), "places")
    found = left.where(F.col("in").isNotNull()).select("x", "y", F.col("in.iso3").alias("iso3"))
    ranked = "struct<d:double,priority:int,iso3:string>"
    left = left.where(F.col("in").isNull()).select("x", "y", F.lit(None).cast(ranked).alias("best"))
    x, y, seen = F.col("x"), F.col("y"), -1
    low_x, low_y = F.floor((x - SHIFT_X * b) / b), F.floor((y - SHIFT_Y * b) / b)
    x0, y0 = low_x * b + SHIFT_X * b, low_y * b + SHIFT_Y * b
    for rings in ROUND_RINGS:
        if left.isEmpty():
            break
        offsets = F.sequence(F.lit(-rings), F.lit(rings))
        asked = left.select("x", "y", "best", F.explode(offsets).alias("i")).withColumn("j", F.explode(offsets))
        gap = lambda v, v0, k: F.greatest(F.lit(0.0), v0 + k * b - v, v - v0 - (k + 1) * b)
        gx, gy = gap(x, x0, F.col("i")), gap(y, y0, F.col("j"))
        reach = F.least(F.lit(float(limit_m)), F.coalesce(F.col("best.d"), F.lit(float("inf")))) + TINY
        asked = asked.where((F.greatest(F.abs("i"), F.abs("j")) > seen) & (gx * gx + gy * gy <= reach * reach)).select(
            "x", "y", (low_x + F.col("i")).alias("_bx"), (low_y + F.col("j")).alias("_by"))
        bins = F.broadcast(spread.bins) if spread.small else spread.bins
        near = F.array_min(F.transform("_edges", lambda e: F.struct(
            F.round(F.sqrt(squared_distance(e, F.col("x"), F.col("y"))), 6).alias("d"), e.priority.cast("int").alias("priority"), e.iso3.alias("iso3"))))
        hits = asked.join(bins, ["_bx", "_by"]).select("x", "y", near.alias("hit")).where(F.col("hit.d") <= limit_m).groupBy("x", "y").agg(
            F.min("hit").alias("hit"))
        beyond = rings * b + F.least(x - x0, x0 + b - x, y - y0, y0 + b - y)
        judged = left.join(hits, ["x", "y"], "left").select("x", "y", F.least("best", "hit").alias("best"))
        judged = cut_lineage(judged.withColumn("done", F.coalesce(F.col("best.d") < beyond - TINY, F.lit(False)) | (beyond >= limit_m)), "places")
        found = found.unionByName(judged.where("done and best is not null").select("x", "y", F.col("best.iso3").alias("iso3")))
        left, seen = judged.where("not done").select("x", "y", "best"), rings
    return found


def assign_country(points: DataFrame, zones: ZoneIndex | None, lon: Column, lat: Column, p: Params,
                   only: Column | None = None, name: str = "country") -> DataFrame:
    """Country of each point: the zone it is in, else the nearest zone within the snapping distance, else ``UNK``.

    Points not in ``only`` get ``UNK`` without a lookup. Points to be snapped are looked up once per place; all points are
    written once in between, so that what made them is not computed twice.
    """
    if zones is None:
        return points.withColumn(name, F.lit(UNKNOWN))
    out = zones_at(points, zones, lon, lat, name, only)
    out = out.withColumn(name, F.coalesce(name, F.lit(UNKNOWN)))
    if zones.outlines is None:
        return out
    open_ = (F.col(name) == UNKNOWN) & (F.lit(True) if only is None else only)
    x, y = geo.to_metric(lon, lat)
    out = cut_lineage(out.withColumns({"_nx": F.when(open_, x), "_ny": F.when(open_, y)}), "zoned")
    places = out.where(F.col("_nx").isNotNull() & F.col("_ny").isNotNull()).select(F.col("_nx").alias("x"), F.col("_ny").alias("y")).distinct()
    near = cut_lineage(nearest_zone(places, zones, p.eez_max_distance_m).toDF("_nx", "_ny", "_nearest"), "nearest")
    out = lookup_join(out, near, ["_nx", "_ny"], elements(near) <= BROADCAST_ELEMENTS)
    return out.withColumn(name, F.coalesce("_nearest", name)).drop("_nearest", "_nx", "_ny")
