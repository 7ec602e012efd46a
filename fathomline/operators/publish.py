"""Published tables: points, time series, hotspots, the display layer of the meadows, build parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Params
from ..functions import geo, outlines
from ..functions.scalars import ais_class, floor_nd, num, step_round
from ..runtime import cut_lineage, ship
from ..sources.files import feature_text
from .pressure import country_series, month_array
from .ranking import country_order, points_most_recent, with_month_index
from .spatial import polygon_edges


def flag_lookup(df: DataFrame, mids: DataFrame, mmsi: str = "mmsi", name: str = "flag") -> DataFrame:
    """Flag state from the first three digits of a ship's MMSI; ``mids`` (mid, iso2) is the ITU's public table.

    Only nine-digit numbers starting with 2 to 7 belong to ships.
    """
    number = F.regexp_replace(F.col(mmsi), r"(?U)^\s+|\s+$", "")
    mid = F.when(number.rlike(r"\A[2-7][0-9]{8}\z"), F.substring(number, 1, 3))
    table = mids.select(F.col("mid").alias("_mid"), F.col("iso2").alias(name))
    return df.withColumn("_mid", mid).join(table, "_mid", "left").drop("_mid")


def publish_points(fact: DataFrame, calendar: DataFrame, mids: DataFrame, p: Params) -> DataFrame:
    """On-meadow detections as published: all, or the newest ``p.points_cap``.

    Whoever is matched has a confidence, cut to two decimals. What identifies a boat further (speed, length in steps, flag) is
    left out below the confident class; the ship's number itself never leaves the fact table.
    """
    rows = flag_lookup(points_most_recent(fact, calendar, p.points_cap), mids)
    matched, confident = F.col("ais_matched"), F.col("ais_confident")
    return with_month_index(rows, calendar).select(
        num(F.col("lon"), p.coord_decimals).alias("lon"), num(F.col("lat"), p.coord_decimals).alias("lat"), "m",
        num(F.col("length_m_inferred"), 1).alias("length_m"), "country",
        ais_class(matched, confident, F.col("ais_stationary")).alias("ais_class"),
        F.when(matched, floor_nd(F.col("matching_confidence"), 2)).alias("ais_conf"),
        F.when(confident, floor_nd(F.col("ais_speed_kn"), 1)).alias("ais_speed_kn"),
        F.when(confident, step_round(F.col("ais_length_m"), p.length_step_m)).alias("ais_length_m"),
        F.when(confident, F.col("flag")).alias("ais_flag"))


def publish_timeseries(totals: DataFrame, ais_totals: DataFrame) -> DataFrame:
    """All monthly totals in one table."""
    return totals.join(ais_totals, "month").orderBy("month")


def publish_countries(fact: DataFrame, calendar: DataFrame, names: DataFrame) -> DataFrame:
    """Per country its name, rank by total, and the two monthly series as arrays in calendar order.

    There are some 250 countries with twelve values a year each, so numbering them in one task is bounded.
    """
    return countries_of(country_series(fact, calendar), names)


def countries_of(series: DataFrame, names: DataFrame) -> DataFrame:
    ranked = country_order(series).withColumn("position", F.row_number().over(W.orderBy(F.desc("total"), "country")))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("month", c))), lambda s: s[c])
    arrays = series.groupBy("country").agg(*[in_order(c).alias(c) for c in ("anchored_on_meadow", "large_on_meadow")])
    named = arrays.join(names.withColumnRenamed("iso3", "country"), "country", "left")
    return named.join(ranked, "country").select(
        "position", "country", F.coalesce("name", "country").alias("name"), "total", "anchored_on_meadow", "large_on_meadow"
    ).orderBy("position")


def publish_hotspots(hot: DataFrame, p: Params) -> DataFrame:
    lon, lat = geo.cell_centre(F.col("cell"))
    return hot.select(
        "cell", num(lon, p.coord_decimals).alias("lon"), num(lat, p.coord_decimals).alias("lat"), "country",
        F.lit(None).cast("string").alias("place"), "on_meadow", "large_on_meadow", num(F.col("density"), 4).alias("density"),
        "peak_month")


def number_hotspots(hot: DataFrame) -> DataFrame:
    """Add the 1-based ``position``; the table holds only the top few cells."""
    order = [F.desc("on_meadow"), F.desc(F.coalesce("density", F.lit(-1.0))), F.asc("cell")]
    return hot.withColumn("position", F.row_number().over(W.orderBy(*order)))


def publish_hexes(hexes: DataFrame) -> DataFrame:
    return hexes.withColumns({"density": num(F.col("density"), 4), "meadow_km2": num(F.col("meadow_km2"), 3)})


def series_of(countries: DataFrame, calendar: DataFrame) -> DataFrame:
    """Country, month and the two counts again, from the arrays of published countries."""
    values = countries.select("country", F.posexplode(F.arrays_zip("anchored_on_meadow", "large_on_meadow")).alias("m", "v"))
    dated = values.withColumn("_months", month_array(calendar))
    return dated.select("country", F.get("_months", F.col("m")).alias("month"), "v.anchored_on_meadow", "v.large_on_meadow")


def meta_row(calendar: DataFrame, p: Params) -> DataFrame:
    """One row with the build's parameters and months."""
    return calendar.agg(F.array_sort(F.collect_set("month")).alias("months")).select(
        "months", F.lit(p.speed_kn_max).alias("speed_kn_max"), F.lit(p.buffer_m).alias("buffer_m"),
        F.lit(p.large_length_m).alias("large_length_m"), F.lit(p.ais_confidence_min).alias("ais_confidence_min"),
        F.lit(geo.CELL_SIDE_M).alias("cell_side_m"), F.array(*[F.lit(v) for v in p.bbox]).alias("bbox"))


def display_vertices(polygons: DataFrame, tolerance_m: float) -> DataFrame:
    """Ring vertices snapped to a grid of ``tolerance_m``, without consecutive repeats: pid, ring, k, x, y, in metres.

    This thins outlines evenly; it is not a Douglas-Peucker simplification. A ring that snapping would leave with fewer
    than four vertices (the closing one included) keeps its own vertices, so no polygon is lost.
    """
    closed = closed_vertices(polygons)
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    step = F.lit(float(tolerance_m))
    snap = lambda v: F.floor(v / step + 0.5)
    v = closed.select("pid", "ring", "k", x.alias("x"), y.alias("y")).withColumns({"gx": snap(F.col("x")), "gy": snap(F.col("y"))})
    w = W.partitionBy("pid", "ring")
    same = (F.lag("gx").over(w.orderBy("k")) == F.col("gx")) & (F.lag("gy").over(w.orderBy("k")) == F.col("gy"))
    v = v.withColumn("_new", F.coalesce(~same, F.lit(True))).withColumn("_thin", F.count_if("_new").over(w) >= 4)
    return v.where("_new or not _thin").select(
        "pid", "ring", "k", F.when(F.col("_thin"), F.col("gx") * step).otherwise(F.col("x")).alias("x"),
        F.when(F.col("_thin"), F.col("gy") * step).otherwise(F.col("y")).alias("y"))


def closed_vertices(polygons: DataFrame) -> DataFrame:
    """Ring vertices with the first one repeated at the end."""
    e = polygon_edges(polygons)
    last = e.groupBy("pid", "ring").agg(F.max_by(F.struct("lon2", "lat2"), "k").alias("v"), (F.max("k") + 1).alias("k"))
    return e.select("pid", "ring", "k", F.col("lon1").alias("lon"), F.col("lat1").alias("lat")).unionByName(
        last.select("pid", "ring", "k", F.col("v.lon2").alias("lon"), F.col("v.lat2").alias("lat")))


def polygon_display_layer(polygons: DataFrame, tolerance_m: float, decimals: int = 5) -> DataFrame:
    """Thinned polygons: id, type, rings of (lon, lat) on a 10^-decimals degree grid, and the part of each ring."""
    lon, lat = geo.to_lonlat(F.col("x"), F.col("y"))
    v = display_vertices(polygons, tolerance_m).select(
        "pid", "ring", "k", F.bround(lon, decimals).alias("lon"), F.bround(lat, decimals).alias("lat"))
    drop_k = lambda a: F.transform(a, lambda s: F.struct(s.lon.alias("lon"), s.lat.alias("lat")))
    rings = v.groupBy("pid", "ring").agg(F.array_sort(F.collect_list(F.struct("k", "lon", "lat"))).alias("vs"))
    parts = rings.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("ring", drop_k(F.col("vs")).alias("vs")))).alias("rs"))
    layer = parts.select(F.col("pid").alias("id"), F.transform("rs", lambda r: r.vs).alias("rings"), F.transform("rs", lambda r: r.ring).alias("_ring"))
    if "parts" in polygons.columns:
        own = polygons.select(F.col("pid").alias("id"), F.col("parts").alias("_of"))
        layer = layer.join(own, "id").withColumn("parts", F.transform("_ring", lambda i: F.get("_of", i)))
    else:
        layer = layer.withColumn("parts", F.transform("_ring", lambda i: F.lit(0)))
    return layer.select("id", layer_type().alias("type"), "rings", "parts")


def layer_type() -> Column:
    return F.when(F.size(F.array_distinct("parts")) > 1, F.lit("MultiPolygon")).otherwise(F.lit("Polygon"))


#: bytes that a published layer stays below, how much coarser each attempt is, and how many there are
TARGET_BYTES, COARSER, ATTEMPTS = 10_000_000, 1.6, 8


def sized_layer(polygons: DataFrame, tolerance_m: float, target_bytes: int = TARGET_BYTES, decimals: int = 5) -> tuple[DataFrame, float]:
    """Simplified polygons (id, type, rings, parts) whose GeoJSON is below ``target_bytes``, and the tolerance that took.

    Each attempt simplifies the polygons' own outlines, writes the layer and measures its features; the tolerance grows until the sum
    is below the target, or the attempts are used up: then the coarsest layer stands. No polygon is lost at any tolerance.
    """
    ship(polygons.sparkSession)
    to_plane = lambda v: F.struct(*(c.alias(n) for c, n in zip(geo.to_metric(v.lon, v.lat), ("x", "y"))))
    parts = F.col("parts") if "parts" in polygons.columns else F.transform("rings", lambda r: F.lit(0))
    plane = polygons.select(F.col("pid").alias("id"), parts.alias("parts"), F.transform("rings", lambda r: F.transform(r, to_plane)).alias("rings"))
    lon, lat = (lambda v: geo.to_lonlat(v.x, v.y)[0]), (lambda v: geo.to_lonlat(v.x, v.y)[1])
    for attempt in range(ATTEMPTS):
        thin = plane.mapInArrow(outlines.simplifier(tolerance_m), plane.schema)
        rounded = F.transform("rings", lambda r: rounded_ring(r, lon, lat, decimals))
        layer = cut_lineage(thin.select("id", layer_type().alias("type"), rounded.alias("rings"), "parts"), "layer")
        size = layer.agg(F.sum(F.octet_length(feature_text(layer)) + 1)).first()[0] or 0
        if size < target_bytes or attempt == ATTEMPTS - 1:
            return layer, tolerance_m
        tolerance_m *= COARSER
    raise AssertionError("unreachable")


def rounded_ring(ring: Column, lon, lat, decimals: int) -> Column:
    """Vertices on a 10^-decimals degree grid without consecutive repeats; a ring too small for that grid gets a finer one."""
    def at(d: int) -> Column:
        vs = F.transform(ring, lambda v: F.struct(F.bround(lon(v), d).alias("lon"), F.bround(lat(v), d).alias("lat")))
        after = F.concat(F.slice(vs, 2, F.size(ring) - 1), F.array(F.lit(None).cast("struct<lon:double,lat:double>")))
        # the last of equal neighbours stays, the closing vertex among them
        return F.transform(F.filter(F.arrays_zip(vs.alias("v"), after.alias("w")), lambda p: ~p.v.eqNullSafe(p.w)), lambda p: p.v)

    coarse = at(decimals)
    return F.when(F.size(coarse) >= 4, coarse).otherwise(at(decimals + 4))
