"""The whole build: stored tables in, published tables out."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Params
from ..functions import geo
from ..functions.scalars import country_names
from ..operators import checks, pressure, publish, ranking, selection
from ..operators.country import ZoneIndex, assign_country, index_zones, zones_in_box
from ..operators.detections import classify
from ..operators.spatial import PolygonIndex, build_index, cell_area, cells_touching_polygons, planar_edges, polygon_edges
from ..runtime import cut_lineage, elements, replace_folder
from ..sources.files import read_layer, write_by_month, write_columnar_json, write_geojson

#: side of the bins meadow polygons are indexed by, in metres
MEADOW_BIN_M = 1000.0


def index_meadows(meadows: DataFrame, p: Params, bin_m: float = MEADOW_BIN_M) -> PolygonIndex:
    """``meadows``: pid, rings."""
    # polygons come from few small files; what is made of them is not small
    return build_index(planar_edges(polygon_edges(meadows.repartition("pid"))), bin_m, p.buffer_m)


def meadow_cells(meadows: DataFrame, index: PolygonIndex, zones: ZoneIndex | None, p: Params, step_m: float = 100.0) -> DataFrame:
    """The cell dimension: cells touched by the grown meadows, country of the cell's centre, meadow area.

    The country of a detection is that of its own position and may differ.
    """
    edges = index.edges if index.edges is not None else planar_edges(polygon_edges(meadows)).repartition("pid", "x1", "y1")
    cells = cells_touching_polygons(edges, index, p.buffer_m)
    area = cell_area(index, step_m).select("cell", "meadow_km2")
    cells = cells.join(area, "cell", "left").withColumn("meadow_km2", F.coalesce("meadow_km2", F.lit(0.0)))
    lon, lat = geo.cell_centre(F.col("cell"))
    cells = cells.withColumns({"lon": lon, "lat": lat})
    return assign_country(cells, zones, F.col("lon"), F.col("lat"), p).select("cell", "country", "meadow_km2")


def overpass_cells(cells: DataFrame) -> DataFrame:
    """Cells to keep overpasses of: the meadow cells and their neighbours, so a meadow whose outline moves a little is still covered."""
    return cells.select(F.explode(geo.neighbours(F.col("cell"))).alias("cell")).distinct()


#: columns of the detections that published tables are made of
PUBLISHED = ("scene_id", "lat", "lon", "detect_timestamp", "month", "length_m_inferred", "matching_confidence", "mmsi", "ais_length_m")


def fact_table(det: DataFrame, meadows: PolygonIndex | None, zones: ZoneIndex | None, p: Params, keep: Sequence[str] | None = None) -> DataFrame:
    """Classified detections with their country; only those on a meadow are looked up, the others are ``UNK``."""
    rows = classify(det, meadows, p, keep)
    return assign_country(rows, zones, F.col("lon"), F.col("lat"), p, F.col("on_meadow"))


@dataclass(frozen=True)
class Dimensions:
    meadows: PolygonIndex
    zones: ZoneIndex | None
    cells: DataFrame


def dimensions(meadows: DataFrame, zones: DataFrame | None, p: Params) -> Dimensions:
    meadow_index = index_meadows(meadows, p)
    zone_index = index_zones(zones_in_box(zones, p), p) if zones is not None else None
    return Dimensions(meadow_index, zone_index, cut_lineage(meadow_cells(meadows, meadow_index, zone_index, p)))


@dataclass(frozen=True)
class Counts:
    """What the published tables are made of."""

    months: DataFrame  # months with detections, counted or not
    totals: DataFrame  # month: all, on a meadow, large ones
    series: DataFrame  # country, month
    cells: DataFrame  # cell, month: seven counters
    points: DataFrame  # rows on a meadow, perhaps with others


def counts_of(fact: DataFrame, months: DataFrame) -> Counts:
    return Counts(months, pressure.total_counts(fact), pressure.country_counts(fact), pressure.cell_months(fact), fact)


@dataclass(frozen=True)
class Published:
    meta: DataFrame
    timeseries: DataFrame
    countries: DataFrame
    hexes: DataFrame
    hex_monthly: DataFrame
    clear: DataFrame
    points: DataFrame
    hotspots: DataFrame
    layer: DataFrame
    summary: DataFrame
    unasked: DataFrame  # cells whose overpasses were never asked for


def build(det: DataFrame, overpass: DataFrame, meadows: DataFrame, zones: DataFrame | None, mids: DataFrame, p: Params,
          tolerance_m: float = 30.0, validate: bool = True, target_bytes: int = publish.TARGET_BYTES,
          requested: DataFrame | None = None) -> Published:
    """``det`` and ``overpass`` are the merged periods; see ``releases.merge_periods``, and ``partials.build_stored`` for a build
    that reads only what has changed.

    ``requested`` (cell) is what ``incremental.requested_cells`` has stored; without it the cells of ``overpass`` stand for it. Cells of
    the meadows that are not among them would count no clear overpass whatever was observed: a warning tells how many, and
    ``unasked`` which. Overpasses have to be ingested again after meadows or the buffer have changed.

    The fact table and the cell tables feed several outputs each and are materialised once.
    """
    dims = dimensions(meadows, zones, p)
    fact = cut_lineage(fact_table(det, dims.meadows, dims.zones, p, PUBLISHED))
    return published(counts_of(fact, det.select("month")), overpass, dims, meadows, zones, mids, p, tolerance_m, validate, target_bytes, requested)


def published(counts: Counts, overpass: DataFrame, dims: Dimensions, meadows: DataFrame, zones: DataFrame | None, mids: DataFrame, p: Params,
              tolerance_m: float, validate: bool, target_bytes: int, requested: DataFrame | None) -> Published:
    """All published tables from counts."""
    cells = dims.cells
    asked = requested if requested is not None else overpass.select(F.col("h3_id").alias("cell"))
    unasked = cut_lineage(pressure.missing_cells(cells, asked), "unasked")
    if (n := elements(unasked)) and not asked.isEmpty():
        warnings.warn(f"overpasses of {n} cells were never asked for; their clear overpasses will be 0", stacklevel=2)
    calendar = cut_lineage(pressure.calendar_union(counts.months, overpass))
    hexes = cut_lineage(pressure.hexes_of(counts.cells, cells, overpass, calendar))
    rows = cut_lineage(pressure.known_cell_months(counts.cells, hexes, calendar))
    clear = pressure.clear_matrix(hexes, overpass, calendar)
    totals, ais = pressure.fill_totals(counts.totals, calendar), pressure.ais_monthly_totals(rows, calendar)
    series = pressure.fill_series(counts.series, calendar)
    timeseries = publish.publish_timeseries(totals, ais)
    names = country_names(zones) if zones is not None else overpass.sparkSession.createDataFrame([], "iso3 string, name string")
    out = Published(
        meta=publish.meta_row(calendar, p), timeseries=timeseries,
        countries=publish.countries_of(series, names), hexes=publish.publish_hexes(hexes),
        hex_monthly=rows, clear=clear, points=publish.publish_points(counts.points, calendar, mids, p),
        hotspots=publish.publish_hotspots(ranking.hotspots(hexes, p.hotspots_n), p),
        layer=publish.sized_layer(meadows, tolerance_m, target_bytes)[0], summary=pressure.build_summary(totals, hexes), unasked=unasked)
    if validate:
        checks.enforce(
            checks.check_timeseries(timeseries, series, calendar), checks.check_hexes(hexes),
            checks.check_hex_monthly(rows, clear, hexes, calendar), checks.check_points(out.points, calendar, p),
            checks.check_polygons(out.layer), checks.check_totals_reconcile(ais, rows),
            checks.check_hotspots(publish.number_hotspots(out.hotspots), p))
    return out


TABLES = ("meta", "timeseries", "countries", "hexes", "hex_monthly", "clear", "points", "hotspots", "summary")


def write_published(out: Published, path: str, p: Params, chunk_rows: int = 100_000) -> None:
    """Write all tables beside ``path``, check the files written, and only then put them in place.

    Tables are parquet; cells, monthly cell counts (coded by cell and month position), clear overpasses, points, time series,
    countries and hotspots are columnar JSON as well, the parameters one JSON object, the meadows GeoJSON. ``running`` holds the running
    sums by month that ``selection.selection_between`` reads.
    """
    spark = out.hexes.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:8]}"
    for name in TABLES:
        getattr(out, name).write.parquet(f"{beside}/{name}")
    read = {name: spark.read.schema(getattr(out, name).schema).parquet(f"{beside}/{name}") for name in TABLES}
    cells = ranking.cell_index(read["hexes"])
    months = read["timeseries"].select("month")
    coded = {"hexes": (cells, "i"), "timeseries": (ranking.with_month_index(read["timeseries"], months), "m"),
             "hex_monthly": (_numbered(ranking.index_lookup(read["hex_monthly"], read["hexes"], months), "i", "m"), "row"),
             "clear": (_numbered(ranking.index_lookup(read["clear"], read["hexes"], months), "i", "m"), "row"),
             "points": (_numbered(read["points"], *read["points"].columns), "row"),
             "countries": (read["countries"], "position"), "hotspots": (publish.number_hotspots(read["hotspots"]), "position")}
    for name, (table, index) in coded.items():
        write_columnar_json(table, index, f"{beside}/{name}_json", chunk_rows)
    read["meta"].write.option("ignoreNullFields", "false").json(f"{beside}/meta_json")
    write_by_month(selection.running_sums(read["hex_monthly"], read["clear"].where("clear > 0"), months), f"{beside}/running")
    write_geojson(out.layer, f"{beside}/meadows")
    ais = read["timeseries"].select("month", *pressure.AIS_TOTALS)
    checks.enforce(
        checks.check_hexes(read["hexes"]), checks.check_hex_monthly(read["hex_monthly"], read["clear"], read["hexes"], months),
        checks.check_points(read["points"], months, p), checks.check_hotspots(publish.number_hotspots(read["hotspots"]), p),
        checks.check_totals_reconcile(ais, read["hex_monthly"]), checks.check_polygons(read_layer(spark, f"{beside}/meadows")),
        checks.check_timeseries(read["timeseries"], publish.series_of(read["countries"], months), months))
    replace_folder(spark, beside, path)


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """Rows with their position in the given order, as ``row``: numbered by range partition, partitions one after the other."""
    dealt = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    within = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = dealt.withColumn("_at", within).join(sizes.select("_part", before.alias("_before")), "_part")
    return rows.withColumn("row", F.col("_before") + F.col("_at") - 1).drop("_part", "_at", "_before")
