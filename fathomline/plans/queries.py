"""One query per operator over the benchmark tables, with its reference answer in SQL where SQL can give one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULTS as P
from ..functions import geo, predicates, scalars
from ..operators import checks, country, detections, pressure, publish, ranking, releases, selection, spatial
from ..runtime import cut_lineage, lean_writes, scratch_path
from ..schema import AIS_COUNTERS, COUNTERS, DETECTIONS, OVERPASSES, SEASONS
from ..sources import files
from ..streaming import incremental
from . import bindings as b
from . import build, partials
from . import oracle as o
from .bindings import Tables

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = o.sql(sql)
        return f
    return add


KEY = ["scene_id", "detect_timestamp", "lat", "lon"]
K = "scene_id, detect_timestamp, lat, lon"
HEX_COLS = ["cell", "country", "on_meadow", "large_on_meadow", "clear_overpasses", "density", "meadow_km2",
            *[p + s for s in SEASONS for p in ("", "large_", "clear_")], "peak_month"]
HEXES = ", ".join(HEX_COLS)
TOTALS = ["anchored_total", "anchored_on_meadow", "large_on_meadow", *pressure.AIS_TOTALS]


# ============================================================================================================ sources
CSV_EXTRA = ["matching_score_secondary", "ais_lat_before"]
CSV_HEADER = [CSV_EXTRA[0], *reversed(DETECTIONS.names), CSV_EXTRA[1]]
D1 = ", ".join(DETECTIONS.names)


def _write_detections_csv(t: Tables, df: DataFrame, path: str, mode: str = "overwrite", **how: str) -> None:
    """Detections as the source files have them: more columns than are read, another order, flags in capitals."""
    text = df.withColumns({
        CSV_EXTRA[0]: F.lit("0.5"), CSV_EXTRA[1]: F.col("lat").cast("string"),
        "likely_infrastructure": F.upper(F.col("likely_infrastructure").cast("string"))})
    (text.select(*CSV_HEADER).write.mode(mode).option("header", True).options(**how).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


@query("scan_detections_csv", f"SELECT {D1} FROM det")
def _(t):
    path = scratch_path(t.spark, "csv")
    _write_detections_csv(t, t.detections, path)
    return files.scan_detections_csv(t.spark, path)


def _periods(t: Tables) -> list[str]:
    return sorted(r["period"] for r in t.delivered_periods.collect())  # some twenty


#: how sources are compressed: quickly
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: rows that a task writes as files of a source
ROWS_PER_TASK = 2_000_000


def _dealt(rows: DataFrame, files_: int) -> DataFrame:
    """Rows in ``files_`` partitions, or in as many as their number asks for."""
    return rows.repartition(max(files_, -(-rows.count() // ROWS_PER_TASK)))


def _scanned(rows: DataFrame, files_: int) -> DataFrame:
    """Scanned rows in ``files_`` partitions, or about as many as their number asks for: those of the scan put together, and dealt out
    by a shuffle only where these are too few to keep all cores busy."""
    n, scanned = max(files_, -(-rows.count() // ROWS_PER_TASK)), rows.rdd.getNumPartitions()
    return rows.coalesce(n) if scanned >= max(files_, min(n, rows.sparkSession.sparkContext.defaultParallelism)) else _dealt(rows, files_)


def _write_by_period(t: Tables, path: str) -> None:
    """The delivered detections as two CSV files per period, or more of large tables."""
    rows = t.delivered.withColumns({CSV_EXTRA[0]: F.lit("0.5"), CSV_EXTRA[1]: F.col("lat").cast("string")})
    with lean_writes(t.spark):
        (_scanned(rows.select(*CSV_HEADER, "period"), 2).write.partitionBy("period").option("header", True).options(**GZIP)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


@query("ingest_detections", f"SELECT {K}, month, period FROM delivered WHERE {o.IN_BOX} AND period <> '1995'")
def _(t):
    # periods of several files, rows of other months in them, and a correction of 1995 that has no row in the study box
    src, out = scratch_path(t.spark, "csv"), scratch_path(t.spark, "detections")
    _write_by_period(t, src)
    files.ingest_detections(t.spark, {p: f"{src}/period={p}" for p in _periods(t)}, out, P)
    _write_detections_csv(t, t.delivered.where("period = '1995'").withColumn("lon", F.col("lon") + 100.0), f"{src}/again", **GZIP)
    files.ingest_detections(t.spark, {"1995": f"{src}/again"}, out, P)
    return files.read_stored(t.spark, out, DETECTIONS).select(*KEY, "month", "period")


@query("ingest_overpasses", """SELECT h3_id, month, overpasses, overpasses_cloud_under_20, substr(month, 1, 4) AS period FROM overpass
    WHERE h3_id IN (SELECT cell FROM wide_cells)""")
def _(t):
    src, out = scratch_path(t.spark, "csv"), scratch_path(t.spark, "overpass")
    rows = t.overpass_raw.withColumn("period", F.substring("month", 1, 4))
    years = [r[0] for r in rows.select("period").distinct().collect()]
    rows.select(F.lit("x").alias("extra"), *reversed(OVERPASSES.names), "period").write.partitionBy("period").option("header", True).csv(src)
    files.ingest_overpasses(t.spark, {y: f"{src}/period={y}" for y in years}, build.overpass_cells(t.cells), out)
    return files.read_stored(t.spark, out, OVERPASSES).select(*OVERPASSES.names, "period")


@query("read_partitions", f"SELECT {K}, month FROM det")
def _(t):
    out = scratch_path(t.spark, "detections")
    files.write_by_month(t.detections, out)
    return files.read_partitions(t.spark, out).select(*KEY, "month")


def _feature_texts(t) -> DataFrame:
    """One GeoJSON feature per supplier (s_suppkey, value), as polygons: a polygon, a multi-polygon where there are two overlapping meadows, every fifth
    a geometry collection of a point and the meadows, or (every sixth) only a point; every ninth lies outside the study box; one has no id."""
    rings = t.meadows.selectExpr("pid", "floor(pid/2) as s_suppkey", "transform(rings, r -> transform(r, v -> array(v.lon + case when floor(pid/2)%9 = 0 then 100e0 else 0e0 end, v.lat))) as c")
    parts = rings.groupBy("s_suppkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("pid", "c"))), lambda s: s.c).alias("parts"))
    multi = F.size("parts") > 1
    point = F.lit('{"type":"Point","coordinates":[1.0,40.0]}')
    single = lambda c: F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(c), F.lit("}"))
    own = F.when(multi, F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json("parts"), F.lit("}"))).otherwise(single(F.col("parts")[0]))
    members = F.when(multi, F.concat(single(F.col("parts")[0]), F.lit(","), single(F.get("parts", F.lit(1))))).otherwise(own)
    shape = F.when(F.expr("s_suppkey%6 = 3"), point).when(
        F.expr("s_suppkey%5 = 2"), F.concat(F.lit('{"type":"GeometryCollection","geometries":['), point, F.lit(","), members, F.lit("]}"))).otherwise(own)
    key = F.when(F.expr("s_suppkey = 4"), F.lit("")).otherwise(F.concat(F.lit('"objectid":'), F.col("s_suppkey").cast("string")))
    text = F.concat(F.lit('{"type":"Feature","properties":{'), key, F.lit('},"geometry":'), shape, F.lit("}"))
    return parts.select("s_suppkey", text.alias("value"))


_OBJECTID = T.StructType([T.StructField("objectid", T.LongType())])


def _features(t) -> DataFrame:
    """Polygons of the features, from files with one per line."""
    src = scratch_path(t.spark, "geojson")
    _feature_texts(t).select("value").write.text(src)
    features = files.read_geojson(t.spark, src, _OBJECTID, sequence=True)
    return cut_lineage(files.polygons_from_geojson(features, "objectid", P))


_KEPT = "s_suppkey%6 <> 3 AND s_suppkey%9 <> 0"


_VERTICES = f"""SELECT f.pid, f.objectid, r.part, r.ring, m.k, m.lon1 AS lon, m.lat1 AS lat FROM (
    SELECT s_suppkey, objectid, CAST(row_number() OVER (ORDER BY objectid NULLS LAST) - 1 AS INT) AS pid FROM (
      SELECT s_suppkey, CASE WHEN s_suppkey <> 4 THEN s_suppkey END AS objectid FROM supplier WHERE {_KEPT})) f
    JOIN (SELECT pid, ring AS own, pid // 2 AS s_suppkey, CAST(pid%2 AS INT) AS part, CAST(row_number() OVER (PARTITION BY pid // 2 ORDER BY pid, ring) - 1 AS INT) AS ring
      FROM (SELECT DISTINCT pid, ring FROM meadow_ring)) r USING (s_suppkey)
    JOIN meadow_ring m ON m.pid = r.pid AND m.ring = r.own"""


def _vertices(polygons: DataFrame) -> DataFrame:
    rings = polygons.select("pid", "objectid", F.posexplode(F.arrays_zip("rings", "parts")).alias("ring", "r"))
    vertices = rings.select("pid", "objectid", "ring", F.col("r.parts").alias("part"),
                            F.posexplode(F.slice("r.rings", F.lit(1), F.size("r.rings") - 1)).alias("k", "v"))  # the last repeats the first
    return vertices.select("pid", "objectid", "part", "ring", "k", "v.lon", "v.lat")


@query("polygons_from_geojson", _VERTICES)
def _(t):
    return _vertices(_features(t))


@query("polygons_from_collections", _VERTICES)
def _(t):
    """The same features from documents that are whole collections, each of a hundred suppliers, with members before and behind."""
    member = F.sort_array(F.collect_list(F.struct("s_suppkey", "value")))
    docs = _feature_texts(t).groupBy(F.expr("s_suppkey div 100").alias("doc")).agg(F.transform(member, lambda r: r.value).alias("f"))
    head = F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"a {\\"brace\\" }"}},"links":[{"type":"text"}], "features": [')
    src = scratch_path(t.spark, "collections")
    docs.select(F.concat(head, F.array_join("f", ", "), F.lit('],"note":"]}"}')).alias("value")).write.text(src)
    return _vertices(cut_lineage(files.polygons_from_geojson(files.read_geojson(t.spark, src, _OBJECTID), "objectid", P)))


@query("points_in_collections", f"""SELECT {K}, coalesce(on_meadow, false) AS on_meadow FROM det_xy
    LEFT JOIN (SELECT rid, bool_or(odd OR d2 < 400e0) AS on_meadow FROM (SELECT *, pid // 2 AS s_suppkey FROM det_hit) WHERE {_KEPT} GROUP BY rid) USING (rid)""")
def _(t):
    # overlapping members of a collection, or parts of a multi-polygon, count as their union
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    return spatial.points_in_polygons(t.detections.select(*KEY), build.index_meadows(_features(t), P), x, y, P.buffer_m, stored=True)


@query("sized_layer", f"""SELECT f.id, f.type, r.part, r.ring, count(*) + 1 AS vertices, CAST(sum(CAST(floor(m.lon1*1000 + 0.5e0) AS BIGINT)*(m.k%7 + 1)) AS BIGINT) AS lons,
    CAST(sum(CAST(floor(m.lat1*1000 + 0.5e0) AS BIGINT)*(m.k%7 + 1)) AS BIGINT) AS lats FROM (
    SELECT s_suppkey, CAST(row_number() OVER (ORDER BY CASE WHEN s_suppkey <> 4 THEN s_suppkey END NULLS LAST) - 1 AS INT) AS id,
      CASE WHEN {b.HAS_SECOND} THEN 'MultiPolygon' ELSE 'Polygon' END AS type FROM supplier WHERE {_KEPT}) f
    JOIN (SELECT pid, ring AS own, pid // 2 AS s_suppkey, CAST(pid%2 AS INT) AS part, CAST(row_number() OVER (PARTITION BY pid // 2 ORDER BY pid, ring) - 1 AS INT) AS ring
      FROM (SELECT DISTINCT pid, ring FROM meadow_ring)) r USING (s_suppkey)
    JOIN meadow_ring m ON m.pid = r.pid AND m.ring = r.own GROUP BY f.id, f.type, r.part, r.ring""")
def _(t):
    # outlines with three more vertices on every edge, some metres inwards: simplifying leaves the corners, in their parts and rings
    mid = lambda a, b, q: F.struct((a.lon + (b.lon - a.lon) * q).alias("lon"), (a.lat + (b.lat - a.lat) * q).alias("lat"))
    centre = lambda r: mid(F.get(r, F.lit(0)), F.get(r, F.floor(F.size(r) / 2).cast("int")), 0.5)
    inner = lambda r, i, q: mid(mid(F.get(r, i), F.get(r, i + 1), q / 4), centre(r), 0.003) if q else F.get(r, i)
    finer = lambda r: F.concat(F.flatten(F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda i: F.array(
        *[inner(r, i, q) for q in range(4)]))), F.slice(r, -1, 1))
    layer, _ = publish.sized_layer(_features(t).withColumn("rings", F.transform("rings", finer)), 30.0, decimals=9)
    rings = layer.select("id", "type", F.posexplode(F.arrays_zip("rings", "parts")).alias("ring", "r")).select(
        "id", "type", "ring", F.col("r.parts").alias("part"), F.size("r.rings").alias("vertices"), F.posexplode(F.slice("r.rings", F.lit(1), F.size("r.rings") - 1)).alias("nth", "v"))
    total = lambda c: F.sum(F.floor(F.col(f"v.{c}") * 1000 + 0.5) * (F.col("nth") % 7 + 1))
    return rings.groupBy("id", "type", "part", "ring").agg(F.max("vertices").cast("bigint").alias("vertices"), total("lon").alias("lons"), total("lat").alias("lats"))


@query("eez_normalise", "SELECT pid, mrgid, geoname, pol_type, iso3, name, priority FROM zones")
def _(t):
    return country.normalise_zones(t.raw_zones).select("pid", "mrgid", "geoname", "pol_type", "iso3", "name", "priority")


@query("write_columnar_json", """SELECT i // 100 AS chunk, count(*) AS rows, string_agg(cell, ',' ORDER BY i) AS cells,
    string_agg(CAST(on_meadow AS VARCHAR), ',' ORDER BY i) AS counts FROM hexes JOIN cidx USING (cell) GROUP BY i // 100""")
def _(t):
    out = scratch_path(t.spark, "json")
    files.write_columnar_json(ranking.cell_index(cut_lineage(t.hexes)), "i", out, chunk_rows=100)
    back = t.spark.read.schema("chunk bigint, cell array<string>, on_meadow array<bigint>").json(out)
    return back.select("chunk", F.size("cell").cast("bigint").alias("rows"), F.array_join("cell", ",").alias("cells"),
                       F.array_join(F.transform("on_meadow", lambda v: v.cast("string")), ",").alias("counts"))


_FLAG = """(SELECT f.*, m.iso2 AS flag FROM fact f LEFT JOIN mids m ON regexp_full_match(trim(f.mmsi), '[2-7][0-9]{8}') AND substr(trim(f.mmsi), 1, 3) = m.mid)"""
_POINTS = f"""SELECT round_even(lon, 5) AS lon, round_even(lat, 5) AS lat, m, round_even(CAST(length_m_inferred AS DOUBLE), 1) AS length_m, country,
    CAST(ais_matched AS INT) + CAST(ais_confident AS INT) + CAST(ais_stationary AS INT) AS ais_class,
    CASE WHEN ais_matched THEN floor(round(CAST(matching_confidence AS DOUBLE)*100, 4))/100 END AS ais_conf,
    CASE WHEN ais_confident THEN floor(round(ais_speed_kn*10, 5))/10 END AS ais_speed_kn,
    CASE WHEN ais_confident THEN CAST(round_even(CAST(ais_length_m AS DOUBLE)/5, 0)*5 AS BIGINT) END AS ais_length_m,
    CASE WHEN ais_confident THEN flag END AS ais_flag FROM {_FLAG} JOIN midx USING (month) WHERE on_meadow"""


@query("publish_points", _POINTS)
def _(t):
    return publish.publish_points(t.fact, t.calendar, t.mids, P)


@query("publish_timeseries", f"SELECT month, {', '.join(TOTALS)} FROM totals JOIN ais_totals USING (month)")
def _(t):
    return publish.publish_timeseries(t.totals, t.ais_totals)


_NAMES = """(SELECT iso3, CASE WHEN iso3 = 'UNK' THEN 'Unknown / outside EEZ' ELSE name END AS name FROM (SELECT iso3, name,
    row_number() OVER (PARTITION BY iso3 ORDER BY priority, name) AS rk FROM zones) WHERE rk = 1)"""


@query("publish_countries", f"""SELECT row_number() OVER (ORDER BY total DESC, country) AS position, country, coalesce(name, country) AS name, total, a AS counts, l AS large_counts FROM (
    SELECT country, CAST(sum(anchored_on_meadow) AS BIGINT) AS total, string_agg(CAST(anchored_on_meadow AS VARCHAR), ',' ORDER BY month) AS a,
    string_agg(CAST(large_on_meadow AS VARCHAR), ',' ORDER BY month) AS l FROM series GROUP BY country) LEFT JOIN {_NAMES} ON iso3 = country""")
def _(t):
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    out = publish.publish_countries(t.fact, t.calendar, scalars.country_names(t.zones))
    return out.select(F.col("position").cast("bigint").alias("position"), "country", "name", "total",
                      text("anchored_on_meadow").alias("counts"), text("large_on_meadow").alias("large_counts"))


@query("publish_hotspots", f"""SELECT cell, round_even({o.lonlat('x', 'y')[0]}, 5) AS lon, round_even({o.lonlat('x', 'y')[1]}, 5) AS lat, country,
    CAST(NULL AS VARCHAR) AS place, on_meadow, large_on_meadow, round_even(density, 4) AS density, peak_month
    FROM hot JOIN cell_point USING (cell) WHERE position <= 50""".replace("cell, round_even", "hot.cell, round_even", 1))
def _(t):
    return publish.publish_hotspots(ranking.hotspots(t.hexes, P.hotspots_n), P)


_TOL = 300.0


_THIN = f"""(SELECT *, count(*) FILTER (WHERE fresh) OVER (PARTITION BY pid, ring) >= 4 AS thin FROM (
    SELECT *, pgx IS NULL OR pgx <> gx OR pgy <> gy AS fresh FROM (
    SELECT *, lag(gx) OVER w AS pgx, lag(gy) OVER w AS pgy FROM (SELECT pid, ring, k, x, y, floor(x/{_TOL} + 0.5e0) AS gx, floor(y/{_TOL} + 0.5e0) AS gy FROM (
      SELECT pid, ring, k, {o.metric('lon', 'lat')[0]} AS x, {o.metric('lon', 'lat')[1]} AS y FROM (
        SELECT pid, ring, k, lon1 AS lon, lat1 AS lat FROM meadow_ring UNION ALL
        SELECT pid, ring, (SELECT max(k) FROM meadow_ring q WHERE q.pid = p.pid AND q.ring = p.ring) + 1, lon1, lat1 FROM meadow_ring p WHERE k = 0)))
    WINDOW w AS (PARTITION BY pid, ring ORDER BY k))))"""


@query("polygon_display_layer", f"""SELECT pid AS id, CAST(ring AS INT) AS ring, count(*) AS vertices, CAST(sum(CAST(floor(lon*1000 + 0.5e0) AS BIGINT)*(nth%7 + 1)) AS BIGINT) AS lons,
    CAST(sum(CAST(floor(lat*1000 + 0.5e0) AS BIGINT)*(nth%7 + 1)) AS BIGINT) AS lats FROM (
    SELECT pid, dense_rank() OVER (PARTITION BY pid ORDER BY ring) - 1 AS ring, row_number() OVER (PARTITION BY pid, ring ORDER BY k) - 1 AS nth, {o.lonlat('vx', 'vy')[0]} AS lon, {o.lonlat('vx', 'vy')[1]} AS lat FROM (
    SELECT pid, ring, k, CASE WHEN thin THEN gx*{_TOL} ELSE x END AS vx, CASE WHEN thin THEN gy*{_TOL} ELSE y END AS vy FROM {_THIN} WHERE fresh OR NOT thin)) GROUP BY pid, ring""")
def _(t):
    # the layer itself, ring by ring: vertices in order enter sums of whole thousandths of a degree
    rings = publish.polygon_display_layer(t.meadows, _TOL, decimals=9).select("id", F.posexplode("rings").alias("ring", "r"))
    v = rings.select("id", "ring", F.posexplode("r").alias("nth", "v"))
    part = lambda c: F.sum(F.floor(F.col(f"v.{c}") * 1000 + 0.5) * (F.col("nth") % 7 + 1))
    return v.groupBy("id", "ring").agg(F.count(F.lit(1)).alias("vertices"), part("lon").alias("lons"), part("lat").alias("lats"))


@query("incremental_ingest", f"SELECT {K}, month, period FROM delivered WHERE {o.IN_BOX} AND period <> '1995'")
def _(t):
    inbox, out, state = (scratch_path(t.spark, n) for n in ("inbox", "stored", "seen"))
    stored = lambda: incremental.ingest_new_detections(t.spark, inbox, out, state, P)
    rows = t.delivered.withColumns({CSV_EXTRA[0]: F.lit("0.5"), CSV_EXTRA[1]: F.col("lat").cast("string")})
    _by_release(_scanned(rows, 3), CSV_HEADER, inbox, "2026-03-01_300")
    for _run in range(2):  # the second run finds nothing new
        stored()
    # a correction without a row in the study box, in another column order; and an old upload that comes late
    _by_release(rows.where("period = '1995'").withColumn("lon", F.col("lon") + 100.0), sorted(CSV_HEADER), inbox, "2026-04-01_400")
    _by_release(rows.where("period = '1996'").limit(3), CSV_HEADER, inbox, "2025-01-01_100")
    stored()
    return files.read_stored(t.spark, f"{out}/detections", DETECTIONS).select(*KEY, "month", "period")


def _by_release(rows: DataFrame, header: list[str], path: str, upload: str) -> None:
    """One folder per period below ``path``, with as many files as ``rows`` has tasks."""
    with lean_writes(rows.sparkSession):
        (rows.select(*header, F.concat(F.lit(f"{upload}_release_"), "period").alias("release")).write.mode("append")
         .partitionBy("release").option("header", True).options(**GZIP).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))


@query("ledger_round_trip", f"""SELECT {K}, month, period FROM delivered WHERE {o.IN_BOX} AND period IN (SELECT period FROM to_fetch) AND
    ((length(period) = 6 AND month = substr(period, 1, 4) || '-' || substr(period, 5, 2))
    OR (length(period) = 4 AND month NOT IN (SELECT substr(period, 1, 4) || '-' || substr(period, 5, 2) FROM to_fetch WHERE length(period) = 6)))""")
def _(t):
    """Records, what to fetch, ingestion, the ledger it leaves, the periods a build may read, and their rows."""
    src, out = scratch_path(t.spark, "csv"), scratch_path(t.spark, "stored")
    empty = releases.ledger(t.spark, f"{out}/ledger")
    fetch = releases.releases_to_fetch(t.latest, empty, P).collect()  # some twenty
    stored = set(_periods(t))
    _write_by_period(t, src)
    todo = [r for r in fetch if r["period"] in stored]
    uploads = [incremental.Upload(r["published"], r["record_id"], 0.0, r["period"], f"{src}/period={r['period']}") for r in todo]
    incremental.store_detections(t.spark, uploads, out, P)
    # the overpasses of these periods are one and the same file
    _dealt(t.overpass_raw.select(*OVERPASSES.names), 2).write.option("header", True).options(**GZIP).csv(f"{src}/overpass")
    incremental.store_overpasses(t.spark, [replace(u, path=f"{src}/overpass") for u in uploads], t.cells, out)
    ledger = releases.ledger(t.spark, f"{out}/ledger")
    if releases.releases_to_fetch(t.latest.where(F.col("period").isin(sorted(stored))), ledger, P).count():
        raise AssertionError("what was ingested is asked for again")
    own = files.read_stored(t.spark, f"{out}/detections", DETECTIONS).groupBy("period").count()
    if ledger.join(own, "period", "full").where("coalesce(detections_rows, -1) <> coalesce(count, 0)").count():
        raise AssertionError("the ledger does not tell the rows that are stored")
    rows = files.read_stored(t.spark, f"{out}/detections", DETECTIONS)
    return releases.merge_periods(rows, releases.usable_periods(ledger, P)).select(*KEY, "month", "period")


# ========================================================================================================= predicates
@query("bbox_filter", f"SELECT {K} FROM det WHERE {o.IN_BOX}")
def _(t):
    return t.detections.where(predicates.in_box(F.col("lon"), F.col("lat"), P.bbox)).select(*KEY)


@query("region_mask", f"SELECT {K} FROM det WHERE {o.IN_REGION}")
def _(t):
    return t.detections.where(predicates.in_region(F.col("lon"), F.col("lat"), P)).select(*KEY)


@query("quality_mask", f"SELECT {K} FROM det WHERE {o.QUALITY}")
def _(t):
    return t.detections.where(predicates.score_rules(P)).select(*KEY)


@query("flag_filter", f"SELECT {K} FROM det WHERE {o.FLAGS}")
def _(t):
    return t.detections.where(predicates.flag_rules(t.detections, P)).select(*KEY)


@query("anchored", f"SELECT {K} FROM det WHERE {o.SLOW} AND {o.QUALITY} AND {o.FLAGS}")
def _(t):
    return t.detections.where(predicates.anchored(t.detections, P)).select(*KEY)


@query("large", f"SELECT {K}, coalesce(length_m_inferred >= 24e0, false) AS large FROM det")
def _(t):
    return t.detections.select(*KEY, predicates.is_large(P).alias("large"))


@query("ais_matched", f"SELECT {K}, {o.MATCHED} AS ais_matched FROM det")
def _(t):
    return t.detections.select(*KEY, predicates.has_mmsi(t.detections).alias("ais_matched"))


@query("ais_fields", f"SELECT {K}, ais_matched, ais_speed_kn, ais_confident, ais_stationary, ais_moving FROM {o.ais('det')}")
def _(t):
    return predicates.with_ais(t.detections, P).select(
        *KEY, "ais_matched", "ais_speed_kn", "ais_confident", "ais_stationary", "ais_moving")


@query("classify", f"SELECT {K}, on_meadow, large, ais_matched, ais_confident, ais_stationary, ais_moving, cell FROM classified")
def _(t):
    return detections.classify(t.detections, t.meadow_index, P).select(
        *KEY, "on_meadow", "large", "ais_matched", "ais_confident", "ais_stationary", "ais_moving", "cell")


@query("month_filter", f"SELECT {K}, month FROM det WHERE {o.season('month')} = 'JJA'")
def _(t):
    summer = t.calendar.where(scalars.season_of(F.col("month")) == "JJA")
    return pressure.month_filter(t.detections, summer).select(*KEY, "month")


@query("point_filter", f"""SELECT lon, lat, m, length_m, ais_class FROM ({_POINTS}) WHERE m IN (SELECT m FROM midx WHERE {o.season('month')} = 'JJA')
    AND length_m < 24e0 AND ais_class = 3""")
def _(t):
    cal = selection.month_calendar(t.calendar)
    points = publish.publish_points(t.fact, t.calendar, t.mids, P)
    out = selection.point_filter(points, selection.select_months(cal, season="JJA"), P.large_length_m, large=False, boats="ais_st")
    return out.select("lon", "lat", "m", "length_m", "ais_class")


# ============================================================================================================== joins
@query("points_in_polygons", f"""SELECT {K}, coalesce(on_meadow, false) AS on_meadow FROM det_xy
    LEFT JOIN (SELECT rid, bool_or(odd OR d2 < 400e0) AS on_meadow FROM det_hit GROUP BY rid) USING (rid)""")
def _(t):
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    return spatial.points_in_polygons(t.detections.select(*KEY), t.meadow_index, x, y, P.buffer_m, stored=True)


@query("cell_fact_left_join", """SELECT cell, country, coalesce(on_meadow, 0) AS on_meadow, coalesce(large_on_meadow, 0) AS large_on_meadow
    FROM cells LEFT JOIN cell_sum USING (cell)""")
def _(t):
    counts = pressure.cell_counts(t.fact, t.calendar)
    joined = t.cells.select("cell", "country").join(counts, "cell", "left")
    return pressure.zeros(joined, "on_meadow", "large_on_meadow")


def _old_cells(t: Tables) -> DataFrame:
    """A cell table from a coarser survey, which misses the cells with little meadow."""
    return t.cells.where("meadow_km2 > 0.505")


@query("unknown_cells", """SELECT DISTINCT cell, 'UNK' AS country, 0e0 AS meadow_km2 FROM cell_month WHERE cell NOT IN (SELECT cell FROM old_cells)""")
def _(t):
    return pressure.unknown_cells(pressure.cell_months(t.fact), _old_cells(t))


@query("assign_country", f"SELECT {K}, country FROM anch JOIN anch_zone USING (rid)")
def _(t):
    rows = detections.anchored_in_region(t.detections, P)
    return country.assign_country(rows, t.zone_index, F.col("lon"), F.col("lat"), P).select(*KEY, "country")


@query("overpass_semi", """SELECT h3_id, month, overpasses, overpasses_cloud_under_20 FROM overpass WHERE h3_id IN (SELECT cell FROM cells)
    AND month IN (SELECT month FROM cal)""")
def _(t):
    return pressure.overpass_semi(t.overpass, t.cells, t.calendar).select(*OVERPASSES.names)


@query("index_lookup", f"SELECT i, m, {', '.join(COUNTERS)} FROM hexm JOIN cidx USING (cell) JOIN midx USING (month)")
def _(t):
    return ranking.index_lookup(t.rows, t.cells, t.calendar)


@query("flag_lookup", """SELECT scene_id, detect_timestamp, lat, lon, mmsi, iso2 AS flag FROM det LEFT JOIN mids
    ON regexp_full_match(trim(mmsi), '[2-7][0-9]{8}') AND substr(trim(mmsi), 1, 3) = mid""")
def _(t):
    return publish.flag_lookup(t.detections, t.mids).select(*KEY, "mmsi", "flag")


@query("month_precedence_anti", f"""SELECT {K}, month, period FROM delivered WHERE length(period) = 4 AND month NOT IN (SELECT mm FROM monthly_months)""")
def _(t):
    return releases.months_without_monthly(t.delivered, t.delivered_periods).select(*KEY, "month", "period")


@query("missing_cells_check", "SELECT cell FROM cells WHERE cell NOT IN (SELECT h3_id FROM overpass)")
def _(t):
    return pressure.missing_cells(t.cells, t.overpass.select(F.col("h3_id").alias("cell")))


@query("cells_touching_polygons", "SELECT cell FROM cell_touch")
def _(t):
    edges = spatial.planar_edges(spatial.polygon_edges(t.meadows))
    return spatial.cells_touching_polygons(edges, t.meadow_index, P.buffer_m)


# ======================================================================================================= aggregations
@query("monthly_totals", "SELECT month, anchored_total, anchored_on_meadow, large_on_meadow FROM totals")
def _(t):
    return t.totals


@query("ais_monthly_totals", f"SELECT month, {', '.join(pressure.AIS_TOTALS)} FROM ais_totals")
def _(t):
    return t.ais_totals


@query("country_series", "SELECT country, month, anchored_on_meadow, large_on_meadow FROM series")
def _(t):
    return t.series


@query("cell_counts", "SELECT cell, on_meadow, large_on_meadow FROM cell_sum")
def _(t):
    return pressure.cell_counts(t.fact, t.calendar)


@query("clear_overpasses", "SELECT cell, clear_overpasses FROM seasons_clear")
def _(t):
    return pressure.clear_overpasses(t.overpass, t.calendar)


@query("density", "SELECT cell, on_meadow, clear_overpasses, density FROM hexes")
def _(t):
    counts, clear = pressure.cell_counts(t.fact, t.calendar), pressure.clear_overpasses(t.overpass, t.calendar)
    rows = pressure.zeros(t.cells.select("cell").join(counts, "cell", "left").join(clear, "cell", "left"), "on_meadow", "clear_overpasses")
    return rows.select("cell", "on_meadow", "clear_overpasses",
                       pressure.density(F.col("on_meadow"), F.col("clear_overpasses")).alias("density"))


_PIVOT = [p + s for p in ("", "large_", "clear_") for s in SEASONS]


@query("season_pivot", f"SELECT cell, {', '.join(_PIVOT)} FROM hexes")
def _(t):
    return pressure.season_pivot(t.fact, t.overpass, t.cells, t.calendar)


@query("peak_month", "SELECT cell, peak_month FROM peak")
def _(t):
    return pressure.peak_months(pressure.month_filter(pressure.cell_months(t.fact), t.calendar))


@query("aggregate_hexes", f"SELECT {HEXES} FROM hexes")
def _(t):
    return pressure.aggregate_hexes(t.fact, t.cells, t.overpass, t.calendar)


@query("aggregate_hexes_old_cells", f"SELECT {HEXES} FROM ({o.hexes_of('old_cells')})")
def _(t):
    # with a cell table that lacks some cells, so that unknown ones are appended
    return pressure.aggregate_hexes(t.fact, _old_cells(t), t.overpass, t.calendar)


@query("hex_monthly", f"SELECT cell, month, {', '.join(COUNTERS)} FROM hexm")
def _(t):
    return t.rows


@cache
def _stored_months(t: Tables) -> tuple[str, build.Dimensions]:
    """Detections stored by year until 1997 and by month since, one year of them wrong; their months kept; the year corrected."""
    out = scratch_path(t.spark, "stored")
    period = F.when(F.substring("month", 1, 4) <= "1997", F.substring("month", 1, 4)).otherwise(F.replace("month", F.lit("-"), F.lit("")))
    src = scratch_path(t.spark, "periods")
    files.write_by_month(t.detections.withColumn("period", period), src, ("period",))  # read by period below
    rows = files.read_partitions(t.spark, src)
    periods = cut_lineage(rows.select("period").distinct(), "names")
    dims = build.Dimensions(t.meadow_index, t.zone_index, t.cells)
    wrong, path = {"1996"}, f"{out}/detections"
    first = {r["period"]: rows.where(F.col("period") == r["period"]) for r in periods.collect()}  # some twenty
    first |= {p: rows.where(F.col("period") == p).withColumn("lat", F.col("lat") + 0.004) for p in wrong}
    files.publish_versions(t.spark, path, {p: files.write_version(r, path, p) for p, r in first.items()})
    partials.refresh(t.spark, out, periods, t.meadows, t.zones, dims, P)
    files.publish_versions(t.spark, path, {p: files.write_version(rows.where(F.col("period") == p), path, p) for p in wrong})
    again = partials.refresh(t.spark, out, periods, t.meadows, t.zones, dims, P)
    if {m[:4] for m in again} != wrong or partials.refresh(t.spark, out, periods, t.meadows, t.zones, dims, P):
        raise AssertionError(f"months made again: {again}")
    return out, dims


@query("stored_hex_monthly", f"SELECT cell, month, {', '.join(COUNTERS)} FROM hexm")
def _(t):
    out, dims = _stored_months(t)
    return pressure.known_cell_months(partials.kept_counts(t.spark, out).cells, dims.cells, t.calendar)


@query("stored_totals", """SELECT 'all' AS country, month, anchored_total, anchored_on_meadow, large_on_meadow FROM totals
    UNION ALL SELECT country, month, NULL, anchored_on_meadow, large_on_meadow FROM series""")
def _(t):
    kept = partials.kept_counts(t.spark, _stored_months(t)[0])
    totals = pressure.fill_totals(kept.totals, t.calendar).withColumn("country", F.lit("all"))
    return totals.unionByName(pressure.fill_series(kept.series, t.calendar), allowMissingColumns=True)


@query("clear_matrix", "SELECT cell, month, clear FROM clear_dense")
def _(t):
    return t.clear


@query("cell_area", "SELECT cell, hits, meadow_km2 FROM cell_area")
def _(t):
    return spatial.cell_area(t.meadow_index)


@query("build_summary", """SELECT count(*) AS months, CAST(sum(anchored_total) AS BIGINT) AS anchored_total, CAST(sum(anchored_on_meadow) AS BIGINT) AS anchored_on_meadow,
    CAST(sum(large_on_meadow) AS BIGINT) AS large_on_meadow, (SELECT count(*) FROM hexes) AS hexes, (SELECT count(*) FROM hexes WHERE on_meadow > 0) AS hexes_with_detections FROM totals""")
def _(t):
    return pressure.build_summary(t.totals, t.hexes)


@query("ais_check", """SELECT matched, stationary, moving, matched - stationary - moving AS no_speed, CAST(floor(100*stationary/CAST(matched AS DOUBLE) + 0.5e0) AS BIGINT) AS stationary_pct,
    CAST(floor(100*moving/CAST(matched AS DOUBLE) + 0.5e0) AS BIGINT) AS moving_pct,
    CASE WHEN moving > 0 THEN CAST(floor(100*moving/CAST(stationary + moving AS DOUBLE) + 0.5e0) AS BIGINT) ELSE 0 END AS moving_of_checked_pct FROM (
    SELECT matched, stationary, least(mv, matched - stationary) AS moving FROM (SELECT matched, least(st, matched) AS stationary, mv FROM (
    SELECT CAST(sum(ais_matched_on_meadow) AS BIGINT) AS matched, CAST(sum(ais_stationary_on_meadow) AS BIGINT) AS st, CAST(sum(ais_moving_on_meadow) AS BIGINT) AS mv FROM ais_totals))) WHERE matched > 0""")
def _(t):
    return pressure.ais_check(t.ais_totals)


@query("country_totals", """SELECT country, CAST(sum(anchored_on_meadow) AS BIGINT) AS total, CAST(sum(large_on_meadow) AS BIGINT) AS large FROM series
    GROUP BY country HAVING sum(anchored_on_meadow) > 0""")
def _(t):
    return pressure.country_totals(t.series)


def _selected(first: str, last: str, seasons: str, on: str, large: str) -> str:
    months = f"(SELECT month FROM calendar WHERE idx >= 0 AND month BETWEEN '{first}' AND '{last}' AND {o.season('month')} IN ({seasons}))"
    return f"""SELECT k.cell, coalesce(n, 0) AS on_meadow, coalesce(l, 0) AS large_on_meadow,
    CASE WHEN coalesce(c, 0) > 0 THEN coalesce(n, 0)/CAST(c AS DOUBLE) END AS density FROM cells k
    LEFT JOIN (SELECT cell, CAST(sum({on}) AS BIGINT) AS n, CAST(sum({large}) AS BIGINT) AS l FROM hexm WHERE month IN {months} GROUP BY cell) USING (cell)
    LEFT JOIN (SELECT cell, CAST(sum(clear) AS BIGINT) AS c FROM clear_dense WHERE month IN {months} GROUP BY cell) USING (cell)"""


_SELECTED = _selected("1997-03", "2000-10", "'JJA'", "ais", "ais_large")


def _known_calendar(t: Tables) -> DataFrame:
    """Calendar over the months that releases supply; one month among the monthly ones was never released."""
    annual = t.latest.where("length(period) = 4").select(F.explode(scalars.period_months(F.col("period"))).alias("month")).where("month < '1998-01'")
    return selection.month_calendar(annual.unionByName(releases.monthly_months(t.latest)).distinct())


@query("selection_aggregate", _SELECTED)
def _(t):
    chosen = selection.select_months(_known_calendar(t), "1997-03", "2000-10", "JJA")
    return selection.selection_aggregate(t.rows, pressure.clear_months(t.overpass, t.calendar), t.cells, chosen, "ais")


@query("selection_between", f"""SELECT 1 AS asked, * FROM ({_SELECTED}) UNION ALL
    SELECT 2 AS asked, * FROM ({_selected('1993-02', '1998-05', "'DJF', 'MAM', 'JJA', 'SON'", 'n', 'large')})""")
def _(t):
    months = _known_calendar(t).where("idx >= 0")
    path = scratch_path(t.spark, "sums")
    files.write_by_month(selection.running_sums(t.rows, pressure.clear_months(t.overpass, t.calendar), months), path)
    sums = files.read_partitions(t.spark, path)
    asked = [("1997-03", "2000-10", "JJA", "ais"), ("1993-02", "1998-05", None, "all")]
    one, two = (selection.selection_between(sums, t.cells, months, *a).withColumn("asked", F.lit(i + 1)) for i, a in enumerate(asked))
    return one.unionByName(two)


@query("pressure_rollup", """SELECT CASE WHEN grouping(month) = 1 THEN 'cell' WHEN grouping(country) = 0 THEN 'country_month' WHEN grouping(cell) = 0 THEN 'cell_month' ELSE 'month' END AS grain,
    country, cell, month, count(*) AS on_meadow, count(*) FILTER (WHERE large) AS large_on_meadow FROM fact WHERE on_meadow
    GROUP BY GROUPING SETS ((month), (country, month), (cell, month), (cell))""")
def _(t):
    return pressure.pressure_rollup(t.fact)


_BAND = "CASE WHEN kn < 1e0 THEN 'below 1' WHEN kn < 5e0 THEN '1 to 5' ELSE '5 and more' END"


@query("ais_speed_bands", f"""SELECT large, band, n, n/CAST(sum(n) OVER (PARTITION BY large) AS DOUBLE) AS share, median_kn FROM (
    SELECT large, {_BAND} AS band, count(*) AS n FROM (SELECT large, round(ais_speed_kn, 6) AS kn FROM fact WHERE on_meadow AND ais_confident AND ais_speed_kn IS NOT NULL) GROUP BY ALL)
    JOIN (SELECT large, quantile_cont(round(ais_speed_kn, 6), 0.5) AS median_kn FROM fact WHERE on_meadow AND ais_confident AND ais_speed_kn IS NOT NULL GROUP BY large) USING (large)""")
def _(t):
    return pressure.ais_speed_bands(t.fact)


# ============================================================================================================ windows
@query("dedupe_detections", f"SELECT {K}, mmsi, matching_confidence, length_m_inferred FROM deduped")
def _(t):
    return detections.dedupe_detections(t.detections).select(*KEY, "mmsi", "matching_confidence", "length_m_inferred")


_REL = "record_id, period, title, published, detections_url, detections_name, detections_size, overpass_url, overpass_name, overpass_size"


@query("latest_release_per_period", f"SELECT {_REL} FROM latest")
def _(t):
    return t.latest


@query("hotspot_rank_in_country", """SELECT cell, country, on_meadow, CAST(row_number() OVER (PARTITION BY country ORDER BY position) AS INT) AS nth FROM hot WHERE position <= 50""")
def _(t):
    return ranking.rank_in_country(ranking.hotspots(t.hexes, P.hotspots_n)).select("cell", "country", "on_meadow", "nth")


@query("cell_index", "SELECT cell, i FROM cidx")
def _(t):
    return ranking.cell_index(t.cells.select("cell")).select("cell", "i")


@query("month_index", "SELECT month, m FROM midx")
def _(t):
    return ranking.with_month_index(t.calendar, t.calendar)


@query("best_polygon", f"SELECT {K}, iso3 FROM deduped_in")
def _(t):
    rows = detections.dedupe_detections(t.detections)
    return country.zones_at(rows, t.zone_index, F.col("lon"), F.col("lat"), "iso3").select(*KEY, "iso3")


@query("consecutive_vertex", "SELECT pid, ring, k, lon1, lat1, lon2, lat2 FROM meadow_ring")
def _(t):
    return spatial.consecutive_vertices(publish.closed_vertices(t.meadows))


# ============================================================================================================ ranking
@query("hotspots", "SELECT cell, country, on_meadow, large_on_meadow, density, peak_month FROM hot WHERE position <= 50")
def _(t):
    return ranking.hotspots(t.hexes, P.hotspots_n).select("cell", "country", "on_meadow", "large_on_meadow", "density", "peak_month")


@query("points_most_recent", f"SELECT {K}, month FROM fact WHERE on_meadow ORDER BY detect_timestamp DESC, lon, lat, scene_id LIMIT 500")
def _(t):
    return ranking.points_most_recent(t.fact, t.calendar, 500).select(*KEY, "month")


@query("sorted_cells", "SELECT cell, country, on_meadow FROM hexes ORDER BY cell")
def _(t):
    return t.hexes.orderBy("cell").select("cell", "country", "on_meadow")


@query("sorted_rows", f"SELECT i, m, {', '.join(COUNTERS)} FROM hexm JOIN cidx USING (cell) JOIN midx USING (month) ORDER BY i, m")
def _(t):
    return ranking.index_lookup(t.rows, t.cells, t.calendar).orderBy("i", "m")


@query("country_order", "SELECT country, CAST(sum(anchored_on_meadow) AS BIGINT) AS total FROM series GROUP BY country ORDER BY 2 DESC, 1")
def _(t):
    return ranking.country_order(t.series)


def _breaks_sql(source: str, is_count: bool) -> str:
    tidy = "greatest(1e0, ceil(v))" if is_count else "round(v*pow(10e0, 1 - floor(log10(v))))/pow(10e0, 1 - floor(log10(v)))"
    picks = " UNION ALL ".join(f"SELECT least(n - 1, CAST(floor({q}*n) AS BIGINT)) AS at FROM (SELECT count(*) AS n FROM pos)" for q in ("0.2e0", "0.4e0", "0.6e0", "0.8e0"))
    return f"""(WITH pos AS (SELECT CAST(v AS DOUBLE) AS v, row_number() OVER (ORDER BY v) - 1 AS k FROM {source} WHERE v > 0)
        SELECT DISTINCT brk FROM (SELECT {tidy} AS brk FROM pos WHERE k IN ({picks}))
        WHERE brk > (SELECT min(v) FROM pos) AND brk <= (SELECT max(v) FROM pos))"""


@query("quantile_breaks", f"""SELECT 'count' AS metric, brk FROM {_breaks_sql('(SELECT on_meadow AS v FROM hexes)', True)} UNION ALL
    SELECT 'density', brk FROM {_breaks_sql('(SELECT density AS v FROM hexes)', False)}""")
def _(t):
    hexes = cut_lineage(t.hexes.select("on_meadow", "density"))
    parts = [ranking.quantile_breaks(hexes, c, n == "count").select(F.lit(n).alias("metric"), F.explode("breaks").alias("brk"))
             for n, c in (("count", "on_meadow"), ("density", "density"))]
    return parts[0].unionByName(parts[1])


@query("class_of", f"""SELECT cell, on_meadow, CAST(CASE WHEN on_meadow > 0 THEN (SELECT count(*) FROM {_breaks_sql('(SELECT on_meadow AS v FROM hexes)', True)} WHERE brk <= on_meadow)
    ELSE -1 END AS INT) AS class FROM hexes""")
def _(t):
    hexes = cut_lineage(t.hexes.select("cell", "on_meadow"))
    return ranking.class_of(hexes, "on_meadow", ranking.quantile_breaks(hexes, "on_meadow", True))


# =========================================================================================================== set ops
@query("merge_periods", f"""SELECT {K}, month, period FROM delivered WHERE (length(period) = 6 AND month = substr(period, 1, 4) || '-' || substr(period, 5, 2))
    OR (length(period) = 4 AND month NOT IN (SELECT mm FROM monthly_months))""")
def _(t):
    return releases.merge_periods(t.delivered, t.delivered_periods).select(*KEY, "month", "period")


@query("calendar_union", "SELECT month FROM cal")
def _(t):
    return t.calendar


@query("cells_difference", "SELECT cell FROM cells EXCEPT SELECT h3_id FROM overpass")
def _(t):
    return t.cells.select("cell").exceptAll(t.overpass.select(F.col("h3_id").alias("cell")).distinct())


@query("neighbour_expand", "SELECT cell FROM wide_cells")
def _(t):
    return build.overpass_cells(t.cells)


# ============================================================================================================ scalars
@query("month_of", f"SELECT {K}, substr(detect_timestamp, 1, 7) AS month FROM det")
def _(t):
    return t.detections.select(*KEY, scalars.month_of(F.col("detect_timestamp")).alias("month"))


@query("season_of", f"SELECT {K}, {o.season('month')} AS season FROM det")
def _(t):
    return t.detections.select(*KEY, scalars.season_of(F.col("month")).alias("season"))


@query("widened", f"SELECT {K}, round(CAST(matching_confidence AS DOUBLE), 6) AS confidence, round(CAST(ais_speed_kn_before AS DOUBLE), 6) AS speed FROM det")
def _(t):
    return t.detections.select(*KEY, scalars.widened(F.col("matching_confidence")).alias("confidence"),
                               scalars.widened(F.col("ais_speed_kn_before")).alias("speed"))


@query("num", f"SELECT {K}, round_even(lon, 5) AS lon5, round_even(CAST(length_m_inferred AS DOUBLE), 1) AS length1, CAST(round_even(CAST(cloud_score AS DOUBLE)*10, 0) AS BIGINT) AS cloud0 FROM det")
def _(t):
    return t.detections.select(
        *KEY, scalars.num(F.col("lon"), 5).alias("lon5"), scalars.num(F.col("length_m_inferred"), 1).alias("length1"),
        scalars.num(F.col("cloud_score").cast("double") * 10, 0).alias("cloud0"))


@query("floor_nd", f"SELECT {K}, floor(round(CAST(matching_confidence AS DOUBLE)*100, 4))/100 AS conf2, floor(round(CAST(ais_speed_kn_before AS DOUBLE)*10, 5))/10 AS speed1 FROM det")
def _(t):
    return t.detections.select(*KEY, scalars.floor_nd(F.col("matching_confidence"), 2).alias("conf2"),
                               scalars.floor_nd(F.col("ais_speed_kn_before"), 1).alias("speed1"))


@query("step_round", f"SELECT {K}, CAST(round_even(CAST(ais_length_m AS DOUBLE)/5, 0)*5 AS BIGINT) AS length5 FROM det")
def _(t):
    return t.detections.select(*KEY, scalars.step_round(F.col("ais_length_m"), 5).alias("length5"))


@query("ais_class", f"SELECT {K}, CAST(ais_matched AS INT) + CAST(ais_confident AS INT) + CAST(ais_stationary AS INT) AS ais_class FROM {o.ais('det')}")
def _(t):
    return predicates.with_ais(t.detections, P).select(
        *KEY, scalars.ais_class(F.col("ais_matched"), F.col("ais_confident"), F.col("ais_stationary")).alias("ais_class"))


@query("publish_mask", f"SELECT ais_class, ais_conf, ais_speed_kn, ais_length_m, ais_flag, count(*) AS n FROM ({_POINTS}) GROUP BY ALL")
def _(t):
    return publish.publish_points(t.fact, t.calendar, t.mids, P).groupBy(
        "ais_class", "ais_conf", "ais_speed_kn", "ais_length_m", "ais_flag").agg(F.count(F.lit(1)).alias("n"))


@query("country_names", f"SELECT iso3, name FROM {_NAMES}")
def _(t):
    return scalars.country_names(t.zones)


@query("period_months", """SELECT DISTINCT period, CASE WHEN length(period) = 4 THEN period || '-' || lpad(CAST(mm AS VARCHAR), 2, '0')
    ELSE substr(period, 1, 4) || '-' || substr(period, 5, 2) END AS month FROM latest, (SELECT unnest(range(1, 13)) AS mm)""")
def _(t):
    return t.latest.select("period", F.explode(scalars.period_months(F.col("period"))).alias("month"))


@query("month_label", "SELECT month, strftime(CAST(month || '-01' AS DATE), '%b %Y') AS label FROM cal")
def _(t):
    return t.calendar.select("month", scalars.month_label(F.col("month")).alias("label"))


@query("country_display", f"""SELECT DISTINCT country, coalesce(name, {o.COUNTRY_CASE.replace('CASE iso3', 'CASE country')}, country) AS display FROM fact
    LEFT JOIN (SELECT iso3, name FROM {_NAMES} WHERE iso3 <> 'UNK' AND length(name) > 0) ON iso3 = country""")
def _(t):
    named = scalars.country_names(t.zones).where("iso3 <> 'UNK'").withColumnRenamed("iso3", "country")
    found = t.fact.select("country").distinct().join(named, "country", "left")
    return found.select("country", scalars.country_display(F.col("country"), F.col("name")).alias("display"))


@query("parse_release", f"SELECT {_REL} FROM releases")
def _(t):
    return t.releases


@query("decode_ais", f"""SELECT lon, lat, m, ais_class, CAST(ais_class >= 2 AS INT) AS a, CASE WHEN ais_class >= 1 THEN CAST(ais_class = 3 AS INT) END AS st,
    CASE WHEN ais_class = 1 THEN ais_conf END AS shown_conf, CASE WHEN ais_class >= 2 THEN ais_speed_kn END AS shown_speed,
    CASE WHEN ais_class >= 2 THEN ais_length_m END AS shown_length, CASE WHEN ais_class >= 2 THEN ais_flag END AS shown_flag FROM ({_POINTS})""")
def _(t):
    c = F.col
    points = publish.publish_points(t.fact, t.calendar, t.mids, P)
    return points.select("lon", "lat", "m", "ais_class", *scalars.decode_ais(
        c("ais_class"), c("ais_conf"), c("ais_speed_kn"), c("ais_length_m"), c("ais_flag")))


# =========================================================================================================== geometry
@query("polygon_edges", "SELECT pid, ring, k, lon1, lat1, lon2, lat2 FROM meadow_ring")
def _(t):
    return spatial.polygon_edges(t.meadows)


def _steps(c, unit: float):
    return F.round(c * F.lit(unit)).cast("bigint")


@query("to_metric", f"SELECT {K}, CAST(round(x*1000) AS BIGINT) AS x_mm, CAST(round(y*1000) AS BIGINT) AS y_mm FROM det_xy")
def _(t):
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    return t.detections.select(*KEY, _steps(x, 1000).alias("x_mm"), _steps(y, 1000).alias("y_mm"))


@query("within_buffer", f"""SELECT {K}, coalesce(exact, false) AS exact, coalesce(grown, false) AS grown FROM anch
    LEFT JOIN (SELECT rid, bool_or(odd) AS exact, bool_or(odd OR d2 < 400e0) AS grown FROM meadow_hit GROUP BY rid) USING (rid)""")
def _(t):
    rows = detections.anchored_in_region(t.detections, P).select(*KEY, "x", "y")
    rows = spatial.points_in_polygons(rows, t.meadow_index, F.col("x"), F.col("y"), 0.0, "exact")
    return spatial.points_in_polygons(rows, t.meadow_index, F.col("x"), F.col("y"), P.buffer_m, "grown").select(*KEY, "exact", "grown")


@query("cell_of", f"SELECT {K}, cell FROM {o.hexed('det_xy')}")
def _(t):
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    return t.detections.select(*KEY, x.alias("x"), y.alias("y")).select(*KEY, geo.cell_of(F.col("x"), F.col("y")).alias("cell"))


@query("cells_covering", "SELECT pid, cell FROM pid_touch")
def _(t):
    # per polygon, so that each one's cover can be told apart
    edges = spatial.planar_edges(spatial.polygon_edges(t.meadows))
    return spatial.cells_covering(edges, t.meadow_index, P.buffer_m)


@query("cell_centre", "SELECT cell, CAST(round(lon*1e7) AS BIGINT) AS lon_e7, CAST(round(lat*1e7) AS BIGINT) AS lat_e7 FROM cell_point")
def _(t):
    lon, lat = geo.cell_centre(F.col("cell"))
    return t.cells.select("cell", _steps(lon, 1e7).alias("lon_e7"), _steps(lat, 1e7).alias("lat_e7"))


@query("cell_boundary", f"""SELECT cell, k, CAST(round({o.lonlat('(x + dx)', '(y + dy)')[0]}*1e7) AS BIGINT) AS lon_e7, CAST(round({o.lonlat('(x + dx)', '(y + dy)')[1]}*1e7) AS BIGINT) AS lat_e7
    FROM cell_point, {o.values([(i, *geo.corner_offsets()[i % 6]) for i in range(7)], 'k, dx, dy')}""")
def _(t):
    v = t.cells.select("cell", F.posexplode(geo.cell_boundary(F.col("cell"))).alias("k", "v"))
    return v.select("cell", "k", _steps(F.col("v.lon"), 1e7).alias("lon_e7"), _steps(F.col("v.lat"), 1e7).alias("lat_e7"))


@query("meadow_cells", "SELECT cell, country, meadow_km2 FROM cells")
def _(t):
    return build.meadow_cells(t.meadows, t.meadow_index, t.zone_index, P)


# =========================================================================================================== releases
@query("complete_releases", f"SELECT {_REL} FROM complete")
def _(t):
    return releases.complete_releases(t.releases)


@query("superseded", o.superseded("latest"))
def _(t):
    return releases.superseded(t.latest)


_ANSWERS = """(SELECT r.request, coalesce(m.period, a.period) AS period FROM requests r LEFT JOIN (SELECT period FROM latest WHERE length(period) = 6) m
    ON (length(r.request) = 7 AND m.period = replace(r.request, '-', '')) OR (length(r.request) = 4 AND substr(m.period, 1, 4) = r.request)
    LEFT JOIN (SELECT period FROM latest WHERE length(period) = 4) a ON a.period = substr(r.request, 1, 4))"""


@query("resolve_requests", f"SELECT request, period FROM {_ANSWERS}")
def _(t):
    return releases.resolve_requests(t.requests, t.latest)


@query("releases_for_months", f"SELECT {_REL} FROM latest WHERE period IN (SELECT period FROM {_ANSWERS} WHERE period IS NOT NULL)")
def _(t):
    return releases.releases_for_months(t.requests, t.latest).select(*t.latest.columns)


_CACHED = """(SELECT r.*, coalesce(l.record_id = r.record_id AND coalesce(l.detections_schema, 1) = 2 AND l.has_files, false) AS cached,
    coalesce(l.record_id = r.record_id AND l.overpass_rows IS NOT NULL AND l.has_files, false) AS keep_overpass
    FROM latest r LEFT JOIN ledger l USING (period))"""


@query("releases_to_fetch", f"""SELECT {_REL} FROM {_CACHED} WHERE NOT cached AND period >= '1996' AND period NOT IN ({o.superseded('latest')})""")
def _(t):
    return releases.releases_to_fetch(t.latest, t.ledger, P, since="1996").select(*t.latest.columns)


@query("is_cached", f"SELECT period, record_id, cached, keep_overpass FROM {_CACHED}")
def _(t):
    flagged = releases.keeps_overpass(releases.is_cached(t.latest, t.ledger, P), t.ledger)
    return flagged.select("period", "record_id", "cached", "keep_overpass")


_STALE = f"""WITH base AS (SELECT period, coalesce(detections_schema, 1) <> 2 AS stale, coalesce(detections_schema, 1) <> 2 AND substr(period, 1, 4) < '1996' AS early
    FROM ledger WHERE has_files), kept AS (SELECT period FROM base WHERE NOT early)
    SELECT period, CASE WHEN early THEN 'excluded' WHEN stale AND period IN ({o.superseded('base', 'kept')}) THEN 'unused' WHEN stale THEN 'stale' ELSE 'use' END AS status FROM base"""


@query("stale_releases", f"SELECT period, status FROM ({_STALE})")
def _(t):
    return releases.ledger_status(t.ledger, P, since="1996")


# ============================================================================================================= checks
def _check_sql(rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS \"table\", '{rule}' AS rule, CAST(coalesce(({count}), 0) AS BIGINT) AS violations" for table, rule, count in rows)


def _bad(source: str, condition: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE NOT coalesce({condition}, false)"


# Tables with planted faults: each rule of a check is broken by some rows, chosen by values that both engines have.
_BAD_SERIES = f"""(SELECT CASE WHEN substr(month, 6, 2) = '03' THEN replace(month, '-', '/') ELSE month END AS month,
    CASE WHEN substr(month, 6, 2) = '05' THEN -1 ELSE anchored_total END AS anchored_total, {', '.join(c for c in TOTALS if c not in ('anchored_total', 'ais_stationary_on_meadow'))},
    ais_stationary_on_meadow + CASE WHEN substr(month, 6, 2) = '09' THEN 1000000 ELSE 0 END AS ais_stationary_on_meadow
    FROM (SELECT *, unnest(range(CASE WHEN substr(month, 6, 2) = '07' THEN 2 ELSE 1 END)) FROM totals JOIN ais_totals USING (month)))"""
_BAD_COUNTRIES = """(SELECT country || CASE WHEN country < 'F' THEN 'X' ELSE '' END AS country, month FROM series WHERE country >= 'M' OR substr(month, 6, 2) <> '01')"""


@query("check_timeseries", _check_sql([
    ("timeseries", "month format", _bad(_BAD_SERIES, r"regexp_full_match(month, '\d{4}-\d{2}')")),
    ("timeseries", "one row per month", f"SELECT count(*) - count(DISTINCT month) FROM {_BAD_SERIES}"),
    ("timeseries", "counts present", _bad(_BAD_SERIES, " AND ".join(f"{c} >= 0" for c in TOTALS))),
    ("timeseries", "stationary + moving <= matched", _bad(_BAD_SERIES, "ais_stationary_on_meadow + ais_moving_on_meadow <= ais_matched_on_meadow")),
    ("timeseries", "month of the calendar missing", f"SELECT count(*) FROM cal WHERE month NOT IN (SELECT month FROM {_BAD_SERIES})"),
    ("countries", "iso3 has three letters", _bad(f"(SELECT DISTINCT country FROM {_BAD_COUNTRIES})", "length(country) = 3")),
    ("countries", "series covers the calendar", f"SELECT count(*) FROM (SELECT country, count(*) AS n FROM {_BAD_COUNTRIES} GROUP BY country) WHERE n <> (SELECT count(*) FROM cal)"),
]))
def _(t):
    fact, calendar = cut_lineage(t.fact), cut_lineage(t.calendar)
    rows = pressure.hex_monthly(fact, t.cells, calendar)
    totals = publish.publish_timeseries(pressure.monthly_totals(fact, calendar), pressure.ais_monthly_totals(rows, calendar))
    mm, country_ = F.substring("month", 6, 2), F.col("country")
    totals = totals.unionByName(totals.where(mm == "07")).withColumns({
        "month": F.when(mm == "03", F.replace("month", F.lit("-"), F.lit("/"))).otherwise(F.col("month")),
        "anchored_total": F.when(mm == "05", F.lit(-1)).otherwise(F.col("anchored_total")),
        "ais_stationary_on_meadow": F.col("ais_stationary_on_meadow") + F.when(mm == "09", F.lit(1_000_000)).otherwise(F.lit(0))})
    series = pressure.country_series(fact, calendar).where((country_ >= "M") | (mm != "01")).withColumn(
        "country", F.concat("country", F.when(country_ < "F", F.lit("X")).otherwise(F.lit(""))))
    return checks.check_timeseries(totals, series, calendar)


_BAD_HEXES = """(SELECT cell || CASE WHEN on_meadow%7 = 3 THEN 'x' ELSE '' END AS cell, on_meadow, clear_overpasses, MAM, JJA, SON,
    CASE WHEN on_meadow%3 <> 1 THEN density END AS density, DJF + CASE WHEN on_meadow%4 = 1 THEN 1 ELSE 0 END AS DJF,
    CASE WHEN on_meadow%6 = 5 THEN on_meadow + 1 ELSE large_on_meadow END AS large_on_meadow
    FROM (SELECT *, unnest(range(CASE WHEN on_meadow%5 = 2 THEN 2 ELSE 1 END)) FROM hexes))"""


@query("check_hexes", _check_sql([
    ("hexes", "valid cell id", _bad(_BAD_HEXES, r"regexp_full_match(cell, '-?\d+_-?\d+')")),
    ("hexes", "cells unique", f"SELECT count(*) - count(DISTINCT cell) FROM {_BAD_HEXES}"),
    ("hexes", "density null exactly without clear overpasses", _bad(_BAD_HEXES, "(density IS NULL) = (clear_overpasses = 0)")),
    ("hexes", "seasons sum to the total", _bad(_BAD_HEXES, "DJF + MAM + JJA + SON = on_meadow")),
    ("hexes", "large <= all", _bad(_BAD_HEXES, "large_on_meadow BETWEEN 0 AND on_meadow")),
]))
def _(t):
    on, keep = F.col("on_meadow"), lambda c: F.col(c)
    twice = t.hexes.unionByName(t.hexes.where(on % 5 == 2))
    return checks.check_hexes(twice.withColumns({
        "cell": F.when(on % 7 == 3, F.concat("cell", F.lit("x"))).otherwise(keep("cell")),
        "density": F.when(on % 3 != 1, keep("density")),
        "DJF": F.when(on % 4 == 1, keep("DJF") + 1).otherwise(keep("DJF")),
        "large_on_meadow": F.when(on % 6 == 5, on + 1).otherwise(keep("large_on_meadow"))}))


@query("check_hex_monthly", _check_sql([
    ("hex_monthly", "stationary <= AIS <= all", _bad("hexm", "ais_st <= ais AND ais <= n")),
    ("hex_monthly", "large: stationary <= AIS <= all", _bad("hexm", "ais_st_large <= ais_large AND ais_large <= large")),
    ("hex_monthly", "0 <= large <= all", _bad("hexm", "large BETWEEN 0 AND n")),
    ("hex_monthly", "0 <= AIS large <= AIS", _bad("hexm", "ais_large BETWEEN 0 AND ais")),
    ("hex_monthly", "0 <= stationary large <= stationary", _bad("hexm", "ais_st_large BETWEEN 0 AND ais_st")),
    ("hex_monthly", "only rows with detections", _bad("hexm", "n > 0")),
    # checked against an older cell table, so that three rules report violations
    ("hex_monthly", "cell known", "SELECT count(*) FROM hexm WHERE cell NOT IN (SELECT cell FROM old_cells)"),
    ("hex_monthly", "month known", "SELECT count(*) FROM hexm WHERE month NOT IN (SELECT month FROM cal)"),
    ("hex_monthly", "clear overpasses for every cell and month", "SELECT (SELECT count(*) FROM clear_dense) - (SELECT count(*) FROM old_cells)*(SELECT count(*) FROM cal)"),
    ("hex_monthly", "sum equals the hexes", "SELECT (SELECT sum(n) FROM hexm) - (SELECT sum(on_meadow) FROM hexes WHERE cell IN (SELECT cell FROM old_cells))"),
]))
def _(t):
    # several rules read each table, so the tables are materialised first, as a build does
    hexes, rows = cut_lineage(t.hexes), cut_lineage(t.rows)
    known = hexes.join(_old_cells(t).select("cell"), "cell", "left_semi")
    return checks.check_hex_monthly(rows, cut_lineage(t.clear), known, cut_lineage(t.calendar))


_BAD_POINTS = f"""(SELECT m + CASE WHEN m%7 = 6 THEN 100000 ELSE 0 END AS m, ais_class + CASE WHEN m%5 = 1 THEN 4 ELSE 0 END AS ais_class,
    CASE m%5 WHEN 2 THEN coalesce(ais_conf, 0.5e0) WHEN 3 THEN NULL ELSE ais_conf END AS ais_conf, ais_speed_kn,
    ais_length_m + CASE WHEN m%5 = 0 THEN 1 ELSE 0 END AS ais_length_m, CASE WHEN m%5 = 4 THEN 'XX' ELSE ais_flag END AS ais_flag FROM ({_POINTS}))"""


@query("check_points", _check_sql([
    ("points", "row cap", f"SELECT greatest(count(*) - 100, 0) FROM {_BAD_POINTS}"),
    ("points", "class is 0..3", _bad(_BAD_POINTS, "ais_class BETWEEN 0 AND 3")),
    ("points", "no confidence without a match", _bad(_BAD_POINTS, "ais_class <> 0 OR ais_conf IS NULL")),
    ("points", "confidence of a confident match", _bad(_BAD_POINTS, "ais_class < 2 OR ais_conf IS NOT NULL")),
    ("points", "vessel values only for a confident match", _bad(_BAD_POINTS, "ais_class >= 2 OR (ais_speed_kn IS NULL AND ais_length_m IS NULL AND ais_flag IS NULL)")),
    ("points", "length in steps", _bad(_BAD_POINTS, "ais_length_m IS NULL OR ais_length_m % 5 = 0")),
    ("points", "month in range", _bad(_BAD_POINTS, "m BETWEEN 0 AND (SELECT count(*) FROM cal) - 1")),
]))
def _(t):
    calendar = cut_lineage(t.calendar)
    m, keep = F.col("m"), lambda c: F.col(c)
    points = publish.publish_points(t.fact, calendar, t.mids, P).withColumns({
        "m": F.when(m % 7 == 6, m + 100_000).otherwise(m), "ais_class": F.when(m % 5 == 1, keep("ais_class") + 4).otherwise(keep("ais_class")),
        "ais_conf": F.when(m % 5 == 2, F.coalesce("ais_conf", F.lit(0.5))).when(m % 5 != 3, keep("ais_conf")),
        "ais_length_m": F.when(m % 5 == 0, keep("ais_length_m") + 1).otherwise(keep("ais_length_m")),
        "ais_flag": F.when(m % 5 == 4, F.lit("XX")).otherwise(keep("ais_flag"))})
    return checks.check_points(points, calendar, replace(P, points_cap=100))


_LAYER = "(SELECT DISTINCT pid FROM meadow_ring UNION ALL SELECT DISTINCT pid FROM meadow_ring WHERE pid%13 = 0)"


@query("check_polygons", _check_sql([
    ("polygons", "polygonal", f"SELECT count(*) FROM {_LAYER} WHERE pid%7 = 0"), ("polygons", "id present", f"SELECT count(*) FROM {_LAYER} WHERE pid%11 = 0"),
    ("polygons", "type by parts", f"SELECT count(*) FROM {_LAYER} WHERE pid%3 = 0 AND pid%7 <> 0"),
    ("polygons", "ids unique", f"SELECT count(*) - count(DISTINCT CASE WHEN pid%11 <> 0 THEN pid END) FROM {_LAYER}"),
    ("polygons", "rings closed", f"SELECT count(*) FROM {_LAYER} WHERE pid%5 = 0")]))
def _(t):
    # every rule is broken by some rows: another type, one of several parts with a single one, no id, a row twice, an open ring
    layer = publish.polygon_display_layer(t.meadows, 30.0)
    layer = layer.unionByName(layer.where("id%13 = 0")).select(
        F.when(F.expr("id%11 <> 0"), F.col("id")).alias("id"), F.when(F.expr("id%7 = 0"), "Point").when(F.expr("id%3 = 0"), "MultiPolygon").otherwise(F.col("type")).alias("type"), "parts",
        F.when(F.expr("id%5 = 0"), F.transform("rings", lambda r: F.slice(r, 1, F.size(r) - 1))).otherwise(F.col("rings")).alias("rings"))
    return checks.check_polygons(cut_lineage(layer))


_BAD_HOT = "(SELECT position, CASE WHEN position%5 = 0 THEN 0 ELSE position%7 + 1 END AS on_meadow FROM hot WHERE position <= 50)"


@query("check_hotspots", _check_sql([
    ("hotspots", "row cap", f"SELECT greatest(count(*) - 3, 0) FROM {_BAD_HOT}"),
    ("hotspots", "descending", f"SELECT count(*) FROM {_BAD_HOT} h JOIN {_BAD_HOT} k ON k.position = h.position + 1 WHERE k.on_meadow > h.on_meadow"),
    ("hotspots", "has detections", _bad(_BAD_HOT, "on_meadow > 0")),
]))
def _(t):
    hot = publish.number_hotspots(publish.publish_hotspots(ranking.hotspots(t.hexes, P.hotspots_n), P))
    at = F.col("position")
    hot = hot.withColumn("on_meadow", F.when(at % 5 == 0, F.lit(0)).otherwise(at % 7 + 1).cast("bigint"))
    return checks.check_hotspots(cut_lineage(hot), replace(P, hotspots_n=3))


@query("check_totals_reconcile", _check_sql([
    ("totals", f"{name} is the sum over cells", f"""SELECT count(*) FROM ais_totals LEFT JOIN (SELECT month, sum({c}) AS s FROM hexm GROUP BY month) USING (month)
        WHERE coalesce(s, 0) <> {name} + CASE WHEN CAST(substr(month, 6, 2) AS INT)%5 = {i} THEN 1 ELSE 0 END""")
    for i, (c, name) in enumerate(zip(AIS_COUNTERS, pressure.AIS_TOTALS))]))
def _(t):
    # every counter is one too high in some months
    rows = cut_lineage(t.rows)
    mm = F.substring("month", 6, 2).cast("int")
    totals = pressure.ais_monthly_totals(rows, t.calendar)
    return checks.check_totals_reconcile(totals.withColumns({c: F.col(c) + (mm % 5 == i).cast("int") for i, c in enumerate(pressure.AIS_TOTALS)}), rows)


# ========================================================================================================= selections
@query("month_calendar", "SELECT c, month, idx FROM calendar")
def _(t):
    return _known_calendar(t).select(F.col("c").cast("bigint").alias("c"), "month", "idx")


@query("select_months", f"SELECT month, idx FROM calendar WHERE idx >= 0 AND month BETWEEN '1996-05' AND '2001-02' AND {o.season('month')} = 'MAM'")
def _(t):
    return selection.select_months(_known_calendar(t), "1996-05", "2001-02", "MAM").select("month", "idx")


@query("year_ranges", """SELECT substr(month, 1, 4) AS year, CAST(min(c) AS INT) AS "first", CAST(max(c) AS INT) AS "last" FROM calendar GROUP BY 1""")
def _(t):
    return selection.year_ranges(_known_calendar(t))


@query("timeline_series", """SELECT CAST(c AS INT) AS c, month, CASE WHEN idx >= 0 THEN ais_stationary_large_on_meadow END AS value FROM calendar LEFT JOIN ais_totals USING (month)""")
def _(t):
    return selection.timeline_series(_known_calendar(t), publish.publish_timeseries(t.totals, t.ais_totals), "ais_st", True)


@query("available_seasons", f"SELECT DISTINCT {o.season('month')} AS season FROM calendar WHERE idx >= 0 AND month BETWEEN '1998-06' AND '1998-11'")
def _(t):
    return selection.available_seasons(_known_calendar(t), "1998-06", "1998-11")


@query("season_fallback", """SELECT cell, JJA AS on_meadow, large_JJA AS large_on_meadow, CASE WHEN clear_JJA > 0 THEN JJA/CAST(clear_JJA AS DOUBLE) END AS density FROM hexes""")
def _(t):
    return selection.season_fallback(t.hexes, "JJA")


@query("country_scale", "SELECT max(anchored_on_meadow) AS scale FROM series")
def _(t):
    return selection.country_scale(t.series)


@query("monthly_table", "SELECT month, anchored_on_meadow, large_on_meadow, anchored_total FROM totals")
def _(t):
    return selection.monthly_table(t.totals)


@query("meta", """SELECT string_agg(month, ',' ORDER BY month) AS months, 1e0 AS speed_kn_max, 20e0 AS buffer_m, 24e0 AS large_length_m, 0.9e0 AS ais_confidence_min,
    1409.2852535992536e0 AS cell_side_m, '-6.0,30.0,36.5,46.0' AS bbox FROM cal""")
def _(t):
    return publish.meta_row(t.calendar, P).withColumns({
        "months": F.array_join("months", ","), "bbox": F.array_join(F.transform("bbox", lambda v: v.cast("string")), ",")})


@query("points_most_recent_capped", f"""SELECT {K} FROM (SELECT *, row_number() OVER (ORDER BY detect_timestamp DESC, lon, lat, scene_id) AS nth FROM fact
    WHERE on_meadow AND month IN (SELECT month FROM cal)) WHERE nth <= 1000""")
def _(t):
    return ranking.points_most_recent(t.fact, t.calendar, 1000).select(*KEY)


# ============================================================================================================ registry
_tables: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    """Tables of a folder; within one session the reference tables (polygon indexes, cells) are built once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables.clear()
        _tables[key] = Tables(spark, folder)
    return _tables[key]


def bound(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: q(tables(spark, folder))
