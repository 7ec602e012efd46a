"""Reference answers in plain SQL over the benchmark tables, which share nothing with the operators but the table bindings.

Spatial questions are answered by brute force: every candidate point against every edge of a polygon. A query is a chain of
named common table expressions; ``sql`` puts together those a final statement needs.
"""

from __future__ import annotations

import math
import re

from . import bindings as b

# The equal-area projection (GRS80, 38 N 15 E) and the grid of hexagons, as numbers of their own.
E2 = 0.006694380022900787
ECC = 0.08181919104281579
QP = 1.9955310874809387
SIN_B1 = 0.613948707056177
COS_B1 = 0.789345922333199
RQ = 6371007.1808835175
D = 1.000696128836744
LON0 = 15.0
CELL_SIDE_M = 1409.2852535992536
RING1 = ((0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))

CTES: dict[str, str] = {}


def num(v: float) -> str:
    text = repr(float(v))
    return f"({text})" if "e" in text else f"({text}e0)"


def columns(spec: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in spec.items())


def values(rows, names: str) -> str:
    cell = lambda v: num(v) if isinstance(v, float) else (f"'{v}'" if isinstance(v, str) else str(v))
    return f"(VALUES {', '.join('(' + ', '.join(cell(v) for v in r) + ')' for r in rows)}) AS t({names})"


def metric(lon: str, lat: str) -> tuple[str, str]:
    s = f"sin(radians({lat}))"
    q = (f"({num(1 - E2)}*({s}/(1 - {num(E2)}*{s}*{s}) - ln((1 - {num(ECC)}*{s})/(1 + {num(ECC)}*{s}))"
         f"/{num(2 * ECC)}))")
    sb = f"({q}/{num(QP)})"
    cb = f"sqrt(1 - {sb}*{sb})"
    lam = f"radians({lon} - {num(LON0)})"
    k = f"({num(RQ)}*sqrt(2/(1 + {num(SIN_B1)}*{sb} + {num(COS_B1)}*{cb}*cos({lam}))))"
    return (f"({k}*{num(D)}*{cb}*sin({lam}))",
            f"({k}/{num(D)}*({num(COS_B1)}*{sb} - {num(SIN_B1)}*{cb}*cos({lam})))")


def hexed(source: str, x: str = "x", y: str = "y") -> str:
    """``source`` with q, r and cell of the hexagon holding (x, y)."""
    s, r3 = num(CELL_SIDE_M), num(math.sqrt(3) / 3)
    return f"""(SELECT * EXCLUDE (fq_, fr_, fs_, rq_, rr_, rs_), CAST(q AS VARCHAR) || '_' || CAST(r AS VARCHAR) AS cell FROM (
      SELECT *, CASE WHEN abs(rq_-fq_) > abs(rr_-fr_) AND abs(rq_-fq_) > abs(rs_-fs_) THEN -rr_-rs_ ELSE rq_ END AS q,
             CASE WHEN NOT (abs(rq_-fq_) > abs(rr_-fr_) AND abs(rq_-fq_) > abs(rs_-fs_)) AND abs(rr_-fr_) > abs(rs_-fs_)
                  THEN -rq_-rs_ ELSE rr_ END AS r FROM (
        SELECT *, CAST(floor(fq_+0.5e0) AS BIGINT) AS rq_, CAST(floor(fr_+0.5e0) AS BIGINT) AS rr_, CAST(floor(fs_+0.5e0) AS BIGINT) AS rs_ FROM (
          SELECT *, -fq_-fr_ AS fs_ FROM (
            SELECT *, ({r3}*{x} - {y}/3)/{s} AS fq_, ({num(2 / 3)}*{y})/{s} AS fr_ FROM {source})))))"""


def lonlat(x: str, y: str) -> tuple[str, str]:
    xs, ys = f"({x}/{num(D)})", f"({y}*{num(D)})"
    rho = f"sqrt({xs}*{xs} + {ys}*{ys})"
    c = f"(2*asin({rho}/{num(2 * RQ)}))"
    bb = f"asin(cos({c})*{num(SIN_B1)} + {ys}*sin({c})*{num(COS_B1)}/{rho})"
    e2, e4, e6 = E2, E2**2, E2**3
    lat = (f"degrees({bb} + {num(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040)}*sin(2*{bb}) + "
           f"{num(23 * e4 / 360 + 251 * e6 / 3780)}*sin(4*{bb}) + {num(761 * e6 / 45360)}*sin(6*{bb}))")
    lon = (f"({num(LON0)} + degrees(atan2({xs}*sin({c}), {rho}*{num(COS_B1)}*cos({c}) - "
           f"{ys}*{num(SIN_B1)}*sin({c}))))")
    return lon, lat


def season(month: str) -> str:
    return (f"CASE WHEN substr({month}, 6, 2) IN ('12', '01', '02') THEN 'DJF' WHEN substr({month}, 6, 2) IN ('03', '04', '05') "
            f"THEN 'MAM' WHEN substr({month}, 6, 2) IN ('06', '07', '08') THEN 'JJA' ELSE 'SON' END")


def cte(name: str, body: str) -> None:
    CTES[name] = body


def sql(final: str) -> str:
    """The statement with all tables it names, directly or through others, in front."""
    order: list[str] = []
    open_names: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and name not in open_names and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                open_names.add(name)
                visit(CTES[name])
                order.append(name)

    visit(final)
    if not order:
        return final
    chain = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    return f"WITH {chain}\n{final}"


# ------------------------------------------------------------------------------------------------------------ detections
cte("lineitem_v", f"SELECT *, 0 AS version FROM lineitem UNION ALL SELECT *, 1 AS version FROM lineitem WHERE {b.REPROCESSED}")
cte("det", f"SELECT *, {b.MONTH} AS month FROM (SELECT {columns(b.DETECTION_COLUMNS)} FROM lineitem_v)")

IN_BOX = "lon BETWEEN -6e0 AND 36.5e0 AND lat BETWEEN 30e0 AND 46e0"
IN_REGION = (f"{IN_BOX} AND NOT (lon BETWEEN -6e0 AND -5.62e0 AND lat BETWEEN 30e0 AND 46e0) AND NOT (lon BETWEEN -6e0 AND 1e0 "
             "AND lat BETWEEN 42e0 AND 46e0) AND NOT (lon BETWEEN 27.3e0 AND 36.5e0 AND lat BETWEEN 41.15e0 AND 46e0)")
QUALITY = ("presence_score >= 0.3e0 AND NOT coalesce(nonvessel_score > 0.95e0, false) AND NOT coalesce(cloud_score > 0.5e0, false)")
FLAGS = "NOT coalesce(likely_infrastructure, false) AND NOT coalesce(potential_ice, false)"
SLOW = "speed_kn_inferred < 1e0"
MATCHED = r"coalesce(regexp_matches(mmsi, '\S'), false)"
_TIES = ("detect_timestamp", "scene_id", "lat", "lon", "speed_kn_inferred", "length_m_inferred", "presence_score",
         "nonvessel_score", "cloud_score", "likely_infrastructure", "potential_ice", "mmsi", "matching_confidence",
         "ais_speed_kn_before", "ais_speed_kn_after", "ais_length_m")
cte("deduped", f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (
    PARTITION BY CAST(round_even(lat*1e4, 0) AS BIGINT), CAST(round_even(lon*1e4, 0) AS BIGINT), substr(detect_timestamp, 1, 16)
    ORDER BY {MATCHED} DESC, round(CAST(matching_confidence AS DOUBLE), 6) DESC NULLS LAST,
    {', '.join(c + ' ASC NULLS FIRST' for c in _TIES)}) AS rk FROM det) WHERE rk = 1""")
_x, _y = metric("lon", "lat")
cte("anch", f"""SELECT *, row_number() OVER () AS rid, {_x} AS x, {_y} AS y FROM deduped
    WHERE {IN_REGION} AND {SLOW} AND {QUALITY} AND {FLAGS}""")
cte("det_xy", f"SELECT *, row_number() OVER () AS rid, {_x} AS x, {_y} AS y FROM det")

# -------------------------------------------------------------------------------------------------------------- meadows
_clon, _clat = b.centre("s_suppkey")


def _pairs(offsets):
    return [(k, *offsets[k], *offsets[(k + 1) % len(offsets)]) for k in range(len(offsets))]


_EDGE = "{lon} + dx1 AS lon1, {lat} + dy1 AS lat1, {lon} + dx2 AS lon2, {lat} + dy2 AS lat2"
_names = "k, dx1, dy1, dx2, dy2"
cte("meadow_ring", f"""
    SELECT CAST(s_suppkey*2 AS INT) AS pid, 0 AS ring, k, {_EDGE.format(lon=_clon, lat=_clat)} FROM supplier, {values(_pairs(b.OCTAGON), _names)}
    UNION ALL SELECT CAST(s_suppkey*2 AS INT), 1, k, {_EDGE.format(lon=_clon, lat=_clat)} FROM supplier, {values(_pairs(b.HOLE), _names)} WHERE {b.HAS_HOLE}
    UNION ALL SELECT CAST(s_suppkey*2 + 1 AS INT), 0, k, {_EDGE.format(lon=f'({_clon} + {num(b.SECOND_SHIFT)})', lat=_clat)}
    FROM supplier, {values(_pairs(b.OCTAGON), _names)} WHERE {b.HAS_SECOND}""")
_x1, _y1 = metric("lon1", "lat1")
_x2, _y2 = metric("lon2", "lat2")
cte("meadow_edge", f"SELECT pid, {_x1} AS x1, {_y1} AS y1, {_x2} AS x2, {_y2} AS y2 FROM meadow_ring")
cte("meadow_box", "SELECT pid, min(x1) AS xa, max(x1) AS xb, min(y1) AS ya, max(y1) AS yb FROM meadow_edge GROUP BY pid")

CROSSES = "((y1 > py) <> (y2 > py)) AND (x1 + (py - y1)*(x2 - x1)/nullif(y2 - y1, 0) <= px)"
T = "greatest(0e0, least(1e0, ((px - x1)*(x2 - x1) + (py - y1)*(y2 - y1))/nullif((x2 - x1)*(x2 - x1) + (y2 - y1)*(y2 - y1), 0)))"
DIST2 = f"(pow(px - x1 - {T}*(x2 - x1), 2) + pow(py - y1 - {T}*(y2 - y1), 2))"


def hits(source: str, key: str, edge: str, box: str, reach: float, x: str = "x", y: str = "y", tile: float = 0.0) -> str:
    """(key, pid, odd, d2) for points of ``source`` near a polygon's box; with ``tile`` they meet by the square tiles of that side."""
    r, t = num(reach), num(tile or 1)
    near = f"s.{x} BETWEEN g.xa - {r} AND g.xb + {r} AND s.{y} BETWEEN g.ya - {r} AND g.yb + {r}"
    pairs = f"SELECT s.{key}, s.{x} AS px, s.{y} AS py, g.pid FROM {source} s JOIN {box} g ON {near}"
    if tile:
        at = lambda v: f"CAST(floor(({v})/{t}) AS BIGINT)"
        tiles = f"""(SELECT *, unnest(range({at(f'ya - {r}')}, {at(f'yb + {r}')} + 1)) AS ty FROM (
          SELECT *, unnest(range({at(f'xa - {r}')}, {at(f'xb + {r}')} + 1)) AS tx FROM {box}))"""
        pairs = f"""SELECT s.{key}, s.{x} AS px, s.{y} AS py, g.pid FROM (SELECT *, {at(x)} AS tx, {at(y)} AS ty FROM {source}) s
          JOIN {tiles} g ON s.tx = g.tx AND s.ty = g.ty WHERE {near}"""
    return f"""SELECT {key}, pid, count(*) FILTER (WHERE {CROSSES}) % 2 = 1 AS odd, min({DIST2}) AS d2
      FROM ({pairs}) JOIN {edge} USING (pid) GROUP BY {key}, pid"""


cte("meadow_hit", hits("anch", "rid", "meadow_edge", "meadow_box", 20.0, tile=2000.0))
cte("det_hit", hits("det_xy", "rid", "meadow_edge", "meadow_box", 20.0, tile=2000.0))

# ---------------------------------------------------------------------------------------------------------------- zones
PRIORITY = "CASE pol_type WHEN '200NM' THEN 0 WHEN 'Joint regime' THEN 1 WHEN 'Overlapping claim' THEN 2 ELSE 3 END"
cte("zone_raw", f"SELECT {columns(b.ZONE_COLUMNS)}, {columns(b.ZONE_BOX)} FROM nation")
cte("zones", f"""SELECT pid, mrgid, geoname, pol_type, coalesce(iso_ter1, iso_sov1, 'UNK') AS iso3,
    CASE WHEN iso_ter1 IS NULL THEN sovereign1 ELSE territory1 END AS name, {PRIORITY} AS priority, lon0, lon1, lat0, lat1 FROM zone_raw""")
cte("zone_ring", """SELECT pid, z.lon0 AS lon1, z.lat0 AS lat1, z.lon1 AS lon2, z.lat0 AS lat2 FROM zones z
    UNION ALL SELECT pid, z.lon1, z.lat0, z.lon1, z.lat1 FROM zones z UNION ALL SELECT pid, z.lon1, z.lat1, z.lon0, z.lat1 FROM zones z
    UNION ALL SELECT pid, z.lon0, z.lat1, z.lon0, z.lat0 FROM zones z""")
cte("zone_deg", "SELECT pid, lon1 AS x1, lat1 AS y1, lon2 AS x2, lat2 AS y2 FROM zone_ring")
cte("zone_deg_box", "SELECT pid, min(x1) AS xa, max(x1) AS xb, min(y1) AS ya, max(y1) AS yb FROM zone_deg GROUP BY pid")
cte("zone_edge", f"SELECT pid, {_x1} AS x1, {_y1} AS y1, {_x2} AS x2, {_y2} AS y2 FROM zone_ring")
cte("zone_box", "SELECT pid, -1e9 AS xa, 1e9 AS xb, -1e9 AS ya, 1e9 AS yb FROM zone_edge GROUP BY pid")


def country(name: str, source: str, key: str) -> None:
    """CTEs ``{name}_zone`` (key, country): zone of each point of ``source`` (key, lon, lat, x, y)."""
    cte(f"{name}_in", hits(source, key, "zone_deg", "zone_deg_box", 0.0, "lon", "lat"))
    cte(f"{name}_first", f"""SELECT {key}, iso3 FROM (SELECT {key}, iso3, row_number() OVER (PARTITION BY {key} ORDER BY priority, iso3) AS rk
        FROM {name}_in JOIN zones USING (pid) WHERE odd) WHERE rk = 1""")
    cte(f"{name}_open", f"SELECT s.{key}, s.x, s.y FROM {source} s LEFT JOIN {name}_first USING ({key}) WHERE coalesce(iso3, 'UNK') = 'UNK'")
    cte(f"{name}_far", hits(f"{name}_open", key, "zone_edge", "zone_box", 0.0))
    cte(f"{name}_near", f"""SELECT {key}, iso3 FROM (SELECT {key}, iso3, row_number() OVER (PARTITION BY {key} ORDER BY d, priority, iso3) AS rk FROM (
        SELECT {key}, pid, CASE WHEN odd THEN 0e0 ELSE round(sqrt(d2), 6) END AS d FROM {name}_far) JOIN zones USING (pid) WHERE d <= 20000e0) WHERE rk = 1""")
    cte(f"{name}_zone", f"""SELECT s.{key}, coalesce(n.iso3, f.iso3, 'UNK') AS country FROM {source} s
        LEFT JOIN {name}_first f USING ({key}) LEFT JOIN {name}_near n USING ({key})""")


# ----------------------------------------------------------------------------------------------------------------- fact
CONFIDENT = "(ais_matched AND coalesce(round(CAST(matching_confidence AS DOUBLE), 6) >= 0.9e0, false))"
AIS_SPEED = "(round(CAST(ais_speed_kn_before AS DOUBLE), 6) + round(CAST(ais_speed_kn_after AS DOUBLE), 6))/2"


def ais(source: str) -> str:
    return f"""(SELECT *, ais_confident AND coalesce(ais_speed_kn < 1e0, false) AS ais_stationary,
        ais_confident AND coalesce(ais_speed_kn >= 1e0, false) AS ais_moving FROM (
        SELECT *, CASE WHEN ais_matched THEN {AIS_SPEED} END AS ais_speed_kn, {CONFIDENT} AS ais_confident FROM (
        SELECT *, {MATCHED} AS ais_matched FROM {source})))"""


cte("flagged", """SELECT a.*, coalesce(h.on_meadow, false) AS on_meadow FROM anch a
    LEFT JOIN (SELECT rid, bool_or(odd OR d2 < 400e0) AS on_meadow FROM meadow_hit GROUP BY rid) h USING (rid)""")
cte("on_points", "SELECT rid, lon, lat, x, y FROM flagged WHERE on_meadow")
country("on_points", "on_points", "rid")
country("anch", "anch", "rid")
cte("dedup_points", f"SELECT *, row_number() OVER () AS rid FROM deduped")
cte("dedup_hit", hits("dedup_points", "rid", "zone_deg", "zone_deg_box", 0.0, "lon", "lat"))
cte("deduped_in", """SELECT d.*, z.iso3 FROM dedup_points d LEFT JOIN (SELECT rid, iso3 FROM (SELECT rid, iso3, row_number() OVER (PARTITION BY rid ORDER BY priority, iso3) AS rk
    FROM dedup_hit JOIN zones USING (pid) WHERE odd) WHERE rk = 1) z USING (rid)""")
cte("classified", f"""SELECT * EXCLUDE (cell), CASE WHEN on_meadow THEN cell END AS cell,
    coalesce(length_m_inferred >= 24e0, false) AS large FROM {ais(hexed('flagged'))}""")
cte("fact", "SELECT c.*, coalesce(z.country, 'UNK') AS country FROM classified c LEFT JOIN on_points_zone z USING (rid)")

# ------------------------------------------------------------------------------------------------------- cell dimension
_W, _S = num(CELL_SIDE_M * math.sqrt(3)), num(CELL_SIDE_M * 1.5)
_RC = num(CELL_SIDE_M + 25)
cte("cell_row", f"""SELECT pid, xa, xb, CAST(unnest(range(CAST(floor((ya - {_RC})/{_S}) AS BIGINT), CAST(ceil((yb + {_RC})/{_S}) AS BIGINT) + 1)) AS BIGINT) AS r
    FROM meadow_box""")
cte("cell_candidate", f"""SELECT pid, q, r, {_W}*(q + r/2) AS x, {_S}*r AS y, CAST(q AS VARCHAR) || '_' || CAST(r AS VARCHAR) AS cell FROM (
    SELECT pid, r, CAST(unnest(range(CAST(floor((xa - {_RC})/{_W} - r/2) AS BIGINT), CAST(ceil((xb + {_RC})/{_W} - r/2) AS BIGINT) + 1)) AS BIGINT) AS q
    FROM cell_row)""")
cte("candidate_centre", "SELECT DISTINCT cell, x, y FROM cell_candidate")
cte("centre_hit", hits("candidate_centre", "cell", "meadow_edge", "meadow_box", 0.0))
_corners = [(CELL_SIDE_M*math.cos(math.radians(a)), CELL_SIDE_M*math.sin(math.radians(a))) for a in (-30, 30, 90, 150, 210, 270)]
_SEG = [(*_corners[i], *_corners[(i + 1) % 6]) for i in range(6)]


def _ps(px, py, ax, ay, bx, by):
    t = f"greatest(0e0, least(1e0, (({px}-{ax})*({bx}-{ax}) + ({py}-{ay})*({by}-{ay}))/(pow({bx}-{ax}, 2) + pow({by}-{ay}, 2))))"
    return f"(pow({px} - {ax} - {t}*({bx}-{ax}), 2) + pow({py} - {ay} - {t}*({by}-{ay}), 2))"


def _cr(ax, ay, bx, by, px, py):
    return f"(({bx}-{ax})*({py}-{ay}) - ({by}-{ay})*({px}-{ax}))"


cte("side_pair", f"""SELECT pid, c.cell, e.x1, e.y1, e.x2, e.y2, c.x + t.ax AS ax, c.y + t.ay AS ay, c.x + t.bx AS bx, c.y + t.by_ AS by_
    FROM cell_candidate c JOIN meadow_edge e USING (pid), {values(_SEG, 'ax, ay, bx, by_')}""")
cte("cell_touch", f"""SELECT DISTINCT cell FROM side_pair WHERE
    ({_cr('x1', 'y1', 'x2', 'y2', 'ax', 'ay')}*{_cr('x1', 'y1', 'x2', 'y2', 'bx', 'by_')} < 0 AND {_cr('ax', 'ay', 'bx', 'by_', 'x1', 'y1')}*{_cr('ax', 'ay', 'bx', 'by_', 'x2', 'y2')} < 0)
    OR least({_ps('x1', 'y1', 'ax', 'ay', 'bx', 'by_')}, {_ps('x2', 'y2', 'ax', 'ay', 'bx', 'by_')}, {_ps('ax', 'ay', 'x1', 'y1', 'x2', 'y2')}, {_ps('bx', 'by_', 'x1', 'y1', 'x2', 'y2')}) <= 400e0
    UNION SELECT cell FROM centre_hit WHERE odd UNION SELECT DISTINCT cell FROM {hexed('meadow_edge', 'x1', 'y1')}""")
cte("pid_centre", "SELECT DISTINCT pid, cell, x, y FROM cell_candidate")
cte("pid_inside", f"""SELECT pid, cell FROM (SELECT pid, cell, count(*) FILTER (WHERE {CROSSES}) % 2 = 1 AS odd FROM (
    SELECT pid, cell, x AS px, y AS py FROM pid_centre) JOIN meadow_edge USING (pid) GROUP BY pid, cell) WHERE odd""")
cte("pid_touch", f"""SELECT DISTINCT pid, cell FROM side_pair WHERE
    ({_cr('x1', 'y1', 'x2', 'y2', 'ax', 'ay')}*{_cr('x1', 'y1', 'x2', 'y2', 'bx', 'by_')} < 0 AND {_cr('ax', 'ay', 'bx', 'by_', 'x1', 'y1')}*{_cr('ax', 'ay', 'bx', 'by_', 'x2', 'y2')} < 0)
    OR least({_ps('x1', 'y1', 'ax', 'ay', 'bx', 'by_')}, {_ps('x2', 'y2', 'ax', 'ay', 'bx', 'by_')}, {_ps('ax', 'ay', 'x1', 'y1', 'x2', 'y2')}, {_ps('bx', 'by_', 'x1', 'y1', 'x2', 'y2')}) <= 400e0
    UNION SELECT pid, cell FROM pid_inside UNION SELECT DISTINCT pid, cell FROM {hexed('meadow_edge', 'x1', 'y1')}""")
cte("area_row", "SELECT pid, xa, xb, CAST(unnest(range(CAST(floor(ya/100) AS BIGINT), CAST(ceil(yb/100) AS BIGINT) + 1)) AS BIGINT) AS j FROM meadow_box")
cte("area_point", """SELECT DISTINCT i, j, i*100e0 AS x, j*100e0 AS y, CAST(i AS VARCHAR) || ',' || CAST(j AS VARCHAR) AS ij FROM (
    SELECT j, CAST(unnest(range(CAST(floor(xa/100) AS BIGINT), CAST(ceil(xb/100) AS BIGINT) + 1)) AS BIGINT) AS i FROM area_row)""")
cte("area_hit", hits("area_point", "ij", "meadow_edge", "meadow_box", 0.0))
cte("cell_area", f"""SELECT cell, count(*) AS hits, count(*)*{num(100.0 * 100.0 / 1e6)} AS meadow_km2 FROM {hexed('area_point')}
    WHERE ij IN (SELECT ij FROM area_hit WHERE odd) GROUP BY cell""")
_clo, _cla = lonlat("x", "y")
cte("cell_point", f"""SELECT cell, x, y, {_clo} AS lon, {_cla} AS lat FROM (SELECT cell, {_W}*(q + r/2) AS x, {_S}*r AS y FROM (
    SELECT cell, CAST(split_part(cell, '_', 1) AS BIGINT) AS q, CAST(split_part(cell, '_', 2) AS BIGINT) AS r FROM cell_touch))""")
# reprojected, as the operators do, so that the snapping distance is measured from the same place
cte("cell_place", f"SELECT cell, lon, lat, {_x} AS x, {_y} AS y FROM cell_point")
country("cell", "cell_place", "cell")
cte("cells", "SELECT cell, country, coalesce(meadow_km2, 0e0) AS meadow_km2 FROM cell_zone LEFT JOIN cell_area USING (cell)")

# ------------------------------------------------------------------------------------------------------------ overpasses
_hx, _hy = metric(_clon, _clat)
cte("harbour", f"SELECT s_suppkey, q, r FROM {hexed(f'(SELECT s_suppkey, {_hx} AS x, {_hy} AS y FROM supplier)')}")
cte("overpass_raw", f"""SELECT CAST(h.q + t.dq AS VARCHAR) || '_' || CAST(h.r + t.dr AS VARCHAR) AS h3_id, {columns(b.OVERPASS_COLUMNS)}
    FROM orders JOIN harbour h ON h.s_suppkey = o_custkey % (SELECT count(*) FROM supplier)
    JOIN {values([(i, *d) for i, d in enumerate(RING1)], 'n, dq, dr')} ON t.n = o_orderkey % 7""")
cte("overpass", "SELECT h3_id, substr(month, 1, 7) AS month, overpasses, overpasses_cloud_under_20 FROM overpass_raw")
cte("wide_cells", f"""SELECT DISTINCT CAST(q + dq AS VARCHAR) || '_' || CAST(r + dr AS VARCHAR) AS cell FROM (
    SELECT CAST(split_part(cell, '_', 1) AS BIGINT) AS q, CAST(split_part(cell, '_', 2) AS BIGINT) AS r FROM cells), {values(RING1, 'dq, dr')}""")

# --------------------------------------------------------------------------------------------------------------- counts
cte("cal", "SELECT DISTINCT month FROM (SELECT month FROM det UNION ALL SELECT month FROM overpass)")
_CNT = """CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE large) AS BIGINT) AS large,
    CAST(count(*) FILTER (WHERE ais_confident) AS BIGINT) AS ais, CAST(count(*) FILTER (WHERE ais_confident AND large) AS BIGINT) AS ais_large,
    CAST(count(*) FILTER (WHERE ais_stationary) AS BIGINT) AS ais_st, CAST(count(*) FILTER (WHERE ais_stationary AND large) AS BIGINT) AS ais_st_large,
    CAST(count(*) FILTER (WHERE ais_moving) AS BIGINT) AS ais_mv"""
cte("cell_month", f"SELECT cell, month, {_CNT} FROM fact WHERE on_meadow GROUP BY cell, month")
cte("hexm", "SELECT * FROM cell_month WHERE cell IN (SELECT cell FROM cells) AND month IN (SELECT month FROM cal)")
cte("clear_month", "SELECT h3_id AS cell, month, CAST(sum(overpasses_cloud_under_20) AS BIGINT) AS clear FROM overpass GROUP BY h3_id, month")
cte("clear_dense", """SELECT c.cell, k.month, coalesce(o.clear, 0) AS clear FROM cells c CROSS JOIN cal k
    LEFT JOIN clear_month o ON o.cell = c.cell AND o.month = k.month""")
SEASONS = ("DJF", "MAM", "JJA", "SON")


def per_season(value: str, prefix: str = "") -> str:
    return ", ".join(f"CAST(coalesce(sum({value}) FILTER (WHERE {season('month')} = '{s}'), 0) AS BIGINT) AS {prefix}{s}" for s in SEASONS)


cte("seasons_on", f"SELECT cell, {per_season('n')}, {per_season('large', 'large_')} FROM cell_month GROUP BY cell")
cte("seasons_clear", f"SELECT cell, CAST(sum(clear) AS BIGINT) AS clear_overpasses, {per_season('clear', 'clear_')} FROM clear_month GROUP BY cell")
cte("cell_sum", "SELECT cell, CAST(sum(n) AS BIGINT) AS on_meadow, CAST(sum(large) AS BIGINT) AS large_on_meadow FROM cell_month GROUP BY cell")
cte("peak", "SELECT cell, month AS peak_month FROM (SELECT cell, month, row_number() OVER (PARTITION BY cell ORDER BY n DESC, month DESC) AS rk FROM cell_month) WHERE rk = 1")
_z = lambda p: ", ".join(f"coalesce({p}{s}, 0) AS {p}{s}" for s in SEASONS)


def hexes_of(cells: str) -> str:
    return f"""SELECT cell, k.country, coalesce(on_meadow, 0) AS on_meadow, coalesce(large_on_meadow, 0) AS large_on_meadow,
    coalesce(clear_overpasses, 0) AS clear_overpasses, CASE WHEN coalesce(clear_overpasses, 0) > 0 THEN coalesce(on_meadow, 0)/CAST(clear_overpasses AS DOUBLE) END AS density,
    k.meadow_km2, {_z('')}, {_z('large_')}, {_z('clear_')}, peak_month
    FROM (SELECT * FROM {cells} UNION ALL SELECT DISTINCT cell, 'UNK', 0e0 FROM cell_month WHERE cell NOT IN (SELECT cell FROM {cells})) k
    LEFT JOIN cell_sum USING (cell) LEFT JOIN seasons_on USING (cell) LEFT JOIN seasons_clear USING (cell) LEFT JOIN peak USING (cell)"""


cte("hexes", hexes_of("cells"))
# a cell table from a coarser survey, which misses the cells with little meadow
cte("old_cells", "SELECT * FROM cells WHERE meadow_km2 > 0.505e0")
cte("totals", """SELECT k.month, coalesce(a, 0) AS anchored_total, coalesce(o, 0) AS anchored_on_meadow, coalesce(l, 0) AS large_on_meadow FROM cal k
    LEFT JOIN (SELECT month, count(*) AS a, count(*) FILTER (WHERE on_meadow) AS o, count(*) FILTER (WHERE on_meadow AND large) AS l FROM fact GROUP BY month) USING (month)""")
_TOT = list(zip(("ais", "ais_large", "ais_st", "ais_st_large", "ais_mv"), (
    "ais_matched_on_meadow", "ais_matched_large_on_meadow", "ais_stationary_on_meadow", "ais_stationary_large_on_meadow", "ais_moving_on_meadow")))
cte("ais_totals", f"""SELECT k.month, {', '.join(f'coalesce({t}, 0) AS {t}' for _, t in _TOT)} FROM cal k LEFT JOIN (
    SELECT month, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {t}' for c, t in _TOT)} FROM hexm GROUP BY month) USING (month)""")
cte("series", """SELECT c.country, k.month, coalesce(a, 0) AS anchored_on_meadow, coalesce(l, 0) AS large_on_meadow
    FROM (SELECT DISTINCT country FROM fact WHERE on_meadow) c CROSS JOIN cal k LEFT JOIN (
    SELECT country, month, count(*) AS a, count(*) FILTER (WHERE large) AS l FROM fact WHERE on_meadow GROUP BY country, month) f
    ON f.country = c.country AND f.month = k.month""")
cte("hot", """SELECT *, row_number() OVER (ORDER BY on_meadow DESC, coalesce(density, -1) DESC, cell) AS position FROM hexes WHERE on_meadow > 0""")
cte("midx", "SELECT month, row_number() OVER (ORDER BY month) - 1 AS m FROM cal")
cte("cidx", "SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS i FROM cells")
cte("calendar", """SELECT row_number() OVER (ORDER BY d) - 1 AS c, strftime(d, '%Y-%m') AS month, coalesce(m, -1) AS idx FROM (
    SELECT unnest(generate_series(CAST((SELECT min(month) FROM known_months) || '-01' AS DATE), CAST((SELECT max(month) FROM known_months) || '-01' AS DATE), INTERVAL 1 MONTH)) AS d)
    LEFT JOIN (SELECT month, row_number() OVER (ORDER BY month) - 1 AS m FROM known_months) k ON k.month = strftime(d, '%Y-%m')""")
# months that releases supply: of annual ones up to 1997, then those of the monthly ones
cte("known_months", """SELECT DISTINCT month FROM (
    SELECT substr(period, 1, 4) || '-' || substr(period, 5, 2) AS month FROM latest WHERE length(period) = 6 UNION ALL
    SELECT period || '-' || lpad(CAST(mm AS VARCHAR), 2, '0') FROM latest, (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12)) AS t(mm)
    WHERE length(period) = 4 AND period < '1998')""")
cte("mids", f"SELECT mid, arg_min(iso2, s_suppkey) AS iso2 FROM (SELECT s_suppkey, {columns(b.MID_COLUMNS)} FROM supplier) GROUP BY mid")

# ------------------------------------------------------------------------------------------------------------- releases
_OM = "substr(CAST(o_orderdate AS VARCHAR), 1, 7)"
cte("order_months", f"SELECT DISTINCT {_OM} AS month FROM orders")
cte("periods", f"""SELECT DISTINCT substr(month, 1, 4) AS period, 0 AS kind FROM order_months UNION ALL
    SELECT replace(month, '-', ''), k FROM order_months, (VALUES (0), (1), (2)) AS t(k)
    WHERE substr(month, 1, 4) >= '1998' AND month <> '{b.NO_MONTHLY}' AND (k = 0 OR (k = 1 AND CAST(substr(month, 6, 2) AS INT)%4 = 0) OR (k = 2 AND CAST(substr(month, 6, 2) AS INT)%5 = 0))""")
cte("records", f"SELECT {columns(b.RECORD_COLUMNS)} FROM periods")
cte("releases", """SELECT CAST(id AS BIGINT) AS record_id, coalesce(nullif(regexp_extract(title, '^\\s*(\\d{6}|\\d{4})\\b', 1), ''),
      nullif(regexp_extract(det_key, '_(\\d{4,6})\\.csv$', 1), '')) AS period, title, published,
    coalesce(det_link, 'https://files.example/records/' || CAST(id AS VARCHAR) || '/' || det_key) AS detections_url, det_key AS detections_name, det_size AS detections_size,
    CASE WHEN ovp_key LIKE 'sentinel2_overpass%' THEN ovp_link END AS overpass_url, CASE WHEN ovp_key LIKE 'sentinel2_overpass%' THEN ovp_key END AS overpass_name,
    CASE WHEN ovp_key LIKE 'sentinel2_overpass%' THEN ovp_size END AS overpass_size FROM records""")
cte("complete", "SELECT * FROM releases WHERE detections_url IS NOT NULL AND overpass_url IS NOT NULL AND coalesce(overpass_size, 0) >= 0")
cte("latest", "SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY published DESC, record_id DESC) AS rk FROM complete) WHERE rk = 1")
cte("ledger", f"SELECT {columns(b.LEDGER_COLUMNS)} FROM latest WHERE {b.LEDGER_FILTER}")
cte("requests", f"""SELECT DISTINCT unnest([month, substr(month, 1, 4), CAST(CAST(substr(month, 1, 4) AS INT) + 5 AS VARCHAR) || substr(month, 5, 3),
    CAST(CAST(substr(month, 1, 4) AS INT) + 5 AS VARCHAR)]) AS request FROM order_months""")
MONTHS12 = ", ".join(f"({m})" for m in range(1, 13))


def superseded(source: str, monthly: str | None = None) -> str:
    m = monthly or source
    return f"""SELECT p.period FROM (SELECT DISTINCT period FROM {source} WHERE length(period) = 4) p, (VALUES {MONTHS12}) AS t(mm)
        JOIN (SELECT DISTINCT period AS mp FROM {m} WHERE length(period) = 6) k ON k.mp = p.period || lpad(CAST(mm AS VARCHAR), 2, '0')
        GROUP BY p.period HAVING count(*) = 12"""


cte("delivered", f"""SELECT *, {b.ANNUAL_PERIOD} AS period FROM det WHERE {b.ANNUAL_ROWS} UNION ALL
    SELECT *, {b.MONTHLY_PERIOD} AS period FROM det WHERE {b.MONTHLY_ROWS}""")
cte("to_fetch", f"SELECT period FROM latest WHERE period NOT IN ({superseded('latest')})")
cte("monthly_months", "SELECT DISTINCT substr(period, 1, 4) || '-' || substr(period, 5, 2) AS mm FROM delivered WHERE length(period) = 6")

# Short names of holders.
COUNTRY_NAMES = {
    "ALB": "Albania", "BIH": "Bosnia and Herzegovina", "CYP": "Cyprus", "DZA": "Algeria", "EGY": "Egypt", "ESP": "Spain", "FRA": "France",
    "GBR": "United Kingdom", "GIB": "Gibraltar", "GRC": "Greece", "HRV": "Croatia", "ISR": "Israel", "ITA": "Italy", "LBN": "Lebanon",
    "LBY": "Libya", "MAR": "Morocco", "MCO": "Monaco", "MLT": "Malta", "MNE": "Montenegro", "PSE": "Palestine", "SVN": "Slovenia",
    "SYR": "Syria", "TUN": "Tunisia", "TUR": "Türkiye", "UNK": "Outside EEZ / unknown",
}
COUNTRY_CASE = "CASE iso3 " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COUNTRY_NAMES.items()) + " END"
