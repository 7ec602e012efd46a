"""Polygon index, cells, area and country assignment against brute force in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.config import Params
from fathomline.functions import geo
from fathomline.operators import country, spatial
from fathomline.operators.joins import lookup_join
from fathomline.plans import build


def star(rng, cx, cy, r, n):
    """A jagged polygon: n corners at growing angles and random radii."""
    a = np.sort(rng.uniform(0, 2 * np.pi, n))
    d = rng.uniform(0.3, 1.0, n) * r
    return [(cx + d[i] * math.cos(a[i]), cy + d[i] * math.sin(a[i])) for i in range(n)]


def edges_of(rings):
    return [(*r[i], *r[(i + 1) % len(r)]) for r in rings for i in range(len(r))]


def frame(spark, polygons):
    rows = [(pid, *e) for pid, rings in polygons.items() for e in edges_of(rings)]
    return spark.createDataFrame([(p, float(a), float(b), float(c), float(d)) for p, a, b, c, d in rows], "pid int, x1 double, y1 double, x2 double, y2 double")


def odd(rings, x, y):
    n = 0
    for x1, y1, x2, y2 in edges_of(rings):
        if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
            n += 1
    return n % 2 == 1


def dist(rings, x, y):
    best = math.inf
    for x1, y1, x2, y2 in edges_of(rings):
        dx, dy = x2 - x1, y2 - y1
        n = dx * dx + dy * dy
        t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / n)) if n else 0
        best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(7)
    polys = {i: [star(rng, rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(3, 30), int(rng.integers(3, 40)))] for i in range(25)}
    polys[100] = [[(-20, -20), (120, -20), (120, 10), (-20, 10)], [(10, -10), (90, -10), (90, 5), (10, 5)]]  # long sides, a hole
    polys[101] = [[(50, 40), (60, 40), (60, 60), (50, 60)], [(70, 40), (80, 40), (80, 60), (70, 60)]]  # two parts
    polys[102] = [[(3.0, 3.0), (3.2, 3.0), (3.1, 3.1)]]  # smaller than a bin
    return polys


@pytest.mark.parametrize("bin_size, most", [(1.7, 512), (40.0, 12), (400.0, 25)])
def test_points_in_polygons_and_buffer_match_brute_force(spark, shapes, bin_size, most):
    rng = np.random.default_rng(11)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-30, 130, (1200, 2)))]
    # on grid lines of the shapes and along their corners' heights
    pts += [(2000 + i, float(x), float(r[0][1])) for i, (r, x) in enumerate(zip((p[0] for p in shapes.values()), rng.uniform(-30, 130, 28)))]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    index = spatial.build_index(frame(spark, shapes), bin_size, reach=2.5, most=most)
    assert (index.divided is not None) == (most < 512)
    out = spatial.points_in_polygons(df, index, F.col("x"), F.col("y"), 0.0, "hit")
    out = spatial.points_in_polygons(out, index, F.col("x"), F.col("y"), 2.5, "grown")
    got = {r.id: (r.hit, r.grown) for r in out.collect()}
    assert len(got) == len(pts)
    for i, x, y in pts:
        hit = any(odd(p, x, y) for p in shapes.values())
        grown = hit or any(dist(p, x, y) < 2.5 for p in shapes.values())
        assert got[i] == (hit, grown), (i, x, y)


def listed(index):
    return index.bins.select("_lvl", F.aggregate("_polys", F.lit(0), lambda n, g: F.greatest(
        F.size(g.sides), F.lit(0)) + F.greatest(F.size(g.walls), F.size(g.rim)) + n).alias("n")).groupBy("_lvl").agg(F.max("n").alias("n"))


def test_bins_of_a_dense_outline_are_divided_until_they_are_small(spark):
    # an outline of 200,000 edges, most of them within one bin, whose centre lies in a corner of the grid
    n, bin_size = 200_000, 1000.0
    a, size = 2 * math.pi * F.col("id") / n, 400.0
    wave = lambda t: size * (1 + 0.3 * F.sin(t * 40))
    b = 2 * math.pi * (F.col("id") + 1) / n
    edges = spark.range(n).select(F.lit(1).alias("pid"), (wave(a) * F.cos(a)).alias("x1"), (wave(a) * F.sin(a)).alias("y1"),
                                  (wave(b) * F.cos(b)).alias("x2"), (wave(b) * F.sin(b)).alias("y2"))
    index = spatial.build_index(edges, bin_size, most=500)
    assert max(r.n for r in listed(index).collect()) <= 500 and len({r[0] for r in index.bins.select("_lvl").distinct().collect()}) > 1
    rng = np.random.default_rng(3)
    pts = [(float(x), float(y)) for x, y in rng.uniform(-600, 600, (3000, 2))]
    out = spatial.points_in_polygons(spark.createDataFrame(pts, "x double, y double"), index, F.col("x"), F.col("y"), 0.0, "hit")
    # a lookup is one join with the divided bins and one with the bins; points stay one row each
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Generate" not in plan and "Exchange hash" not in plan
    rows = out.collect()
    assert len(rows) == len(pts) and sum(r.hit for r in rows) > 500
    for r in rows:
        edge = 400 * (1 + 0.3 * math.sin(math.atan2(r.y, r.x) * 40))
        if abs(math.hypot(r.x, r.y) - edge) > 0.1:
            assert r.hit == (math.hypot(r.x, r.y) < edge)


def test_edges_through_bin_corners(spark):
    # edges of slope 1, -1 and 2 that run exactly through corners of the bin grid
    b = 8.0
    cx, cy = 3 * b + spatial.SHIFT_X * b, 2 * b + spatial.SHIFT_Y * b
    shapes = {i: [[(cx - 4 * b, cy - 4 * b * m), (cx + 4 * b, cy + 4 * b * m), (cx + 5 * b, cy - 7 * b), (cx - 4 * b, cy - 9 * b)]] for i, m in enumerate((1.0, -1.0, 2.0, 0.0))}
    rng = np.random.default_rng(2)
    for pid, rings in shapes.items():
        pts = [(float(x), float(y)) for x, y in rng.uniform((cx - 6 * b, cy - 10 * b), (cx + 6 * b, cy + 10 * b), (500, 2))]
        index = spatial.build_index(frame(spark, {pid: rings}), b * (4 if pid % 2 else 1), most=1 if pid % 2 else 512, deepest=3)
        out = spatial.points_in_polygons(spark.createDataFrame(pts, "x double, y double"), index, F.col("x"), F.col("y"), 0.0, "hit")
        assert all(r.hit == odd(rings, r.x, r.y) for r in out.collect())


def test_nearest_distance_matches_brute_force(spark, shapes):
    rng = np.random.default_rng(5)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-30, 130, (300, 2)))]
    index = spatial.build_index(frame(spark, shapes), 10.0, reach=10.0)
    nearest = lambda polys, px, py: F.array_min(F.transform(polys, lambda g: F.struct(spatial.distance_to(g, px, py).alias("d"), g.pid)))["d"]
    out = spatial.lookup(spark.createDataFrame(pts, "id int, x double, y double"), index, F.col("x"), F.col("y"), "d", nearest)
    got = {r.id: r.d for r in out.collect()}
    for i, x, y in pts:
        want = min(0.0 if odd(p, x, y) else dist(p, x, y) for p in shapes.values())
        if want <= 10:
            assert got[i] == pytest.approx(want, abs=1e-5)
        else:
            assert got[i] is None or got[i] > 10


def test_nearest_zone_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(country, "MOST", 5)
    rng = np.random.default_rng(9)
    zones = {i: [star(rng, rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(2, 9), 30)] for i in range(9)}
    attrs = {i: (int(i % 3), f"Z{i}") for i in zones}
    edges = frame(spark, zones).join(spark.createDataFrame([(i, *a) for i, a in attrs.items()], "pid int, priority int, iso3 string"), "pid")
    names, limit = ["priority", "iso3"], 20.0
    index = country.ZoneIndex(None, spatial.build_index(edges, 20.0, attrs=names, most=20), country.bin_outlines(edges, limit / 4, names, most=5))
    assert index.outlines.bins.groupBy("_bx", "_by").count().where("count > 1").count() > 0  # crowded bins are several rows
    pts = [(float(x), float(y)) for x, y in rng.uniform(-40, 100, (500, 2))]
    places = spark.createDataFrame(pts, "x double, y double")
    got = {(r.x, r.y): r.iso3 for r in country.nearest_zone(places, index, limit).collect()}
    for x, y in pts:
        ranked = sorted((0.0 if odd(r, x, y) else round(dist(r, x, y), 6), *attrs[i]) for i, r in zones.items())
        if abs(ranked[0][0] - limit) > 1e-5:
            assert got.get((x, y)) == (ranked[0][2] if ranked[0][0] <= limit else None), (x, y)
    assert 50 < len(got) < 450


def test_bins_of_outlines_list_only_edges_that_run_through_them(spark, shapes):
    bins = country.bin_outlines(frame(spark, shapes).withColumn("iso3", F.lit("A")), 7.0, ["iso3"]).bins
    b, sx, sy = 7.0, spatial.SHIFT_X * 7.0, spatial.SHIFT_Y * 7.0
    for r in bins.select("_bx", "_by", F.explode("_edges").alias("e")).collect():
        x0, y0, e = r._bx * b + sx, r._by * b + sy, r.e
        t = np.linspace(0, 1, 4001)
        x, y = e.x + t * e.dx, e.y + t * e.dy
        tiny = 0.02 * b
        assert ((x >= x0 - tiny) & (x <= x0 + b + tiny) & (y >= y0 - tiny) & (y <= y0 + b + tiny)).any()


def test_no_polygons_and_a_buffer_beyond_the_reach(spark, shapes):
    df = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert spatial.points_in_polygons(df, None, F.col("x"), F.col("y")).first().on_meadow is False
    with pytest.raises(ValueError):
        spatial.points_in_polygons(df, spatial.build_index(frame(spark, shapes), 7.0), F.col("x"), F.col("y"), 1.0)


def test_large_dimension_is_joined_by_shuffle_with_hot_keys_split(spark):
    facts = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("k"))
    facts = facts.unionByName(spark.createDataFrame([(-1, None), (-2, 999)], "id long, k int"))
    dim = spark.range(50).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    small, large = (lookup_join(facts, dim, ["k"], s, rows_per_split=100) for s in (True, False))
    rows = lambda df: sorted(df.select("id", "k", "v").collect(), key=str)
    assert rows(small) == rows(large) and large.count() == 3002
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_index_over_the_limit_gives_the_same_answer(spark, shapes):
    df = spark.range(800).select((F.col("id") % 40 * 2.5).alias("x"), (F.floor(F.col("id") / 40) * 5.1).alias("y"))
    small, large = (spatial.build_index(frame(spark, shapes), 7.0, limit=n) for n in (10**6, 1))
    assert small.small and not large.small
    rows = lambda i: sorted(tuple(r) for r in spatial.points_in_polygons(df, i, F.col("x"), F.col("y")).collect())
    assert rows(small) == rows(large)


# ------------------------------------------------------------------------------------------------------------- geometry
def at(spark, rows, cols, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, cols).select(*exprs).collect()]


def test_projection_round_trips_and_keeps_area(spark):
    pts = [(15.0, 38.0), (3.1, 42.5), (-5.9, 36.0), (36.2, 31.0), (12.0, 45.9)]
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame(pts, "lon double, lat double").withColumns({"x": x, "y": y})
    lon, lat = geo.to_lonlat(F.col("x"), F.col("y"))
    for (a, b), r in zip(pts, df.withColumns({"lo": lon, "la": lat}).collect()):
        assert r.lo == pytest.approx(a, abs=1e-7) and r.la == pytest.approx(b, abs=1e-7)
    assert (df.first().x, df.first().y) == (0.0, 0.0) or max(abs(df.first().x), abs(df.first().y)) < 1e-6
    # a small quadrilateral has the area it has on the ellipsoid
    d = 1e-3
    corners = [(20.0, 35.0), (20.0 + d, 35.0), (20.0 + d, 35.0 + d), (20.0, 35.0 + d)]
    p = at(spark, corners, "lon double, lat double", *geo.to_metric(F.col("lon"), F.col("lat")))
    planar = abs(sum(p[i][0] * p[(i + 1) % 4][1] - p[(i + 1) % 4][0] * p[i][1] for i in range(4))) / 2
    s = math.sin(math.radians(35.0 + d / 2))
    m, n = 6378137.0 * (1 - geo.E2) / (1 - geo.E2 * s * s) ** 1.5, 6378137.0 / math.sqrt(1 - geo.E2 * s * s)
    assert planar == pytest.approx(m * n * math.cos(math.asin(s)) * math.radians(d) ** 2, rel=1e-6)


def test_web_mercator(spark):
    (got,) = at(spark, [(1113194.9079327357, 4865942.279503176)], "x double, y double", *geo.from_web_mercator(F.col("x"), F.col("y")))
    assert got == pytest.approx((10.0, 40.0), abs=1e-9)


def test_cells_are_the_nearest_centre_and_neighbours_ring_them(spark):
    rng = np.random.default_rng(3)
    pts = [(float(x), float(y)) for x, y in rng.uniform(-40000, 40000, (300, 2))]
    df = spark.createDataFrame(pts, "x double, y double").withColumn("cell", geo.cell_of(F.col("x"), F.col("y")))
    q, r = geo.cell_axial(F.col("cell"))
    cx, cy = geo.axial_centre(q, r)
    df = df.withColumns({"cx": cx, "cy": cy, "ring": geo.neighbours(F.col("cell"))})
    centre = lambda c: (geo.CELL_SIDE_M * math.sqrt(3) * (int(c.split("_")[0]) + int(c.split("_")[1]) / 2), geo.CELL_SIDE_M * 1.5 * int(c.split("_")[1]))
    for row in df.collect():
        assert len(set(row.ring)) == 7 and row.cell in row.ring
        d = {c: math.dist(centre(c), (row.x, row.y)) for c in row.ring}
        assert min(d, key=d.get) == row.cell
        width = geo.CELL_SIDE_M * math.sqrt(3)
        assert all(math.dist(centre(c), centre(row.cell)) == pytest.approx(width) for c in row.ring if c != row.cell)


def test_cell_boundary_is_a_closed_ring_around_the_centre(spark):
    (r,) = spark.createDataFrame([("12_-7",)], "cell string").select(geo.cell_boundary(F.col("cell")).alias("b"), *[c.alias(n) for c, n in zip(geo.cell_centre(F.col("cell")), ("lon", "lat"))]).collect()
    assert len(r.b) == 7 and r.b[0] == r.b[-1]
    assert odd([[(v.lon, v.lat) for v in r.b[:-1]]], r.lon, r.lat)


def meadows(spark, *rings):
    return spark.createDataFrame([(i, [[{"lon": a, "lat": b} for a, b in ring] for ring in rs]) for i, rs in enumerate(rings)], "pid int, rings array<array<struct<lon:double,lat:double>>>")


SQUARE = [(15.00, 38.00), (15.10, 38.00), (15.10, 38.08), (15.00, 38.08)]


def test_edges_close_open_rings_and_agree_with_consecutive_vertices(spark):
    closed, opened = (meadows(spark, [r]) for r in (SQUARE + SQUARE[:1], SQUARE))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    e = rows(spatial.polygon_edges(opened))
    assert len(e) == 4 and e == rows(spatial.polygon_edges(closed))
    assert e == rows(spatial.consecutive_vertices(spatial.ring_vertices(closed)))


def test_area_counts_overlaps_once_and_subtracts_holes(spark):
    p = Params()
    hole = [(15.04, 38.03), (15.06, 38.03), (15.06, 38.05), (15.04, 38.05)]
    whole = spatial.cell_area(build.index_meadows(meadows(spark, [SQUARE]), p), 50.0).agg(F.sum("meadow_km2")).first()[0]
    twice = spatial.cell_area(build.index_meadows(meadows(spark, [SQUARE], [SQUARE]), p), 50.0).agg(F.sum("meadow_km2")).first()[0]
    holed = spatial.cell_area(build.index_meadows(meadows(spark, [SQUARE, hole]), p), 50.0).agg(F.sum("meadow_km2")).first()[0]
    exact = 0.1 * 0.08 * math.cos(math.radians(38.04)) * 111.32 * 111.0
    assert whole == pytest.approx(exact, rel=0.02) and twice == pytest.approx(whole)
    assert holed == pytest.approx(whole * (1 - 0.0004 / 0.008), rel=0.02)


def test_touching_cells_cover_the_polygon_and_a_tiny_one_has_its_own_cell(spark):
    p = Params()
    tiny = [(16.0, 39.0), (16.0001, 39.0), (16.00005, 39.0001)]
    m = meadows(spark, [SQUARE], [tiny])
    index = build.index_meadows(m, p)
    edges = spatial.planar_edges(spatial.polygon_edges(m))
    cover = spatial.cells_covering(edges, index, p.buffer_m)
    got = {pid: {r.cell for r in cover.where(F.col("pid") == pid).collect()} for pid in (0, 1)}
    x, y = geo.to_metric(F.lit(16.00005), F.lit(39.00004))
    own = spark.range(1).select(geo.cell_of(x, y)).first()[0]
    assert own in got[1] and len(got[1]) <= 3
    # every lattice point of the square lies in a covering cell
    lattice = [(15.0 + i / 300, 38.0 + j / 300) for i in range(1, 30) for j in range(1, 24)]
    df = spark.createDataFrame(lattice, "lon double, lat double").withColumns(dict(zip("xy", geo.to_metric(F.col("lon"), F.col("lat")))))
    assert {r[0] for r in df.select(geo.cell_of(F.col("x"), F.col("y"))).collect()} <= got[0]
    assert {r.cell for r in spatial.cell_area(index).collect()} <= got[0] | got[1]


# ------------------------------------------------------------------------------------------------------------- country
def zone(lon0, lat0, lon1, lat1):
    return [[{"lon": float(a), "lat": float(b)} for a, b in ((lon0, lat0), (lon1, lat0), (lon1, lat1), (lon0, lat1), (lon0, lat0))]]


ZONES = "pid int, priority int, iso3 string, rings array<array<struct<lon:double,lat:double>>>"


def countries(spark, zones, points, p=Params()):
    index = country.index_zones(spark.createDataFrame(zones, ZONES), p) if zones is not None else None
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, lon double, lat double")
    return [r.country for r in country.assign_country(df, index, F.col("lon"), F.col("lat"), p).orderBy("i").collect()]


def test_country_by_priority_then_nearest_then_unknown(spark):
    zones = [(0, 1, "AAA", zone(0, 36, 2, 38)), (1, 0, "BBB", zone(1, 36, 3, 38)), (2, 3, "CCC", zone(3.5, 36, 4, 38)), (3, 0, "UNK", zone(6, 36, 7, 38)),
             (4, 2, "DDD", zone(7.05, 36, 8, 38))]
    pts = [(0.5, 37), (1.5, 37), (3.1, 37), (3.45, 37), (3.25, 37), (5.0, 37), (7.02, 37), (6.98, 37), (2.9, 38.1), (0.5, 38.3)]
    # 6.98 lies inside the zone of an unknown holder and is nearest to it; 3.25 is beyond 20 km of both
    assert countries(spark, zones, pts) == ["AAA", "BBB", "BBB", "CCC", "UNK", "UNK", "UNK", "UNK", "BBB", "UNK"]


def test_country_ties_at_a_shared_corner_go_to_the_better_priority(spark):
    triangle = lambda *c: [[{"lon": float(a), "lat": float(b)} for a, b in (*c, c[0])]]
    zones = [(0, 2, "AAA", triangle((2, 38), (0, 36), (1.5, 36))), (1, 1, "BBB", triangle((2.5, 36), (4, 36), (2, 38)))]
    assert countries(spark, zones, [(2.0, 38.05), (1.99, 38.1)]) == ["BBB", "BBB"]


def test_country_without_zones_or_snapping(spark):
    assert countries(spark, None, [(1, 37)]) == ["UNK"]
    assert countries(spark, [(0, 0, "AAA", zone(0, 36, 2, 38))], [(1, 37), (2.1, 37)], Params(eez_max_distance_m=0)) == ["AAA", "UNK"]
