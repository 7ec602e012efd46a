"""Simplified outlines and layers of a given size."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS
from fathomline.functions import geo, outlines
from fathomline.operators import checks, publish, spatial
from fathomline.plans import build
from fathomline.sources import files


def wavy(n, cx=0.0, cy=0.0, r=100.0, seed=0, rough=0.05):
    rng = np.random.default_rng(seed)
    a = np.arange(n) * 2 * math.pi / n
    d = r * (1 + rough * rng.normal(size=n))
    ring = np.column_stack((cx + d * np.cos(a), cy + d * np.sin(a)))
    return np.concatenate((ring, ring[:1]))


def plain(points, tolerance):
    """Douglas-Peucker, by recursion."""
    if len(points) < 3:
        return list(points)
    (ax, ay), (bx, by) = points[0], points[-1]
    n = (bx - ax) ** 2 + (by - ay) ** 2
    best, at = -1.0, 0
    for i, (x, y) in enumerate(points[1:-1], 1):
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / n)) if n else 0.0
        d = math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))
        if d > best:
            best, at = d, i
    if best <= tolerance:
        return [points[0], points[-1]]
    return plain(points[: at + 1], tolerance)[:-1] + plain(points[at:], tolerance)


@pytest.mark.parametrize("tolerance", [0.5, 3.0, 15.0])
def test_thinning_equals_a_plain_version(tolerance):
    for seed in range(6):
        ring = wavy(300, seed=seed)
        far = int(np.argmax(((ring[:-1] - ring[0]) ** 2).sum(axis=1)))
        pts = [tuple(p) for p in ring.tolist()]
        want = plain(pts[: far + 1], tolerance)[:-1] + plain(pts[far:], tolerance)
        assert [tuple(p) for p in ring[outlines.thinned(ring, tolerance)].tolist()] == want


def test_small_rings_keep_their_shape():
    ring = wavy(40, r=1.0)
    kept = ring[outlines.thinned(ring, 1000.0)]
    assert len(kept) >= 4 and (kept[0] == kept[-1]).all()
    triangle = wavy(3)
    assert len(outlines.thinned(triangle, 1e6)) == 4


def crosses(rings):
    """Every pair of edges."""
    edges = [(i, *r[k], *r[k + 1]) for i, r in enumerate(rings) for k in range(len(r) - 1)]
    s = lambda ax, ay, bx, by, x, y: (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    return {o for i, a, b, c, d in edges for j, e, f, g, h in edges
            if s(a, b, c, d, e, f) * s(a, b, c, d, g, h) < 0 and s(e, f, g, h, a, b) * s(e, f, g, h, c, d) < 0 for o in (i, j)}


def test_crossings_equal_comparing_all_pairs():
    rng = np.random.default_rng(1)
    seen = set()
    for k in range(30):
        rings = [wavy(int(rng.integers(3, 25)), *rng.uniform(0, 90, 2), r=12, seed=100 * k + i, rough=rng.choice([0.05, 0.6])) for i in range(4)]
        got = outlines.crossing(rings)
        assert got == crosses(rings)
        seen.add(len(got))
    assert len(seen) > 2


def test_simplifying_does_not_make_outlines_cross():
    # a thin bay, and a hole close to the shore, which a coarse outline would cut
    outer = np.array([(0, 0), (100, 0), (100, 100), (52, 100), (51, 10), (50.5, 9), (50, 10), (49, 100), (0, 100), (0, 0)], dtype=float)
    hole = np.array([(46, 20), (48.9, 20), (49.3, 50), (48.9, 80), (46, 80), (46, 20)], dtype=float)
    assert not crosses([outer, hole])
    for tolerance in (0.4, 3, 60):
        out = outlines.simplified([outer, hole], tolerance)
        assert not crosses(out) and all(len(r) >= 4 for r in out)


def polygons(spark, rings, parts):
    x0, y0 = 1000.0, 2000.0
    v = spark.createDataFrame([(pid, [[(float(x) + x0, float(y) + y0) for x, y in r] for r in rs]) for pid, rs in rings.items()],
                              "pid int, rings array<array<struct<x:double,y:double>>>")
    at = lambda p: F.struct(*[c.alias(n) for c, n in zip(geo.to_lonlat(p.x, p.y), ("lon", "lat"))])
    part = spark.createDataFrame(list(parts.items()), "pid int, parts array<int>")
    return v.join(part, "pid").withColumn("rings", F.transform("rings", lambda r: F.transform(r, at)))


def test_a_layer_gets_coarser_until_it_has_its_size(spark, tmp_path):
    rings = {i: [wavy(400, 3000 * i, 0, 1000, seed=i, rough=0.01)] for i in range(8)}
    rings[20] = [wavy(300, 0, 9000, 1000, seed=20, rough=0.01), wavy(100, 0, 9000, 300, seed=21, rough=0.01), wavy(300, 1200, 9000, 1000, seed=22, rough=0.01),
                 wavy(50, 1200, 9000, 200, seed=23, rough=0.01)]
    rings[21] = [wavy(9, 0, 20000, 0.4, seed=24)]  # smaller than any tolerance
    df = polygons(spark, rings, {**{i: [0] for i in (*range(8), 21)}, 20: [0, 0, 1, 1]})
    whole, fine = publish.sized_layer(df, 2.0)
    layer, tolerance = publish.sized_layer(df, 2.0, target_bytes=30_000)
    assert fine == 2.0 and tolerance in [pytest.approx(2.0 * 1.6**k) for k in range(1, 8)]
    files.write_geojson(layer, f"{tmp_path}/layer")
    text = [r.value for r in spark.read.text(f"{tmp_path}/layer").collect()]
    assert sum(len(t.encode()) + 1 for t in text) < 30_000 < sum(len(r.value) + 1 for r in whole.select(files.feature_text(whole)).collect())
    features = {f["properties"]["id"]: f["geometry"] for f in map(json.loads, text)}
    assert set(features) == set(rings)
    two = features[20]
    assert two["type"] == "MultiPolygon" and [len(p) for p in two["coordinates"]] == [2, 2]
    assert all(g["type"] == "Polygon" and len(g["coordinates"]) == 1 for i, g in features.items() if i != 20)
    for g in features.values():
        for p in g["coordinates"] if g["type"] == "MultiPolygon" else [g["coordinates"]]:
            assert all(len(r) >= 4 and r[0] == r[-1] for r in p)
    assert all(r.violations == 0 for r in checks.check_polygons(layer).collect())
    # attempts are bounded: an impossible target leaves the coarsest
    _, last = publish.sized_layer(df, 2.0, target_bytes=10)
    assert last == pytest.approx(2.0 * 1.6**7)


def test_overlapping_parts_are_a_union_and_holes_belong_to_their_part(spark):
    square = lambda x, y, r: np.array([(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)], dtype=float)
    # the second part covers the first one's hole
    rings = {1: [square(0, 0, 1000), square(0, 0, 200), square(500, 0, 800), square(900, 0, 50)]}
    df = polygons(spark, rings, {1: [0, 0, 1, 1]})
    index = build.index_meadows(df, DEFAULTS)
    pts = [(-150.0, -100.0), (0.0, 0.0), (-100.0, 0.0), (900.0, 0.0), (-900.0, 0.0), (1280.0, 0.0), (1400.0, 0.0), (-250.0, 0.0)]
    at = spark.createDataFrame([(i, x + 1000, y + 2000) for i, (x, y) in enumerate(pts)], "i int, x double, y double")
    got = [r.hit for r in spatial.points_in_polygons(at, index, F.col("x"), F.col("y"), 0.0, "hit").orderBy("i").collect()]
    inside = lambda x, y, cx, r: abs(x - cx) <= r and abs(y) <= r
    assert got == [(inside(x, y, 0, 1000) and not inside(x, y, 0, 200)) or (inside(x, y, 500, 800) and not inside(x, y, 900, 50)) for x, y in pts]
    km2 = spatial.cell_area(index, 10.0).agg(F.sum("meadow_km2")).first()[0]
    # each part covers the other's hole, and the second reaches 300 m beyond the first
    assert km2 == pytest.approx(4.0 + 0.3 * 1.6, rel=0.02)
