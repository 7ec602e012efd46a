"""Edges that are made once, and cells that need no look at all sides of their hexagon."""

import math
import random

from fathomline.functions import geo
from fathomline.operators import spatial


def _octagon(r, n=8):
    x, y, size = r.uniform(-9000, 9000), r.uniform(-9000, 9000), r.choice([30.0, 400.0, 1300.0, 4000.0])
    turn = r.random()
    return [(x + size * math.cos(turn + 2 * math.pi * k / n), y + size * math.sin(turn + 2 * math.pi * k / n)) for k in range(n)]


def _edges(spark, rings):
    return spark.createDataFrame([(i, *a, *b) for i, v in enumerate(rings) for a, b in zip(v, [*v[1:], v[0]])],
                                 "pid int, x1 double, y1 double, x2 double, y2 double")


def test_edges_are_made_once_for_index_and_cells(spark):
    index = spatial.build_index(_edges(spark, [_octagon(random.Random(1))]), 1000.0, 20.0)
    assert index.edges.inputFiles() and index.edges.count() == 8


def test_cells_near_edges_match_a_look_at_all_sides(spark):
    r = random.Random(5)
    rings = [_octagon(r) for _ in range(40)]
    for buffer_m in (0.0, 20.0):
        got = {(row.pid, row.cell) for row in spatial.cells_near_edges(_edges(spark, rings), buffer_m).distinct().collect()}
        want = set()
        side = geo.CELL_SIDE_M
        for pid, v in enumerate(rings):
            for a, b in zip(v, [*v[1:], v[0]]):
                for i in range(-12, 13):
                    for j in range(-12, 13):
                        cx, cy = side * 3**0.5 * (i + j / 2), 1.5 * side * j
                        if math.hypot(cx - a[0], cy - a[1]) < side + buffer_m + math.dist(a, b) and _gap(a, b, cx, cy, side) <= buffer_m:
                            want.add((pid, f"{i}_{j}"))
        assert got == want


def _gap(a, b, cx, cy, side):
    """Distance of an edge and a hexagon, by fine steps along the edge where neither end nor a crossing settles it."""
    corners = [(cx + x, cy + y) for x, y in geo.corner_offsets(side)]
    sides = list(zip(corners, [*corners[1:], corners[0]]))
    turn = lambda p, q, o: (q[0] - p[0]) * (o[1] - p[1]) - (q[1] - p[1]) * (o[0] - p[0])
    signs = {turn(p, q, a) > 0 for p, q in sides}
    if len(signs) == 1 or any((turn(a, b, p) > 0) != (turn(a, b, q) > 0) and (turn(p, q, a) > 0) != (turn(p, q, b) > 0) for p, q in sides):
        return 0.0

    def far(o, p, q):
        dx, dy = q[0] - p[0], q[1] - p[1]
        t = max(0.0, min(1.0, ((o[0] - p[0]) * dx + (o[1] - p[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(o[0] - p[0] - t * dx, o[1] - p[1] - t * dy)

    return min(min(far(a, p, q), far(b, p, q), far(p, a, b), far(q, a, b)) for p, q in sides)
