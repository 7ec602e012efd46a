"""Simplifying polygon outlines: Douglas-Peucker per ring, with a check that no outline crosses itself or another of its part.

Tasks take polygons one by one; what a polygon becomes depends on nothing but itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def thinned(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Positions of the vertices of a closed ring to keep: none of the others is farther than ``tolerance`` from the new outline.

    The ring is anchored at its first vertex and the one farthest from it. At least four positions are returned, the closing one
    included, where the ring has as many different vertices: the tolerance is halved until they are left.
    """
    n = len(ring) - 1
    if n < 4 or tolerance <= 0:
        return np.arange(n + 1)
    far = int(np.argmax(((ring[:n] - ring[0]) ** 2).sum(axis=1)))
    keep = np.zeros(n + 1, dtype=bool)
    keep[[0, far, n]] = True
    open_ = [(0, far), (far, n)]
    while open_:
        a, b = open_.pop()
        if b - a < 2:
            continue
        p, d = ring[a + 1: b] - ring[a], ring[b] - ring[a]
        length2 = float(d @ d)
        t = np.clip(p @ d / length2, 0, 1) if length2 else np.zeros(len(p))
        gap = ((p - t[:, None] * d) ** 2).sum(axis=1)
        k = int(np.argmax(gap))
        if gap[k] > tolerance * tolerance:
            keep[a + 1 + k] = True
            open_ += [(a, a + 1 + k), (a + 1 + k, b)]
    found = np.flatnonzero(keep)
    return found if len(found) >= 4 else thinned(ring, tolerance / 2)


def crossing(rings: list[np.ndarray]) -> set[int]:
    """Numbers of closed rings that cross themselves or each other; touching is no crossing."""
    starts = np.concatenate([r[:-1] for r in rings])
    ends = np.concatenate([r[1:] for r in rings])
    owner = np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])
    low, high = np.minimum(starts, ends), np.maximum(starts, ends)
    order = np.argsort(low[:, 0], kind="stable")
    starts, ends, low, high, owner = starts[order], ends[order], low[order], high[order], owner[order]
    found: set[int] = set()

    def side(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
        return (b[:, 0] - a[:, 0]) * (p[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (p[:, 0] - a[:, 0])

    # edges by their left ends: each is compared with those that start before it ends, one step further a turn
    i = np.arange(len(owner))
    step = 0
    while len(i):
        step += 1
        i = i[i + step < len(owner)]
        i = i[low[i + step, 0] <= high[i, 0]]
        j = i + step
        near = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        a, b, c, d = starts[i[near]], ends[i[near]], starts[j[near]], ends[j[near]]
        hit = (side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)
        found.update(owner[i[near][hit]].tolist(), owner[j[near][hit]].tolist())
    return found


def simplified(rings: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """The rings of one part. Rings that would cross are simplified less, down to their own vertices."""
    by_ring = [tolerance] * len(rings)
    out = [r[thinned(r, tolerance)] for r in rings]
    while bad := {i for i in crossing(out) if by_ring[i] > 0}:
        for i in bad:
            by_ring[i] = by_ring[i] / 2 if by_ring[i] > tolerance / 64 else 0.0
            out[i] = rings[i][thinned(rings[i], by_ring[i])]
    return out


def simplifier(tolerance: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` over (id, parts, rings of x and y): the same with simplified, closed rings."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("rings")
            out = []
            for parts, rings in zip(b.column("parts").to_pylist(), b.column(at)):
                found: list = [None] * len(parts)
                closed = []
                for r in rings.values:
                    xy = np.column_stack([r.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
                    closed.append(xy if len(xy) and (xy[0] == xy[-1]).all() else np.concatenate((xy, xy[:1])))
                for part in set(parts):
                    own = [i for i, p in enumerate(parts) if p == part]
                    for i, r in zip(own, simplified([closed[i] for i in own], tolerance)):
                        found[i] = [{"x": x, "y": y} for x, y in r.tolist()]
                out.append(found)
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return run
