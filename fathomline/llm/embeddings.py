"""Near duplicates among embeddings: an exact range join in a metric space.

Distances are angles between unit vectors. Pivots partition the vectors: each belongs to the cell of its nearest pivot. Let r
be the angle of the cosine threshold. A vector x of another cell must also be seen by the cell of pivot q if some vector y
there can be within r of it. Two consequences of the triangle inequality bound that: the angle of x to q is at most r plus
the cell's radius, and, y being nearer to q than to x's own pivot p, x lies within r of the great sphere between p and q. So x is
seen by every cell for which both hold. Neighbouring cells are joined together, as strips: a vector is copied once to a strip,
however many of its cells see it, and is compared there with those cells only. Strips are joined block by block: a task keeps a
bounded block of home vectors and lets the vectors seen pass by in small pieces, so a cell of any size spreads over many tasks
of bounded memory.

Equal vectors are one vector with a count. Products in single precision pick candidates with a margin wider than their error;
within the margin the cosine in double precision decides. Per vector the links are counted; of the links themselves only edges
that span the linked groups of a block leave a task.

In high dimension random vectors lie at right angles to each other and to every pivot, so a threshold of 0.9 makes nearly all of
them boundary vectors; work then approaches that of comparing all with all, in blocks, and a vector is copied once for every block
of home vectors. That is a property of metric joins.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, as do vectors of
another length. Rows that repeat a vector id are one vector if the vectors are equal, else nodes of one name. A null id links
with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import arrow_schema, remove, ship
from .graph import components, hook

THRESHOLD = 0.9
#: vectors for which there is one pivot, on average, and the most pivots there are
PER_PIVOT, MAX_PIVOTS = 4096, 512
#: most rows of a block of home vectors, and of the vectors seen that pass it by in one task
HOME_BLOCK, SEEN_BLOCK = 65_536, 262_144
#: blocks that small tables are cut into as well, and the rows below which they are not
SPREAD, LEAST_BLOCK = 8, 1024
#: most numbers that a block holds, however long its vectors are
BLOCK_NUMBERS = 65_536 * 64
#: rows that are looked at together: of vectors seen, and of the home vectors they are multiplied with
SEEN_PIECE, HOME_PIECE = 8192, 512
#: most partitions that the blocks are dealt to
MAX_TASKS = 20_000
#: links that are counted together, and numbers of the vectors whose cosines are
LINKS, NUMBERS = 500_000, 4_000_000
#: more than the error of a product of unit vectors in single precision
MARGIN = 1e-3


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors of a column of packed ones."""
    return _units(np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1))


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component, valid) for every row: vectors linked directly, and the smallest id reachable by links."""
    spark = vectors.sparkSession
    ship(spark)
    rows = cut_lineage(_usable(vectors, id_col, vec_col), "vectors")
    # equal vectors fall together before anything is compared
    reps = cut_lineage(rows.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "distinct")
    counts, edges = [], []
    kind = "f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "f8"  # what holds the numbers as they are
    for dim in [r[0] for r in reps.select(F.size("v").alias("d")).distinct().collect()]:  # one, but for broken tables
        links, forest = _join(reps.where(F.size("v") == dim), threshold, dim, kind)
        counts.append(links)
        edges.append(forest)
    if counts:
        links, forest = counts[0], edges[0]
        for a, b in zip(counts[1:], edges[1:]):
            links, forest = links.unionByName(a), forest.unionByName(b)
        comp = components(forest)
        found = reps.join(links, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left").select(
            "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
        # one row of ``found`` per distinct vector; a vector with very many copies is split by adaptive skew handling
        members = rows.join(found, "v").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    else:
        members = rows.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    every = vectors.select(F.col(id_col).cast("bigint").alias("vid"))
    return every.join(members, F.col("vid") == F.col("id"), "left").select(
        F.col("vid").alias("id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vid").alias("component"), F.col("id").isNotNull().alias("valid"))


def _join(reps: DataFrame, threshold: float, dim: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """Links per distinct vector (rep, n), counted with copies, and edges (a, b) that span the linked groups."""
    spark = reps.sparkSession
    n = reps.count()
    n_pivots = min(MAX_PIVOTS, max(1, n // PER_PIVOT))
    # pivots are a bounded sample by hash; which vectors they are changes the work, not the result
    share = min(1.0, 4.0 * n_pivots / max(n, 1))
    sample = reps.where(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).orderBy(
        F.xxhash64("rep")).limit(4 * n_pivots).collect()
    pool = np.array([r["v"] for r in sample] or [reps.first()["v"]], dtype=np.float64)
    pool /= np.linalg.norm(pool, axis=1, keepdims=True)
    chosen = [0]
    nearest = pool @ pool[0]
    while len(chosen) < min(n_pivots, len(pool)):  # each next pivot is the one farthest from those before
        k = int(np.argmin(nearest))
        chosen.append(k)
        nearest = np.maximum(nearest, pool @ pool[k])
    pivots = pool[chosen]
    homes = cut_lineage(reps.mapInArrow(_assign(pivots, kind), "rep bigint, copies bigint, x binary, home int, to_pivot double"), "homes")
    stats = {r["home"]: (r["n"], r["radius"]) for r in homes.groupBy("home").agg(
        F.count(F.lit(1)).alias("n"), F.max("to_pivot").alias("radius")).collect()}  # one row per pivot
    fit = max(1, BLOCK_NUMBERS // dim)
    home_rows = min(HOME_BLOCK, fit, max(LEAST_BLOCK, -(-n // SPREAD)))
    seen_rows = min(SEEN_BLOCK, max(LEAST_BLOCK, -(-2 * n // SPREAD)))
    strips = _strips(pivots, {c: v[0] for c, v in stats.items()}, home_rows)
    bounds = _Bounds(pivots, {c: v[1] for c, v in stats.items()}, math.acos(threshold) + 1e-9)
    seen = cut_lineage(homes.mapInArrow(_spread(bounds, strips, kind), "rep bigint, copies bigint, x binary, home int, own int, strips array<int>"), "cells")
    remove(spark, homes)
    size = {r["strip"]: r["n"] for r in seen.select(F.explode("strips").alias("strip")).groupBy("strip").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = [(s, -(-sum(stats[c][0] for c in strips[s]) // home_rows), -(-size[s] // seen_rows)) for s in size]
    dealt = seen.withColumn("strip", F.explode("strips")).join(F.broadcast(spark.createDataFrame(plan, "strip int, rows int, cols int")), "strip").withColumn(
        "row", F.pmod(F.xxhash64("rep", F.lit(1)), "rows").cast("int")).withColumn("col", F.pmod(F.xxhash64("rep", F.lit(2)), "cols").cast("int"))
    down = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(i.alias("i"), F.col("col").alias("j"), F.lit(False).alias("h")))
    across = F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda j: F.struct(F.col("row").alias("i"), j.alias("j"), F.lit(True).alias("h")))
    places = F.when(F.col("strip") == F.col("own"), F.concat(across, down)).otherwise(down)
    tasks = dealt.withColumn("p", F.explode(places)).select("strip", F.col("p.i").alias("i"), F.col("p.j").alias("j"), F.col("p.h").alias("h"),
                                                           "rep", "copies", "home", "x")
    # twice as many partitions as blocks, so that few of them meet in one
    tasks = tasks.repartition(min(2 * sum(rows * cols for _, rows, cols in plan), MAX_TASKS), "strip", "i", "j").sortWithinPartitions("strip", "i", "j", F.col("h").desc())
    out = cut_lineage(tasks.mapInArrow(_compare(threshold, bounds, kind), "rep bigint, n bigint, other bigint"), "links")
    remove(spark, seen)
    return out.where("n > 0").groupBy("rep").agg(F.sum("n").alias("n")), out.where("other is not null").select(
        F.col("rep").alias("a"), F.col("other").alias("b"))


def _strips(pivots: np.ndarray, sizes: dict[int, int], most: int) -> list[list[int]]:
    """The cells, each next to its nearest one left, in groups of at most ``most`` vectors; a larger cell stands alone."""
    left = sorted(sizes)
    strips: list[list[int]] = []
    last, room = left[0], 0
    while left:
        last = left.pop(int(np.argmax(pivots[left] @ pivots[last])))
        if not strips or sizes[last] > room:
            strips.append([])
            room = most
        strips[-1].append(last)
        room -= sizes[last]
    return strips


class _Bounds:
    """Which cells may hold a vector within the angle ``r`` of a given one."""

    def __init__(self, pivots: np.ndarray, radius: dict[int, float], r: float):
        self.pivots, self.radius, self.r = pivots, radius, r

    def near(self, u: np.ndarray, home: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Unit vectors and their own cells -> a row per vector with a flag for each of ``cells``."""
        to = self.pivots[cells]
        c = u @ to.T
        own = np.einsum("ij,ij->i", u, self.pivots[home])
        reach = np.array([self.radius[k] for k in cells.tolist()])
        near = np.arccos(np.clip(c, -1, 1)) <= reach + self.r + 1e-9
        gap = np.sqrt(np.maximum(2 - 2 * (self.pivots @ to.T), 0))[home]
        near &= own[:, None] - c <= (math.sin(self.r) + 1e-9) * gap + 1e-9
        near[home[:, None] == cells[None, :]] = True
        return near


def _assign(pivots: np.ndarray, kind: str):
    schema = arrow_schema(rep=pa.int64(), copies=pa.int64(), x=pa.binary(), home=pa.int32(), to_pivot=pa.float64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(b.schema.get_field_index("v")))
            u = _units(x)
            c = u @ pivots.T
            home = c.argmax(axis=1)
            angle = np.arccos(np.clip(c[np.arange(len(u)), home], -1, 1))
            packed = pa.array([row.tobytes() for row in x.astype(kind)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("rep")), b.column(b.schema.get_field_index("copies")),
                                              packed, pa.array(home, pa.int32()), pa.array(angle)], schema=schema)

    return run


def _spread(bounds: _Bounds, strips: list[list[int]], kind: str):
    cells = np.array([c for s in strips for c in s], dtype=np.int64)
    starts = np.cumsum([0, *(len(s) for s in strips[:-1])])
    strip_of = np.zeros(len(bounds.pivots), dtype=np.int32)
    for k, s in enumerate(strips):
        strip_of[s] = k
    schema = arrow_schema(rep=pa.int64(), copies=pa.int64(), x=pa.binary(), home=pa.int32(), own=pa.int32(), strips=pa.list_(pa.int32()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, SEEN_PIECE // 4) for whole in batches for at in range(0, whole.num_rows, SEEN_PIECE // 4)):
            home = b.column(3).to_numpy()
            near = np.logical_or.reduceat(bounds.near(_unpacked(b.column(2), kind), home, cells), starts, axis=1)
            row, at = np.nonzero(near)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(home)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(strip_of[home], pa.int32()),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))], schema=schema)

    return run


def _cosines(u: np.ndarray, i: np.ndarray, v: np.ndarray, j: np.ndarray) -> np.ndarray:
    step = max(1, NUMBERS // u.shape[1])
    return np.concatenate([np.einsum("ij,ij->i", u[i[k: k + step]], v[j[k: k + step]]) for k in range(0, len(i), step)])


_LINK = arrow_schema(rep=pa.int64(), n=pa.int64(), other=pa.int64())


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.zeros(len(a), np.int64)), pa.array(np.maximum(a, b))], schema=_LINK)


class _Block:
    """Home vectors of one task, and what is known of their links so far."""

    def __init__(self, threshold: float, bounds: _Bounds, kind: str):
        self.threshold, self.bounds, self.kind = threshold, bounds, kind
        self.given: list[pa.RecordBatch] = []
        self.closed = False

    def take(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows of the block, home vectors before all that are seen; yields edges of the links found."""
        n = int(b.column(3).to_numpy(zero_copy_only=False).astype(bool).sum())
        if n:
            self.given.append(b.slice(0, n))
        if n < b.num_rows and (self.closed or self.given):
            if not self.closed:
                self._close()
            for at in range(n, b.num_rows, SEEN_PIECE):
                yield from self._see(b.slice(at, min(SEEN_PIECE, b.num_rows - at)))

    def _close(self) -> None:
        ids, home = (np.concatenate([b.column(k).to_numpy() for b in self.given]) for k in (4, 6))
        order = np.lexsort((ids, home))
        self.ids, home = ids[order], home[order]
        self.u = np.concatenate([_unpacked(b.column(7), self.kind) for b in self.given])[order]
        self.single = self.u.astype(np.float32)
        self.cells, first = np.unique(home, return_index=True)
        self.ends = [*first.tolist(), len(home)]
        self.by_id = np.argsort(self.ids)
        self.n = np.zeros(len(home), dtype=np.int64)
        self.root = np.arange(len(home))
        self.given, self.closed = [], True

    def _see(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, copies, home = (b.column(k).to_numpy() for k in (4, 5, 6))
        u = _unpacked(b.column(7), self.kind)
        near, y = self.bounds.near(u, home, self.cells), u.astype(np.float32)
        # a vector seen that is at home here is that node, any other one a further node
        at = self.by_id[np.minimum(np.searchsorted(self.ids, ids, sorter=self.by_id), len(self.ids) - 1)]
        node = np.where(self.ids[at] == ids, at, len(self.ids) + np.arange(len(ids)))
        root = np.concatenate([self.root, len(self.ids) + np.arange(len(ids))])
        for k in range(len(self.cells)):
            m = np.flatnonzero(near[:, k])
            some = y[m]
            for lo in range(self.ends[k], self.ends[k + 1] if len(m) else 0, HOME_PIECE):
                c = (self.single[lo: min(lo + HOME_PIECE, self.ends[k + 1])] @ some.T).ravel()
                hits = np.flatnonzero(c >= self.threshold - MARGIN)
                for s in range(0, len(hits), LINKS):
                    hit = hits[s: s + LINKS]
                    i, j = np.divmod(hit, len(m))
                    i, j = i + lo, m[j]
                    linked = self.ids[i] != ids[j]
                    close = np.flatnonzero(c[hit] < self.threshold + MARGIN)
                    if len(close):
                        linked[close] &= _cosines(self.u, i[close], u, j[close]) >= self.threshold
                    i, j = i[linked], j[linked]
                    np.add.at(self.n, i, copies[j])
                    apart = root[i] != root[node[j]]
                    hook(root, i[apart], node[j][apart])
        self.root = root[: len(self.ids)]
        new = np.flatnonzero(root[node] < len(self.ids)) if len(ids) else []
        new = new[node[new] >= len(self.ids)]
        if len(new):
            yield _edges(ids[new], self.ids[root[node[new]]])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.closed:
            i = np.flatnonzero(self.n)
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[i]), pa.array(self.n[i]), pa.nulls(len(i), pa.int64())], schema=_LINK)
            i = np.flatnonzero(self.root != np.arange(len(self.root)))
            yield _edges(self.ids[i], self.ids[self.root[i]])


def _compare(threshold: float, bounds: _Bounds, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            k = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.concatenate(([0], np.flatnonzero(np.any(k[1:] != k[:-1], axis=1)) + 1, [len(k)])) if len(k) else [0]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if key != tuple(k[s]):
                    if block is not None:
                        yield from block.end()
                    key, block = tuple(k[s]), _Block(threshold, bounds, kind)
                yield from block.take(batch.slice(s, e - s))
        if block is not None:
            yield from block.end()

    return run
