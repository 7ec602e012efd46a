"""Connected components of a link table: large-star and small-star rounds, and one task for what fits in it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import remove, ship

#: edges that one task solves in memory (16 MB of them); larger tables go through rounds of joins
ONE_TASK = 1_000_000


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def hook(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Let the nodes of each edge (u, v) have one root, the smallest, in an array of all nodes' roots."""
    while True:
        x, y = root[u], root[v]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root[:] = shorter


def lowest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their components for edges in memory, by hooking roots to smaller roots and shortening paths."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    hook(root, index[: len(a)], index[len(a):])
    return nodes, nodes[root]


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
    if parts:
        nodes, low = lowest_reachable(*(np.concatenate(c) for c in zip(*parts)))
        for lo in range(0, len(nodes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[lo: lo + 100_000]), pa.array(low[lo: lo + 100_000])], names=["node", "component"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) for every node that some edge (a, b) names; the component is its smallest node.

    Edges may repeat, point either way or join a node to itself; edges with a null end count for nothing. Up to ``one_task``
    distinct edges are solved by one task, within a memory that this bounds. More go through rounds of large-star and
    small-star, as many as the logarithm of the nodes, each a written table, so none repeats another; a node with very many
    neighbours is counted by partial minima, and the join that follows is left to adaptive skew handling.
    """
    spark = edges.sparkSession
    ship(spark)
    first = cut_lineage(edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where(
        "a is not null and b is not null").distinct(), "edges")
    if first.count() <= one_task:
        return first.repartition(1).mapInArrow(_solve, "node bigint, component bigint")
    e, seen = first, None
    while True:
        step = cut_lineage(_small_star(_large_star(e)), "star")
        mark = step.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if e is not first:
            remove(spark, e)
        e = step
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    roots = e.groupBy("a").agg(F.min("b").alias("component"))
    every = first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node"))).distinct()
    return every.join(roots, every.node == roots.a, "left").select(
        "node", F.coalesce("component", "node").alias("component"))
