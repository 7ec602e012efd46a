"""Vector code compression: every vector becomes one entry number per part, from codebooks learned in whole numbers.

Vectors are cut into parts. Per part position, the distinct parts with their numbers of copies are written once, in
lexicographic order: the depth-first order of a trie whose edges are components. A walk carries, for every node on its path, the
squared distances so far to all entries of the codebook. Parts that share their first components share those nodes, so a
component adds one term per node, not per part. At a leaf the nearest entry is taken and the part's components, times its
copies, are added to that entry's sums. Only those sums leave a task. Tasks hold ranges of the order, and a walk keeps its path from
one block of leaves to the next.

When the codebooks stand, each task codes its own vectors by the same walk over the distinct parts of a block of them. Nothing is
shuffled for that; a vector that a third of all rows share is one leaf per block.

Defined cases: rows whose vector is null or holds a null or non-finite component are dropped, and so are rows of another length than
the most frequent one that can be cut into equal parts (of several, the longest). Null ids and labels are kept; null ids come
last where the first vectors start the codebooks; of equal ids the smaller vector comes first. With fewer rows than entries the
codebooks are as short as that. Components are whole numbers up to 2^62; larger ones are held there. Beyond 2^28 the walk goes on in
unbounded integers; an error that fits no 64-bit integer is null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..runtime import cut_lineage
from .common import ship

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: leaves of a walk taken at once
BLOCK = 1 << 14
#: components below this have squared distances that fit 64 bits in parts of up to 16 components
NARROW = 1 << 28


class Walk:
    """A depth-first walk over parts in lexicographic order, against one codebook (entries by components).

    ``nearest`` takes the next leaves of the walk and returns the entry and squared distance of each. The path to the last leaf
    is kept, so the next call goes on from the deepest node it shares.
    """

    def __init__(self, codebook: np.ndarray):
        self.codebook = codebook
        self.last: np.ndarray | None = None
        self.path: list[np.ndarray] = []

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, depth = parts.shape
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        wide = depth > 16 or max(_largest(parts), _largest(self.codebook)) >= NARROW
        kind = object if wide else np.int64
        parts, codebook = parts.astype(kind), self.codebook.astype(kind)
        # a leaf opens a node at every depth behind the components it shares with the leaf before
        opens = np.ones((n, depth), dtype=bool)
        opens[1:] = ~np.logical_and.accumulate(parts[1:] == parts[:-1], axis=1)
        if self.last is not None:
            opens[0] = ~np.logical_and.accumulate(parts[0] == self.last)
        path = []
        sums, node = np.zeros((1, len(codebook)), dtype=kind), np.zeros(n, dtype=np.int64)
        for d in range(depth):
            leaf = np.flatnonzero(opens[:, d])
            term = parts[leaf, d][:, None] - codebook[None, :, d]
            opened = sums[node[leaf]] + term * term
            node = np.cumsum(opens[:, d])  # 0: still below the node of the path
            carried = self.path[d].astype(kind) if self.path else np.zeros(len(codebook), dtype=kind)
            sums = np.concatenate((carried[None], opened))
            path.append(sums[node[-1]])
        self.last, self.path = parts[-1], path
        at_leaf = sums[node]
        entry = at_leaf.argmin(axis=1)  # the first of equals
        return entry, at_leaf[np.arange(n), entry]


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0


def _rows_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """(id, label, v) of the usable rows, components as whole numbers, and the length of a part; 0 without any."""
    v = F.col(vec_col).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = float(1 << 62)
    number = F.transform(v, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x * F.lit(float(scale))).cast("double"))).cast("bigint"))
    kept = vectors.where(F.coalesce(usable, F.lit(False)) & (F.size(vec_col) > 0) & (F.size(vec_col) % parts == 0)).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), number.alias("v"))
    kept = cut_lineage(kept, "whole")
    common = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not common:
        return kept, 0
    return kept.where(F.size("v") == common[0]["d"]), common[0]["d"] // parts


def distinct_parts(kept: DataFrame, parts: int, width: int) -> DataFrame:
    """(pos, part, copies), each part once, in tables whose files hold ranges of the lexicographic order."""
    cut = F.array(*[F.slice("v", p * width + 1, width) for p in range(parts)])
    counted = kept.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("copies"))
    # ranges need a sample of the distinct parts: count once, deal from the written table
    counted = cut_lineage(counted, "parts")
    return cut_lineage(counted.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "trie")


def _sums(codebooks: list[np.ndarray]):
    """Per task and (position, entry): copies of the parts nearest to it, and the sums of their components."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, width = codebooks[0].shape
        total = np.zeros((len(codebooks), entries, width + 1), dtype=object)
        walks = [Walk(c) for c in codebooks]
        for b in batches:
            pos = b.column(0).to_numpy()
            rows, copies = _rows_of(b.column(1), width), b.column(2).to_numpy()
            cuts = np.flatnonzero(np.diff(pos)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(pos)]):
                for at in range(low, high, BLOCK):
                    some = slice(at, min(at + BLOCK, high))
                    entry, _ = walks[pos[low]].nearest(rows[some])
                    wide = max(_largest(rows[some]), 1) * int(copies[some].sum()) >= 1 << 62
                    kind = object if wide else np.int64
                    add = np.zeros((entries, width + 1), dtype=kind)
                    n = copies[some].astype(kind)
                    np.add.at(add, entry, np.concatenate((rows[some].astype(kind) * n[:, None], n[:, None]), axis=1))
                    total[pos[low]] += add.astype(object)
        p, e = np.nonzero(total[:, :, width])
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()),
             pa.array([[Decimal(int(x)) for x in total[i, j]] for i, j in zip(p, e)], pa.list_(pa.decimal128(38, 0)))], ["pos", "entry", "sums"])

    return run


def learn(trie: DataFrame, codebooks: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Move every entry to the rounded-down mean of the parts nearest to it, ``rounds`` times; unused entries stay."""
    for _ in range(rounds):
        part_sums = trie.mapInArrow(_sums(codebooks), "pos int, entry int, sums array<decimal(38,0)>")
        summed = part_sums.select("pos", "entry", F.posexplode("sums").alias("k", "x")).groupBy("pos", "entry", "k").agg(F.sum("x").alias("x"))
        codebooks = [c.copy() for c in codebooks]
        by_entry: dict[tuple[int, int], dict[int, int]] = {}
        for r in summed.collect():  # components of all entries: as large as the codebooks
            by_entry.setdefault((r["pos"], r["entry"]), {})[r["k"]] = int(r["x"])
        for (p, e), sums in by_entry.items():
            n = sums.pop(max(sums))
            codebooks[p][e] = [sums[k] // n for k in range(len(sums))]
    return codebooks


def _codes(codebooks: list[np.ndarray]):
    """Code and error of every vector, block by block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = codebooks[0].shape[1]
        for whole_batch in batches:
            for at in range(0, len(whole_batch), BLOCK):
                b = whole_batch.slice(at, BLOCK)
                rows = _rows_of(b.column(2), width * len(codebooks))
                digits = np.zeros((len(rows), len(codebooks)), dtype=np.uint8)
                error = np.zeros(len(rows), dtype=object)
                for p, codebook in enumerate(codebooks):
                    part = rows[:, p * width: (p + 1) * width]
                    order = np.lexsort(part.T[::-1])
                    ordered = part[order]
                    first = np.ones(len(order), dtype=bool)
                    first[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
                    entry, far = Walk(codebook).nearest(ordered[first])
                    leaf = np.cumsum(first) - 1
                    digits[order, p] = entry[leaf]
                    error[order] += far[leaf].astype(object)
                errors = [int(x) if x < 1 << 63 else None for x in error]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes().hex() for r in digits], pa.string()),
                                                  pa.array(errors, pa.int64())], ["id", "label", "code", "error"])

    return run


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of the usable vectors, and the codebooks; code has two hex digits per part."""
    if not 0 < entries <= 256:
        raise ValueError("an entry number has two hex digits")
    spark = vectors.sparkSession
    ship(spark)
    kept, width = whole(vectors, id_col, vec_col, label_col, parts, scale)
    types = {f.name: f.dataType for f in kept.schema}
    schema = StructType([StructField("id", types["id"]), StructField("label", types["label"]), StructField("code", StringType()),
                         StructField("error", LongType())])
    if not width:
        return spark.createDataFrame([], schema), []
    start = np.array([r["v"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()], dtype=np.int64)
    codebooks = [start[:, p * width: (p + 1) * width] for p in range(parts)]
    codebooks = learn(distinct_parts(kept, parts, width), codebooks, rounds)
    return kept.select("id", "label", "v").mapInArrow(_codes(codebooks), schema), codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for c in codebooks for x in c.ravel()).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors summed over the rows of the same label; nulls are one label."""
    by_label = coded.groupBy(F.col("label").alias("_of")).agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_of")), "left").drop("_of")
