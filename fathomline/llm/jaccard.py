"""Exact Jaccard join of documents' shingle sets, by universe partition and pigeonhole.

Two sets with at least ``NUM / DEN`` of their union in common differ in few shingles. Set sizes fall into bands so narrow that a
set links only within its band or with the next; for each band the most shingles H by which two linked sets can differ is known.
The universe of shingles is hashed into m = H + 1 segments, the band's scheme; linked sets then agree in one segment at least.
Every set indexes its segments under the schemes of its own band and the one below.

Cost-based allocation. The cost of indexing a segment is the number of sets it is expected to bring together, which falls with the
shingles it holds. Thin segments, of one shingle or none, cost more than the alternative: to skip them and index one-deletion
neighbourhoods of a few richer segments. Let a linked pair agree in h segments only, all of them thin. Its other m - h segments
hold at most m - 1 differences, at least one each, so at most h - 1 of them hold more than one. Among any h segments in which one of
the sets has three shingles or more (these are not the thin ones), some segment therefore differs by exactly one shingle, and the
other set has two or more in it. So: a set indexes its segments that are not thin; if it has t > 0 thin ones, also the
one-deletion neighbourhoods of its first segments, as many as hold t with three shingles or more; if it has not so many,
those of all, and the thin segments themselves. Of two sets the one that covers fewer first segments decides, and the other
covers those too.

Sets that share an index entry are candidates. Candidates form clusters (components of the candidate graph, from the smallest member
of every entry); all links lie within clusters. A cluster is verified in blocks of bounded size, on the shingles themselves, not
on hashes: all pairs of a block that are not yet known to be connected. Blocks are dealt anew by other hashes as long as that
connects more; then what still lies in several components is compared block by block, only across components. So a family of many
near copies costs a few linear rounds, and pairs within a group are never written out.

Equal sets fall together before all this. Defined cases: a text of fewer words than a shingle has its whole sequence as its only shingle; an
empty or null text has none, links with nothing and is its own component. A null id links with nothing and has no component. Rows that
share an id are one node. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import arrow_schema, fresh, remove, ship
from .graph import components
from .wordhash import U, mix, sequence_hashes, text_chunks, word_hashes, word_spans

SHINGLE = 3
NUM, DEN = 90, 100
#: shingles and sets that a block of verification holds about
BLOCK_SHINGLES, BLOCK_SETS = 300_000, 256
#: rounds of dealing blocks anew before components are compared across blocks
ROUNDS = 4


class Schemes:
    """Size bands and the number of segments of each."""

    def __init__(self, num: int = NUM, den: int = DEN):
        lows = [1]
        while lows[-1] < 1 << 31:
            lows.append(lows[-1] * den // num + 1)
        self.lows = np.array(lows, dtype=np.int64)
        high = self.lows[1:] - 1
        # |a - b| + |b - a| <= (den - num) / (den + num) * (|a| + |b|), and |b| <= |a| * den / num
        self.segments = (den - num) * (high + high * den // num) // (den + num) + 1

    def of(self, n: int) -> list[tuple[int, int]]:
        """(scheme, segments) under which a set of ``n`` shingles is indexed. One segment links equal sets only."""
        g = int(np.searchsorted(self.lows, n, side="right")) - 1
        return [(s, int(self.segments[s])) for s in (g - 1, g) if s >= 0 and self.segments[s] > 1]


def index_entries(shingles: np.ndarray, schemes: list[tuple[int, int]]) -> np.ndarray:
    """Hashes under which a set of distinct shingle hashes is indexed."""
    spread, value = mix(shingles, 31) >> U(32), mix(shingles, 41)
    out = []
    for scheme, m in schemes:
        seg = ((spread * U(m)) >> U(32)).astype(np.int64)
        total = np.zeros(m, dtype=np.uint64)
        np.add.at(total, seg, value)
        held = np.bincount(seg, minlength=m)
        place = (np.arange(m, dtype=np.uint64) << U(1)) + U(scheme << 40)
        thin = held <= 1
        out.append(mix(total[~thin] ^ mix(place[~thin], 51), 61))
        skipped = int(thin.sum())
        if not skipped:
            continue
        rich = np.cumsum(held >= 3)
        if rich[-1] >= skipped:
            covered = int(np.searchsorted(rich, skipped)) + 1
        else:
            covered = m
            out.append(mix(total[thin] ^ mix(place[thin], 51), 61))
        near = place[:covered] + U(1)  # entries of deletion neighbourhoods are a space of their own
        whole = held[:covered] >= 2
        out.append(mix(total[:covered][whole] ^ mix(near[whole], 51), 61))
        some = (seg < covered) & (held[seg] >= 3)
        out.append(mix((total[seg[some]] - value[some]) ^ mix(near[seg[some]], 51), 61))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Distinct shingle hashes of every text, in pieces of the column: first row, rows, one array per row."""
    for first, data, bounds in text_chunks(column):
        starts, ends, words = word_spans(data, bounds)
        h = word_hashes(data, starts, ends, lower=True)
        grams = sequence_hashes(h, shingle)
        sets = []
        for a, z in zip(words[:-1].tolist(), words[1:].tolist()):
            own = grams[a: z - shingle + 1] if z - a >= shingle else sequence_hashes(h[a:z], z - a) if z > a else grams[:0]
            sets.append(np.unique(own))
        yield first, len(sets), sets


def _digests(shingle: int):
    """(doc_id, n, d1, d2) from (doc_id, text): size of the set and two sums over it that equal sets share."""
    schema = arrow_schema(doc_id=pa.int64(), n=pa.int64(), d1=pa.int64(), d2=pa.int64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, rows, sets in _shingle_sets(b.column(1), shingle):
                d1 = np.array([np.add.reduce(mix(s, 21)) for s in sets], dtype=np.uint64)
                d2 = np.array([np.bitwise_xor.reduce(mix(s, 22)) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, rows), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], schema=schema)

    return run


def _entries(num: int, den: int, shingle: int):
    """(rep, entries) from (doc_id, text)."""
    schemes = Schemes(num, den)
    schema = arrow_schema(rep=pa.int64(), entries=pa.list_(pa.int64()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, rows, sets in _shingle_sets(b.column(1), shingle):
                found = [index_entries(s, schemes.of(len(s))) if len(s) else s for s in sets]
                at = np.cumsum([0, *map(len, found)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, rows), lists], schema=schema)

    return run


def _lowest_of_entry(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (entry, rep) rows in that order: each rep with the lowest rep of its entry, where they differ."""
    entry, low = None, None
    for b in batches:
        if not b.num_rows:
            continue
        e, r = b.column(0).to_numpy(), b.column(1).to_numpy()
        new = np.concatenate(([entry is None or e[0] != entry], e[1:] != e[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(e)), -1))
        lows = np.where(at >= 0, r[np.maximum(at, 0)], low if low is not None else 0)
        entry, low = e[-1], lows[-1]
        differ = lows != r
        if differ.any():
            pairs = np.unique(np.stack([r[differ], lows[differ]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def shingles_of(text: str, shingle: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The shingles themselves, of the text with A-Z in lower case."""
    w = text.encode().lower().split()
    if len(w) < shingle:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(shingle))))


def links(texts: list[str], labels: list[int], sides: list[int], num: int, den: int, shingle: int = SHINGLE) -> list[tuple[int, int]]:
    """Positions of linked texts, enough of them to connect all that links connect.

    Texts of equal label are connected already; with more than one side, only texts of different sides are compared.
    """
    ids: dict[tuple[bytes, ...], int] = {}
    sets = [np.fromiter((ids.setdefault(s, len(ids)) for s in shingles_of(t, shingle)), dtype=np.int64) for t in texts]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
    begin = np.cumsum(size) - size
    root = list(range(len(texts)))

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    by_label: dict[int, int] = {}
    for i, x in enumerate(labels):
        root[find(i)] = find(by_label.setdefault(x, i))
    out = []
    mark = np.zeros(len(ids) + 1, dtype=np.int64)
    filled = np.flatnonzero(size)
    side = np.array(sides, dtype=np.int64)
    across = len(side) > 0 and bool((side != side[0]).any())
    for k, i in enumerate(filled.tolist()):
        others = filled[:k]
        # only sets of a size that allows a link, and not yet connected with this one
        others = others[(den * np.minimum(size[others], size[i]) >= num * np.maximum(size[others], size[i]))]
        if across:
            others = others[side[others] != side[i]]
        mine = find(i)
        others = np.array([j for j in others.tolist() if find(j) != mine], dtype=np.int64)
        if not len(others):
            continue
        mark[sets[i]] = 1
        if len(others) * 4 > k:
            common = np.add.reduceat(mark[flat], begin[filled])[np.searchsorted(filled, others)]
        else:
            common = np.array([mark[sets[j]].sum() for j in others.tolist()], dtype=np.int64)
        mark[sets[i]] = 0
        union = size[others] + size[i] - common
        for j in others[den * common >= num * union].tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _verify(num: int, den: int, shingle: int, n_keys: int):
    """Over rows (keys..., side, label, rep, text) in order of the keys: links within each group of equal keys."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, labels, reps, texts = None, [], [], [], []

        def finish() -> pa.RecordBatch | None:
            found = links(texts, labels, sides, num, den, shingle) if len(texts) > 1 else []
            if not found:
                return None
            return pa.RecordBatch.from_arrays([pa.array([reps[i] for i, _ in found], pa.int64()), pa.array([reps[j] for _, j in found], pa.int64())],
                                              names=["a", "b"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:n_keys] != key:
                    if key is not None and (got := finish()) is not None:
                        yield got
                    key, sides, labels, reps, texts = row[:n_keys], [], [], [], []
                for into, value in zip((sides, labels, reps, texts), row[n_keys:]):
                    into.append(value)
        if key is not None and (got := finish()) is not None:
            yield got

    return run


def similar_groups(docs: DataFrame, num: int = NUM, den: int = DEN, shingle: int = SHINGLE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set and the smallest id reachable by links."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = cut_lineage(texts.mapInArrow(_digests(shingle), "doc_id bigint, n bigint, d1 bigint, d2 bigint"), "sets")
    filled = sets.where("n > 0 and doc_id is not null")
    reps = cut_lineage(filled.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "reps")
    # texts are hashed again rather than all index entries stored: they would outweigh the texts
    entries = texts.where("doc_id is not null").mapInArrow(_entries(num, den, shingle), "rep bigint, entries array<bigint>").where("size(entries) > 0")
    entries = entries.join(reps.select("rep"), "rep", "left_semi").select(F.explode("entries").alias("entry"), "rep")
    entries = entries.repartition("entry").sortWithinPartitions("entry", "rep")
    candidates = cut_lineage(entries.mapInArrow(_lowest_of_entry, "a bigint, b bigint").distinct(), "candidates")
    clusters = cut_lineage(components(candidates), "clusters")
    edges, scratch = _verified(spark, texts, reps, clusters, num, den, shingle)
    comp = cut_lineage(components(_union(edges)), "components")
    remove(spark, candidates, clusters, *scratch, *edges)
    named = sets.select("doc_id", "n", "d1", "d2").join(reps, ["d1", "d2", "n"], "left").join(comp, F.col("rep") == F.col("node"), "left")
    known = F.coalesce(F.col("component"), F.col("rep"), F.col("doc_id"))
    # rows that share an id are one node: their smallest component holds for all of them
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), known).alias("component_id"))


def _verified(spark, texts: DataFrame, reps: DataFrame, clusters: DataFrame, num: int, den: int, shingle: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Edges that connect what links connect within the clusters, and other tables written on the way.

    A small cluster is one block. A large one is dealt by size band and hash, as sets link only within a band or with the next; in
    later rounds two neighbouring bands are dealt together.
    """
    lows = [int(x) for x in Schemes(num, den).lows]
    band = F.size(F.filter(F.lit(lows), lambda x: x <= F.col("n")))
    sized = clusters.join(reps, clusters["node"] == reps["rep"]).select("rep", "n", F.col("component").alias("cluster"))
    sized = sized.groupBy("rep").agg(F.min("cluster").alias("cluster"), F.max("n").alias("n")).withColumn("band", band)
    need = F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("int")
    whole = sized.groupBy("cluster").agg(need.alias("blocks"))
    parts = sized.groupBy("cluster", "band").agg(need.alias("in_band"))
    plan = sized.join(whole, "cluster").join(parts, ["cluster", "band"]).drop("n")
    members = texts.join(plan.withColumnRenamed("rep", "_rep"), texts["doc_id"] == F.col("_rep"))
    members = cut_lineage(members.select("cluster", "blocks", "band", "in_band", F.col("doc_id").alias("rep"), "text"), "members")

    def dealt(rows: DataFrame, turn: int) -> DataFrame:
        group = F.floor((F.col("band") + turn) / 2) if turn else F.col("band")
        block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("in_band"))).otherwise(0).cast("int")
        rows = rows.select("cluster", F.when(F.col("blocks") > 1, group).otherwise(0).cast("int").alias("group"), block.alias("block"),
                           F.lit(0).alias("side"), "label", "rep", "text")
        return rows.repartition("cluster", "group", "block").sortWithinPartitions("cluster", "group", "block", "rep")

    edges = cut_lineage(dealt(members.withColumn("label", F.col("rep")), 0).mapInArrow(_verify(num, den, shingle, 3), "a bigint, b bigint"), "links")
    large = members.where("blocks > 1")
    if not large.limit(1).count():
        return [edges], [members]
    found, scratch = [edges], [members]
    for turn in range(1, ROUNDS + 1):
        labelled, open_ones = _open(large, _union(found))
        scratch.append(labelled)
        if not open_ones.limit(1).count():
            return found, scratch
        more = cut_lineage(dealt(open_ones, turn).mapInArrow(_verify(num, den, shingle, 3), "a bigint, b bigint"), "links")
        found.append(more)
        if turn > 1 and not more.limit(1).count():
            break
    labelled, open_ones = _open(large, _union(found))
    open_ones = cut_lineage(open_ones.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(0)), F.col("in_band")).cast("int")), "open")
    scratch += [labelled, open_ones]
    # every block meets the later blocks of its band and all blocks of the next; and itself, for what it held apart
    blocks = open_ones.select("cluster", "band", "in_band").distinct()
    later = blocks.select("cluster", (F.col("band") - 1).alias("band"), F.col("in_band").alias("_next"))
    rows = open_ones.join(later, ["cluster", "band"], "left").withColumn("_next", F.coalesce("_next", F.lit(0)))
    own = F.transform(F.filter(F.sequence(F.lit(0), F.col("in_band") - 1), lambda k: k != F.col("block")), lambda k: F.struct(
        F.col("band").alias("g"), F.least(F.col("block"), k).alias("i"), F.lit(0).alias("up"), F.greatest(F.col("block"), k).alias("j"),
        (F.col("block") > k).cast("int").alias("side")))
    up = F.transform(F.filter(F.sequence(F.lit(0), F.col("_next")), lambda k: k < F.col("_next")), lambda k: F.struct(
        F.col("band").alias("g"), F.col("block").alias("i"), F.lit(1).alias("up"), k.alias("j"), F.lit(0).alias("side")))
    below = blocks.select("cluster", (F.col("band") + 1).alias("band"), F.col("in_band").alias("_below"))
    rows = rows.join(below, ["cluster", "band"], "left").withColumn("_below", F.coalesce("_below", F.lit(0)))
    down = F.transform(F.filter(F.sequence(F.lit(0), F.col("_below")), lambda k: k < F.col("_below")), lambda k: F.struct(
        (F.col("band") - 1).alias("g"), k.alias("i"), F.lit(1).alias("up"), F.col("block").alias("j"), F.lit(1).alias("side")))
    pairs = rows.withColumn("_p", F.explode(F.concat(own, up, down))).select(
        "cluster", "_p.g", "_p.i", "_p.up", "_p.j", "_p.side", "label", "rep", "text")
    keys = ["cluster", "g", "i", "up", "j"]
    pairs = pairs.repartition(*keys).sortWithinPartitions(*keys, "rep")
    found.append(cut_lineage(pairs.mapInArrow(_verify(num, den, shingle, 5), "a bigint, b bigint"), "links"))
    return found, scratch


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _open(members: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All members with their component as label, written; and those of clusters that links do not yet connect in full."""
    comp = components(edges)
    own = members.join(comp, members["rep"] == comp["node"], "left").withColumn("label", F.coalesce("component", "rep")).drop("node", "component")
    own = cut_lineage(own, "labelled")
    apart = own.groupBy("cluster").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l < _h").select("cluster")
    return own, own.join(apart, "cluster", "left_semi")


def keep_one(docs: DataFrame, num: int = NUM, den: int = DEN, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the document of the smallest id."""
    groups = similar_groups(docs, num, den, shingle, id_col, text_col)
    gone, = fresh(docs, "_gone")
    drop = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(drop, docs[id_col] == drop[gone], "left_anti")
