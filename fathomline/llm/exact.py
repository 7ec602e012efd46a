"""Exact deduplication of an incoming batch against immutable snapshots.

A snapshot is a set of documents that never changes. Its distinct text digests are dealt into buckets by hash, and each
bucket gets a static binary-fuse filter (8-bit fingerprints, three probes in consecutive segments). An incoming batch is
reduced to its distinct digests first; each is screened by its bucket's filter. Negatives are new for certain. Positives
join the snapshot's exact buckets on the whole digest, and their texts are compared byte by byte, so a false positive
costs work but never a document. Duplicates within the batch are grouped by digest separately, with partial counts before
the shuffle, so a text that a third of all rows share is one row per task.

Defined cases: a null text is empty, and all empty texts are equal. Rows that repeat both id and text are one document and
get the same answer. A null id ranks after every other id. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import SPACE, fresh, ship
from .wordhash import mix

#: distinct digests that one filter holds on average
KEYS_PER_FILTER = 50_000
U = np.uint64


def normalised(text: Column) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


# -------------------------------------------------------------------------------------------------- binary-fuse filters
def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of start segments for ``n`` keys."""
    length = 1 << int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    length = min(length, 1 << 18)
    size = int(round(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))))
    return length, max(1, -(-size // length) - 2)


def _positions(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys, seed)
    first = ((h >> U(32)) * U(segments)) >> U(32)
    m = U(length - 1)
    spots = np.stack([first * U(length) + (h & m), (first + U(1)) * U(length) + ((h >> U(18)) & m),
                      (first + U(2)) * U(length) + (mix(h, 5) & m)])
    return spots.astype(np.int64), (mix(h, 9) & U(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, number of start segments and fingerprints for distinct 64-bit keys."""
    keys = np.unique(keys)
    n = len(keys)
    length, segments = _layout(n)
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += max(1, segments // 4)  # an unlucky set gets more room
        spots, prints = _positions(keys, seed, length, segments)
        cells = (segments + 2) * length
        count = np.bincount(spots.ravel(), minlength=cells)
        xor = np.zeros(cells, dtype=np.int64)
        for row in spots:
            np.bitwise_xor.at(xor, row, np.arange(n))
        alive, order = np.ones(n, bool), []
        while True:  # peel all keys that are alone in some cell, layer by layer
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            found, at = np.unique(xor[single], return_index=True)
            order.append((found, single[at]))
            alive[found] = False
            for row in spots:
                np.subtract.at(count, row[found], 1)
                np.bitwise_xor.at(xor, row[found], found)
        if not alive.any():
            table = np.zeros(cells, dtype=np.uint8)
            for found, cell in reversed(order):
                others = np.zeros(len(found), dtype=np.uint8)
                for row in spots:
                    p = row[found]
                    others ^= np.where(p == cell, 0, table[p]).astype(np.uint8)
                table[cell] = prints[found] ^ others
            return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gives a filter for these keys")


def may_contain(keys: np.ndarray, built: tuple[int, int, int, bytes]) -> np.ndarray:
    seed, length, segments, data = built
    table = np.frombuffer(data, dtype=np.uint8)
    spots, prints = _positions(keys, seed, length, segments)
    return (table[spots[0]] ^ table[spots[1]] ^ table[spots[2]]) == prints


_FILTER = "bucket int, n bigint, seed int, length int, segments int, fingerprints binary"


def fuse_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the distinct digests (``key`` bigint, ``bucket`` int) of a snapshot."""
    ship(digests.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame([(int(rows["bucket"].iloc[0]), len(rows), *build_filter(keys))],
                            columns=["bucket", "n", "seed", "length", "segments", "fingerprints"])

    return digests.select("bucket", "key").groupBy("bucket").applyInPandas(build, _FILTER)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The digests of ``incoming`` (digest, key, bucket) that their bucket's filter may hold."""
    ship(incoming.sparkSession)

    def pick(rows: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(built):
            return rows.iloc[:0][["digest"]]
        f = built.iloc[0]
        hit = may_contain(rows["key"].to_numpy(np.int64).view(np.uint64),
                          (int(f["seed"]), int(f["length"]), int(f["segments"]), f["fingerprints"]))
        return rows.loc[hit, ["digest"]]

    return incoming.select("digest", "key", "bucket").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(
        pick, "digest string")


# ------------------------------------------------------------------------------------------------------ the deduplication
def _distinct(rows: DataFrame, buckets: int) -> DataFrame:
    """Distinct digests with their smallest id and number of rows, keyed for the filters."""
    low = rows.groupBy("digest").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    key = F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint")
    return low.withColumn("key", key).withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int"))


def deduplicate(batch: DataFrame, snapshot: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(side, id, digest, keep_id, group_size) of every row of the snapshot and of the batch.

    ``keep_id`` is the smallest id over both sides of the rows whose normalised text equals this row's. Give an empty
    ``snapshot`` for a first batch.
    """
    spark = batch.sparkSession

    def rows(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.lit(side).alias("side"), F.col(id_col).alias("id"), digest(normalised(F.col(text_col))).alias("digest"))

    # one pass over the texts; only ids and digests go on
    every = cut_lineage(rows(snapshot, "snapshot").unionByName(rows(batch, "batch")), "digests")
    known = every.where("side = 'snapshot'")
    n = {r["side"]: r["count"] for r in every.groupBy("side").count().collect()}
    n_known = n.get("snapshot", 0)
    # a task meets one bucket of both sides, so the larger one decides how many there are
    buckets = max(1, -(-max(n.values(), default=0) // KEYS_PER_FILTER))
    stored = cut_lineage(_distinct(known, buckets), "snapshot")
    fresh_ones = cut_lineage(_distinct(every.where("side = 'batch'"), buckets), "batch")
    filters = cut_lineage(fuse_filters(stored, buckets), "filters")
    positive = screen(fresh_ones, filters) if n_known else fresh_ones.where(F.lit(False)).select("digest")
    candidates = cut_lineage(stored.join(positive, "digest").select(
        "digest", F.col("low").alias("old_id"), F.col("n").alias("old_n")).join(
        fresh_ones.select("digest", F.col("low").alias("new_id"), F.col("n").alias("new_n")), "digest"), "candidates")
    same = candidates.join(_equal_bytes(candidates, snapshot, batch, id_col, text_col), "digest", "left_semi")

    # groups of either side alone, and of both where the bytes agree
    low = F.least("old_id", "new_id")  # skips null
    joined = same.select("digest", low.alias("keep_id"), (F.col("old_n") + F.col("new_n")).alias("group_size"))
    alone = stored.unionByName(fresh_ones).select("digest", F.col("low").alias("keep_id"), F.col("n").alias("group_size"))
    groups = alone.join(same.select("digest"), "digest", "left_anti").unionByName(joined)
    return every.join(groups, "digest").select("side", "id", "digest", "keep_id", "group_size")


def _equal_bytes(candidates: DataFrame, snapshot: DataFrame, batch: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digests whose representatives on both sides have the same bytes.

    One text per side and candidate digest is compared; two texts of one SHA-256 digest that differ would be an error of
    the digest, and are reported as such.
    """
    def texts(df: DataFrame, low: str, name: str) -> DataFrame:
        wanted = candidates.select("digest", F.col(low).alias("_id"))
        own = df.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias(name))
        both = own.join(wanted, own["_id"].eqNullSafe(wanted["_id"])).drop(wanted["_id"])
        # an id may repeat with other texts: only the text of this digest counts, once
        return both.where(digest(F.col(name)) == F.col("digest")).groupBy("digest").agg(F.min(name).alias(name), F.max(name).alias(f"{name}_max"))

    old, new = texts(snapshot, "old_id", "_old"), texts(batch, "new_id", "_new")
    pair = old.join(new, "digest")
    equal = (F.col("_old") == F.col("_new")) & (F.col("_old") == F.col("_old_max")) & (F.col("_new") == F.col("_new_max"))
    return pair.select("digest", F.assert_true(equal, F.lit("two texts share a SHA-256 digest")).alias("_ok")).where(
        "_ok is null").select("digest")


def split_snapshot(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """A table as one immutable snapshot and one incoming batch, by a hash of the id: half of the ids each."""
    half = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2))
    return docs.where(half == 1), docs.where(half == 0)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts one row of the smallest id."""
    batch, snapshot = split_snapshot(docs, id_col)
    found = deduplicate(batch, snapshot, id_col, text_col)
    keep = cut_lineage(found.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("id", "digest").agg(
        F.count(F.lit(1)).alias("times")), "keep")
    i, d, t, own = fresh(docs, "_id", "_digest", "_times", "_own")
    keep = keep.select(F.col("id").alias(i), F.col("digest").alias(d), F.col("times").alias(t))
    rows = docs.withColumn(own, digest(normalised(F.col(text_col))))
    kept = rows.join(keep, (rows[own] == keep[d]) & rows[id_col].eqNullSafe(keep[i]))
    # rows that repeat both id and text are rare: only those are reduced to one
    once = kept.where(F.col(t) == 1)
    again = kept.where(F.col(t) > 1).dropDuplicates([own, id_col])
    return once.unionByName(again).select(*docs.columns)
