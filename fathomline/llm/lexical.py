"""Ranked lexical search with bag deduplication.

Items ask for documents by terms. Only the items' vocabulary can score, so every document is cut down to its bag: the terms of
that vocabulary with their counts, plus the document's length class m, which is all a score depends on. Documents with the same
bag and m have the same score for every item: they are dealt by a hash of both, compared byte by byte, and scored once. Of a
class only its first ``k`` members by ascending id can ever be among the first ``k``, since equal scores rank by id; map tasks
send no more than those, so a class of any size is no burden.

Classes are scored in blocks: the counts of a class's terms are spread over the items that hold the term. A task keeps, per item,
the ``k`` best classes seen; a class outside them has ``k`` better documents before it. What tasks keep is expanded to members
and ranked once more per item.

Items are taken in blocks of about ``ITEMS`` items or ``TERMS`` different terms; a block's vocabulary and postings are what is
sent to tasks, so that is bounded however many items there are. More items mean more passes over the documents.

Defined cases: a null or empty text has no terms, and counts for nothing. Rows that repeat a document id are documents of their own;
a null id ranks behind all others of the same score. Rows that repeat an item id are one item with all their terms; a null
item id is an item. An item without terms, or whose terms no document holds, has no rows. No documents or no items give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window as W

from ..runtime import cut_lineage
from .common import ship

#: items and different terms of a block of items, about
ITEMS, TERMS = 1024, 200_000
#: documents ranked per item; percent of the length share in a score
K, LENGTH_SHARE = 10, 90
#: cells of a block of scores, and term counts spread over items at once
CELLS, SPREAD = 1 << 21, 1 << 21

# What terms consist of, as bytes of UTF-8: digits, letters, everything beyond ASCII. Only A-Z is lower-cased.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """A block of items: its vocabulary by number, and per term the numbers of the items that hold it."""
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    n_items: int

    @staticmethod
    def of(terms_by_item: list[set[bytes]]) -> Block:
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms_by_item)))}
        pairs = np.array([(vocabulary[t], i) for i, terms in enumerate(terms_by_item) for t in terms], dtype=np.int64).reshape(-1, 2)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        starts = np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1))
        return Block(vocabulary, starts, pairs[:, 1], len(terms_by_item))


def rank(documents: DataFrame, items: DataFrame, k: int = K, doc_col: str = "doc_id", item_col: str = "item_id",
         text_col: str = "text") -> DataFrame:
    """(item, rank, doc, score): per item the ``k`` best documents with a score above 0, best first."""
    spark = documents.sparkSession
    ship(spark)
    types = (items.schema[item_col].dataType, documents.schema[doc_col].dataType)
    out = StructType([StructField("item", types[0]), StructField("rank", IntegerType()), StructField("doc", types[1]),
                      StructField("score", LongType())])
    docs = documents.select(F.col(doc_col).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    # a term takes two bytes at least, with what parts it from the next
    n_blocks = max(1, math.ceil(size["n"] / ITEMS), math.ceil((size["bytes"] or 0) / (2 * TERMS)))
    found = None
    for b in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b).collect()  # one block of items
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r["item"], set()).update(terms_of(r["text"].encode()))
        names = [i for i, t in by_item.items() if t]
        if not names:
            continue
        ranked = _rank_block(docs, Block.of([by_item[i] for i in names]), k)
        numbered = spark.createDataFrame(list(enumerate(names)), StructType([StructField("no", IntegerType()), out["item"]]))
        ranked = ranked.join(F.broadcast(numbered), "no").select(*out.names)
        found = ranked if found is None else found.unionByName(ranked)
    return spark.createDataFrame([], out) if found is None else found


def _rank_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """(no, rank, doc, score) for the items of a block, by their numbers."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    doc_type = docs.schema["doc"].dataType.simpleString()
    bags = cut_lineage(docs.mapInArrow(_bags(shared), f"doc {doc_type}, n bigint, bag binary"), "bags")
    total = bags.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(total["n"]), max(int(total["l"]), 1)
    holding = np.zeros(len(block.vocabulary), dtype=np.int64)
    for r in bags.select("bag").mapInArrow(_holding(len(holding)), "term int, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        holding[r["term"]] = r["docs"]  # one row per term of the block
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding.tolist()], dtype=np.int64)
    weights = spark.sparkContext.broadcast(weight)

    # products beyond 64 bits are possible on the way, not in the result
    m = F.expr(f"{100 - LENGTH_SHARE} + ((cast(n as decimal(13,0)) * cast({LENGTH_SHARE * n_docs} as decimal(20,0))) div {n_terms})")
    rows = bags.where(F.octet_length("bag") > 0).select("doc", "bag", m.alias("m")).withColumn("h", F.xxhash64("bag", "m"))
    same = ["h", "m", "bag"]  # the hash deals the rows, the bag itself decides
    nth = F.row_number().over(W.partitionBy(*same).orderBy(F.col("doc").asc_nulls_last()))
    first = rows.withColumn("nth", nth).where(F.col("nth") <= k)
    classes = first.groupBy(*same).agg(F.array_sort(F.collect_list(F.struct(F.col("doc").isNull().alias("none"), "doc"))).alias("members"))
    classes = cut_lineage(classes.select("m", "bag", "members"), "classes")
    kept = classes.mapInArrow(_best(shared, weights, k), f"no int, score bigint, members {classes.schema['members'].dataType.simpleString()}")
    docs_of = kept.select("no", "score", F.explode("members").alias("member")).select("no", "score", "member.doc")
    place = F.row_number().over(W.partitionBy("no").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
    return docs_of.withColumn("rank", place).where(F.col("rank") <= k)


def _bags(shared):
    """Cut documents down to bags: pairs of (term number, count) as 32-bit integers, by term number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.vocabulary.get
        for b in batches:
            lengths, bags = [], []
            for text in b.column(1):
                terms = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                counts = Counter(map(number, terms))
                counts.pop(None, None)
                lengths.append(len(terms))
                bags.append(np.array(sorted(counts.items()), dtype="<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths, pa.int64()), pa.array(bags, pa.binary())], ["doc", "n", "bag"])

    return run


def _pairs(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of several bags, and for each bag where its pairs start (one more at the end)."""
    starts = np.cumsum([0, *(len(x) // 8 for x in bags)])
    return np.frombuffer(b"".join(bags), dtype="<i4").reshape(-1, 2).astype(np.int64), starts


def _holding(n_terms: int):
    """Documents that hold each term, counted per task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            n += np.bincount(_pairs(b.column(0).to_pylist())[0][:, 0], minlength=n_terms)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(n[hit])], ["term", "docs"])

    return run


def class_scores(pairs: np.ndarray, starts: np.ndarray, m: np.ndarray, weight: np.ndarray, block: Block) -> np.ndarray:
    """Scores of some classes (rows) for the items of a block (columns)."""
    n, term, tf = len(m), pairs[:, 0], pairs[:, 1]
    row = np.repeat(np.arange(n), np.diff(starts))
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    scores = np.zeros(n * block.n_items, dtype=np.int64)
    held = np.diff(block.starts)[term]
    ends = np.cumsum(held)
    low = 0
    while low < len(pairs):  # so many at once as spread over a bounded number of cells
        high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SPREAD, side="right")), low + 1)
        some = held[low:high]
        entry = np.repeat(np.arange(low, high), some)
        within = np.arange(len(entry)) - np.repeat(np.cumsum(some) - some, some)
        cell = row[entry] * block.n_items + block.items[block.starts[term[entry]] + within]
        if len(entry) and int(part[low:high].max()) * (high - low) < 1 << 53:  # whole numbers that doubles add exactly
            scores += np.bincount(cell, weights=part[entry], minlength=len(scores)).astype(np.int64)
        else:
            np.add.at(scores, cell, part[entry])
        low = high
    return scores.reshape(n, block.n_items)


def _best(shared, weights, k: int):
    """The classes that are among the ``k`` best of an item within this task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value, weights.value
        per_block = max(1, CELLS // block.n_items)
        least = np.ones(block.n_items, dtype=np.int64)  # a score below cannot enter any more
        no = score = lead = np.zeros(0, dtype=np.int64)
        kept: pa.Array | None = None
        for b in batches:
            for at in range(0, len(b), per_block):
                some = b.slice(at, per_block)
                pairs, starts = _pairs(some.column(1).to_pylist())
                s = class_scores(pairs, starts, some.column(0).to_numpy(), weight, block)
                if len(s) >= k:
                    least = np.maximum(least, np.partition(s, len(s) - k, axis=0)[len(s) - k])
                rows, cols = np.nonzero(s >= least)
                if not len(rows):
                    continue
                members = some.column(2).take(pa.array(rows))
                # a class leads by its first member; null ids come last
                leads = members.flatten().take(pa.array(members.offsets.to_numpy()[:-1] - members.offsets[0].as_py())).field(1)
                no, score = np.concatenate((no, cols)), np.concatenate((score, s[rows, cols]))
                lead = np.concatenate((lead, _order(leads)))
                kept = members if kept is None else pa.concat_arrays([kept, members])
                order = np.lexsort((lead, -score, no))
                same = np.searchsorted(no[order], np.arange(block.n_items))
                order = order[np.arange(len(order)) - same[no[order]] < k]
                no, score, lead, kept = no[order], score[order], lead[order], kept.take(pa.array(order))
                full = np.bincount(no, minlength=block.n_items) >= k
                last = np.searchsorted(no, np.arange(block.n_items), side="right") - 1
                least[full] = np.maximum(least[full], score[last[full]])
        if kept is not None:
            yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(score), kept], ["no", "score", "members"])

    return run


def _order(ids: pa.Array) -> np.ndarray:
    """Numbers in the order of integer ids, nulls behind them."""
    return ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
