"""Substring deduplication: seed and extend.

A repeat is a run of ``WINDOW`` words or more that also stands earlier (in a document of smaller id, or further up in the same
one). Seeds are runs of ``SEED`` words. Of the seeds inside each window of ``WINDOW`` words the one of smallest hash is the
window's anchor (winnowing), so equal windows have equal anchors at equal places, and consecutive windows mostly share
theirs: an anchor stands for a stretch of windows, about seven words long.

Occurrences of anchors are sorted by (anchor, hash and check sum of the whole stretch, document, position). Where stretches are equal, the match
extends over the whole stretch both ways, and every occurrence but the first is a repeat: one comparison with the row before.
Only where an anchor occurs in stretches that differ, which is at the ends of repeats, must the match be extended word by word:
one occurrence of each such stretch goes there. Its windows are compared by hash; a window is a repeat where an equal one
stands earlier. Stretches and windows that are repeats are joined to maximal spans per document.

The sort is by range over all these columns, so an anchor that a third of all documents hold spreads over as many partitions as it
fills. A task cannot see whether the first and last anchor of its range go on in its neighbours; it therefore sends their
stretches to the word-by-word step too, which decides exactly. First occurrences of windows come from partial minima; no
pairs of occurrences are ever made.

Stretches and windows are equal where 64 bits of hash and 62 of an independent check sum modulo primes are, so sequences that collide
in the hash are told apart. Defined cases: a null text has no words; a text of fewer than ``WINDOW`` words repeats nothing and is
repeated by nothing. Rows with a null id lose nothing and are no one's earlier copy. Rows that repeat id and text are one document, with
the same answer each; rows that repeat an id with another text are documents of their own, in the order of a hash of the text. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import arrow_schema, fresh, running_sum, ship
from .wordhash import check_prefixes, prefix_hashes, sequence_hashes, span_check, span_hash, text_chunks, word_hashes, word_spans

WINDOW, SEED = 20, 8


def stretches(h: np.ndarray, words: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts whose word hashes stand in a row: text, anchor hash, hash of the stretch, first window, windows, and
    the stretch's first and last word in the row.

    ``words`` are the positions at which texts begin, and the last ends. Windows count from their text's first word.
    """
    none = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(h) < window:
        return none
    grams = sequence_hashes(h, seed)
    span = window - seed + 1
    anchor = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(h) - window + 1)
    text = np.repeat(np.arange(len(words) - 1), np.diff(words))[: len(anchor)]
    inside = np.arange(len(anchor)) + window <= words[1:][text]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    a, t = anchor[at], text[at]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])))
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(at)])))
    w0, doc = at[first], t[first]
    sums = prefix_hashes(h)
    end = w0 + n - 1 + window
    return doc, grams[a[first]], span_hash(sums, w0, end), w0 - words[doc], n, w0, end


def _occurrences(window: int, seed: int):
    schema = arrow_schema(anchor=pa.int64(), stretch=pa.int64(), proof=pa.int64(), doc=pa.int64(), w0=pa.int32(), n=pa.int32())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, bounds in text_chunks(b.column(1)):
                starts, ends, words = word_spans(data, bounds)
                doc, key, ctx, w0, n, first, end = stretches(word_hashes(data, starts, ends), words, window, seed)
                proof = span_check(check_prefixes(data, starts, ends), first, end)
                ids = b.column(0).slice(i, len(bounds) - 1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)),
                                                  pa.array(proof.view(np.int64)), pa.array(ids[doc]), pa.array(w0, pa.int32()),
                                                  pa.array(n, pa.int32())], schema=schema)

    return run


def _sort_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From occurrences in order: those that repeat a whole stretch (kind 0), and those to be extended by words (kind 1)."""
    schema = arrow_schema(kind=pa.int32(), doc=pa.int64(), w0=pa.int32(), n=pa.int32())

    def rows(kind: int, doc, w0, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind), pa.int32()), pa.array(doc, pa.int64()),
                                           pa.array(w0, pa.int32()), pa.array(n, pa.int32())], schema=schema)

    last = None  # anchor, stretch and its check sum of the row before
    waiting = None  # the only stretch so far of the anchor at hand, if it has not been sent on
    sent = True  # the partition's first anchor is always sent on
    begun = False
    for b in batches:
        if not b.num_rows:
            continue
        key, ctx, proof, doc, w0, n = (c.to_numpy() for c in b.columns)
        new_key = np.concatenate(([last is None or key[0] != last[0]], key[1:] != key[:-1]))
        other = np.concatenate(([last is None or ctx[0] != last[1] or proof[0] != last[2]], (ctx[1:] != ctx[:-1]) | (proof[1:] != proof[:-1])))
        new = new_key | other
        yield rows(0, doc[~new], w0[~new], n[~new])
        group = np.cumsum(new_key)  # 0: the anchor of the batch before
        variants = np.bincount(group, weights=new, minlength=int(group[-1]) + 1).astype(np.int64)
        several = variants > 1
        if not new_key[0]:
            goes_on = variants[0] > 0
            if goes_on and waiting is not None:
                yield rows(1, *waiting)
                waiting, sent = None, True
            several[0] = sent or goes_on
        elif not begun:
            several[1] = True
        begun = True
        send = new & several[group]
        yield rows(1, doc[send], w0[send], n[send])
        if int(group[-1]) > 0:  # another anchor is at hand now
            waiting, sent = None, bool(several[-1])
            if not sent:
                k = int(np.flatnonzero(new_key)[-1])
                waiting = (doc[k: k + 1], w0[k: k + 1], n[k: k + 1])
        last = (key[-1], ctx[-1], proof[-1])
    if waiting is not None:  # the last anchor may go on in the next partition
        yield rows(1, *waiting)


def _windows(window: int):
    schema = arrow_schema(hash=pa.int64(), proof=pa.int64(), doc=pa.int64(), w=pa.int32(), again=pa.bool_())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            todo = b.column(2).to_pylist()
            for i, data, bounds in text_chunks(b.column(1)):
                starts, ends, words = word_spans(data, bounds)
                sums, checks = prefix_hashes(word_hashes(data, starts, ends)), check_prefixes(data, starts, ends)
                ids = b.column(0).slice(i, len(bounds) - 1).to_pylist()
                out = []
                for j, doc in enumerate(ids):
                    w = np.concatenate([np.arange(x["w0"], x["w0"] + x["n"]) for x in todo[i + j]])
                    w = np.unique(w)
                    at = w + int(words[j])
                    h = span_hash(sums, at, at + window).view(np.int64)
                    proof = span_check(checks, at, at + window).view(np.int64)
                    order = np.lexsort((w, proof, h))
                    again = np.zeros(len(h), bool)
                    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (proof[order[1:]] == proof[order[:-1]])
                    out.append((h, proof, np.full(len(h), doc), w, again))
                if out:
                    h, proof, d, w, again = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(proof), pa.array(d, pa.int64()), pa.array(w, pa.int32()),
                                                      pa.array(again)], schema=schema)

    return run


def _later(windows: DataFrame) -> DataFrame:
    """The windows that an equal one stands before."""
    first = windows.groupBy(F.col("hash").alias("_hash"), F.col("proof").alias("_proof")).agg(
        F.min("doc").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same = (F.col("hash") == F.col("_hash")) & (F.col("proof") == F.col("_proof"))
    return windows.join(first, same).where((F.col("doc") > F.col("_first")) | F.col("again"))


def _cut(window: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = arrow_schema(doc=pa.int64(), n_words=pa.int64(), n_removed=pa.int64(), spans=pa.list_(span), kept=pa.string())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                out = []
                for doc, text, ranges in zip(*(c.to_pylist() for c in part.columns)):
                    words = (text or "").encode().split()
                    if not ranges:
                        out.append((doc, len(words), 0, [], b" ".join(words).decode()))
                        continue
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(depth, [x["w0"] for x in ranges], 1)
                    np.add.at(depth, [x["w0"] + x["n"] - 1 + window for x in ranges], -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    keep = np.flatnonzero(~gone).tolist()
                    out.append((doc, len(words), int(gone.sum()), [{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)],
                                b" ".join([words[k] for k in keep]).decode()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """Documents whose ids repeat, numbered anew: (doc, id, text), ``doc`` in the order of id and hash of the text."""
    marked = rows.withColumn("mark", F.xxhash64("text"))
    keys = cut_lineage(marked.where("id is not null").select("id", "mark", F.lit(1).alias("one")).distinct(), "keys")
    order = running_sum(keys, ["id", "mark"], "one", "doc").select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "doc")
    both = marked.join(order, (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return both.select("doc", "id", "text")


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every row: its words, those that repeats cover, the maximal spans of them as
    word positions, and the words that are left, joined by spaces."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    twice = rows.where("id is not null").groupBy("id").count().where("count > 1").limit(1).count() > 0
    texts = cut_lineage(_numbered(rows), "numbered") if twice else rows.select(F.col("id").alias("doc"), "id", "text")
    one_each = texts.where("doc is not null").select("doc", "text")
    if twice:
        one_each = one_each.dropDuplicates(["doc"])

    found = one_each.mapInArrow(_occurrences(window, seed), "anchor bigint, stretch bigint, proof bigint, doc bigint, w0 int, n int")
    order = ["anchor", "stretch", "proof", "doc", "w0"]
    found = found.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_out = cut_lineage(found.mapInArrow(_sort_out, "kind int, doc bigint, w0 int, n int"), "stretches")

    open_ends = sorted_out.where("kind = 1").groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("w0", "n")).alias("todo"))
    windows = one_each.join(open_ends, F.col("doc") == F.col("_doc")).select("doc", "text", "todo")
    windows = cut_lineage(windows.mapInArrow(_windows(window), "hash bigint, proof bigint, doc bigint, w int, again boolean"), "windows")
    later = _later(windows)
    spans = sorted_out.where("kind = 0").select("doc", "w0", "n").unionByName(later.select("doc", F.col("w").alias("w0"), F.lit(1).alias("n")))
    spans = spans.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("w0", "n")).alias("ranges"))
    if not twice:  # the usual case: documents are their ids
        both = texts.join(spans, F.col("doc") == F.col("_doc"), "left").select("doc", "text", "ranges")
        return both.mapInArrow(_cut(window), _CUT).withColumnRenamed("doc", "doc_id")
    done = cut_lineage(one_each.join(spans, F.col("doc") == F.col("_doc"), "left").select("doc", "text", "ranges").mapInArrow(
        _cut(window), _CUT), "cut")
    no_id = texts.where("doc is null").select("doc", "text", F.lit(None).cast("array<struct<w0:int,n:int>>").alias("ranges"))
    lone = no_id.mapInArrow(_cut(window), _CUT).withColumnRenamed("doc", "doc_id")
    back = texts.where("doc is not null").select("doc", F.col("id").alias("doc_id")).join(done, "doc").drop("doc")
    return back.unionByName(lone)


_CUT = "doc bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept string"
