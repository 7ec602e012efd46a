"""Mixing sources to target weights: how many words of each document a training mix takes.

The mix is as large as all sources together. Targets share it by weight; no source is asked for more than ``max_epochs``
times its size, and what that leaves over is shared again by weight among the others. Each source is then taken in complete
epochs first; the rest of its target is a weighted sample without replacement by the method of Efraimidis and Spirakis: every
document draws an exponential key with its quality weight as rate, the documents stand in the order of their keys, and are
taken until a running sum of their sizes reaches the budget. The document at the border is cut at the budget, so a source's
total differs from its target by rounding only.

Defined cases: a null text has size 0; documents of size 0 are never taken. A null source is the last. A null, non-positive or
non-finite quality weight counts as 1. Keys come from a hash of id, text and seed, so reruns agree; rows that repeat both are
told apart by nothing and may swap places, which leaves all counts the same. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import SPACE, fresh, running_sum, words_in

# Weights that sources get in turn, and the most often a source may repeat.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> dict[str | None, float]:
    """Words asked of each source. Sources stand by code point, null last, and weigh ``weights`` in turn."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    out: dict[str | None, float] = {}
    open_ones, left = list(order), total
    while open_ones:
        per = left / sum(weight[s] for s in open_ones)
        full = [s for s in open_ones if weight[s] * per >= max_epochs * sizes[s]]
        if not full:
            out.update({s: weight[s] * per for s in open_ones})
            break
        for s in full:
            out[s] = float(max_epochs * sizes[s])
            left -= out[s]
        open_ones = [s for s in open_ones if s not in full]
    return out


def exponential_key(seed: int, weight: Column, *identity: Column) -> Column:
    """A standard exponential variate over the weight; the smallest keys are drawn first."""
    u = (F.shiftrightunsigned(F.xxhash64(*identity, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    good = (weight > 0) & (weight < float("inf"))
    return -F.log(u) / F.when(good, weight).otherwise(F.lit(1.0))


def take(docs: DataFrame, quality: DataFrame | None = None, seed: int = 17, weights: Sequence[float] = WEIGHTS,
         max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, mark, size, source, source_size, target, taken) of every document. ``mark`` is a hash of the text.

    ``quality`` has the weight of documents, (id, weight); of several rows of an id the largest weight counts. It joins the
    documents' sizes, so texts are read once and never moved.
    """
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), mark.alias("mark"),
                        words_in(F.col(text_col)).alias("size"))
    weight = F.lit(1.0)
    if quality is not None:
        rated = quality.groupBy(F.col("id").alias("_id")).agg(F.max("weight").cast("double").alias("_weight"))
        plain = cut_lineage(plain, "plain").join(rated, F.col("doc_id") == F.col("_id"), "left")
        weight = F.col("_weight")
    sized = cut_lineage(plain.select("doc_id", "source", "mark", "size", exponential_key(seed, weight, F.col("doc_id"), F.col("mark")).alias("key")), "sizes")
    sizes = {r[0]: int(r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()}  # one row per source
    asked = targets(sizes, weights, max_epochs)
    spark = docs.sparkSession
    rows = [(s, sizes[s], asked[s], *divmod(round(asked[s]), sizes[s] or 1)) for s in sizes]
    plan = spark.createDataFrame(rows, "source string, source_size bigint, target double, epochs bigint, rest bigint")
    order = running_sum(sized, ["source", "key", "doc_id", "mark"], "size", "before")
    # running sums go over all sources in order: each source starts where those before it end
    start, at = [], 0
    for s in sorted(sizes, key=lambda s: (s is not None, (s or "").encode("utf-8"))):
        start.append((s, at))
        at += sizes[s]
    starts = spark.createDataFrame(start, "source string, _start bigint")
    plan = plan.join(starts, plan["source"].eqNullSafe(starts["source"])).drop(starts["source"]).withColumnRenamed("source", "_source")
    both = order.join(F.broadcast(plan), order["source"].eqNullSafe(plan["_source"]))
    part = F.least(F.greatest(F.col("rest") - (F.col("before") - F.col("_start")), F.lit(0)), F.col("size"))
    return both.select("doc_id", "mark", "size", "source", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))


def mix(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The mixed table itself, with the columns of ``docs``: a document stands as often as it is taken, cut where it is cut."""
    t = take(docs, quality, **options)
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    t = t.where("taken > 0").groupBy("doc_id", "mark").agg(F.max("taken").alias("taken"), F.max("size").alias("size"),
                                                            F.sum("taken").alias("all"), F.count(F.lit(1)).alias("n"))
    m, i, k, taken, size, copy = fresh(docs, "_mark", "_id", "_mark_of", "_taken", "_size", "_copy")
    t = t.select(F.col("doc_id").alias(i), F.col("mark").alias(k),
                 # rows that repeat id and text share what they take together
                 F.ceil(F.col("all") / F.col("n")).cast("bigint").alias(taken), F.col("size").alias(size))
    rows = docs.withColumn(m, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    both = rows.join(t, rows[id_col].eqNullSafe(t[i]) & (rows[m] == t[k]))
    copies = F.ceil(F.col(taken) / F.col(size)).cast("int")
    both = both.withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    rest = F.col(taken) - (F.col(copy) - 1) * F.col(size)
    first = F.slice(F.filter(F.split(F.col(text_col), f"{SPACE}+"), lambda w: w != ""), F.lit(1), rest.cast("int"))
    cut = F.when(rest >= F.col(size), F.col(text_col)).otherwise(F.array_join(first, " "))
    return both.withColumn(text_col, cut).select(*docs.columns)
