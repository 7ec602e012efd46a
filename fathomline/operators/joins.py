"""Joining a large fact table to a dimension with one row per key, safely under skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import all_of
from ..runtime import cut_lineage

#: rows of one key that a single task may join before the key is split
ROWS_PER_SPLIT = 5_000_000


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], small: bool,
                rows_per_split: int = ROWS_PER_SPLIT, stored: bool = False) -> DataFrame:
    """Left join that keeps every fact row exactly once; ``dim`` has unique keys.

    A dimension checked to be ``small`` is broadcast and the facts are not shuffled. Otherwise both sides are
    shuffled, and keys holding more than ``rows_per_split`` facts are spread over several tasks: the fact side by a hash
    of the whole row, the dimension side by repeating just those keys. The list of such keys has at most one entry per
    ``rows_per_split`` facts and is broadcast, so the facts are shuffled once. They are read twice, and written before unless they
    are ``stored``, that is cheaply read from a table.
    """
    keys = list(keys)
    if small:
        return facts.join(F.broadcast(dim), keys, "left")
    facts = facts if stored else cut_lineage(facts)  # read twice below
    splits = (
        facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .where((F.col("_rows") > rows_per_split) & all_of([F.col(k).isNotNull() for k in keys]))
        .withColumn("_splits", F.ceil(F.col("_rows") / rows_per_split))
        .drop("_rows")
    )
    spread = F.xxhash64(*[F.col(c) for c in facts.columns])
    # rows without a key match nothing; their own hash keeps them from meeting in one task
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    split = F.when(no_key, spread).otherwise(F.pmod(spread, F.coalesce("_splits", F.lit(1))))
    left = facts.join(F.broadcast(splits), keys, "left").withColumn("_split", split).drop("_splits")
    right = (
        dim.join(F.broadcast(splits), keys, "left")
        .withColumn("_split", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_splits", F.lit(1).cast("bigint")) - 1)))
        .drop("_splits")
    )
    return left.join(right, [*keys, "_split"], "left").drop("_split")
