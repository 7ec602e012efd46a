"""The features of GeoJSON collections, however large one document is: read by many tasks, never by one.

The text reader deals a file out in splits and cuts it behind every closing brace. What such a piece does to the nesting depends
only on whether it begins inside a string, so it is counted for both cases. Running sums, within the splits and then over the
splits' totals, tell which case holds and how deep each piece lies; the pieces between two ends of objects of the outermost level
are one object, also where it spans several splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..runtime import cut_lineage

_SPLIT = ["file", "block"]
#: text up to the next opening brace that is not inside a string
_HEAD = r'(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'


class NotJson(ValueError):
    """A file whose braces, brackets or quotes do not match."""


def _before(c: Column, within: list[str], order: str) -> Column:
    """The sum of ``c`` over the earlier rows."""
    return F.coalesce(F.sum(c).over(W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _earlier_pieces(name: str) -> Column:
    return _before(F.col(name), _SPLIT, "seq")


def _earlier_splits(name: str) -> Column:
    return _before(F.col(name), ["file"], "block")


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pieces of the files in order (file, block, seq), with their effect on braces (b0, b1) and brackets (k0, k1) when they begin
    outside and inside a string, and whether they change between the two (flip)."""
    rows = spark.read.option("lineSep", "}").text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text"))
    bare = F.regexp_replace("text", r"\\.", "")

    def count(text: Column, sign: str) -> Column:
        return F.length(text) - F.length(F.translate(text, sign, ""))

    flip = count(bare, '"') % 2
    effects = {"flip": flip}
    for inside in (0, 1):
        # strings are taken out; a piece that begins inside one gets the quote that its first string lacks
        plain = F.regexp_replace(F.concat(F.lit('"' * inside), bare), r'"[^"]*(?:"|\z)', "")
        closes = F.when((flip + inside) % 2 == 0, 1).otherwise(0)
        effects[f"b{inside}"] = count(plain, "{") - closes
        effects[f"k{inside}"] = count(plain, "[") - count(plain, "]")
    return rows.withColumns(effects)


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with the depth in braces and brackets before and after them, and whether they end inside a string."""
    rows = pieces.withColumn("flips", _earlier_pieces("flip"))
    cases = {f"{n}{h}_own": F.when((F.col("flips") + h) % 2 == 1, F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for h in (0, 1) for n in "bk"}
    rows = rows.withColumns(cases)
    rows = cut_lineage(rows.withColumns({c.replace("_own", "_in"): _earlier_pieces(c) for c in cases}), "pieces")
    totals = rows.groupBy(*_SPLIT).agg(F.sum("flip").alias("flip"), *[F.sum(c).alias(c) for c in cases])
    totals = totals.withColumn("case", _earlier_splits("flip") % 2)

    def chosen(name: str) -> Column:
        return F.when(F.col("case") == 1, F.col(name.replace("?", "1"))).otherwise(F.col(name.replace("?", "0")))

    totals = totals.withColumns({"b": chosen("b?_own"), "k": chosen("k?_own")})
    starts = cut_lineage(totals.select(*_SPLIT, "case", "flip", "b", "k", _earlier_splits("b").alias("b_at"), _earlier_splits("k").alias("k_at")), "splits")
    ends = starts.groupBy("file").agg(F.sum("b").alias("b"), F.sum("k").alias("k"), (F.sum("flip") % 2).alias("open"))
    # what follows the last brace of a file is counted as if one more closed behind it
    bad = [r["file"] for r in ends.where("open = 1 OR k <> 0 OR b NOT IN (0, -1)").select("file").limit(5).collect()]
    if bad:
        raise NotJson(f"braces, brackets or quotes do not match in {', '.join(bad)}")
    out = rows.join(starts.select(*_SPLIT, "case", "b_at", "k_at"), _SPLIT)
    depth, bracket = F.col("b_at") + chosen("b?_in"), F.col("k_at") + chosen("k?_in")
    return out.select("file", "block", "seq", "text", depth.alias("depth"), (depth + chosen("b?_own")).alias("after"),
                      (bracket + chosen("k?_own")).alias("bracket"), ((F.col("case") + F.col("flips") + F.col("flip")) % 2 == 1).alias("inside"))


def collection_features(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(text): every object that stands in an array directly below the document, as its own JSON text.

    A file holds one collection or several, one after the other. Objects of other arrays than ``features`` are among them, and
    told by their type. Empty files and collections have none; a file that is cut off in its features is an error.
    """
    rows = _placed(_pieces(spark, paths))
    rows = rows.withColumn("ends", (~F.col("inside") & (F.col("after") <= 1)).cast("int"))
    rows = cut_lineage(rows.withColumn("ended", _earlier_pieces("ends")), "objects")
    earlier = rows.groupBy(*_SPLIT).agg(F.sum("ends").alias("n")).select(*_SPLIT, _earlier_splits("n").alias("earlier"))
    rows = rows.join(earlier, _SPLIT).withColumn("object", F.col("earlier") + F.col("ended"))
    place = F.struct("block", "seq")
    objects = rows.groupBy("file", "object").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("pieces"), F.min_by("depth", place).alias("depth"),
        F.max((F.col("ends") == 1) & (F.col("after") == 1) & (F.col("bracket") == 1)).alias("listed"))
    whole = F.concat(F.array_join(F.transform("pieces", lambda r: r.text), "}"), F.lit("}"))
    below = F.regexp_replace(whole, "^" + _HEAD, "")
    text = F.when(F.col("depth") == 0, F.regexp_replace(whole, "^" + _HEAD + r"\{" + _HEAD, "")).otherwise(below)
    return objects.where("listed").select(text.alias("text"))
