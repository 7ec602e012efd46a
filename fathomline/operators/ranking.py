"""Ordering: top cells, dense positions, quantile classes. No operator sorts a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .pressure import month_array


def hotspots(hexes: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` cells with most detections; ties by density (none last), then cell."""
    order = [F.desc("on_meadow"), F.desc(F.coalesce("density", F.lit(-1.0))), F.asc("cell")]
    return hexes.where("on_meadow > 0").orderBy(*order).limit(n)


def rank_in_country(hot: DataFrame) -> DataFrame:
    """Running number of each hotspot within its country, in hotspot order."""
    order = [F.desc("on_meadow"), F.desc(F.coalesce("density", F.lit(-1.0))), F.asc("cell")]
    return hot.withColumn("nth", F.row_number().over(W.partitionBy("country").orderBy(*order)))


def points_most_recent(fact: DataFrame, calendar: DataFrame, cap: int | None) -> DataFrame:
    """On-meadow rows of the calendar, the newest ``cap`` of them, or all.

    Where the cap falls is found from counts, per month and then per day of the deciding month; only rows from that day
    on are ranked, so no task sees more than the cap and one day. Rows come in no particular order.
    """
    rows = fact.where("on_meadow").join(calendar.select("month"), "month", "left_semi")
    if cap is None:
        return rows
    day = F.substring("detect_timestamp", 1, 10)
    per_month = rows.groupBy("month").count().orderBy(F.desc("month")).collect()  # twelve rows a year
    total, deciding = 0, None
    for r in per_month:
        if total + r["count"] > cap:
            deciding = r["month"]
            break
        total += r["count"]
    if deciding is None:
        return rows
    for r in rows.where(F.col("month") == deciding).groupBy(day.alias("day")).count().orderBy(F.desc("day")).collect():
        first_day = r["day"]
        if total + r["count"] > cap:
            break
        total += r["count"]
    # months are those of the timestamps, so later months lie after the deciding day
    later = rows.where((F.col("month") > deciding) | ((F.col("month") == deciding) & (day > first_day)))
    edge = rows.where((F.col("month") == deciding) & (day == first_day))
    last = edge.orderBy(F.desc("detect_timestamp"), *[F.asc(c) for c in ("lon", "lat", "scene_id")]).limit(cap - total)
    return later.unionByName(last)


def country_order(series: DataFrame) -> DataFrame:
    return series.groupBy("country").agg(F.sum("anchored_on_meadow").alias("total")).orderBy(F.desc("total"), "country")


def with_offsets(df: DataFrame, bucket: Column, weight: Column) -> DataFrame:
    """Rows with the weight of all lower buckets (``_before``) and of the whole table (``_all``).

    The running sum is taken over one row per bucket; callers use bucketings with a fixed number of buckets.
    """
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy("_bucket").agg(F.sum(weight).alias("_size"))
    below = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_before"),
        F.sum("_size").over(W.partitionBy()).alias("_all"))
    return rows.join(offsets, "_bucket")


def cell_index(cells: DataFrame, prefix: int = 3) -> DataFrame:
    """0-based position ``i`` of each cell in id order.

    Ids are numbered within their prefix and shifted by the sizes of lower prefixes. Three characters of an id are
    digits, a sign or the separator: at most 12^3 prefixes.
    """
    rows = with_offsets(cells, F.substring("cell", 1, prefix), F.lit(1))
    within = F.row_number().over(W.partitionBy("_bucket").orderBy("cell"))
    return rows.withColumn("i", F.col("_before") + within - 1).drop("_bucket", "_before", "_all")


def with_month_index(df: DataFrame, calendar: DataFrame, name: str = "m") -> DataFrame:
    """0-based position of the row's month in the calendar, NULL for other months."""
    at = F.array_position("_months", F.col("month"))
    return df.withColumn("_months", month_array(calendar)).withColumn(name, F.when(at > 0, at - 1)).drop("_months")


def index_lookup(rows: DataFrame, cells: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of (cell, month) coded as positions (i, m)."""
    coded = with_month_index(rows.join(cell_index(cells.select("cell")), "cell"), calendar)
    return coded.select("i", "m", *[c for c in rows.columns if c not in ("cell", "month")])


# The quantiles that separate the five map classes.
QUANTILES = (0.2, 0.4, 0.6, 0.8)
#: histogram buckets per doubling of the value
BUCKETS_PER_DOUBLING = 32


def quantile_breaks(df: DataFrame, column: str, is_count: bool) -> DataFrame:
    """One row with the ascending class breaks of the positive values, as an array of at most four.

    A break is the value at zero-based position floor(q * n). Values are first reduced to distinct values with counts,
    then to logarithmic buckets (a double has some 67,000 of them), so only one bucket at a time is sorted.
    """
    v = F.col("v")
    hist = df.select(F.col(column).cast("double").alias("v")).where((v > 0) & (v < float("inf"))).groupBy("v").agg(
        F.count(F.lit(1)).alias("n"))
    rows = with_offsets(hist, F.floor(F.log2(v) * BUCKETS_PER_DOUBLING), F.col("n"))
    upto = W.partitionBy("_bucket").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.col("_before") + F.sum("n").over(upto))
    at = [F.least(F.col("_all") - 1, F.floor(F.lit(q) * F.col("_all"))) for q in QUANTILES]
    picks = rows.agg(*[F.min(F.when(F.col("_upto") > a, v)).alias(f"q{k}") for k, a in enumerate(at)],
                     F.min("v").alias("low"), F.max("v").alias("high"))

    def tidy(b: Column) -> Column:
        if is_count:
            return F.greatest(F.lit(1.0), F.ceil(b).cast("double"))
        scale = F.pow(F.lit(10.0), 1 - F.floor(F.log10(b)))  # two significant digits
        return F.round(b * scale) / scale

    candidates = F.array(*[tidy(F.col(f"q{k}")) for k in range(len(QUANTILES))])
    kept = F.filter(candidates, lambda b: (b > F.col("low")) & (b <= F.col("high")))
    return picks.select(F.array_sort(F.array_distinct(kept)).alias("breaks"))


def class_of(df: DataFrame, column: str, breaks: DataFrame, name: str = "class") -> DataFrame:
    """Number of breaks not above the value; -1, the zero class, for missing and non-positive values."""
    v = F.col(column)
    rows = df.withColumn("_breaks", breaks.select("breaks").scalar())
    cls = F.when(v > 0, F.size(F.filter("_breaks", lambda b: b <= v))).otherwise(F.lit(-1))
    return rows.withColumn(name, cls).drop("_breaks")
