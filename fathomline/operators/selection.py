"""Interactive questions: a month range, a season and a class of boats, answered from the monthly cell tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.scalars import season_of
from ..schema import SEASONS
from .pressure import density, month_array, zeros

# Boat classes and the counters they read, of all boats and of large ones.
BOAT_COUNTERS = {"all": ("n", "large"), "ais": ("ais", "ais_large"), "ais_st": ("ais_st", "ais_st_large")}
BOAT_TOTALS = {
    "all": ("anchored_on_meadow", "large_on_meadow"),
    "ais": ("ais_matched_on_meadow", "ais_matched_large_on_meadow"),
    "ais_st": ("ais_stationary_on_meadow", "ais_stationary_large_on_meadow"),
}


def month_calendar(months: DataFrame) -> DataFrame:
    """Every month from the first to the last: c (position), month, idx (position among the months with data, else -1)."""
    known = months.agg(F.array_sort(F.collect_set("month")).alias("known"))
    day = lambda m: F.to_date(m, "yyyy-MM")
    steps = F.expr("interval 1 month")
    days = F.sequence(day(F.col("known")[0]), day(F.element_at("known", -1)), steps)
    rows = known.where(F.size("known") > 0).select("known", F.posexplode(days).alias("c", "_d"))
    month = F.date_format("_d", "yyyy-MM")
    return rows.select("c", month.alias("month"), (F.array_position("known", month) - 1).alias("idx"))


def select_months(calendar: DataFrame, first: str | None = None, last: str | None = None, season: str | None = None) -> DataFrame:
    """Months with data in the range and season; without either, all of them."""
    out = calendar.where("idx >= 0")
    if first is not None:
        out = out.where(F.col("month") >= first)
    if last is not None:
        out = out.where(F.col("month") <= last)
    if season is not None:
        out = out.where(season_of(F.col("month")) == season)
    return out


def year_ranges(calendar: DataFrame) -> DataFrame:
    """First and last calendar position of every year."""
    return calendar.groupBy(F.substring("month", 1, 4).alias("year")).agg(F.min("c").alias("first"), F.max("c").alias("last"))


def available_seasons(calendar: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    return select_months(calendar, first, last).select(season_of(F.col("month")).alias("season")).distinct()


def selection_aggregate(rows: DataFrame, passes: DataFrame, cells: DataFrame, selected: DataFrame, boats: str = "all") -> DataFrame:
    """Counts and density of every cell for the selected months and class of boats.

    ``rows`` is the sparse monthly cell table, ``passes`` the sparse clear overpasses (cell, month, clear). Months are selected
    before anything is summed. Data from before boats were told apart has no counters for them: all boats count.
    """
    every, large = BOAT_COUNTERS[boats] if set(BOAT_COUNTERS[boats]) <= set(rows.columns) else BOAT_COUNTERS["all"]
    months = selected.select("month")
    counts = rows.join(months, "month", "left_semi").groupBy("cell").agg(
        F.sum(every).alias("on_meadow"), F.sum(large).alias("large_on_meadow"))
    clear = passes.join(months, "month", "left_semi").groupBy("cell").agg(F.sum("clear").alias("clear"))
    out = cells.select("cell").join(counts, "cell", "left").join(clear, "cell", "left")
    out = zeros(out, "on_meadow", "large_on_meadow", "clear")
    return out.select("cell", "on_meadow", "large_on_meadow", density(F.col("on_meadow"), F.col("clear")).alias("density"))


#: what running sums are kept of
SUMMED = (*dict.fromkeys(c for pair in BOAT_COUNTERS.values() for c in pair), "clear")
RUNNING = [f"{c}_{s}" for c in SUMMED for s in SEASONS]


def _summed(rows: DataFrame, passes: DataFrame) -> DataFrame:
    """(cell, month) with all counters and passes."""
    both = rows.unionByName(passes, allowMissingColumns=True)
    return both.groupBy("cell", "month").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in SUMMED])


def _seasonal() -> dict[str, Column]:
    """Every counter in the column of the month's season and 0 in the others."""
    return {f"{c}_{s}": F.when(season_of(F.col("month")) == s, F.col(c)).otherwise(F.lit(0)) for c in SUMMED for s in SEASONS}


def running_sums(rows: DataFrame, passes: DataFrame, months: DataFrame) -> DataFrame:
    """Per month and cell what every counter has come to by the end of that month, season by season.

    ``months`` are those with data; rows of others do not count. To be stored by month: any range is then the difference of two of
    its partitions, and a new month one more partition (``next_sums``). A cell has rows from its first count on.
    """
    own = _summed(rows, passes).join(months.select("month"), "month", "left_semi")
    upto = W.partitionBy("cell").orderBy("month")
    # rows without a cell count nowhere
    sums = {n: F.when(F.col("cell").isNotNull(), F.sum(c).over(upto)).otherwise(F.lit(0)).alias(n) for n, c in _seasonal().items()}
    steps = own.select("cell", "month", *sums.values(), F.lead("month").over(upto).alias("_next"))
    # sums stand until the cell's next month with counts: months are added after the sums, without moving the table of all months
    stand = F.filter("_months", lambda m: (m >= F.col("_from")) & (F.col("_next").isNull() | (m < F.col("_next"))))
    dense = steps.withColumnRenamed("month", "_from").withColumn("_months", month_array(months))
    return dense.select("cell", F.explode(stand).alias("month"), *RUNNING)


def next_sums(previous: DataFrame, rows: DataFrame, passes: DataFrame, month: str) -> DataFrame:
    """The running sums of ``month`` from those of the month with data before it, and the rows of that month alone."""
    own = _summed(*(t.where(F.col("month") == month) for t in (rows, passes)))
    both = previous.select("cell", *RUNNING).unionByName(own.select("cell", *[c.alias(n) for n, c in _seasonal().items()]))
    return both.groupBy("cell").agg(*[F.sum(c).alias(c) for c in RUNNING]).select("cell", F.lit(month).alias("month"), *RUNNING)


def selection_between(sums: DataFrame, cells: DataFrame, months: DataFrame, first: str | None = None, last: str | None = None,
                      season: str | None = None, boats: str = "all") -> DataFrame:
    """``selection_aggregate`` for a range of months and a season, from stored running sums: two months of them are read, however
    long the range is, and of these the columns of the season and the class."""
    known = months.select("month")
    ends = known.agg(F.max(F.when(F.col("month") <= last, F.col("month")) if last else F.col("month")).alias("upto"),
                     (F.max(F.when(F.col("month") < first, F.col("month"))) if first else F.lit(None).cast("string")).alias("before")).first()
    upto, before = ends["upto"], ends["before"]
    if last is not None and first is not None and last < first:
        upto = before
    sign = F.when(F.col("month") == upto, 1).otherwise(0) - F.when(F.col("month") == before, 1).otherwise(0) if before else F.lit(1)
    read = sums.where(F.col("month").isin([m for m in (upto, before) if m]))
    names = dict(zip(("on_meadow", "large_on_meadow", "clear"), (*BOAT_COUNTERS[boats], "clear")))

    def total(counter: str) -> Column:
        of = [F.col(f"{counter}_{s}") for s in (SEASONS if season is None else (season,))]
        return F.sum(sign * reduce(Column.__add__, of)).cast("bigint")

    out = cells.select("cell").join(read.groupBy("cell").agg(*[total(c).alias(n) for n, c in names.items()]), "cell", "left")
    out = zeros(out, *names)
    return out.select("cell", "on_meadow", "large_on_meadow", density(F.col("on_meadow"), F.col("clear")).alias("density"))


def season_fallback(hexes: DataFrame, season: str) -> DataFrame:
    """The same answer for one season from the all-months table, when no monthly cell table exists."""
    if season not in SEASONS:
        raise ValueError(f"unknown season {season}")
    on, large, clear = F.col(season), F.col(f"large_{season}"), F.col(f"clear_{season}")
    return hexes.select("cell", on.alias("on_meadow"), large.alias("large_on_meadow"), density(on, clear).alias("density"))


def point_filter(points: DataFrame, selected: DataFrame | None, large_length_m: float, small: bool = True, large: bool = True,
                 boats: str = "all") -> DataFrame:
    """Published points of the selected months (``m`` holds the index), sizes and class of boats.

    Points published without a class belong to any.
    """
    out = points
    if selected is not None:
        out = out.join(selected.select(F.col("idx").alias("m")), "m", "left_semi")
    if not small:
        out = out.where(F.col("length_m") >= large_length_m)
    if not large:
        out = out.where(F.col("length_m") < large_length_m)
    if "ais_class" not in points.columns:
        return out
    if boats == "ais":
        out = out.where(F.col("ais_class") >= 2)
    elif boats == "ais_st":
        out = out.where(F.col("ais_class") == 3)
    return out


def timeline_series(calendar: DataFrame, totals: DataFrame, boats: str = "all", large: bool = False) -> DataFrame:
    """One value per calendar month, NULL for months without data."""
    series = totals.select("month", F.col(BOAT_TOTALS[boats][int(large)]).alias("value"))
    out = calendar.join(series, "month", "left")
    return out.select("c", "month", F.when(F.col("idx") >= 0, F.col("value")).alias("value"))


def country_scale(series: DataFrame) -> DataFrame:
    """The largest monthly value of any country, for charts that share one scale."""
    return series.agg(F.max("anchored_on_meadow").alias("scale"))


def monthly_table(totals: DataFrame) -> DataFrame:
    return totals.select("month", "anchored_on_meadow", "large_on_meadow", "anchored_total").orderBy("month")
