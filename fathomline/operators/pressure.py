"""Counts per month, country, cell and season from the fact table, and their normalisation.

The fact table is always reduced to (cell, month) or (month, country) partial counts first; everything after that works
on dimension-sized rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import season_of, widened
from ..schema import AIS_COUNTERS, COUNTERS, SEASONS
from .country import UNKNOWN

#: names of the monthly totals, in the order of ``AIS_COUNTERS``
AIS_TOTALS = (
    "ais_matched_on_meadow", "ais_matched_large_on_meadow", "ais_stationary_on_meadow",
    "ais_stationary_large_on_meadow", "ais_moving_on_meadow",
)


def zeros(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in names})


def calendar_union(*tables: DataFrame) -> DataFrame:
    """Months present in any of the tables."""
    out = tables[0].select("month")
    for t in tables[1:]:
        out = out.unionByName(t.select("month"))
    return out.distinct()


def month_array(calendar: DataFrame) -> Column:
    """The sorted months of a calendar as one scalar array (a calendar has twelve rows a year)."""
    return calendar.agg(F.array_sort(F.collect_set("month"))).scalar()


def every_month(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each row once per calendar month."""
    return df.withColumn("_months", month_array(calendar)).withColumn("month", F.explode("_months")).drop("_months")


def month_filter(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return df.join(calendar.select("month"), "month", "left_semi")


# ---------------------------------------------------------------------------------------------------- months, countries
def monthly_totals(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return fill_totals(total_counts(fact), calendar)


def total_counts(fact: DataFrame) -> DataFrame:
    on = F.col("on_meadow")
    return fact.groupBy("month").agg(
        F.count(F.lit(1)).alias("anchored_total"),
        F.count_if(on).alias("anchored_on_meadow"),
        F.count_if(on & F.col("large")).alias("large_on_meadow"))


def fill_totals(counts: DataFrame, calendar: DataFrame) -> DataFrame:
    return zeros(calendar.select("month").join(counts, "month", "left"),
                 "anchored_total", "anchored_on_meadow", "large_on_meadow")


def ais_monthly_totals(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per month the AIS counters of ``hex_monthly``, summed over the cells."""
    sums = rows.groupBy("month").agg(*[F.sum(c).alias(t) for c, t in zip(AIS_COUNTERS, AIS_TOTALS)])
    return zeros(calendar.select("month").join(sums, "month", "left"), *AIS_TOTALS)


def country_series(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Counts per country and month, zero-filled over the calendar, for countries with at least one row on meadow."""
    return fill_series(country_counts(fact), calendar)


def country_counts(fact: DataFrame) -> DataFrame:
    return fact.where("on_meadow").groupBy("country", "month").agg(
        F.count(F.lit(1)).alias("anchored_on_meadow"), F.count_if("large").alias("large_on_meadow"))


def fill_series(counts: DataFrame, calendar: DataFrame) -> DataFrame:
    frame = every_month(counts.select("country").distinct(), calendar)
    return zeros(frame.join(counts, ["country", "month"], "left"), "anchored_on_meadow", "large_on_meadow")


# ------------------------------------------------------------------------------------------------------------- cells
def cell_months(fact: DataFrame, *also: str) -> DataFrame:
    """Seven counters per (cell, month), or finer by other columns, of the on-meadow rows."""
    large, sure, still = F.col("large"), F.col("ais_confident"), F.col("ais_stationary")
    return fact.where("on_meadow").groupBy("cell", "month", *also).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(large).alias("large"),
        F.count_if(sure).alias("ais"), F.count_if(sure & large).alias("ais_large"),
        F.count_if(still).alias("ais_st"), F.count_if(still & large).alias("ais_st_large"),
        F.count_if("ais_moving").alias("ais_mv"))


def hex_monthly(fact: DataFrame, cells: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sparse counters of the known cells and months."""
    return known_cell_months(cell_months(fact), cells, calendar)


def known_cell_months(per_month: DataFrame, cells: DataFrame, calendar: DataFrame) -> DataFrame:
    counted = month_filter(per_month, calendar)
    return counted.join(cells.select("cell"), "cell", "left_semi").select("cell", "month", *COUNTERS)


def cell_counts(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    per = month_filter(fact.where("on_meadow").groupBy("cell", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("large").alias("large")), calendar)
    return per.groupBy("cell").agg(F.sum("n").alias("on_meadow"), F.sum("large").alias("large_on_meadow"))


def clear_months(overpass: DataFrame, calendar: DataFrame) -> DataFrame:
    """Clear overpasses per cell and month, where there are any rows (cell, month, clear)."""
    per = overpass.groupBy(F.col("h3_id").alias("cell"), "month").agg(
        F.sum(F.col("overpasses_cloud_under_20").cast("bigint")).alias("clear"))
    return month_filter(per, calendar)


def clear_overpasses(overpass: DataFrame, calendar: DataFrame) -> DataFrame:
    return clear_months(overpass, calendar).groupBy("cell").agg(F.sum("clear").alias("clear_overpasses"))


def overpass_semi(overpass: DataFrame, cells: DataFrame, calendar: DataFrame) -> DataFrame:
    known = cells.select(F.col("cell").alias("h3_id"))
    return month_filter(overpass.join(known, "h3_id", "left_semi"), calendar)


def density(on: Column, clear: Column) -> Column:
    return F.when(clear > 0, on / F.when(clear > 0, clear))


def _by_season(value: str, prefix: str = "") -> list[Column]:
    return [F.sum(F.when(F.col("season") == s, F.col(value)).otherwise(0)).alias(f"{prefix}{s}") for s in SEASONS]


def season_pivot(fact: DataFrame, overpass: DataFrame, cells: DataFrame, calendar: DataFrame) -> DataFrame:
    """Counts, large counts and clear overpasses per cell and season; cells without any have zeros."""
    on = month_filter(cell_months(fact), calendar).withColumn("season", season_of(F.col("month")))
    clear = clear_months(overpass, calendar).withColumn("season", season_of(F.col("month")))
    counts = on.groupBy("cell").agg(*_by_season("n"), *_by_season("large", "large_"))
    passes = clear.groupBy("cell").agg(*_by_season("clear", "clear_"))
    names = [p + s for p in ("", "large_", "clear_") for s in SEASONS]
    return zeros(cells.select("cell").join(counts, "cell", "left").join(passes, "cell", "left"), *names)


def peak_months(per_month: DataFrame) -> DataFrame:
    """The month with most rows per cell, the latest one on ties."""
    return per_month.groupBy("cell").agg(F.max_by("month", F.struct("n", "month")).alias("peak_month"))


def unknown_cells(counted: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells that have detections but are no known cell: country UNK, no area."""
    return counted.select("cell").distinct().join(cells.select("cell"), "cell", "left_anti").select(
        "cell", F.lit(UNKNOWN).alias("country"), F.lit(0.0).alias("meadow_km2"))


def all_cells(counted: DataFrame, cells: DataFrame) -> DataFrame:
    return cells.select("cell", "country", "meadow_km2").unionByName(unknown_cells(counted, cells))


def aggregate_hexes(fact: DataFrame, cells: DataFrame, overpass: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per cell over all months: counts, density, area, seasons, peak month."""
    return hexes_of(cell_months(fact), cells, overpass, calendar)


def hexes_of(per_month: DataFrame, cells: DataFrame, overpass: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same from counters per cell and month."""
    on = month_filter(per_month.select("cell", "month", "n", "large"), calendar)
    on = on.withColumn("season", season_of(F.col("month")))
    counts = on.groupBy("cell").agg(
        F.sum("n").alias("on_meadow"), F.sum("large").alias("large_on_meadow"),
        *_by_season("n"), *_by_season("large", "large_"),
        F.max_by("month", F.struct("n", "month")).alias("peak_month"))
    passes = (
        clear_months(overpass, calendar).withColumn("season", season_of(F.col("month")))
        .groupBy("cell").agg(F.sum("clear").alias("clear_overpasses"), *_by_season("clear", "clear_"))
    )
    # a full join appends cells that have detections but are no known cell
    known = cells.select("cell", "country", "meadow_km2")
    out = known.join(counts, "cell", "full").join(passes, "cell", "left")
    names = ["on_meadow", "large_on_meadow", "clear_overpasses", *[p + s for p in ("", "large_", "clear_") for s in SEASONS]]
    out = zeros(out, *names).withColumns({
        "country": F.coalesce("country", F.lit(UNKNOWN)), "meadow_km2": F.coalesce("meadow_km2", F.lit(0.0)),
        "density": density(F.col("on_meadow"), F.col("clear_overpasses"))})
    return out.select("cell", "country", "on_meadow", "large_on_meadow", "clear_overpasses", "density", "meadow_km2",
                      *[p + s for s in SEASONS for p in ("", "large_", "clear_")], "peak_month")


def clear_matrix(cells: DataFrame, overpass: DataFrame, calendar: DataFrame) -> DataFrame:
    """Clear overpasses of every cell in every month, 0 where none."""
    frame = every_month(cells.select("cell"), calendar)
    return zeros(frame.join(clear_months(overpass, calendar), ["cell", "month"], "left"), "clear")


def missing_cells(cells: DataFrame, overpass_cells: DataFrame) -> DataFrame:
    """Known cells the overpass subset does not cover; their clear count would read 0."""
    return cells.select("cell").join(overpass_cells.select("cell").distinct(), "cell", "left_anti")


# ------------------------------------------------------------------------------------------------------------- rollups
def pressure_rollup(fact: DataFrame) -> DataFrame:
    """All published grains in one pass: month, country x month, cell x month and cell, told apart by ``grain``.

    The grouping sets run over (country, cell, month) partial counts, so the fact rows are not multiplied.
    """
    base = fact.where("on_meadow").groupBy("country", "cell", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("large").alias("n_large"))
    sets = [["month"], ["country", "month"], ["cell", "month"], ["cell"]]
    out = base.groupingSets(sets, "country", "cell", "month").agg(
        F.sum("n").alias("on_meadow"), F.sum("n_large").alias("large_on_meadow"),
        F.grouping("country").alias("_gc"), F.grouping("cell").alias("_gl"), F.grouping("month").alias("_gm"))
    grain = (F.when(F.col("_gm") == 1, "cell").when(F.col("_gc") == 0, "country_month")
             .when(F.col("_gl") == 0, "cell_month").otherwise("month"))
    return out.select(grain.alias("grain"), "country", "cell", "month", "on_meadow", "large_on_meadow")


def build_summary(totals: DataFrame, hexes: DataFrame) -> DataFrame:
    cells = hexes.agg(F.count(F.lit(1)).alias("hexes"), F.count_if(F.col("on_meadow") > 0).alias("hexes_with_detections"))
    return totals.agg(
        F.count(F.lit(1)).alias("months"), F.coalesce(F.sum("anchored_total"), F.lit(0)).alias("anchored_total"),
        F.coalesce(F.sum("anchored_on_meadow"), F.lit(0)).alias("anchored_on_meadow"),
        F.coalesce(F.sum("large_on_meadow"), F.lit(0)).alias("large_on_meadow"),
    ).withColumns({"hexes": cells.select("hexes").scalar(), "hexes_with_detections": cells.select("hexes_with_detections").scalar()})


def ais_check(totals: DataFrame) -> DataFrame:
    """How far the boats' own AIS agrees with the image-based speed, over all months. Empty when nothing matched."""
    if "ais_matched_on_meadow" not in totals.columns or "ais_stationary_on_meadow" not in totals.columns:
        return totals.limit(0).select(*[F.lit(None).cast("bigint").alias(c) for c in (
            "matched", "stationary", "moving", "no_speed", "stationary_pct", "moving_pct", "moving_of_checked_pct")])
    with_moving = "ais_moving_on_meadow" in totals.columns
    moving_sum = F.sum("ais_moving_on_meadow") if with_moving else F.lit(None).cast("bigint")
    s = totals.agg(F.sum("ais_matched_on_meadow").alias("matched"), F.sum("ais_stationary_on_meadow").alias("st"),
                   moving_sum.alias("mv")).where("matched > 0")
    s = s.withColumn("stationary", F.least("st", "matched"))
    # least() would skip the NULL of data without moving counts
    s = s.withColumn("moving", F.when(F.col("mv").isNotNull(), F.least("mv", F.col("matched") - F.col("stationary"))))
    pct = lambda a, b: F.floor(100 * a / b + 0.5).cast("bigint")
    checked = F.col("stationary") + F.col("moving")
    return s.select(
        "matched", "stationary", "moving", (F.col("matched") - checked).alias("no_speed"),
        pct(F.col("stationary"), F.col("matched")).alias("stationary_pct"),
        pct(F.col("moving"), F.col("matched")).alias("moving_pct"),
        F.when(F.col("moving") > 0, pct(F.col("moving"), F.when(checked > 0, checked)))
        .when(F.col("moving").isNotNull(), F.lit(0).cast("bigint")).alias("moving_of_checked_pct"))


def country_totals(series: DataFrame) -> DataFrame:
    """Countries with at least one row, ``UNK`` last, then by total."""
    t = series.groupBy("country").agg(F.sum("anchored_on_meadow").alias("total"), F.sum("large_on_meadow").alias("large"))
    return t.where("total > 0").orderBy(F.col("country") == UNKNOWN, F.desc("total"), "country")


# Limits of the reported speed bands, in knots.
SPEED_BANDS = (1.0, 5.0)


def ais_speed_bands(fact: DataFrame) -> DataFrame:
    """Confident matches on meadow with a known AIS speed, by size and speed band, with each size's share and median.

    Speeds are aggregated to (size, speed) counts first; the median runs over those. AIS reports tenths of a knot up to 102.2,
    so there are some 2,000 different means.
    """
    speed = widened(F.col("ais_speed_kn"))
    counted = (
        fact.where(F.col("on_meadow") & F.col("ais_confident") & F.col("ais_speed_kn").isNotNull())
        .groupBy("large", speed.alias("kn")).agg(F.count(F.lit(1)).alias("n"))
    )
    low, high = SPEED_BANDS
    band = F.when(F.col("kn") < low, "below 1").when(F.col("kn") < high, "1 to 5").otherwise("5 and more")
    whole = counted.groupBy("large").agg(F.sum("n").alias("all_n"), F.percentile("kn", 0.5, F.col("n")).alias("median_kn"))
    bands = counted.groupBy("large", band.alias("band")).agg(F.sum("n").alias("n"))
    return bands.join(whole, "large").select("large", "band", "n", (F.col("n") / F.col("all_n")).alias("share"), "median_kn")
