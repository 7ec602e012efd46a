"""Contract checks: every rule is a count of violations, one aggregation per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions.predicates import holds
from ..schema import AIS_COUNTERS, SEASONS
from .pressure import AIS_TOTALS

# Columns and formats of the published tables.
HOTSPOT_COLUMNS = {"cell", "lon", "lat", "country", "place", "on_meadow", "large_on_meadow", "density", "peak_month"}
MONTH = r"\A\d{4}-\d{2}\z"
CELL = r"\A-?\d+_-?\d+\z"


class ContractError(ValueError):
    """A published table breaks its contract."""


def breaks(rule: Column) -> Column:
    """Rows on which a rule does not hold; a missing value does not hold."""
    return F.count_if(~holds(rule))


def violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """(table, rule, violations) for aggregate expressions over ``df``."""
    one = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"r{i}") for i, c in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(rules)])
    return one.select(F.explode(pairs).alias("v")).select(F.lit(table).alias("table"), "v.rule", "v.violations")


def _over(limit: int) -> Column:
    return F.greatest(F.count(F.lit(1)) - limit, F.lit(0))


def check_timeseries(totals: DataFrame, series: DataFrame, calendar: DataFrame) -> DataFrame:
    c = F.col
    counts = ["anchored_total", "anchored_on_meadow", "large_on_meadow", *AIS_TOTALS]
    n = calendar.agg(F.countDistinct("month")).scalar()
    monthly = violations(totals, "timeseries", {
        "month format": breaks(c("month").rlike(MONTH)),
        "one row per month": F.count(F.lit(1)) - F.countDistinct("month"),
        "counts present": breaks(reduce(lambda a, b: a & b, [c(x) >= 0 for x in counts])),
        "stationary + moving <= matched": breaks(
            c("ais_stationary_on_meadow") + c("ais_moving_on_meadow") <= c("ais_matched_on_meadow")),
    })
    missing = violations(calendar.join(totals.select("month"), "month", "left_anti"), "timeseries", {
        "month of the calendar missing": F.count(F.lit(1))})
    per = series.groupBy("country").agg(F.count(F.lit(1)).alias("months")).withColumn("_n", n)
    by_country = violations(per, "countries", {
        "iso3 has three letters": breaks(F.length("country") == 3),
        "series covers the calendar": breaks(c("months") == c("_n"))})
    return monthly.unionByName(missing).unionByName(by_country)


def check_hexes(hexes: DataFrame) -> DataFrame:
    c = F.col
    missing = {"cell", "country", "on_meadow", "large_on_meadow", "clear_overpasses", "density", "meadow_km2",
               *[p + s for p in ("", "large_", "clear_") for s in SEASONS]} - set(hexes.columns)
    if missing:
        raise ContractError(f"hexes lacks {sorted(missing)}")
    return violations(hexes, "hexes", {
        "valid cell id": breaks(c("cell").rlike(CELL)),
        "cells unique": F.count(F.lit(1)) - F.countDistinct("cell"),
        "density null exactly without clear overpasses": breaks(c("density").isNull() == (c("clear_overpasses") == 0)),
        "seasons sum to the total": breaks(reduce(lambda a, b: a + b, [c(s) for s in SEASONS]) == c("on_meadow")),
        "large <= all": breaks(c("large_on_meadow").between(0, c("on_meadow"))),
    })


def check_hex_monthly(rows: DataFrame, clear: DataFrame, hexes: DataFrame, calendar: DataFrame) -> DataFrame:
    """``rows`` and ``clear`` keyed by (cell, month)."""
    c = F.col
    nested = violations(rows, "hex_monthly", {
        "stationary <= AIS <= all": breaks((c("ais_st") <= c("ais")) & (c("ais") <= c("n"))),
        "large: stationary <= AIS <= all": breaks((c("ais_st_large") <= c("ais_large")) & (c("ais_large") <= c("large"))),
        "0 <= large <= all": breaks(c("large").between(0, c("n"))),
        "0 <= AIS large <= AIS": breaks(c("ais_large").between(0, c("ais"))),
        "0 <= stationary large <= stationary": breaks(c("ais_st_large").between(0, c("ais_st"))),
        "only rows with detections": breaks(c("n") > 0),
    })
    known = violations(rows.join(hexes.select("cell"), "cell", "left_anti"), "hex_monthly", {"cell known": F.count(F.lit(1))})
    months = violations(rows.join(calendar.select("month"), "month", "left_anti"), "hex_monthly", {"month known": F.count(F.lit(1))})
    n_cells, n_months = hexes.agg(F.count(F.lit(1))).scalar(), calendar.agg(F.countDistinct("month")).scalar()
    dense = clear.agg(F.count(F.lit(1)).alias("size")).select(F.abs(F.col("size") - n_cells * n_months).alias("d"))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).select(
        F.abs(F.col("s") - F.coalesce(hexes.agg(F.sum("on_meadow")).scalar(), F.lit(0))).alias("d"))
    out = nested.unionByName(known).unionByName(months)
    for df, rule in ((dense, "clear overpasses for every cell and month"), (total, "sum equals the hexes")):
        out = out.unionByName(violations(df, "hex_monthly", {rule: F.sum("d")}))
    return out


def check_points(points: DataFrame, calendar: DataFrame, p: Params) -> DataFrame:
    c = F.col
    if "mmsi" in points.columns:
        raise ContractError("points must not contain the MMSI")
    cls = c("ais_class")
    last = calendar.agg(F.countDistinct("month")).scalar()
    vessel = [c(x).isNull() for x in ("ais_speed_kn", "ais_length_m", "ais_flag")]
    return violations(points.withColumn("_months", last), "points", {
        "row cap": _over(p.points_cap) if p.points_cap is not None else F.lit(0),
        "class is 0..3": breaks(cls.between(0, 3)),
        "no confidence without a match": breaks((cls != 0) | c("ais_conf").isNull()),
        "confidence of a confident match": breaks((cls < 2) | c("ais_conf").isNotNull()),
        "vessel values only for a confident match": breaks((cls >= 2) | reduce(lambda a, b: a & b, vessel)),
        "length in steps": breaks(c("ais_length_m").isNull() | (c("ais_length_m") % p.length_step_m == 0)),
        "month in range": breaks(c("m").between(0, c("_months") - 1)),
    })


def check_polygons(layer: DataFrame) -> DataFrame:
    """``layer``: id, type, rings, parts."""
    if set(layer.columns) != {"id", "type", "rings", "parts"}:
        raise ContractError(f"polygon layer columns {sorted(layer.columns)}")
    ring = lambda r: (F.size(r) >= 4) & (r[0] == F.element_at(r, -1))
    return violations(layer, "polygons", {
        "polygonal": breaks(F.col("type").isin("Polygon", "MultiPolygon")),
        "id present": breaks(F.col("id").isNotNull()),
        "type by parts": breaks((F.size(F.array_distinct("parts")) > 1) == (F.col("type") == "MultiPolygon")),
        "ids unique": F.count(F.lit(1)) - F.countDistinct("id"),
        "rings closed": breaks(F.forall("rings", ring)),
    })


def check_hotspots(hot: DataFrame, p: Params) -> DataFrame:
    """Rows in published order: ``position`` numbers them."""
    if set(hot.columns) - {"position"} != HOTSPOT_COLUMNS:
        raise ContractError(f"hotspot columns {sorted(set(hot.columns) ^ HOTSPOT_COLUMNS)}")
    nxt = hot.select((F.col("position") - 1).alias("position"), F.col("on_meadow").alias("_next"))
    return violations(hot.join(nxt, "position", "left"), "hotspots", {
        "row cap": _over(p.hotspots_n),
        "descending": F.count_if(F.col("_next") > F.col("on_meadow")),
        "has detections": breaks(F.col("on_meadow") > 0),
    })


def check_totals_reconcile(ais_totals: DataFrame, rows: DataFrame) -> DataFrame:
    """Per month the AIS totals are the sums of the cell counters."""
    sums = rows.groupBy("month").agg(*[F.sum(c).alias(f"_{t}") for c, t in zip(AIS_COUNTERS, AIS_TOTALS)])
    both = ais_totals.join(sums, "month", "full")
    zero = F.lit(0)
    return violations(both, "totals", {
        f"{t} is the sum over cells": breaks(F.coalesce(F.col(t), zero) == F.coalesce(F.col(f"_{t}"), zero)) for t in AIS_TOTALS})


def enforce(*checks: DataFrame) -> None:
    """Raise when any rule has a violation."""
    found = reduce(DataFrame.unionByName, checks).where("violations > 0").collect()  # one row per rule at most
    if found:
        raise ContractError("; ".join(f"{r['table']}: {r['rule']} ({r['violations']})" for r in found))
