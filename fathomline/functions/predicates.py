"""Row predicates: region, quality, anchored, size, AIS class.

Every predicate is two-valued: a comparison with a missing value is false, as the thresholds are meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Box, Params
from .scalars import all_of, widened


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def in_box(lon: Column, lat: Column, box: Box) -> Column:
    """Inclusive on all four sides."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def region_rules(lon: Column, lat: Column, p: Params) -> Column:
    """In the study box and in none of the excluded boxes (which are inclusive too); NULL for missing coordinates.

    The form for filters: nothing is wrapped around the comparisons, so a scan can use them.
    """
    return all_of([in_box(lon, lat, p.bbox), *[~in_box(lon, lat, b) for b in p.exclude_boxes]])


def in_region(lon: Column, lat: Column, p: Params) -> Column:
    return holds(region_rules(lon, lat, p))


def score_rules(p: Params) -> Column:
    """A missing presence score or length drops the row; a missing nonvessel or cloud score keeps it."""
    rules = []
    if p.presence_score_min is not None:
        rules.append(holds(F.col("presence_score") >= p.presence_score_min))
    if p.nonvessel_score_max is not None:
        rules.append(~holds(F.col("nonvessel_score") > p.nonvessel_score_max))
    if p.cloud_score_max is not None:
        rules.append(~holds(F.col("cloud_score") > p.cloud_score_max))
    if p.length_m_min:
        rules.append(holds(F.col("length_m_inferred") >= p.length_m_min))
    return all_of(rules)


def flag_rules(df: DataFrame, p: Params) -> Column:
    """Drop fixed structures and ice; a missing value, or a table without the column, keeps the row."""
    rules = []
    if p.exclude_infrastructure and "likely_infrastructure" in df.columns:
        rules.append(~holds(F.col("likely_infrastructure")))
    if p.exclude_ice and "potential_ice" in df.columns:
        rules.append(~holds(F.col("potential_ice")))
    return all_of(rules)


def quality(df: DataFrame, p: Params) -> Column:
    return score_rules(p) & flag_rules(df, p)


def slow(p: Params) -> Column:
    return holds(F.col("speed_kn_inferred") < p.speed_kn_max)


def anchored(df: DataFrame, p: Params) -> Column:
    return slow(p) & quality(df, p)


def is_large(p: Params) -> Column:
    return holds(F.col("length_m_inferred") >= p.large_length_m)


def has_mmsi(df: DataFrame) -> Column:
    """An AIS match is an MMSI that is more than white space; false for tables without the column."""
    if "mmsi" not in df.columns:
        return F.lit(False)
    return holds(F.col("mmsi").rlike(r"(?U)\S"))


def with_ais(df: DataFrame, p: Params) -> DataFrame:
    """Add ais_matched, ais_speed_kn, ais_confident, ais_stationary, ais_moving.

    The speed is the mean of the two reported ones and unknown unless both are there; a confident match
    without a speed is neither stationary nor moving. Values are compared at their decimal value.
    """
    speed = (widened(F.col("ais_speed_kn_before")) + widened(F.col("ais_speed_kn_after"))) / 2
    df = df.withColumn("ais_matched", has_mmsi(df))
    df = df.withColumns({
        "ais_speed_kn": F.when(F.col("ais_matched"), speed),
        "ais_confident": F.col("ais_matched") & holds(widened(F.col("matching_confidence")) >= p.ais_confidence_min),
    })
    return df.withColumns({
        "ais_stationary": F.col("ais_confident") & holds(F.col("ais_speed_kn") < p.speed_kn_max),
        "ais_moving": F.col("ais_confident") & holds(F.col("ais_speed_kn") >= p.speed_kn_max),
    })
