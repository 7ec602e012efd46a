"""From raw detections to the fact table: dedupe, filter, place on meadows and in cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import Params
from ..functions import geo
from ..functions.predicates import anchored, has_mmsi, holds, is_large, region_rules, with_ais
from ..functions.scalars import widened
from ..runtime import cut_lineage, elements
from .spatial import PolygonIndex, points_in_polygons

#: decides between equally good versions of a detection; together with the key this covers every column used later
TIE_BREAKERS = (
    "detect_timestamp", "scene_id", "lat", "lon", "speed_kn_inferred", "length_m_inferred", "presence_score",
    "nonvessel_score", "cloud_score", "likely_infrastructure", "potential_ice", "mmsi", "matching_confidence",
    "ais_speed_kn_before", "ais_speed_kn_after", "ais_length_m",
)
#: versions of one detection differ by less than this many degrees
SAME_PLACE_DEG = 2e-4
#: rows near the region up to which all versions are ranked in one shuffle of whole rows
RANKED_WHOLE = 5_000_000
_KEY = ["_lat4", "_lon4", "_minute"]


def dedupe_detections(df: DataFrame, tie_breakers: tuple[str, ...] = TIE_BREAKERS) -> DataFrame:
    """One row per place (4 decimals) and minute: a matched version first, then the most confident match.

    The best row is picked with a rank limit, so every map task sends at most one row per key to the shuffle and a
    hot key costs no more than any other.
    """
    return _first(df, _place_and_minute(), tie_breakers)


def _place_and_minute() -> list[Column]:
    return [
        F.rint(F.col("lat") * 1e4).cast("bigint"),
        F.rint(F.col("lon") * 1e4).cast("bigint"),
        F.substring("detect_timestamp", 1, 16),
    ]


def _confidence(df: DataFrame) -> Column:
    return widened(F.col("matching_confidence")) if "matching_confidence" in df.columns else F.lit(None).cast("double")


def _first(df: DataFrame, key: Sequence[Column], tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    order = [has_mmsi(df).desc()]
    if "matching_confidence" in df.columns:
        order.append(_confidence(df).desc_nulls_last())
    order += [F.col(c).asc_nulls_first() for c in tie_breakers if c in df.columns]
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_rank = 1").drop("_rank")


def dedupe_wanted(df: DataFrame, wanted: Column) -> DataFrame:
    """The rows of ``dedupe_detections`` for which ``wanted`` holds, without moving whole rows of the others; written as a table.

    Wanted rows compete among themselves. Of the others, a key has only to tell whether its best version is matched and how
    confident: that settles all but the keys where both are equal, and only of those whole rows are compared.
    """
    rows = df.withColumns({
        **dict(zip(_KEY, _place_and_minute())), "_matched": has_mmsi(df), "_conf": _confidence(df), "_wanted": holds(wanted)})
    # a missing minute is a key of its own
    rows = rows.withColumn("_minute", F.coalesce(F.concat(F.lit("_"), "_minute"), F.lit("")))
    others = rows.where("not _wanted")
    rivals = others.groupBy(*_KEY).agg(
        F.max("_matched").alias("_m"), F.max(F.when(F.col("_matched"), F.col("_conf"))).alias("_m1"),
        F.max(F.when(~F.col("_matched"), F.col("_conf"))).alias("_m0"))
    best = F.when(F.col("_m"), F.col("_m1")).otherwise(F.col("_m0"))
    same, conf = F.col("_m") == F.col("_matched"), F.col("_conf")
    loses = (F.col("_m") & ~F.col("_matched")) | (same & holds((best > conf) | (best.isNotNull() & conf.isNull())))
    left = _first(rows.where("_wanted"), [F.col(k) for k in _KEY]).join(rivals, _KEY, "left").where(~holds(loses))
    left = cut_lineage(left.withColumn("_tie", holds(same & best.eqNullSafe(conf))).drop("_m", "_m1", "_m0"), "anchored")
    stay = left.where("not _tie").select(*df.columns)
    if left.where("_tie").isEmpty():
        return stay
    tied = cut_lineage(left.where("_tie").drop("_tie"), "tied")
    asked = tied.select(*[F.col(c).alias(f"{c}_") for c in (*_KEY, "_matched", "_conf")])
    on = [F.col(k) == F.col(f"{k}_") for k in (*_KEY, "_matched")]
    equal = others.join(asked, [*on, F.col("_conf").eqNullSafe(F.col("_conf_"))], "left_semi")
    first = _first(tied.unionByName(equal), [F.col(k) for k in _KEY]).where("_wanted").select(*df.columns)
    return cut_lineage(stay.unionByName(first), "anchored")


def near_region(df: DataFrame, p: Params) -> DataFrame:
    """Cheap filter before the dedupe: drops only rows no version of which can lie in the region."""
    m = SAME_PLACE_DEG
    grown = replace(
        p,
        bbox=(p.bbox[0] - m, p.bbox[1] - m, p.bbox[2] + m, p.bbox[3] + m),
        exclude_boxes=tuple((b[0] + m, b[1] + m, b[2] - m, b[3] - m) for b in p.exclude_boxes))
    return df.where(region_rules(F.col("lon"), F.col("lat"), grown))


def anchored_in_region(det: DataFrame, p: Params) -> DataFrame:
    """Deduped rows that are in the region and anchored, with metric coordinates.

    Quality is judged after the dedupe: a poor version that wins takes its detection with it.
    """
    return _anchored(det, p)[0]


def _anchored(det: DataFrame, p: Params, whole: int | None = None) -> tuple[DataFrame, bool]:
    """The same, and whether they are read from a table."""
    near = near_region(det, p)
    wanted = [region_rules(F.col("lon"), F.col("lat"), p), anchored(near, p)]
    many = elements(near) > (RANKED_WHOLE if whole is None else whole)
    rows = dedupe_wanted(near, wanted[0] & wanted[1]) if many else dedupe_detections(near).where(wanted[0]).where(wanted[1])
    x, y = geo.to_metric(F.col("lon"), F.col("lat"))
    return rows.withColumns({"x": x, "y": y}), many


def classify(det: DataFrame, meadows: PolygonIndex | None, p: Params, keep: Sequence[str] | None = None) -> DataFrame:
    """The fact table: anchored detections with on_meadow, large, the AIS view and (on meadow only) the cell.

    ``keep`` names the columns of the detections that the facts have; without it they have all.
    """
    rows, stored = _anchored(det, p)
    flagged = with_ais(rows.withColumn("large", is_large(p)), p)
    if keep is not None:
        flagged = flagged.select(*keep, "x", "y", *[c for c in flagged.columns if c not in rows.columns])
    rows = points_in_polygons(flagged, meadows, F.col("x"), F.col("y"), p.buffer_m, stored=stored)
    return rows.withColumn("cell", F.when(F.col("on_meadow"), geo.cell_of(F.col("x"), F.col("y"))))
