"""Column names and types of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns the detection and overpass files are read for.
DETECTIONS = T.StructType([
    T.StructField("scene_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("detect_timestamp", T.StringType()),
    T.StructField("speed_kn_inferred", T.FloatType()),
    T.StructField("heading_deg_inferred", T.FloatType()),
    T.StructField("length_m_inferred", T.FloatType()),
    T.StructField("presence_score", T.FloatType()),
    T.StructField("nonvessel_score", T.FloatType()),
    T.StructField("cloud_score", T.FloatType()),
    T.StructField("likely_infrastructure", T.BooleanType()),
    T.StructField("potential_ice", T.BooleanType()),
    T.StructField("matching_score", T.FloatType()),
    T.StructField("matching_confidence", T.FloatType()),
    T.StructField("mmsi", T.StringType()),
    T.StructField("ais_speed_kn_before", T.FloatType()),
    T.StructField("ais_speed_kn_after", T.FloatType()),
    T.StructField("ais_length_m", T.FloatType()),
])
OVERPASSES = T.StructType([
    T.StructField("h3_id", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("overpasses", T.IntegerType()),
    T.StructField("overpasses_cloud_under_20", T.IntegerType()),
])
SEASONS = ("DJF", "MAM", "JJA", "SON")

#: counters of one (cell, month): column -> what it counts among the on-meadow rows
AIS_COUNTERS = ("ais", "ais_large", "ais_st", "ais_st_large", "ais_mv")
COUNTERS = ("n", "large", *AIS_COUNTERS)


def with_optional(df: DataFrame, *fields: T.StructField) -> DataFrame:
    """Add a typed NULL column for every field the table does not have (older caches lack the AIS columns)."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name and cast them; text that is no value, and NaN, become NULL."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.dataType != T.StringType():
            c = c.try_cast(f.dataType)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)
