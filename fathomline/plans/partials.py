"""Counts and points of single months, kept beside the detections they were made from.

A detection's versions share its minute, so whatever becomes of a month's rows depends on those rows alone, on the meadows, the
zones and the parameters. What is kept of a month therefore bears a signature of all of them: the stored versions that supply it
and a fingerprint of the rest. ``refresh`` makes the months again whose signature has changed, all of them in one job, and nothing else; a
build then adds up what is kept instead of reading detections. Months are versions behind a manifest, like periods: a
job that dies on the way leaves what was there. Rows without a month belong to none and are left out.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Params
from ..operators import pressure, publish
from ..operators.releases import ledger, merge_periods, usable_periods
from ..runtime import cut_lineage
from ..schema import COUNTERS, DETECTIONS, OVERPASSES
from ..sources import files
from ..streaming import incremental
from . import build as b

#: to be raised whenever facts come to be derived in another way
FACTS_VERSION = 1
#: parameters that only matter after the facts are made
PUBLISHING = ("points_cap", "hotspots_n", "coord_decimals", "length_step_m")
GONE = "gone"
COUNTS = T.StructType([T.StructField("country", T.StringType()), T.StructField("cell", T.StringType()), T.StructField("anchored", T.LongType()),
                       *[T.StructField(c, T.LongType()) for c in COUNTERS]])
#: what publishing points reads of a fact
POINTS = T.StructType([
    *[DETECTIONS[c] for c in ("scene_id", "lat", "lon", "detect_timestamp", "length_m_inferred", "matching_confidence", "mmsi", "ais_length_m")],
    *[T.StructField(c, T.BooleanType()) for c in ("on_meadow", "large", "ais_matched", "ais_confident", "ais_stationary")],
    T.StructField("ais_speed_kn", T.DoubleType()), T.StructField("country", T.StringType())])


def fingerprint(table: DataFrame | None) -> list[str]:
    """Tells tables of different rows apart, whatever their order."""
    if table is None:
        return []
    row = F.xxhash64(*sorted(table.columns))
    return [str(v) for v in table.select(row.alias("h")).agg(F.count("h"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()]


def _month_folders(spark: SparkSession, path: str) -> set[tuple[str, str, str]]:
    """(period, version, month) of all stored detections: one entry per folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/period=*/version=*/month=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [s.getPath().toString().rsplit("/", 3)[1:] for s in found]
    return {tuple(n.split("=", 1)[1] for n in parts) for parts in names}


def month_sources(spark: SparkSession, path: str, periods: DataFrame) -> dict[str, list[str]]:
    """Of each month the stored versions that ``merge_periods`` takes its rows from, for the given periods."""
    usable = {r["period"] for r in periods.select("period").distinct().collect()}  # some hundred
    counting = {(p, v.name) for p, v in files.manifest(spark, path).items() if p in usable}
    own = {f"{p[:4]}-{p[4:]}" for p in usable if len(p) == 6}
    found: dict[str, list[str]] = {}
    for period, version, month in sorted(_month_folders(spark, path)):
        if (period, version) in counting and (period == month.replace("-", "") or (len(period) == 4 and month not in own)):
            found.setdefault(month, []).append(f"{period}/{version}")
    found.pop("__HIVE_DEFAULT_PARTITION__", None)
    return found


def month_counts(fact: DataFrame) -> DataFrame:
    """(month, country, cell): anchored detections and the counters of those on a meadow; those elsewhere have no cell."""
    on = F.col("on_meadow")
    anchored = fact.groupBy("month").agg(F.count_if(~on).alias("anchored")).where("anchored > 0").withColumns({
        "country": F.lit(None).cast("string"), "cell": F.lit(None).cast("string"), **{c: F.lit(0).cast("bigint") for c in COUNTERS}})
    cells = pressure.cell_months(fact, "country").withColumn("anchored", F.col("n"))
    return anchored.select("month", *COUNTS.names).unionByName(cells.select("month", *COUNTS.names))


def _append(rows: DataFrame, path: str, names: Mapping[str, str]) -> dict[str, files.Version]:
    """Write the rows of all months, each as the named version, in one job. Nothing reads them before they are published."""
    spark = rows.sparkSession
    named = spark.createDataFrame(sorted(names.items()), "month string, version string")
    (rows.join(named, "month").withColumnRenamed("month", "period").hint("rebalance", "period").write.mode("append")
     .option("compression", "zstd").partitionBy("period", "version").parquet(path))
    written = {m: files.Version(v, 1) for m, v in names.items() if _exists(spark, f"{path}/period={m}/version={v}")}
    sizes = {r["period"]: r["count"] for r in files.read_stored(spark, path, T.StructType([]), by=(), versions=written).groupBy("period").count().collect()}
    return {m: files.Version(v, sizes.get(m, 0)) for m, v in names.items()}


def _exists(spark: SparkSession, folder: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def refresh(spark: SparkSession, out: str, periods: DataFrame, meadows: DataFrame, zones: DataFrame | None, dims: b.Dimensions, p: Params) -> list[str]:
    """Bring what is kept below ``out``/months up to date with ``out``/detections; returns the months that were made again."""
    counts, points = f"{out}/months/counts", f"{out}/months/points"
    rules = {k: v for k, v in asdict(p).items() if k not in PUBLISHING}
    common = json.dumps([FACTS_VERSION, rules, fingerprint(meadows), fingerprint(zones)], sort_keys=True)
    wanted = {month: hashlib.sha256(json.dumps([common, v]).encode()).hexdigest()[:24]
              for month, v in month_sources(spark, f"{out}/detections", periods).items()}
    kept = {month: v.name.split("-")[0] for month, v in files.manifest(spark, counts).items()}
    changed = sorted(m for m, signature in wanted.items() if kept.get(m) != signature)
    new = {m: files.Version(GONE, 0) for m, signature in kept.items() if m not in wanted and signature != GONE}
    if changed:
        run = uuid.uuid4().hex[:12]
        names = {m: f"{wanted[m]}-{run}" for m in changed}
        stored = files.read_stored(spark, f"{out}/detections", DETECTIONS).where(F.col("month").isin(changed))
        fact = cut_lineage(b.fact_table(merge_periods(stored, periods), dims.meadows, dims.zones, p, b.PUBLISHED))
        on_meadow = fact.where("on_meadow").select("month", *[F.col(f.name).cast(f.dataType) for f in POINTS])
        files.publish_versions(spark, points, _append(on_meadow, points, names) | new)
        new |= _append(month_counts(fact), counts, names)
    if new:
        files.publish_versions(spark, counts, new)  # the one that counts
    return changed


def kept_counts(spark: SparkSession, out: str) -> b.Counts:
    """What a build needs, added up from the months that are kept."""
    known = {m: v for m, v in files.manifest(spark, f"{out}/months/counts").items() if v.name != GONE}
    by_month = files.read_stored(spark, f"{out}/months/counts", COUNTS, by=(), versions=known).withColumnRenamed("period", "month")
    months = spark.createDataFrame([(m,) for m in sorted(known)], "month string")
    # points go by the manifest of the counts: their own, which is replaced a moment earlier, only serves to remove old ones
    folder = f"{out}/months/points"
    with_points = {m: v for m, v in known.items() if v.rows and _exists(spark, f"{folder}/period={m}/version={v.name}")}
    points = files.read_stored(spark, folder, POINTS, by=(), versions=with_points).withColumnRenamed("period", "month")
    on = by_month.where("cell IS NOT NULL")
    return b.Counts(
        months=months,
        totals=by_month.groupBy("month").agg(F.sum("anchored").alias("anchored_total"), F.sum("n").alias("anchored_on_meadow"), F.sum("large").alias("large_on_meadow")),
        series=on.groupBy("country", "month").agg(F.sum("n").alias("anchored_on_meadow"), F.sum("large").alias("large_on_meadow")),
        cells=on.groupBy("cell", "month").agg(*[F.sum(c).alias(c) for c in COUNTERS]), points=points)


def build_stored(spark: SparkSession, out: str, meadows: DataFrame, zones: DataFrame | None, mids: DataFrame, p: Params,
                 tolerance_m: float = 30.0, validate: bool = True, target_bytes: int = publish.TARGET_BYTES) -> b.Published:
    """The build over what ``streaming.incremental`` has stored below ``out``. Only months that have changed are derived from detections."""
    periods = usable_periods(ledger(spark, f"{out}/ledger"), p)
    dims = b.dimensions(meadows, zones, p)
    refresh(spark, out, periods, meadows, zones, dims, p)
    overpass = merge_periods(files.read_stored(spark, f"{out}/overpass", OVERPASSES), periods)
    requested = incremental.requested_cells(spark, out).select("cell").distinct()
    return b.published(kept_counts(spark, out), overpass, dims, meadows, zones, mids, p, tolerance_m, validate, target_bytes, requested)
