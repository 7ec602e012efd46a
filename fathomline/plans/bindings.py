"""The library's input tables, derived from the benchmark's star-schema tables.

The formulas are SQL text that Spark and the checking engine read alike (constants are written with ``e0`` so that both take
them as doubles).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Params
from ..functions import geo
from ..operators import pressure, releases
from ..operators.country import ZoneIndex, index_zones, normalise_zones
from ..operators.spatial import PolygonIndex
from ..runtime import cut_lineage
from . import build


def centre(key: str) -> tuple[str, str]:
    """Longitude and latitude of a harbour."""
    return (f"(-5.5e0 + 41.5e0*(({key}*7919)%1009)/1009e0)", f"(30.5e0 + 15e0*(({key}*6007)%997)/997e0)")


_CLON, _CLAT = centre("l_suppkey")
_TWO = "lpad(cast({} as string), 2, '0')"
_CONF = "(80 + l_orderkey%21)/100e0"

#: lineitem (with a version 0 or 1) -> detections
DETECTION_COLUMNS = {
    "scene_id": "'SC-' || cast(l_suppkey as string) || '-' || cast(l_linenumber as string)",
    "lat": f"{_CLAT} + (((l_partkey*53 + l_orderkey*29 + l_linenumber)%201) - 100)/5000e0 + version*0.00001e0",
    "lon": f"{_CLON} + (((l_partkey*31 + l_orderkey*17)%201) - 100)/5000e0",
    "detect_timestamp": "substr(cast(l_shipdate as string), 1, 10) || ' 10:' || "
                        f"{_TWO.format('l_orderkey%60')} || ':' || {_TWO.format('l_partkey%60')}",
    "speed_kn_inferred": "cast(l_discount*20e0 as float)",
    "heading_deg_inferred": "cast((l_partkey*7)%360 as float)",
    "length_m_inferred": "cast(l_quantity as float)",
    "presence_score": "cast((25 + (l_orderkey*7 + l_linenumber)%75)/100e0 as float)",
    "nonvessel_score": "cast(l_tax*12e0 as float)",
    "cloud_score": "cast(case when l_partkey%17 = 0 then null else ((l_partkey*13)%100)/100e0 end as float)",
    "likely_infrastructure": "l_returnflag = 'R' and l_linenumber = 7",
    "potential_ice": "case when l_linenumber = 6 then null else l_orderkey%500 = 0 end",
    "matching_score": "cast((l_orderkey%100)/100e0 as float)",
    "matching_confidence": "cast(case when l_orderkey%3 = 0 or l_orderkey%29 = 0 then null when version = 1 "
                           f"then least({_CONF} + 0.05e0, 0.95e0) else {_CONF} end as float)",
    "mmsi": "case when l_orderkey%3 = 0 then null when l_orderkey%50 = 1 then '  ' else "
            "cast(201 + l_suppkey%575 as string) || lpad(cast(l_orderkey%1000000 as string), 6, '0') end",
    "ais_speed_kn_before": "cast(case when l_partkey%5 = 0 then null else (l_partkey%40)/20e0 end as float)",
    "ais_speed_kn_after": "cast(case when l_partkey%7 = 0 then null else ((l_partkey + l_orderkey)%40)/20e0 end as float)",
    "ais_length_m": "cast(case when l_partkey%11 = 0 then null else l_quantity + (l_partkey%10)/10e0 end as float)",
}
#: lineitem rows that were processed a second time
REPROCESSED = "l_partkey%60 between 30 and 39"
MONTH = "substr(detect_timestamp, 1, 7)"

#: octagon around a harbour, a square hole, and the shift of a second, overlapping octagon
_A, _B, _H, SECOND_SHIFT = 0.01203, 0.00503, 0.00203, 0.00609
OCTAGON = [(_A, _B), (_B, _A), (-_B, _A), (-_A, _B), (-_A, -_B), (-_B, -_A), (_B, -_A), (_A, -_B)]
HOLE = [(_H, _H), (-_H, _H), (-_H, -_H), (_H, -_H)]
HAS_HOLE, HAS_SECOND = "s_suppkey%5 = 0", "s_suppkey%4 = 1"

#: nation -> maritime zones: a 5 x 5 tiling with overlaps and gaps
_OFF = "(case when n_nationkey%3 = 0 then 0.05e0 when n_nationkey%4 = 1 then -0.1e0 else 0e0 end)"
ZONE_BOX = {
    "lon0": f"-6e0 + 8.5e0*(n_nationkey%5) - {_OFF}", "lon1": f"-6e0 + 8.5e0*(n_nationkey%5) + 8.5e0 + {_OFF}",
    "lat0": f"30e0 + 3.2e0*floor(n_nationkey/5e0) - {_OFF}", "lat1": f"30e0 + 3.2e0*floor(n_nationkey/5e0) + 3.2e0 + {_OFF}",
}
_ISO = "'N' || lpad(cast(n_nationkey as string), 2, '0')"
ZONE_COLUMNS = {
    "pid": "n_nationkey", "mrgid": "8000 + n_nationkey", "geoname": "n_name || ' zone'",
    "pol_type": "case when n_nationkey%3 = 0 then 'Joint regime' when n_nationkey%7 = 5 then 'Overlapping claim' "
                "when n_nationkey%11 = 10 then '12NM' else '200NM' end",
    "territory1": "case when n_nationkey%4 = 2 then null else n_name end",
    "iso_ter1": f"case when n_nationkey%4 = 2 or n_nationkey = 7 then null else {_ISO} end",
    "sovereign1": "'Sovereign ' || cast(n_regionkey as string)",
    "iso_sov1": f"case when n_nationkey = 7 then null else {_ISO} end",
}

#: orders -> overpasses of the cells around each harbour
OVERPASS_COLUMNS = {
    "month": "substr(cast(o_orderdate as string), 1, 7) || '-01'",
    "overpasses": "cast(1 + o_orderkey%4 as int)",
    "overpasses_cloud_under_20": "cast(case when o_orderpriority = '5-LOW' then 0 else o_orderkey%3 end as int)",
}

#: months and years of orders -> release records; kind 0 is the first upload of a period, 1 a later one, 2 lacks a file
NO_MONTHLY = "1998-04"
RECORD_COLUMNS = {
    "id": "cast(period as bigint)*10 + kind",
    "title": "case when (length(period) = 6 and cast(substr(period, 5, 2) as int)%3 = 0) then 'Vessel detections' "
             "else '  ' || period || ' vessel detections' end",
    "published": "substr(period, 1, 4) || '-' || lpad(cast(10 + kind as string), 2, '0') || '-28'",
    "det_key": "'sentinel2_vessel_detections_global_' || period || '.csv'",
    "det_link": "case when kind = 1 then null else 'https://files.example/' || period || '/detections' end",
    "det_size": "cast(1000 + kind as bigint)",
    "ovp_key": "case when kind = 2 then 'readme.txt' else 'sentinel2_overpass_' || period || '.csv' end",
    "ovp_link": "'https://files.example/' || period || '/overpass'",
    "ovp_size": "cast(case when cast(period as bigint)%11 = 3 then null when cast(period as bigint)%11 = 4 then 0 when cast(period as bigint)%11 = 5 then -1 else 500 + kind end as bigint)",
}
FILES_URL = "https://files.example/records/{id}/{key}"
#: newest releases -> ledger of ingested periods
LEDGER_FILTER = "cast(period as bigint)%3 <> 1"
LEDGER_COLUMNS = {
    "period": "period",
    "record_id": "case when cast(period as bigint)%5 = 0 then record_id - 1 else record_id end",
    "detections_schema": "cast(case when substr(period, 1, 4) < '1997' then 1 when cast(period as bigint)%13 = 0 then null else 2 end as int)",
    "overpass_rows": "cast(case when cast(period as bigint)%4 = 0 then null else 9 end as bigint)",
    "has_files": "cast(period as bigint)%7 <> 0",
}

#: detections -> rows of the period they were delivered in: annual up to 1998, monthly from 1998 on, some misplaced
ANNUAL_ROWS, MONTHLY_ROWS = "substr(month, 1, 4) <= '1998'", f"substr(month, 1, 4) >= '1998' and month <> '{NO_MONTHLY}'"
ANNUAL_PERIOD = "substr(month, 1, 4)"
MONTHLY_PERIOD = "case when scene_id like '%-7' then '199812' else replace(month, '-', '') end"

MID_COLUMNS = {"mid": "cast(201 + s_suppkey%575 as string)",
               "iso2": "chr(cast(65 + s_suppkey%26 as int)) || chr(cast(65 + (s_suppkey*7)%26 as int))"}


def select(columns: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in columns.items()]


def _ring(lon: str, lat: str, offsets: list[tuple[float, float]]) -> str:
    closed = [*offsets, offsets[0]]
    return "array(" + ", ".join(f"struct({lon} + ({dx!r}e0) as lon, {lat} + ({dy!r}e0) as lat)" for dx, dy in closed) + ")"


class Tables:
    """All tables of one scale-factor folder, built on demand. Reference tables are materialised once per instance."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = DEFAULTS):
        self.spark, self.folder, self.p = spark, folder.rstrip("/"), params

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ------------------------------------------------------------------------------------------------------ detections
    @cached_property
    def detections(self) -> DataFrame:
        """Stored as parquet first, like ingested releases, so that filters reach the scan."""
        return cut_lineage(self.derived_detections, "detections")

    @cached_property
    def derived_detections(self) -> DataFrame:
        versions = F.when(F.expr(REPROCESSED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = self.raw("lineitem").withColumn("version", F.explode(versions))
        return rows.selectExpr(*select(DETECTION_COLUMNS)).selectExpr("*", f"{MONTH} as month")

    @cached_property
    def delivered(self) -> DataFrame:
        """Detections with the period of the file they came in; months around the change come twice."""
        periods = F.array_compact(F.array(F.expr(f"case when {ANNUAL_ROWS} then {ANNUAL_PERIOD} end"),
                                          F.expr(f"case when {MONTHLY_ROWS} then {MONTHLY_PERIOD} end")))
        return self.detections.withColumn("period", F.explode(periods))

    @cached_property
    def delivered_periods(self) -> DataFrame:
        return self.delivered.select("period").distinct()

    # -------------------------------------------------------------------------------------------------------- polygons
    @cached_property
    def meadows(self) -> DataFrame:
        lon, lat = centre("s_suppkey")
        first = f"case when {HAS_HOLE} then array({_ring(lon, lat, OCTAGON)}, {_ring(lon, lat, HOLE)}) else array({_ring(lon, lat, OCTAGON)}) end"
        second = f"case when {HAS_SECOND} then array({_ring(f'({lon} + {SECOND_SHIFT!r}e0)', lat, OCTAGON)}) end"
        rows = self.raw("supplier").selectExpr("s_suppkey", f"array_compact(array({first}, {second})) as parts")
        return rows.select("s_suppkey", F.posexplode("parts").alias("part", "rings")).selectExpr(
            "cast(s_suppkey*2 + part as int) as pid", "rings")

    @cached_property
    def raw_zones(self) -> DataFrame:
        b = ZONE_BOX
        corners = [("lon0", "lat0"), ("lon1", "lat0"), ("lon1", "lat1"), ("lon0", "lat1"), ("lon0", "lat0")]
        ring = "array(" + ", ".join(f"struct({b[x]} as lon, {b[y]} as lat)" for x, y in corners) + ")"
        return self.raw("nation").selectExpr(*select(ZONE_COLUMNS), f"array({ring}) as rings")

    @cached_property
    def zones(self) -> DataFrame:
        return normalise_zones(self.raw_zones)

    @cached_property
    def meadow_index(self) -> PolygonIndex:
        return build.index_meadows(self.meadows, self.p)

    @cached_property
    def zone_index(self) -> ZoneIndex:
        return index_zones(self.zones, self.p)

    @cached_property
    def cells(self) -> DataFrame:
        return cut_lineage(build.meadow_cells(self.meadows, self.meadow_index, self.zone_index, self.p))

    # ------------------------------------------------------------------------------------------------------ overpasses
    @cached_property
    def overpass_raw(self) -> DataFrame:
        supplier = self.raw("supplier")
        x, y = geo.to_metric(*[F.expr(e) for e in centre("s_suppkey")])
        q, r = geo.axial(F.col("x"), F.col("y"))
        harbours = supplier.select("s_suppkey", x.alias("x"), y.alias("y")).select("s_suppkey", q.alias("q"), r.alias("r"))
        ring = F.array(*[F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr")) for dq, dr in geo.RING1])
        n = supplier.agg(F.count(F.lit(1))).scalar()
        rows = self.raw("orders").withColumn("s_suppkey", F.col("o_custkey") % n).join(harbours, "s_suppkey")
        rows = rows.withColumn("d", F.get(ring, (F.col("o_orderkey") % 7).cast("int")))
        h3 = geo.cell_id(F.col("q") + F.col("d.dq"), F.col("r") + F.col("d.dr"))
        return rows.withColumn("h3_id", h3).selectExpr("h3_id", *select(OVERPASS_COLUMNS))

    @cached_property
    def overpass(self) -> DataFrame:
        return self.overpass_raw.withColumn("month", F.substring("month", 1, 7))

    # ------------------------------------------------------------------------------------------------ facts and counts
    @cached_property
    def calendar(self) -> DataFrame:
        return cut_lineage(pressure.calendar_union(self.detections, self.overpass), "calendar")

    @cached_property
    def fact(self) -> DataFrame:
        return build.fact_table(self.detections, self.meadow_index, self.zone_index, self.p, build.PUBLISHED)

    @cached_property
    def rows(self) -> DataFrame:
        return pressure.hex_monthly(self.fact, self.cells, self.calendar)

    @cached_property
    def hexes(self) -> DataFrame:
        return pressure.aggregate_hexes(self.fact, self.cells, self.overpass, self.calendar)

    @cached_property
    def clear(self) -> DataFrame:
        return pressure.clear_matrix(self.cells, self.overpass, self.calendar)

    @cached_property
    def totals(self) -> DataFrame:
        return pressure.monthly_totals(self.fact, self.calendar)

    @cached_property
    def ais_totals(self) -> DataFrame:
        return pressure.ais_monthly_totals(self.rows, self.calendar)

    @cached_property
    def series(self) -> DataFrame:
        return pressure.country_series(self.fact, self.calendar)

    @cached_property
    def mids(self) -> DataFrame:
        rows = self.raw("supplier").selectExpr("s_suppkey", *select(MID_COLUMNS))
        return rows.groupBy("mid").agg(F.min_by("iso2", "s_suppkey").alias("iso2"))

    # -------------------------------------------------------------------------------------------------------- releases
    @cached_property
    def records(self) -> DataFrame:
        """Source records: one upload per year, per month from 1998 on, some corrected and some incomplete ones."""
        months = self.raw("orders").selectExpr("substr(cast(o_orderdate as string), 1, 7) as month").distinct()
        annual = months.selectExpr("substr(month, 1, 4) as period", "array(0) as kinds").distinct()
        kinds = "array_compact(array(0, case when cast(substr(month, 6, 2) as int)%4 = 0 then 1 end, case when cast(substr(month, 6, 2) as int)%5 = 0 then 2 end))"
        monthly = months.where(f"substr(month, 1, 4) >= '1998' and month <> '{NO_MONTHLY}'").selectExpr(
            "replace(month, '-', '') as period", f"{kinds} as kinds")
        rows = annual.unionByName(monthly).select("period", F.explode("kinds").alias("kind")).selectExpr(*select(RECORD_COLUMNS))
        files = "array(struct(ovp_key as key, ovp_link as link, ovp_size as size), struct(det_key as key, det_link as link, det_size as size))"
        return rows.selectExpr("id", "title", "published", f"{files} as files")

    @cached_property
    def releases(self) -> DataFrame:
        return releases.parse_releases(self.records, FILES_URL)

    @cached_property
    def latest(self) -> DataFrame:
        return releases.latest_release_per_period(self.releases)

    @cached_property
    def ledger(self) -> DataFrame:
        return self.latest.where(LEDGER_FILTER).selectExpr(*select(LEDGER_COLUMNS))

    @cached_property
    def requests(self) -> DataFrame:
        """Asked for: every month of orders and every year, and the same five years later, which partly do not exist."""
        months = self.raw("orders").selectExpr("substr(cast(o_orderdate as string), 1, 7) as month").distinct()
        late = "cast(cast(substr(month, 1, 4) as int) + 5 as string)"
        return months.selectExpr(f"explode(array(month, substr(month, 1, 4), {late} || substr(month, 5, 3), {late})) as request").distinct()
