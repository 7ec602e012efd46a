"""What is kept of single months: equal to counting everything, made again only where something has changed."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS
from fathomline.operators import releases
from fathomline.plans import build, partials
from fathomline.plans.bindings import Tables
from fathomline.schema import DETECTIONS
from fathomline.sources import files

SF = "/root/testdata/sf0.001"


def square(spark, side):
    ring = [(5.0, 40.0), (5.0 + side, 40.0), (5.0 + side, 40.0 + side), (5.0, 40.0 + side), (5.0, 40.0)]
    return spark.createDataFrame([(0, [ring])], "pid int, rings array<array<struct<lon:double,lat:double>>>")


def detections(spark, *rows):
    """(minute, lon) each; a boat on the meadow where lon is below 5.1."""
    base = {"lat": 40.05, "speed_kn_inferred": 0.1, "length_m_inferred": 30.0, "presence_score": 0.9, "nonvessel_score": 0.1, "cloud_score": 0.1,
            "likely_infrastructure": False, "potential_ice": False}
    data = [{**base, "scene_id": f"s{i}", "detect_timestamp": f"{when}:00", "lon": lon} for i, (when, lon) in enumerate(rows)]
    return spark.createDataFrame(data, DETECTIONS).withColumn("month", F.substring("detect_timestamp", 1, 7))


def store(spark, out, **periods):
    path = f"{out}/detections"
    files.publish_versions(spark, path, {p[1:]: files.write_version(rows, path, p[1:]) for p, rows in periods.items()})


def kept(spark, out):
    c = partials.kept_counts(spark, out)
    totals = {r.month: (r.anchored_total, r.anchored_on_meadow) for r in c.totals.collect()}
    points = {r.month: r["count"] for r in c.points.groupBy("month").count().collect()}
    assert points == {m: on for m, (_, on) in totals.items() if on} and c.cells.agg(F.sum("n")).first()[0] == (sum(points.values()) or None)
    assert set(totals) <= {r.month for r in c.months.collect()}
    return totals


def test_only_months_whose_rows_or_rules_have_changed_are_made_again(spark, tmp_path, monkeypatch):
    out, meadow = f"{tmp_path}/out", square(spark, 0.1)
    dims = build.Dimensions(build.index_meadows(meadow, DEFAULTS), None, None)
    names = spark.createDataFrame([("2021",), ("202103",), ("202104",)], "period string")

    def refresh(p=DEFAULTS, meadows=meadow, periods=names):
        return partials.refresh(spark, out, periods, meadows, None, dims, p)

    assert refresh() == [] and kept(spark, out) == {}
    year = detections(spark, ("2021-01-01 10:00", 5.01), ("2021-01-01 10:00", 5.01), ("2021-02-01 10:00", 9.0), ("2021-03-01 10:00", 5.02), ("2021-05-01 10:00", 5.03))
    march = detections(spark, ("2021-03-02 10:00", 5.02), ("2021-03-03 10:00", 5.03), ("2021-04-09 10:00", 5.04))  # a stray row of April
    store(spark, out, _2021=year, _202103=march)
    assert refresh() == ["2021-01", "2021-02", "2021-03", "2021-05"] and refresh() == []
    first = {"2021-01": (1, 1), "2021-02": (1, 0), "2021-03": (2, 2), "2021-05": (1, 1)}
    assert kept(spark, out) == first

    store(spark, out, _202104=detections(spark, ("2021-04-01 10:00", 5.05)))  # one new month
    with monkeypatch.context() as m:  # which dies before its manifest is replaced
        publish = files.publish_versions
        m.setattr(files, "publish_versions", lambda s, path, v: publish(s, path, v) if path.endswith("points") else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh()
    assert kept(spark, out) == first
    assert refresh() == ["2021-04"] and kept(spark, out) == first | {"2021-04": (1, 1)}

    store(spark, out, _202103=march.where("month = '2021-04'"))  # a correction that leaves the month without rows: the year does not step in
    assert refresh() == [] and kept(spark, out) == {k: v for k, v in first.items() if k != "2021-03"} | {"2021-04": (1, 1)}
    assert refresh(replace(DEFAULTS, hotspots_n=3, points_cap=1)) == []
    assert refresh(periods=names.where("period <> '202103'")) == ["2021-03"]  # now it does
    assert kept(spark, out)["2021-03"] == (1, 1)
    every = [f"2021-0{k}" for k in range(1, 6)]
    assert refresh(replace(DEFAULTS, presence_score_min=0.95), periods=names.where("period <> '202103'")) == every
    assert kept(spark, out) == {} and {r.month for r in partials.kept_counts(spark, out).months.collect()} == set(every)
    assert refresh(meadows=square(spark, 0.2), periods=names.where("period <> '202103'")) == every
    assert files.remove_unused(spark, f"{out}/months/counts") > 0 and len(kept(spark, out)) == 5


def test_a_build_of_kept_months_equals_one_of_all_detections(spark, tmp_path):
    t, out = Tables(spark, SF), f"{tmp_path}/out"
    det = t.detections.withColumn("period", F.substring("month", 1, 4))
    ovp = t.overpass.withColumn("period", F.substring("month", 1, 4))
    periods = sorted(r[0] for r in det.select("period").union(ovp.select("period")).distinct().collect())
    for part, rows in (("detections", det), ("overpass", ovp)):
        files.publish_versions(spark, f"{out}/{part}", {p: files.write_version(rows.where(F.col("period") == p), f"{out}/{part}", p) for p in periods})
        releases.note(spark, f"{out}/ledger", [(p, 1, "2026-01-01", part, 1, DEFAULTS.schema_version if part == "detections" else None) for p in periods])
    files.publish_versions(spark, f"{out}/requested", {"1996": files.write_version(t.overpass.select(F.col("h3_id").alias("cell")).distinct(), f"{out}/requested", "1996", by=())})
    whole = build.build(t.detections, t.overpass, t.meadows, t.zones, t.mids, DEFAULTS, validate=False)
    parts = partials.build_stored(spark, out, t.meadows, t.zones, t.mids, DEFAULTS)
    for name in ("timeseries", "countries", "hexes", "hex_monthly", "points", "hotspots", "summary"):
        a, b = getattr(whole, name), getattr(parts, name).select(*getattr(whole, name).columns)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
