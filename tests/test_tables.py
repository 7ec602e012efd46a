"""Releases, files, the incremental ingest and the whole build."""

import os

import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS, Params
from fathomline.operators import checks, country, publish, releases, selection
from fathomline.plans import build
from fathomline.plans.bindings import Tables
from fathomline.runtime import scratch_path
from fathomline.schema import DETECTIONS, OVERPASSES
from fathomline.sources import files
from fathomline.streaming import incremental

SF = "/root/testdata/sf0.001"
REL = ("record_id long, period string, title string, published string, detections_url string, detections_name string, detections_size long, "
       "overpass_url string, overpass_name string, overpass_size long")
LEDGER = "period string, record_id long, detections_schema int, overpass_rows long, has_files boolean"


def rel(spark, *periods, **changes):
    base = {"title": "t", "published": "2026-01-01", "detections_url": "d", "detections_name": "d.csv", "detections_size": 1, "overpass_url": "o",
            "overpass_name": "o.csv", "overpass_size": 1, **changes}
    return spark.createDataFrame([{"record_id": int(p), "period": p, **base} for p in periods], REL)


def ledger(spark, **schemas):
    return spark.createDataFrame([(k[1:], 1, v, None, True) for k, v in schemas.items()], LEDGER)


def values(df, name="period"):
    return [r[name] for r in df.collect()]


def asked(spark, latest, *requests):
    return sorted(values(releases.releases_for_months(spark.createDataFrame([(r,) for r in requests], "request string"), latest)))


def test_requests_prefer_monthly_releases_and_fall_back(spark):
    latest = rel(spark, "2024", "2025", "202501", "202502")
    assert asked(spark, latest, "2025-02", "2025") == ["202501", "202502"]
    assert asked(spark, latest, "2024-06") == ["2024"] and asked(spark, latest, "2024") == ["2024"]
    assert asked(spark, latest, "2023-05") == []
    missing = releases.resolve_requests(spark.createDataFrame([("2023-05",)], "request string"), latest)
    assert [tuple(r) for r in missing.collect()] == [("2023-05", None)]


def test_newest_complete_release_wins(spark):
    all_ = (rel(spark, "2024").unionByName(rel(spark, "2024", published="2026-02-01").withColumn("record_id", F.lit(7).cast("long")))
            .unionByName(rel(spark, "2024", published="2026-03-01", overpass_size=-1)).unionByName(rel(spark, "2024", published="2026-03-01", overpass_url=None))
            .unionByName(rel(spark, "2023", overpass_size=0)))
    assert {(r.period, r.record_id) for r in releases.latest_release_per_period(all_).collect()} == {("2024", 7), ("2023", 2023)}


def test_periods_come_from_title_or_file_name_and_the_last_file_counts(spark):
    f = "id long, title string, published string, files array<struct<key:string,link:string,size:long>>"
    det, ovp = "sentinel2_vessel_detections_x_{}.csv", "sentinel2_overpass_{}.csv"
    rows = [(1, " 202501 data", "p", [(det.format("202501"), "u", 1), (det.format("202502"), None, 2), (ovp.format("202501"), "o", None)]),
            (2, "data", "p", [(ovp.format("2024"), "o", 3)]), (3, "data", "p", [("readme", "u", 1)]), (4, "20251 x", "p", [(det.format("2023"), "u", 1)]), (5, "2022", "p", [])]
    got = {r.record_id: r for r in releases.parse_releases(spark.createDataFrame(rows, f), "http://h/{id}/{key}").collect()}
    assert {k: v.period for k, v in got.items()} == {1: "202501", 2: "2024", 4: "2023", 5: "2022"}
    assert got[1].detections_url == "http://h/1/" + det.format("202502") and got[1].detections_size == 2 and got[2].detections_url is None


def test_cache_state_depends_on_record_schema_and_files(spark):
    r = rel(spark, "202501")
    state = lambda *row: tuple(releases.keeps_overpass(releases.is_cached(r, spark.createDataFrame([row], LEDGER), DEFAULTS), spark.createDataFrame([row], LEDGER)).select("cached", "keep_overpass").first())
    assert state("202501", 202501, 2, 9, True) == (True, True)
    assert state("202501", 202501, None, 9, True) == (False, True)  # only the detections are read again
    assert state("202501", 202501, 2, 9, False) == (False, False)
    assert state("202501", 1, 2, 9, True) == (False, False)
    assert state("202502", 202501, 2, 9, True) == (False, False)


YEAR = [f"2025{m:02d}" for m in range(1, 13)]


def test_fetch_list_is_newest_first_without_superseded_years(spark):
    none = spark.createDataFrame([], LEDGER)
    assert values(releases.releases_to_fetch(rel(spark, "2024", "2025", *YEAR), none, DEFAULTS)) == [*reversed(YEAR), "2024"]
    partial = rel(spark, "2024", "2025", *[p for p in YEAR if p != "202507"])
    assert values(releases.releases_to_fetch(partial, none, DEFAULTS))[-2:] == ["2025", "2024"]
    assert "2024" not in values(releases.releases_to_fetch(partial, none, DEFAULTS, since="2025"))


def test_stale_periods_stop_a_build_unless_nothing_is_read_from_them(spark):
    stale = lambda led, since=None: sorted(values(releases.stale_releases(led, DEFAULTS, since)))
    assert stale(ledger(spark, p202501=None)) == ["202501"]
    with pytest.raises(releases.StaleRelease, match="202501"):
        releases.usable_periods(ledger(spark, p202501=None), DEFAULTS)
    assert stale(ledger(spark, p2025=None, **{f"p{m}": 2 for m in YEAR if m != "202501"})) == ["2025"]
    whole = ledger(spark, p2025=None, **{f"p{m}": 2 for m in YEAR})
    assert stale(whole) == [] and sorted(values(releases.usable_periods(whole, DEFAULTS))) == YEAR
    old = ledger(spark, p2023=2, p2024=None, p202412=None, p202501=2)
    assert stale(old) == ["2024", "202412"] and stale(old, "2025") == []
    assert sorted(values(releases.usable_periods(old, DEFAULTS, "2025"))) == ["2023", "202501"]
    assert stale(ledger(spark, p202501=None), "2025") == ["202501"]


def test_merge_takes_a_month_from_one_period_only(spark):
    rows = spark.createDataFrame([("2024", "2024-06", 1), ("2024", "2024-07", 2), ("202407", "2024-07", 3), ("202407", "2024-06", 4), ("202406x", "2024-06", 5)],
                                 "period string, month string, v int")
    periods = spark.createDataFrame([("2024",), ("202407",)], "period string")
    assert sorted(values(releases.merge_periods(rows, periods), "v")) == [1, 3]


def test_zone_attributes(spark):
    raw = spark.createDataFrame([(1, "200NM", "Spain", "ESP", "Spain", "ESP"), (2, "Joint regime", None, None, "Spain", "ESP"), (3, "x", "T", None, "S", None),
                                 (4, "Overlapping claim", "T", "GIB", "S", "GBR")], "pid int, pol_type string, territory1 string, iso_ter1 string, sovereign1 string, iso_sov1 string")
    got = [(r.iso3, r.name, r.priority) for r in country.normalise_zones(raw).orderBy("pid").collect()]
    assert got == [("ESP", "Spain", 0), ("ESP", "Spain", 1), ("UNK", "S", 3), ("GIB", "T", 2)]


# --------------------------------------------------------------------------------------------------------------- files
def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


HEADER = ["extra", *reversed(DETECTIONS.names)]


def line(lon, ts, mmsi=""):
    v = {"lat": "40.0", "lon": lon, "detect_timestamp": ts, "cloud_score": "nan", "potential_ice": "True", "likely_infrastructure": "FALSE", "mmsi": mmsi}
    return ",".join(v.get(c, "") for c in HEADER)


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    write(f"{tmp_path}/a.csv", ",".join(HEADER), line("5.0", "2025-07-01 10:00", "227000000"))
    (r,) = files.scan_detections_csv(spark, f"{tmp_path}/a.csv").collect()
    assert (r.lon, r.mmsi, r.cloud_score, r.potential_ice, r.likely_infrastructure, r.presence_score) == (5.0, "227000000", None, True, False, None)


def stored(spark, out):
    return sorted((r.period, r.month, r.lon) for r in files.read_stored(spark, out, DETECTIONS).collect())


def test_an_uploaded_period_replaces_itself_and_nothing_else(spark, tmp_path):
    out = f"{tmp_path}/out"
    assert stored(spark, out) == []
    head = ",".join(HEADER)
    write(f"{tmp_path}/y/1.csv", head, *[line(f"{k}.0", "2021-03-01 10:00") for k in range(3)], line("36.5", "2021-09-01 10:00"), line("36.6", "2021-09-01 10:00"))
    write(f"{tmp_path}/y/2.csv", head, line("9.0", "2021-10-01 10:00"), line("", "2021-10-01 10:00"))
    write(f"{tmp_path}/m.csv", head, line("7.0", "2021-10-05 10:00"), line("8.0", "2021-03-09 10:00"))
    files.ingest_detections(spark, {"2021": f"{tmp_path}/y", "202110": f"{tmp_path}/m.csv"}, out, DEFAULTS)
    year = [("2021", "2021-03", 0.0), ("2021", "2021-03", 1.0), ("2021", "2021-03", 2.0), ("2021", "2021-09", 36.5), ("2021", "2021-10", 9.0)]
    assert stored(spark, out) == [*year, ("202110", "2021-03", 8.0), ("202110", "2021-10", 7.0)]
    periods = spark.createDataFrame([("2021",), ("202110",)], "period string")
    merged = releases.merge_periods(files.read_stored(spark, out, DETECTIONS), periods)
    assert sorted(r.lon for r in merged.collect()) == [0.0, 1.0, 2.0, 7.0, 36.5]  # a stray row supplies no month
    write(f"{tmp_path}/empty.csv", head, line("90.0", "2021-10-05 10:00"))
    files.ingest_detections(spark, {"202110": f"{tmp_path}/empty.csv"}, out, DEFAULTS)
    assert stored(spark, out) == year
    files.ingest_detections(spark, {"2021": f"{tmp_path}/empty.csv"}, out, DEFAULTS)
    assert stored(spark, out) == []


def test_a_write_that_dies_leaves_the_old_period_and_the_ledger(spark, tmp_path, monkeypatch):
    out, head = f"{tmp_path}/out", ",".join(HEADER)
    write(f"{tmp_path}/1.csv", head, line("1.0", "2022-05-01 10:00"), line("2.0", "2022-06-01 10:00"))
    write(f"{tmp_path}/2.csv", head, *[line(f"{k}.5", f"2022-0{k}-01 10:00") for k in range(1, 8)])
    write(f"{tmp_path}/3.csv", head, line("3.0", "2022-07-01 10:00"))
    first = incremental.Upload("2022-06-03", 41, 0.0, "2022", f"{tmp_path}/1.csv")
    incremental.store_detections(spark, [first], out, DEFAULTS)
    before = [("2022", "2022-05", 1.0), ("2022", "2022-06", 2.0)]
    notes = lambda: {(r.period, r.record_id, r.rows) for r in releases.noted(spark, f"{out}/ledger", "detections").collect()}
    assert stored(spark, f"{out}/detections") == before and notes() == {("2022", 41, 2)}

    # tasks die when they meet one row, after others are written; an other period of the same delivery is complete by then
    scan = files.scan_detections_csv
    dying = lambda s, paths: scan(s, paths).withColumn("lon", F.when(F.col("lon") == 7.5, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("lon")))
    monkeypatch.setattr(files, "scan_detections_csv", dying)
    both = [incremental.Upload("2022-07-03", 44, 0.0, "2022", f"{tmp_path}/2.csv"), incremental.Upload("2022-07-03", 44, 0.0, "202207", f"{tmp_path}/3.csv")]
    with pytest.raises(Exception, match="lost"):
        incremental.store_detections(spark, both, out, DEFAULTS)
    assert stored(spark, f"{out}/detections") == before and notes() == {("2022", 41, 2)}

    # or between the last write and the manifest's replacement
    monkeypatch.setattr(files, "scan_detections_csv", scan)
    with monkeypatch.context() as m:
        m.setattr(files, "publish_versions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental.store_detections(spark, both, out, DEFAULTS)
    assert stored(spark, f"{out}/detections") == before

    reader = files.read_stored(spark, f"{out}/detections", DETECTIONS)  # of before the replacement
    incremental.store_detections(spark, both, out, DEFAULTS)
    assert len(stored(spark, f"{out}/detections")) == 8 and notes() == {("2022", 44, 7), ("202207", 44, 1)}
    assert sorted(r.lon for r in reader.collect()) == [1.0, 2.0]
    assert files.remove_unused(spark, f"{out}/detections") >= 3 and len(stored(spark, f"{out}/detections")) == 8


def test_a_build_tells_which_cells_were_never_asked_for(spark):
    from fathomline.operators import pressure
    cells = spark.createDataFrame([("a",), ("b",)], "cell string")
    assert [r.cell for r in pressure.missing_cells(cells, spark.createDataFrame([("2021", "a")], "period string, cell string")).collect()] == ["b"]


def test_uploads_are_taken_in_once_and_the_latest_published_counts(spark, tmp_path):
    inbox, out, seen = (f"{tmp_path}/{n}" for n in ("in", "out", "seen"))
    run = lambda p=DEFAULTS: incremental.ingest_new_detections(spark, inbox, out, seen, p)
    have = lambda: stored(spark, f"{out}/detections")
    head = ",".join(HEADER)
    up = f"{inbox}/2022-06-03_41_vessels_202205"
    write(f"{up}/a.csv", head, line("1.0", "2022-05-01 10:00"))
    write(f"{up}/b.csv", ",".join(sorted(HEADER)), ",".join(dict(zip(HEADER, line("2.0", "2022-05-02 10:00").split(","))).get(c, "") for c in sorted(HEADER)))
    write(f"{inbox}/2022-02-01_7_vessels_2021.csv", head, line("3.0", "2021-05-01 10:00"))
    run()
    first = [("2021", "2021-05", 3.0), ("202205", "2022-05", 1.0), ("202205", "2022-05", 2.0)]
    assert have() == first
    run()
    assert have() == first
    write(f"{up}/c.csv", head, line("4.0", "2022-05-03 10:00"))  # a late file of an upload: all of its files are read again
    write(f"{inbox}/2021-12-31_6_vessels_2021.csv", head, line("9.0", "2021-05-01 10:00"))  # an older upload that comes late
    run()
    assert have() == [*first, ("202205", "2022-05", 4.0)]
    write(f"{inbox}/2022-06-09_44_vessels_202205.csv", head, line("80.0", "2022-05-01 10:00"))  # a correction with no row in the box
    run()
    assert have() == first[:1]
    notes = {(r.period, r.record_id, r.rows) for r in releases.noted(spark, f"{out}/ledger", "detections").collect()}
    assert notes == {("2021", 7, 1), ("202205", 44, 0)}
    run(Params(schema_version=3))
    assert have() == first[:1]
    assert {r.detections_schema for r in releases.ledger(spark, f"{out}/ledger").collect()} == {3}


def test_overpasses_are_noted_with_the_cells_asked_for(spark, tmp_path):
    write(f"{tmp_path}/in/2022-06-03_41_ovp_202205.csv", "overpasses,h3_id,month,overpasses_cloud_under_20", "3,a,2022-05-01,2", "3,b,2022-05-01,1")
    write(f"{tmp_path}/in/2022-06-03_41_det_202205.csv.txt", "no csv")
    cells = spark.createDataFrame([("a",), ("never seen",)], "cell string")
    out = f"{tmp_path}/out"
    incremental.ingest_new_overpasses(spark, f"{tmp_path}/in", cells, out, f"{tmp_path}/s")
    assert [(r.h3_id, r.month, r.overpasses_cloud_under_20, r.period) for r in files.read_stored(spark, f"{out}/overpass", OVERPASSES).collect()] == [("a", "2022-05", 2, "202205")]
    assert {(r.period, r.cell) for r in incremental.requested_cells(spark, out).collect()} == {("202205", "a"), ("202205", "never seen")}
    (entry,) = releases.ledger(spark, f"{out}/ledger").collect()
    assert (entry.period, entry.record_id, entry.overpass_rows, entry.has_files) == ("202205", 41, None, False)
    releases.note(spark, f"{out}/ledger", [("202205", 41, "2022-06-03", "detections", 5, 2)])
    (entry,) = releases.ledger(spark, f"{out}/ledger").collect()
    assert (entry.overpass_rows, entry.has_files, entry.detections_schema) == (1, True, 2)
    assert [r.period for r in releases.usable_periods(releases.ledger(spark, f"{out}/ledger"), DEFAULTS).collect()] == ["202205"]


def test_records_as_delivered(spark, tmp_path):
    write(f"{tmp_path}/r.json", '{"id":5,"created":"2022-06-03T08:00:00","metadata":{"title":"202205 vessels"},"files":[{"key":"sentinel2_vessel_detections_x_202205.csv",'
          '"size":9,"links":{"self":"https://h/5"}},{"key":"sentinel2_overpass_202205.csv","size":0,"links":{"self":null}}]}',
          '{"id":6,"created":"2022-07-01","metadata":{"title":null,"publication_date":"2022-07-02"},"files":[]}')
    flat = releases.flatten_records(spark.read.schema(
        "id long, created string, metadata struct<title:string,publication_date:string>, files array<struct<key:string,size:long,links:struct<self:string>>>").json(f"{tmp_path}/r.json"))
    assert [(r.id, r.title, r.published) for r in flat.orderBy("id").collect()] == [(5, "202205 vessels", "2022-06-03T08:00:00"), (6, "", "2022-07-02")]
    (r,) = releases.latest_release_per_period(releases.parse_releases(flat, "https://f/{id}/{key}")).collect()
    assert (r.period, r.detections_url, r.overpass_url, r.overpass_size) == ("202205", "https://h/5", "https://f/5/sentinel2_overpass_202205.csv", 0)


def test_every_polygon_is_kept_and_numbered(spark, tmp_path):
    from pyspark.sql import types as T
    tri = lambda x: f"[[[{x},40],[{x + 1},40],[{x},41],[{x},40]]]"
    poly = lambda x: f'{{"type":"Polygon","coordinates":{tri(x)}}}'
    both = f'{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":[1,2]}},{poly(3)},{{"type":"MultiPolygon","coordinates":[{tri(4)},{tri(5)}]}}]}}'
    lines = [('"objectid":2', poly(1)), ("", poly(2)), ('"objectid":2', poly(6)), ('"objectid":900000000000', both), ('"objectid":1', '{"type":"Point","coordinates":[1,2]}'), ("", poly(7))]
    write(f"{tmp_path}/f.json", *[f'{{"type":"Feature","properties":{{{k}}},"geometry":{g}}}' for k, g in lines])
    props = T.StructType([T.StructField("objectid", T.LongType())])
    out = files.polygons_from_geojson(files.read_geojson(spark, f"{tmp_path}/f.json", props, sequence=True), "objectid", DEFAULTS).orderBy("pid").collect()
    assert [(r.pid, r.objectid, len(r.rings)) for r in out] == [(0, 2, 1), (1, 2, 1), (2, 900000000000, 3), (3, None, 1), (4, None, 1)]
    layer = publish.polygon_display_layer(spark.createDataFrame([(1, [[(5.0, 40.0), (5.0001, 40.0), (5.0001, 40.0001), (5.0, 40.0)]])],
                                                                "pid int, rings array<array<struct<lon:double,lat:double>>>"), 3000.0).collect()
    assert len(layer) == 1 and len(layer[0].rings[0]) == 4  # far below the tolerance, and still there


def test_geojson_collection_in_web_mercator(spark, tmp_path):
    from pyspark.sql import types as T
    ring = "[[1113194.9079327357,4865942.279503176],[1224514.3987260093,4865942.279503176],[1224514.3987260093,5009377.085697311],[1113194.9079327357,4865942.279503176]]"
    far = "[[11131949.0,4865942.0],[11231949.0,4865942.0],[11131949.0,5009377.0],[11131949.0,4865942.0]]"
    feature = '{"type":"Feature","properties":{"objectid":%d,"map_id":"m"},"geometry":%s}'
    feats = [(9, f'{{"type":"Polygon","coordinates":[{ring}]}}'), (4, f'{{"type":"MultiPolygon","coordinates":[[{ring}],[{ring}]]}}'), (5, '{"type":"Point","coordinates":[1.0,2.0]}'),
             (6, f'{{"type":"Polygon","coordinates":[{far}]}}'), (7, "null"), (8, '{"type":"Polygon","coordinates":[]}')]
    write(f"{tmp_path}/c.json", '{"type":"FeatureCollection","features":[', ",\n".join(feature % f for f in feats), "]}")
    props = T.StructType([T.StructField("objectid", T.LongType()), T.StructField("map_id", T.StringType())])
    out = files.polygons_from_geojson(files.read_geojson(spark, f"{tmp_path}/c.json", props), "objectid", DEFAULTS, ["map_id"], mercator=True)
    got = [(r.pid, r.objectid, r.map_id, len(r.rings)) for r in out.orderBy("pid").collect()]
    assert got == [(0, 4, "m", 2), (1, 9, "m", 1)]
    v = out.first().rings[0][0]
    assert (v.lon, v.lat) == (pytest.approx(10.0, abs=1e-9), pytest.approx(40.0, abs=1e-9))


def test_columnar_chunks_keep_order_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(i, f"c{i}", None if i == 1 else i) for i in (3, 1, 0, 2)], "i long, cell string, n int")
    one, = files.columnar(df, "i").collect()
    assert (one.cell, one.n) == (["c0", "c1", "c2", "c3"], [0, None, 2, 3])
    files.write_columnar_json(df, "i", f"{tmp_path}/j", chunk_rows=3)
    assert sorted((r.chunk, len(r.cell)) for r in spark.read.json(f"{tmp_path}/j").collect()) == [(0, 3), (1, 1)]


# --------------------------------------------------------------------------------------------------------------- build
def test_build_publishes_consistent_tables(spark, tmp_path):
    t = Tables(spark, SF)
    out = build.build(t.detections, t.overpass, t.meadows, t.zones, t.mids, DEFAULTS)
    build.write_published(out, f"{tmp_path}/pub", DEFAULTS)
    build.write_published(out, f"{tmp_path}/pub", DEFAULTS)  # again, in the place of the first
    assert os.listdir(tmp_path) == ["pub"]
    read = lambda n: spark.read.parquet(f"{tmp_path}/pub/{n}")
    s = read("summary").first()
    assert s.anchored_total > s.anchored_on_meadow > s.large_on_meadow > 0 and s.hexes == read("hexes").count()
    assert read("hex_monthly").agg(F.sum("n")).first()[0] == read("hexes").agg(F.sum("on_meadow")).first()[0] == s.anchored_on_meadow
    assert read("points").count() == s.anchored_on_meadow and read("hotspots").count() <= 50
    checks.enforce(checks.check_hotspots(publish.number_hotspots(read("hotspots")), DEFAULTS))
    for name in ("hexes", "hex_monthly", "clear", "points", "timeseries", "countries", "hotspots"):
        chunks = spark.read.json(f"{tmp_path}/pub/{name}_json").collect()
        arrays = [c for c in chunks[0].asDict() if c != "chunk"]
        assert arrays and all(len({len(r[a]) for a in arrays}) == 1 for r in chunks)
        assert sum(len(r[arrays[0]]) for r in chunks) == read(name).count()
    one = spark.read.json(f"{tmp_path}/pub/hexes_json").first()
    assert len(one.cell) == s.hexes and one.cell == sorted(one.cell)
    meta = spark.read.json(f"{tmp_path}/pub/meta_json").first()
    assert meta.months == sorted(r.month for r in read("timeseries").collect()) and meta.bbox == list(DEFAULTS.bbox)
    layer = lambda df: {r.id: (r.type, [(float(v.lon), float(v.lat)) for ring in r.rings for v in ring], list(r.parts)) for r in df.collect()}
    assert layer(files.read_layer(spark, f"{tmp_path}/pub/meadows")) == layer(out.layer)
    series = publish.series_of(read("countries"), read("timeseries")).groupBy("month").agg(F.sum("anchored_on_meadow").alias("n"))
    assert {r.month: r.n for r in series.collect()} == {r.month: r.anchored_on_meadow for r in read("timeseries").collect()}
    sums = files.read_partitions(spark, f"{tmp_path}/pub/running")
    asked = selection.selection_between(sums, read("hexes"), read("timeseries"))
    assert asked.agg(F.sum("on_meadow")).first()[0] == s.anchored_on_meadow
    feature = spark.read.json(f"{tmp_path}/pub/meadows").first()
    assert feature.geometry.type == "Polygon" and feature.properties.id is not None


def test_build_without_zones_leaves_countries_unknown(spark):
    t = Tables(spark, SF)
    with pytest.warns(UserWarning, match="never asked for"):
        out = build.build(t.detections, t.overpass, t.meadows, None, t.mids, DEFAULTS, validate=False, requested=t.cells.limit(3).select("cell"))
    assert out.unasked.count() == t.cells.count() - 3
    assert {r.country for r in out.hexes.select("country").distinct().collect()} == {"UNK"}


def test_lineage_is_cut_in_the_shared_folder(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(base.rstrip("/"))
