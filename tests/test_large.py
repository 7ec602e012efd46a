"""What large tables are spared: whole rows that cannot stay, columns nobody reads, tasks that write a whole source."""

import itertools

import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS
from fathomline.operators import detections, spatial
from fathomline.plans import build
from fathomline.plans import queries as registry
from fathomline.schema import DETECTIONS, OVERPASSES, conform, with_optional
from fathomline.sources import files
from fathomline.streaming import incremental

BASE = {"lat": 39.52, "lon": 2.61, "detect_timestamp": "2023-06-14 10:41:07", "speed_kn_inferred": 0.35, "presence_score": 0.62, "nonvessel_score": 0.4,
        "cloud_score": 0.21, "likely_infrastructure": False, "potential_ice": False, "length_m_inferred": 17.5}


def versions(spark):
    """Groups of versions that differ in match, confidence and quality, in all combinations of two and three, with equal ones; some without a minute."""
    kinds = [{"mmsi": m, "matching_confidence": c, "speed_kn_inferred": s, "scene_id": scene}
             for m, c, scene in ((None, None, "A"), (None, 0.5, "B"), ("224", None, "A"), ("224", 0.5, "B"), (" ", 0.5, "A"), ("224", 0.9, "C"), ("224", float("nan"), "A"))
             for s in (0.35, 7.0)]
    groups = [*itertools.combinations_with_replacement(kinds, 2), *itertools.combinations(kinds, 3)]
    rows = [{**BASE, **v, "lat": 38.0 + (g % 300) / 100, "lon": 2.0 + (g // 300) / 100, "detect_timestamp": None if g % 17 == 0 else "" if g % 17 == 1 else BASE["detect_timestamp"]}
            for g, group in enumerate(groups) for v in group]
    text = spark.createDataFrame([{k: None if v is None else str(v) for k, v in r.items()} for r in rows], ", ".join(f"{k} string" for k in rows[0]))
    return conform(with_optional(text, *DETECTIONS.fields), DETECTIONS)


def counted(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_wanted_rows_are_those_of_the_whole_dedupe(spark):
    df = versions(spark)
    slow = F.col("speed_kn_inferred") < 1
    whole, apart = detections.dedupe_detections(df).where(slow), detections.dedupe_wanted(df, slow)
    assert apart.columns == df.columns and counted(apart) == counted(whole) and 0 < whole.count() < df.where(slow).count()
    many, stored = detections._anchored(df, DEFAULTS, whole=0)
    few, plain = detections._anchored(df, DEFAULTS)
    assert stored and not plain and counted(many) == counted(few)


def test_without_ties_rows_that_are_not_wanted_are_read_once_more_by_nobody(spark):
    df = versions(spark).where("scene_id = 'C' or speed_kn_inferred < 1").where("mmsi = '224'")
    slow = F.col("speed_kn_inferred") < 1
    assert counted(detections.dedupe_wanted(df, slow)) == counted(detections.dedupe_detections(df).where(slow))


def test_a_stored_table_is_not_written_again_for_a_lookup(spark, monkeypatch):
    square = [(0.0, 0.0, 9.0, 0.0), (9.0, 0.0, 9.0, 9.0), (9.0, 9.0, 0.0, 9.0), (0.0, 9.0, 0.0, 0.0)]
    index = spatial.build_index(spark.createDataFrame([(1, *e) for e in square], "pid int, x1 double, y1 double, x2 double, y2 double"), 4.0, limit=1)
    df = spark.range(200).select(F.col("id"), (F.col("id") % 20).cast("double").alias("x"), (F.floor(F.col("id") / 10) * 1.1).alias("y"))
    want = counted(spatial.points_in_polygons(df, index, F.col("x"), F.col("y")))
    monkeypatch.setattr("fathomline.operators.joins.cut_lineage", lambda *a: pytest.fail("written again"))
    assert counted(spatial.points_in_polygons(df, index, F.col("x"), F.col("y"), stored=True)) == want


def test_facts_have_only_the_columns_asked_for(spark):
    df = versions(spark).withColumn("month", F.substring("detect_timestamp", 1, 7))
    fact = build.fact_table(df, None, None, DEFAULTS, build.PUBLISHED)
    wide = build.fact_table(df, None, None, DEFAULTS)
    assert "presence_score" in wide.columns and "presence_score" not in fact.columns
    assert counted(fact) == counted(wide.select(*fact.columns))


def test_sources_are_written_by_as_many_tasks_as_their_rows_ask_for(spark, monkeypatch):
    rows = spark.range(95)
    assert registry._dealt(rows, 2).rdd.getNumPartitions() == 2
    monkeypatch.setattr(registry, "ROWS_PER_TASK", 10)
    dealt = registry._dealt(rows, 3)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 95
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) <= 12


def test_edges_of_few_small_files_are_dealt_out(spark):
    one = spark.range(20_000).coalesce(1).select(F.col("id").cast("int").alias("pid"), (F.col("id") * 3.0).alias("x1"), F.lit(0.0).alias("y1"),
                                                 (F.col("id") * 3.0 + 1).alias("x2"), F.lit(1.0).alias("y2"))
    seen = []
    cut = spatial.cut_lineage
    spatial.cut_lineage = lambda df, *a: (seen.append(df._jdf.queryExecution().executedPlan().toString()), cut(df, *a))[1]
    try:
        spatial.build_index(one, 50.0)
    finally:
        spatial.cut_lineage = cut
    assert "Exchange hashpartitioning(pid" in seen[0]


def test_scanned_rows_are_put_together_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_PER_TASK", 30)
    many, few = spark.range(0, 95, 1, 8), spark.range(0, 95, 1, 1)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert registry._scanned(many, 3).rdd.getNumPartitions() == 4 and "Exchange" not in plan(registry._scanned(many, 3))
    assert registry._scanned(few, 3).rdd.getNumPartitions() == 4 and registry._scanned(few, 3).count() == 95


def _uploads(spark, folder):
    rows = versions(spark).withColumn("detect_timestamp", F.when(F.col("lat") < 39, "2023-05-14 10:41:07").otherwise(F.col("detect_timestamp"))).repartition(5)
    for period, part in (("202305", rows.where("scene_id = 'A'")), ("202306", rows.where("scene_id <> 'A'"))):
        part.write.options(header=True, compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/2026-03-01_300_release_{period}")
    return rows


def test_uploads_are_stored_without_a_shuffle_and_settings_are_put_back(spark, tmp_path, monkeypatch):
    rows = _uploads(spark, tmp_path / "in")
    monkeypatch.setattr(files, "TASKS", 2)
    monkeypatch.setattr(type(rows), "hint", lambda *a: pytest.fail("shuffled"))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    got = files.ingest_detections(spark, {p: f"{tmp_path}/in/2026-03-01_300_release_{p}" for p in ("202305", "202306")}, f"{tmp_path}/out", DEFAULTS)
    stored = files.read_stored(spark, f"{tmp_path}/out", DETECTIONS)
    names = [f.name for f in DETECTIONS.fields]
    want = rows.withColumn("month", F.substring("detect_timestamp", 1, 7)).withColumn("period", F.expr("case when scene_id = 'A' then '202305' else '202306' end"))
    assert spark.conf.get(key) == before and sum(got.values()) == rows.count()
    assert counted(stored.select(*names, "period")) == counted(want.withColumn("detect_timestamp", F.expr("nullif(detect_timestamp, '')")).select(*names, "period"))
    assert len(list((tmp_path / "out").glob("period=202305/*/month=2023-06/*.parquet"))) <= 2


def test_compressed_uploads_are_taken_in(spark, tmp_path):
    rows = _uploads(spark, tmp_path / "in")
    assert incremental.upload_of("/in/2026-03-01_300_x_202305.csv.gz", 1.0) == incremental.Upload("2026-03-01", 300, 1.0, "202305", "/in/2026-03-01_300_x_202305.csv.gz")
    assert incremental.upload_of("/in/x_202305/part-0.csv.gz", 1.0).path == "/in/x_202305" and incremental.upload_of("/in/x_202305.csv", 1.0).path == "/in/x_202305.csv"
    incremental.ingest_new_detections(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/seen", DEFAULTS)
    assert files.read_stored(spark, f"{tmp_path}/out/detections", DETECTIONS).count() == rows.count()


def test_files_of_several_periods_are_read_once(spark, tmp_path, monkeypatch):
    rows = [(f"{i}_0", f"2023-0{1 + i % 3}-01", i, i % 2) for i in range(60)]
    spark.createDataFrame(rows, "h3_id string, month string, overpasses int, overpasses_cloud_under_20 int").write.option("header", True).csv(f"{tmp_path}/in")
    cells = spark.createDataFrame([(f"{i}_0",) for i in range(0, 60, 2)] * 2, "cell string")
    read, scan = [], files.scan_csv
    monkeypatch.setattr(files, "scan_csv", lambda *a: (read.append(a), scan(*a))[1])
    got = files.ingest_overpasses(spark, dict.fromkeys(("2023", "202301", "202302"), f"{tmp_path}/in"), cells, f"{tmp_path}/out")
    assert got == {"2023": 30, "202301": 30, "202302": 30} and len(read) == 1
    stored = files.read_stored(spark, f"{tmp_path}/out", OVERPASSES)
    assert counted(stored.select("h3_id", "month", "overpasses", "period")) == sorted((c, m[:7], str(o), p) for c, m, o, _ in rows if o % 2 == 0 for p in ("2023", "202301", "202302"))
