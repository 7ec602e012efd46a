"""The plans of the heavy operators, and every registered query against its SQL answer."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
from fathomline.config import DEFAULTS  # noqa: E402
from fathomline.operators import country, detections, ranking  # noqa: E402
from fathomline.plans import queries as registry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.fixture(scope="module")
def tables(spark):
    return registry.tables(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_before_the_shuffle_and_filters_reach_the_scan(tables):
    text = plan(detections.anchored_in_region(tables.detections, DEFAULTS))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(lon), IsNotNull(lat), GreaterThanOrEqual(lon," in text


def test_spatial_lookup_does_not_shuffle_points(tables):
    classified = detections.classify(tables.detections, tables.meadow_index, DEFAULTS)
    zoned = plan(country.zones_at(classified, tables.zone_index, F.col("lon"), F.col("lat"), only=F.col("on_meadow")))
    assert zoned.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in zoned and "NestedLoop" not in zoned
    # the dedupe's is the only shuffle of detections
    assert zoned.count("Exchange hashpartitioning") == 1
    # what is snapped to the nearest zone is looked up by place, in rows written before
    fact = plan(tables.fact)
    assert fact.count("BroadcastHashJoin") == 1 and "Exchange hash" not in fact and "SortMergeJoin" not in fact and "NestedLoop" not in fact


def test_no_query_uses_a_cross_join(tables):
    for name in ("clear_matrix", "country_series", "selection_aggregate", "quantile_breaks", "class_of", "month_calendar"):
        text = plan(registry.QUERIES[name](tables))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_top_k_is_not_a_full_sort(tables):
    assert "TakeOrderedAndProject" in plan(ranking.hotspots(tables.hexes))
    assert "TakeOrderedAndProject" not in plan(ranking.points_most_recent(tables.fact, tables.calendar, None))
    first_of_month = tables.fact.withColumn("detect_timestamp", F.concat("month", F.lit("-01 10:00")))
    capped = ranking.points_most_recent(first_of_month, tables.calendar, 10)
    # only one day is ranked; months and days before it are left out by filters on the facts
    assert plan(capped).count("TakeOrderedAndProject") == 1


def test_columns_are_pruned(tables):
    text = plan(tables.detections.groupBy("month").agg(F.count(F.lit(1))))
    assert "ReadSchema: struct<month:string>" in text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "cell" and df.count() > 0


def test_every_query_has_an_answer():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    rows, _, message = compare.compare(spark, con, name, SF)
    assert message is None
