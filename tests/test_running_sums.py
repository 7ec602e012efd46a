"""Selections from running sums against selections that add up their months."""

import random

import pytest
from pyspark.sql import functions as F

from fathomline.operators import selection
from fathomline.schema import COUNTERS
from fathomline.sources import files

MONTHS = [f"{y}-{m:02d}" for y in (2020, 2021, 2022) for m in range(1, 13) if (y, m) not in {(2020, 1), (2021, 4), (2021, 5)}]


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(3)
    keys = [(c, m) for c in "abcdefg" for m in [*MONTHS, "2021-04"] if r.random() < 0.3]
    rows = spark.createDataFrame([(c, m, *[r.randrange(9) for _ in COUNTERS]) for c, m in keys], f"cell string, month string, {' long, '.join(COUNTERS)} long")
    passes = spark.createDataFrame([(c, m, r.randrange(5)) for c in "cdefgh" for m in MONTHS if r.random() < 0.4], "cell string, month string, clear long")
    cells = spark.createDataFrame([(c,) for c in "abcdefghi"], "cell string")
    months = selection.month_calendar(spark.createDataFrame([(m,) for m in MONTHS], "month string")).where("idx >= 0")
    return rows, passes, cells, months


@pytest.fixture(scope="module")
def sums(spark, tables, tmp_path_factory):
    rows, passes, _, months = tables
    path = str(tmp_path_factory.mktemp("sums") / "by_month")
    files.write_by_month(selection.running_sums(rows, passes, months), path)
    return files.read_partitions(spark, path)


@pytest.mark.parametrize("first, last, season, boats", [
    (None, None, None, "all"), ("2020-06", "2021-07", None, "ais"), ("2021-04", "2022-02", "DJF", "ais_st"), ("2021-03", "2021-05", "MAM", "all"),
    ("2019-01", "2019-12", None, "all"), ("2020-01", "2020-02", "DJF", "all"), (None, "2021-04", "MAM", "ais"), ("2021-06", None, "SON", "all"),
    ("2022-05", "2021-02", None, "all"), ("2023-01", "2024-01", None, "all"), ("2022-12", "2022-12", "DJF", "ais")])
def test_a_range_is_the_difference_of_two_months(tables, sums, first, last, season, boats):
    rows, passes, cells, months = tables
    chosen = selection.select_months(months, first, last, season)
    want = selection.selection_aggregate(rows, passes, cells, chosen, boats)
    got = selection.selection_between(sums, cells, months, first, last, season, boats)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_only_two_partitions_and_the_columns_asked_for_are_read(tables, sums):
    got = selection.selection_between(sums, tables[2], tables[3], "2020-06", "2021-04", "JJA", "ais")
    text = got._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "month#" in scan and "IN (2020-05,2021-03)" in scan.replace("2021-03,2020-05", "2020-05,2021-03")
    assert "n_JJA" not in scan and "ais_DJF" not in scan and "ais_JJA" in scan


def test_a_new_month_needs_only_the_one_before(tables, sums):
    rows, passes, _, _ = tables
    for before, month in zip(MONTHS[-3:], MONTHS[-2:]):
        got = selection.next_sums(sums.where(F.col("month") == before), rows, passes, month)
        assert sorted(map(str, got.collect())) == sorted(map(str, sums.where(F.col("month") == month).select(*got.columns).collect()))


def test_nothing_in_nothing_out(tables):
    rows, passes, cells, months = tables
    empty = selection.running_sums(rows.limit(0), passes.limit(0), months)
    got = selection.selection_between(empty, cells, months, "2020-02", "2020-03").collect()
    assert {(r.on_meadow, r.density) for r in got} == {(0, None)} and len(got) == 9
    assert selection.selection_between(empty, cells, months.limit(0)).count() == 9
