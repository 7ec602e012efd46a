"""Counts, ranking, selections and checks on a small made-up coast."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS, Params
from fathomline.operators import checks, pressure, publish, ranking, selection

FACT = "on_meadow boolean, month string, cell string, country string, large boolean, ais_confident boolean, ais_stationary boolean, ais_moving boolean"
MONTHS = ["2022-12", "2023-01", "2023-04", "2023-06", "2023-07"]


@pytest.fixture(scope="module")
def rows():
    """Anchored vessels of a seeded season: five cells in two countries, one of them unknown to the cell table."""
    rng = random.Random(20)
    home = {"10_4": "ESP", "10_5": "ESP", "11_4": "FRA", "-3_7": "FRA", "99_9": "UNK"}
    out = []
    for _ in range(240):
        on = rng.random() < 0.7
        cell = rng.choice(sorted(home)) if on else None
        ship = rng.random() < 0.4
        still = ship and rng.random() < 0.5
        out.append((on, rng.choice([*MONTHS, "2019-05"]), cell, home.get(cell, "UNK"), rng.random() < 0.3, ship, still, ship and not still and rng.random() < 0.5))
    return out


@pytest.fixture(scope="module")
def fact(spark, rows):
    return spark.createDataFrame(rows, FACT).repartition(3).cache()


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.createDataFrame([(m,) for m in reversed(MONTHS)], "month string")


@pytest.fixture(scope="module")
def cells(spark):
    known = [("10_4", "ESP", 2.5), ("10_5", "ESP", 0.25), ("11_4", "FRA", 1.0), ("-3_7", "FRA", 0.5), ("0_0", "FRA", 0.75)]
    return spark.createDataFrame(known, "cell string, country string, meadow_km2 double")


OVERPASS = [("10_4", "2023-06", 4), ("10_4", "2023-06", 1), ("10_4", "2022-12", 2), ("11_4", "2023-07", 3), ("-3_7", "2023-07", 0), ("5_5", "2023-07", 9)]


@pytest.fixture(scope="module")
def overpass(spark):
    return spark.createDataFrame(OVERPASS, "h3_id string, month string, overpasses_cloud_under_20 int")


def tally(rows, key, *also):
    """Plain counts: per key the rows and, of them, those each condition holds for."""
    out = {}
    for r in rows:
        k = key(r)
        if k is None:
            continue
        old = out.setdefault(k, [0] * (1 + len(also)))
        old[0] += 1
        for i, c in enumerate(also):
            old[i + 1] += bool(c(r))
    return {k: tuple(v) for k, v in out.items()}


ON, MONTH, CELL, COUNTRY, LARGE, SHIP, STILL, MOVING = range(8)
KINDS = (lambda r: r[LARGE], lambda r: r[SHIP], lambda r: r[SHIP] and r[LARGE], lambda r: r[STILL], lambda r: r[STILL] and r[LARGE], lambda r: r[MOVING])


# ---------------------------------------------------------------------------------------------------------- counts
def test_monthly_cell_counts(fact, rows, cells, calendar):
    known = {r.cell for r in cells.collect()}
    want = tally(rows, lambda r: (r[CELL], r[MONTH]) if r[ON] and r[CELL] in known and r[MONTH] in MONTHS else None, *KINDS)
    got = {(r.cell, r.month): tuple(r)[2:] for r in pressure.hex_monthly(fact, cells, calendar).collect()}
    assert got == want and want


def test_monthly_ship_totals_add_up_and_keep_quiet_months(spark, fact, rows, cells, calendar):
    more = calendar.unionByName(spark.createDataFrame([("2024-02",)], "month string"))
    known = {r.cell for r in cells.collect()}
    want = tally(rows, lambda r: r[MONTH] if r[ON] and r[CELL] in known and r[MONTH] in MONTHS else None, *KINDS[1:])
    got = {r.month: tuple(r)[1:] for r in pressure.ais_monthly_totals(pressure.hex_monthly(fact, cells, more), more).collect()}
    assert got == {**{m: want[m][1:] for m in MONTHS}, "2024-02": (0,) * 5}


def test_totals_and_series_cover_the_calendar(fact, rows, calendar):
    every = tally(rows, lambda r: r[MONTH] if r[MONTH] in MONTHS else None, lambda r: r[ON], lambda r: r[ON] and r[LARGE])
    assert {r.month: tuple(r)[1:] for r in pressure.monthly_totals(fact, calendar).collect()} == every
    want = tally(rows, lambda r: (r[COUNTRY], r[MONTH]) if r[ON] and r[MONTH] in MONTHS else None, lambda r: r[LARGE])
    series = {(r.country, r.month): (r.anchored_on_meadow, r.large_on_meadow) for r in pressure.country_series(fact, calendar).collect()}
    assert len(series) == 3 * len(MONTHS) and {k: v for k, v in series.items() if v[0]} == want


def test_clear_overpasses_of_all_cells_and_months(cells, overpass, calendar):
    got = {(r.cell, r.month): r.clear for r in pressure.clear_matrix(cells, overpass, calendar).collect()}
    assert len(got) == 5 * len(MONTHS)
    assert {k: v for k, v in got.items() if v} == {("10_4", "2023-06"): 5, ("10_4", "2022-12"): 2, ("11_4", "2023-07"): 3}


def test_cells_with_their_seasons(fact, rows, cells, overpass, calendar):
    got = {r.cell: r for r in pressure.aggregate_hexes(fact, cells, overpass, calendar).collect()}
    count = tally(rows, lambda r: r[CELL] if r[ON] and r[MONTH] in MONTHS else None, lambda r: r[LARGE], lambda r: r[MONTH] in ("2022-12", "2023-01"), lambda r: r[MONTH] == "2023-04")
    assert set(got) == {r.cell for r in cells.collect()} | {"99_9"}
    for cell, (n, large, winter, spring) in count.items():
        r = got[cell]
        assert (r.on_meadow, r.large_on_meadow, r.DJF, r.MAM, r.JJA, r.SON) == (n, large, winter, spring, n - winter - spring, 0)
        months = Counter(x[MONTH] for x in rows if x[ON] and x[CELL] == cell and x[MONTH] in MONTHS)
        assert r.peak_month == max(months, key=lambda m: (months[m], m))
    assert (got["10_4"].clear_overpasses, got["10_4"].clear_JJA, got["10_4"].clear_DJF) == (7, 5, 2)
    assert got["10_4"].density == got["10_4"].on_meadow / 7
    assert got["10_5"].density is None and got["-3_7"].density is None  # none seen, and none clear
    assert (got["0_0"].on_meadow, got["0_0"].peak_month) == (0, None)
    assert (got["99_9"].country, got["99_9"].meadow_km2) == ("UNK", 0.0)


def test_density_of_single_cells(spark):
    df = spark.createDataFrame([(9, 6), (9, 0), (0, 6), (0, 0)], "boats int, clear int")
    assert [r[0] for r in df.select(pressure.density(F.col("boats"), F.col("clear"))).collect()] == [1.5, None, 0.0, None]


def test_rollup_has_every_grain_once(fact, rows):
    want = {}
    for grain, key in (("month", lambda r: (None, None, r[MONTH])), ("country_month", lambda r: (r[COUNTRY], None, r[MONTH])),
                       ("cell_month", lambda r: (None, r[CELL], r[MONTH])), ("cell", lambda r: (None, r[CELL], None))):
        want |= {(grain, *k): v for k, v in tally(rows, lambda r: key(r) if r[ON] else None, lambda r: r[LARGE]).items()}
    got = {(r.grain, r.country, r.cell, r.month): (r.on_meadow, r.large_on_meadow) for r in pressure.pressure_rollup(fact).collect()}
    assert got == want


def test_speed_bands_share_and_median(spark):
    speeds = {True: [0.5, 0.99, 1.0, 4.5, 5.0], False: [2.5, 7.0]}
    data = [(True, True, big, v) for big, vs in speeds.items() for v in vs] + [(True, False, True, 0.1), (False, True, True, 0.1), (True, True, False, None)]
    got = {(r.large, r.band): (r.n, round(r.share, 4), r.median_kn) for r in pressure.ais_speed_bands(
        spark.createDataFrame(data, "on_meadow boolean, ais_confident boolean, large boolean, ais_speed_kn double")).collect()}
    assert got == {(True, "below 1"): (2, 0.4, 1.0), (True, "1 to 5"): (2, 0.4, 1.0), (True, "5 and more"): (1, 0.2, 1.0),
                   (False, "1 to 5"): (1, 0.5, 4.75), (False, "5 and more"): (1, 0.5, 4.75)}


def test_ship_check_in_whole_percent(spark):
    names = [f"ais_{k}_on_meadow bigint" for k in ("matched", "stationary", "moving")]
    run = lambda n, *data: [tuple(r) for r in pressure.ais_check(spark.createDataFrame(data, ", ".join(names[:n]))).collect()]
    assert run(3, (30, 6, 9), (10, 4, 0)) == [(40, 10, 9, 21, 25, 23, 47)]
    assert run(3, (4, 9, 2)) == [(4, 4, 0, 0, 100, 0, 0)]  # more at rest than matched cannot be
    assert run(3, (0, 0, 0)) == []
    assert run(2, (8, 2)) == [(8, 2, None, None, 25, None, None)]


# --------------------------------------------------------------------------------------------------------- ranking
def test_busiest_cells_first(spark):
    h = spark.createDataFrame([("n", 12, None), ("w", 12, 0.5), ("s", 12, 0.5), ("e", 40, 0.1), ("quiet", 0, None)], "cell string, on_meadow int, density double")
    assert [r.cell for r in ranking.hotspots(h, 9).collect()] == ["e", "s", "w", "n"]
    assert [r.cell for r in ranking.hotspots(h, 2).collect()] == ["e", "s"]
    named = publish.number_hotspots(ranking.hotspots(h.withColumn("country", F.lit("ESP")), 3))
    assert {r.position: r.cell for r in named.collect()} == {1: "e", 2: "s", 3: "w"}


def test_unknown_country_closes_the_list(spark):
    s = spark.createDataFrame([("UNK", 70, 5), ("HRV", 20, 1), ("ALB", 31, 2), ("MNE", 0, 0)], "country string, anchored_on_meadow bigint, large_on_meadow bigint")
    assert [r.country for r in pressure.country_totals(s).collect()] == ["ALB", "HRV", "UNK"]


@pytest.mark.parametrize("seed", range(4))
def test_breaks_split_the_values_into_fifths(spark, seed):
    rng = random.Random(seed)
    given = [rng.lognormvariate(1, 1.2) for _ in range(400)] + [0.0, -1.0]
    values = [float(int(v) + 1) if seed % 2 else v for v in given if v > 0] + [0.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    found = ranking.quantile_breaks(df, "v", seed % 2 == 1).first().breaks
    positive = [v for v in values if v > 0]
    assert found == sorted(set(found)) and all(min(positive) < b <= max(positive) for b in found)
    if seed % 2 == 0:  # continuous values: rounding to two digits moves a share by little
        assert [round(sum(v < b for v in positive) / len(positive), 1) for b in found] == [0.2, 0.4, 0.6, 0.8]
    else:  # whole numbers: at most a fifth lies strictly below the first break, and so on
        assert all(b == int(b) for b in found)


def test_breaks_of_few_or_equal_values(spark):
    def run(*v):
        return ranking.quantile_breaks(spark.createDataFrame([(x,) for x in v], "v double"), "v", True).first().breaks
    assert run(None, 0.0) == [] and run(7.0) == [] and run(*[2.0] * 9) == []
    assert run(1.0, 2.0) == [2.0]


def test_classes_count_the_breaks_passed(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (0.4,), (0.5,), (7.9,), (8.0,), (100.0,)], "v double")
    b = spark.createDataFrame([([0.5, 3.0, 8.0],)], "breaks array<double>")
    assert [r["class"] for r in ranking.class_of(df, "v", b).collect()] == [-1, -1, -1, 0, 1, 2, 3, 3]


def test_positions_of_cells_and_months(spark, calendar):
    rng = random.Random(3)
    ids = list({f"{rng.randrange(-90, 90)}_{rng.randrange(-400, 400)}" for _ in range(700)})
    got = {r.cell: r.i for r in ranking.cell_index(spark.createDataFrame([(c,) for c in ids], "cell string")).collect()}
    assert [c for c, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(ids)
    rows = spark.createDataFrame([("b", "2023-04", 8), ("a", "2022-12", 6), ("a", "2031-01", 1)], "cell string, month string, n int")
    some = spark.createDataFrame([("b",), ("a",), ("c",)], "cell string")
    assert {tuple(r) for r in ranking.index_lookup(rows, some, calendar).collect()} == {(1, 2, 8), (0, 0, 6), (0, None, 1)}


@pytest.mark.parametrize("cap", [None, 1, 7, 60, 10_000])
def test_newest_points_by_the_cap(spark, calendar, cap):
    rng = random.Random(9)
    data = [(rng.random() < 0.8, m := rng.choice(MONTHS), f"{m}-{rng.randrange(1, 4):02d} 10:{rng.randrange(60):02d}", float(rng.randrange(9)), 40.0, f"s{i}") for i in range(150)]
    df = spark.createDataFrame(data, "on_meadow boolean, month string, detect_timestamp string, lon double, lat double, scene_id string")
    on = sorted((r for r in data if r[0]), key=lambda r: (r[3], r[5]))
    want = sorted(on, key=lambda r: r[2], reverse=True)[:cap]
    assert {r.scene_id for r in ranking.points_most_recent(df, calendar, cap).collect()} == {r[5] for r in want}


# ------------------------------------------------------------------------------------------------------ selections
def test_timeline_with_gaps(calendar, spark):
    cal = selection.month_calendar(calendar)
    got = {r.month: (r.c, r.idx) for r in cal.collect()}
    assert len(got) == 8 and got["2022-12"] == (0, 0) and got["2023-02"] == (2, -1) and got["2023-07"] == (7, 4)
    pick = lambda *a, **k: {r.month for r in selection.select_months(cal, *a, **k).collect()}
    assert pick() == set(MONTHS) and pick("2023-01", "2023-06") == set(MONTHS[1:4]) and pick(season="DJF") == set(MONTHS[:2])
    assert {r.season for r in selection.available_seasons(cal, "2023-01", "2023-05").collect()} == {"DJF", "MAM"}
    assert {(r.year, r["first"], r["last"]) for r in selection.year_ranges(cal).collect()} == {("2022", 0, 0), ("2023", 1, 7)}
    assert selection.month_calendar(calendar.where("false")).count() == 0


def test_a_season_is_counted_alike_both_ways(fact, rows, cells, overpass, calendar):
    monthly, clear = pressure.hex_monthly(fact, cells, calendar), pressure.clear_months(overpass, calendar)
    summer = selection.select_months(selection.month_calendar(calendar), season="JJA")
    got = {r.cell: tuple(r)[1:] for r in selection.selection_aggregate(monthly, clear, cells, summer).collect()}
    known = pressure.aggregate_hexes(fact, cells, overpass, calendar).join(cells.select("cell"), "cell", "left_semi")
    assert got == {r.cell: tuple(r)[1:] for r in selection.season_fallback(known, "JJA").collect()}
    ships = tally(rows, lambda r: r[CELL] if r[ON] and r[SHIP] and r[MONTH] in ("2023-06", "2023-07") else None, lambda r: r[LARGE])
    of_ships = {r.cell: (r.on_meadow, r.large_on_meadow) for r in selection.selection_aggregate(monthly, clear, cells, summer, "ais").collect()}
    assert of_ships == {c: ships.get(c, (0, 0)) for c in of_ships} and len(of_ships) == 5
    older = monthly.select("cell", "month", "n", "large")
    assert got == {r.cell: tuple(r)[1:] for r in selection.selection_aggregate(older, clear, cells, summer, "ais_st").collect()}


def test_points_without_a_class_are_kept_for_every_class(spark):
    old = spark.createDataFrame([(0, 30.0), (1, 9.0), (1, None)], "m int, length_m double")
    assert selection.point_filter(old, None, 24.0, boats="ais_st").count() == 3
    assert selection.point_filter(old, None, 24.0, large=False, boats="ais").count() == 1


# ---------------------------------------------------------------------------------------------- publishing, checks
POINT = ("on_meadow boolean, month string, detect_timestamp string, scene_id string, lon double, lat double, length_m_inferred double, country string, mmsi string, "
         "ais_matched boolean, matching_confidence double, ais_confident boolean, ais_stationary boolean, ais_speed_kn double, ais_length_m double")


def published(spark, calendar, **ships):
    mids = spark.createDataFrame([("224", "ES")], "mid string, iso2 string")
    data = [(True, "2023-06", "2023-06-14 10:41", k, 2.6123449, 39.5, 21.26, "ESP", *v) for k, v in ships.items()]
    return publish.publish_points(spark.createDataFrame(data, POINT), calendar, mids, DEFAULTS)


def test_points_tell_of_a_boat_what_is_certain(spark, calendar):
    out = published(spark, calendar, none=(None, False, 0.7, False, False, None, 18.0), weak=("224000111", True, 0.678, False, False, 0.3, 18.0),
                    unsaid=("224000112", True, None, False, False, 0.3, 18.0), under_way=("224000113", True, 0.918, True, False, 2.39, 18.0),
                    at_rest=("224000114", True, 0.93, True, True, 0.75, 22.6))
    got = {(r.ais_class, r.ais_conf, r.ais_speed_kn, r.ais_length_m, r.ais_flag) for r in out.collect()}
    assert got == {(0, None, None, None, None), (1, 0.67, None, None, None), (1, None, None, None, None), (2, 0.91, 2.3, 20, "ES"), (3, 0.93, 0.7, 25, "ES")}
    assert "mmsi" not in out.columns
    first = out.first()
    assert (first.lon, first.m, first.length_m, first.country) == (2.61234, 3, 21.3, "ESP")
    checks.enforce(checks.check_points(out, calendar, DEFAULTS))


def broken(df):
    return {r.rule for r in df.where("violations > 0").collect()}


PUB = "ais_class int, ais_conf double, ais_speed_kn double, ais_length_m bigint, ais_flag string, m int"
FAULTY = [
    ("class is 0..3", (9, 0.95, None, None, None, 2)), ("no confidence without a match", (0, 0.95, None, None, None, 2)),
    ("confidence of a confident match", (3, None, 0.5, 20, "ES", 2)), ("vessel values only for a confident match", (1, 0.5, 0.4, None, None, 2)),
    ("vessel values only for a confident match", (0, None, None, 20, None, 2)), ("vessel values only for a confident match", (1, 0.5, None, None, "ES", 2)),
    ("length in steps", (3, 0.95, 0.5, 21, "ES", 2)), ("month in range", (0, None, None, None, None, 5)), ("month in range", (0, None, None, None, None, -1))]


@pytest.mark.parametrize(("rule", "row"), FAULTY)
def test_each_rule_for_points_finds_its_fault(spark, calendar, rule, row):
    sound = (3, 0.95, 0.5, 20, "ES", 4)
    found = checks.check_points(spark.createDataFrame([sound, row, sound], PUB), calendar, DEFAULTS)
    assert broken(found) == {rule}


def test_row_limits_come_from_the_parameters(spark, calendar):
    three = spark.createDataFrame([(0, None, None, None, None, 0)] * 3, PUB)
    assert broken(checks.check_points(three, calendar, Params(points_cap=2))) == {"row cap"}
    assert broken(checks.check_points(three, calendar, DEFAULTS)) == set()
    hot = spark.createDataFrame([("a", 1.0, 1.0, "ESP", None, n, 0, 1.0, "2023-06", k + 1) for k, n in enumerate((9, 4, 6))],
                                "cell string, lon double, lat double, country string, place string, on_meadow int, large_on_meadow int, density double, peak_month string, position int")
    assert broken(checks.check_hotspots(hot, Params(hotspots_n=2))) == {"row cap", "descending"}


def test_ship_numbers_are_never_published(spark, calendar):
    with pytest.raises(checks.ContractError, match="MMSI"):
        checks.check_points(spark.createDataFrame([("224000111",)], "mmsi string"), calendar, DEFAULTS)


@pytest.mark.parametrize(("change", "rules"), [
    ({"ais": 12}, {"stationary <= AIS <= all"}), ({"ais_st": 8}, {"stationary <= AIS <= all"}),
    ({"ais_large": 5}, {"large: stationary <= AIS <= all"}), ({"ais_st_large": 4}, {"large: stationary <= AIS <= all"}),
    ({"large": -1, "ais_large": -2, "ais_st_large": -3}, {"0 <= large <= all", "0 <= AIS large <= AIS", "0 <= stationary large <= stationary"})])
def test_counters_must_nest(spark, change, rules):
    sound = {"cell": "7_7", "month": "2023-06", "n": 11, "large": 4, "ais": 7, "ais_large": 3, "ais_st": 5, "ais_st_large": 2, "ais_mv": 1}
    one = spark.createDataFrame([("2023-06",)], "month string")
    hexes = spark.createDataFrame([("7_7", 11)], "cell string, on_meadow bigint")
    clear = spark.createDataFrame([("7_7", "2023-06", 0)], "cell string, month string, clear bigint")
    assert broken(checks.check_hex_monthly(spark.createDataFrame([sound]), clear, hexes, one)) == set()
    bad = checks.check_hex_monthly(spark.createDataFrame([{**sound, **change}]), clear, hexes, one)
    assert broken(bad) == rules
    with pytest.raises(checks.ContractError, match="hex_monthly"):
        checks.enforce(bad)
