"""Row rules: what counts as an anchored vessel, which version of a detection stays, how values are published."""

import pytest
from pyspark.sql import functions as F

from fathomline.config import DEFAULTS, Params
from fathomline.functions import predicates, scalars
from fathomline.operators import detections, publish
from fathomline.schema import DETECTIONS, conform, with_optional

#: a detection that every rule lets through, with a vessel at rest off Palma
BASE = {"scene_id": "A", "lat": 39.52, "lon": 2.61, "detect_timestamp": "2023-06-14 10:41:07", "speed_kn_inferred": 0.35,
        "presence_score": 0.62, "nonvessel_score": 0.4, "cloud_score": 0.21, "likely_infrastructure": False, "potential_ice": False,
        "length_m_inferred": 17.5}


def table(spark, **cases):
    """One detection per case; a case gives the values that differ. The scene is the case's name."""
    rows = [{**BASE, "scene_id": name, **change} for name, change in cases.items()]
    text = spark.createDataFrame([{k: None if v is None else str(v) for k, v in r.items()} for r in rows],
                                 ", ".join(f"{k} string" for k in dict.fromkeys(k for r in rows for k in r)))
    return conform(with_optional(text, *DETECTIONS.fields), DETECTIONS)


def passing(df, rule):
    return {r.scene_id for r in df.where(rule).collect()}


def values(spark, kind, given, f):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(given)], f"n int, v {kind}")
    return [r.out for r in df.select("n", f(F.col("v")).alias("out")).orderBy("n").collect()]


# ----------------------------------------------------------------------------------------------------------- rules
@pytest.mark.parametrize(("column", "inside", "outside"), [
    ("presence_score", 0.31, 0.29), ("nonvessel_score", 0.94, 0.96), ("cloud_score", 0.49, 0.51)])
def test_a_score_counts_on_its_own_side_of_the_limit(spark, column, inside, outside):
    df = table(spark, near={column: inside}, past={column: outside})
    assert passing(df, predicates.quality(df, DEFAULTS)) == {"near"}


def test_limits_themselves_are_allowed(spark):
    p = Params(presence_score_min=0.25, nonvessel_score_max=0.75, cloud_score_max=0.125)
    df = table(spark, edge={"presence_score": 0.25, "nonvessel_score": 0.75, "cloud_score": 0.125})
    assert passing(df, predicates.quality(df, p)) == {"edge"}


def test_only_presence_has_to_be_known(spark):
    unknown = {c: None for c in ("nonvessel_score", "cloud_score", "likely_infrastructure", "potential_ice")}
    df = table(spark, bare=unknown, blind={"presence_score": None})
    assert passing(df, predicates.quality(df, DEFAULTS)) == {"bare"}


def test_flags_drop_and_absent_flag_columns_do_not(spark):
    df = table(spark, rig={"likely_infrastructure": True}, floe={"potential_ice": True}, boat={})
    assert passing(df, predicates.quality(df, DEFAULTS)) == {"boat"}
    assert passing(df, predicates.quality(df, Params(exclude_ice=False))) == {"boat", "floe"}
    narrow = df.drop("potential_ice")
    assert passing(narrow, predicates.quality(narrow, DEFAULTS)) == {"boat", "floe"}


def test_rules_set_to_none_are_off(spark):
    p = Params(presence_score_min=None, cloud_score_max=None, nonvessel_score_max=None)
    df = table(spark, poor={"presence_score": 0.0, "cloud_score": 1.0, "nonvessel_score": 1.0}, blank={"presence_score": None})
    assert passing(df, predicates.quality(df, p)) == {"poor", "blank"}


def test_a_least_length_drops_short_and_unmeasured_vessels(spark):
    df = table(spark, long={"length_m_inferred": 12.25}, short={"length_m_inferred": 12.0}, unmeasured={"length_m_inferred": None})
    assert passing(df, predicates.quality(df, Params(length_m_min=12.25))) == {"long"}
    assert len(passing(df, predicates.quality(df, DEFAULTS))) == 3


def test_a_vessel_at_the_speed_limit_is_under_way(spark):
    df = table(spark, rest={"speed_kn_inferred": 0.0}, slow={"speed_kn_inferred": 0.75}, limit={"speed_kn_inferred": 1.0}, unknown={"speed_kn_inferred": None})
    assert passing(df, predicates.anchored(df, DEFAULTS)) == {"rest", "slow"}


def test_corners_of_boxes_belong_to_them(spark):
    p = Params(bbox=(-2.0, 50.0, 2.0, 52.0), exclude_boxes=((-2.0, 51.5, -1.0, 52.0), (1.5, 50.0, 2.0, 50.25)))
    spots = {"west edge": (-2.0, 50.5, True), "north east corner": (2.0, 52.0, True), "outside": (2.001, 51.0, False), "cut corner": (-1.0, 51.5, False),
             "second cut": (1.75, 50.1, False), "beside a cut": (1.49, 50.1, True), "nowhere": (None, 51.0, False)}
    df = spark.createDataFrame([(k, x, y) for k, (x, y, _) in spots.items()], "k string, lon double, lat double")
    got = {r.k: r.inside for r in df.select("k", predicates.in_region(F.col("lon"), F.col("lat"), p).alias("inside")).collect()}
    assert got == {k: v[2] for k, v in spots.items()}


# -------------------------------------------------------------------------------------------------------- versions
def versions(spark, **cases):
    """Scenes left by the dedupe."""
    return {r.scene_id for r in detections.dedupe_detections(table(spark, **cases)).collect()}


def test_versions_share_a_place_to_four_decimals_and_a_minute(spark):
    assert len(versions(spark, one={"lat": 39.52004}, two={"lat": 39.51998, "detect_timestamp": "2023-06-14 10:41:58"})) == 1
    assert len(versions(spark, one={}, other_minute={"detect_timestamp": "2023-06-14 10:42:07"}, other_place={"lon": 2.6103})) == 3


def test_a_known_ship_beats_any_confidence(spark):
    assert versions(spark, ship={"mmsi": "224000111", "matching_confidence": 0.1}, blank={"mmsi": "   ", "matching_confidence": 0.99}, none={"matching_confidence": 1.0}) == {"ship"}


def test_among_equals_the_higher_confidence_stays_and_none_is_lowest(spark):
    assert versions(spark, a={"mmsi": "224000111", "matching_confidence": 0.4}, b={"mmsi": "224000112", "matching_confidence": 0.6}, c={"mmsi": "224000113"}) == {"b"}
    assert versions(spark, a={}, b={"matching_confidence": 0.05}) == {"b"}


def test_a_poor_version_that_wins_takes_its_detection_along(spark):
    df = table(spark, clear={}, cloudy={"cloud_score": 0.77, "mmsi": "224000111"}, elsewhere={"lon": 2.7})
    assert {r.scene_id for r in detections.anchored_in_region(df, DEFAULTS).collect()} == {"elsewhere"}


# -------------------------------------------------------------------------------------------------------------- AIS
def judged(spark, **cases):
    """(matched, confident, stationary, moving, mean speed) per case of (mmsi, confidence, speed before, speed after)."""
    names = ("mmsi", "matching_confidence", "ais_speed_kn_before", "ais_speed_kn_after")
    df = predicates.with_ais(table(spark, **{k: dict(zip(names, v)) for k, v in cases.items()}), DEFAULTS)
    return {r.scene_id: (r.ais_matched, r.ais_confident, r.ais_stationary, r.ais_moving, None if r.ais_speed_kn is None else round(r.ais_speed_kn, 4)) for r in df.collect()}


def test_a_ship_is_judged_by_its_mean_speed(spark):
    got = judged(spark, still=("224000111", 0.92, 0.5, 1.25), under_way=("224000112", 0.92, 0.5, 1.75), half_known=("224000113", 0.92, 0.5, None))
    assert got["still"] == (True, True, True, False, 0.875)
    assert got["under_way"] == (True, True, False, True, 1.125)
    assert got["half_known"] == (True, True, False, False, None)


def test_uncertain_matches_are_neither_at_rest_nor_moving(spark):
    got = judged(spark, weak=("224000111", 0.75, 0.0, 0.0), unsaid=("224000112", None, 0.0, 0.0), nobody=(None, 0.99, 0.0, 0.0), spaces=(" \t ", 0.99, 0.0, 0.0))
    assert {k: v[:4] for k, v in got.items()} == {
        "weak": (True, False, False, False), "unsaid": (True, False, False, False), "nobody": (False,) * 4, "spaces": (False,) * 4}


def test_limits_hold_for_values_stored_in_32_bits(spark):
    # 0.9 and 0.7 + 1.3 are not exact in 32 bits; the limits mean their decimal values
    got = judged(spark, edge=("224000111", 0.9, 0.7, 1.3), below=("224000112", 0.9, 0.7, 1.2))
    assert got["edge"][1:4] == (True, False, True) and got["below"][1:4] == (True, True, False)


def test_without_ship_columns_nothing_is_matched(spark):
    bare = with_optional(spark.createDataFrame([("x",)], "scene_id string"), *DETECTIONS.fields)
    r = predicates.with_ais(bare, DEFAULTS).first()
    assert [r.ais_matched, r.ais_confident, r.ais_stationary, r.ais_moving] == [False] * 4


# ---------------------------------------------------------------------------------------------------------- values
def test_text_that_is_no_value_is_missing(spark):
    r = table(spark, odd={"cloud_score": "NaN", "presence_score": "high", "likely_infrastructure": "maybe", "potential_ice": "TRUE"}).first()
    assert (r.cloud_score, r.presence_score, r.likely_infrastructure, r.potential_ice) == (None, None, None, True)


def test_seasons_of_all_months(spark):
    given = [f"1999-{m:02d}" for m in range(1, 13)]
    assert values(spark, "string", given, scalars.season_of) == ["DJF"] * 2 + ["MAM"] * 3 + ["JJA"] * 3 + ["SON"] * 3 + ["DJF"]


def test_published_decimals(spark):
    assert values(spark, "double", [41.23456789, -0.000004, float("nan"), None], lambda c: scalars.num(c, 5)) == [41.23457, -0.0, None, None]
    assert values(spark, "double", [3.5, 4.5, 4.51], lambda c: scalars.num(c, 0)) == [4, 4, 5]


def test_lengths_go_to_the_nearest_step(spark):
    assert values(spark, "float", [61.0, 62.4, 63.0, 22.5, 1.0, None, float("nan")], lambda c: scalars.step_round(c, 5)) == [60, 60, 65, 20, 0, None, None]


def test_cut_decimals_never_round_up_and_respect_32_bits(spark):
    assert values(spark, "double", [0.999, 0.1289, 0.5, None], lambda c: scalars.floor_nd(c, 2)) == [0.99, 0.12, 0.5, None]
    # the 32-bit values of 0.29 and 0.58 lie a little off the decimals they stand for
    assert values(spark, "float", [0.29, 0.58, float("nan")], lambda c: scalars.floor_nd(c, 2)) == [0.29, 0.58, None]


def test_flags_of_ship_numbers(spark):
    mids = spark.createDataFrame([("224", "ES"), ("655", "MW"), ("111", "??")], "mid string, iso2 string")
    cases = {"224000111": "ES", "655123456 ": "MW", "111123456": None, "22400011": None, "2240001112": None, "224O00111": None, "777123456": None, None: None}
    df = spark.createDataFrame([(m,) for m in cases], "mmsi string")
    assert {r.mmsi: r.flag for r in publish.flag_lookup(df, mids).collect()} == cases


def test_labels_and_months_of_periods(spark):
    assert values(spark, "string", ["1997-03", "never", None], scalars.month_label) == ["Mar 1997", "never", None]
    year, month = values(spark, "string", ["2021", "202110"], scalars.period_months)
    assert (year[0], year[-1], len(year), month) == ("2021-01", "2021-12", 12, ["2021-10"])


def test_country_names_come_from_the_data_first(spark):
    df = spark.createDataFrame([("GRC", "Hellas"), ("GRC", None), ("QQQ", None), (None, "x")], "iso string, name string")
    got = [r[0] for r in df.select(scalars.country_display(F.col("iso"), F.col("name"))).collect()]
    assert got[:3] == ["Hellas", "Greece", "QQQ"]


def test_vessel_values_are_decoded_for_confident_classes_only(spark):
    df = spark.createDataFrame([(k, 0.91, 1.5, 40, "ES") for k in range(4)] + [(None, 0.91, 1.5, 40, "ES")], "k int, conf double, kn double, len int, flag string")
    got = {r[0]: tuple(r)[1:] for r in df.select("k", *scalars.decode_ais(*(F.col(c) for c in ("k", "conf", "kn", "len", "flag")))).collect()}
    vessel = {k: v[-3:] for k, v in got.items()}
    assert vessel[2] == vessel[3] == (1.5, 40, "ES")
    assert vessel[0] == vessel[1] == vessel[None] == (None, None, None)


def test_parameters_from_a_mapping():
    p = Params.from_mapping({"bbox": [0, 1, 2, 3], "exclude_boxes": [[0, 1, 1, 2]], "points_cap": 10})
    assert (p.bbox, p.exclude_boxes, p.points_cap, p.buffer_m) == ((0, 1, 2, 3), ((0, 1, 1, 2),), 10, DEFAULTS.buffer_m)
    with pytest.raises(KeyError, match="colour"):
        Params.from_mapping({"colour": "blue"})
