"""Hand-made rows with known results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lapframe import config
from lapframe.functions import geo, messages, text, times
from lapframe.operators import clean, evaluate, features, folds, geometry, joins, ordered, quantiles
from lapframe.schema import LIVE_MESSAGE, nan_to_null
from lapframe.streaming.live import DEFAULTS


def values(df, column):
    return [r[column] for r in df.collect()]


def test_lap_time_limits_are_inclusive(spark):
    rows = [(2024, 1, 1, i, t) for i, t in enumerate([39.9, 40.0, 300.0, 300.1, None])]
    df = spark.createDataFrame(
        rows, "season int, race_round int, driver_id int, lap_number int, lap_time double"
    )
    assert sorted(values(clean.clean_laps(df), "lap_time")) == [40.0, 300.0]


def test_pit_filter_keeps_null_and_the_limit(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, i, 90.0, p) for i, p in enumerate([None, 0.0, 0.01, 0.02])],
        "season int, race_round int, driver_id int, lap_number int, lap_time double, PitDuration double",
    )
    assert clean.clean_laps(df, pit_column="PitDuration").count() == 3
    assert clean.clean_laps(df, pit_column="not_there").count() == 4


def test_missing_required_column_is_named(spark):
    with pytest.raises(ValueError, match="lap_time"):
        clean.clean_laps(spark.createDataFrame([(1,)], "season int"), required=["season", "lap_time"])


def test_boolean_words(spark):
    df = spark.createDataFrame([("True", "a"), ("Maybe", "b"), (None, "a"), ("1", "b")], "x string, y string")
    out = clean.coerce_booleans(df)
    assert values(out, "x") == [1.0, None, None, None]
    assert values(out, "y") == ["a", "b", "a", "b"]


def test_all_null_columns_go_before_the_fill(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    out = clean.numeric_frame(clean.drop_all_null(df))
    assert out.columns == ["b"] and values(out, "b") == [1.0, 0.0]


def test_lags_do_not_leak_across_drivers(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, 9.0), (1, 1, 1, 2, 8.0), (1, 1, 1, 4, 7.0), (1, 1, 2, 1, 5.0)],
        "season int, race_round int, driver_id int, lap_number int, lap_time double",
    )
    out = features.lag_features(df, config.DRIVER_RACE_KEYS, ["lap_number"], {"lap_time": [1], "none": [1]})
    got = {(r.driver_id, r.lap_number): r.lap_time_lag1 for r in out.collect()}
    assert got == {(1, 1): None, (1, 2): 9.0, (1, 4): 8.0, (2, 1): None}
    filled = features.lag_features(df, config.DRIVER_RACE_KEYS, ["lap_number"], {"lap_time": [1]}, fill=0.0)
    assert sorted(values(filled, "lap_time_lag1")) == [0.0, 0.0, 8.0, 9.0]


def test_flag_decoding(spark):
    df = spark.createDataFrame(
        [(0, 0, 0, "x"), (0, 1, 1, "y"), (None, None, 1, "z")],
        "Compound_A int, Compound_B int, Compound_C int, Compound_type string",
    )
    assert values(features.with_compound(df), "compound") == ["A", "B", "C"]
    known = df.select(features.text_or_flags(df, [], "Compound_", "UNKNOWN").alias("c"))
    assert values(known, "c") == ["UNKNOWN", "B", "C"]
    assert values(features.with_team(df), "TeamText") == [None] * 3


def test_elevation_difference_is_zero_beside_null(spark):
    df = spark.createDataFrame(
        [("t", 0.0, 1.0), ("t", 10.0, None), ("t", 20.0, 4.0)],
        "track string, distance_m double, elevation_m double",
    )
    out = geometry.elevation_deltas(df)
    assert values(out, "elev_delta_m") == [0.0, 0.0, 0.0]
    summary = geometry.elevation_summary(out).first()
    assert (summary.total_elev_change, summary.total_up_m, summary.total_down_m) == (3.0, 0.0, 0.0)


def test_corner_spacing(spark):
    apexes = spark.createDataFrame([("t", "b", 5.0), ("t", "a", 3.0)], "track string, corner string, dist_m double")
    totals = spark.createDataFrame([("t", 9.0)], "track string, total_m double")
    out = geometry.corner_spacing(apexes, totals).orderBy("corner_no")
    assert values(out, "spacing_m") == [3.0, 2.0]
    assert values(out, "final_straight_m") == [None, 4.0]


def test_corner_elevation_change(spark):
    df = spark.createDataFrame(
        [("t", "a", 1.0, 10.0), ("t", "b", 2.0, 14.0), ("t", "c", 3.0, 11.0)],
        "track string, corner string, dist_m double, elevation_m double",
    )
    out = geometry.corner_elevation_change(df).orderBy("dist_m")
    assert values(out, "elev_change_m") == [4.0, -3.0, None]


def test_interpolation_clamps(spark):
    profile = spark.createDataFrame([("t", float(d), 10.0 * d) for d in (0, 1, 2)], "track string, d double, e double")
    spots = spark.createDataFrame([("t", -1.0), ("t", 0.5), ("t", 9.0)], "track string, at double")
    out = geometry.interpolate(spots, profile, "at", "d", ["e"]).orderBy("at")
    assert values(out, "e") == [0.0, 5.0, 20.0]


def test_circumradius_and_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0, 2.0, 0.0), (0.0, 0.0, 1.0, 1.0, 2.0, 2.0)], list("abcdef"))
    got = values(df.select(geo.circumradius(*[F.col(c) for c in "abcdef"]).alias("r")), "r")
    assert got[0] == pytest.approx(1.0) and got[1] is None
    here = [F.lit(51.5), F.lit(-0.1)]
    assert df.select(geo.haversine(*here, *here).alias("h")).first().h == 0.0
    quarter = df.select(geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("h")).first().h
    assert quarter == pytest.approx(math.pi / 2 * 6371000.0)


def test_residual_bins(spark):
    df = spark.createDataFrame([(-21.0,), (-20.0,), (19.999,), (20.0,), (20.1,)], "error double")
    got = {r.bin: r.n for r in evaluate.histogram(df, "error", -20, 20, 80).collect()}
    assert got == {1: 1, 80: 2}


def test_baseline_fallback(spark):
    laps = spark.createDataFrame([(1, 9)], "season int, race_round int")
    known = spark.createDataFrame([(1, i, b) for i, b in enumerate([1.0, 2.0, 10.0, 11.0])], "season int, race_round int, baseline double")
    assert joins.with_baseline(laps, known, config.RACE_KEYS).first().baseline == 6.0
    assert joins.with_baseline(laps, known.limit(0), config.RACE_KEYS).first().baseline == 0.0


def test_as_of(spark):
    left = spark.createDataFrame([(1, 1), (1, 5), (2, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 0, "a"), (1, 4, "b"), (1, 6, "c")], "k int, rt int, v string")
    out = joins.as_of(left, right, ["k"], "t", "rt", ["v"])
    assert {(r.k, r.t): r.v for r in out.collect()} == {(1, 1): "a", (1, 5): "b", (2, 5): None}


def test_as_of_keeps_a_match_with_null(spark):
    left = spark.createDataFrame([(1, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 3, 7), (1, 4, None)], "k int, rt int, v int")
    row = joins.as_of(left, right, ["k"], "t", "rt", ["rt", "v"]).first()
    assert (row.rt, row.v) == (4, None)


def test_as_of_ignores_null_keys_and_times(spark):
    left = spark.createDataFrame([(None, 5), (1, None), (1, 5)], "k int, t int")
    right = spark.createDataFrame([(None, 1, "a"), (1, None, "b"), (1, 2, "c")], "k int, rt int, v string")
    out = joins.as_of(left, right, ["k"], "t", "rt", ["v"])
    assert {(r.k, r.t): r.v for r in out.collect()} == {(None, 5): None, (1, None): None, (1, 5): "c"}


def test_sources_agree_before_a_union(spark):
    first = spark.sql("select 1 DriverNumber, interval '1' minute + interval '2.5' second LapTime")
    keep = ["driver_id", "lap_time", "grand_prix"]
    names = {"DriverNumber": "driver_id", "LapTime": "lap_time"}
    one = clean.normalize(first, names, keep, ["driver_id"], {"grand_prix": "a"})
    two = clean.normalize(
        spark.createDataFrame([("7", 80.0), ("x", 81.0)], "DriverNumber string, LapTime double"),
        names, keep, ["driver_id"], {"grand_prix": "b"},
    )
    got = [tuple(r) for r in one.unionByName(two).orderBy("lap_time").collect()]
    assert got == [(1, 62.5, "a"), (7, 80.0, "b"), (None, 81.0, "b")]


def test_lap_interval_ends(spark):
    samples = spark.createDataFrame([(1, 5), (1, 12), (1, 25)], "k int, t int")
    laps = spark.createDataFrame([(1, 0, 10, "a"), (1, 12, 20, "b")], "k int, s int, e int, lap string")
    out = joins.lap_at(samples, laps, ["k"], "t", "s", "e", ["lap"])
    assert {r.t: r.lap for r in out.collect()} == {5: "a", 12: "b", 25: None}


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    made, levels = features.one_hot(df, ["c", "absent"])
    assert levels == {"c": ["x", "y"]} and list(made) == ["c_x", "c_y"]
    rows = [tuple(r) for r in df.select(*[e.alias(n) for n, e in made.items()]).collect()]
    assert rows == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]
    # More levels than fit wide columns go to the sparse encoder, and to rows.
    assert features.category_levels(df, ["c"], wide_levels=1) == ({}, ["c"])
    long = features.one_hot_long(df.withColumn("k", F.lit(1)), ["k"], ["c", "absent"])
    assert sorted(tuple(r) for r in long.collect()) == [(1, "c", "x"), (1, "c", "y")]


def test_bands_without_stored_quantiles(spark):
    row = evaluate.with_band(spark.createDataFrame([(90.0,)], "pred_lap_time double")).first()
    assert (row.pred_low, row.pred_high) == (89.0, 91.0)


def test_text(spark):
    one = spark.range(1)
    assert one.select(text.slug(F.lit(" Emilia-Romagna G.P. ")).alias("s")).first().s == "emilia_romagna_gp"
    years = spark.createDataFrame([("2019-2021",), ("2020",)], "y string")
    assert values(years.select(text.first_int(F.col("y")).alias("n")), "n") == [2019, 2020]
    lat, lon = text.lat_lon(F.lit("43.4, 39.9"))
    assert tuple(one.select(lat, lon).first()) == (43.4, 39.9)


def test_message_defaults(spark):
    good = ["{}", '{"driver_id": 7, "tire_temp_avg": null}', '{"driver_id": 8, "tire_temp_avg": NaN, "tire_temp_std": 2}']
    df = spark.createDataFrame([(t,) for t in good], "value string")
    out = df.select(*messages.decode_with_defaults(F.col("value"), LIVE_MESSAGE, DEFAULTS))
    assert [tuple(r) for r in out.collect()] == [(0, 0.0, 0.0), (7, 0.0, 0.0), (8, 0.0, 2.0)]


def test_malformed_messages_never_become_defaults(spark):
    bad = ["not json", '{"driver_id": "x"}', None, ""]
    df = spark.createDataFrame([(t,) for t in ["{}", *bad]], "value string")
    aside = df.select(*messages.decode_with_defaults(F.col("value"), LIVE_MESSAGE, DEFAULTS, "bad")).collect()
    assert tuple(aside[0]) == (0, 0.0, 0.0, None)
    assert [tuple(r) for r in aside[1:]] == [(None, None, None, t or "") for t in bad]
    for text in bad:
        one = spark.createDataFrame([(text,)], "value string")
        with pytest.raises(Exception, match="malformed message"):
            one.select(*messages.decode_with_defaults(F.col("value"), LIVE_MESSAGE, DEFAULTS)).collect()


def test_keys_that_are_no_numbers_fail_when_asked(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "driver_id string")
    with pytest.raises(Exception, match="driver_id is no whole number: x"):
        clean.normalize(df, {}, ["driver_id"], ["driver_id"], strict=True).collect()
    kept = clean.normalize(df.where("driver_id is null or driver_id <> 'x'"), {}, ["driver_id"], ["driver_id"], strict=True)
    assert {r.driver_id for r in kept.collect()} == {7, None}


def test_a_vertex_without_coordinates_loses_no_corner(spark):
    points = spark.createDataFrame([("a", 0, 0.0, 0.0, 0.0), ("a", 1, None, None, None), ("a", 2, 5.0, 0.0, 5.0)], "track string, idx int, x double, y double, dist_m double")
    apex = spark.createDataFrame([("a", 4.0, 0.0, None, None)], "track string, c1_x double, c1_y double, c2_x double, c2_y double")
    found = geometry.nearest_vertex(points, apex, ["c1", "c2"]).collect()
    assert [(r.corner, r.idx, r.gap_m) for r in found] == [("c1", 2, 1.0)]


@pytest.mark.parametrize("limit", [7, 97, 1000])
def test_a_segment_begins_where_the_one_before_ends(spark, small_groups, limit):
    rows = [("t", i, 0.01 * (i * 37 % 101) / 101, 0.01 * (i * 53 % 97) / 97) for i in range(400)]
    points = spark.createDataFrame(rows, "track string, idx int, lon double, lat double")
    small_groups(limit)
    got = geometry.sphere_segments(points).orderBy("idx").collect()
    assert [r.from_m for r in got[1:]] == [r.dist_m for r in got[:-1]] and got[0].from_m == 0.0
    marks = geometry.resample(geometry.sphere_segments(points), 10.0).orderBy("sample_m").collect()
    assert [r.sample_m for r in marks[:-1]] == [10.0 * k for k in range(len(marks) - 1)]


def test_durations(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 0, 1, 500000))], "a timestamp_ntz, b timestamp_ntz"
    )
    row = df.select(
        times.seconds_between(F.col("a"), F.col("b")).alias("s"),
        times.interval_seconds(F.col("b") - F.col("a")).alias("i"),
    ).first()
    assert (row.s, row.i) == (86401.5, 86401.5)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, n int")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_folds_two_of_three_groups(spark):
    sizes = {1: 5, 2: 4, 3: 3}
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g int")
    got = {r.g: r.fold for r in folds.group_folds(df, ["g"], 2).collect()}
    loads = [sum(sizes[g] for g, f in got.items() if f == k) for k in range(2)]
    assert sorted(loads) == [5, 7]


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantiles.percentiles(empty, [], "x", [0.5], "p").first().p is None


def test_row_numbers(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9)], "k int, v int")
    got = {(r.k, r.v): r.n for r in ordered.row_numbers(df, ["k"], ["v"], "n").collect()}
    assert got == {(1, 2): 1, (1, 3): 2, (2, 9): 1}


def test_pit_lane_and_wide_corners(spark):
    df = spark.createDataFrame([("t", i, float(i)) for i in (1, 2)], "track string, corner_no int, radius_m double")
    row = geometry.corners_wide(df, {"radius": "radius_m"}, 3).first()
    assert (row.corner_1_radius, row.corner_2_radius, row.corner_3_radius) == (1.0, 2.0, None)


@pytest.mark.parametrize("limit", [5, 10_000])
def test_as_of_in_buckets_equals_as_of(spark, small_groups, limit):
    start = dt.datetime(2024, 1, 1)
    left = [(i % 2, start + dt.timedelta(hours=i * 7 % 400)) for i in range(80)] + [(None, start), (3, start), (1, None)]
    right = [(i % 2, start + dt.timedelta(hours=i * 53 % 300 - 20), i) for i in range(9)] + [(None, start, 99), (0, None, 98), (1, start, None)]
    rows = spark.createDataFrame(left, "k int, t timestamp")
    history = spark.createDataFrame(right, "k int, ht timestamp, v int")
    small_groups(limit)
    want = joins.as_of(rows, history, ["k"], "t", "ht", ["v"])
    got = joins.as_of_in_buckets(rows, history, ["k"], "t", "ht", ["v"], 24 * 3600)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
