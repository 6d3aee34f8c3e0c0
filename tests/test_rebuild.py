"""Landed folders become the wide lap table."""

import dataclasses
import datetime as dt
import json

import pytest

from lapframe.plans import rebuild
from lapframe.sources import readers, writers

LAPS = "season int, race_round int, grand_prix string, DriverNumber string, LapNumber long, LapTime double, lap_start timestamp"


def _land(spark, root):
    at = dt.datetime(2024, 3, 2, 14, 30)
    rows = [(2024, k, name, "7", n, 90.0 + n, at + dt.timedelta(hours=n)) for k, name in ((1, "Test G.P."), (2, "No Track")) for n in range(3)]
    spark.createDataFrame(rows, LAPS).write.parquet(f"{root}/laps")
    spark.createDataFrame([(2024, 1, "7", 3, 1)], "season int, race_round int, DriverNumber string, GridPosition long, Position long").write.parquet(f"{root}/results")
    hours = [{"datetime": f"{h}:00:00", "temp": float(h), "humidity": 50.0, "conditions": "Clear"} for h in (14, 15)]
    docs = [("2024/test_gp/race_2024-03-02.json", json.dumps({"days": [{"datetime": "2024-03-02", "hours": hours}]}))]
    writers.named_files(spark.createDataFrame(docs, "f string, t string"), f"{root}/weather", "f", "t")
    line = {"features": [{"geometry": {"coordinates": [[0.0, 0.0], [0.001, 0.0], [0.001, 0.001]]}}]}
    writers.named_files(spark.createDataFrame([("test_gp.geojson", json.dumps(line))], "f string, t string"), f"{root}/lines", "f", "t")
    text = "track,distance_m,elevation_m,elev_delta_m\ntest_gp,0,5,0\ntest_gp,10,NaN,0\ntest_gp,20,9,0"
    writers.named_files(spark.createDataFrame([("a/test_gp_elevation_profile.csv", text)], "f string, t string"), f"{root}/profiles", "f", "t")
    writers.csv(spark.createDataFrame([("test_gp", "0.0,0.001")], "slug string, corner_1_coords string"), f"{root}/tracks")
    return rebuild.Folders(*(f"{root}/{x}" for x in ("laps", "results", "weather", "lines", "profiles", "tracks")))


def test_one_call_and_one_event_again(spark, tmp_path):
    folders = _land(spark, str(tmp_path))
    wide = rebuild.rebuild(spark, folders, str(tmp_path / "wide"))
    rows = sorted(wide.collect(), key=lambda r: (r.race_round, r.lap_number))
    assert [(r.race_round, r.lap_number, r.driver_id, r.slug) for r in rows] == [(k, n, 7, s) for k, s in ((1, "test_gp"), (2, "no_track")) for n in range(3)]
    assert [r.temperature for r in rows] == [14.0, 15.0, 15.0, None, None, None]
    assert [r.grid_position for r in rows] == [3, 3, 3, None, None, None]
    assert rows[0].total_elev_change == 4.0 and rows[0].lap_length_m == 20.0 and rows[3].track_length is None
    assert rows[0].corner_1_distance == pytest.approx(111.19, abs=0.01) and rows[0].track_length == pytest.approx(222.39, abs=0.01)
    again = readers.parquet(spark, [folders.laps]).where("race_round = 1 and LapNumber = 0").selectExpr("* except (LapTime)", "80.0d AS LapTime")
    again.write.parquet(str(tmp_path / "later"))
    rebuilt = rebuild.rebuild(spark, dataclasses.replace(folders, laps=str(tmp_path / "later")), str(tmp_path / "wide"))
    assert sorted((r.race_round, r.lap_time) for r in rebuilt.collect()) == [(1, 80.0), (2, 90.0), (2, 91.0), (2, 92.0)]


def test_a_track_without_a_profile(spark, tmp_path):
    folders = _land(spark, str(tmp_path))
    writers.csv(spark.createDataFrame([("spa", "0.0,0.001")], "slug string, corner_1_coords string"), f"{tmp_path}/more")
    with pytest.raises(FileNotFoundError, match="spa"):
        rebuild.wide_table(spark, dataclasses.replace(folders, tracks=f"{tmp_path}/more"))
