"""Files in, files out."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from lapframe.functions import messages
from lapframe.operators import clean, evaluate
from lapframe.plans import wide_laps
from lapframe.plans import landing
from lapframe.sources import readers, writers
from lapframe.session import new_path, shared_dir


def test_lap_csv_trims_names_and_reads_nan(spark, tmp_path):
    (tmp_path / "laps.csv").write_text(" season , lap_time \n2024,91.5\n2024,NaN\n2024,\n")
    df = readers.lap_csv(spark, str(tmp_path / "laps.csv"))
    assert df.columns == ["season", "lap_time"]
    assert sorted(r.lap_time or 0 for r in df.collect()) == [0, 0, 91.5]


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "old.csv").write_text("driver_id,lap_time\n1,90.0\n")
    spark.createDataFrame([(2, 80.0, "SOFT")], "driver_id int, lap_time double, compound string").write.parquet(
        str(tmp_path / "a" / "b" / "new")
    )
    df = readers.lap_files(spark, str(tmp_path))
    rows = {r.driver_id: (r.lap_time, r.compound) for r in df.collect()}
    assert rows == {1: (90.0, None), 2: (80.0, "SOFT")}
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.lap_files(spark, str(tmp_path / "empty"))


def test_rows_fetched_twice(spark):
    df = spark.createDataFrame([(1, 1, 9.0), (1, 1, 8.0), (1, 2, 7.0)], "driver_id int, lap_number int, lap_time double")
    got = readers.one_per_key(df, ["driver_id", "lap_number"], ["lap_time"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 8.0), (1, 2, 7.0)]


def test_newest_file_wins(spark, tmp_path):
    import os

    for i, name in enumerate(("first", "second")):
        (tmp_path / f"{name}.csv").write_text(f"v\n{i}\n")
        os.utime(tmp_path / f"{name}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    df = spark.read.schema("v int").option("header", "true").csv(str(tmp_path))
    assert [r.v for r in readers.newest_files(df).collect()] == [1]


def test_weather_documents(spark, tmp_path):
    folder = tmp_path / "2024" / "test_grand_prix"
    folder.mkdir(parents=True)
    (folder / "race_2024-03-02.json").write_text(json.dumps({"days": [{"temp": 20.5}, {"temp": 21.0}]}, indent=1))
    body = T.StructType().add("days", T.ArrayType(T.StructType().add("temp", "double")))
    df = readers.weather_documents(spark, str(tmp_path), body).withColumn("day", F.explode("days"))
    rows = sorted((r.year, r.slug, r.label, str(r.date), r.day.temp) for r in df.collect())
    assert rows == [(2024, "test_grand_prix", "race", "2024-03-02", t) for t in (20.5, 21.0)]


def test_centerline(spark, tmp_path):
    doc = {"features": [{"geometry": {"coordinates": [[10.0, 45.0], [10.1, 45.1]]}}, {"geometry": {"coordinates": []}}]}
    (tmp_path / "monza.geojson").write_text(json.dumps(doc))
    rows = [tuple(r) for r in readers.centerlines(spark, str(tmp_path)).orderBy("idx").collect()]
    assert rows == [("monza", 0, 10.0, 45.0), ("monza", 1, 10.1, 45.1)]


def test_profiles_and_missing_track(spark, tmp_path):
    (tmp_path / "monza_elevation_profile.csv").write_text(
        "track,distance_m,elevation_m,elev_delta_m\nmonza,0,5,0\nmonza,10,NaN,0\n"
    )
    profiles = readers.elevation_profiles(spark, str(tmp_path))
    assert [r.elevation_m for r in profiles.orderBy("distance_m").collect()] == [5.0, None]
    readers.require_profiles(spark.createDataFrame([("monza",)], "track string"), profiles)
    with pytest.raises(FileNotFoundError, match="spa"):
        readers.require_profiles(spark.createDataFrame([("spa",)], "track string"), profiles)


def test_track_coordinates_by_loose_names(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Round,Grand Prix,Latitude,Longitude\n1,Test G.P.,45.5,9.2\n")
    assert tuple(readers.track_coordinates(spark, str(tmp_path / "c.csv")).first()) == ("Test G.P.", 45.5, 9.2, "test_gp")
    (tmp_path / "d.csv").write_text("place,lat,lon\nSpa,50,5\n")
    assert readers.track_coordinates(spark, str(tmp_path / "d.csv")).first().slug == "spa"


def test_track_metadata_and_pit_lane(spark, tmp_path):
    (tmp_path / "m.csv").write_text('host,pit_entry_coords,pit_exit_coords\nspa,"50.0,5.0","50.0,5.01"\n')
    columns = T.StructType().add("host", "string").add("pit_entry_coords", "string").add("pit_exit_coords", "string")
    meta = readers.track_metadata(spark, str(tmp_path / "m.csv"), columns)
    row = wide_laps.pit_lane_length(meta, "pit_entry_coords", "pit_exit_coords").first()
    assert 700 < row.pit_lane_length < 730


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, "a", 1.5), (2023, "b", None)], "season int, grand_prix string, lap_time double")
    writers.csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").schema(df.schema).csv(str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in back.collect()) == [(2023, "b", None), (2024, "a", 1.5)]
    writers.partitioned_parquet(df, str(tmp_path / "pq"), ["season", "grand_prix"])
    assert (tmp_path / "pq" / "season=2024" / "grand_prix=a").is_dir()


def test_metrics_json(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 5.0)], "fold int, actual double, pred_lap_time double")
    writers.metrics_json(
        evaluate.error_metrics(rows, ["fold"]), evaluate.error_metrics(rows), 7, str(tmp_path / "m")
    )
    got = json.loads(spark.read.text(str(tmp_path / "m")).first().value)
    assert got["mae"] == 1.5 and got["n_rows"] == 2 and got["n_features"] == 7
    assert [c["fold"] for c in got["cv"]] == [0, 1]


def test_encoding_leaves_null_out(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert messages.encode_rows(df).first().value == '{"a":1}'


def test_empty_input_is_an_error(spark):
    with pytest.raises(RuntimeError, match="laps"):
        clean.require_rows(spark.range(0).toDF("x"), "laps")


class _Session:
    """Just enough of a session to ask where shared tables go."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext, self.master, self.folder = self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder():
    cluster = _Session("hdfs:///shared", "yarn")
    assert shared_dir(cluster) == "hdfs:///shared" == cluster.folder
    assert new_path(cluster, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(None, "yarn"))
    assert shared_dir(_Session(None, "local[2]"))


def test_three_sources_land_as_one_table(spark):
    raw = spark.sql(
        """select '7' DriverNumber, 3.0D LapNumber, interval '1' minute + interval '20.5' second LapTime,
           interval '20' second Sector1Time, 2.0D Position, timestamp'2024-01-01 10:00:00' PitInTime, timestamp'2024-01-01 10:00:25' PitOutTime"""
    )
    events = landing.event_laps(raw, 2024, "monza")
    assert events.columns == ["season", "grand_prix", "driver_id", "lap_number", "lap_time", "sector1_time", "position"]
    assert tuple(events.first()) == (2024, "monza", 7, 3.0, 80.5, 20.0, 2.0)
    results = spark.createDataFrame([("7", 4.0, 1.0, "SOFT")], "DriverNumber string, GridPosition double, Position double, Compound string")
    weather = spark.createDataFrame([(1, 20.0, 50.0), (2, 25.0, 40.0)], "Time int, Temperature double, Humidity double")
    old = landing.historical_laps(raw.drop("Position"), results, weather, 2023, 5, "Emilia Romagna G.P.").first()
    assert (old.driver_id, old.grid_position, old.finish_position, old.compound) == (7, 4.0, 1.0, "SOFT")
    assert (old.temperature, old.humidity, old.tracktemperature, old.grand_prix, old.race_round) == (25.0, 40.0, None, "emilia_romagna_gp", 5)
    tv = landing.tv_laps(raw.withColumn("GridPosition", F.lit(9.0)), 2022, "spa").first()
    assert (tv.pit_stop_lap, tv.pit_stop_duration, tv.grid_position) == (3.0, 25.0, 9.0)
    samples = spark.sql("select '7' DriverNumber, timestamp'2024-01-01 10:00:00' Time, 300.0D Speed, 8 nGear, 12 DRS")
    assert landing.telemetry(samples, 2024, "spa").columns == ["season", "grand_prix", "timestamp", "speed", "gear", "drs_active", "driver_id"]
    assert landing.all_laps(events, landing.event_laps(raw, 2025, "spa")).count() == 2
    with pytest.raises(Exception, match="driver_id is no whole number"):
        landing.event_laps(raw.withColumn("DriverNumber", F.lit("VER")), 2024, "spa").collect()


def test_nan_in_parquet_is_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k int, v double")
    df.write.parquet(str(tmp_path / "a" / "b"))
    for read in (readers.parquet(spark, [str(tmp_path / "a" / "b")]), readers.lap_files(spark, str(tmp_path)), readers.parquet(spark, [str(tmp_path / "a" / "b")], df.schema)):
        assert {r.k: r.v for r in read.collect()} == {1: None, 2: 3.0}


def test_a_folder_of_one_machine_is_no_shared_folder(spark):
    from lapframe import session

    assert session._is_local_path(spark, "file:///tmp/x") and session._is_local_path(spark, "/tmp/x")
    assert not session._is_local_path(spark, "hdfs://nn/x") and not session._is_local_path(spark, "s3a://b/x")


def test_a_landing_of_several_files_counts_as_one(spark, tmp_path):
    import os

    for k in range(2):
        spark.range(k * 100, k * 100 + 40).repartition(4).write.parquet(str(tmp_path / "in" / f"landing={k}"))
    for n, file in enumerate(sorted((tmp_path / "in" / "landing=1").glob("*.parquet"))):
        os.utime(file, (2_000_000_000 + n, 2_000_000_000 + n))
    rows = spark.read.parquet(str(tmp_path / "in")).select("id")
    assert sorted(r.id for r in readers.newest_landing(rows).collect()) == list(range(100, 140))


def test_landing_an_event_again_replaces_only_its_folder(spark, tmp_path):
    path = str(tmp_path / "laps")
    rows = spark.createDataFrame([(s, r, float(s + r + i)) for s in (2023, 2024) for r in (1, 2, 3) for i in range(4)], "season int, race_round int, lap_time double")
    writers.land_partitions(rows, path, ["season", "race_round"])
    other = {f for f in (tmp_path / "laps").rglob("*.parquet") if "season=2024/race_round=2" not in str(f)}
    for _ in range(2):
        writers.land_partitions(rows.where("season = 2024 and race_round = 2").limit(3).withColumn("lap_time", F.lit(1.0)), path, ["season", "race_round"])
    back = spark.read.schema(rows.schema).parquet(path)
    assert back.count() == 23 and back.where("lap_time = 1.0").count() == 3
    assert other <= set((tmp_path / "laps").rglob("*.parquet"))
    one = back.where("season = 2024 and race_round = 2")
    assert "PartitionFilters: [isnotnull(season" in one._jdf.queryExecution().toString()
    writers.land_partitions(rows.limit(0), path, ["season", "race_round"])
    assert spark.read.schema(rows.schema).parquet(path).count() == 23


def _files(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_named_files_are_whole_ordered_and_replaced(spark, tmp_path):
    rows = [(f"a/{i % 3}.txt", i, None if i == 4 else f"line {i}") for i in range(30)] + [("empty.txt", 0, None)]
    df = spark.createDataFrame(rows, "file string, at int, text string").repartition(5)
    writers.named_files(df, str(tmp_path), "file", "text", ["at"])
    want = {f"a/{k}.txt": "".join(f"line {i}\n" for i in range(k, 30, 3) if i != 4) for k in range(3)} | {"empty.txt": ""}
    assert _files(tmp_path) == want
    writers.named_files(df.where("file = 'a/1.txt' and at < 9"), f"file:{tmp_path}", "file", "text", ["at"])
    assert _files(tmp_path) == want | {"a/1.txt": "line 1\nline 7\n"}
    writers.named_files(df.limit(0), str(tmp_path), "file", "text")
    assert _files(tmp_path) == want | {"a/1.txt": "line 1\nline 7\n"}


@pytest.mark.parametrize("name", [None, "", "../up.txt", "a//b", "_hidden/x", ".x", "/etc/x"])
def test_names_that_are_no_files_below_the_folder(spark, tmp_path, name):
    df = spark.createDataFrame([("fine.txt", "x"), (name, "y")], "file string, text string")
    with pytest.raises(Exception, match="does not name a file"):
        writers.named_files(df, str(tmp_path), "file", "text")
    assert _files(tmp_path) == {}


def test_rows_of_a_named_file_must_lie_together(spark, tmp_path):
    spark.dataSource.register(writers.NamedFiles)
    for rows in ([("x", "1"), ("y", "2"), ("x", "3")], [("x", "1"), ("x", "2")]):
        df = spark.createDataFrame(rows, "name string, line string").repartitionByRange(len(rows) if len(rows) == 2 else 1, "line")
        with pytest.raises(Exception, match="lie apart"):
            df.write.format("named_files").mode("append").save(str(tmp_path))
    assert _files(tmp_path) == {}
