"""Sources and sinks: driver tables written as files, read back, and compared."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.registry import query, settled, settled_sql
from lapframe.functions.arrays import strip_prefix
from lapframe.operators import clean, evaluate, features, geometry
from lapframe.plans import landing, rebuild
from lapframe.session import materialize, new_path
from lapframe.sources import readers, writers
from lapframe.streaming import live


@query(
    """SELECT CAST(year(l_shipdate) AS INT) AS season, l_suppkey AS driver_id, l_orderkey AS lap_number, l_linenumber AS part,
       l_extendedprice AS lap_time, CASE WHEN l_linenumber <> 1 THEN l_quantity END AS "TyreLife", l_returnflag AS compound FROM lineitem"""
)
def scan_lap_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A wide CSV with blanks around its names, and NaN for missing numbers."""
    rows = b.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias(" season"),
        F.col("l_suppkey").alias("driver_id "),
        F.col("l_orderkey").alias(" lap_number "),
        F.col("l_linenumber").alias("part"),
        F.col("l_extendedprice").alias("lap_time"),
        F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity")).alias("TyreLife"),
        F.col("l_returnflag").alias("compound"),
    )
    path = new_path(spark, "csv")
    writers.csv(rows, path)
    return readers.lap_csv(spark, path, rows.schema)


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders"""
)
def scan_mixed_folder(spark: SparkSession, sf: str) -> DataFrame:
    """CSV and Parquet files side by side below one folder, NaN in both; one kind lacks a column."""
    price = F.when(F.col("o_orderkey") % 5 == 0, float("nan")).otherwise(F.col("o_totalprice"))
    rows = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", price.alias("o_totalprice"), "o_orderstatus")
    path = new_path(spark, "mixed")
    writers.csv(rows.where("o_orderkey % 2 = 0").drop("o_orderstatus"), f"{path}/a/csv")
    rows.where("o_orderkey % 2 = 1").write.parquet(f"{path}/b/parquet")
    return readers.lap_files(spark, path, rows.drop("o_orderstatus").schema, rows.schema)


@query(
    """SELECT n_name AS host, CAST(n_nationkey AS INT) AS corners, '20' || (n_nationkey + 10) || '-2099' AS years,
       CASE WHEN n_regionkey <> 2 THEN n_nationkey || ',' || n_regionkey END AS corner_1_coords FROM nation"""
)
def scan_track_metadata(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    rows = b.table(spark, sf, "nation").select(
        F.col("n_name").alias("host "),
        key.cast("int").alias(" corners"),
        F.concat(F.lit("20"), key + 10, F.lit("-2099")).alias("years"),
        F.when(F.col("n_regionkey") != 2, F.concat(key, F.lit(","), "n_regionkey")).alias("corner_1_coords"),
    )
    path = new_path(spark, "tracks")
    writers.csv(rows, path)
    return readers.track_metadata(spark, path, rows.schema)


@query(
    """SELECT n_name AS gp, CAST(n_nationkey AS DOUBLE) AS lat, CASE WHEN n_regionkey <> 1 THEN n_regionkey + 0.5 END AS lon,
       lower(replace(n_name, ' ', '_')) AS slug FROM nation"""
)
def scan_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Loosely named columns, and text where a number should be."""
    lon = F.when(F.col("n_regionkey") == 1, "unknown").otherwise((F.col("n_regionkey") + 0.5).cast("string"))
    rows = b.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("Latitude (deg)"), lon.alias("LONG"), F.col("n_name").alias("Grand Prix")
    )
    path = new_path(spark, "coordinates")
    writers.csv(rows, path)
    return readers.track_coordinates(spark, path)


_BLOCK = 500  # events of a weather document


@query(
    f"""WITH d AS (SELECT event_id, value, event_id // {_BLOCK} AS block FROM events)
    SELECT CAST(2000 + block % 25 AS INT) AS year, 'grand_prix_' || (block % 7) AS slug, 'race' || block AS label,
       CAST(DATE '2024-01-01' + CAST(block % 300 AS INT) AS DATE) AS date, event_id, value AS temp FROM d"""
)
def scan_weather_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Weather documents of up to 500 readings, landed as {year}/{slug}/{label}_{date}.json, as rows with the path's fields."""
    block = F.floor(F.col("event_id") / _BLOCK)
    docs = b.table(spark, sf, "events").groupBy(block.alias("block")).agg(
        F.collect_list(F.struct("event_id", F.col("value").alias("temp"))).alias("days")
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("block") % 300).cast("int"))
    name = F.format_string(
        "%d/grand_prix_%d/race%d_%s.json", 2000 + F.col("block") % 25, F.col("block") % 7, F.col("block"), day.cast("string")
    )
    path = new_path(spark, "weather")
    writers.named_files(docs.select(name.alias("name"), F.to_json(F.struct("days")).alias("body")), path, "name", "body")
    body = T.StructType.fromDDL("days array<struct<event_id: long, temp: double>>")
    return readers.weather_documents(spark, path, body).select("year", "slug", "label", "date", F.inline("days"))


_TRACK = 20  # vectors of a track
_TRACKS_SQL = f"""{b.VERTICES_SQL}, tracks AS (
  SELECT 'track_' || (track // {_TRACK}) AS name, CAST(row_number() OVER (PARTITION BY track // {_TRACK} ORDER BY track, idx) - 1 AS INT) AS place,
         lon, lat, elevation_m FROM vertices)"""


def _tracks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per track of at most 640 vertices, ``points`` in order."""
    points = F.array_sort(F.collect_list(F.struct("track", "idx", "lon", "lat", "elevation_m")))
    name = F.concat(F.lit("track_"), F.floor(F.col("track") / _TRACK))
    return b.vertices(spark, sf).groupBy(name.alias("name")).agg(points.alias("points"))


def _land_centerlines(tracks: DataFrame, path: str) -> None:
    """A GeoJSON file per track, named after it, with a second feature that does not count."""
    line = F.transform("points", lambda p: F.array(p["lon"], p["lat"]))
    features = F.array(*[F.struct(F.struct(c.alias("coordinates")).alias("geometry")) for c in (line, F.slice(line, 1, 1))])
    docs = tracks.select(F.concat("name", F.lit(".geojson")).alias("file"), F.to_json(F.struct(features.alias("features"))).alias("body"))
    writers.named_files(docs, path, "file", "body")


def _land_profiles(tracks: DataFrame, path: str) -> None:
    """A profile file per track in a folder of its own, NaN in it, and a file of another name that does not count."""
    rows = tracks.select("name", F.posexplode("points").alias("place", "p"))
    height = F.when(F.col("place") % 5 == 3, "NaN").otherwise(F.col("p.elevation_m").cast("string"))
    line = F.concat_ws(",", "name", (F.col("place") * 10.0).cast("string"), height, F.lit("0.5"))
    # The first vertex brings the header with it.
    shown = F.when(F.col("place") == 0, F.array(F.lit("track,distance_m,elevation_m,elev_delta_m"), line)).otherwise(F.array(line))
    lines = rows.select("name", "place", F.posexplode(shown).alias("part", "line"))
    for tail in ("elevation_profile.csv", "notes.csv"):
        named = lines.withColumn("file", F.concat("name", F.lit("/"), "name", F.lit(f"_{tail}")))
        writers.named_files(named, path, "file", "line", ["place", "part"])


@query(f"WITH {_TRACKS_SQL} SELECT name AS track, place AS idx, lon, lat FROM tracks")
def scan_centerlines(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "centerlines")
    _land_centerlines(_tracks(spark, sf), path)
    return readers.centerlines(spark, path)


@query(
    f"""WITH {_TRACKS_SQL} SELECT name AS track, place * 10.0::DOUBLE AS distance_m,
       CASE WHEN place % 5 <> 3 THEN elevation_m END AS elevation_m, CAST(0.5 AS DOUBLE) AS elev_delta_m FROM tracks"""
)
def scan_profiles(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "profiles")
    tracks = materialize(_tracks(spark, sf), "tracks")
    _land_profiles(tracks, path)
    profiles = readers.elevation_profiles(spark, path)
    readers.require_profiles(tracks.select(F.col("name").alias("track")), profiles)
    return profiles


_CORNERS = (40, 200, 360, 520)  # the vertices at the corners of a track


@query(
    f"""WITH {b.LAPS_SQL}, {_TRACKS_SQL}, flat AS (
      SELECT *, 6371000.0 * radians(lon - first_value(lon) OVER w) * cos(radians(first_value(lat) OVER w)) AS px,
        6371000.0 * radians(lat - first_value(lat) OVER w) AS py FROM tracks WINDOW w AS (PARTITION BY name ORDER BY place)),
    moves AS (SELECT *, coalesce(sqrt(pow(px - lag(px) OVER w, 2) + pow(py - lag(py) OVER w, 2)), 0) AS step
      FROM flat WINDOW w AS (PARTITION BY name ORDER BY place)),
    path AS (SELECT *, sum(step) OVER (PARTITION BY name ORDER BY place) AS dist FROM moves),
    spaced AS (SELECT name, row_number() OVER w AS no, dist - coalesce(lag(dist) OVER w, 0) AS spacing
      FROM path WHERE place IN {_CORNERS} WINDOW w AS (PARTITION BY name ORDER BY dist)),
    corners AS (SELECT name, max(spacing) FILTER (no = 1) AS c1, max(spacing) FILTER (no = 3) AS c3 FROM spaced GROUP BY name),
    shape AS (SELECT name, max(dist) AS track_length,
        max(elevation_m) FILTER (place % 5 <> 3) - min(elevation_m) FILTER (place % 5 <> 3) AS rise FROM path GROUP BY name),
    wx AS (SELECT year(o_orderdate) AS season, month(o_orderdate) AS race_round, o_orderdate AS ts, max(o_totalprice) AS temperature
      FROM orders GROUP BY ALL)
    SELECT CAST(c.season AS BIGINT) AS season, CAST(c.race_round AS BIGINT) AS race_round, c.driver_id, c.lap_number, c.car_part,
      c.lap_time, s_nationkey AS grid_position, temperature, round(track_length, 3) AS track_length, round(rise, 6) AS rise,
      round(c1, 3) AS corner_1_distance, round(c3, 3) AS corner_3_distance
    FROM clean c LEFT JOIN supplier ON s_suppkey = c.driver_id
    ASOF LEFT JOIN wx ON c.season = wx.season AND c.race_round = wx.race_round AND c.lap_start >= wx.ts
    LEFT JOIN shape ON shape.name = 'track_' || c.race_round LEFT JOIN corners ON corners.name = 'track_' || c.race_round"""
)
def rebuild_wide_table(spark: SparkSession, sf: str) -> DataFrame:
    """Laps, results, weather documents, centerlines, profiles and track metadata land as files; one call makes the wide table."""
    path = new_path(spark, "rebuilt")
    laps = clean.clean_laps(b.laps(spark, sf)).select(
        "season",
        "race_round",
        F.concat(F.lit("Track "), "race_round").alias("grand_prix"),
        F.col("driver_id").cast("string").alias("DriverNumber"),
        F.col("lap_number").alias("LapNumber"),
        F.col("lap_time").alias("LapTime"),
        F.col("lap_start").cast("timestamp").alias("lap_start"),
        "car_part",
    )
    laps = materialize(laps, "laps")
    laps.write.parquet(f"{path}/laps")
    results = b.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("DriverNumber"), F.col("s_nationkey").alias("GridPosition"))
    events = laps.select("season", "race_round", "DriverNumber").distinct()
    events.join(results, "DriverNumber").write.parquet(f"{path}/results")
    days = (
        b.table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"), F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_totalprice").alias("temp"))
    )
    hours = F.array(F.struct(F.lit("00:00:00").alias("datetime"), "temp"))
    docs = days.groupBy("year", "round").agg(F.collect_list(F.struct(F.col("day").cast("string").alias("datetime"), hours.alias("hours"))).alias("days"))
    name = F.format_string("%d/track_%d/race_%d-%02d-01.json", "year", "round", "year", "round")
    writers.named_files(docs.select(name.alias("name"), F.to_json(F.struct("days")).alias("body")), f"{path}/weather", "name", "body")
    tracks = materialize(_tracks(spark, sf), "tracks")
    _land_centerlines(tracks, f"{path}/centerlines")
    _land_profiles(tracks, f"{path}/profiles")
    spots = [F.get("points", F.lit(v)) for v in _CORNERS]
    coords = [F.concat_ws(",", p["lat"], p["lon"]).alias(f"corner_{i}_coords") for i, p in enumerate(spots, 1)]
    writers.csv(tracks.select(F.col("name").alias("slug"), *coords), f"{path}/tracks")
    folders = rebuild.Folders(*(f"{path}/{x}" for x in ("laps", "results", "weather", "centerlines", "profiles", "tracks")))
    wide = rebuild.rebuild(spark, folders, f"{path}/wide", lap_schema=laps.schema, extra=["car_part"])
    return wide.select(
        "season", "race_round", "driver_id", "lap_number", "car_part", "lap_time", "grid_position", "temperature",
        F.round("track_length", 3).alias("track_length"), F.round("total_elev_change", 6).alias("rise"),
        F.round("corner_1_distance", 3).alias("corner_1_distance"), F.round("corner_3_distance", 3).alias("corner_3_distance"),
    )


@query(
    f"""WITH {b.LAPS_SQL}, e AS (SELECT race_round AS fold, lap_time - 60 AS error FROM clean),
    f AS (SELECT fold, {settled_sql("sqrt(avg(error * error))")} AS rmse, {settled_sql("avg(abs(error))")} AS mae FROM e GROUP BY fold)
    SELECT fold, f.rmse, f.mae, o.rmse AS overall_rmse, n_rows, CAST(3 AS BIGINT) AS n_features FROM f,
      (SELECT {settled_sql("sqrt(avg(error * error))")} AS rmse, CAST(count(*) AS BIGINT) AS n_rows FROM e) o"""
)
def metrics_record(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics record, written as JSON and read back fold by fold."""
    laps = clean.clean_laps(b.laps(spark, sf)).select(
        F.col("race_round").alias("fold"), F.col("lap_time").alias("actual"), F.lit(60.0).alias("pred_lap_time")
    )
    laps, path = materialize(laps), new_path(spark, "metrics")
    writers.metrics_json(evaluate.error_metrics(laps, ["fold"]), evaluate.error_metrics(laps), 3, path)
    record = spark.read.schema(
        "rmse double, mae double, n_rows long, n_features long, cv array<struct<fold:int,rmse:double,mae:double>>"
    ).json(path)
    rows = record.select(F.col("rmse").alias("overall_rmse"), "n_rows", "n_features", F.explode("cv").alias("c"))
    rows = rows.select("c.*", "overall_rmse", "n_rows", "n_features")
    return rows.withColumns({c: settled(c) for c in ("rmse", "mae", "overall_rmse")})


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def newest_file(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings of the orders, of several files each; only the one written last counts, all of it."""
    rows, path = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), new_path(spark, "landed")
    for k in range(2):
        landing = rows.where(F.col("o_orderkey") % 2 == k).repartition(3, "o_orderkey")
        landing.write.parquet(f"{path}/landing={k}")
        time.sleep(1.1 * (1 - k))  # file systems keep whole seconds
    return readers.newest_landing(spark.read.schema(rows.schema).parquet(path).select(*rows.columns))


@query(
    f"""WITH {b.LAPS_SQL}, one AS (SELECT season, race_round FROM clean GROUP BY ALL ORDER BY season, race_round LIMIT 1)
    SELECT c.season, c.race_round, driver_id, lap_number, car_part, CASE WHEN o.season IS NULL THEN lap_time ELSE lap_time + 1 END AS lap_time
    FROM clean c LEFT JOIN one o ON c.season = o.season AND c.race_round = o.race_round"""
)
def land_event_again(spark: SparkSession, sf: str) -> DataFrame:
    """All events land, then the first one again with other times: only its folder is replaced."""
    rows = clean.clean_laps(b.laps(spark, sf)).select("season", "race_round", "driver_id", "lap_number", "car_part", "lap_time")
    path = new_path(spark, "events")
    writers.land_partitions(rows, path, ["season", "race_round"])
    first = rows.agg(F.min(F.struct("season", "race_round")).alias("e")).select("e.*").first()
    landed = spark.read.schema(rows.schema).parquet(path)
    event = landed.where((F.col("season") == first["season"]) & (F.col("race_round") == first["race_round"]))
    writers.land_partitions(event.withColumn("lap_time", F.col("lap_time") + 1), path, ["season", "race_round"])
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("SELECT l_linenumber, l_orderkey, l_partkey, l_quantity, l_tax, l_returnflag, l_linestatus FROM lineitem")
def chosen_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Names from a list and by prefix, without repeats, then without exclusions."""
    rows = b.table(spark, sf, "lineitem")
    clean.require_columns(rows, ["l_orderkey", "l_partkey"])
    names = clean.names_with(rows, ["l_linenumber", "not_there", "l_orderkey", "l_orderkey"], ["l_"])
    kept = clean.without(names, ["l_suppkey", "l_discount"], ["l_ship", "l_extended"])
    return clean.require_rows(rows, "lineitem").select(*kept)


@query(
    f"""WITH {b.VERTICES_SQL}, {b.APEX_SQL} SELECT CAST(max(c) AS BIGINT) AS corners
       FROM (SELECT track, count(*) AS c FROM near GROUP BY track)"""
)
def most_corners(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    spaced = geometry.corner_spacing(b.apexes(spark, sf, line), geometry.track_totals(line), fits=True)
    most = geometry.most_corners(spaced)
    return spaced.agg(F.lit(most).cast("bigint").alias("corners"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, unnest(['A', 'N', 'R']) AS label,
       unnest([l_returnflag = 'A', l_returnflag = 'N', l_returnflag = 'R']) AS is_set FROM lineitem"""
)
def flag_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Flag columns as rows, each named by what follows the prefix."""
    rows = b.flagged_laps(spark, sf)
    flags = clean.names_with(rows, prefixes=["Compound_"])
    pairs = F.array(
        *[
            F.struct(F.lit(strip_prefix(f, "Compound_")).alias("label"), (F.col(f) == 1).alias("is_set"))
            for f in flags
        ]
    )
    return rows.select(
        F.floor(F.col("lap_number") / 10).alias("l_orderkey"),
        F.col("position").cast("int").alias("l_linenumber"),
        F.col("car_part").alias("l_partkey"),
        F.explode(pairs).alias("p"),
    ).select("l_orderkey", "l_linenumber", "l_partkey", "p.*")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, unnest(['compound', 'Team', 'driver_id']) AS feature,
       unnest([nullif(l_returnflag, 'R'), l_linestatus, CAST(l_suppkey AS VARCHAR)]) AS level
       FROM lineitem WHERE l_returnflag <> 'R'
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, unnest(['Team', 'driver_id']),
       unnest([l_linestatus, CAST(l_suppkey AS VARCHAR)]) FROM lineitem WHERE l_returnflag = 'R'"""
)
def onehot_long(spark: SparkSession, sf: str) -> DataFrame:
    """The ones of a one-hot table with any number of levels."""
    rows = b.table(spark, sf, "lineitem").withColumns(
        {"compound": F.nullif("l_returnflag", F.lit("R")), "Team": F.col("l_linestatus"), "driver_id": F.col("l_suppkey")}
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return features.one_hot_long(rows, keys, ["compound", "Team", "driver_id", "not_there"])


@query("SELECT event_id, ts, user_id, event_type, value, props, true AS stamped FROM events")
def replay_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows sent as JSON messages, replayed as a stream, and decoded with their processing time."""
    events, path = b.table(spark, sf, "events"), new_path(spark, "replay")
    live.replay(events, f"{path}/in")
    raw = T.StructType.fromDDL("value string")
    begin = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    stream = live.parse(live.file_messages(spark, f"{path}/in", raw), "value", events.schema, {}, event_time="stamp")
    live.finish(live.append_rows(stream, f"{path}/out", f"{path}/checkpoint"))
    back = spark.read.schema(stream.schema).parquet(f"{path}/out")
    return back.withColumn("stamped", F.col("stamp") >= F.lit(begin)).drop("stamp")


@query(
    """WITH last AS (SELECT max_by(value, (ts, event_id)) AS temperature FROM events)
    SELECT 2024 AS season, 7 AS race_round, l_suppkey AS driver_id, l_orderkey AS lap_number, l_extendedprice AS lap_time,
       l_tax AS sector1_time, s_nationkey AS grid_position, s_acctbal AS finish_position, CAST(NULL AS VARCHAR) AS conditions,
       temperature, CAST(NULL AS VARCHAR) AS humidity, CAST(NULL AS VARCHAR) AS tracktemperature, 'emilia_romagna_gp' AS grand_prix
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey, last"""
)
def landed_laps(spark: SparkSession, sf: str) -> DataFrame:
    """Laps, results and weather under their sources' names, landed as one event."""
    laps = b.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("DriverNumber"),
        F.col("l_orderkey").alias("LapNumber"),
        F.col("l_extendedprice").alias("LapTime"),
        F.col("l_tax").alias("Sector1Time"),
    )
    results = b.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("DriverNumber"),
        F.col("s_nationkey").alias("GridPosition"),
        F.col("s_acctbal").alias("Position"),
    )
    weather = b.table(spark, sf, "events").select(F.struct("ts", "event_id").alias("Time"), F.col("value").alias("Temperature"))
    return landing.historical_laps(laps, results, weather, 2024, 7, "Emilia-Romagna G.P.")
