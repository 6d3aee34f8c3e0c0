"""Joins: lookups, as-of and interval alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.registry import query, settled, settled_sql
from lapframe.operators import clean, evaluate, joins
from lapframe.plans import wide_laps
from lapframe.session import materialize


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, lap_time,
       s_nationkey AS grid_position, s_acctbal AS finish_position
       FROM clean LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey <> 3) ON driver_id = s_suppkey"""
)
def laps_with_results(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(*config.REQUIRED_COLUMNS, "car_part")
    results = (
        b.table(spark, sf, "supplier")
        .where("s_nationkey <> 3")
        .withColumnsRenamed(
            {
                "s_suppkey": "driver_id",
                "s_nationkey": "grid_position",
                "s_acctbal": "finish_position",
            }
        )
    )
    return joins.attach(
        laps, results, ["driver_id"], ["grid_position", "finish_position", "compound"]
    )


@query(
    """WITH laps AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS lap_number,
         max(value) AS lap_time FROM events WHERE event_type = 'signup' GROUP BY ALL),
    tel AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS lap_number,
         value AS speed FROM events WHERE event_type <> 'signup')
    SELECT tel.event_id, tel.user_id, tel.lap_number, tel.speed, laps.lap_time
    FROM tel LEFT JOIN laps ON tel.user_id = laps.user_id AND tel.lap_number = laps.lap_number"""
)
def telemetry_lap_join(spark: SparkSession, sf: str) -> DataFrame:
    lap = F.get_json_object("props", "$.k").cast("bigint").alias("lap_number")
    events = b.table(spark, sf, "events").select(
        "event_id", "user_id", lap, F.col("value").alias("speed"), "event_type"
    )
    laps = (
        events.where("event_type = 'signup'")
        .groupBy("user_id", "lap_number")
        .agg(F.max("speed").alias("lap_time"))
    )
    telemetry = events.where("event_type <> 'signup'").drop("event_type")
    return joins.attach(telemetry, laps, ["user_id", "lap_number"], ["lap_time"])


@query(
    """WITH laps AS (SELECT user_id, ts AS lap_start, event_id AS lap_id, value AS lap_time,
         ts + to_microseconds(CAST(round(value * 3600000000) AS BIGINT)) AS lap_end
         FROM events WHERE event_type = 'signup')
    SELECT e.event_id, e.user_id, e.ts, CASE WHEN e.ts < lap_end THEN lap_id END AS lap_id,
           CASE WHEN e.ts < lap_end THEN lap_time END AS lap_time
    FROM (SELECT * FROM events WHERE event_type <> 'signup') e
    ASOF LEFT JOIN laps ON e.user_id = laps.user_id AND e.ts >= laps.lap_start"""
)
def telemetry_lap_interval(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    micros = F.round(F.col("value") * 3_600_000_000).cast("bigint")
    start = F.col("ts").cast("timestamp")
    laps = events.where("event_type = 'signup'").select(
        "user_id",
        F.col("ts").alias("lap_start"),
        F.timestamp_micros(F.unix_micros(start) + micros).cast("timestamp_ntz").alias("lap_end"),
        F.col("event_id").alias("lap_id"),
        F.col("value").alias("lap_time"),
    )
    samples = events.where("event_type <> 'signup'").select("event_id", "user_id", "ts")
    return joins.lap_at(
        samples, laps, ["user_id"], "ts", "lap_start", "lap_end", ["lap_id", "lap_time"]
    )


@query(
    """WITH places AS (SELECT lower(n_name) AS slug, CAST(n_nationkey AS DOUBLE) AS lat,
         CAST(n_regionkey AS DOUBLE) AS lon FROM nation WHERE n_regionkey <> 2)
    SELECT s_suppkey, 'nation_' || s_nationkey AS slug, lat, lon
    FROM supplier JOIN places ON 'nation_' || s_nationkey = slug"""
)
def event_coords_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation = b.table(spark, sf, "nation").where("n_regionkey <> 2")
    places = nation.select(
        F.col("n_name").alias("gp"),
        F.col("n_nationkey").cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"),
        F.lit(0).alias("line"),
    )
    # A second spelling of every place, which the first-match rule must ignore.
    places = places.unionByName(
        places.withColumns(
            {"gp": F.translate("gp", "_", "-"), "lat": F.lit(-1.0), "line": F.lit(1)}
        )
    )
    events = b.table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit(" Nation "), "s_nationkey", F.lit(" ")).alias("EventName")
    )
    return joins.lookup_by_slug(events, "EventName", places, "gp", ["line"]).select(
        "s_suppkey", "slug", "lat", "lon"
    )


@query(
    f"""WITH {b.LAPS_SQL},
    base AS (SELECT season, race_round, median(lap_time) AS baseline FROM clean
             WHERE season <= 1999 GROUP BY ALL)
    SELECT season, race_round, driver_id, lap_number, car_part, lap_time,
           {settled_sql("coalesce(baseline, (SELECT median(baseline) FROM base))", 9)} AS baseline
    FROM clean LEFT JOIN base USING (season, race_round)"""
)
def baseline_lookup(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(*config.REQUIRED_COLUMNS, "car_part")
    base = materialize(evaluate.race_baseline(laps.where("season <= 1999")))
    return joins.with_baseline(laps, base, config.RACE_KEYS).withColumn(
        "baseline", settled("baseline", 9)
    )


@query(
    """WITH w AS (SELECT user_id, ts, event_id AS weather_id, value AS temperature FROM events
         WHERE event_type = 'view')
    SELECT p.event_id, p.user_id, p.ts, weather_id, temperature
    FROM events p
    ASOF LEFT JOIN w ON p.user_id = w.user_id AND p.ts >= w.ts"""
)
def asof_weather(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    weather = events.where("event_type = 'view'").select(
        "user_id",
        F.col("ts").alias("weather_ts"),
        F.col("event_id").alias("weather_id"),
        F.col("value").alias("temperature"),
    )
    laps = events.select("event_id", "user_id", "ts")
    return joins.as_of(
        laps, weather, ["user_id"], "ts", "weather_ts", ["weather_id", "temperature"]
    )


@query(
    """WITH final AS (SELECT user_id, arg_max(value, ts) AS temperature,
         arg_max(event_id, ts) AS conditions FROM events WHERE event_type = 'view' GROUP BY user_id)
    SELECT e.event_id, e.user_id, temperature, conditions, CAST(NULL AS VARCHAR) AS tracktemperature
    FROM (SELECT * FROM events WHERE event_type <> 'view') e LEFT JOIN final USING (user_id)"""
)
def last_weather_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    series = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("value").alias("temperature"), F.col("event_id").alias("conditions")
    )
    laps = events.where("event_type <> 'view'").select("event_id", "user_id")
    return joins.last_snapshot(
        laps, series, ["user_id"], ["ts"], ["temperature", "conditions", "tracktemperature"]
    )


@query(
    f"""WITH {b.LAPS_SQL}, {b.VERTICES_SQL}, {b.APEX_SQL},
    sp AS (SELECT track, row_number() OVER w AS corner_no,
             dist_m - coalesce(lag(dist_m) OVER w, 0) AS spacing
           FROM near WINDOW w AS (PARTITION BY track ORDER BY dist_m, corner)),
    feats AS (SELECT track, max(total_m) AS track_length,
             max(spacing) FILTER (corner_no = 1) AS c1, max(spacing) FILTER (corner_no = 4) AS c4
             FROM sp JOIN totals USING (track) GROUP BY track),
    wx AS (SELECT CAST(year(o_orderdate) AS INT) AS season, o_orderdate AS ts,
             max(o_totalprice) AS temperature FROM orders GROUP BY ALL)
    SELECT c.season, c.race_round, c.driver_id, c.lap_number, c.car_part, c.lap_time, grid_position,
           temperature, round(track_length, 3) AS track_length,
           round(c1, 3) AS corner_1_distance, round(c4, 3) AS corner_4_distance
    FROM clean c
    LEFT JOIN (SELECT s_suppkey AS driver_id, s_nationkey AS grid_position FROM supplier) USING (driver_id)
    ASOF LEFT JOIN wx ON c.season = wx.season AND c.lap_start >= wx.ts
    LEFT JOIN feats ON feats.track = c.race_round"""
)
def wide_lap_table(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(
        *config.REQUIRED_COLUMNS, "car_part", "lap_start"
    )
    results = b.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").alias("grid_position")
    )
    weather = (
        b.table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("season"), F.col("o_orderdate").alias("weather_ts"))
        .agg(F.max("o_totalprice").alias("temperature"))
    )
    line = materialize(b.line(spark, sf))
    tracks = wide_laps.corner_table(
        line, b.apexes(spark, sf, line), n_corners=len(b.APEX_VERTICES)
    ).withColumnRenamed("track", "race_round")
    wide = wide_laps.assemble(
        laps,
        results,
        weather,
        tracks,
        result_keys=["driver_id"],
        weather_keys=["season"],
        lap_time="lap_start",
        weather_time="weather_ts",
        track_keys=["race_round"],
        bucket_seconds=7 * 86400,
    )
    return wide.select(
        *config.REQUIRED_COLUMNS,
        "car_part",
        "grid_position",
        "temperature",
        F.round("track_length", 3).alias("track_length"),
        F.round("corner_1_distance", 3).alias("corner_1_distance"),
        F.round("corner_4_distance", 3).alias("corner_4_distance"),
    )
