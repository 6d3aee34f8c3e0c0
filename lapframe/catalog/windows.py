"""Ordered features per driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.registry import query, settled, settled_sql
from lapframe.operators import clean, features

_ORDER = 'PARTITION BY season, race_round, driver_id ORDER BY lap_number, car_part, lap_time, "TyreLife"'


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, lap_time, "TyreLife",
       lag(lap_time, 1) OVER w AS lap_time_lag1, lag(lap_time, 2) OVER w AS lap_time_lag2,
       lag(lap_time, 3) OVER w AS lap_time_lag3, lag("TyreLife", 1) OVER w AS "TyreLife_lag1",
       lag("TyreLife", 2) OVER w AS "TyreLife_lag2" FROM clean WINDOW w AS ({_ORDER})"""
)
def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(
        *config.REQUIRED_COLUMNS, "car_part", "TyreLife"
    )
    return features.lag_features(laps, config.DRIVER_RACE_KEYS, b.LAP_ORDER, config.LAGS)


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, lap_time,
       {settled_sql("avg(lap_time) OVER w", 9)} AS lap_time_roll_mean,
       {settled_sql("stddev_samp(lap_time) OVER w")} AS lap_time_roll_std
       FROM clean WINDOW w AS ({_ORDER} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""
)
def rolling_lap_stats(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(
        *config.REQUIRED_COLUMNS, "car_part", "TyreLife"
    )
    rows = features.rolling_stats(laps, config.DRIVER_RACE_KEYS, b.LAP_ORDER, "lap_time", 5)
    return rows.drop("TyreLife").withColumns(
        {
            "lap_time_roll_mean": settled("lap_time_roll_mean", 9),
            "lap_time_roll_std": settled("lap_time_roll_std"),
        }
    )


_PIT = """pits AS (SELECT event_id, user_id, ts,
  CASE WHEN event_type = 'signup' THEN ts END AS pit_in,
  CASE WHEN event_type IN ('signup', 'view') THEN
    ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS pit_out FROM events)"""


@query(
    f"""WITH {_PIT}, nxt AS (SELECT *, lead(pit_out) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS out2
         FROM pits)
    SELECT event_id, CASE WHEN pit_in IS NOT NULL THEN event_id END AS pit_stop_lap,
      (epoch_us(pit_out) - epoch_us(pit_in)) / 1e6 AS pit_stop_duration,
      (epoch_us(out2) - epoch_us(pit_in)) / 1e6 AS next_lap_duration FROM nxt"""
)
def pit_stops(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    out = F.timestamp_micros(F.unix_micros(ts) + F.round(F.col("value") * 1_000_000).cast("bigint"))
    events = b.table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("event_type") == "signup", ts).alias("pit_in"),
        F.when(F.col("event_type").isin("signup", "view"), out).alias("pit_out"),
    )
    same = features.pit_stops(events, "event_id", "pit_in", "pit_out")
    late = features.pit_stops_next_lap(
        same.withColumnRenamed("pit_stop_duration", "same_row"),
        ["user_id"],
        ["ts", "event_id"],
        "event_id",
        "pit_in",
        "pit_out",
    )
    return late.select(
        "event_id",
        "pit_stop_lap",
        F.col("same_row").alias("pit_stop_duration"),
        F.col("pit_stop_duration").alias("next_lap_duration"),
    )
