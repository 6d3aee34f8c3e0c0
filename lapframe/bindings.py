"""Roles of the generic test tables: which columns play laps, telemetry, weather and tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe.operators import geometry

LAP_ORDER = ["lap_number", "car_part", "lap_time", "TyreLife"]
TRACK_VERTICES = 32
APEX_VERTICES = (4, 12, 20, 28)
DEGREES = 0.01


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def laps(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.year("l_shipdate").alias("season"),
        F.month("l_shipdate").alias("race_round"),
        F.col("l_suppkey").alias("driver_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("lap_number"),
        (F.col("l_extendedprice") / 1000).alias("lap_time"),
        F.col("l_partkey").alias("car_part"),
        F.col("l_quantity").alias("TyreLife"),
        F.col("l_discount").alias("PitDuration"),
        F.col("l_tax").alias("humidity"),
        F.col("l_linenumber").cast("double").alias("position"),
        F.col("l_returnflag").alias("compound"),
        F.col("l_linestatus").alias("team"),
        F.col("l_shipdate").alias("lap_start"),
    )


LAPS_SQL = """laps AS (
  SELECT CAST(year(l_shipdate) AS INT) AS season, CAST(month(l_shipdate) AS INT) AS race_round,
         l_suppkey AS driver_id, l_orderkey * 10 + l_linenumber AS lap_number,
         l_extendedprice / 1000 AS lap_time, l_partkey AS car_part, l_quantity AS "TyreLife",
         l_discount AS "PitDuration", l_tax AS humidity, CAST(l_linenumber AS DOUBLE) AS position,
         l_returnflag AS compound, l_linestatus AS team, l_shipdate AS lap_start
  FROM lineitem),
clean AS (SELECT * FROM laps WHERE lap_time BETWEEN 40 AND 300)"""


def flagged_laps(spark: SparkSession, sf: str) -> DataFrame:
    """Laps whose compound and team come as 0/1 flags instead of text."""
    rows = laps(spark, sf)
    for value in ("A", "N", "R"):
        rows = rows.withColumn(f"Compound_{value}", (F.col("compound") == value).cast("double"))
    for value in ("F", "O"):
        rows = rows.withColumn(f"Team_{value}", (F.col("team") == value).cast("double"))
    return rows.drop("compound", "team")


def vertices(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding as a line of 32 (lon, lat) vertices with an elevation."""
    e = table(spark, sf, "embeddings")
    pairs = e.select(
        F.col("vec_id").alias("track"), F.col("embedding").cast("array<double>").alias("e")
    ).select(
        "track", "e", F.explode(F.sequence(F.lit(0), F.lit(TRACK_VERTICES - 1))).alias("idx")
    )
    lon, lat = F.get("e", F.col("idx") * 2), F.get("e", F.col("idx") * 2 + 1)
    return pairs.select(
        "track",
        "idx",
        (lon * DEGREES).alias("lon"),
        (lat * DEGREES).alias("lat"),
        lon.alias("elevation_m"),
    )


VERTICES_SQL = """pairs AS (
  SELECT vec_id AS track, embedding AS e, unnest(range(0, 32)) AS i FROM embeddings),
vertices AS (
  SELECT track, CAST(i AS INT) AS idx, CAST(e[2 * i + 1] AS DOUBLE) * 0.01 AS lon,
         CAST(e[2 * i + 2] AS DOUBLE) * 0.01 AS lat, CAST(e[2 * i + 1] AS DOUBLE) AS elevation_m
  FROM pairs),
xy AS (
  SELECT *, 6371000.0 * radians(lon - first_value(lon) OVER w) * cos(radians(first_value(lat) OVER w)) AS x,
         6371000.0 * radians(lat - first_value(lat) OVER w) AS y
  FROM vertices WINDOW w AS (PARTITION BY track ORDER BY idx)),
steps AS (
  SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0) AS seg_m
  FROM xy WINDOW w AS (PARTITION BY track ORDER BY idx)),
line AS (
  SELECT *, sum(seg_m) OVER (PARTITION BY track ORDER BY idx) AS dist_m FROM steps),
totals AS (SELECT track, max(dist_m) AS total_m FROM line GROUP BY track)"""


def line(spark: SparkSession, sf: str) -> DataFrame:
    """Vertices with x, y, seg_m and dist_m in the local plane."""
    return geometry.plane_distance(geometry.local_xy(vertices(spark, sf)))


# Where each apex lies relative to its vertex, in metres.
APEX_SHIFT_M = 3.0


def apex_columns(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """One row per track with the x and y of four apexes, from the track's own vertices."""
    xy = geometry.local_xy(vertices(spark, sf)).where(F.col("idx").isin(*APEX_VERTICES))
    names = [f"c{i}" for i in range(1, len(APEX_VERTICES) + 1)]
    wide = xy.groupBy("track").agg(
        *[
            (F.max(F.when(F.col("idx") == v, F.col(axis))) + APEX_SHIFT_M).alias(f"{n}_{axis}")
            for n, v in zip(names, APEX_VERTICES)
            for axis in ("x", "y")
        ]
    )
    return wide, names


APEX_SQL = """spots(corner, v) AS (VALUES ('c1', 4), ('c2', 12), ('c3', 20), ('c4', 28)),
apexes AS (
  SELECT track, corner, x + 3.0 AS ax, y + 3.0 AS ay FROM xy JOIN spots ON idx = v),
near AS (
  SELECT * FROM (
    SELECT a.track, corner, sqrt(pow(x - ax, 2) + pow(y - ay, 2)) AS gap_m, idx, dist_m,
           row_number() OVER (PARTITION BY a.track, corner
                              ORDER BY sqrt(pow(x - ax, 2) + pow(y - ay, 2)), idx) AS rn
    FROM apexes a JOIN line l ON a.track = l.track) WHERE rn = 1)"""


def apexes(spark: SparkSession, sf: str, points: DataFrame | None = None) -> DataFrame:
    """The projected apexes: track, corner, gap_m, idx, dist_m. At most four rows per track."""
    wide, names = apex_columns(spark, sf)
    return geometry.nearest_vertex(line(spark, sf) if points is None else points, wide, names)
