"""Track geometry on polylines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe import bindings as b
from lapframe.catalog.registry import ENTRIES, query
from lapframe.operators import geometry
from lapframe.plans import wide_laps
from lapframe.session import materialize

_V = b.VERTICES_SQL


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(f"WITH {_V} SELECT track, idx, round(x, 4) AS x, round(y, 4) AS y FROM xy")
def local_xy(spark: SparkSession, sf: str) -> DataFrame:
    rows = geometry.local_xy(b.vertices(spark, sf)).select("track", "idx", "x", "y")
    return _round(rows, 4, "x", "y")


@query(f"WITH {_V} SELECT track, idx, round(seg_m, 4) AS seg_m, round(dist_m, 4) AS dist_m FROM line")
def polyline_cumdist(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.line(spark, sf).select("track", "idx", "seg_m", "dist_m")
    return _round(rows, 4, "seg_m", "dist_m")


@query(
    f"""WITH {_V}, {b.APEX_SQL} SELECT track, corner, idx, round(gap_m, 4) AS gap_m,
       round(dist_m, 4) AS dist_m FROM near"""
)
def nearest_centerline_point(spark: SparkSession, sf: str) -> DataFrame:
    return _round(b.apexes(spark, sf), 4, "gap_m", "dist_m")


_SPACED = """spaced AS (SELECT near.*, CAST(row_number() OVER w AS BIGINT) AS corner_no,
  dist_m - coalesce(lag(dist_m) OVER w, 0) AS spacing_m,
  CASE WHEN lead(dist_m) OVER w IS NULL THEN total_m - dist_m END AS final_straight_m
  FROM near JOIN totals USING (track) WINDOW w AS (PARTITION BY near.track ORDER BY dist_m, corner))"""


@query(
    f"""WITH {_V}, {b.APEX_SQL}, {_SPACED} SELECT track, corner, corner_no,
       round(spacing_m, 4) AS spacing_m, round(final_straight_m, 4) AS final_straight_m FROM spaced"""
)
def corner_spacing(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    rows = geometry.corner_spacing(b.apexes(spark, sf, line), geometry.track_totals(line), fits=True)
    return _round(
        rows.select("track", "corner", "corner_no", "spacing_m", "final_straight_m"),
        4,
        "spacing_m",
        "final_straight_m",
    )


@query(
    f"""WITH {_V}, {b.APEX_SQL},
    e AS (SELECT near.track, corner, near.dist_m, elevation_m FROM near
          JOIN line ON near.track = line.track AND near.idx = line.idx)
    SELECT track, corner, round(elevation_m, 7) AS elevation_m,
      round(lead(elevation_m) OVER (PARTITION BY track ORDER BY dist_m, corner) - elevation_m, 7) AS elev_change_m
    FROM e"""
)
def corner_elev_change(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    apexes = materialize(b.apexes(spark, sf, line).select("track", "corner", "dist_m"))
    heights = geometry.interpolate(apexes, line, "dist_m", "dist_m", ["elevation_m"])
    rows = geometry.corner_elevation_change(heights, fits=True)
    return _round(
        rows.select("track", "corner", "elevation_m", "elev_change_m"),
        7,
        "elevation_m",
        "elev_change_m",
    )



@query(
    f"""WITH {_V},
    seg AS (SELECT *, lead(dist_m) OVER w AS next_m, lead(elevation_m) OVER w AS next_e,
              idx = 0 AS is_first FROM line WINDOW w AS (PARTITION BY track ORDER BY idx)),
    spots AS (SELECT track, k, total_m * (k - 1) / 8.0 AS at_m FROM totals, (SELECT unnest(range(0, 11)) AS k)),
    hit AS (SELECT s.track, k, at_m, dist_m, next_m, elevation_m, next_e,
              row_number() OVER (PARTITION BY s.track, k ORDER BY dist_m DESC) AS rn
            FROM spots s JOIN seg ON s.track = seg.track AND (at_m >= dist_m OR is_first))
    SELECT track, CAST(k AS INT) AS k, round(at_m, 3) AS at_m, round(CASE WHEN next_m IS NULL THEN elevation_m
      ELSE elevation_m + (next_e - elevation_m) * greatest((at_m - dist_m) / (next_m - dist_m), 0) END, 6)
      AS elevation_m FROM hit WHERE rn = 1"""
)
def interp_elevation(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    # From one eighth before the start to one eighth beyond the end, to meet both clamps.
    spots = geometry.track_totals(line).select(
        "track", "total_m", F.explode(F.sequence(F.lit(0), F.lit(10))).alias("k")
    )
    spots = spots.select("track", "k", (F.col("total_m") * (F.col("k") - 1) / 8.0).alias("at_m"))
    rows = geometry.interpolate(spots, line, "at_m", "dist_m", ["elevation_m"])
    return _round(_round(rows, 3, "at_m"), 6, "elevation_m")


@query(
    f"""WITH {_V}, {b.APEX_SQL},
    seg AS (SELECT *, lead(dist_m) OVER w AS next_m, lead(x) OVER w AS next_x, lead(y) OVER w AS next_y
            FROM line WINDOW w AS (PARTITION BY track ORDER BY idx)),
    probes AS (SELECT track, corner, dist_m AS apex_m, s,
                greatest(0, least(total_m, dist_m + (s - 1) * 15.0)) AS at_m
              FROM near JOIN totals USING (track), (SELECT unnest([0, 1, 2]) AS s)),
    hit AS (SELECT p.*, seg.dist_m, next_m, x, y, next_x, next_y,
              row_number() OVER (PARTITION BY p.track, corner, s ORDER BY seg.dist_m DESC) AS rn
            FROM probes p JOIN seg ON p.track = seg.track AND at_m >= seg.dist_m),
    pt AS (SELECT track, corner, s, coalesce(x + (next_x - x) * (at_m - dist_m) / (next_m - dist_m), x) AS x,
             coalesce(y + (next_y - y) * (at_m - dist_m) / (next_m - dist_m), y) AS y FROM hit WHERE rn = 1),
    t AS (SELECT track, corner, max(x) FILTER (s = 0) AS ax, max(y) FILTER (s = 0) AS ay,
            max(x) FILTER (s = 1) AS bx, max(y) FILTER (s = 1) AS bq,
            max(x) FILTER (s = 2) AS cx, max(y) FILTER (s = 2) AS cy FROM pt GROUP BY ALL),
    d AS (SELECT *, (bx - ax) * (cy - ay) - (cx - ax) * (bq - ay) AS det FROM t)
    SELECT track, corner, CASE WHEN abs(det) >= 1e-6 THEN round(
      sqrt(pow(bx - ax, 2) + pow(bq - ay, 2)) * sqrt(pow(cx - bx, 2) + pow(cy - bq, 2)) *
      sqrt(pow(ax - cx, 2) + pow(ay - cy, 2)) / (2 * abs(det)), 3) END AS radius_m FROM d"""
)
def corner_radius(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    apexes = materialize(b.apexes(spark, sf, line))
    rows = geometry.corner_radius(apexes, line, geometry.track_totals(line))
    return _round(rows.select("track", "corner", "radius_m"), 3, "radius_m")


# Spherical distances from vertex to vertex.
_SPHERE = """arcs AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM vertices
  WINDOW w AS (PARTITION BY track ORDER BY idx)),
chord AS (SELECT *, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) *
  pow(sin(radians(lon - plon) / 2), 2) AS a FROM arcs),
arc AS (SELECT *, coalesce(2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)), 0) AS arc_m FROM chord),
path AS (SELECT *, sum(arc_m) OVER (PARTITION BY track ORDER BY idx) AS at_m FROM arc),
span AS (SELECT *, coalesce(lag(at_m) OVER (PARTITION BY track ORDER BY idx), 0) AS from_m FROM path)"""


@query(
    f"""WITH {_V}, {_SPHERE}, ends AS (SELECT track, max(at_m) AS total FROM path GROUP BY track),
    marks AS (SELECT track, total, unnest(range(0, CAST(ceil(total / 10.0) AS BIGINT))) * 10.0 AS sample_m FROM ends),
    inner_ AS (SELECT m.track, sample_m,
        CASE WHEN sample_m = 0 THEN lon ELSE plon + (lon - plon) * (sample_m - from_m) / (at_m - from_m) END AS lon,
        CASE WHEN sample_m = 0 THEN lat ELSE plat + (lat - plat) * (sample_m - from_m) / (at_m - from_m) END AS lat
      FROM marks m JOIN span s ON m.track = s.track
        AND ((sample_m = 0 AND idx = 0) OR (sample_m > from_m AND sample_m <= at_m)))
    SELECT track, round(sample_m, 3) AS sample_m, round(lon, 8) AS lon, round(lat, 8) AS lat FROM inner_
    UNION ALL SELECT track, round(at_m, 3), round(lon, 8), round(lat, 8) FROM span WHERE idx = 31"""
)
def resample_polyline(spark: SparkSession, sf: str) -> DataFrame:
    segments = geometry.sphere_segments(b.vertices(spark, sf))
    rows = geometry.resample(segments)
    return _round(_round(rows, 3, "sample_m"), 8, "lon", "lat")


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.sphere_segments(b.vertices(spark, sf)).select(
        "track",
        F.col("dist_m").alias("distance_m"),
        F.when(F.col("idx") != 9, F.col("elevation_m")).alias("elevation_m"),
    )


_DELTA = """profile AS (SELECT track, at_m AS distance_m, CASE WHEN idx <> 9 THEN elevation_m END AS elevation_m
  FROM path),
deltas AS (SELECT *, coalesce(elevation_m - lag(elevation_m) OVER
  (PARTITION BY track ORDER BY distance_m), 0) AS elev_delta_m FROM profile)"""


@query(
    f"""WITH {_V}, {_SPHERE}, {_DELTA} SELECT track, round(distance_m, 3) AS distance_m,
       elevation_m, round(elev_delta_m, 9) AS elev_delta_m FROM deltas"""
)
def elevation_profile_delta(spark: SparkSession, sf: str) -> DataFrame:
    rows = geometry.elevation_deltas(_profile(spark, sf))
    return _round(_round(rows, 3, "distance_m"), 9, "elev_delta_m")


@query(
    f"""WITH {_V}, {_SPHERE}, {_DELTA} SELECT track, round(max(distance_m), 3) AS lap_length_m,
       round(max(elevation_m) - min(elevation_m), 8) AS total_elev_change,
       round(coalesce(sum(elev_delta_m) FILTER (elev_delta_m > 0), 0), 8) AS total_up_m,
       round(coalesce(-sum(elev_delta_m) FILTER (elev_delta_m < 0), 0), 8) AS total_down_m
       FROM deltas GROUP BY track"""
)
def elevation_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = geometry.elevation_summary(geometry.elevation_deltas(_profile(spark, sf)))
    return _round(
        _round(rows, 3, "lap_length_m"), 8, "total_elev_change", "total_up_m", "total_down_m"
    )


# Telemetry: one sample per vertex and one between, with a speed made from the elevation.
_SAMPLES = """mid AS (SELECT track, dist_m - seg_m / 2 AS dist_m, 200 - 100 * elevation_m AS speed FROM line
  UNION ALL SELECT track, dist_m, 200 + 100 * elevation_m FROM line)"""


def _samples(line: DataFrame) -> DataFrame:
    return line.select(
        "track",
        F.explode(
            F.array(
                F.struct(
                    (F.col("dist_m") - F.col("seg_m") / 2).alias("dist_m"),
                    (200 - 100 * F.col("elevation_m")).alias("speed"),
                ),
                F.struct("dist_m", (200 + 100 * F.col("elevation_m")).alias("speed")),
            )
        ).alias("_s"),
    ).select("track", "_s.*")


@query(
    f"""WITH {_V}, {b.APEX_SQL}, {_SAMPLES},
    hit AS (SELECT n.track, corner, s.dist_m, speed FROM near n JOIN mid s ON n.track = s.track
            AND s.dist_m BETWEEN greatest(0, n.dist_m - 900) AND n.dist_m + 900)
    SELECT track, corner, round(first(speed ORDER BY dist_m, speed), 6) AS entry_speed,
      round(last(speed ORDER BY dist_m, speed), 6) AS exit_speed, round(max(speed), 6) AS max_speed
    FROM hit GROUP BY track, corner"""
)
def corner_speeds(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    apexes = materialize(b.apexes(spark, sf, line).select("track", "corner", "dist_m"))
    rows = geometry.corner_speeds(_samples(line), apexes, 900.0, 900.0)
    return _round(rows.drop("dist_m"), 6, "entry_speed", "exit_speed", "max_speed")


_MEASURES = {
    "radius": "radius_m",
    "distance": "spacing_m",
    "elev_change": "elev_change_m",
    "entry_speed": "entry_speed",
    "exit_speed": "exit_speed",
    "max_speed": "max_speed",
}
_PARTS = ("corner_spacing", "corner_radius", "corner_elev_change", "corner_speeds")


@query(
    "WITH "
    + ", ".join(f"part_{n} AS ({ENTRIES[n].sql})" for n in _PARTS)
    + " SELECT track, "
    + ", ".join(
        f"max({column}) FILTER (corner_no = {i}) AS corner_{i}_{name}"
        for i in range(1, len(b.APEX_VERTICES) + 1)
        for name, column in _MEASURES.items()
    )
    + " FROM "
    + " JOIN ".join(f"part_{n}" + (" USING (track, corner)" if i else "") for i, n in enumerate(_PARTS))
    + " GROUP BY track"
)
def track_features(spark: SparkSession, sf: str) -> DataFrame:
    line = materialize(b.line(spark, sf))
    apexes = materialize(b.apexes(spark, sf, line))
    profile = line.select("track", F.col("dist_m").alias("distance_m"), "elevation_m")
    n = len(b.APEX_VERTICES)
    wide = wide_laps.track_features(line, apexes, profile, _samples(line), n, 900.0)
    digits = {"radius": 3, "distance": 4, "elev_change": 7}
    return wide.select(
        "track",
        *[
            F.round(f"corner_{i}_{name}", digits.get(name, 6)).alias(f"corner_{i}_{name}")
            for i in range(1, n + 1)
            for name in _MEASURES
        ],
    )
