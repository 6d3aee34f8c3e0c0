"""The wide lap table: laps with results, weather at the lap start, and track features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapframe.functions.geo import haversine
from lapframe.functions.text import lat_lon
from lapframe.operators import geometry, joins


def corner_table(line: DataFrame, apexes: DataFrame, n_corners: int) -> DataFrame:
    """Per track: the length, and the distance of each corner from the one before.

    ``apexes`` comes from ``nearest_vertex`` and so has at most ``n_corners`` rows per track.
    """
    totals = geometry.track_totals(line)
    spaced = geometry.corner_spacing(apexes, totals, fits=True)
    wide = geometry.corners_wide(spaced, {"distance": "spacing_m"}, n_corners)
    return wide.join(totals.withColumnRenamed("total_m", "track_length"), "track")


def track_features(
    line: DataFrame,
    apexes: DataFrame,
    profile: DataFrame,
    samples: DataFrame,
    n_corners: int,
    speed_window_m: float = geometry.SPEED_WINDOW_M,
) -> DataFrame:
    """All corner features of every track in one plan, one row per track.

    ``line`` holds vertices with x, y and dist_m; ``apexes`` track, corner, dist_m; ``profile``
    track, distance_m, elevation_m; ``samples`` track, dist_m, speed of the representative lap.
    Line and apexes are read several times, so pass materialized tables.
    """
    totals = geometry.track_totals(line)
    spaced = geometry.corner_spacing(apexes.select("track", "corner", "dist_m"), totals, fits=True)
    radius = geometry.corner_radius(apexes, line, totals).select("track", "corner", "radius_m")
    speeds = geometry.corner_speeds(
        samples, apexes.select("track", "corner", "dist_m"), speed_window_m, speed_window_m
    ).drop("dist_m")
    heights = geometry.interpolate(
        apexes.select("track", "corner", "dist_m"), profile, "dist_m", "distance_m", ["elevation_m"]
    )
    rise = geometry.corner_elevation_change(heights, fits=True).select("track", "corner", "elev_change_m")
    corners = (
        spaced.join(radius, ["track", "corner"], "left")
        .join(rise, ["track", "corner"], "left")
        .join(speeds, ["track", "corner"], "left")
    )
    return geometry.corners_wide(
        corners,
        {
            "radius": "radius_m",
            "distance": "spacing_m",
            "elev_change": "elev_change_m",
            "entry_speed": "entry_speed",
            "exit_speed": "exit_speed",
            "max_speed": "max_speed",
        },
        n_corners,
    )


def pit_lane_length(meta: DataFrame, entry: str, leave: str) -> DataFrame:
    """Great-circle length between the "lat,lon" texts of pit entry and pit exit."""
    return meta.withColumn(
        "pit_lane_length", haversine(*lat_lon(F.col(entry)), *lat_lon(F.col(leave)))
    )


def assemble(
    laps: DataFrame,
    results: DataFrame,
    weather: DataFrame,
    tracks: DataFrame,
    result_keys: Sequence[str],
    weather_keys: Sequence[str],
    lap_time: str,
    weather_time: str,
    track_keys: Sequence[str],
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Left joins only: every lap is kept once. The as-of step runs first, on the narrow laps.

    With ``bucket_seconds`` the as-of step also splits by time, which few weather keys need.
    """
    facts = [c for c in weather.columns if c not in [*weather_keys, weather_time]]
    if bucket_seconds is None:
        rows = joins.as_of(laps, weather, weather_keys, lap_time, weather_time, facts)
    else:
        rows = joins.as_of_in_buckets(
            laps, weather, weather_keys, lap_time, weather_time, facts, bucket_seconds
        )
    rows = joins.attach(
        rows, results, result_keys, [c for c in results.columns if c not in result_keys]
    )
    return joins.attach(
        rows, tracks, track_keys, [c for c in tracks.columns if c not in track_keys]
    )
