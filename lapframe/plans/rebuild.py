"""From landed folders to the wide lap table, in one call."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lapframe.functions.geo import plane_x, plane_y
from lapframe.functions.text import lat_lon, slug
from lapframe.operators import clean, geometry
from lapframe.plans import landing, wide_laps
from lapframe.schema import WEATHER_DOCUMENT
from lapframe.session import materialize
from lapframe.sources import readers, writers

EVENT = ["season", "race_round"]


@dataclass(frozen=True)
class Folders:
    """Where the sources have landed. ``tracks`` is a metadata CSV; the others are folders."""

    laps: str  # CSV or Parquet with season, race_round, grand_prix, lap_start and a source's lap columns
    results: str  # Parquet with season, race_round and a source's result columns
    weather: str  # {year}/{slug}/{label}_{date}.json
    centerlines: str  # {slug}.geojson
    profiles: str  # *elevation_profile.csv
    tracks: str  # slug, and corner_{i}_coords as "lat,lon"


def weather_hours(spark: SparkSession, root: str) -> DataFrame:
    """One row per hour of every landed document: season, slug, weather_time and readings."""
    docs = readers.weather_documents(spark, root, WEATHER_DOCUMENT)
    hours = docs.select("year", "slug", F.explode("days").alias("d")).select(
        "year", "slug", F.col("d.datetime").alias("day"), F.inline("d.hours")
    )
    return hours.select(
        F.col("year").alias("season"),
        "slug",
        F.concat_ws(" ", "day", "datetime").try_cast("timestamp").alias("weather_time"),
        F.col("temp").alias("temperature"),
        "humidity",
        "conditions",
    ).where(F.col("weather_time").isNotNull())


def apexes(line: DataFrame, tracks: DataFrame, corners: Sequence[str]) -> DataFrame:
    """The nearest vertex of each corner of the metadata, in the plane of its track."""
    placed = tracks.join(geometry.origins(line).withColumnRenamed("track", "slug"), "slug")
    names = [c.removesuffix("_coords") for c in corners]
    spots = {}
    for name, column in zip(names, corners):
        lat, lon = lat_lon(F.col(column))
        spots[f"{name}_x"] = plane_x(lon, F.col("lat0"), F.col("lon0"))
        spots[f"{name}_y"] = plane_y(lat, F.col("lat0"))
    wide = placed.select(F.col("slug").alias("track"), *[e.alias(n) for n, e in spots.items()])
    return geometry.nearest_vertex(line, wide, names)


def track_table(spark: SparkSession, folders: Folders) -> DataFrame:
    """One row per track: length, corner distances, and what its elevation profile says.

    A track without a profile is an error, as in ``readers.require_profiles``.
    """
    tracks = spark.read.option("header", "true").csv(folders.tracks)
    tracks = materialize(clean.trim_names(tracks), "tracks")
    corners = [c for c in tracks.columns if c.startswith("corner_") and c.endswith("_coords")]
    line = materialize(geometry.plane_distance(geometry.local_xy(readers.centerlines(spark, folders.centerlines))), "line")
    profiles = materialize(readers.elevation_profiles(spark, folders.profiles), "profiles")
    readers.require_profiles(tracks.select(F.col("slug").alias("track")), profiles)
    wide = wide_laps.corner_table(line, apexes(line, tracks, corners), n_corners=len(corners))
    heights = geometry.elevation_summary(geometry.elevation_deltas(profiles.drop("elev_delta_m")))
    return wide.join(heights, "track", "left").withColumnRenamed("track", "slug")


def wide_table(spark: SparkSession, folders: Folders, lap_schema: T.StructType | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Every landed lap once, with its results, the weather at its start, and its track.

    Weather is that of the same season and event. ``extra`` names more lap columns to keep. Pass the schema of
    the laps where there are many files.
    """
    laps = readers.lap_files(spark, folders.laps, lap_schema, lap_schema)
    named = [n for o, n in landing.EVENT_LAPS.items() if o in laps.columns or n in laps.columns]
    kept = [*EVENT, "grand_prix", *named, "lap_start", *extra]
    laps = clean.normalize(laps, landing.EVENT_LAPS, kept, [*EVENT, "driver_id"], strict=True)
    laps = laps.withColumn("slug", slug(F.col("grand_prix")))
    results = readers.parquet(spark, [folders.results])
    facts = [n for o, n in landing.RESULTS.items() if n != "driver_id" and (o in results.columns or n in results.columns)]
    results = clean.normalize(results, landing.RESULTS, [*EVENT, "driver_id", *facts], [*EVENT, "driver_id"], strict=True)
    results = readers.one_per_key(results, [*EVENT, "driver_id"], facts)
    return wide_laps.assemble(
        clean.require_rows(laps, "laps"),
        results,
        weather_hours(spark, folders.weather).withColumn("season", F.col("season").cast("bigint")),
        track_table(spark, folders),
        result_keys=[*EVENT, "driver_id"],
        weather_keys=["season", "slug"],
        lap_time="lap_start",
        weather_time="weather_time",
        track_keys=["slug"],
    )


def rebuild(spark: SparkSession, folders: Folders, target: str, **settings) -> DataFrame:
    """The wide lap table written below ``target`` by season and round, and read back.

    Only the events that have landed are replaced, so a call with the laps of one event renews that event.
    """
    wide = wide_table(spark, folders, **settings)
    writers.land_partitions(wide, target, EVENT)
    return spark.read.schema(wide.schema).parquet(target).select(*wide.columns)
