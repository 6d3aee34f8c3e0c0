"""Scans of landed files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lapframe import schema
from lapframe.functions.text import slug
from lapframe.operators import geometry
from lapframe.operators.clean import trim_names


def parquet(
    spark: SparkSession, paths: Sequence[str], columns: T.StructType | None = None
) -> DataFrame:
    """Parquet files or folders as one table; columns a file lacks are null, and so is NaN.

    Pass the schema for many files: without one the footer of every file is read.
    """
    reader = spark.read.schema(columns) if columns else spark.read.option("mergeSchema", "true")
    return schema.nan_to_null(reader.parquet(*paths))


def lap_csv(
    spark: SparkSession, path: str | Sequence[str], columns: T.StructType | None = None
) -> DataFrame:
    """A wide lap CSV with trimmed names and NaN as null. Pass the schema for big inputs:
    without one the file is read twice to infer it."""
    reader = spark.read.option("header", "true").option("nanValue", "NaN")
    reader = reader.schema(columns) if columns else reader.option("inferSchema", "true")
    return schema.nan_to_null(trim_names(reader.csv(path)))


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name; missing columns are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _any_file(spark: SparkSession, root: str, pattern: str) -> bool:
    """Whether a file below root matches. Only the path column is read, never a body."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return not files.select("path").isEmpty()


def lap_files(
    spark: SparkSession,
    root: str,
    csv_schema: T.StructType | None = None,
    parquet_schema: T.StructType | None = None,
) -> DataFrame:
    """Every CSV and Parquet file below a dataset folder, united by column name; NaN is null."""
    found = []
    if _any_file(spark, root, "*.csv"):
        reader = (
            spark.read.option("header", "true")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv")
        )
        reader = reader.schema(csv_schema) if csv_schema else reader.option("inferSchema", "true")
        found.append(schema.nan_to_null(trim_names(reader.csv(root))))
    if _any_file(spark, root, "*.parquet"):
        reader = spark.read.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet"
        )
        reader = (
            reader.schema(parquet_schema) if parquet_schema else reader.option("mergeSchema", "true")
        )
        found.append(schema.nan_to_null(reader.parquet(root)))
    if not found:
        raise FileNotFoundError(f"no CSV or Parquet files below {root}")
    return unite(found)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows fetched twice collapse to the first in order; a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def newest_landing(df: DataFrame) -> DataFrame:
    """Only the rows of the folder that was written to last, from all of its files.

    A landing of several files has several times of writing; they count as one by their folder.
    """
    folder, written = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1), F.col("_metadata.file_modification_time")
    newest = df.select(F.max_by(folder, F.struct(written, folder))).scalar()
    return df.withColumn("_folder", folder).where(F.col("_folder") == newest).drop("_folder")


def newest_files(df: DataFrame) -> DataFrame:
    """Only the rows that come from the file written last."""
    stamped = df.withColumn("_written", F.col("_metadata.file_modification_time"))
    newest = df.select(F.max(F.col("_metadata.file_modification_time"))).scalar()
    return stamped.where(F.col("_written") == newest).drop("_written")


def weather_documents(spark: SparkSession, root: str, body: T.StructType) -> DataFrame:
    """Raw weather documents below {year}/{slug}/{label}_{date}.json with the path fields."""
    path = F.col("_metadata.file_path")
    tail = r"([0-9]{4})/([^/]+)/([^/]+)_([0-9]{4}-[0-9]{2}-[0-9]{2})\.json$"
    return (
        spark.read.schema(body)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .json(root)
        .select(
            F.regexp_extract(path, tail, 1).try_cast("int").alias("year"),
            F.regexp_extract(path, tail, 2).alias("slug"),
            F.regexp_extract(path, tail, 3).alias("label"),
            F.regexp_extract(path, tail, 4).try_cast("date").alias("date"),
            *body.names,
        )
    )


def centerlines(spark: SparkSession, root: str) -> DataFrame:
    """Vertices (track, idx, lon, lat) of the first feature of every GeoJSON file in a folder."""
    docs = (
        spark.read.schema(schema.CENTERLINE)
        .option("multiLine", "true")
        .option("pathGlobFilter", "*.geojson")
        .json(root)
    )
    named = docs.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.geojson$", 1).alias("track"),
        F.col("features")[0]["geometry"]["coordinates"].alias("coordinates"),
    )
    return geometry.vertices(named, "track", "coordinates")


def track_metadata(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    return trim_names(spark.read.option("header", "true").schema(columns).csv(path))


def elevation_profiles(spark: SparkSession, root: str) -> DataFrame:
    """All profiles below a folder; the track is a column of the files."""
    return schema.nan_to_null(
        spark.read.option("header", "true")
        .schema(schema.ELEVATION_PROFILE)
        .option("pathGlobFilter", "*elevation_profile.csv")
        .option("recursiveFileLookup", "true")
        .csv(root)
    )


def require_profiles(tracks: DataFrame, profiles: DataFrame) -> None:
    """Fail, naming one track, when a track has no elevation profile."""
    missing = tracks.select("track").join(profiles.select("track"), "track", "left_anti").first()
    if missing:
        raise FileNotFoundError(f"no elevation profile for {missing['track']}")


def track_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """A coordinates CSV with loosely named columns as gp, lat, lon, slug."""
    raw = spark.read.option("header", "true").csv(path)

    def pick(*words: str, default: str | None = None) -> str:
        for name in raw.columns:
            if any(w in name.lower() for w in words):
                return name
        if default is None:
            raise ValueError(f"no column named like {words[0]!r} in {path}")
        return default

    name = pick("grand", "event", default=raw.columns[0])
    return raw.select(
        F.col(f"`{name}`").alias("gp"),
        F.col(f"`{pick('lat')}`").try_cast("double").alias("lat"),
        F.col(f"`{pick('lon')}`").try_cast("double").alias("lon"),
    ).withColumn("slug", slug(F.col("gp")))
