"""Schemas of the landed tables, and the null convention: NULL is the only missing value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

LAP_CORE = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("race_round", T.IntegerType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("lap_number", T.LongType()),
        T.StructField("lap_time", T.DoubleType()),
    ]
)

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("engine_rpm", T.DoubleType()),
        T.StructField("gear", T.IntegerType()),
        T.StructField("throttle_pct", T.DoubleType()),
        T.StructField("brake_pressure", T.DoubleType()),
        T.StructField("drs_active", T.IntegerType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("season", T.IntegerType()),
        T.StructField("grand_prix", T.StringType()),
    ]
)

LIVE_MESSAGE = T.StructType(
    [
        T.StructField("driver_id", T.LongType()),
        T.StructField("tire_temp_avg", T.DoubleType()),
        T.StructField("tire_temp_std", T.DoubleType()),
    ]
)

ELEVATION_PROFILE = T.StructType(
    [
        T.StructField("track", T.StringType()),
        T.StructField("distance_m", T.DoubleType()),
        T.StructField("elevation_m", T.DoubleType()),
        T.StructField("elev_delta_m", T.DoubleType()),
    ]
)

# The part of a landed weather document that is read.
_HOUR = (
    T.StructType().add("datetime", "string").add("temp", "double").add("humidity", "double").add("conditions", "string")
)
WEATHER_DOCUMENT = T.StructType().add(
    "days", T.ArrayType(T.StructType().add("datetime", "string").add("hours", T.ArrayType(_HOUR)))
)

CENTERLINE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [
                                    T.StructField(
                                        "coordinates", T.ArrayType(T.ArrayType(T.DoubleType()))
                                    )
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, because Spark aggregates propagate NaN."""
    return df.select(
        *[
            F.when(F.isnan(F.col(f.name)), None).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema
        ]
    )
