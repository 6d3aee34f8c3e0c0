"""From what the three lap sources deliver to the common lap and telemetry tables.

Each map renames a source's columns. Keys that are no whole numbers fail the query, intervals become
seconds, and what a source does not deliver stays out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lapframe.functions.text import slug
from lapframe.operators import clean, features, joins
from lapframe.sources.readers import unite

# Column names of the sources and what they are called here.
SECTORS = {
    "Sector1Time": "sector1_time",
    "Sector2Time": "sector2_time",
    "Sector3Time": "sector3_time",
}
LAPS = {"DriverNumber": "driver_id", "LapNumber": "lap_number", "LapTime": "lap_time", **SECTORS}
EVENT_LAPS = {**LAPS, "Position": "position"}
RESULTS = {
    "DriverNumber": "driver_id",
    "GridPosition": "grid_position",
    "Position": "finish_position",
    "Compound": "compound",
}
TV_LAPS = {**LAPS, "GridPosition": "grid_position", "FinishPosition": "finish_position"}
TELEMETRY = {
    "Time": "timestamp",
    "Speed": "speed",
    "RPM": "engine_rpm",
    "nGear": "gear",
    "Throttle": "throttle_pct",
    "Brake": "brake_pressure",
    "DRS": "drs_active",
    "DriverNumber": "driver_id",
}
WEATHER = {
    "Conditions": "conditions",
    "Temperature": "temperature",
    "Humidity": "humidity",
    "TrackTemperature": "tracktemperature",
}


def _named(df: DataFrame, renames: dict[str, str], keys: list[str], extra: list[str], literals: dict) -> DataFrame:
    kept = [n for o, n in renames.items() if o in df.columns or n in df.columns]
    more = [c for c in extra if c in df.columns]
    return clean.normalize(df, renames, [*literals, *kept, *more], keys, literals, strict=True)


def event_laps(laps: DataFrame, season: int, event: str) -> DataFrame:
    """The laps of one event with sector times and positions."""
    return _named(laps, EVENT_LAPS, ["driver_id"], [], {"season": season, "grand_prix": event})


def telemetry(samples: DataFrame, season: int, event: str) -> DataFrame:
    return _named(samples, TELEMETRY, ["driver_id"], [], {"season": season, "grand_prix": event})


def historical_laps(
    laps: DataFrame, results: DataFrame, weather: DataFrame, season: int, race_round: int, event: str
) -> DataFrame:
    """Laps with the driver's grid and finish, and the last weather row of the session.

    ``weather`` has a ``Time`` column; columns it lacks are null.
    """
    literals = {"season": season, "race_round": race_round}
    rows = _named(laps, LAPS, ["driver_id"], ["PitInTime", "PitOutTime"], literals)
    facts = _named(results, RESULTS, ["driver_id"], [], {})
    rows = joins.attach(rows, facts, ["driver_id"], [c for c in facts.columns if c != "driver_id"])
    named = weather.withColumnsRenamed(WEATHER).withColumn("season", F.lit(season))
    rows = joins.last_snapshot(rows, named, ["season"], ["Time"], list(WEATHER.values()))
    return rows.withColumn("grand_prix", slug(F.lit(event)))


def tv_laps(laps: DataFrame, season: int, event: str) -> DataFrame:
    """Laps with the lap and the duration of each pit stop."""
    literals = {"season": season, "grand_prix": event}
    stops = features.pit_stops(laps, "LapNumber", "PitInTime", "PitOutTime")
    return _named(stops, TV_LAPS, ["driver_id"], ["pit_stop_lap", "pit_stop_duration"], literals)


def all_laps(*landed: DataFrame) -> DataFrame:
    """The laps of any number of events and sources as one table."""
    return unite([clean.intervals_to_seconds(df) for df in landed])
