"""Feature settings. Every list is a default argument that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names and limits that results depend on.
REQUIRED_COLUMNS = ["season", "race_round", "driver_id", "lap_number", "lap_time"]
TARGET = "lap_time"
RACE_KEYS = ["season", "race_round"]
DRIVER_RACE_KEYS = ["season", "race_round", "driver_id"]
CANDIDATE_NUMERIC = [
    "position",
    "grid_position",
    "TyreLife",
    "PitDuration",
    "humidity",
    "track_length",
    "number_of_laps",
    "corners",
    "pit_lane_length",
    "LapStart_sin",
    "LapStart_cos",
]
CANDIDATE_CATEGORICAL = ["race_direction", "grand_prix", "compound", "driver_id", "Team"]
FLAG_PREFIXES = ["Driver_", "Team_", "grand_prix_", "Compound_"]
EXCLUDE_EXACT = [
    "lap_time",
    "sector1_time",
    "sector2_time",
    "sector3_time",
    "SpeedI1",
    "SpeedI2",
    "SpeedST",
    "SpeedFL",
    "finish_position",
    "Sector1SessionTime",
    "Sector2SessionTime",
    "Sector3SessionTime",
]
EXCLUDE_PREFIXES = ["corner_", "FastF1Generated"]
LAGS = {"lap_time": [1, 2, 3], "TyreLife": [1, 2]}
MIN_LAP_SECONDS = 40.0
MAX_LAP_SECONDS = 300.0
PIT_SECONDS = 0.01
FOLDS = 5
BAND_DEFAULTS = (-1.0, 1.0)
BAND_FRACTIONS = (0.1, 0.9)


@dataclass
class FeatureConfig:
    required: list[str] = field(default_factory=lambda: list(REQUIRED_COLUMNS))
    target: str = TARGET
    group_keys: list[str] = field(default_factory=lambda: list(RACE_KEYS))
    driver_keys: list[str] = field(default_factory=lambda: list(DRIVER_RACE_KEYS))
    lap_order: list[str] = field(default_factory=lambda: ["lap_number"])
    numeric: list[str] = field(default_factory=lambda: list(CANDIDATE_NUMERIC))
    categorical: list[str] = field(default_factory=lambda: list(CANDIDATE_CATEGORICAL))
    flag_prefixes: list[str] = field(default_factory=lambda: list(FLAG_PREFIXES))
    exclude_exact: list[str] = field(default_factory=lambda: list(EXCLUDE_EXACT))
    exclude_prefixes: list[str] = field(default_factory=lambda: list(EXCLUDE_PREFIXES))
    lags: dict[str, list[int]] = field(default_factory=lambda: {k: list(v) for k, v in LAGS.items()})
    min_lap: float = MIN_LAP_SECONDS
    max_lap: float = MAX_LAP_SECONDS
    drop_pit_laps: bool = False
    wide_levels: int = 200
    n_folds: int = FOLDS
    model: dict[str, object] = field(default_factory=lambda: {"type": "hgb", "params": {}})
    fractions: tuple[float, float] = BAND_FRACTIONS

    @classmethod
    def from_dict(cls, settings: dict) -> FeatureConfig:
        """Settings in nested form, as read from a YAML file; what is missing keeps its default.

        Unknown settings are an error, so that none is ignored without a word.
        """
        check_settings(settings)
        data, filters = settings.get("data", {}), settings.get("filters", {})
        cv, bands = settings.get("cv", {}), settings.get("intervals", {}).get("alphas")
        given = {
            "required": data.get("required_columns"),
            "target": settings.get("target"),
            "group_keys": cv.get("group_by"),
            "numeric": settings.get("candidate_numeric"),
            "categorical": settings.get("candidate_categorical"),
            "flag_prefixes": settings.get("onehot_prefixes"),
            "exclude_exact": settings.get("exclude_exact"),
            "exclude_prefixes": settings.get("exclude_prefixes"),
            "lags": settings.get("lags"),
            "min_lap": filters.get("min_lap_time_sec"),
            "max_lap": filters.get("max_lap_time_sec"),
            "drop_pit_laps": filters.get("drop_pit_in_laps"),
            "n_folds": cv.get("n_splits"),
            "model": settings.get("model"),
            "fractions": tuple(bands) if bands else None,
        }
        return cls(**{k: v for k, v in given.items() if v is not None})


# The names of all settings. A group without names takes any.
SETTINGS: dict[str, set[str] | None] = {
    "data": {"required_columns", "csv_path"},
    "target": None,
    "candidate_numeric": None,
    "candidate_categorical": None,
    "onehot_prefixes": None,
    "exclude_exact": None,
    "exclude_prefixes": None,
    "lags": None,
    "filters": {"drop_pit_in_laps", "min_lap_time_sec", "max_lap_time_sec"},
    "cv": {"n_splits", "group_by"},
    "model": {"type", "params"},
    "intervals": {"alphas"},
}


def check_settings(settings: dict) -> None:
    for group, value in settings.items():
        if group not in SETTINGS:
            raise ValueError(f"unknown setting {group!r}")
        known = SETTINGS[group]
        for name in value if known else ():
            if name not in known:
                raise ValueError(f"unknown setting {group}.{name}")
