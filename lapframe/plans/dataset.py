"""From raw laps to the feature frame used for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lapframe.config import FeatureConfig
from lapframe.functions.text import group_key
from lapframe.operators import clean, features, levels as dictionaries
from lapframe.session import max_group_rows


#: Added to the names of text columns that go to the sparse encoder.
SPARSE = "_text"


@dataclass
class FeatureSet:
    """One frame with keys, target, group and features side by side, never split and realigned.

    ``names``, ``levels`` and ``sparse`` are the choices made on the training data. Passing them back
    to ``build`` gives a scoring frame with exactly the same columns. ``sparse`` are text columns with
    very many values, which the frame holds as they are for the sparse encoder.
    """

    frame: DataFrame
    names: list[str]
    levels: dict[str, list[str]]
    sparse: list[str]


def prepare(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Trim names, coerce booleans, validate, filter and derive the categories."""
    rows = clean.trim_names(df)
    # Only columns that can become features are worth the look at their values.
    used = clean.names_with(
        rows, [*cfg.required, *cfg.numeric, *cfg.categorical, *cfg.lags], cfg.flag_prefixes
    )
    rows = clean.coerce_booleans(rows, used)
    rows = clean.clean_laps(
        rows,
        cfg.required,
        cfg.target,
        cfg.min_lap,
        cfg.max_lap,
        "PitDuration" if cfg.drop_pit_laps else None,
    )
    return features.with_team(features.with_compound(rows))


@dataclass
class Profile:
    """What one pass over the prepared rows tells: which columns hold values, and group sizes."""

    filled: set[str]
    largest_group: int
    most_filled: dict[str, int]  # greatest number of values of a column in one group


def profile(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Profile:
    """One job, pre-aggregated per group, and one row back to the driver."""
    columns = list(columns)
    per_group = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    row = per_group.agg(
        F.max("_n"), *[F.max(f"_{i}") for i in range(len(columns))]
    ).first()
    most = {c: n or 0 for c, n in zip(columns, row[1:])}
    return Profile({c for c, n in most.items() if n}, row[0] or 0, most)


def build(
    df: DataFrame,
    cfg: FeatureConfig,
    carry: Sequence[str] = (),
    names: list[str] | None = None,
    levels: dict[str, list[str]] | None = None,
    fill: float | None = 0.0,
    sparse: Sequence[str] | None = None,
) -> FeatureSet:
    """The feature frame: numeric candidates, lags, one-hot levels and flag columns.

    Laps that share the lap order are put in order by all their values that are used, so that lags are the
    same in every run.

    A name occurs once: a flag column wins over a one-hot column of the same name.
    Exclusions apply to every base column but not to lags. Columns without any value are
    left out before nulls are filled. ``fill=None`` leaves nulls in place.
    """
    rows = prepare(df, cfg)
    base = clean.without(
        clean.names_with(rows, cfg.numeric), cfg.exclude_exact, cfg.exclude_prefixes
    )
    numeric = set(clean.numeric_names(rows))
    flags = [
        c
        for c in clean.without(
            clean.names_with(rows, prefixes=cfg.flag_prefixes),
            cfg.exclude_exact,
            cfg.exclude_prefixes,
        )
        if c in numeric and c not in base
    ]
    seen = None
    if names is None and all(k in rows.columns for k in cfg.driver_keys):
        lagged = [c for c in cfg.lags if c in rows.columns]
        seen = profile(rows, cfg.driver_keys, dict.fromkeys([*base, *flags, *lagged]))
    fits = seen is not None and seen.largest_group <= max_group_rows(df.sparkSession)
    if levels is None:
        levels, many = features.category_levels(rows, cfg.categorical, cfg.wide_levels)
        sparse = many if sparse is None else sparse
    sparse = list(sparse or [])
    hot, levels = features.one_hot(rows, cfg.categorical, levels)
    used = {*cfg.driver_keys, *cfg.group_keys, *cfg.lap_order, *base, *flags, *cfg.lags, *cfg.categorical, *carry, cfg.target}
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c in used])
    rows = features.lag_features(
        rows.withColumn("_tie", tie), cfg.driver_keys, [*cfg.lap_order, "_tie"], cfg.lags, fits=fits
    ).drop("_tie")
    lags = {
        f"{c}_lag{n}": (c, n)
        for c, steps in cfg.lags.items()
        for n in steps
        if f"{c}_lag{n}" in rows.columns
    }
    taken = {c.lower() for c in [*base, *lags, *flags]}
    made = {
        **{c: F.col(f"`{c}`").cast("double") for c in [*base, *lags, *flags]},
        **{n: e for n, e in hot.items() if n.lower() not in taken},
    }
    keys = list(dict.fromkeys([*cfg.driver_keys, *carry, cfg.target]))
    kept = {k: F.col(k) for k in keys if k not in made}
    kept["season_race"] = group_key(*[F.col(k) for k in cfg.group_keys])
    for c in sparse:
        kept[f"{c}{SPARSE}"] = F.col(f"`{c}`").cast("string") if c in rows.columns else F.lit(None).cast("string")
    if names is None:
        names = _with_values(rows, made, lags, seen)
    chosen = []
    for n in names:
        value = made.get(n, F.lit(None).cast("double"))
        chosen.append((value if fill is None else F.coalesce(value, F.lit(fill))).alias(n))
    frame = rows.select(*[e.alias(k) for k, e in kept.items()], *chosen)
    return FeatureSet(frame, names, levels, sparse)


def sparse_features(made: FeatureSet, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The frame with its wide text columns as ``indices`` and ``values``, and the dictionary of their levels.

    A dictionary from training gives a scoring frame the same slots. Any number of levels will do.
    """
    columns = [f"{c}{SPARSE}" for c in made.sparse]
    if dictionary is None:
        dictionary = dictionaries.level_dictionary(made.frame, columns)
    return dictionaries.sparse_rows(made.frame, columns, dictionary).drop(*columns), dictionary


def _with_values(
    rows: DataFrame, made: dict, lags: dict[str, tuple[str, int]], seen: Profile | None
) -> list[str]:
    """The feature columns that are not null throughout.

    The profile settles nearly all of them: a group with more than n values of a column gives
    its lag of n steps a value. Only what stays open is looked up in the lagged rows.
    """
    if seen is None:
        wide = rows.select(*[e.alias(n) for n, e in made.items()])
        return clean.non_null_columns(wide, list(made))
    base = set(seen.most_filled)
    empty = {c for c in made if c in base and c not in lags and c not in seen.filled}
    empty |= {c for c, (source, _) in lags.items() if source not in seen.filled}
    open_ = [
        c for c, (source, n) in lags.items() if c not in empty and seen.most_filled[source] <= n
    ]
    found = set(clean.non_null_columns(rows, open_))
    return [c for c in made if c not in empty and (c not in open_ or c in found)]
