"""Lap features: lags, rolling statistics, category decoding and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapframe.functions.arrays import decode_flags, strip_prefix
from lapframe.functions.times import day_angle, seconds_between
from lapframe.operators.clean import names_with, numeric_names
from lapframe.operators.ordered import neighbours, over_groups
from lapframe.session import materialize


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lags: dict[str, Sequence[int]],
    fill: float | None = None,
    fits: bool = False,
) -> DataFrame:
    """Positional lags ``{column}_lag{n}`` within each driver's race, after filtering.

    Columns that do not exist are skipped, and nothing is added when a key is missing.
    """
    if any(k not in df.columns for k in keys):
        return df
    wanted = {
        f"{base}_lag{n}": (base, n)
        for base, steps in lags.items()
        if base in df.columns
        for n in steps
    }
    if not wanted:
        return df
    out = neighbours(df, keys, order, lags=wanted, fits=fits)
    return out if fill is None else out.fillna(fill, subset=list(wanted))


def rolling_stats(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, size: int
) -> DataFrame:
    """Mean and sample deviation of the previous ``size`` laps, this lap excluded."""

    def step(rows: DataFrame, part: list[str], by: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*by).rowsBetween(-size, -1)
        return rows.withColumns(
            {
                f"{column}_roll_mean": F.avg(column).over(w),
                f"{column}_roll_std": F.stddev_samp(column).over(w),
            }
        )

    return over_groups(df, keys, order, step, back=size)


def text_or_flags(
    df: DataFrame, text_columns: Sequence[str], prefix: str, none_set: str | None = None
) -> Column:
    """A category from the first existing text column, else from its flag columns, else null.

    Only numeric or boolean columns count as flags, so a text column that happens to share
    the prefix is not mistaken for one.
    """
    for name in text_columns:
        if name in df.columns:
            return F.col(f"`{name}`").cast("string")
    numeric = set(numeric_names(df))
    flags = [c for c in names_with(df, prefixes=[prefix]) if c in numeric]
    if flags:
        return decode_flags(flags, [strip_prefix(f, prefix) for f in flags], none_set)
    return F.lit(None).cast("string")


def with_compound(df: DataFrame) -> DataFrame:
    return df.withColumn("compound", text_or_flags(df, ["compound"], "Compound_"))


def with_team(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "TeamText", text_or_flags(df, ["team", "Team", "constructor"], "Team_")
    )


def category_levels(
    df: DataFrame, columns: Sequence[str], wide_levels: int = 200
) -> tuple[dict[str, list[str]], list[str]]:
    """Sorted distinct values of each column, and the columns that have more than ``wide_levels``.

    One pass over the rows; their distinct levels are written. At most ``wide_levels`` values of a column come to
    the driver; a column with more is left to the level dictionary, which has no limit.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}, []
    distinct = materialize(one_hot_long(df, [], present).distinct(), "levels")
    counts = {r["feature"]: r["n"] for r in distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = [c for c in present if counts.get(c, 0) > wide_levels]
    found: dict[str, list[str]] = {c: [] for c in present if c not in many}
    for r in distinct.where(F.col("feature").isin(list(found))).collect():
        found[r["feature"]].append(r["level"])
    return {c: sorted(v, key=lambda level: level.encode()) for c, v in found.items()}, many


def one_hot_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The ones of a one-hot table as rows ``keys, feature, level``, however many levels there are.

    A null has no row. Columns that do not exist are skipped.
    """
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("level"))
        for c in columns
        if c in df.columns
    ]
    rows = df.select(*keys, F.explode(F.array(*pairs)).alias("_p")).select(*keys, "_p.feature", "_p.level")
    return rows.where(F.col("level").isNotNull())


def one_hot(
    df: DataFrame, columns: Sequence[str], levels: dict[str, list[str]] | None = None,
    wide_levels: int = 200,
) -> tuple[dict[str, Column], dict[str, list[str]]]:
    """Expressions ``{column}_{level}`` of 1.0 or 0.0. All levels are kept; null gives zeros.

    Without given levels, a column with more than ``wide_levels`` is an error: ``levels.sparse_rows`` takes any number.
    """
    if levels is None:
        levels, many = category_levels(df, columns, wide_levels)
        if many:
            raise ValueError(f"{', '.join(many)}: more than {wide_levels} levels; use a level dictionary and sparse rows")
    made = {
        f"{c}_{v}": F.when(F.col(f"`{c}`").cast("string") == v, 1.0).otherwise(0.0)
        for c, values in levels.items()
        for v in values
    }
    return made, levels


def cyclical_time(df: DataFrame, ts: str) -> DataFrame:
    angle = day_angle(F.col(ts))
    return df.withColumns(
        {
            "LapStartDayOfYear": F.dayofyear(ts),
            "LapStart_sin": F.sin(angle),
            "LapStart_cos": F.cos(angle),
        }
    )


def pit_stops(
    df: DataFrame, lap: str, pit_in: str, pit_out: str
) -> DataFrame:
    """The lap of a stop where a pit-in exists, and out minus in on the same row in seconds."""
    return df.withColumns(
        {
            "pit_stop_lap": F.when(F.col(pit_in).isNotNull(), F.col(lap)),
            "pit_stop_duration": seconds_between(F.col(pit_in), F.col(pit_out)),
        }
    )


def pit_stops_next_lap(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], lap: str, pit_in: str, pit_out: str
) -> DataFrame:
    """As ``pit_stops``, with the out time read from the driver's next lap, where it is recorded."""
    ahead = neighbours(df, keys, order, leads={"_out": (pit_out, 1)})
    return pit_stops(ahead, lap, pit_in, "_out").drop("_out")
