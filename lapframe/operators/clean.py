"""Column choices, row filters and null handling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lapframe import config
from lapframe.functions.times import interval_seconds


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required column {missing[0]!r} is missing")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"no rows in {what}")
    return df


def intervals_to_seconds(df: DataFrame) -> DataFrame:
    """Every day-time interval column as seconds, so that sources agree before a union."""
    found = [f.name for f in df.schema if isinstance(f.dataType, T.DayTimeIntervalType)]
    return df.withColumns({c: interval_seconds(F.col(c)) for c in found}) if found else df


def normalize(
    df: DataFrame,
    renames: dict[str, str],
    keep: Sequence[str],
    int_keys: Sequence[str] = (),
    literals: dict[str, object] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rename to the common schema, add constants, cast keys, and keep the listed columns.

    Names that are absent from the input are skipped by the rename. Intervals become seconds.
    A key that is no whole number becomes null; with ``strict`` it fails the query.
    """
    out = intervals_to_seconds(df.withColumnsRenamed(renames))
    out = out.withColumns({k: F.lit(v) for k, v in (literals or {}).items()})
    out = out.withColumns({k: _whole(k, strict) for k in int_keys})
    return out.select(*keep)


def _whole(key: str, strict: bool) -> Column:
    number = F.col(key).try_cast("bigint")
    if not strict:
        return number
    text = F.concat(F.lit(f"{key} is no whole number: "), F.col(key).cast("string"))
    failed = F.raise_error(text).cast("bigint")
    return F.when(F.col(key).isNotNull() & number.isNull(), failed).otherwise(number)


def clean_laps(
    df: DataFrame,
    required: Sequence[str] = tuple(config.REQUIRED_COLUMNS),
    lap_time: str = "lap_time",
    low: float = config.MIN_LAP_SECONDS,
    high: float = config.MAX_LAP_SECONDS,
    pit_column: str | None = None,
    pit_limit: float = config.PIT_SECONDS,
) -> DataFrame:
    """Keep complete rows with a plausible lap time, and optionally no pit laps.

    Plain comparisons, so that the scan can skip row groups by them.
    """
    require_columns(df, required)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    out = df.where(complete & F.col(lap_time).between(low, high))
    if pit_column and pit_column in df.columns:
        out = out.where(F.coalesce(F.col(pit_column), F.lit(0.0)) <= pit_limit)
    return out


def valid_rounds(df: DataFrame, column: str = "RoundNumber") -> DataFrame:
    return df.where(F.col(column) >= 1)


def first_rounds(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first n distinct rounds in order, a report limit on the number of events."""
    return df.select(column).distinct().orderBy(column).limit(n)


def track_period(df: DataFrame, host: str, first: int, last: int) -> DataFrame:
    return df.where((F.col("host") == host) & F.col("year_start").between(first, last))


def season_split(
    df: DataFrame, train_to: int, test_season: int, season: str = "season"
) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(season) <= train_to), df.where(F.col(season) == test_season)


def names_with(df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()) -> list[str]:
    """Existing columns from a list, then by prefix, without repeats."""
    listed = [n for n in names if n in df.columns]
    by_prefix = [c for p in prefixes for c in df.columns if c.startswith(p)]
    return list(dict.fromkeys(listed + by_prefix))


def without(names: Sequence[str], exact: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    banned = set(exact)
    return [n for n in names if n not in banned and not n.startswith(tuple(prefixes) or ("\0",))]


def numeric_names(df: DataFrame) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def numeric_frame(df: DataFrame, drop: Sequence[str] = (), fill: float = 0.0) -> DataFrame:
    """Only the numeric and boolean columns, as doubles, with nulls filled."""
    rest = df.drop(*drop)
    return rest.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(fill)).alias(c)
            for c in numeric_names(rest)
        ]
    )


def non_null_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of the columns that hold any value: one job for all of them."""
    if not names:
        return []
    row = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def drop_all_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    names = list(df.columns if names is None else names)
    kept = set(non_null_columns(df, names))
    return df.drop(*[n for n in names if n not in kept])


def coerce_booleans(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Text columns that hold any true/false become 1, 0, and null for everything else.

    One job decides for all text columns, or for the named ones only. A column without
    true/false is left alone.
    """
    wanted = set(df.columns if names is None else names)
    text = [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name in wanted
    ]
    if not text:
        return df
    seen = df.agg(
        *[F.max(F.lower(F.col(f"`{c}`")).isin("true", "false")).alias(c) for c in text]
    ).first()
    words = {
        c: F.when(F.lower(F.col(f"`{c}`")) == "true", 1.0).when(
            F.lower(F.col(f"`{c}`")) == "false", 0.0
        )
        for c in text
        if seen[c]
    }
    return df.withColumns(words) if words else df
