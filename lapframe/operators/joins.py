"""Lookups, as-of and interval alignment of laps, telemetry, weather and dimensions.

No join here forces a broadcast. Catalyst broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides shuffle on the key and
adaptive execution splits partitions swollen by a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lapframe.functions.text import slug
from lapframe.operators.ordered import last_known
from lapframe.operators.quantiles import SINGLE_GROUP_ROWS, percentiles
from lapframe.session import materialize, max_group_rows


def attach(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left equi-join that brings the listed columns, skipping those the other side lacks."""
    present = [c for c in columns if c in other.columns]
    return rows.join(other.select(*keys, *present), list(keys), "left")


def lap_at(
    samples: DataFrame,
    laps: DataFrame,
    keys: Sequence[str],
    sample_time: str,
    lap_start: str,
    lap_end: str,
    columns: Sequence[str],
) -> DataFrame:
    """Each telemetry sample with the lap whose [start, end) holds it, nulls when none does.

    Laps of one key must not overlap. The latest lap begun is then the only candidate, so
    the interval join is an as-of step plus a bound, with no inequality join.
    """
    kept = list(dict.fromkeys([*keys, lap_start, lap_end, *columns]))
    found = last_known(samples, laps.select(*kept), keys, sample_time, lap_start, "_lap")
    inside = F.col(sample_time) < F.col("_lap")[lap_end]
    return found.select(
        *samples.columns, *[F.when(inside, F.col("_lap")[c]).alias(c) for c in columns]
    )


def as_of(
    rows: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    history_time: str,
    columns: Sequence[str],
) -> DataFrame:
    """The latest history row at or before each row, per key."""
    kept = list(dict.fromkeys([*keys, history_time, *columns]))
    found = last_known(rows, history.select(*kept), keys, time, history_time, "_past")
    return found.select(*rows.columns, *[F.col("_past")[c].alias(c) for c in columns])


def as_of_in_buckets(
    rows: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    history_time: str,
    columns: Sequence[str],
    bucket_seconds: int,
) -> DataFrame:
    """As ``as_of``, for few keys with long histories: keys are cut into buckets of time.

    Every bucket is joined on its own. The last history row of each bucket is carried into all later
    buckets up to the next one that has any, by a window over one row per key and bucket; so a match
    from any earlier time is found. The rows are read once to count them by key and bucket, which
    also tells whether any bucket is too large for one task, and once to be joined.
    """
    keys = list(keys)

    def bucket(column: str) -> Column:
        return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / bucket_seconds).alias("_bucket")

    kept = list(dict.fromkeys([*keys, history_time, *columns]))
    past = history.select(*kept, bucket(history_time)).dropna(subset=[*keys, history_time])
    asked = rows.withColumn("_bucket", bucket(time))
    rest = [c for c in kept if c not in keys]
    fact = F.struct(*[F.col(c) for c in rest])
    order = F.struct(history_time, *[c for c in columns if c != history_time])
    final = past.groupBy(*keys, "_bucket").agg(F.max_by(fact, order).alias("_last"), F.count(F.lit(1)).alias("_n"))
    places = asked.select(*keys, "_bucket").dropna().groupBy(*keys, "_bucket").agg(
        F.lit(None).cast(dict(final.dtypes)["_last"]).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    both_sides = final.unionByName(places).groupBy(*keys, "_bucket")
    small = materialize(both_sides.agg(F.max("_last").alias("_last"), F.sum("_n").alias("_n")), "buckets")
    largest = small.agg(F.max("_n")).first()[0] or 0
    fits = largest < max_group_rows(rows.sparkSession)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = small.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).where(
        F.col("_before").isNotNull()
    )
    carried = carried.select(*keys, "_bucket", *[F.col("_before")[c].alias(c) for c in rest])
    both = past.select(*keys, "_bucket", *rest).unionByName(carried)
    found = last_known(asked, both, [*keys, "_bucket"], time, history_time, "_past", fits=fits)
    return found.select(*rows.columns, *[F.col("_past")[c].alias(c) for c in columns])


def first_match(dimension: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in order. A mergeable aggregate, so a hot key costs nothing."""
    rest = [c for c in dimension.columns if c != key]
    return (
        dimension.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(key, "_row.*")
    )


def lookup_by_slug(
    events: DataFrame, name: str, places: DataFrame, place_name: str, order: Sequence[str]
) -> DataFrame:
    """Events with the first place of the same slug. Events without a place are left out."""
    keyed = places.withColumn("slug", slug(F.col(place_name)))
    return events.withColumn("slug", slug(F.col(name))).join(
        first_match(keyed, "slug", order), "slug"
    )


def median_of(table: DataFrame, column: str) -> Column:
    """The median of a column as a scalar subquery, 0 for an empty table.

    Meant for written tables, where the count comes from file footers.
    """
    if table.count() <= SINGLE_GROUP_ROWS:
        middle = table.agg(F.percentile(column, 0.5)).scalar()
    else:
        row = percentiles(table, [], column, [0.5], "_m")
        middle = row.select(F.col("_m")[0]).scalar()
    return F.coalesce(middle, F.lit(0.0))


def with_baseline(
    rows: DataFrame,
    baseline: DataFrame,
    keys: Sequence[str],
    column: str = "baseline",
) -> DataFrame:
    """Add the baseline of each row's race, or the median of all baselines for an unknown race.

    ``baseline`` is read twice, so pass a saved or materialized table.
    """
    fallback = median_of(baseline, column)
    return rows.join(baseline.select(*keys, column), list(keys), "left").withColumn(
        column, F.coalesce(F.col(column), fallback)
    )


def last_snapshot(
    rows: DataFrame,
    series: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Every row with the final series row of its session. Fields the series lacks are null."""
    present = [c for c in columns if c in series.columns]
    final = (
        series.groupBy(*keys)
        .agg(F.max_by(F.struct(*present), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
    )
    out = rows.join(final, list(keys), "left")
    absent = {c: F.lit(None).cast("string") for c in columns if c not in present}
    return out.withColumns(absent) if absent else out
