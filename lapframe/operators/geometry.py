"""Track geometry on long tables: one row per vertex (track, idx, lon, lat) or per corner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapframe.functions.geo import along, circumradius, haversine, plane_x, plane_y
from lapframe.operators.ordered import last_known, neighbours, row_numbers, running_sum
from lapframe.operators.skew import split_hot
from lapframe.session import materialize

# How far around an apex to look, and the sampling step, in metres.
APEX_BUFFER_M = 15.0
SPEED_WINDOW_M = 30.0
SAMPLE_STEP_M = 10.0


def vertices(df: DataFrame, track: str, coordinates: str) -> DataFrame:
    """One row per [lon, lat] pair of a coordinate array."""
    return df.select(F.col(track).alias("track"), F.posexplode(coordinates).alias("idx", "_p")).select(
        "track", "idx", F.col("_p")[0].alias("lon"), F.col("_p")[1].alias("lat")
    )


def origins(points: DataFrame) -> DataFrame:
    """The first vertex of every track: plain numbers, so a hash aggregate without a sort."""
    return points.groupBy("track").agg(
        F.min_by("lat", "idx").alias("lat0"), F.min_by("lon", "idx").alias("lon0")
    )


def local_xy(points: DataFrame, origin: DataFrame | None = None) -> DataFrame:
    """Add x, y in metres from the track's first vertex."""
    origin = origins(points) if origin is None else origin
    return (
        points.join(origin, "track")
        .withColumns(
            {
                "x": plane_x(F.col("lon"), F.col("lat0"), F.col("lon0")),
                "y": plane_y(F.col("lat"), F.col("lat0")),
            }
        )
        .drop("lat0", "lon0")
    )


def _with_segments(points: DataFrame, length: Column, previous: dict[str, str]) -> DataFrame:
    """Add the previous vertex, the length from it (seg_m), the distance since the start at
    the previous vertex (from_m) and at this one (dist_m), and whether it is the last (is_end)."""
    fits = split_hot(points, ["track"]) is None
    linked = neighbours(
        points,
        ["track"],
        ["idx"],
        lags={name: (column, 1) for name, column in previous.items()},
        leads={"_next": ("idx", 1)},
        fits=fits,
    )
    linked = linked.withColumns(
        {"seg_m": F.coalesce(length, F.lit(0.0)), "is_end": F.col("_next").isNull()}
    ).drop("_next")

    summed = running_sum(linked, ["track"], ["idx"], "seg_m", "dist_m", fits=fits)
    if not fits:
        summed = materialize(summed, "segments")
    # The very value of the vertex before, not a second sum that may differ in its last bits.
    ranged = neighbours(summed, ["track"], ["idx"], lags={"from_m": ("dist_m", 1)}, fits=fits)
    return ranged.withColumn("from_m", F.coalesce("from_m", F.lit(0.0)))


def plane_distance(points: DataFrame) -> DataFrame:
    """Cumulative distance in the local plane; needs x and y. Adds seg_m and dist_m."""
    step = F.hypot(F.col("x") - F.col("_px"), F.col("y") - F.col("_py"))
    return _with_segments(points, step, {"_px": "x", "_py": "y"}).drop("_px", "_py", "from_m", "is_end")


def sphere_segments(points: DataFrame) -> DataFrame:
    """Cumulative great-circle distance. Adds prev_lat, prev_lon, seg_m, from_m, dist_m and is_end."""
    step = haversine(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    return _with_segments(points, step, {"prev_lat": "lat", "prev_lon": "lon"})


def resample(segments: DataFrame, step_m: float = SAMPLE_STEP_M) -> DataFrame:
    """Points every ``step_m`` along each track, plus the end point at its true distance.

    Takes ``sphere_segments``. Each segment (from, to] makes the samples that fall into it, so
    nothing is searched or joined, and a long track spreads over as many tasks as it fills.
    """
    first = F.floor(F.col("from_m") / step_m) + 1
    last = F.floor(F.col("dist_m") / step_m)
    nothing = F.array().cast("array<double>")
    marks = F.when(F.col("prev_lat").isNull(), F.array(F.lit(0.0))).when(
        last >= first, F.transform(F.sequence(first, last), lambda k: k * F.lit(float(step_m)))
    )
    # The end point takes the place of a mark that falls exactly on it.
    inner = F.filter(
        F.coalesce(marks, nothing), lambda m: ~F.col("is_end") | (m < F.col("dist_m"))
    )
    end = F.when(F.col("is_end"), F.array("dist_m")).otherwise(nothing)
    share = F.when(
        F.col("seg_m") > 0, (F.col("sample_m") - F.col("from_m")) / F.col("seg_m")
    ).otherwise(F.lit(1.0))
    return (
        segments.withColumn("sample_m", F.explode(F.concat(inner, end)))
        .withColumn("_share", F.when(F.col("sample_m") == F.col("dist_m"), 1.0).otherwise(share))
        .select(
            "track",
            "sample_m",
            along(F.coalesce("prev_lon", "lon"), F.col("lon"), F.col("_share")).alias("lon"),
            along(F.coalesce("prev_lat", "lat"), F.col("lat"), F.col("_share")).alias("lat"),
        )
    )


def interpolate(
    queries: DataFrame,
    profile: DataFrame,
    at: str,
    distance: str,
    values: Sequence[str],
) -> DataFrame:
    """Piecewise-linear values of a profile at query distances, clamped at both ends.

    Each profile point carries its successor, so one as-of step finds the segment.
    """
    fits = split_hot(profile, ["track"]) is None
    ordered = neighbours(
        profile.select("track", distance, *values),
        ["track"],
        [distance],
        lags={"_before": (distance, 1)},
        leads={"_after": (distance, 1), **{f"_next_{v}": (v, 1) for v in values}},
        fits=fits,
    ).withColumns(
        {
            "_from": F.when(F.col("_before").isNull(), F.lit(float("-inf"))).otherwise(
                F.col(distance)
            ),
        }
    )
    # The first point also answers queries before it, the last one queries beyond it.
    found = last_known(
        queries,
        ordered.select("track", "_from", distance, "_after", *values, *[f"_next_{v}" for v in values]),
        ["track"],
        at,
        "_from",
        "_seg",
    )
    seg = F.col("_seg")
    span = seg["_after"] - seg[distance]
    share = F.when(span > 0, F.greatest((F.col(at) - seg[distance]) / span, F.lit(0.0))).otherwise(
        F.lit(0.0)
    )
    return found.select(
        *queries.columns,
        *[
            F.when(seg["_after"].isNull(), seg[v])
            .otherwise(along(seg[v], seg[f"_next_{v}"], share))
            .alias(v)
            for v in values
        ],
    )


def track_totals(points: DataFrame) -> DataFrame:
    return points.groupBy("track").agg(F.max("dist_m").alias("total_m"))


def nearest_vertex(
    points: DataFrame, apexes: DataFrame, corners: Sequence[str]
) -> DataFrame:
    """The nearest vertex of every apex, the lowest idx among equals.

    ``apexes`` has one row per track with ``{corner}_x`` and ``{corner}_y``. Each vertex row is
    compared with the few apexes of its own track as columns of one partial aggregate, so no
    vertex-apex pairs are formed and a hot track merges before it is shuffled.
    """
    joined = points.join(apexes, "track")

    def gap(c: str) -> Column:
        return F.hypot(F.col("x") - F.col(f"{c}_x"), F.col("y") - F.col(f"{c}_y"))

    # A vertex without coordinates has no gap and is passed over.
    nearest = joined.groupBy("track").agg(
        *[
            F.min(
                F.when(gap(c).isNotNull(), F.struct(gap(c).alias("gap_m"), "idx", "dist_m"))
            ).alias(c)
            for c in corners
        ]
    )
    return (
        nearest.unpivot(["track"], list(corners), "corner", "_near")
        .where(F.col("_near.gap_m").isNotNull())
        .select("track", "corner", "_near.gap_m", "_near.idx", "_near.dist_m")
    )


def corner_spacing(apexes: DataFrame, totals: DataFrame, fits: bool = False) -> DataFrame:
    """Order corners along the lap. Adds corner_no, spacing_m and, on the last, final_straight_m.

    ``fits`` says that a track has few corners by construction, as after ``nearest_vertex``.
    """
    fits = fits or split_hot(apexes, ["track"]) is None
    order = ["dist_m", "corner"]
    ranked = row_numbers(apexes, ["track"], order, "corner_no", fits=fits)
    spaced = neighbours(
        ranked,
        ["track"],
        order,
        lags={"_prev": ("dist_m", 1)},
        leads={"_next": ("dist_m", 1)},
        fits=fits,
    )
    return (
        spaced.join(totals, "track")
        .withColumns(
            {
                "spacing_m": F.col("dist_m") - F.coalesce("_prev", F.lit(0.0)),
                "final_straight_m": F.when(
                    F.col("_next").isNull(), F.col("total_m") - F.col("dist_m")
                ),
            }
        )
        .drop("_prev", "_next", "total_m")
    )


def corner_elevation_change(
    corners: DataFrame, elevation: str = "elevation_m", fits: bool = False
) -> DataFrame:
    """Elevation of the next corner minus this one; null on the last."""
    return neighbours(
        corners, ["track"], ["dist_m", "corner"], leads={"_next": (elevation, 1)}, fits=fits
    ).withColumn("elev_change_m", F.col("_next") - F.col(elevation)).drop("_next")


def corner_radius(
    apexes: DataFrame, points: DataFrame, totals: DataFrame, buffer_m: float = APEX_BUFFER_M
) -> DataFrame:
    """Radius of the circle through the line ``buffer_m`` before, at and after each apex."""
    spots = apexes.select("track", "corner", F.col("dist_m").alias("apex_m")).join(totals, "track")
    queries = spots.select(
        "track",
        "corner",
        "apex_m",
        F.explode(
            F.array(
                F.struct(
                    F.lit(0).alias("spot"),
                    F.greatest(F.lit(0.0), F.col("apex_m") - buffer_m).alias("at"),
                ),
                F.struct(F.lit(1).alias("spot"), F.col("apex_m").alias("at")),
                F.struct(
                    F.lit(2).alias("spot"),
                    F.least(F.col("total_m"), F.col("apex_m") + buffer_m).alias("at"),
                ),
            )
        ).alias("_q"),
    ).select("track", "corner", "apex_m", "_q.spot", "_q.at")
    placed = interpolate(queries, points, "at", "dist_m", ["x", "y"])
    # Three rows per corner, merged into columns.
    trio = placed.groupBy("track", "corner", "apex_m").agg(
        *[
            F.max(F.when(F.col("spot") == i, F.col(axis))).alias(f"{axis}{i}")
            for i in range(3)
            for axis in ("x", "y")
        ]
    )
    names = [f"{axis}{i}" for i in range(3) for axis in ("x", "y")]
    return trio.withColumn("radius_m", circumradius(*[F.col(n) for n in names])).drop(*names)


def corner_speeds(
    samples: DataFrame,
    apexes: DataFrame,
    before_m: float = SPEED_WINDOW_M,
    after_m: float = SPEED_WINDOW_M,
) -> DataFrame:
    """First, last and top speed of the samples from ``before_m`` ahead of an apex to ``after_m`` past it.

    Samples and windows meet in a bucket as wide as a window, so a window touches at most two
    buckets and the join is an equi-join with a bound. A bucket swollen with samples is split by
    adaptive execution on the sample side, and the aggregates merge before the shuffle.
    """
    width = before_m + after_m
    windows = apexes.select(
        "track",
        "corner",
        F.greatest(F.lit(0.0), F.col("dist_m") - before_m).alias("_lo"),
        (F.col("dist_m") + after_m).alias("_hi"),
    ).withColumn(
        "_bucket", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width)))
    )
    placed = samples.select(
        "track", "dist_m", "speed", F.floor(F.col("dist_m") / width).alias("_bucket")
    )
    hits = placed.join(windows, ["track", "_bucket"]).where(
        F.col("dist_m").between(F.col("_lo"), F.col("_hi"))
    )
    by_place = F.struct("dist_m", "speed")
    found = hits.groupBy("track", "corner").agg(
        F.min_by("speed", by_place).alias("entry_speed"),
        F.max_by("speed", by_place).alias("exit_speed"),
        F.max("speed").alias("max_speed"),
    )
    return apexes.join(found, ["track", "corner"], "left")


def elevation_deltas(profile: DataFrame) -> DataFrame:
    """Difference to the previous profile point, 0 where either is missing."""
    return neighbours(
        profile, ["track"], ["distance_m"], lags={"_prev": ("elevation_m", 1)}
    ).withColumn(
        "elev_delta_m", F.coalesce(F.col("elevation_m") - F.col("_prev"), F.lit(0.0))
    ).drop("_prev")


def elevation_summary(deltas: DataFrame) -> DataFrame:
    """Span, climb and descent per track, with the lap length."""
    d = F.col("elev_delta_m")
    return deltas.groupBy("track").agg(
        F.max("distance_m").alias("lap_length_m"),
        (F.max("elevation_m") - F.min("elevation_m")).alias("total_elev_change"),
        F.coalesce(F.sum(F.when(d > 0, d)), F.lit(0.0)).alias("total_up_m"),
        F.coalesce(-F.sum(F.when(d < 0, d)), F.lit(0.0)).alias("total_down_m"),
    )


def corners_long(
    meta: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str = "coords"
) -> DataFrame:
    """Wide ``corner_{i}_...`` columns to rows, missing corners skipped."""
    present = [c for c in columns if c in meta.columns]
    return meta.unpivot(list(keys), present, "corner", value).where(F.col(value).isNotNull())


def most_corners(corners: DataFrame) -> int:
    """The greatest number of corners of any track, for ``corners_wide``."""
    return corners.agg(F.max("corner_no")).first()[0] or 0


def corners_wide(
    corners: DataFrame, measures: dict[str, str], n_corners: int
) -> DataFrame:
    """Rows per corner to ``corner_{i}_{measure}`` columns, null past a track's last corner."""
    return corners.groupBy("track").agg(
        *[
            F.max(F.when(F.col("corner_no") == i, F.col(column))).alias(f"corner_{i}_{name}")
            for i in range(1, n_corners + 1)
            for name, column in measures.items()
        ]
    )
