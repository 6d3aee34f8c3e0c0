"""Error metrics, slices, baselines, bands and residual tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapframe import config
from lapframe.operators.joins import with_baseline
from lapframe.operators.quantiles import percentiles


def error_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "pred_lap_time",
    band: tuple[str, str] | None = None,
    totals: bool = False,
) -> DataFrame:
    """n, rmse and mae, overall or per slice; coverage too when a band is given.

    ``totals`` adds the overall row (null keys) in the same pass.
    """
    error = F.col(predicted) - F.col(actual)
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    ]
    if band:
        inside = F.col(actual).between(F.col(band[0]), F.col(band[1]))
        measures.append(F.avg(inside.cast("double")).alias("coverage"))
    grouped = df.rollup(*by) if totals and by else df.groupBy(*by)
    return grouped.agg(*measures)


def stint_bucket(laps_on_tyre: Column) -> Column:
    return (
        F.when(laps_on_tyre <= 8, "0-8").when(laps_on_tyre <= 20, "9-20").when(
            laps_on_tyre > 20, "21+"
        )
    )


def race_baseline(
    laps: DataFrame, keys: Sequence[str] = tuple(config.RACE_KEYS), target: str = config.TARGET
) -> DataFrame:
    """The median target per race."""
    return percentiles(laps, keys, target, [0.5], "_m").select(
        *keys, F.col("_m")[0].alias("baseline")
    )


def baseline_predictions(
    laps: DataFrame,
    baseline: DataFrame,
    keys: Sequence[str],
    target: str = config.TARGET,
    residual: str | None = None,
) -> DataFrame:
    """Prediction = baseline (+ a predicted residual), with actual and error. Keys are kept."""
    rows = with_baseline(laps, baseline, keys)
    extra = F.lit(0.0) if residual is None else F.col(residual)
    return rows.withColumns(
        {"pred_lap_time": F.col("baseline") + extra, "actual": F.col(target)}
    ).withColumn("error", F.col("pred_lap_time") - F.col("actual"))


def residual_quantiles(
    predictions: DataFrame, fractions: Sequence[float] = config.BAND_FRACTIONS
) -> DataFrame:
    """Percentiles of actual minus predicted, one column per fraction (p10, p90, ...)."""
    residuals = predictions.select((-F.col("error")).alias("residual"))
    row = percentiles(residuals, [], "residual", fractions, "_q")
    return row.select(
        *[F.col("_q")[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(fractions)]
    )


def with_band(predictions: DataFrame, quantiles: DataFrame | None = None) -> DataFrame:
    """Add pred_low and pred_high. Without stored quantiles the offsets are the fixed defaults."""
    if quantiles is None:
        low, high = (F.lit(v) for v in config.BAND_DEFAULTS)
    else:
        names = quantiles.columns
        low = quantiles.select(names[0]).scalar()
        high = quantiles.select(names[-1]).scalar()
    return predictions.withColumns(
        {"pred_low": F.col("pred_lap_time") + low, "pred_high": F.col("pred_lap_time") + high}
    )


def histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int
) -> DataFrame:
    """Counts per equal bin with the top edge closed; values outside are left out."""
    x = F.col(column)
    place = F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    width = (high - low) / bins
    return (
        df.where(x.between(low, high))
        .groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width))
    )


def residual_summary(predictions: DataFrame) -> DataFrame:
    """Mean and median error in one row."""
    median = percentiles(predictions, [], "error", [0.5], "_m").select(F.col("_m")[0]).scalar()
    return predictions.agg(F.avg("error").alias("mean_error")).withColumn("median_error", median)


def sensor_stats(
    df: DataFrame, by: Sequence[Column | str], value: str
) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(value).alias("value_avg"),
        F.stddev_samp(value).alias("value_std"),
        F.count(F.lit(1)).alias("n"),
    )


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each group that is least by the order columns, such as the fastest lap."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.where(F.col(order[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )
