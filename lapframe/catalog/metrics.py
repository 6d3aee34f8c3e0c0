"""Baselines, error metrics, slices, folds and residual tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.registry import query, settled, settled_sql
from lapframe.operators import clean, evaluate, folds, sketches
from lapframe.operators.quantiles import percentiles
from lapframe.session import materialize, new_path

# The deterministic predictor: the race median, and bands at its residual percentiles.
PREDICTIONS_SQL = f"""{b.LAPS_SQL},
base AS (SELECT season, race_round, median(lap_time) AS baseline FROM clean GROUP BY ALL),
preds AS (SELECT clean.*, baseline AS pred_lap_time, lap_time AS actual,
            baseline - lap_time AS error FROM clean JOIN base USING (season, race_round)),
q AS (SELECT quantile_cont(-error, 0.1) AS p10, quantile_cont(-error, 0.9) AS p90 FROM preds),
banded AS (SELECT preds.*, pred_lap_time + p10 AS pred_low, pred_lap_time + p90 AS pred_high
           FROM preds, q)"""
_METRICS = f"""CAST(count(*) AS BIGINT) AS n, {settled_sql("sqrt(avg(error * error))")} AS rmse,
  {settled_sql("avg(abs(error))")} AS mae"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    laps = narrow_laps(spark, sf)
    base = materialize(evaluate.race_baseline(laps))
    return evaluate.baseline_predictions(laps, base, config.RACE_KEYS)


def narrow_laps(spark: SparkSession, sf: str) -> DataFrame:
    """Clean laps with the columns that the tables below need, written once: medians, sketches and
    metrics read them several times."""
    columns = [*config.REQUIRED_COLUMNS, "car_part", "compound", "TyreLife"]
    return materialize(clean.clean_laps(b.laps(spark, sf)).select(*columns), "laps")


def banded(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialize(predictions(spark, sf), "predictions")
    return evaluate.with_band(rows, materialize(evaluate.residual_quantiles(rows)))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: settled(c, digits) for c in columns})


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT 'in_sample' AS origin, {_METRICS},
       {settled_sql("avg(CAST(actual BETWEEN pred_low AND pred_high AS DOUBLE))")} AS coverage
       FROM banded"""
)
def metrics_overall(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluate.error_metrics(banded(spark, sf), band=("pred_low", "pred_high"))
    return _rounded(rows, "rmse", "mae", "coverage").withColumn("origin", F.lit("in_sample"))


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT season, race_round, {_METRICS} FROM preds
       GROUP BY season, race_round ORDER BY rmse"""
)
def slice_by_race(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluate.error_metrics(predictions(spark, sf), config.RACE_KEYS)
    return _rounded(rows, "rmse", "mae").orderBy("rmse")


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT compound, {_METRICS} FROM preds GROUP BY compound
       ORDER BY rmse"""
)
def slice_by_compound(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluate.error_metrics(predictions(spark, sf), ["compound"])
    return _rounded(rows, "rmse", "mae").orderBy("rmse")


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT CASE WHEN "TyreLife" <= 8 THEN '0-8'
       WHEN "TyreLife" <= 20 THEN '9-20' ELSE '21+' END AS stint_bucket, {_METRICS}
       FROM preds GROUP BY 1"""
)
def slice_by_stint(spark: SparkSession, sf: str) -> DataFrame:
    rows = predictions(spark, sf).withColumn(
        "stint_bucket", evaluate.stint_bucket(F.col("TyreLife"))
    )
    return _rounded(evaluate.error_metrics(rows, ["stint_bucket"]), "rmse", "mae")


# The greedy rule replayed one group at a time.
FOLDS_SQL = """sizes AS (SELECT season, race_round, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, season, race_round) AS rn FROM sizes),
greedy AS (
  SELECT CAST(0 AS BIGINT) AS rn, -1 AS fold, [CAST(0 AS BIGINT), 0, 0, 0, 0] AS loads
  UNION ALL
  SELECT ranked.rn, list_position(loads, list_min(loads)) - 1,
         list_transform(range(1, 6), lambda i: loads[i] +
           CASE WHEN i = list_position(loads, list_min(loads)) THEN ranked.n ELSE 0 END)
  FROM greedy JOIN ranked ON ranked.rn = greedy.rn + 1),
folds AS (SELECT season, race_round, n, CAST(fold AS INT) AS fold
          FROM ranked JOIN greedy USING (rn))"""


@query(f"WITH RECURSIVE {b.LAPS_SQL}, {FOLDS_SQL} SELECT * FROM folds")
def grouped_folds(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf))
    return folds.group_folds(laps, config.RACE_KEYS, config.FOLDS)


@query(
    f"""WITH RECURSIVE {b.LAPS_SQL}, {FOLDS_SQL},
    rows_ AS (SELECT clean.*, fold FROM clean JOIN folds USING (season, race_round)),
    base AS (SELECT f.fold, median(m) AS pred FROM (SELECT DISTINCT fold FROM folds) f,
             (SELECT season, race_round, fold, median(lap_time) AS m FROM rows_ GROUP BY ALL) r
             WHERE f.fold <> r.fold GROUP BY f.fold),
    preds AS (SELECT fold, pred - lap_time AS error FROM rows_ JOIN base USING (fold))
    SELECT coalesce(CAST(fold AS VARCHAR), 'overall') AS fold, {_METRICS}
    FROM preds GROUP BY ROLLUP (fold)"""
)
def fold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A held-out race is never in its training baselines, so each fold is predicted by the
    median of the race medians of the other folds."""
    laps = narrow_laps(spark, sf)
    fold_table = materialize(folds.group_folds(laps, config.RACE_KEYS, config.FOLDS))
    races = materialize(
        evaluate.race_baseline(laps).join(fold_table, config.RACE_KEYS).drop("n")
    )
    # Every race is a training race of the folds it is not in.
    training = races.withColumn(
        "held_out", F.explode(F.array_except(
            F.array(*[F.lit(i) for i in range(config.FOLDS)]), F.array("fold")
        ))
    )
    fallback = percentiles(training, ["held_out"], "baseline", [0.5], "_m").select(
        F.col("held_out").alias("fold"), F.col("_m")[0].alias("pred_lap_time")
    )
    rows = folds.with_folds(laps, fold_table, config.RACE_KEYS).join(fallback, "fold")
    out = evaluate.error_metrics(
        rows.withColumn("actual", F.col("lap_time")), ["fold"], totals=True
    )
    return _rounded(out, "rmse", "mae").withColumn(
        "fold", F.coalesce(F.col("fold").cast("string"), F.lit("overall"))
    )


@query(f"WITH {b.LAPS_SQL} SELECT DISTINCT driver_id FROM clean ORDER BY driver_id")
def distinct_drivers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_laps(b.laps(spark, sf)).select("driver_id").distinct().orderBy("driver_id")


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, lap_time, driver_id, lap_number, car_part FROM (
       SELECT *, row_number() OVER (PARTITION BY season, race_round
                                    ORDER BY lap_time, driver_id, lap_number, car_part) AS rn
       FROM clean) WHERE rn = 1"""
)
def fastest_lap(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.clean_laps(b.laps(spark, sf)).select(*config.REQUIRED_COLUMNS, "car_part")
    return evaluate.best_row(
        rows, config.RACE_KEYS, ["lap_time", "driver_id", "lap_number", "car_part"]
    )


@query(f"WITH {PREDICTIONS_SQL} SELECT {settled_sql('p10', 9)} AS p10, {settled_sql('p90', 9)} AS p90 FROM q")
def residual_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        evaluate.residual_quantiles(predictions(spark, sf)), "p10", "p90", digits=9
    )


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, {settled_sql("median(lap_time)", 9)} AS baseline
       FROM clean GROUP BY ALL"""
)
def race_baseline(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf))
    return _rounded(evaluate.race_baseline(laps), "baseline", digits=9)


@query(
    f"""WITH {PREDICTIONS_SQL}, bins AS (
       SELECT least(CAST(floor((error + 20) / 0.5) AS INT) + 1, 80) AS bin FROM preds
       WHERE error BETWEEN -20 AND 20)
    SELECT bin, CAST(count(*) AS BIGINT) AS n, CAST(-20 + (bin - 1) * 0.5 AS DOUBLE) AS bin_start FROM bins GROUP BY bin"""
)
def residual_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.histogram(predictions(spark, sf), "error", -20, 20, 80)


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT {settled_sql("avg(error)")} AS mean_error,
       {settled_sql("median(error)", 9)} AS median_error FROM preds"""
)
def residual_summary(spark: SparkSession, sf: str) -> DataFrame:
    row = evaluate.residual_summary(predictions(spark, sf))
    return row.select(
        settled("mean_error").alias("mean_error"), settled("median_error", 9).alias("median_error")
    )


@query(
    f"""SELECT user_id, date_trunc('day', ts) AS day, {settled_sql("avg(value)")} AS value_avg,
       {settled_sql("stddev_samp(value)")} AS value_std, CAST(count(*) AS BIGINT) AS n
       FROM events GROUP BY ALL"""
)
def sensor_stats_batch(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    rows = evaluate.sensor_stats(b.table(spark, sf, "events"), ["user_id", day], "value")
    return _rounded(rows, "value_avg", "value_std")


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT season, race_round, driver_id, lap_number, car_part,
       {settled_sql("pred_lap_time", 9)} AS pred_lap_time, actual, {settled_sql("error", 9)} AS error
       FROM preds"""
)
def baseline_predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = predictions(spark, sf).select(
        *config.DRIVER_RACE_KEYS, "lap_number", "car_part", "pred_lap_time", "actual", "error"
    )
    return _rounded(rows, "pred_lap_time", "error", digits=9)


@query(
    f"""WITH {PREDICTIONS_SQL} SELECT season, race_round, driver_id, lap_number, car_part,
       {settled_sql("pred_low", 8)} AS pred_low, {settled_sql("pred_high", 8)} AS pred_high,
       {settled_sql("pred_lap_time - 1", 9)} AS default_low,
       {settled_sql("pred_lap_time + 1", 9)} AS default_high
       FROM banded"""
)
def prediction_bands(spark: SparkSession, sf: str) -> DataFrame:
    stored = banded(spark, sf).withColumnsRenamed({"pred_low": "low", "pred_high": "high"})
    both = evaluate.with_band(stored)
    return both.select(
        *config.DRIVER_RACE_KEYS,
        "lap_number",
        "car_part",
        settled("low", 8).alias("pred_low"),
        settled("high", 8).alias("pred_high"),
        settled("pred_low", 9).alias("default_low"),
        settled("pred_high", 9).alias("default_high"),
    )


_SKETCHED_SQL = " UNION ALL ".join(
    f"SELECT '{grain}' AS grain, {season} AS season, {race} AS race_round, "
    + ", ".join(settled_sql(f"quantile_cont(lap_time, {p})") + f" AS p{round(100 * p)}" for p in (0.1, 0.5, 0.9))
    + f" FROM clean {group}"
    for grain, season, race, group in (
        ("race", "season", "race_round", "GROUP BY season, race_round"),
        ("season", "season", "CAST(NULL AS INT)", "GROUP BY season"),
        ("all", "CAST(NULL AS INT)", "CAST(NULL AS INT)", ""),
    )
)


@query(f"WITH {b.LAPS_SQL} {_SKETCHED_SQL}")
def percentiles_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches per race, added in two landings, serve exact percentiles of races, seasons and everything."""
    laps = materialize(clean.clean_laps(b.laps(spark, sf)).select("season", "race_round", "lap_time"), "laps")
    table = sketches.SketchTable(spark, new_path(spark, "sketches"), ["season", "race_round"], "season", "lap_time")
    for odd in (0, 1):
        table.add(laps.where(F.col("season") % 2 == odd))
    found = []
    for grain, by in (("race", ["season", "race_round"]), ("season", ["season"]), ("all", [])):
        rows = table.exact(laps, by, [0.1, 0.5, 0.9], "q")
        keys = [(F.col(k) if k in by else F.lit(None).cast("int")).alias(k) for k in ("season", "race_round")]
        found.append(rows.select(F.lit(grain).alias("grain"), *keys, *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "p50", "p90"))]))
    return _rounded(found[0].unionAll(found[1]).unionAll(found[2]), "p10", "p50", "p90")
