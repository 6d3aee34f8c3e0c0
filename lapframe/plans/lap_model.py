"""Train and predict from raw laps to scored rows with bands."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lapframe.config import FeatureConfig
from lapframe.operators import evaluate, folds, joins
from lapframe.plans import dataset, training
from lapframe.session import materialize


def train(
    laps: DataFrame,
    cfg: FeatureConfig,
    spec: training.ModelSpec | None = None,
    n_folds: int | None = None,
    residualize: bool = False,
    fractions: Sequence[float] | None = None,
) -> tuple[training.Bundle, DataFrame]:
    """Fit the final model on all rows, and return it with the out-of-fold predictions.

    What is not given comes from the settings. The bands come from out-of-fold residuals, so they are
    honest about new races. With ``residualize`` the target is lap time minus the race baseline. Folds
    then use baselines of their training races only, which leaves a held-out race with the median of
    those. The predictions carry compound, laps on the tyre, lap number and bands, so that every
    report can be made of them. The bundle has the features' importance.
    """
    spec = spec or training.ModelSpec.from_settings(cfg.model)
    n_folds, fractions = n_folds or cfg.n_folds, fractions or cfg.fractions
    carry = [c for c in ("lap_number", "compound", "TyreLife") if c in laps.columns or c == "compound"]
    made = dataset.build(laps, cfg, carry)
    frame = materialize(made.frame, "features")
    spec = replace(spec, categorical=[*spec.categorical, *[f"{c}{dataset.SPARSE}" for c in made.sparse]])
    fold_table = materialize(folds.group_folds(frame, cfg.group_keys, n_folds), "folds")
    if not residualize:
        oof = training.out_of_fold(frame, made.names, fold_table, spec, cfg.group_keys, cfg.target)
        learned, target, baseline = frame, cfg.target, None
    else:
        baseline = materialize(evaluate.race_baseline(frame, cfg.group_keys, cfg.target))
        rows = training.by_fold(frame, fold_table, cfg.group_keys)

        def held_out(k: int) -> DataFrame:
            others = rows.where(F.col("fold") != k)
            seen = materialize(evaluate.race_baseline(others, cfg.group_keys, cfg.target))
            fitted = training.fit(_residual(others, seen, cfg), made.names, spec, "_residual")
            return _restore(fitted, rows.where(F.col("fold") == k), seen, cfg)

        oof = reduce(DataFrame.unionByName, training.at_once(held_out, range(n_folds)))
        learned, target = _residual(frame, baseline, cfg), "_residual"
    model = training.fit(learned, made.names, spec, target)
    oof = materialize(oof, "oof")
    quantiles = materialize(evaluate.residual_quantiles(oof, fractions))
    importance = materialize(training.importance(model, learned, made.names, cfg.driver_keys, target, spec.categorical))
    bundle = training.Bundle(model, made.names, made.levels, baseline, quantiles, made.sparse, importance)
    return bundle, evaluate.with_band(oof, quantiles)


def predict(
    laps: DataFrame, cfg: FeatureConfig, bundle: training.Bundle, carry: Sequence[str] = ()
) -> DataFrame:
    """Scored laps with keys, bands, actual and error, on exactly the trained columns."""
    frame = dataset.build(laps, cfg, carry, bundle.names, bundle.levels, sparse=bundle.sparse).frame
    if bundle.baseline is None:
        scored = training.score(bundle.model, frame, cfg.target)
    else:
        scored = _restore(bundle.model, frame, bundle.baseline, cfg)
    used = [*bundle.names, *[f"{c}{dataset.SPARSE}" for c in bundle.sparse]]
    return evaluate.with_band(scored, bundle.quantiles).drop(
        *[n for n in used if n not in [*cfg.driver_keys, *carry]]
    )


def _residual(frame: DataFrame, baseline: DataFrame, cfg: FeatureConfig) -> DataFrame:
    rows = joins.with_baseline(frame, baseline, cfg.group_keys)
    return materialize(rows.withColumn("_residual", F.col(cfg.target) - F.col("baseline")))


def _restore(model, frame: DataFrame, baseline: DataFrame, cfg: FeatureConfig) -> DataFrame:
    scored = training.score(model, frame, None).withColumnRenamed(training.PREDICTION, "_residual")
    return evaluate.baseline_predictions(
        scored, baseline, cfg.group_keys, cfg.target, "_residual"
    ).drop("_residual", "baseline")
