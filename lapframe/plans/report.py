"""Evaluation tables of scored laps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lapframe import config
from lapframe.operators import evaluate
from lapframe.plans import training
from lapframe.sources import writers


# What the tables need beside the predictions themselves.
NEEDED = ("pred_low", "pred_high", *config.RACE_KEYS, "compound", "TyreLife")


def slices(predictions: DataFrame, origin: str) -> dict[str, DataFrame]:
    """Overall and sliced metrics, residual histogram and summary, each tagged with its origin:
    in_sample, oof or holdout. A column that a table needs and the predictions lack is an error."""
    missing = [c for c in NEEDED if c not in predictions.columns]
    if missing:
        raise ValueError(f"the report needs the columns {missing}")
    rows = predictions.withColumn("stint_bucket", evaluate.stint_bucket(F.col("TyreLife")))
    tables = {
        "overall": evaluate.error_metrics(rows, band=("pred_low", "pred_high")),
        "residual_histogram": evaluate.histogram(rows, "error", -20, 20, 80),
        "residual_summary": evaluate.residual_summary(rows),
    }
    for name, keys in {
        "slice_by_race": config.RACE_KEYS,
        "slice_by_compound": ["compound"],
        "slice_by_stint": ["stint_bucket"],
    }.items():
        tables[name] = evaluate.error_metrics(rows, keys)
    return {name: t.withColumn("origin", F.lit(origin)) for name, t in tables.items()}


def write(
    predictions: DataFrame,
    bundle: training.Bundle,
    path: str,
    origin: str,
    frame: DataFrame | None = None,
) -> None:
    """All tables as CSV, the metrics record as JSON when folds are known, and importance.

    The predictions are read once per table, so pass a materialized table.
    """
    for name, table in slices(predictions, origin).items():
        ordered = table.orderBy("rmse") if name in ("slice_by_race", "slice_by_compound") else table
        writers.csv(ordered, f"{path}/{name}")
    if "fold" in predictions.columns:
        writers.metrics_json(
            evaluate.error_metrics(predictions, ["fold"]),
            evaluate.error_metrics(predictions),
            len(bundle.names),
            f"{path}/metrics",
        )
    table = bundle.importance
    if table is None and frame is not None:
        table = training.feature_importance(bundle.model, frame)
    if table is not None:
        writers.csv(table, f"{path}/feature_importance")
