"""Fit, cross-validate, explain and store lap-time models with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from lapframe import config
from lapframe.operators.evaluate import error_metrics
from lapframe.operators.folds import with_folds
from lapframe.operators.ordered import row_numbers
from lapframe.operators.sample import seeded_sample
from lapframe.plans import boosting
from lapframe.plans.encoding import LevelEncoder
from lapframe.session import materialize, new_path, shared_dir
from lapframe.sources.writers import partitioned_parquet

SEED = 42
PREDICTION = "pred_lap_time"

# The default settings of Spark's own model kinds. Depth must be bounded here.
GBT_DEFAULTS = {"maxIter": 400, "stepSize": 0.08, "minInstancesPerNode": 20, "maxDepth": 8}
FOREST_DEFAULTS = {"numTrees": 400, "minInstancesPerNode": 2, "maxDepth": 12}
# What settings are called elsewhere, per model kind.
RENAMED = {
    "hgb": {name: name for name in boosting.Settings.__dataclass_fields__ if name != "forest"},
    "forest": {"n_estimators": "max_iter", "max_depth": "max_depth", "min_samples_leaf": "min_samples_leaf", "max_features": "feature_fraction"},
    "gbt": {
        "max_iter": "maxIter", "learning_rate": "stepSize", "min_samples_leaf": "minInstancesPerNode",
        "max_depth": "maxDepth", "feature_fraction": "featureSubsetStrategy",
        "bagging_fraction": "subsamplingRate", "max_bin": "maxBins",
    },
    "rf": {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
}
# What the types of a settings file are here.
KINDS = {"hgb": "hgb", "gbt": "gbt", "rf": "forest"}
# The default settings of a forest. Its trees have as many leaves as rows allow.
HISTOGRAM_FOREST = {"max_iter": 400, "min_samples_leaf": 2, "max_leaf_nodes": None, "forest": True}
PERMUTATION_ROWS = 1000
PERMUTATION_REPEATS = 5
# Rows that change places among themselves.
PERMUTED_ROWS = 100_000


@dataclass
class ModelSpec:
    """A model's kind and settings, its text columns, and a bound on the labelled rows it is fitted on.

    Kinds are ``hgb`` (histogram boosting, best-first, of any depth), ``forest`` (such trees on bootstraps), and
    ``gbt`` and ``rf`` (Spark's trees). With ``max_rows`` the rows with the least hash are taken, the same on any partitioning. Without it
    all rows are used. Scoring always covers all rows.
    """

    kind: str = "hgb"
    params: dict[str, object] = field(default_factory=dict)
    categorical: list[str] = field(default_factory=list)
    max_rows: int | None = None

    @classmethod
    def from_settings(cls, model: dict[str, object], max_rows: int | None = None) -> ModelSpec:
        """From a settings file's ``type`` and ``params``. Settings without a counterpart are an error,
        unless they switch nothing on (null or zero)."""
        kind = KINDS.get(model.get("type", "hgb"))
        if kind is None:
            raise ValueError(f"unknown model kind {model.get('type')!r}")
        params: dict[str, object] = {}
        for name, value in (model.get("params") or {}).items():
            if name in RENAMED[kind]:
                if value is not None:
                    own = RENAMED[kind][name]
                    params[own] = str(value) if own == "featureSubsetStrategy" else value
            elif value:
                raise ValueError(f"model setting {name!r} has no counterpart")
        return cls(kind, params, [], max_rows)


def regressor(spec: ModelSpec, target: str, names: Sequence[str] = ()):
    if spec.kind in ("hgb", "forest"):
        codes = [f"{c}_code" for c in spec.categorical]
        given = {**(HISTOGRAM_FOREST if spec.kind == "forest" else {}), **spec.params}
        return boosting.HistogramBoosting(names, codes, target, PREDICTION, boosting.Settings(**given))
    common = {"featuresCol": "features", "labelCol": target, "predictionCol": PREDICTION, "seed": SEED}
    if spec.kind == "gbt":
        return GBTRegressor(**{**common, **GBT_DEFAULTS, **spec.params})
    if spec.kind == "rf":
        return RandomForestRegressor(**{**common, **FOREST_DEFAULTS, **spec.params})
    raise ValueError(f"unknown model kind {spec.kind!r}")


def pipeline(spec: ModelSpec, names: Sequence[str], target: str = config.TARGET) -> Pipeline:
    """The stages of a kind: level codes and boosting, or sparse one-hot, one feature vector and Spark's trees."""
    stages: list = []
    if spec.kind in ("hgb", "forest"):
        if spec.categorical:
            stages.append(LevelEncoder(spec.categorical))
        return Pipeline(stages=[*stages, regressor(spec, target, names)])
    inputs = list(names)
    if spec.categorical:
        index = [f"_{c}_index" for c in spec.categorical]
        sparse = [f"{c}_onehot" for c in spec.categorical]
        stages.append(
            StringIndexer(
                inputCols=spec.categorical,
                outputCols=index,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=sparse, dropLast=False))
        inputs += sparse
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(regressor(spec, target))
    return Pipeline(stages=stages)


def fit(
    frame: DataFrame, names: Sequence[str], spec: ModelSpec, target: str = config.TARGET
) -> PipelineModel:
    """Fit on all rows, or on ``spec.max_rows`` of them. Pass a materialized frame: a tree model reads
    it once per level.

    Boosting checkpoints its running residuals every few trees once a folder is set for it.
    """
    shared_dir(frame.sparkSession)
    if spec.max_rows is not None:
        frame = bounded(frame, [*names, *spec.categorical, target], spec.max_rows)
    return pipeline(spec, names, target).fit(frame)


def bounded(frame: DataFrame, columns: Sequence[str], max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows, those with the least hash, in a few partitions."""
    used = frame.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)])
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in used.columns])
    rows = used.withColumn("_h", hashed).orderBy("_h").limit(max_rows).drop("_h")
    return materialize(rows.coalesce(max(1, max_rows // 20_000)), "training")


def score(model: Transformer, frame: DataFrame, target: str | None = config.TARGET) -> DataFrame:
    """The frame's rows and keys with the prediction, and actual and error when known."""
    scored = model.transform(frame)
    extra = [c for c in scored.columns if c not in frame.columns and c != PREDICTION]
    scored = scored.drop(*extra)
    if target is None or target not in scored.columns:
        return scored
    return scored.withColumn("actual", F.col(target)).withColumn(
        "error", F.col(PREDICTION) - F.col("actual")
    )


def out_of_fold(
    frame: DataFrame,
    names: Sequence[str],
    folds: DataFrame,
    spec: ModelSpec,
    keys: Sequence[str] = tuple(config.RACE_KEYS),
    target: str = config.TARGET,
) -> DataFrame:
    """Every row predicted by the model of the folds it is not in. One fit per fold.

    The rows are joined with their folds once and written by fold, so that each fit and each
    scoring reads its folds only. Fits share the cluster.
    """
    rows = by_fold(frame, folds, keys)
    numbers = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]

    def held_out(k: int) -> DataFrame:
        model = fit(rows.where(F.col("fold") != k), names, spec, target)
        return score(model, rows.where(F.col("fold") == k), target)

    return reduce(DataFrame.unionByName, at_once(held_out, numbers))


def by_fold(frame: DataFrame, folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with their fold, in one folder per fold."""
    rows = with_folds(frame, folds, keys)
    path = new_path(frame.sparkSession, "folds")
    partitioned_parquet(rows, path, ["fold"])
    return frame.sparkSession.read.schema(rows.schema).parquet(path)


def at_once(work, items: Sequence) -> list:
    """Run a few fits side by side: boosting is a chain of small jobs that leave executors idle."""
    with ThreadPoolExecutor(min(4, max(1, len(items)))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), items))


def holdout(
    train: DataFrame, test: DataFrame, names: Sequence[str], spec: ModelSpec,
    target: str = config.TARGET,
) -> DataFrame:
    """n, rmse and mae on the held-out rows."""
    return error_metrics(score(fit(train, names, spec, target), test, target))


def compare(
    train: DataFrame, test: DataFrame, names: Sequence[str], runs: dict[str, ModelSpec],
    target: str = config.TARGET,
) -> DataFrame:
    """One row per named run on the same hold-out."""

    def one(item: tuple[str, ModelSpec]) -> DataFrame:
        run, spec = item
        return holdout(train, test, names, spec, target).select(
            F.lit(run).alias("run"),
            F.lit(json.dumps({"kind": spec.kind, **spec.params}, sort_keys=True)).alias("params"),
            "n",
            "rmse",
        )

    return reduce(DataFrame.unionByName, at_once(one, list(runs.items())))


def feature_importance(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Impurity importance per feature, greatest first. One-hot slots carry their level."""
    spark = frame.sparkSession
    vectors = frame.limit(0)
    for stage in model.stages[:-1]:
        vectors = stage.transform(vectors)
    attrs = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(slots.get(i, f"feature_{i}"), w) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def gain_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """What the splits of each column gained, as a share of all, greatest first. Levels count for their column."""
    rows = [(n, v) for n, v in model.stages[-1].gains().items()]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def permutation_importance(
    model: PipelineModel,
    frame: DataFrame,
    names: Sequence[str],
    row_key: Sequence[str],
    target: str = config.TARGET,
    sample: int | None = PERMUTATION_ROWS,
    repeats: int = PERMUTATION_REPEATS,
    texts: Sequence[str] = (),
    block_rows: int = PERMUTED_ROWS,
) -> DataFrame:
    """Loss of R2 when one column is shuffled, averaged over repeats, greatest first.

    Columns are shuffled as they come, before any encoding: a text column moves with all its one-hot slots.
    The sample is the rows with the least key hash: the same rows on any partitioning; ``None`` takes
    the whole frame. Rows change places within blocks that a hash deals them to, so nothing is sorted as a
    whole. All shuffled copies (rows x columns x repeats) are scored in one pass.
    """
    raw = [*names, *texts]
    if sample is not None:
        frame = seeded_sample(frame, row_key, sample, SEED)
    everything = F.xxhash64(*[F.col(f"`{c}`") for c in dict.fromkeys([*row_key, *raw, target])], F.lit(SEED))
    rows = materialize(
        frame.select(
            F.col(f"`{target}`").alias("_y"),
            F.struct(*[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(raw)]).alias("_x"),
            everything.alias("_h"),
        ),
        "permuted",
    )
    blocks = max(1, -(-rows.count() // block_rows))
    copies = rows.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    copies = copies.withColumns({"_b": F.pmod(F.xxhash64("_r", "_h"), F.lit(blocks)), "_h2": F.xxhash64("_h", "_r")})
    here = row_numbers(copies, ["_r", "_b"], ["_h", "_y"], "_at")
    there = row_numbers(copies, ["_r", "_b"], ["_h2", "_y"], "_at").select("_r", "_b", "_at", F.col("_x").alias("_x2"))
    paired = here.join(there, ["_r", "_b", "_at"])
    # Column -1 stands for the unchanged row.
    changed = paired.withColumn("_f", F.explode(F.sequence(F.lit(-1), F.lit(len(raw) - 1))))
    values = [
        F.when(F.col("_f") == i, F.col(f"_x2.x{i}")).otherwise(F.col(f"_x.x{i}")).alias(n) for i, n in enumerate(raw)
    ]
    scored = model.transform(changed.select("_r", "_f", "_y", *values))
    fitness = scored.groupBy("_r", "_f").agg(
        (
            F.lit(1.0)
            - F.sum(F.pow(F.col("_y") - F.col(PREDICTION), F.lit(2.0)))
            / F.nullif(F.var_pop("_y") * F.count(F.lit(1)), F.lit(0.0))
        ).alias("_r2")
    )
    base = fitness.where("_f = -1").select("_r", F.col("_r2").alias("_base"))
    labels = F.array(*[F.lit(n) for n in raw])
    return (
        fitness.where("_f >= 0")
        .join(base, "_r")
        .groupBy(F.get(labels, F.col("_f")).alias("feature"))
        .agg(F.avg(F.col("_base") - F.col("_r2")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def importance(
    model: PipelineModel,
    frame: DataFrame,
    names: Sequence[str],
    row_key: Sequence[str],
    target: str = config.TARGET,
    texts: Sequence[str] = (),
) -> DataFrame:
    """The model's own importance, or by permutation for a model without one."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        return feature_importance(model, frame)
    if isinstance(last, boosting.HistogramBoostingModel) and last.is_forest():
        return gain_importance(model, frame.sparkSession)
    return permutation_importance(model, frame, names, row_key, target, texts=texts)


@dataclass
class Bundle:
    """All that scoring needs: the model, its columns, and the baseline and band tables."""

    model: PipelineModel
    names: list[str]
    levels: dict[str, list[str]]
    baseline: DataFrame | None = None
    quantiles: DataFrame | None = None
    sparse: list[str] = field(default_factory=list)
    importance: DataFrame | None = None

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        tables = {"baseline": self.baseline, "quantiles": self.quantiles, "importance": self.importance}
        kept = [name for name, table in tables.items() if table is not None]
        meta = json.dumps(
            {"names": self.names, "levels": self.levels, "tables": kept, "sparse": self.sparse}
        )
        self.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/columns"
        )
        for name in kept:
            tables[name].write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        meta = json.loads(spark.read.text(f"{path}/columns").first()["value"])
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in meta["tables"]}
        model = PipelineModel.load(f"{path}/model")
        return cls(model, meta["names"], meta["levels"], sparse=meta.get("sparse", []), **tables)
