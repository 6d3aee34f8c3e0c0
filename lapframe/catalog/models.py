"""Model queries with the full number of trees.

A fit is bounded by labelled rows (``FIT_ROWS``), never by trees or scored rows. One tree on all laps is checked split by split
against an exhaustive search in SQL. The other queries show what SQL can say: every lap once with its keys, fold
and actual value, an error that is the prediction minus the actual value, finite predictions that differ, a model that beats
the mean on the rows it was fitted on, the column that matters most, and hold-out errors of a model that is neither zero nor constant.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lapframe import bindings as b
from lapframe import config
from lapframe.catalog.metrics import FOLDS_SQL
from lapframe.catalog.registry import query
from lapframe.operators import clean, folds, levels, sample
from lapframe.plans import boosting, dataset, training
from lapframe.session import materialize

# Labelled rows of a fit.
FIT_ROWS = 4_000
# Trees, rates, leaf sizes and samples of the models.
_SAMPLED = {"max_iter": 500, "learning_rate": 0.005, "feature_fraction": 0.8, "bagging_fraction": 0.7}
BOOSTED = training.ModelSpec("hgb", {"max_iter": 400, "learning_rate": 0.08, "min_samples_leaf": 20}, ["compound"], FIT_ROWS)
FOREST = training.ModelSpec("forest", {"max_iter": 400, "min_samples_leaf": 2}, ["compound"], FIT_ROWS)
SPARK_TREES = training.ModelSpec("gbt", {"maxIter": 20, "stepSize": 0.3, "minInstancesPerNode": 20, "maxDepth": 5, "maxBins": 255}, ["compound"], FIT_ROWS)
HOLDOUT = training.ModelSpec("hgb", {"max_leaf_nodes": 169, "max_depth": 12, "bagging_freq": 4, **_SAMPLED}, [], FIT_ROWS)
RUNS = {
    "baseline": training.ModelSpec("hgb", {"max_iter": 500, "learning_rate": 0.1}, [], FIT_ROWS),
    "tuned": training.ModelSpec("hgb", {"max_leaf_nodes": 83, "max_depth": 8, "bagging_freq": 3, **_SAMPLED}, [], FIT_ROWS),
}
CARRY = ["lap_number", "car_part", "compound"]
ROW_KEY = [*config.DRIVER_RACE_KEYS, "lap_number", "car_part"]


def _frame(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """The feature frame, written once for the steps of a query."""
    cfg = config.FeatureConfig(categorical=["Team"], lap_order=b.LAP_ORDER)
    laps = b.laps(spark, sf).withColumnRenamed("team", "Team")
    made = dataset.build(laps, cfg, carry=CARRY)
    return materialize(made.frame, "features"), made.names


def _better(model: PipelineModel, frame: DataFrame, names: list[str], spec: training.ModelSpec) -> Column:
    """Whether the error on the rows of the fit is clearly below that of their mean."""
    rows = training.bounded(frame, [*names, *spec.categorical, config.TARGET], spec.max_rows)
    error, spread = training.score(model, rows).agg(F.sqrt(F.avg(F.col("error") ** 2)), F.stddev_pop("actual")).first()
    return F.lit(error < 0.9 * spread)


def _checked(scored: DataFrame, *more: str) -> DataFrame:
    gap = F.abs(F.col("error") - (F.col(training.PREDICTION) - F.col("actual")))
    finite = F.abs(training.PREDICTION) < 1e6
    return scored.select(*more, *ROW_KEY, "actual", F.round(gap, 9).alias("gap"), finite.alias("finite"))


_ROWS = "season, race_round, driver_id, lap_number, car_part, lap_time AS actual, CAST(0.0 AS DOUBLE) AS gap, true AS finite"
_SCORED = f"WITH {b.LAPS_SQL} SELECT {_ROWS}, true AS better FROM clean"


def _predictions(spark: SparkSession, sf: str, spec: training.ModelSpec) -> DataFrame:
    frame, names = _frame(spark, sf)
    model = training.fit(frame, names, spec)
    return _checked(training.score(model, frame)).withColumn("better", _better(model, frame, names, spec))


@query(_SCORED)
def gbt_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf, BOOSTED)


@query(_SCORED)
def rf_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf, FOREST)


@query(
    f"""WITH RECURSIVE {b.LAPS_SQL}, {FOLDS_SQL} SELECT fold, {_ROWS}, count(*) OVER (PARTITION BY fold) > 200 AS varied
       FROM clean JOIN folds USING (season, race_round)"""
)
def oof_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``varied`` tells that the predictions of a fold's model differ from row to row."""
    frame, names = _frame(spark, sf)
    fold_table = materialize(folds.group_folds(frame, config.RACE_KEYS, config.FOLDS), "folds")
    scored = materialize(training.out_of_fold(frame, names, fold_table, BOOSTED), "oof")
    values = scored.groupBy("fold").agg((F.countDistinct(F.round(training.PREDICTION, 6)) > 200).alias("varied"))
    return _checked(scored, "fold").join(values, "fold")


TREE_NUMBERS = ["position", "TyreLife", "PitDuration", "humidity"]
TREE_TEXTS = ["compound", "team"]
TREE = boosting.Settings(max_iter=1, max_leaf_nodes=8, min_samples_leaf=20)


def _tree_sql(splits: int) -> str:
    """Try every split of every leaf, take the best, and again: nothing of histograms, queues or siblings."""
    numbers = " UNION ALL ".join(f"""SELECT r, false AS text, {i} AS c, CAST("{n}" AS DOUBLE) AS v, NULL AS level FROM base""" for i, n in enumerate(TREE_NUMBERS))
    texts = " UNION ALL ".join(f"""SELECT r, true, {i}, NULL, "{n}" FROM base""" for i, n in enumerate(TREE_TEXTS))
    parts = [
        f"""{b.LAPS_SQL}, base AS (SELECT row_number() OVER () AS r, * FROM clean),
mean AS (SELECT count(*) AS n, CAST(sum(CAST(round_even(lap_time * 1048576, 0) AS HUGEINT)) AS DOUBLE) / count(*) / 1048576 AS m, max(lap_time) - min(lap_time) AS reach FROM base),
step AS (SELECT m, pow(2, least(30, floor(61 - (log2(reach) + 1) - log2(n)), floor(51 - (log2(reach) + 1) - log2(n)))) AS u FROM mean),
cell AS MATERIALIZED ({numbers} UNION ALL {texts}),
cut AS (SELECT c, v, (v + lead(v) OVER (PARTITION BY c ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT c, v FROM cell WHERE NOT text)),
n0 AS MATERIALIZED (SELECT r, 0 AS node, CAST(round_even((lap_time - m) * u, 0) AS BIGINT) AS q FROM base, step)"""
    ]
    for k in range(splits):
        parts.append(
            f"""t{k} AS (SELECT node, count(*) AS n, CAST(sum(q) AS BIGINT) AS s FROM n{k} GROUP BY node),
h{k} AS (SELECT node, text, c, v, level, count(*) AS n, CAST(sum(q) AS BIGINT) AS s FROM n{k} JOIN cell USING (r) GROUP BY ALL),
o{k} AS (SELECT node, text, c, v, level,
    CASE WHEN text THEN n ELSE CAST(sum(n) OVER w AS BIGINT) END AS a, CASE WHEN text THEN s ELSE CAST(sum(s) OVER w AS BIGINT) END AS p
  FROM h{k} WINDOW w AS (PARTITION BY node, text, c ORDER BY v)),
g{k} AS (SELECT o.*, t.n, t.s, (p / u) * (p / u) / a + ((t.s - p) / u) * ((t.s - p) / u) / (t.n - a) - (t.s / u) * (t.s / u) / t.n AS gain
  FROM o{k} o JOIN t{k} t USING (node), step WHERE a >= 20 AND t.n - a >= 20),
b{k} AS MATERIALIZED (SELECT * FROM g{k} WHERE gain > 1e-9 ORDER BY gain DESC, node, text, c, v, level LIMIT 1),
n{k + 1} AS MATERIALIZED (SELECT n.r, CASE WHEN b.node IS NULL THEN n.node
    WHEN CASE WHEN b.text THEN x.level = b.level ELSE x.v <= b.v END THEN {2 * k + 1} ELSE {2 * k + 2} END AS node, q
  FROM n{k} n LEFT JOIN b{k} b ON n.node = b.node LEFT JOIN cell x ON x.r = n.r AND x.text = b.text AND x.c = b.c)"""
        )
    names = f"CASE WHEN b.text THEN [{_listed(TREE_TEXTS)}][b.c + 1] ELSE [{_listed(TREE_NUMBERS)}][b.c + 1] END"
    rows = " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS step, CAST(node AS BIGINT) AS node, {names} AS feature, b.level, cut.cut, CAST(a AS BIGINT) AS left_rows, CAST(n AS BIGINT) AS n_rows, round(gain, 6) AS gain
        FROM b{k} b LEFT JOIN cut ON NOT b.text AND cut.c = b.c AND cut.v = b.v"""
        for k in range(splits)
    )
    return f"WITH {', '.join(parts)} {rows}"


def _listed(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


@query(_tree_sql(TREE.max_leaf_nodes - 1))
def boosted_tree_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The splits of the first tree, grown on all laps, in the order of growth."""
    laps = clean.clean_laps(b.laps(spark, sf))
    dictionary = levels.level_dictionary(laps, TREE_TEXTS)
    codes = [f"{c}_code" for c in TREE_TEXTS]
    frame = levels.with_codes(laps, TREE_TEXTS, dictionary)
    fitted = boosting.fit(frame, TREE_NUMBERS, codes, config.TARGET, TREE)
    rows = []
    for i, s in enumerate(fitted.trees[0].splits):
        cut = None if s.text else float(fitted.edges[s.column][s.bin])
        rows.append((i, s.node, (TREE_TEXTS if s.text else TREE_NUMBERS)[s.column], s.bin if s.text else None, cut, s.left_rows, s.rows, s.gain))
    made = spark.createDataFrame(rows, "step long, node long, feature string, code long, cut double, left_rows long, n_rows long, gain double")
    return made.join(dictionary, ["feature", "code"], "left").select(
        "step", "node", "feature", "level", "cut", "left_rows", "n_rows", F.round("gain", 6).alias("gain")
    )


_LEVELS = ("A", "N", "R", "__unknown")
_FEATURES = (
    "position", "TyreLife", "PitDuration", "humidity", "lap_time_lag1", "lap_time_lag2", "lap_time_lag3",
    "TyreLife_lag1", "TyreLife_lag2", "Team_F", "Team_O",
)


@query(
    f"""SELECT unnest([{_listed([*_FEATURES, *[f"compound_onehot_{v}" for v in _LEVELS]])}]) AS feature,
       true AS in_range, CAST(1.0 AS DOUBLE) AS total, count(*) > 0 AS used, true AS in_order FROM lineitem"""
)
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """``in_order`` tells that no row before has a lower importance."""
    frame, names = _frame(spark, sf)
    found = training.feature_importance(training.fit(frame, names, SPARK_TREES), frame).collect()
    total = round(sum(r.importance for r in found), 6)
    rows = [(r.feature, 0 <= r.importance <= 1, total, total > 0, i == 0 or found[i - 1].importance >= r.importance) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, "feature string, in_range boolean, total double, used boolean, in_order boolean")


@query(f"SELECT unnest([{_listed([*_FEATURES, 'compound'])}]) AS feature, true AS finite, true AS in_order, count(*) > 0 AS used FROM lineitem")
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Loss of fit on the sample that the importance is defined on, a thousand rows; the text column moves as one.

    ``used`` tells that shuffling some column costs the model its fit.
    """
    frame, names = _frame(spark, sf)
    model = training.fit(frame, names, BOOSTED)
    fitted = training.bounded(frame, [*names, "compound", config.TARGET], FIT_ROWS)
    found = training.permutation_importance(model, fitted, names, [*names, "compound"], texts=["compound"]).collect()
    rows = [
        (r.feature, abs(r.importance) < 1e6, i == 0 or found[i - 1].importance >= r.importance, found[0].importance > 0.05) for i, r in enumerate(found)
    ]
    return spark.createDataFrame(rows, "feature string, finite boolean, in_order boolean, used boolean")


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part FROM clean
       ORDER BY md5('42|' || season || '|' || race_round || '|' || driver_id || '|' || lap_number || '|' || car_part) LIMIT 1000"""
)
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    laps = clean.clean_laps(b.laps(spark, sf)).select(*ROW_KEY)
    return sample.seeded_sample(laps, ROW_KEY, training.PERMUTATION_ROWS, training.SEED)


@query(
    f"""WITH {b.LAPS_SQL} SELECT season, race_round, driver_id, lap_number, car_part, unnest(['driver_id', 'car_part']) AS feature,
       unnest([CAST(driver_id AS VARCHAR), CAST(car_part AS VARCHAR)]) AS level, CAST(1.0 AS DOUBLE) AS value FROM clean"""
)
def sparse_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Every one of the sparse one-hot columns of two text columns with very many levels, with its name."""
    cfg = config.FeatureConfig(categorical=["driver_id", "car_part"], lap_order=b.LAP_ORDER, wide_levels=0)
    made = dataset.build(b.laps(spark, sf), cfg, carry=["lap_number", "car_part"])
    frame, dictionary = dataset.sparse_features(made)
    ones = frame.select(*ROW_KEY, F.explode(F.arrays_zip("indices", "values")).alias("one"))
    named = dictionary.select(F.col("slot").alias("_slot"), F.expr(f"regexp_replace(feature, '{dataset.SPARSE}$', '')").alias("feature"), "level")
    return ones.join(named, F.col("one.indices") == F.col("_slot")).select(*ROW_KEY, "feature", "level", F.col("one.values").alias("value"))


@query(
    f"""WITH {b.LAPS_SQL}, level AS (SELECT DISTINCT 'driver_id' AS feature, CAST(driver_id AS VARCHAR) AS level FROM clean
       UNION ALL SELECT DISTINCT 'car_part', CAST(car_part AS VARCHAR) FROM clean)
       SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY encode(level)) - 1 AS code,
         row_number() OVER (ORDER BY feature = 'car_part', encode(level)) - 1 AS slot FROM level"""
)
def level_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return levels.level_dictionary(clean.clean_laps(b.laps(spark, sf)), ["driver_id", "car_part"])


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Season hold-out on the numeric columns only, keys and event dropped."""
    laps = clean.clean_laps(b.laps(spark, sf))
    train, test = clean.season_split(laps, 1999, 2000)
    dropped = ["season", "grand_prix"]
    train = materialize(clean.numeric_frame(train, dropped), "train")
    test = materialize(clean.numeric_frame(test, dropped), "test")
    return train, test, [c for c in train.columns if c != config.TARGET]


def _sane(test: DataFrame) -> Column:
    """Whether an error is about as large as the target's spread, as of a model that is neither zero nor constant."""
    spread = test.agg(F.stddev_pop(config.TARGET)).scalar()
    ratio = F.col("rmse") / spread
    return ratio.between(0.5, 1.3) & (F.abs(ratio - 1) > 1e-9)


@query(f"WITH {b.LAPS_SQL} SELECT CAST(count(*) AS BIGINT) AS n, true AS sane FROM clean WHERE season = 2000")
def season_holdout_rmse(spark: SparkSession, sf: str) -> DataFrame:
    train, test, names = _split(spark, sf)
    return training.holdout(train, test, names, HOLDOUT).select("n", _sane(test).alias("sane"))


@query(
    f"""WITH {b.LAPS_SQL} SELECT unnest(['baseline', 'tuned']) AS run, CAST(count(*) AS BIGINT) AS n, true AS sane, true AS differ
       FROM clean WHERE season = 2000"""
)
def param_comparison(spark: SparkSession, sf: str) -> DataFrame:
    train, test, names = _split(spark, sf)
    found = materialize(training.compare(train, test, names, RUNS), "runs")
    differ = found.agg(F.countDistinct("rmse") == 2).scalar()
    return found.select("run", "n", _sane(test).alias("sane"), differ.alias("differ"))
