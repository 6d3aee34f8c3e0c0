"""Models on a small learnable table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lapframe import config
from lapframe.operators import evaluate, folds
from lapframe.plans import dataset, lap_model, report, training

SPEC = training.ModelSpec("gbt", {"maxIter": 3, "maxDepth": 3, "stepSize": 0.5, "minInstancesPerNode": 1}, ["compound"])


@pytest.fixture(scope="module")
def laps(spark):
    rng = random.Random(3)
    rows = []
    for race in range(1, 9):
        for driver in (1, 44, 63):
            for lap in range(1, 13):
                soft = rng.random() < 0.5
                rows.append((2024, race, driver, lap, 80.0 + race + 2 * (not soft) + 0.1 * lap + rng.random(), float(lap), "SOFT" if soft else "HARD"))
    return spark.createDataFrame(
        rows, "season int, race_round int, driver_id int, lap_number int, lap_time double, TyreLife double, compound string"
    ).cache()


CFG = config.FeatureConfig(categorical=[])


def rmse(df):
    return evaluate.error_metrics(df).first().rmse


def test_train_predict_save_load(spark, laps, tmp_path):
    cfg = config.FeatureConfig(categorical=["compound"])
    spec = training.ModelSpec("gbt", {**SPEC.params})
    bundle, oof = lap_model.train(laps, cfg, spec, 3)
    assert oof.count() == laps.count()
    mean_error = laps.agg(F.stddev_pop("lap_time")).first()[0]
    assert rmse(oof) < mean_error
    report.write(oof, bundle, str(tmp_path / "report"), "oof", oof.limit(0))
    metrics = json.loads(spark.read.text(str(tmp_path / "report" / "metrics")).first().value)
    assert metrics["n_rows"] == laps.count() and len(metrics["cv"]) == 3
    races = spark.read.option("header", "true").csv(str(tmp_path / "report" / "slice_by_race"))
    assert races.count() == 8 and {r.origin for r in races.collect()} == {"oof"}
    bundle.save(str(tmp_path / "bundle"))
    again = training.Bundle.load(spark, str(tmp_path / "bundle"))
    assert again.names == bundle.names and again.levels == {"compound": ["HARD", "SOFT"]}
    # A scoring set without one level still gets the trained columns.
    soft = laps.where("compound = 'SOFT'")
    out = lap_model.predict(soft, cfg, again, carry=["lap_number"])
    assert out.count() == soft.count()
    assert set(out.columns) >= {"season", "race_round", "driver_id", "lap_number", "pred_lap_time", "pred_low", "pred_high", "actual", "error"}
    assert out.where("pred_low > pred_high").count() == 0
    row = out.agg(F.max(F.abs(F.col("error") - (F.col("pred_lap_time") - F.col("actual"))))).first()
    assert row[0] < 1e-9


def test_residualized_target(spark, laps, tmp_path):
    spec = training.ModelSpec("gbt", {**SPEC.params})
    bundle, oof = lap_model.train(laps, CFG, spec, 2, residualize=True)
    assert bundle.baseline.count() == 8 and oof.count() == laps.count()
    bundle.save(str(tmp_path / "b"))
    again = training.Bundle.load(spark, str(tmp_path / "b"))
    assert rmse(lap_model.predict(laps, CFG, again, carry=["lap_number"])) < rmse(oof)


def test_unknown_kind():
    with pytest.raises(ValueError, match="unknown model"):
        training.regressor(training.ModelSpec("svm"), "y")


def test_folds_keep_races_whole(laps):
    table = folds.group_folds(laps, config.RACE_KEYS, 3)
    rows = folds.with_folds(laps, table, config.RACE_KEYS)
    assert rows.groupBy(*config.RACE_KEYS).agg(F.countDistinct("fold").alias("f")).where("f > 1").count() == 0
    assert rows.count() == laps.count()


def test_importance(laps):
    made = dataset.build(laps, CFG, carry=["lap_number", "compound"])
    frame = made.frame.cache()
    model = training.fit(frame, made.names, SPEC)
    table = training.feature_importance(model, frame).collect()
    names = [r.feature for r in table]
    assert any("SOFT" in n for n in names) and abs(sum(r.importance for r in table) - 1) < 1e-6
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)

    plain = training.ModelSpec("gbt", SPEC.params)
    model = training.fit(frame, made.names, plain)
    got = training.permutation_importance(model, frame, made.names, ["season", "race_round", "driver_id", "lap_number"], sample=100, repeats=3).collect()
    assert {r.feature for r in got} == set(made.names)
    assert got[0].importance > 0


def test_forest_and_comparison(laps):
    made = dataset.build(laps, CFG)
    frame = made.frame.cache()
    train, test = frame.where("race_round <= 6"), frame.where("race_round > 6")
    runs = {
        "small": training.ModelSpec("rf", {"numTrees": 2, "maxDepth": 2}),
        "large": training.ModelSpec("rf", {"numTrees": 5, "maxDepth": 4}),
    }
    rows = {r.run: r for r in training.compare(train, test, made.names, runs).collect()}
    assert set(rows) == {"small", "large"} and all(r.n == test.count() and r.rmse > 0 for r in rows.values())


def test_lag_columns_without_values_are_left_out(spark):
    rows = [(2024, r, 1, lap, 90.0, None) for r in (1, 2) for lap in (1, 2)]
    df = spark.createDataFrame(
        rows, "season int, race_round int, driver_id int, lap_number int, lap_time double, TyreLife double"
    )
    names = dataset.build(df, config.FeatureConfig(categorical=[])).names
    assert names == ["lap_time_lag1"]


def test_slices_recombine(laps):
    rows = laps.withColumns({"actual": F.col("lap_time"), "pred_lap_time": F.lit(85.0)}).withColumn(
        "stint", evaluate.stint_bucket(F.col("TyreLife"))
    )
    whole = evaluate.error_metrics(rows).first()
    for by in (["season", "race_round"], ["compound"], ["stint"]):
        part = evaluate.error_metrics(rows, by).collect()
        n = sum(r.n for r in part)
        assert n == whole.n
        assert sum(r.mae * r.n for r in part) / n == pytest.approx(whole.mae)
        assert (sum(r.rmse**2 * r.n for r in part) / n) ** 0.5 == pytest.approx(whole.rmse)


def test_settings_from_nested_dict():
    cfg = config.FeatureConfig.from_dict(
        {"filters": {"min_lap_time_sec": 60, "drop_pit_in_laps": True}, "lags": {"lap_time": [1]}}
    )
    assert (cfg.min_lap, cfg.max_lap, cfg.drop_pit_laps) == (60, 300.0, True)
    assert cfg.lags == {"lap_time": [1]} and cfg.required == config.REQUIRED_COLUMNS


def test_wide_table_as_documented(spark):
    """Text that shares a flag prefix, leakage columns, flags as words, and odd names."""
    rows = [
        (" 2024", 1, 4, lap, 90.0 + lap, "True" if lap % 2 else "False", "SOFT", "McL", "monza", 1.0, 1.0, 0.0, 25.5, 12.0, 3.0, 330.0)
        for lap in range(1, 6)
    ]
    names = [
        "season ", "race_round", "driver_id", "lap_number", "lap_time", "Driver_NOR", "Compound_type",
        "Team_name", "grand_prix_(track_name)", "Team_McLaren", "Compound_SOFT", "Compound_HARD",
        "current_temperature(°C)", "corner_1_radius", "humidity", "SpeedST",
    ]
    df = spark.createDataFrame(rows, names).withColumn("season ", F.trim("season ").cast("int"))
    cfg = config.FeatureConfig(numeric=[*config.CANDIDATE_NUMERIC, "SpeedST"])
    made = dataset.build(df, cfg, carry=["lap_number", "current_temperature(°C)"])
    assert made.names == [
        "humidity", "lap_time_lag1", "lap_time_lag2", "lap_time_lag3",
        "Driver_NOR", "Team_McLaren", "Compound_SOFT", "Compound_HARD", "driver_id_4",
    ]
    first = made.frame.orderBy("lap_number").first()
    assert (first.Driver_NOR, first.Compound_SOFT, first.lap_time_lag1, first.driver_id) == (1.0, 1.0, 0.0, 4)
    assert first.season_race == "2024_1" and first["current_temperature(°C)"] == 25.5


def test_settings_reach_model_folds_and_bands():
    cfg = config.FeatureConfig.from_dict(
        {"cv": {"n_splits": 3}, "model": {"type": "hgb", "params": {"max_depth": None, "max_iter": 7, "l2_regularization": 0.0}}, "intervals": {"alphas": [0.05, 0.95]}}
    )
    spec = training.ModelSpec.from_settings(cfg.model)
    assert (cfg.n_folds, cfg.fractions, spec.kind, spec.params) == (3, (0.05, 0.95), "hgb", {"max_iter": 7, "l2_regularization": 0.0})
    for bad in ({"modle": {}}, {"cv": {"splits": 3}}):
        with pytest.raises(ValueError, match="unknown setting"):
            config.FeatureConfig.from_dict(bad)
    with pytest.raises(ValueError, match="no counterpart"):
        training.ModelSpec.from_settings({"type": "gbt", "params": {"l2_regularization": 1.0}})
    with pytest.raises(ValueError, match="unknown model"):
        training.ModelSpec.from_settings({"type": "svm"})


def test_settings_alone_give_a_model_and_every_report(spark, laps, tmp_path):
    cfg = config.FeatureConfig.from_dict({"cv": {"n_splits": 2}, "model": {"type": "hgb", "params": {"max_iter": 2, "min_samples_leaf": 1}}})
    cfg.wide_levels = 2  # three drivers: the sparse encoder's case
    bundle, oof = lap_model.train(laps, cfg)
    assert bundle.sparse == ["driver_id"] and bundle.importance.count() > 3
    report.write(oof, bundle, str(tmp_path / "report"), "oof")
    overall = spark.read.option("header", "true").csv(str(tmp_path / "report" / "overall")).first()
    assert 0 <= float(overall.coverage) <= 1
    for name in ("slice_by_race", "slice_by_compound", "slice_by_stint", "feature_importance", "residual_histogram"):
        assert spark.read.option("header", "true").csv(str(tmp_path / "report" / name)).count() > 1
    bundle.save(str(tmp_path / "bundle"))
    again = training.Bundle.load(spark, str(tmp_path / "bundle"))
    assert again.sparse == ["driver_id"] and lap_model.predict(laps, cfg, again).count() == laps.count()
    with pytest.raises(ValueError, match="compound"):
        report.slices(oof.drop("compound"), "oof")


def test_bounded_fit_takes_the_same_rows(laps):
    made = dataset.build(laps, CFG)
    one = training.bounded(made.frame, [*made.names, "lap_time"], 50)
    two = training.bounded(made.frame.repartition(7), [*made.names, "lap_time"], 50)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() == 50


def test_whole_frame_permutation(laps, small_groups):
    made = dataset.build(laps, CFG, carry=["lap_number"])
    frame = made.frame.cache()
    model = training.fit(frame, made.names, training.ModelSpec("gbt", SPEC.params))
    key = ["season", "race_round", "driver_id", "lap_number"]
    plain = {r.feature: r.importance for r in training.permutation_importance(model, frame, made.names, key, sample=None, repeats=2).collect()}
    small_groups(40)
    cut = {r.feature: r.importance for r in training.permutation_importance(model, frame, made.names, key, sample=None, repeats=2).collect()}
    assert plain.keys() == cut.keys() and all(plain[k] == pytest.approx(cut[k]) for k in plain)
    both = dataset.build(laps, CFG, carry=["compound", "lap_number"]).frame.cache()
    encoded = training.fit(both, made.names, SPEC)
    got = {r.feature: r.importance for r in training.permutation_importance(encoded, both, made.names, key, texts=["compound"]).collect()}
    assert set(got) == {*made.names, "compound"} and got["compound"] > 0


def test_lags_do_not_depend_on_the_order_of_equal_laps(spark):
    rows = [(2024, 1, 1, 1 + i // 3, 90.0 + i, float(i)) for i in range(12)]
    schema = "season int, race_round int, driver_id int, lap_number int, lap_time double, TyreLife double"
    frames = [spark.createDataFrame(r, schema).repartition(n) for r, n in ((rows, 1), (rows[::-1], 5))]
    got = [sorted(map(tuple, dataset.build(f, config.FeatureConfig(categorical=[]), names=["lap_time_lag1"], levels={}).frame.collect())) for f in frames]
    assert got[0] == got[1]
