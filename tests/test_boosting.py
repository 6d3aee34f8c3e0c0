"""Histogram boosting, level dictionaries and grouped permutation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe import config
from lapframe.operators import features, levels, sample
from lapframe.plans import boosting, dataset, training

SETTINGS = boosting.Settings(max_iter=6, learning_rate=0.3, min_samples_leaf=5, max_leaf_nodes=9)
SCHEMA = "a double, b double, c double, team string, lap_time double"


def rows_of(seed, n=500):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, team = float(r.randrange(40)), r.random(), r.choice(["x", "y", "z", None])
        rows.append((a, None if r.random() < 0.1 else b, 3.0, team, a * 2 + (5 if team == "z" else 0) + (7 if b > 0.6 else 0) + r.random()))
    return rows


def exhaustive(x, codes, residual, settings, leaves):
    """Grow a tree by trying every split of every leaf. x: columns with nan; codes: columns of ints, -1 for none."""

    def best(rows):
        found = None
        total, n = residual[rows].sum(), len(rows)

        def offer(left, key):
            nonlocal found
            m = int(left.sum())
            if min(m, n - m) < settings.min_samples_leaf:
                return
            s = residual[rows][left].sum()
            gain = s * s / m + (total - s) ** 2 / (n - m) - total * total / n
            if gain > 1e-6 and (found is None or gain > found[0] + 1e-6):
                found = (gain, key, rows[left], rows[~left])

        for j, col in enumerate(x):
            own = col[rows]
            for v in np.unique(col[~np.isnan(col)]):
                for missing in ([False, True] if np.isnan(own).any() else [False]):
                    offer((own <= v) | (missing & np.isnan(own)), (j, v, missing))
        for j, col in enumerate(codes):
            for v in np.unique(col[col >= 0]):
                offer(col[rows] == v, ("text", j, v))
        return found

    parts = [np.arange(len(residual))]
    open_ = [best(parts[0])]
    made = []
    while len(parts) < leaves:
        able = [i for i, o in enumerate(open_) if o]
        if not able:
            break
        i = max(able, key=lambda i: open_[i][0])
        gain, key, left, right = open_[i]
        made.append((round(gain, 4), key, len(left), len(right)))
        parts[i : i + 1], open_[i : i + 1] = [left, right], [best(left), best(right)]
    return made, parts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_tree_equals_exhaustive_search(seed):
    r = np.random.default_rng(seed)
    x = [r.integers(0, 30, 300).astype(float), np.where(r.random(300) < 0.2, np.nan, r.integers(0, 9, 300)), r.integers(0, 2, 300).astype(float)]
    codes = [r.integers(-1, 5, 300)]
    y = x[0] + 3 * np.nan_to_num(x[1]) * x[2] + 4 * (codes[0] == 2) + r.random(300)
    steps = 2.0**30
    residual = np.rint((y - y.mean()) * steps) / steps
    edges = [(np.unique(c[~np.isnan(c)])[1:] + np.unique(c[~np.isnan(c)])[:-1]) / 2 for c in x]
    for ahead in (False, True):
        rows = boosting.Rows(np.stack([boosting.binned(c, e) for c, e in zip(x, edges)]), np.stack(codes).astype(np.int32), residual.copy())
        rows.start(steps)
        tree = boosting.grow(boosting.counted_here(rows, 1, steps, SETTINGS), 300, int(rows.counted.sum()), steps, SETTINGS, ahead)
        made, parts = exhaustive(x, codes, residual, SETTINGS, 9)
        assert [(round(s.gain, 4), s.left_rows, s.rows - s.left_rows) for s in tree.splits] == [(g, a, b) for g, _, a, b in made]
        assert sorted(tree.values.values()) == pytest.approx(sorted(0.3 * residual[p].mean() for p in parts))


def test_depth_has_no_limit_unless_set():
    x = np.arange(25, dtype=float)
    y = 1e6 * 3.0 ** (x - 24)
    edges = [(x[1:] + x[:-1]) / 2]

    def deepest(settings):
        rows = boosting.Rows(boosting.binned(x, edges[0])[None], np.zeros((0, 25), np.int32), y - y.mean())
        rows.start(2.0**25)
        tree = boosting.grow(boosting.counted_here(rows, 0, 2.0**25, settings), 25, int(rows.counted.sum()), 2.0**25, settings, False)
        depth = {0: 0}
        for s in tree.splits:
            depth[s.left] = depth[s.right] = depth[s.node] + 1
        return max(depth.values())

    assert deepest(boosting.Settings(min_samples_leaf=1)) > 15
    assert deepest(boosting.Settings(min_samples_leaf=1, max_depth=4)) == 4


@pytest.mark.parametrize("settings", [SETTINGS, boosting.Settings(max_iter=5, min_samples_leaf=5, feature_fraction=0.6, bagging_fraction=0.5, bagging_freq=2, l2_regularization=1.0), boosting.Settings(max_iter=2, min_samples_leaf=3, max_leaf_nodes=None, forest=True)])
def test_passes_over_blocks_give_the_trees_of_one_task(spark, settings, monkeypatch):
    rows = rows_of(5)
    frame = levels.with_codes(spark.createDataFrame(rows, SCHEMA), ["team"], levels.level_dictionary(spark.createDataFrame(rows, SCHEMA), ["team"]))
    names, codes = ["a", "b", "c"], ["team_code"]
    one = boosting.fit(frame, names, codes, "lap_time", settings)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 4)
    many = boosting.fit(frame.repartition(5), names, codes, "lap_time", settings, block_rows=100)
    assert one.to_json() == many.to_json()
    if settings.forest:
        assert max(len(t.splits) for t in one.trees) > 40 and len({t.splits[0].rows for t in one.trees}) > 1
    elif settings.bagging_fraction < 1:
        assert all(200 < t.splits[0].rows < 300 for t in one.trees)
        assert one.trees[0].splits[0].rows == one.trees[1].splits[0].rows != one.trees[2].splits[0].rows
        assert len({s.column for t in one.trees for s in t.splits if not s.text}) > 1
    else:
        assert any(s.text for t in one.trees for s in t.splits) and any(s.missing_left or not s.text for t in one.trees for s in t.splits)


def test_boosting_fits_scores_saves_and_loads(spark, tmp_path):
    frame = spark.createDataFrame(rows_of(7), SCHEMA).cache()
    spec = training.ModelSpec("hgb", {"max_iter": 30, "learning_rate": 0.3}, ["team"])
    model = training.fit(frame, ["a", "b", "c"], spec)
    scored = training.score(model, frame)
    error = scored.agg(F.sqrt(F.avg(F.col("error") ** 2))).first()[0]
    assert error < 1.5 and scored.count() == 500
    model.write().overwrite().save(str(tmp_path / "model"))
    from pyspark.ml import PipelineModel

    again = training.score(PipelineModel.load(str(tmp_path / "model")), frame)
    assert again.agg(F.sqrt(F.avg(F.col("error") ** 2))).first()[0] == error
    # A level that was not there, a missing value, and no rows.
    odd = spark.createDataFrame([(1.0, None, None, "new", None)], SCHEMA)
    assert abs(training.score(model, odd, None).first()[training.PREDICTION]) < 100
    assert training.score(model, frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no row"):
        training.fit(frame.limit(0), ["a"], training.ModelSpec("hgb", {"max_iter": 1}))


def test_a_constant_target_and_few_rows_give_no_splits(spark):
    frame = spark.createDataFrame([(float(i), 5.0) for i in range(30)], "a double, lap_time double")
    fitted = boosting.fit(frame, ["a"], [], "lap_time", boosting.Settings(max_iter=2))
    assert fitted.start == 5.0 and all(not t.splits for t in fitted.trees)


def test_bins_follow_values_or_quantiles(spark):
    frame = spark.createDataFrame([(float(i % 7), float(i), None) for i in range(2000)], "few double, many double, none double").repartition(6)
    few, many, none = boosting.bin_edges(frame, ["few", "many", "none"], 100)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and none.tolist() == []
    sizes = np.bincount(boosting.binned(np.arange(2000.0), many))
    assert len(sizes) == 100 and sizes.min() >= 15 and sizes.max() <= 25


def test_a_dictionary_holds_any_number_of_levels(spark):
    rows = [(i, f"d{i % 321:03}", "x" if i % 2 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, driver string, team string").repartition(3)
    table = levels.level_dictionary(df, ["driver", "team", "absent", "driver"])
    held = {(r.feature, r.level): (r.code, r.slot) for r in table.collect()}
    assert len(held) == 322 and held["driver", "d000"] == (0, 0) and held["driver", "d320"] == (320, 320) and held["team", "x"] == (0, 321)
    sparse = levels.sparse_rows(df, ["driver", "team"], table).collect()
    for r in sparse:
        want = [held["driver", r.driver][1]] + ([321] if r.team else [])
        assert r["indices"] == want and r["values"] == [1.0] * len(want)
    # Scoring rows: a new level and a missing column have no slot.
    new = levels.sparse_rows(spark.createDataFrame([("zz",), ("d001",)], "driver string"), ["driver", "team"], table)
    assert sorted(r["indices"] for r in new.collect()) == [[], [1]]
    with pytest.raises(ValueError, match="driver"):
        features.one_hot(df, ["driver", "team"])
    assert levels.level_dictionary(df.limit(0), ["driver"]).count() == 0


def test_wide_text_columns_reach_the_model(spark):
    r = random.Random(4)
    bonus = {d: r.random() * 40 for d in range(250)}
    rows = [(2024, race, d, lap, 70.0 + bonus[d] + r.random()) for race in (1, 2) for d in range(250) for lap in range(1, 5)]
    laps = spark.createDataFrame(rows, "season int, race_round int, driver_id int, lap_number int, lap_time double")
    made = dataset.build(laps, config.FeatureConfig(categorical=["driver_id"], lags={}), carry=["lap_number"])
    assert made.sparse == ["driver_id"] and made.names == []
    frame, dictionary = dataset.sparse_features(made)
    assert dictionary.count() == 250
    long = frame.select("driver_id", F.explode("indices").alias("slot")).join(dictionary, "slot")
    assert long.where(F.col("driver_id").cast("string") == F.col("level")).count() == 2000
    spec = training.ModelSpec("hgb", {"max_iter": 60, "learning_rate": 0.5, "min_samples_leaf": 4}, ["driver_id_text"])
    scored = training.score(training.fit(made.frame, [], spec), made.frame)
    assert scored.agg(F.sqrt(F.avg(F.col("error") ** 2))).first()[0] < 4


@pytest.mark.parametrize("kind, block_rows", [("gbt", 1000), ("hgb", 40)])
def test_grouped_permutation_equals_a_plain_version(spark, kind, block_rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows_of(9, 200))], f"k int, {SCHEMA}").fillna(0.0).cache()
    params = {"max_iter": 8, "learning_rate": 0.3} if kind == "hgb" else {"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 1}
    spec = training.ModelSpec(kind, params, ["team"])
    model = training.fit(frame, ["a", "b"], spec)
    got = {r.feature: r.importance for r in training.permutation_importance(model, frame, ["a", "b"], ["k"], sample=150, repeats=2, texts=["team"], block_rows=block_rows).collect()}
    chosen = sample.seeded_sample(frame, ["k"], 150, training.SEED)
    raw = ["a", "b", "team"]
    n_blocks = -(-150 // block_rows)
    hashed = chosen.withColumn("h", F.xxhash64("k", "a", "b", "team", "lap_time", F.lit(training.SEED)))
    want = {n: 0.0 for n in raw}
    for repeat in (1, 2):
        rows = hashed.withColumns({"b_": F.pmod(F.xxhash64(F.lit(repeat), "h"), F.lit(n_blocks)), "h2": F.xxhash64("h", F.lit(repeat))}).collect()
        here = sorted(rows, key=lambda r: (r.b_, r.h))
        there = sorted(rows, key=lambda r: (r.b_, r.h2))
        y = np.array([r.lap_time for r in here])

        def fit(changed):
            copies = [tuple(getattr(t if n == changed else h, n) for n in raw) + (i,) for i, (h, t) in enumerate(zip(here, there))]
            pred = {r.i: r[training.PREDICTION] for r in model.transform(spark.createDataFrame(copies, "a double, b double, team string, i int")).collect()}
            return 1 - sum((y[i] - pred[i]) ** 2 for i in range(150)) / (y.var() * 150)

        base = fit(None)
        for n in raw:
            want[n] += (base - fit(n)) / 2
    assert got == pytest.approx(want) and got["a"] > got["team"] > 0


def test_a_forest_averages_deep_trees(spark):
    frame = spark.createDataFrame(rows_of(11), SCHEMA).cache()
    model = training.fit(frame, ["a", "b", "c"], training.ModelSpec("forest", {"max_iter": 40}, ["team"]))
    scored = training.score(model, frame)
    assert scored.agg(F.sqrt(F.avg(F.col("error") ** 2))).first()[0] < 2
    importance = {r.feature: r.importance for r in training.importance(model, frame, ["a", "b", "c"], ["a"], texts=["team"]).collect()}
    assert importance["a"] > importance["team_code"] > importance["c"] == 0 and sum(importance.values()) == pytest.approx(1)
    trees = model.stages[-1].trees()
    rows = boosting.Rows(np.random.default_rng(1).integers(0, 256, (3, 99)).astype(np.uint8), np.random.default_rng(2).integers(-1, 3, (1, 99)).astype(np.int32), np.zeros(99))
    rows.add(trees[0])
    assert boosting.walked(rows, trees[0]) == pytest.approx(-rows.residual)
    assert len(trees) == 40 and [boosting.Tree.from_text(t.to_text()) for t in trees] == trees
