"""Groups too large for a task give the same rows as small ones, however they are cut."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe.operators import folds, geometry, ordered, quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one is null, the rest are small. Order values repeat."""
    rng = random.Random(7)
    keys = [1] * 700 + [None] * 60 + [k for k in range(2, 30) for _ in range(8)]
    rows = [(k, i, rng.randrange(40), round(rng.uniform(0, 9), 2)) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, i int, t int, v double").repartition(3).cache()


def test_lags_and_leads(skewed, same):
    wanted = {"lags": {"a": ("v", 1), "c": ("i", 7)}, "leads": {"d": ("v", 2)}}
    plain = ordered.neighbours(skewed, ["k"], ["t", "i"], **wanted)
    for limit in (300, 40, 2):
        same(ordered.neighbours(skewed, ["k"], ["t", "i"], max_rows=limit, **wanted), plain)


def test_running_sum_and_numbers(skewed, same):
    plain = ordered.running_sum(skewed, ["k"], ["t", "i"], "v", "s")
    same(ordered.running_sum(skewed, ["k"], ["t", "i"], "v", "s", max_rows=50), plain)
    plain = ordered.row_numbers(skewed, ["k"], ["t", "i"], "n")
    same(ordered.row_numbers(skewed, ["k"], ["t", "i"], "n", max_rows=50), plain)


def test_equal_rows_are_cut_too(spark, same):
    df = spark.createDataFrame([(1, 5, 1.0)] * 200, "k int, t int, v double")
    plain = ordered.running_sum(df, ["k"], ["t"], "v", "s")
    same(ordered.running_sum(df, ["k"], ["t"], "v", "s", max_rows=20), plain)
    blocks = ordered.row_numbers(df, ["k"], ["t"], "n", max_rows=20)
    assert sorted(r.n for r in blocks.collect()) == list(range(1, 201))


def test_as_of(skewed, same):
    left = skewed.where("i % 3 <> 0").select("k", "i", "t")
    right = skewed.where("i % 3 = 0").select(
        "k", F.col("t").alias("rt"), F.when(F.col("i") % 2 == 0, F.col("v")).alias("v"), "i"
    )
    plain = ordered.last_known(left, right, ["k"], "t", "rt", "m").select("k", "i", "t", "m.rt", F.col("m.v").alias("mv"), F.col("m.i").alias("mi"))
    for limit in (100, 10):
        cut = ordered.last_known(left, right, ["k"], "t", "rt", "m", max_rows=limit).select("k", "i", "t", "m.rt", F.col("m.v").alias("mv"), F.col("m.i").alias("mi"))
        same(cut, plain)


def test_percentiles(skewed):
    wanted = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    frame = skewed.toPandas()
    for column in ("v", "t"):
        want = {}
        for k, g in frame.groupby("k", dropna=False):
            want[None if k != k else int(k)] = np.percentile(g[column], [100 * p for p in wanted])
        for limit in (10_000, 50, 1):
            got = quantiles.percentiles(skewed, ["k"], column, wanted, "p", max_rows=limit).collect()
            assert len(got) == len(want)
            for r in got:
                assert r.p == pytest.approx(list(want[r.k]), abs=1e-9)
    whole = quantiles.percentiles(skewed, [], "v", wanted, "p", max_rows=20).first().p
    assert whole == pytest.approx(list(np.percentile(frame["v"], [100 * p for p in wanted])))


def test_percentiles_survive_a_bad_sketch(skewed, monkeypatch):
    """With brackets that miss, the ranks are found in the intervals between them."""
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    monkeypatch.setattr(quantiles, "BRACKET", 0.0)
    frame = skewed.toPandas()
    got = quantiles.percentiles(skewed, ["k"], "v", [0.3, 0.77], "p", max_rows=1).collect()
    want = {
        None if k != k else int(k): np.percentile(g["v"], [30, 77])
        for k, g in frame.groupby("k", dropna=False)
    }
    for r in got:
        assert r.p == pytest.approx(list(want[r.k]), abs=1e-9)
    assert len(got) == len(want)


def _greedy(sizes, n):
    loads, out = [0] * n, {}
    for g, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        f = loads.index(min(loads))
        out[g] = f
        loads[f] += size
    return out


@pytest.mark.parametrize("seed,n,groups,top", [(1, 5, 60, 9), (2, 3, 40, 2), (3, 4, 25, 60), (4, 7, 5, 5)])
def test_folds_follow_the_greedy_rule(spark, seed, n, groups, top):
    rng = random.Random(seed)
    sizes = {g: rng.randint(1, top) for g in range(groups)}
    sizes[groups] = sum(sizes.values())
    df = spark.createDataFrame([(g, s) for g, s in sizes.items()], "g int, s int").withColumn(
        "x", F.explode(F.sequence(F.lit(1), "s"))
    )
    got = {r.g: r.fold for r in folds.group_folds(df, ["g"], n).collect()}
    assert got == _greedy(sizes, n)


def test_share_out_equals_one_by_one():
    rng = random.Random(11)
    for _ in range(300):
        n, size, groups = rng.randint(1, 6), rng.randint(1, 9), rng.randint(1, 40)
        loads = [rng.randint(0, 50) for _ in range(n)]
        now, want = list(loads), [0] * n
        for _ in range(groups):
            f = now.index(min(now))
            now[f] += size
            want[f] += 1
        assert folds._share_out(loads, size, groups) == want


@pytest.fixture(scope="module")
def tracks(spark):
    """One track holds most vertices."""
    rng = random.Random(5)
    rows = []
    for track, n in (("long", 400), ("short", 20), ("tiny", 3)):
        lon, lat = 10.0, 45.0
        for i in range(n):
            rows.append((track, i, lon, lat, rng.uniform(0, 50)))
            lon, lat = lon + rng.uniform(0, 0.0006), lat + rng.uniform(-0.0003, 0.0003)
    return spark.createDataFrame(
        rows, "track string, idx int, lon double, lat double, elevation_m double"
    ).repartition(3).cache()


def _track_tables(tracks):
    line = geometry.plane_distance(geometry.local_xy(tracks))
    samples = geometry.resample(geometry.sphere_segments(tracks), 25.0)
    totals = geometry.track_totals(line)
    apexes = line.where("idx % 9 = 1").select(
        "track", F.concat(F.lit("c"), F.col("idx").cast("string")).alias("corner"),
        (F.col("dist_m") + 1.5).alias("dist_m"),
    )
    spaced = geometry.corner_spacing(apexes, totals)
    radius = geometry.corner_radius(apexes, line, totals)
    heights = geometry.interpolate(apexes, line, "dist_m", "dist_m", ["elevation_m"])
    return [
        line.select("track", "idx", F.round("dist_m", 6).alias("dist_m")),
        samples.select("track", F.round("sample_m", 5).alias("m"), F.round("lon", 9).alias("lon")),
        spaced.select("track", "corner", "corner_no", F.round("spacing_m", 5).alias("s")),
        radius.select("track", "corner", F.round("radius_m", 3).alias("r")),
        geometry.corner_elevation_change(heights).select(
            "track", "corner", F.round("elev_change_m", 6).alias("e")
        ),
    ]


def test_track_geometry(tracks, same, small_groups):
    plain = _track_tables(tracks)
    expected = [t.cache() for t in plain]
    for t in expected:
        t.count()
    small_groups(35)
    for got, want in zip(_track_tables(tracks), expected):
        same(got, want)


def test_resample_covers_the_track_once(tracks):
    got = geometry.resample(geometry.sphere_segments(tracks), 25.0).toPandas()
    ends = geometry.sphere_segments(tracks).groupBy("track").agg(F.max("dist_m").alias("m")).collect()
    for track, total in ends:
        marks = sorted(got[got.track == track].sample_m)
        assert marks[-1] == total
        assert marks[:-1] == [25.0 * i for i in range(len(marks) - 1)]
        assert len(marks) - 1 == -(-total // 25.0)
