"""Stored sketches give exact percentiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapframe.operators import quantiles, sketches

WANTED = [0.0, 0.1, 0.5, 0.77, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows in one race, ties, nulls, a null race, and a race without values."""
    noise = F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7.0
    race = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 7)
    value = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 4 == 0, 5.0).otherwise(noise)
    more = spark.createDataFrame([(2023, 99, None)], "season int, race int, v double")
    base = spark.range(6000).select((2020 + F.col("id") % 4).cast("int").alias("season"), race.cast("int").alias("race"), value.alias("v"))
    return base.unionAll(more).cache()


def _want(frame, by):
    frame = frame.dropna(subset=["v"])
    if not by:
        return {(): np.percentile(frame["v"], [100 * p for p in WANTED])}
    groups = frame.groupby(by, dropna=False)["v"]
    return {tuple(None if x != x else int(x) for x in key): np.percentile(v, [100 * p for p in WANTED]) for key, v in groups}


@pytest.mark.parametrize("k, limit", [(2000, None), (20, None), (200, 3)])
def test_exact_by_any_keys(spark, rows, tmp_path, k, limit):
    table = sketches.SketchTable(spark, str(tmp_path / "s"), ["season", "race"], "season", "v", k)
    assert table.exact(rows.limit(0), ["race"], WANTED).count() == 0
    table.add(rows.where("season < 2022"))
    table.add(rows.where("season >= 2022"))
    table.add(rows.where("season = 2022"))  # landed again
    frame = rows.toPandas()
    for by in ([], ["season"], ["race"], ["season", "race"]):
        got = table.exact(rows, by, WANTED, "p", limit).collect()
        want = _want(frame, by)
        assert len(got) == len(want)
        for r in got:
            assert r.p == pytest.approx(list(want[tuple(r[c] for c in by)]), abs=1e-9)
    close = table.approximate([], [0.5], rows.schema).first().percentiles[0]
    assert abs((frame["v"].dropna() <= close).mean() - 0.5) < 3 * sketches.rank_error(k) + 0.3 * (close == 5.0)


def test_rows_that_were_not_added(spark, rows, tmp_path):
    table = sketches.SketchTable(spark, str(tmp_path / "s"), ["season", "race"], "season", "v")
    table.add(rows.where("season < 2022"))
    for by in (["season"], []):
        with pytest.raises(ValueError, match="sketches of"):
            table.exact(rows, by, WANTED).collect()
    with pytest.raises(ValueError):
        sketches.SketchTable(spark, str(tmp_path / "s"), ["season"], "race", "v")
    assert quantiles.percentiles(rows.where("race = 99"), ["race"], "v", [0.5]).count() == 0
