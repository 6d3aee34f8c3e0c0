"""Every query with SQL gives the same rows in DuckDB; the others give rows."""

from dataclasses import replace
from pathlib import Path

import pytest

import check
from lapframe.catalog import ENTRIES, models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle(SF)


@pytest.fixture(autouse=True, scope="module")
def few_trees():
    """The model queries with fewer trees; ``check.py`` runs them with all."""
    full = {n: getattr(models, n) for n in ("BOOSTED", "SPARK_TREES", "FOREST", "HOLDOUT", "RUNS")}

    def light(spec):
        trees = {"maxIter": 3} if spec.kind == "gbt" else {"max_iter": 60}
        return replace(spec, params={**spec.params, **trees}, max_rows=1000)

    for name, spec in full.items():
        setattr(models, name, {r: light(s) for r, s in spec.items()} if name == "RUNS" else light(spec))
    yield
    for name, spec in full.items():
        setattr(models, name, spec)


def test_model_queries_have_all_trees():
    """Outside the fixture the settings are the full ones: fixed values."""
    source = Path(models.__file__).read_text()
    assert source.count('"max_iter": 400') == 2 and source.count('"max_iter": 500') == 2


@pytest.mark.parametrize("name", sorted(n for n, e in ENTRIES.items() if e.sql))
def test_matches_sql(spark, con, name):
    assert check.compare(spark, con, name, SF) == ""


@pytest.mark.parametrize("name", sorted(n for n, e in ENTRIES.items() if e.sql is None))
def test_gives_rows(spark, con, name):
    assert check.compare(spark, con, name, SF) == ""


# The group limit is chosen so that the query's groups are above it.
SPLIT = {
    "asof_weather": 30,
    "telemetry_lap_interval": 30,
    "pit_stops": 30,
    "race_baseline": 20,
    "fold_metrics": 20,
    "residual_quantiles": 500,
    "residual_summary": 500,
    "wide_lap_table": 400,
}


@pytest.mark.parametrize("name", sorted(SPLIT))
def test_matches_sql_when_groups_are_split(spark, con, small_groups, name):
    small_groups(SPLIT[name])
    assert check.compare(spark, con, name, SF) == ""
