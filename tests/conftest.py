import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lapframe.session import MAX_GROUP_ROWS_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "lapframe-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Make every group above the given size take the split path."""

    def limit(rows):
        spark.conf.set(MAX_GROUP_ROWS_CONF, str(rows))

    yield limit
    spark.conf.unset(MAX_GROUP_ROWS_CONF)


def table(df):
    """Rows sorted by their exact values first, so that rounding in a float moves nothing."""

    def key(row):
        exact = [(v is not None, str(v)) for v in row if not isinstance(v, float)]
        return exact, [v for v in row if isinstance(v, float)]

    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.fixture
def same():
    """Both frames hold the same rows the same number of times."""

    def check(a, b):
        columns = sorted(a.columns)
        assert columns == sorted(b.columns)
        x, y = table(a.select(columns)), table(b.select(columns))
        assert len(x) == len(y)
        for r, s in zip(x, y):
            for u, v in zip(r, s):
                assert u == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v)

    return check
