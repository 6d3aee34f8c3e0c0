"""Find groups too large for one task and set them apart."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lapframe.session import materialize, max_group_rows


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality on key pairs: windows and groups treat null as one key, so joins must too."""
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


@dataclass
class Split:
    cold: DataFrame  # rows of the groups one task can handle
    hot: DataFrame  # rows of the others
    hot_keys: DataFrame  # one row per hot group: the keys and the row count _n
    hot_rows: int


def split_hot(df: DataFrame, keys: list[str], max_rows: int | None = None) -> Split | None:
    """Separate groups above the row limit, or return None when there are none.

    The check is one pre-aggregated count over the key columns, and one row comes back to the
    driver. The hot keys are written to a table, at most rows / limit of them, so the planner
    knows its true size when it picks the join: broadcast if small, shuffled if not.
    """
    limit = max_group_rows(df.sparkSession, max_rows)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    n_hot, hot_rows = sizes.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not n_hot:
        return None
    hot_keys = materialize(sizes, "hot-keys")
    probe = hot_keys.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    on = same_keys(df, probe, [(k, f"_hot_{k}") for k in keys])
    return Split(
        cold=df.join(probe, on, "left_anti"),
        hot=df.join(probe, on, "left_semi"),
        hot_keys=hot_keys,
        hot_rows=hot_rows,
    )
