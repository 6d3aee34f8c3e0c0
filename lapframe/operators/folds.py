"""Group folds: whole groups go to folds so that the folds stay balanced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapframe.operators.ordered import row_numbers
from lapframe.operators.skew import same_keys
from lapframe.session import materialize, new_path

CHUNK = 1_000_000
STEPS = 100_000


def group_folds(df: DataFrame, keys: Sequence[str], n_folds: int) -> DataFrame:
    """One row per group with its size ``n`` and ``fold``.

    The rule: groups in order of falling size, ties by key, each to the lightest fold (the
    lowest number among equals). The rule is sequential, but only over distinct sizes: the
    groups of one size take the next free steps of the fold loads, which is a sort. The driver
    walks the distinct sizes one by one, holds the fold loads and ``STEPS`` steps, and appends
    those to a table, so its memory does not grow. Groups meet their fold in a join on
    (size, position).
    """
    keys = list(keys)
    # One row per group, read three times below.
    sizes = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    runs = sizes.groupBy("n").agg(F.count(F.lit(1)).alias("groups")).orderBy(F.desc("n"))
    spark, columns = df.sparkSession, "size bigint, fold int, load bigint, count bigint"
    path, loads, steps = new_path(spark, "steps"), [0] * n_folds, []
    for run in runs.toLocalIterator():
        taken = _share_out(loads, run["n"], run["groups"])
        for fold, count in enumerate(taken):
            if count:
                steps.append((run["n"], fold, loads[fold], count))
                loads[fold] += count * run["n"]
        if len(steps) >= STEPS:
            spark.createDataFrame(steps, columns).write.mode("append").parquet(path)
            steps = []
    spark.createDataFrame(steps, columns).write.mode("append").parquet(path)
    made = spark.read.schema(columns).parquet(path)
    # Very many groups of one size: start chunks first, so that no task makes all their places.
    start = F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1, F.lit(CHUNK))
    stop = F.least(F.col("_from") + CHUNK - 1, F.col("count") - 1)
    slots = (
        made.withColumn("_from", F.explode(start))
        .repartition("size", "fold", "_from")
        .withColumn("_t", F.explode(F.sequence("_from", stop)))
        .select("size", "fold", (F.col("load") + F.col("size") * F.col("_t")).alias("level"))
    )
    slots = row_numbers(slots, ["size"], ["level", "fold"], "_slot").select("size", "fold", "_slot")
    placed = row_numbers(sizes, ["n"], keys, "_at")
    return placed.join(
        slots, (placed["n"] == slots["size"]) & (placed["_at"] == slots["_slot"])
    ).select(*keys, "n", "fold")


def _share_out(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of ``groups`` equal items each fold gets when each goes to the lightest fold.

    Fold f offers places at loads[f], loads[f] + size, ...; the lowest places are filled.
    Bisect the highest level that is filled for certain, then give out what is left.
    """

    def below(level: int) -> list[int]:
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), max(loads) + size * (groups + 1)
    while low < high:
        middle = (low + high + 1) // 2
        if sum(below(middle)) <= groups:
            low = middle
        else:
            high = middle - 1
    taken = below(low)
    left = groups - sum(taken)
    for fold, load in enumerate(loads):
        if left and load <= low and (low - load) % size == 0:
            taken[fold] += 1
            left -= 1
    return taken


def with_folds(df: DataFrame, folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = folds.select(*[F.col(k).alias(f"_f_{k}") for k in keys], "fold")
    return df.join(other, same_keys(df, other, [(k, f"_f_{k}") for k in keys])).drop(
        *[f"_f_{k}" for k in keys]
    )
