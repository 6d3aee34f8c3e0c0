"""Exact percentiles with linear interpolation, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapframe.operators.ordered import running_sum
from lapframe.operators.skew import same_keys
from lapframe.session import materialize, max_group_rows

# A task holds the distinct values of a group while ``percentile`` runs, and of up to 128
# groups at once, so groups must be far smaller here than where rows are only sorted. A
# group without keys is the only one.
GROUP_ROWS = 50_000
SINGLE_GROUP_ROWS = 1_000_000

# The sketch errs by at most 1 / accuracy of a group's rows; the bracket is several times wider.
ACCURACY = 20_000
BRACKET = 4 / ACCURACY


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Sequence[float],
    name: str = "percentiles",
    max_rows: int | None = None,
) -> DataFrame:
    """One row per group: the keys and an array with the exact percentiles of ``value``.

    The input is read twice. The first pass gives the size of each group and a mergeable
    sketch that brackets every percentile. When all groups are small the second pass is the
    built-in ``percentile``; otherwise it is ``_narrowed``, which never gathers a group.
    Without keys the whole input is one group.
    """
    keys = list(keys)
    by = keys or ["_all"]
    values = df.select(
        *(keys or [F.lit(1).alias("_all")]), F.col(value).cast("double").alias("_v")
    ).where(F.col("_v").isNotNull())
    grid = [min(1.0, max(0.0, p + d)) for p in fractions for d in (-BRACKET, BRACKET)]
    sketch = materialize(
        values.groupBy(*[F.col(k).alias(f"_s_{k}") for k in by]).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", grid, ACCURACY).alias("_cuts"),
        ),
        "sketch",
    )
    limit = min(
        max_group_rows(df.sparkSession, max_rows), GROUP_ROWS if keys else SINGLE_GROUP_ROWS
    )
    largest = sketch.agg(F.max("_n")).first()[0] or 0
    if largest <= limit:
        wanted = F.array(*[F.lit(float(p)) for p in fractions])
        return values.groupBy(*keys).agg(F.percentile("_v", wanted).alias(name))
    return _narrowed(values, sketch, by, fractions, name, max_rows).select(*keys, name)


def _narrowed(
    values: DataFrame,
    sketch: DataFrame,
    keys: list[str],
    fractions: Sequence[float],
    name: str,
    max_rows: int | None,
    checked: bool = False,
) -> DataFrame:
    """Count values one by one inside the brackets and in bulk between them.

    The running count says where each wanted rank lies, whatever the error of the sketch. A
    rank that misses its bracket, which the margin makes all but impossible, is looked up in
    its bulk interval by one more pass over the values. With ``checked`` the rows of each group, a
    sketch's or not, must be as many as its sketch has counted.
    """
    pairs = [(k, f"_s_{k}") for k in keys]
    cuts, v = F.col("_cuts"), F.col("_v")
    bracketed = F.lit(False)
    for i in range(len(fractions)):
        bracketed = bracketed | v.between(cuts[2 * i], cuts[2 * i + 1])
    placed = values.join(
        sketch.drop("_n"), same_keys(values, sketch, pairs), "left" if checked else "inner"
    ).select(
        *keys,
        F.size(F.filter(cuts, lambda c: c < v)).alias("_bin"),
        F.when(bracketed, v).alias("_kept"),
        "_v",
    )
    # Within a bin the bulk (null) lies below a kept value, and null sorts first.
    counts = materialize(
        placed.groupBy(*keys, "_bin", "_kept").agg(F.count(F.lit(1)).alias("_copies")), "counts"
    )
    if checked:
        _require_counts(counts, sketch, keys, pairs)
    ranked = running_sum(counts, keys, ["_bin", "_kept"], "_copies", "_end", max_rows)
    wanted = _wanted_ranks(sketch, pairs, fractions)
    hits = materialize(_at_rank(ranked, wanted, keys), "hits")

    missed = hits.where(F.col("_kept").isNull())
    found = hits.where(F.col("_kept").isNotNull()).withColumnRenamed("_kept", "_p")
    if not missed.isEmpty():
        spots = missed.select(*[F.col(k).alias(f"_m_{k}") for k in [*keys, "_bin"]]).distinct()
        bulk = placed.where(F.col("_kept").isNull())
        inside = bulk.join(
            spots, same_keys(bulk, spots, [(k, f"_m_{k}") for k in [*keys, "_bin"]]), "left_semi"
        )
        one_by_one = materialize(
            inside.groupBy(*keys, "_bin", "_v").agg(F.count(F.lit(1)).alias("_copies")), "bulk"
        )
        ranked = running_sum(one_by_one, [*keys, "_bin"], ["_v"], "_copies", "_end", max_rows)
        open_ = missed.select(
            *[F.col(k).alias(f"_w_{k}") for k in [*keys, "_bin"]],
            "_i",
            "_at",
            (F.col("_rank") - (F.col("_end") - F.col("_copies"))).alias("_rank"),
        )
        looked_up = _at_rank(ranked, open_, [*keys, "_bin"])
        found = found.select(*keys, "_i", "_at", "_p").unionByName(
            looked_up.select(*keys, "_i", "_at", F.col("_v").alias("_p"))
        )
    low, high = F.min("_p"), F.max("_p")
    share = F.max("_at") - F.floor(F.max("_at"))
    points = found.groupBy(*keys, "_i").agg((low + (high - low) * share).alias("_p"))
    # As many points per group as fractions were asked for.
    listed = F.array_sort(F.collect_list(F.struct("_i", "_p")))
    return points.groupBy(*keys).agg(F.transform(listed, lambda s: s["_p"]).alias(name))


def _require_counts(counts: DataFrame, sketch: DataFrame, keys: list[str], pairs: list[tuple[str, str]]) -> None:
    """Fail, naming one group, when a sketch has counted other rows than there are."""
    found = counts.groupBy(*keys).agg(F.sum("_copies").alias("_found"))
    both = found.join(sketch.select(*[s for _, s in pairs], "_n"), same_keys(found, sketch, pairs), "full")
    odd = both.where(~F.col("_found").eqNullSafe(F.col("_n"))).first()
    if odd:
        raise ValueError(f"{odd['_found']} rows, but sketches of {odd['_n']}: {odd.asDict()}")


def _wanted_ranks(
    sketch: DataFrame, pairs: list[tuple[str, str]], fractions: Sequence[float]
) -> DataFrame:
    """The two ranks (from 0) around each percentile: two rows per group and fraction."""
    spots = F.array(
        *[
            F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("at"))
            for i, p in enumerate(fractions)
        ]
    )
    names = [F.col(s).alias(f"_w_{k}") for k, s in pairs]
    rows = sketch.select(*names, F.explode(spots).alias("_spot")).select(
        *[f"_w_{k}" for k, _ in pairs], F.col("_spot.i").alias("_i"), F.col("_spot.at").alias("_at")
    )
    around = F.array_distinct(
        F.array(F.floor("_at").cast("bigint"), F.ceil("_at").cast("bigint"))
    )
    return rows.withColumn("_rank", F.explode(around))


def _at_rank(ranked: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The counted row that holds each wanted rank."""
    return ranked.join(
        wanted,
        same_keys(ranked, wanted, [(k, f"_w_{k}") for k in keys])
        & (F.col("_rank") < F.col("_end"))
        & (F.col("_rank") >= F.col("_end") - F.col("_copies")),
    ).drop(*[f"_w_{k}" for k in keys])
