"""Window expressions over ordered groups of any size.

A window puts each whole group into one task. That is the best plan while groups are
small, and it is the plan used when a count shows they are. A group above the limit is
cut into consecutive blocks by range partitioning on (keys, order). Each block receives
a few carry rows that stand for the rows before or after it, the same window runs per
block, and the carry rows are dropped. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lapframe.operators.skew import same_keys, split_hot
from lapframe.session import materialize, max_group_rows

# (rows, partition columns, order columns) -> rows with more columns
WindowStep = Callable[[DataFrame, list[str], list[str]], DataFrame]


def over_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: WindowStep,
    *,
    back: int = 0,
    ahead: int = 0,
    sums: Sequence[str] = (),
    lasts: Sequence[str] = (),
    max_rows: int | None = None,
    fits: bool = False,
) -> DataFrame:
    """Run ``step`` over each group in order.

    What the step may look at outside its block is declared: ``back`` and ``ahead`` rows,
    running ``sums`` of columns from the start of the group, and the ``lasts`` non-null
    value of columns. ``order`` is ascending and must be a total order where ties matter.
    ``fits`` says that a count over the same groups was already made and found none too large.
    """
    keys, order = list(keys), list(order)
    split = None if fits else split_hot(df, keys, max_rows)
    if split is None:
        return step(df, keys, order)

    n_blocks = max(2, -(-split.hot_rows // max_group_rows(df.sparkSession, max_rows)))
    # A row number breaks ties, so a long run of equal rows can be cut as well. It depends on
    # the task that made it, so it is written down before anything relies on it.
    numbered = materialize(split.hot.withColumn("_mix", F.monotonically_increasing_id()))
    order = [*order, "_mix"]
    blocked = materialize(
        numbered.repartitionByRange(n_blocks, *keys, *order).withColumn(
            "_block", F.spark_partition_id()
        )
    )
    block_keys = [*keys, "_block"]
    # One row per (group, block), numbered within the group; as small as the block count.
    blocks = (
        blocked.groupBy(*block_keys).agg(
            *[F.sum(c).alias(f"_sum_{c}") for c in sums],
            *[
                F.expr(
                    f"max_by(struct(`{c}`), struct({', '.join(f'`{o}`' for o in order)}))"
                    f" filter (where `{c}` is not null)"
                ).alias(f"_last_{c}")
                for c in lasts
            ],
            F.count(F.lit(1)).alias("_rows"),
        )
        .withColumn("_seq", F.row_number().over(Window.partitionBy(*keys).orderBy("_block")))
    )
    pieces = [blocked.withColumn("_side", F.lit(0))]
    if back:
        pieces.append(_edge_rows(blocked, blocks, keys, order, back, last=True))
    if ahead:
        pieces.append(_edge_rows(blocked, blocks, keys, order, ahead, last=False))
    if sums or lasts:
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = blocks.select(
            *block_keys,
            *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(c) for c in sums],
            *[
                F.last(f"_last_{c}", ignorenulls=True).over(before).getField(c).alias(c)
                for c in lasts
            ],
        ).withColumn("_side", F.lit(-1))
        pieces.append(carried)
    rows = pieces[0]
    for piece in pieces[1:]:
        rows = rows.unionByName(piece, allowMissingColumns=True)
    hot = step(rows, block_keys, ["_side", *order]).where(F.col("_side") == 0)
    hot = hot.drop("_side", "_block", "_mix")
    return step(split.cold, keys, order[:-1]).unionByName(hot)


def _edge_rows(
    blocked: DataFrame,
    blocks: DataFrame,
    keys: list[str],
    order: list[str],
    n: int,
    *,
    last: bool,
) -> DataFrame:
    """The last (or first) n rows of each block, sent to the next (or previous) n blocks.

    A block may hold fewer than n rows, so n neighbours are enough: none is empty.
    """
    direction = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    edge = blocked.withColumn(
        "_edge", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*direction))
    ).where(F.col("_edge") <= n).drop("_edge")

    source = blocks.select(*[F.col(k).alias(f"_src_{k}") for k in [*keys, "_block", "_seq"]])
    edge = edge.join(
        source, same_keys(edge, source, [(k, f"_src_{k}") for k in [*keys, "_block"]])
    ).drop(*[f"_src_{k}" for k in [*keys, "_block"]], "_block")
    sign = 1 if last else -1
    edge = edge.withColumn(
        "_target", F.explode(F.array(*[F.col("_src__seq") + sign * i for i in range(1, n + 1)]))
    )
    target = blocks.select(*[F.col(k).alias(f"_dst_{k}") for k in [*keys, "_seq"]], "_block")
    edge = edge.join(
        target,
        same_keys(edge, target, [(k, f"_dst_{k}") for k in keys])
        & (edge["_target"] == target["_dst__seq"]),
    )
    return edge.drop(*[f"_dst_{k}" for k in [*keys, "_seq"]], "_src__seq", "_target").withColumn(
        "_side", F.lit(-sign)
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str,
    max_rows: int | None = None,
    fits: bool = False,
) -> DataFrame:
    """Sum of ``column`` from the first row of the group to this one."""

    def step(rows: DataFrame, part: list[str], by: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(name, F.sum(column).over(w))

    return over_groups(df, keys, order, step, sums=[column], max_rows=max_rows, fits=fits)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    max_rows: int | None = None,
    fits: bool = False,
) -> DataFrame:
    """Position of each row in its group, from 1."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(counted, keys, order, "_one", name, max_rows, fits).drop("_one")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lags: dict[str, tuple[str, int]] | None = None,
    leads: dict[str, tuple[str, int]] | None = None,
    max_rows: int | None = None,
    fits: bool = False,
) -> DataFrame:
    """Add lagged and leading values: ``{new name: (column, steps)}``. One sort serves all."""
    lags, leads = lags or {}, leads or {}

    def step(rows: DataFrame, part: list[str], by: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*by)
        return rows.withColumns(
            {
                **{name: F.lag(col, n).over(w) for name, (col, n) in lags.items()},
                **{name: F.lead(col, n).over(w) for name, (col, n) in leads.items()},
            }
        )

    return over_groups(
        df,
        keys,
        order,
        step,
        back=max((n for _, n in lags.values()), default=0),
        ahead=max((n for _, n in leads.values()), default=0),
        max_rows=max_rows,
        fits=fits,
    )


def last_known(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: str,
    *,
    max_rows: int | None = None,
    fits: bool = False,
) -> DataFrame:
    """As-of join: every left row with the latest right row at or before it, per key.

    Both sides are united and sorted once; the newest right row is carried forward, so
    no pairs are formed. The right columns arrive as one struct named ``payload``, null
    when nothing precedes. A right row with null values still counts as the match.
    Among right rows at one time, the greatest in column order wins. As in any join, a null
    key or time matches nothing.
    """
    keys = list(keys)
    right_rows = right.dropna(subset=[*keys, right_time]).select(
        *keys,
        F.col(right_time).alias("_t"),
        F.lit(0).alias("_tag"),
        F.struct(*[F.col(c) for c in right.columns if c not in keys]).alias(payload),
    )
    left_rows = left.withColumns({"_t": F.col(left_time), "_tag": F.lit(1)})
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)

    def step(rows: DataFrame, part: list[str], by: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(payload, F.last(payload, ignorenulls=True).over(w))

    done = over_groups(
        both, keys, ["_t", "_tag", payload], step, lasts=[payload], max_rows=max_rows, fits=fits
    )
    return done.where(F.col("_tag") == 1).select(*left.columns, payload)
