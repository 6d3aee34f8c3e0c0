"""Level dictionaries and sparse one-hot rows, for text columns with any number of levels.

The levels of all columns are a written table, never a list on the driver. A row's one-hot columns are two arrays, the
slots that are one and their values, as in a compressed sparse row matrix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapframe.operators.features import one_hot_long
from lapframe.operators.ordered import row_numbers
from lapframe.session import materialize


def level_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The written table ``feature, level, code, slot``: every level that occurs.

    ``code`` counts the levels of a column from 0 in their order. ``slot`` counts on over all columns, in
    the order that they are named in. Columns that do not exist have no levels.
    """
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "feature string, level string, code bigint, slot bigint")
    distinct = materialize(one_hot_long(df, [], present).distinct(), "levels")
    sizes = {r["feature"]: r["n"] for r in distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for c in present:
        offsets += [F.lit(c), F.lit(before)]
        before += sizes.get(c, 0)
    numbered = row_numbers(distinct, ["feature"], ["level"], "_n")
    code = (F.col("_n") - 1).cast("bigint")
    return materialize(
        numbered.select("feature", "level", code.alias("code"), (code + F.create_map(*offsets)[F.col("feature")]).alias("slot")), "dictionary"
    )


def with_codes(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, name: str = "{}_code", of: str = "code") -> DataFrame:
    """The rows with a code for each column; null for a null and for a level that the dictionary lacks.

    The dictionary's true size decides how Spark joins it.
    """
    for c in columns:
        own = dictionary.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col(of).alias(name.format(c)))
        value = F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")
        df = df.withColumn("_value", value).join(own, F.col("_value") == F.col("_level"), "left").drop("_value", "_level")
    return df


def sparse_rows(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, indices: str = "indices", values: str = "values") -> DataFrame:
    """The rows with their one-hot columns as the sorted slots that are one, and as many ones."""
    columns = list(dict.fromkeys(columns))
    names = [f"_slot_{i}" for i in range(len(columns))]
    out = df
    for c, n in zip(columns, names):
        out = with_codes(out, [c], dictionary, n, "slot")
    slots = F.array(*[F.col(n) for n in names]) if names else F.array().cast("array<bigint>")
    out = out.withColumn(indices, F.array_sort(F.filter(slots, lambda s: s.isNotNull())))
    return out.withColumn(values, F.transform(indices, lambda s: F.lit(1.0))).drop(*names)
