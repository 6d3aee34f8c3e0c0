"""Samples that are the same rows on any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sample_order(keys: Sequence[str], seed: int) -> Column:
    """What a seeded sample is ordered by: the MD5 of the seed and the keys, with ``|`` between."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys]))


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most n rows, those whose keys hash lowest; equal keys are ordered by their other values."""
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumns({"_order": sample_order(keys, seed), "_rest": rest}).orderBy("_order", "_rest").limit(n).drop("_order", "_rest")
