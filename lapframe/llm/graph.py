"""Connected components of a large graph."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.session import materialize


def local_components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node that links a-b reach."""
    label = np.arange(n)
    return merge(label, a, b)


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join components by more links; ``label`` names each node's least node, and is changed."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if len(a):
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up
    return label


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a long, b long)``: the least node it is linked with.

    Alternates large-star and small-star steps (each a partial aggregate and a join on the node)
    until nothing changes, which takes about as many rounds as the logarithm of the longest
    chain. Every round's links are written to the shared folder; none are collected.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen = materialize(edges, "links"), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                edges.select("v", "v").distinct()
            )
        seen = state
