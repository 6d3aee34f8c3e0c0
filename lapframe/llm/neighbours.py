"""Approximate nearest neighbours by cosine over shifted Hilbert orderings.

Vectors are brought to length one and projected on ``curves`` groups of three orthogonal random
directions. Each group's three coordinates, on a grid with its own random shift, give a Hilbert
key, and the keys' quantiles (of a bounded sample, ``sample_rows``) cut the curve into ranges of
about equal size. Spark sends every vector to its range on every curve. A query uses the
``best`` curves on which its own projection is longest, since its neighbours crowd there, and goes to its
range and the neighbouring ones that make up a ``window`` of the curve. Each range is reranked by
exact cosines, and the windows' results are merged.

Equal vectors are folded first, each with as many of its least ids as a result can need, so a vector
that a third of all rows share is one entry. The number of ranges grows with the rows, so a range
stays of a bounded size.

Rows whose id is null, or whose vector is null, zero, of another dimension than most, or has a null or
non-finite component, take no part. Rows that share an id are one candidate for each vector they
hold, and none for a query with that id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapframe.llm.blocks import joined, routed
from lapframe.session import materialize

K = 5
CURVES = 12
AXES = 3
BEST = 5
WINDOW = 0.22
BITS = 12
RANGE_ROWS = 20_000
SAMPLE_ROWS = 20_000
#: More than two products of unit vectors can differ by rounding.
ROUNDING = 1e-11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of grid cells (rows of coordinates below 2**bits).

    By Gray code and rotations, one bit plane after the other from the top.
    """
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for plane in range(bits - 1, 0, -1):
        bit, low = 1 << plane, (1 << plane) - 1
        for i in range(axes):
            high = (x[:, i] & bit) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for plane in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & (1 << plane), (1 << plane) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for plane in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[:, i] >> plane) & 1)
    return key


class Curves:
    """Random directions and grid shifts of several orderings, the same for a seed and dimension."""

    def __init__(self, dimension: int, curves: int = CURVES, axes: int = AXES, seed: int = 7):
        random = np.random.default_rng(seed)
        self.axes = min(axes, dimension)
        groups = max(1, dimension // self.axes)
        turns = [np.linalg.qr(random.normal(size=(dimension, dimension)))[0] for _ in range(-(-curves // groups))]
        self.sets = [turns[c // groups][:, (c % groups) * self.axes : (c % groups + 1) * self.axes] for c in range(curves)]
        # Projections of unit vectors spread by about one over the root of the dimension.
        self.reach = min(1.0, 5 / np.sqrt(dimension))
        self.shift = random.uniform(0, 0.25, size=(curves, self.axes))

    def keys(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per curve the keys of unit vectors and the lengths of their projections."""
        keys, lengths = [], []
        for axes, shift in zip(self.sets, self.shift):
            p = unit @ axes
            grid = ((p / self.reach + 1) / 2 * 0.75 + shift) * (1 << BITS)
            keys.append(hilbert_keys(np.clip(grid, 0, (1 << BITS) - 1), BITS))
            lengths.append(np.linalg.norm(p, axis=1))
        return np.array(keys), np.array(lengths)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimension).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _placed(curves: Curves, cuts: np.ndarray, dimension: int, best: int, window: int, is_query: bool):
    """Send vectors to their range on every curve, queries to their windows on the best ones."""
    n_ranges = cuts.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["embedding"], dimension)
            keys, lengths = curves.keys(_unit(x))
            at = np.array([np.searchsorted(c, k, "right") for c, k in zip(cuts, keys)])
            n = len(at)
            if is_query:
                chosen = np.argsort(-lengths, axis=0, kind="stable")[: min(best, n)]
                first = np.clip(at - window // 2, 0, max(0, n_ranges - window))
                width = min(window, n_ranges)
                share = (chosen * n_ranges + np.take_along_axis(first, chosen, 0))[:, None, :] + np.arange(width)[None, :, None]
            else:
                share = (np.arange(n)[:, None] * n_ranges + at)[:, None, :]
            row = np.broadcast_to(np.arange(len(x)), share.shape).ravel()
            ids = np.asarray(batch["ids"].flatten()).reshape(len(x), -1)
            yield routed(
                share.ravel(),
                n * n_ranges,
                {"vectors": x[row], "ids": ids[row]},
                {"query": int(is_query), "width": ids.shape[1]},
            )

    return run


PLACED = "share int, query long, width long, vectors binary, ids binary"
FOUND = "query_id long, vec_id long, score double"
NO_ID = -(1 << 63)


def _reranked(dimension: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        def part(query: int) -> tuple[np.ndarray, np.ndarray]:
            rows = table.filter(pc.equal(table["query"], query))
            x = joined(rows["vectors"], np.float64).reshape(-1, dimension)
            return x, joined(rows["ids"], np.int64).reshape(len(x), -1) if len(x) else np.zeros((0, 1), np.int64)

        vectors, ids = part(0)
        queries, names = part(1)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        unit = _unit(vectors) if len(vectors) else vectors
        for i in range(0, len(queries) if len(vectors) else 0, 256):
            near = _unit(queries[i : i + 256]) @ unit.T
            # The query's own vector may be one of the nearest. What rounding may have put below the last is compared exactly.
            last = near.shape[1] - min(k + 1, near.shape[1])
            least = np.partition(near, last, axis=1)[:, last] - ROUNDING
            for q, own in enumerate(names[i : i + 256, 0]):
                some = np.flatnonzero(near[q] >= least[q])
                score = cosine(queries[i + q], vectors[some])
                who, score = ids[some].ravel(), np.repeat(score, ids.shape[1])
                keep = (who != own) & (who != NO_ID)
                who, score = who[keep], score[keep]
                order = np.lexsort((who, -score))[:k]
                out.append((np.full(len(order), own), who[order], score[order]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows of others, summed in the same order wherever they stand."""
    one, others = a / np.abs(a).max(), b / np.abs(b).max(axis=1, keepdims=True)
    return (one * others).sum(axis=1) / (np.sqrt((one * one).sum()) * np.sqrt((others * others).sum(axis=1)))


def search(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    curves: int = CURVES,
    best: int = BEST,
    window: float = WINDOW,
    range_rows: int = RANGE_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query(id column)`` holds: ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding")).dropna()
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    dimension = sizes[0]["size"] if sizes else 0
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fit = F.size("embedding") == dimension
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.filter(fit & finite & F.exists("embedding", lambda v: v != 0)).withColumn(
        "embedding", F.transform("embedding", lambda v: v + F.lit(0.0))  # one zero
    )
    # Equal vectors are one, with their k + 1 least ids (a query may be one of them).
    least = Window.partitionBy("embedding").orderBy("id")
    folded = rows.distinct().withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
    folded = folded.groupBy("embedding").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    filler = F.array_repeat(F.lit(NO_ID), k + 1)
    folded = materialize(folded.select("embedding", F.slice(F.concat("ids", filler), 1, k + 1).alias("ids")), "vectors")
    queries = rows.filter(is_query(F.col("id"))).distinct().select("embedding", F.array("id").alias("ids"))

    n = folded.count()
    n_ranges = max(1, min(40, n // 50), n // range_rows)
    width = max(1, min(n_ranges, 2 * round(window * n_ranges / 2) + 1))
    orderings = Curves(dimension, curves)
    sample = folded.select("embedding").orderBy(F.xxhash64("embedding")).limit(sample_rows).toArrow()["embedding"].combine_chunks()
    keys = orderings.keys(_unit(_matrix(sample, dimension)))[0] if len(sample) else np.zeros((curves, 1), np.int64)
    cuts = np.quantile(keys, np.arange(1, n_ranges) / n_ranges, axis=1, method="higher").T.reshape(curves, -1)

    placed = folded.mapInArrow(_placed(orderings, cuts, dimension, best, width, False), PLACED)
    asked = queries.mapInArrow(_placed(orderings, cuts, dimension, best, width, True), PLACED)
    found = placed.unionAll(asked).groupBy("share").applyInArrow(_reranked(dimension, k), FOUND)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return merged.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0)
