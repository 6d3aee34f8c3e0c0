"""Percentile sketches that are stored per group, merged, and turned into exact percentiles by one read of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lapframe.operators.quantiles import _narrowed

K = 2000  # some 50 KB a group

#: Fixed: how the rank error of a KLL sketch, as a share of the rows, follows from k (at 99 % confidence).
RANK_ERROR = (2.296, 0.9723)


def rank_error(k: int) -> float:
    factor, power = RANK_ERROR
    return factor / k**power


class SketchTable:
    """KLL sketches of one column in a folder, one row per group, such as a race.

    Each landing adds the sketches of its own rows. ``part`` is the key whose folders are replaced when they land again, as
    ``writers.land_partitions`` replaces the rows. Sketches merge, so percentiles by fewer keys, or of everything, need no new
    ones. NULL values are not counted, and a group without values has no percentiles.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], part: str, value: str, k: int = K):
        self.spark, self.path, self.keys, self.part, self.value, self.k = spark, path, list(keys), part, value, k
        if part not in self.keys or len(self.keys) < 2:
            raise ValueError("the part is one of several keys")

    def add(self, rows: DataFrame) -> None:
        """Sketch landed rows: one pass, merged before the shuffle. Each part must come whole."""
        value = F.col(self.value).cast("double")
        sketches = rows.groupBy(*self.keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(value, F.lit(self.k)).alias("sketch"))
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)

    def merged(self, by: Sequence[str], kinds: T.StructType) -> DataFrame:
        """``n`` and ``sketch`` for each group of fewer (or the same) keys. ``kinds`` has the keys' types."""
        fields = [kinds[k] for k in self.keys]
        schema = T.StructType([*fields, *T.StructType().add("n", "long").add("sketch", "binary").fields])
        try:
            stored = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], schema)
        return stored.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))

    def approximate(self, by: Sequence[str], fractions: Sequence[float], kinds: T.StructType, name: str = "percentiles") -> DataFrame:
        """Percentiles off by ``rank_error(k)`` in rank at most (99 % of cases), without reading a row."""
        return self.merged(by, kinds).where("n > 0").select(*by, _at(fractions).alias(name))

    def exact(
        self, rows: DataFrame, by: Sequence[str], fractions: Sequence[float], name: str = "percentiles", max_rows: int | None = None
    ) -> DataFrame:
        """Exact percentiles of rows that have all been added, by some of the keys (none: of everything).

        The merged sketches bracket each percentile, and one pass over the rows counts values one by one inside the
        brackets and in bulk outside. The counts decide, so the sketch's error costs time only: a bracket that misses is looked up by one
        more pass. A group whose stored count differs from the rows' is an error: a landing was not added.
        """
        by = list(by)
        keys = by or ["_all"]
        margin = 2 * rank_error(self.k)
        grid = [min(1.0, max(0.0, p + d)) for p in fractions for d in (-margin, margin)]
        held = self.merged(by, rows.schema).withColumn("_all", F.lit(1)).where("n > 0")
        cuts = held.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("n").alias("_n"), _at(grid).alias("_cuts"))
        values = rows.select(*(by or [F.lit(1).alias("_all")]), F.col(self.value).cast("double").alias("_v")).where("_v IS NOT NULL")
        return _narrowed(values, cuts, keys, fractions, name, max_rows, checked=True).select(*by, name)


def _at(fractions: Sequence[float]) -> Column:
    return F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in fractions]))
