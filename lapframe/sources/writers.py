"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapframe.sources.named_files import NamedFiles
from lapframe.workers import send_package


def partitioned_parquet(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Snappy Parquet in one folder per season and event.

    The rebalance hint brings each folder's rows together so that folders hold few files, and
    adaptive execution splits a folder that is too large for one task.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).option(
        "compression", "snappy"
    ).parquet(path)


def land_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write events into their folders, replacing the folders that occur in ``df`` and no others.

    The new files are written aside first, so rows may come from the folders that they replace.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).option(
        "compression", "snappy"
    ).parquet(path)


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def named_files(lines: DataFrame, path: str, name: str, line: str, order: Sequence[str] = ()) -> None:
    """Text files below ``path`` under the names in the column ``name``, their lines in the given order.

    A file is one task's, which holds one batch of its lines at a time. A null line writes nothing, so a file may be empty;
    a null name, and one that Spark's readers would hide, is an error. Files of other names stay.
    """
    spark = lines.sparkSession
    send_package(spark)
    spark.dataSource.register(NamedFiles)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(conf)
    folder = folder.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    together = lines.repartition(F.col(name)).sortWithinPartitions(name, *order)
    together.select(F.col(name).cast("string").alias("name"), F.col(line).cast("string").alias("line")).write.format(
        "named_files"
    ).mode("append").save(folder)


def metrics_json(folds: DataFrame, overall: DataFrame, n_features: int, path: str) -> None:
    """One JSON record: overall rmse, mae, n_rows, n_features, and the list of folds.

    ``folds`` has one row per fold, a handful, so its list fits one row.
    """
    listed = folds.agg(
        F.array_sort(F.collect_list(F.struct("fold", "rmse", "mae"))).alias("cv")
    )
    record = overall.select(
        "rmse", "mae", F.col("n").alias("n_rows"), F.lit(n_features).alias("n_features"),
        listed.scalar().alias("cv"),
    )
    record.write.mode("overwrite").json(path)
