"""Send this package to the executors."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapframe.workers import send_package

# Rows and bytes of an Arrow batch. A row here is a whole document or a block of some megabytes, and a batch is held
# once by the JVM and once by Python. Spark's own limits are 10,000 rows and hundreds of megabytes.
BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_OWN, LONG_ROWS, LARGE_ROWS = "10000", "1000", "4m"


def ship(spark: SparkSession) -> None:
    """Give the package's modules to the Python workers of this application, once.

    A session that has not set the size of Arrow batches gets one that suits long rows.
    """
    if spark.conf.get(BATCH_ROWS) == SPARKS_OWN:
        spark.conf.set(BATCH_ROWS, LONG_ROWS)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, LARGE_ROWS)
    send_package(spark)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
