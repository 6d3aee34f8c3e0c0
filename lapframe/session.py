"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of one group that a single task may sort or hold. Larger groups are split.
MAX_GROUP_ROWS_CONF = "spark.lapframe.maxGroupRows"
MAX_GROUP_ROWS_DEFAULT = 4_000_000

# Applications and folders of which it is known that the driver sees what tasks write there.
_reached: set[tuple[str, str]] = set()


def build_session(app: str = "lapframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def max_group_rows(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    return int(spark.conf.get(MAX_GROUP_ROWS_CONF, str(MAX_GROUP_ROWS_DEFAULT)))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``, and it must be on storage that all nodes share.
    A plain path or ``file:`` may be such storage, mounted on every node, or the disk of one machine,
    where tables would lose rows. So the executors are asked, once for each application.
    Only a local session may fall back to a temporary folder, which goes when Python ends; there
    every task sees the same disk.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.master.startswith("local") and _is_local_path(spark, configured):
            _require_reached(spark, configured)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="lapframe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _is_local_path(spark: SparkSession, path: str) -> bool:
    """Whether a path names a machine's own disk: by its scheme, or by the default file system's."""
    if "://" not in path and not path.startswith("file:"):
        path = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path.startswith("file:")


def _require_reached(spark: SparkSession, folder: str) -> None:
    """Raise unless the driver finds the rows that tasks on the executors write below the folder."""
    context = spark.sparkContext
    if (context.applicationId, folder) in _reached:
        return
    tasks = max(2, context.defaultParallelism)
    written = f"{folder}/probe-{uuid.uuid4().hex}"
    spark.range(0, tasks, 1, tasks).write.parquet(written)
    found = spark.read.schema("id long").parquet(written).count()
    path = context._jvm.org.apache.hadoop.fs.Path(written)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    if found != tasks:
        raise RuntimeError(f"spark.checkpoint.dir is {folder!r}, a folder of one machine")
    _reached.add((context.applicationId, folder))


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back.

    A lost executor then costs no recomputation, later readers prune columns, and the
    planner knows the true size. Use it for what several later steps share.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the written table that ``materialize`` read back, once nothing reads it any more."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        inside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).makeQualified(system.getUri(), system.getWorkingDirectory())
        if path.getParent().equals(inside):
            system.delete(path, True)
