"""Give Python workers the package."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give the package's modules to the Python workers of this application, once.

    A session started with ``--py-files`` has them already; this makes Arrow functions work in any
    session. Spark itself copies the file from the driver to the executors.
    """
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lapframe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = Path(folder) / "lapframe.zip"
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(name))
    _sent.add(application)
