"""Send this package to the executors, so that functions pickled by reference import there."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows travel to Python workers in batches of about so many bytes, whatever the length of texts: both the
#: executor and the worker hold a batch whole. Texts are worked on in slices of 6 MB at most, so that a batch is one slice or a few.
BATCH_BYTES = 11 << 19
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: One archive for each application; the driver serves it as long as the process lives.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Add the package as a zip file to the application, once. Spark serves the file to every
    executor, so nothing has to be installed or shared beforehand."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    if BATCH_SETTING not in dict(context.getConf().getAll()):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    package = Path(__file__).resolve().parent
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
    copy = Path(folder.name) / "copy" / package.name
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__", "data"))
    context.addPyFile(shutil.make_archive(f"{folder.name}/{package.name}", "zip", copy.parent, package.name))
