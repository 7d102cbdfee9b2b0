"""Bring this library to the executors where it is not installed there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers once per application, as `spark-submit --py-files` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = os.path.join(tempfile.mkdtemp(), "gridloam.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(PACKAGE):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
