"""Makes the package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import quillspark

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors through Spark, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(quillspark.__file__))
    folder = tempfile.mkdtemp(prefix="quillspark-code-")
    archive = shutil.make_archive(os.path.join(folder, "quillspark_code"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
