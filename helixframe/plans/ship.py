"""Makes this package importable on executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context, unless their path already has it."""
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_helixframe_shipped", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._helixframe_shipped = True
