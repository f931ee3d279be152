"""Makes the package importable on executors that do not have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship_package(spark: SparkSession) -> None:
    """Sends the package once per Spark context, through Spark's own file distribution."""
    context = spark.sparkContext
    if getattr(context, "_text_operators_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "skyledger.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(_ROOT, "skyledger")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, _ROOT))
    context.addPyFile(path)
    context._text_operators_shipped = True
