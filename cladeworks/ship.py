"""Gives executors the package, where they don't have it installed: Spark serves it to them as one zip."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Once a session; tasks that start afterwards can import the package."""
    context = spark.sparkContext
    if getattr(context, "_cladeworks", False):
        return
    path = os.path.join(tempfile.mkdtemp(), "cladeworks.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    context.addPyFile(path)
    context._cladeworks = True
