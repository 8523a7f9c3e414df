"""Send this package to the executors, where they do not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: Python tasks import the package by name."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="eavspark-ship-")
    archive = os.path.join(folder, "eavspark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for root, _, files in os.walk(_PACKAGE):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(root, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
