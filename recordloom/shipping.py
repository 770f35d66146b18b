"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application.

    Not needed when it is installed there or was given with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
