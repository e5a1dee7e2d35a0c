"""Sending this package to the executors, for operators that run Python there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of a session import this package, once for each application.

    The same as submitting it with ``--py-files``: the driver packs its sources and Spark hands
    them to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="voxtable-"), "voxtable.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
