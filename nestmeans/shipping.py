"""Make the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application (like ``--py-files``)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return spark
    target = os.path.join(tempfile.mkdtemp(prefix="nestmeans-ship-"), "nestmeans.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(_PACKAGE)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)
    return spark
