"""The package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the executors' Python workers, once per application, so
    that they find it wherever they and the driver were started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver's own copy; Spark serves it to the executors
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "tallyweave.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "tallyweave")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
