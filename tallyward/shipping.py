"""The package on the executors: tasks that call its functions import it there."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their Python finds it wherever the driver runs."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        base = os.path.join(tempfile.mkdtemp(prefix="package-"), "tallyward_package")
        shutil.copytree(os.path.dirname(os.path.abspath(__file__)), os.path.join(base, "tallyward"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", base))
        _shipped.add(app)
