"""Making the package importable on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers of this application, once.

    Kernels are pickled by reference, so workers need the package. A cluster that has it
    installed, or a job submitted with ``--py-files``, does not need this call.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="isotherm-src-"), "isotherm")
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", root, "isotherm"))
    _shipped.add(app)
