"""The package on the workers of a cluster."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to all executors, once per application.

    Operators that run Python in tasks import it there. A job submitted with ``--py-files`` has it
    already and need not call this.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    # Spark serves the archive from the driver, so a folder of the driver's own will do.
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name)
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), name))
    _SHIPPED.add(application)
