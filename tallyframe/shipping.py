"""Sending this package to the Python workers of a cluster."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers of every executor import the package; done once for each application.

    Functions that run in Python workers travel by name, so that a worker must find
    their modules wherever it was started. Spark hands the archive out itself.
    """
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    made = tempfile.mkdtemp(prefix="package-")
    archive = shutil.make_archive(os.path.join(made, os.path.basename(folder)), "zip", os.path.dirname(folder), os.path.basename(folder))
    spark.sparkContext.addPyFile(archive)
    # executors that start later still ask the driver for it
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    _sent.add(application)
