"""Python workers that find this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Adds the folder of this package to the PYTHONPATH of workers started from now on.

    On a cluster that has the package installed, or in a folder of its own, this changes nothing.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *paths])
