"""Settings for work in Python tasks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

import wardline
from wardline.session import tune

#: Rows that go to Python at once: whole texts can be very long.
ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, the library's session settings, and this package on the workers' path."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    root = os.path.dirname(os.path.dirname(os.path.abspath(wardline.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return spark
