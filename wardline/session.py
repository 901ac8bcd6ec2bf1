"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime plan changes: split skewed join partitions even where that costs one more
# shuffle, and let small join sides be found by their measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Shuffled bytes that one task reads at most, where keys allow: sorts and hash tables of a task then stay as small however
# large the tables are. A session that asks for less keeps its own size.
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 16 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that can change while a session runs; the rest of it is left alone."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(TASK_SIZE)) > TASK_BYTES:
        spark.conf.set(TASK_SIZE, str(TASK_BYTES))
    return spark
