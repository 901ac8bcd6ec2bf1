"""Where intermediate tables and stream state go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, the context's checkpoint folder, or one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    given = spark._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/wardline-staging"


_kept: set[str] = set()


def run_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used.

    All paths of an application lie in one folder, which is removed when its driver ends.
    """
    own = f"{shared_dir(spark).rstrip('/')}/wardline-{spark.sparkContext.applicationId}"
    if own not in _kept:
        folder = spark._jvm.org.apache.hadoop.fs.Path(own)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        _kept.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a reused intermediate once and read it back, which also cuts lineage."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    if _scopes:
        _scopes[-1].append(staged)
    return staged


_scopes: list[list[DataFrame]] = []


@contextmanager
def released() -> Iterator[None]:
    """Removes what was staged inside when the block ends: for callers that write a job's result in the block."""
    _scopes.append([])
    try:
        yield
    finally:
        release(*_scopes.pop())


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that no query can read any more, after a step that wrote its result.

    Its cleaner removes them once the driver has collected their plan, by default half an hour later.
    """
    spark._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(*staged: DataFrame) -> None:
    """Remove staged tables, as ``stage`` returned them, that no later result reads."""
    for df in staged:
        discard(df.sparkSession, df.staged_at)
