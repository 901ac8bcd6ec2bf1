"""Append, replace and partition-wise writers, and the audit-row form shared by the jobs."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.workspace import discard, release, stage


def append(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Write a new table version to a path of its own."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def audit_rows(
    df: DataFrame, table: str, record: Column, action: str, text: Column, by: str, clock: Clock
) -> DataFrame:
    """One audit row per input row. Action names are kept whole, whatever their length."""
    return df.select(
        F.lit(table).alias("TableName"),
        record.cast("long").alias("RecordID"),
        F.lit(action).alias("Action"),
        text.alias("NewValues"),
        F.lit(by).alias("ChangedBy"),
        clock.ts.alias("ChangedDate"),
    )


def upsert(table: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The table with changed columns replaced and unknown keys added; one change per key.

    Columns the change does not carry keep their old value.
    """
    marked = changes.withColumn("_changed", F.lit(True)).alias("n")
    old = table.alias("o")
    columns = []
    for name in table.columns:
        if name in key:
            columns.append(name)
        elif name in changes.columns:
            columns.append(F.when(F.col("_changed"), F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name))
        else:
            columns.append(F.col(f"o.{name}"))
    return old.join(marked, key, "full").select(*columns)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """Write a table with a folder per partition value; a partition holding most rows is written by many tasks."""
    dealt = df.hint("rebalance", *partition_by)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def merge_partitions(
    spark: SparkSession,
    path: str,
    key: list[str],
    partition_by: list[str],
    changes: DataFrame | None = None,
    removed: DataFrame | None = None,
) -> dict[str, int]:
    """Update, add and delete rows of a partitioned table, reading and rewriting only the partitions they lie in.

    ``changes`` has at most one row per key, with the key, the partition columns and any columns to replace; keys the
    table has not are added, with nulls for the columns not given. ``removed`` has keys and partition columns. The
    partition columns are part of a row's identity: a row that moves is removed in one partition and added in the
    other. Rows both changed and removed are removed. Null partition values are a partition of their own.

    The new partitions are written beside the table first and then put in place, so the table is not read while it
    changes; the same call can be repeated after a failure. Returns how many partitions were ``touched`` and how
    many of them were ``emptied``; partitions left without a row lose their folder, and a table left without any
    partition must be read with a schema.
    """
    table = spark.read.parquet(path)
    identity = [*key, *(n for n in partition_by if n not in key)]
    given = [df.select(*partition_by) for df in (changes, removed) if df is not None]
    # As many rows as there are partitions in the table and the change at most.
    touched = [tuple(r) for r in reduce(lambda a, b: a.unionByName(b), given).distinct().collect()] if given else []
    if not touched:
        return {"touched": 0, "emptied": 0}
    old = table.filter(in_partitions(touched, partition_by))
    # One structure as the key: nulls in it are equal, as in the folders' names.
    named = lambda df: df.withColumn("_row", F.struct(*identity))
    new = named(old).drop(*identity)
    carried = None if changes is None else named(_typed(changes, table)).drop(*identity)
    # Rows go before others change: the table's rows keep their place for the second join and cross a shuffle once.
    if removed is not None:
        gone = named(_typed(removed.select(*identity), table)).select("_row")
        new = new.join(gone, "_row", "left_anti")
        carried = None if carried is None else carried.join(gone, "_row", "left_anti")
    if carried is not None:
        new = upsert(new, carried, ["_row"])
    new = new.select("*", "_row.*")
    new = stage(new.select(*table.columns), "partitions")
    left = {tuple(r) for r in new.select(*partition_by).distinct().collect()}
    files = old.select(*partition_by, F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("_folder"))
    folders = {tuple(r)[:-1]: r["_folder"] for r in files.distinct().collect()}
    emptied = [folder for value, folder in folders.items() if value not in left]
    write_partitioned(new, path, partition_by)
    for folder in emptied:
        discard(spark, folder)
    release(new)
    return {"touched": len(touched), "emptied": len(emptied)}


def _typed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows with the column types of the table, as its folder names give them."""
    return rows.select(*[F.col(n).cast(table.schema[n].dataType).alias(n) for n in rows.columns])


def in_partitions(values: list[tuple], columns: list[str]) -> Column:
    """A condition on the partition columns alone, so that no other folder is opened."""
    if len(columns) == 1:
        given = [v for (v,) in values if v is not None]
        found = F.col(columns[0]).isin(given)
        return found | F.col(columns[0]).isNull() if len(given) < len(values) else found
    one = lambda row: reduce(and_, [F.col(n).eqNullSafe(F.lit(v)) for n, v in zip(columns, row)])
    return reduce(or_, [one(row) for row in values])
