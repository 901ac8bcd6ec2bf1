"""Facts stored bucketed and sorted by their common key, so that jobs per visit or patient need no shuffle.

Tables of a group (visits and their charges, payments, ...) are written with the same number of buckets of the same
key. Rows of one key then lie in the same bucket of every table, already sorted, and folds and joins on the key read
bucket by bucket. A key with a large part of the rows would fill one bucket; such keys are few, they are kept in
plain tables of their own, where folds combine in every task before they shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.clinical_reports import c
from wardline.operators.rows import union_all
from wardline.workspace import discard, run_dir

#: A key is heavy when a table has this many times the rows of an average bucket for it.
HEAVY = 2
#: Rows of the largest table in one bucket at most: a bucket is sorted in one task's memory.
ROWS_PER_BUCKET = 2_000_000
#: Lets joins on the key and further columns use the buckets of the key alone.
JOIN_SETTING = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Colocated:
    """A group of tables by name: the bucketed rows, and the rows of heavy keys where there are any."""

    key: str
    buckets: int
    even: dict[str, DataFrame]
    heavy: dict[str, DataFrame] | None
    stored: dict[str, str]

    def per_key(self, operator: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """An operator whose result for a key depends on that key's rows alone, over all rows."""
        parts = [operator(self.even)]
        if self.heavy is not None:
            parts.append(operator(self.heavy))
        return union_all(parts)


def heavy_keys(tables: dict[str, DataFrame], key: str, buckets: int) -> list:
    """Keys with more rows of a table than ``HEAVY`` average buckets: fewer than half the buckets per table."""
    found = set()
    for df in tables.values():
        counted = df.groupBy(key).agg(F.count("*").alias("_rows"))
        known = c(key).isNotNull()
        # One pass over the rows; only where the largest group is heavy, a second one names the heavy keys.
        one = counted.agg(F.sum("_rows").alias("rows"), F.max(F.when(known, c("_rows"))).alias("largest")).first()
        limit = max(HEAVY * (one["rows"] or 0) / buckets, 1)
        if (one["largest"] or 0) > limit:
            found |= {r[0] for r in counted.filter(known & (c("_rows") > limit)).select(key).collect()}
    return sorted(found)


def store(tables: dict[str, DataFrame], key: str, buckets: int, name: str) -> Colocated:
    """Write tables that share a key, and read them back; into more buckets than asked for where the rows need them.

    Null keys are kept with the even rows, dealt over the buckets' files as one key. Column names and rows are those
    of the input; the stored tables are catalog tables of this session, in the shared folder.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.conf.set(JOIN_SETTING, "false")
    buckets = max(buckets, -(-max(df.count() for df in tables.values()) // ROWS_PER_BUCKET))
    heavy = heavy_keys(tables, key, buckets)
    group = f"{name}_{uuid.uuid4().hex}"
    even, large, folders = {}, {}, {}
    for table, df in tables.items():
        rows = df.filter(c(key).isNull() | ~c(key).isin(heavy)) if heavy else df
        stored = f"{group}_{table}"
        # Dealt by the bucket function first, so that every bucket is one sorted file. The key is stored under another
        # name: read as an alias, it keeps its partitioning also through a union of several tables.
        dealt = rows.withColumnRenamed(key, f"{key}_stored").repartition(buckets, f"{key}_stored")
        writer = dealt.write.mode("overwrite").bucketBy(buckets, f"{key}_stored").sortBy(f"{key}_stored")
        folders[stored] = run_dir(spark, stored)
        writer.option("path", folders[stored]).saveAsTable(stored)
        even[table] = spark.table(stored).withColumnRenamed(f"{key}_stored", key)
        if heavy:
            folders[f"{stored}_heavy"] = path = run_dir(spark, f"{stored}_heavy")
            df.filter(c(key).isin(heavy)).write.parquet(path)
            large[table] = spark.read.schema(df.schema).parquet(path)
    return Colocated(key, buckets, even, large or None, folders)


def forget(spark: SparkSession, group: Colocated) -> None:
    """Drop the group's tables from the catalog and remove their files."""
    for name, folder in group.stored.items():
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        discard(spark, folder)
