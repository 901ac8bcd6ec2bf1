"""Partition-wise table versions: only the partitions a change touches are rewritten."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.compare import values
from wardline.sources.sinks import merge_partitions, upsert, write_partitioned
from wardline.workspace import run_dir

ROWS = [(k, f"2001-{1 + k % 6:02d}" if k % 7 else None, k * 10, "old") for k in range(60)]
SCHEMA = "id long, month string, amount long, note string"


@pytest.fixture
def table(spark):
    path = run_dir(spark, "table")
    write_partitioned(spark.createDataFrame(ROWS, SCHEMA), path, ["month"])
    return path


def files(path):
    return {
        os.path.relpath(os.path.join(d, n), path): os.stat(os.path.join(d, n)).st_mtime_ns
        for d, _, names in os.walk(path)
        for n in names
        if n.endswith(".parquet")
    }


def rows(spark, path):
    return values(spark.read.parquet(path), "id", "month", "amount", "note")


def test_update_add_and_delete(spark, table):
    before = files(table)
    month = {i: m for i, m, *_ in ROWS}
    changes = [(1, month[1], 111), (13, month[13], 222), (900, month[1], 333), (901, "2002-01", 444)]
    removed = [(25, month[25]), (13, month[13]), (31, "2001-05")]
    made = merge_partitions(
        spark, table, ["id"], ["month"],
        spark.createDataFrame(changes, "id int, month string, amount int"),
        spark.createDataFrame(removed, "id long, month string"),
    )
    after = files(table)
    touched = {month[1], month[13], month[25], "2002-01", "2001-05"}
    assert made == {"touched": len(touched), "emptied": 0}
    kept = {n for n in before if n.split("/")[0].split("=")[1] not in touched}
    assert kept and all(after[n] == before[n] for n in kept)
    assert not [n for n in after if n in before and n not in kept]
    want = {i: (i, m, a, n) for i, m, a, n in ROWS}
    want[1], want[900], want[901] = (1, month[1], 111, "old"), (900, month[1], 333, None), (901, "2002-01", 444, None)
    # The row named under another month than its own stays.
    del want[13], want[25]
    assert rows(spark, table) == sorted(want.values(), key=repr)


def test_emptied_and_null_partitions(spark, table):
    month = {i: m for i, m, *_ in ROWS}
    gone = [(i, m) for i, m in month.items() if m == "2001-02" or i == 14]
    changes = spark.createDataFrame([(7, None, 5)], "id long, month string, amount long")
    made = merge_partitions(spark, table, ["id"], ["month"], changes, spark.createDataFrame(gone, "id long, month string"))
    assert made == {"touched": 2, "emptied": 1} and not os.path.exists(f"{table}/month=2001-02")
    want = [(i, m, 5 if i == 7 else a, n) for i, m, a, n in ROWS if (i, m) not in gone]
    assert rows(spark, table) == sorted(want, key=repr)


def test_a_repeated_call_changes_nothing_more(spark, table):
    changes = spark.createDataFrame([(1, "2001-02", 111), (5000, "2001-02", 9)], "id long, month string, amount long")
    removed = spark.createDataFrame([(19, "2001-02")], "id long, month string")
    merge_partitions(spark, table, ["id"], ["month"], changes, removed)
    once = rows(spark, table)
    merge_partitions(spark, table, ["id"], ["month"], changes, removed)
    assert rows(spark, table) == once


def test_nothing_to_do(spark, table):
    before = files(table)
    none = spark.createDataFrame([], "id long, month string")
    assert merge_partitions(spark, table, ["id"], ["month"]) == {"touched": 0, "emptied": 0}
    assert merge_partitions(spark, table, ["id"], ["month"], removed=none)["touched"] == 0
    assert files(table) == before


def test_other_folders_are_not_opened(spark, table):
    from wardline.sources.sinks import in_partitions

    scan = spark.read.parquet(table).filter(in_partitions([("2001-02",), (None,)], ["month"]))
    assert all("month=2001-02" in f or "__HIVE_DEFAULT_PARTITION__" in f for f in scan.select("_metadata.file_path").distinct().toPandas()["file_path"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(month" in plan.replace("((month", "(month") and "Filter (" not in plan


def test_two_partition_columns_and_a_large_partition(spark):
    """Most rows in one partition, which many tasks write; the result is that of a whole-table update."""
    path = run_dir(spark, "table")
    base = spark.range(20_000).select(
        F.col("id"),
        F.when(F.col("id") % 10 < 9, date(2001, 7, 1)).otherwise(date(2001, 7, 2)).alias("day"),
        (F.col("id") % 3 == 0).cast("int").alias("side"),
        F.lit("old").alias("note"),
    )
    write_partitioned(base, path, ["day", "side"])
    changes = base.where("id % 1000 = 5").select("id", "day", "side", F.lit("new").alias("note"))
    made = merge_partitions(spark, path, ["id"], ["day", "side"], changes)
    assert made["touched"] == changes.select("day", "side").distinct().count() < 4
    whole = upsert(base, changes, ["id", "day", "side"])
    assert spark.read.parquet(path).select(*whole.columns).exceptAll(whole).count() == 0
    assert spark.read.parquet(path).count() == 20_000
