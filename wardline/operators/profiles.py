"""Column profiles kept per partition as sketches that can be merged.

A partition's sketch is one row: exact rows, nulls, least and greatest values, a HyperLogLog sketch of the distinct
values of every column and a KLL sketch of the ranks of every number. Sketches of partitions merge into the profile of
the table, so a table that grows is profiled by reading its new partitions only.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.clinical_reports import c
from wardline.sources.sinks import in_partitions, write_partitioned
from wardline.workspace import exists

#: 2 to this power registers in a HyperLogLog sketch: a relative standard error of 1.6 %, in 4 KB at most.
LOG_REGISTERS = 12
#: Accuracy of the KLL sketch: ranks within about 1.3 % of the rows at 99 % confidence.
KLL_SIZE = 200
RANKS = (0.25, 0.5, 0.75)
#: Folder name of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _counted(column: str, kind: T.DataType) -> Column:
    """A column in a type the distinct-count sketch takes; equal values stay equal."""
    if isinstance(kind, (T.IntegralType, T.StringType, T.BinaryType)):
        return c(column)
    return c(column).cast("string")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def sketch_partitions(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """One row per partition value: ``n`` rows, and per column ``i`` its count, bounds and sketches.

    Columns are numbered in the order of the table, the partition columns left out. One pass with a map-side fold.
    """
    aggregates = [F.count("*").alias("n")]
    for i, field in enumerate(profiled(df, partition_by)):
        name = field.name
        aggregates += [
            F.count(name).alias(f"c{i}"),
            F.min(name).alias(f"lo{i}"),
            F.max(name).alias(f"hi{i}"),
            F.hll_sketch_agg(_counted(name, field.dataType), F.lit(LOG_REGISTERS)).alias(f"d{i}"),
        ]
        if _is_number(field.dataType):
            aggregates.append(F.kll_sketch_agg_double(c(name).cast("double"), F.lit(KLL_SIZE)).alias(f"q{i}"))
    return df.groupBy(*partition_by).agg(*aggregates)


def profiled(df: DataFrame, partition_by: list[str]) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in partition_by]


def merged_profile(sketches: DataFrame, fields: list[T.StructField], table: str) -> DataFrame:
    """The profile of a table from the sketches of its partitions.

    ``TableName, ColumnName, Rows, Nulls, MinValue, MaxValue`` are exact; ``DistinctValues`` is the sketch's estimate;
    ``Quartiles`` are the values at a quarter, half and three quarters of the rows of a number, null for other types.
    """
    numbers = [i for i, f in enumerate(fields) if _is_number(f.dataType)]
    aggregates = [F.sum("n").alias("n")]
    for i in range(len(fields)):
        aggregates += [
            F.sum(f"c{i}").alias(f"c{i}"),
            F.min(f"lo{i}").cast("string").alias(f"lo{i}"),
            F.max(f"hi{i}").cast("string").alias(f"hi{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}"),
        ]
    aggregates += [F.kll_merge_agg_double(f"q{i}").alias(f"q{i}") for i in numbers]
    one = sketches.agg(*aggregates)
    no_ranks = F.lit(None).cast("array<double>")
    entries = [
        F.struct(
            F.lit(table).alias("TableName"),
            F.lit(field.name).alias("ColumnName"),
            c("n").alias("Rows"),
            (c("n") - c(f"c{i}")).alias("Nulls"),
            c(f"lo{i}").alias("MinValue"),
            c(f"hi{i}").alias("MaxValue"),
            c(f"d{i}").alias("DistinctValues"),
            (_ranks(i) if i in numbers else no_ranks).alias("Quartiles"),
        )
        for i, field in enumerate(fields)
    ]
    return one.select(F.explode(F.array(*entries)).alias("_p")).select("_p.*").filter(c("Rows").isNotNull())


def _ranks(i: int) -> Column:
    found = F.kll_sketch_get_quantile_double(c(f"q{i}"), F.array(*[F.lit(r) for r in RANKS]))
    return F.when(c(f"c{i}") > 0, found)


def partition_values(table: DataFrame, partition_by: list[str]) -> set[tuple]:
    """Values of a stored table's partition columns, from the names of its folders; no file is opened."""
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    named = [dict(part.split("=", 1) for part in folder.split("/") if "=" in part) for folder in folders]
    if not named:
        return set()
    raw = [tuple(None if d[n] == NO_VALUE else unquote(d[n]) for n in partition_by) for d in named]
    strings = T.StructType([T.StructField(n, T.StringType()) for n in partition_by])
    typed = table.sparkSession.createDataFrame(raw, strings).select(*[c(n).cast(table.schema[n].dataType) for n in partition_by])
    return {tuple(r) for r in typed.collect()}


def refresh(spark: SparkSession, table: DataFrame, partition_by: list[str], store: str) -> list[tuple]:
    """Sketch the partitions of a stored table that the store has none of yet; gives their values.

    The new ones are read with a filter on the partition columns, so no other folder is opened. A partition that was
    rewritten is sketched again by ``resketch``.
    """
    values = partition_values(table, partition_by)
    if exists(spark, store):
        known = spark.read.schema(T.StructType([table.schema[n] for n in partition_by])).parquet(store)
        values -= partition_values(known, partition_by)
    return resketch(table, partition_by, store, sorted(values, key=repr))


def resketch(table: DataFrame, partition_by: list[str], store: str, values: list[tuple]) -> list[tuple]:
    """Sketch the given partitions of a table and replace theirs in the store."""
    if values:
        write_partitioned(sketch_partitions(table.filter(in_partitions(values, partition_by)), partition_by), store, partition_by)
    return values


def stored_profile(spark: SparkSession, table: DataFrame, partition_by: list[str], store: str, name: str) -> DataFrame:
    """The profile of a table from its stored sketches."""
    return merged_profile(spark.read.parquet(store), profiled(table, partition_by), name)
