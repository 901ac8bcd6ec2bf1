"""Building blocks shared by the operators: fact folding and ordered numbering.

Both are written for groups of any size. Folding is a partial aggregate before its
only shuffle. Numbering deals rows into ranges of the sort order, so a group that
holds a large part of all rows is spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.workspace import stage

# Rows one task numbers.
ROWS_PER_TASK = 500_000


def fold_facts(key: str, parts: list[DataFrame], sums: list[str], extra: list[Column] = ()) -> DataFrame:
    """Sum measures of several facts per key with one shuffle.

    Each part carries the key and some of the measures; the rest are null there.
    Stacking the parts before the aggregate replaces one aggregate and one join
    per fact, and the map-side combine keeps hot keys small.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(key).agg(*[F.sum(m).alias(m) for m in sums], *extra)


def stack_totals(parts: list[DataFrame]) -> DataFrame:
    """Put several one-row aggregates side by side without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "RowNumber") -> DataFrame:
    """The first n rows per group. Spark trims each group to n rows before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def number_rows(
    df: DataFrame,
    order: list[str],
    by: list[str] = (),
    out: str = "RowNumber",
    staged: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Dense 1..n numbers per group (or over the whole table) in ascending sort order, nulls first.

    The rows are written, dealt into as many ranges of (group, sort order) as their count asks for,
    written with the number of their range, and numbered inside each range. A group that goes on
    from one range to the next continues from an offset; there is at most one such group
    at each border, so the offsets are few whatever the table holds. ``staged`` says that the input
    is a written table already. The sort order should tell rows apart: equal rows share a range.
    """
    by = list(by)
    source = df if staged else stage(df, "to-number")
    ranges = max(1, -(-source.count() // rows_per_task))
    keys = [F.asc_nulls_first(n) for n in [*by, *(n for n in order if n not in by)]]
    dealt = source.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    dealt = stage(dealt, "ranges")
    inside = Window.partitionBy("_range", *by).orderBy(*[F.asc_nulls_first(n) for n in order])
    numbered = dealt.withColumn("_inside", F.row_number().over(inside).cast("long"))
    offsets = _offsets(dealt, by)
    same = F.col("_range") == F.col("_at")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    # One row for each border between ranges at most.
    joined = numbered.join(F.broadcast(offsets), same, "left")
    return joined.withColumn(out, F.col("_inside") + F.coalesce("_before", F.lit(0))).select(*df.columns, out)


def _offsets(dealt: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a group in the ranges before a range, for the groups that lie in several ranges."""
    held = dealt.groupBy(*by, "_range").agg(F.count("*").alias("_rows"))
    group = [F.col(n).alias(f"_of_{n}") for n in by]
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("_before", F.sum("_rows").over(earlier))
    return before.where("_before > 0").select(*group, F.col("_range").alias("_at"), "_before")
