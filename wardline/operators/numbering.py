"""Running document numbers: PREFIX-PERIOD-00001, continuing from those on file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.dialect import number_suffix, zero_pad
from wardline.operators.rows import number_rows


def last_numbers(existing: DataFrame, number: str, prefixes: list[str]) -> DataFrame:
    """Highest running number on file per prefix; at most one row per given prefix."""
    which = F.lit(None).cast("string")
    for prefix in prefixes:
        which = F.when(F.col(number).startswith(prefix), prefix).otherwise(which)
    return (
        existing.select(which.alias("_prefix"), number_suffix(F.col(number)).alias("_last"))
        .filter(F.col("_prefix").isNotNull())
        .groupBy("_prefix")
        .agg(F.max("_last").alias("_last"))
    )


def assign_numbers(
    batch: DataFrame,
    existing: DataFrame,
    number: str,
    prefixes: list[str],
    width: int,
    order: list[str],
    prefix: Column | None = None,
    key: str | None = None,
    staged: bool = False,
) -> DataFrame:
    """Number a whole batch per prefix in sort order, after the highest number on file.

    With one prefix, the last number is a scalar, and ``key`` asks for the next free ids
    of that column from the same numbering. With several, a single one may hold the
    whole batch: numbering works in ranges, and the last numbers are at most one row
    per prefix, so they are broadcast rather than shuffled on the prefix. ``staged`` is as in ``number_rows``.
    """
    if prefix is None:
        numbered = number_rows(batch, order, (), "_n", staged).withColumn("_prefix", F.lit(prefixes[0]))
        same = existing.filter(F.col(number).startswith(prefixes[0]))
        numbered = numbered.withColumn("_last", same.agg(F.max(number_suffix(F.col(number)))).scalar())
    else:
        numbered = number_rows(batch.withColumn("_prefix", prefix), order, ["_prefix"], "_n", staged)
        last = F.broadcast(last_numbers(existing, number, prefixes))
        numbered = numbered.join(last, "_prefix", "left")
    running = F.coalesce(F.col("_last"), F.lit(0)) + F.col("_n")
    out = numbered.withColumn(number, F.concat(F.col("_prefix"), zero_pad(running, width)))
    if key is not None:
        out = out.withColumn(key, F.col("_n") + highest(existing, key))
    return out.drop("_prefix", "_last", "_n")


def highest(existing: DataFrame, key: str) -> Column:
    """Largest key on file, 0 when there is none."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()


def next_ids(batch: DataFrame, existing: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Give each row of a batch the next free key in sort order."""
    numbered = number_rows(batch, order, (), "_id")
    return numbered.withColumn(key, F.col("_id") + highest(existing, key)).drop("_id")
