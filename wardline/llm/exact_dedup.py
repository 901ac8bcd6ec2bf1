"""Exact duplicates of whole texts, by content hash with a comparison of bytes; built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import tune


def content_hash(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: str = "min",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the
    smallest id stays (``keep="min"``, or the largest with ``"max"``). Null ids lose against any id;
    a group of null ids alone has a null ``keep_id`` and keeps its rows. Rows that repeat the kept id
    are all kept, since nothing tells them apart. An empty table gives no rows; other columns are ignored.
    A very long text is compared whole, as one key.

    The texts are grouped by (content hash, bytes): the hash deals them out, the bytes keep texts
    apart that collide in it. Each task first folds its own copies, so a text that makes up a third
    of the table reaches its group as one row per task. Rows then meet their group on two hashes
    and no text; a group whose hashes do not tell its texts apart ends the job with an error instead
    of mixing them.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", hashed(F.col("text")))
    best = F.min if keep == "min" else F.max
    texts = rows.groupBy("hash", "text").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = (
        texts.select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        .groupBy("hash", "text_sha256")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("texts"))
        .withColumn(
            "group_size",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.lit("different texts agree in both hashes")).cast("long")
            ),
        )
        .drop("texts")
    )
    # One key of both hashes: the join deals out both sides itself, so that it can split a frequent text's rows.
    both = F.concat("hash", F.unhex("text_sha256"))
    keys = rows.select("doc_id", F.concat("hash", F.unhex(F.sha2("text", 256))).alias("key"))
    return keys.join(groups.withColumn("key", both).drop("hash"), "key").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
