"""Connected components of links between keys, as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.workspace import release, stage


def components(links: DataFrame) -> DataFrame:
    """``key, label`` of every key in ``links`` (``a, b``): the label is the smallest key it is linked with, itself included.

    Each round moves every link of a key to the smallest key around it, first from the larger side,
    then from the smaller; stars are left after a number of rounds in the order of the logarithm of the
    longest chain. A key with very many links meets its smallest neighbour in a join that Spark can
    split, and never has its links collected. Rounds and result are written tables, so a lost
    executor costs no more than the round.
    """
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while not only_stars(now):
        # Links from a (larger) to b: every larger neighbour goes to the smallest neighbour of b.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("key"), F.least("a", "low").alias("low"))
        larger = now.join(least, now["b"] == least["key"]).select(now["a"].alias("a"), F.col("low").alias("b"))
        large = stage(larger.where("a != b"), "links")
        # Each key with all its smaller neighbours goes to the smallest of them.
        lows = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("key"), "low")
        moved = large.join(lows, large["a"] == lows["key"]).select(F.col("b").alias("a"), F.col("low").alias("b"))
        smaller = moved.unionByName(lows.select(F.col("key").alias("a"), F.col("low").alias("b"))).where("a != b").distinct()
        after = stage(smaller, "links")
        release(now, large)
        now = after
    labels = now.select(F.col("a").alias("key"), F.col("b").alias("label"))
    roots = now.select(F.col("b").alias("key")).distinct()
    found = stage(labels.unionByName(roots.select("key", F.col("key").alias("label"))), "components")
    release(now)
    return found


def only_stars(links: DataFrame) -> bool:
    """Whether every larger key has one link and no smaller key is a larger one too."""
    one, none = F.lit(1), F.lit(0)
    ends = links.select(F.col("a").alias("key"), one.alias("up"), none.alias("down")).unionByName(
        links.select(F.col("b").alias("key"), none.alias("up"), one.alias("down"))
    )
    held = ends.groupBy("key").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    return held.where("ups > 1 or (ups = 1 and down = 1)").isEmpty()


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (of ``components``) after more links: those between components are all that is worked on."""
    more = stage(links, "more-links")
    of = labels.select(F.col("key").alias("of"), F.col("label").alias("top"))
    first = more.join(of, more["a"] == of["of"], "left").select(F.coalesce("top", "a").alias("a"), "b")
    ends = first.join(of, first["b"] == of["of"], "left").select("a", F.coalesce("top", "b").alias("b"))
    tops = components(ends)
    keys = more.select(F.col("a").alias("key")).unionByName(more.select(F.col("b").alias("key"))).distinct()
    whole = labels.unionByName(keys.join(labels, "key", "left_anti").select("key", F.col("key").alias("label")))
    above = tops.select(F.col("key").alias("of"), F.col("label").alias("top"))
    found = whole.join(above, whole["label"] == above["of"], "left").select("key", F.coalesce("top", "label").alias("label"))
    found = stage(found, "components")
    release(more, tops)
    return found
