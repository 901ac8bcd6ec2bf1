"""How a set of filters interacts: what each removes, alone and in every order.

A document is five flags. Four are functions of its text, found in one scan with built-in functions. The fifth,
whether an equal text has a smaller id, needs other documents: a counting Bloom filter over the texts' hashes clears
those that are certainly unique, and only the texts of the others are shuffled and compared. Flags then fold into
counts per mask, from which all orders follow by addition.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.python_tasks import prepare
from wardline.workspace import stage

FILTERS = "ABCDE"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Counters a text steps, and counters per text of the table.
PROBES = 4
COUNTERS_PER_TEXT = 16
#: Bounds of the merged filter, in counters: 32 MB of one bit each is the most that is broadcast.
LEAST_COUNTERS = 1 << 15
MOST_COUNTERS = 1 << 28


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK_RUN), "")


def text_flags(rows: DataFrame, text: str = "text") -> Column:
    """Mask of the filters that look at the text alone: bit k for filter k."""
    words, whole = F.col("words"), F.col(text)
    fails = [
        F.size(words) < 100,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        F.regexp_count(whole, F.lit("[A-Z]")) * 100 > F.length(whole) * 10,
        whole.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def digest_of(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(text.cast("binary")))


def probes(digest: Column, counters: int) -> Column:
    """The counters a text steps: places taken from its digest, each once."""
    part = lambda k: F.conv(F.substring(F.hex(digest), 1 + 8 * k, 8), 16, 10).cast("long")
    return F.array_distinct(F.array(*(part(k) % counters for k in range(PROBES))))


def counting_filter(digests: DataFrame, counters: int) -> np.ndarray:
    """Bits of the counters that reach two or more, over all rows.

    Each task steps counters for its own rows; the partial counters are added, which merges the filters. Counters
    that stay at one are not kept: a text that steps one of them has no equal.
    """
    stepped = digests.select(F.explode(probes(F.col("digest"), counters)).alias("counter"))
    full = stepped.groupBy("counter").agg(F.count("*").alias("steps")).where("steps > 1")
    # Bitmap places and their pieces of 32,768 bits count from one.
    numbered = full.select((F.col("counter") + 1).alias("place"))
    pieces = numbered.groupBy(F.bitmap_bucket_number("place").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    bits = np.zeros(counters // 8, np.uint8)
    for piece, found in pieces.toLocalIterator():
        at = (piece - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(found, np.uint8)
    return bits


def possible_repeat(spark: SparkSession, bits: np.ndarray, counters: int):
    """A column function of a digest: whether all of a text's counters reached two."""
    shared = spark.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def test(digest: pa.Array) -> pa.Array:
        bits = shared.value
        if len(digest) == 0:
            return pa.array([], pa.bool_())
        words = np.frombuffer(b"".join(digest.to_pylist()), ">u4").reshape(-1, PROBES).astype(np.int64)
        place = words % counters
        return pa.array(((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool).all(1))

    return test


def first_copies(texts: DataFrame) -> DataFrame:
    """``doc_id, digest`` of the smallest id of every text, by the texts themselves.

    Copies fold in their own task first; rows without an id are no one's copy and no one's first.
    """
    named = texts.where(F.col("doc_id").isNotNull())
    return named.groupBy("digest", "text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "digest")


def flag_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per input row: ``doc_id, part, mask``; bit k of ``mask`` says that filter k of ``FILTERS`` fails it."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("digest", digest_of(F.col("text")))
    flagged = stage(
        rows.withColumn("words", words_of(F.col("text"))).select("doc_id", "part", "digest", text_flags(rows).alias("mask")), "flags"
    )
    wanted = max(1, flagged.count()) * COUNTERS_PER_TEXT
    counters = min(MOST_COUNTERS, max(LEAST_COUNTERS, 1 << (wanted - 1).bit_length()))
    test = possible_repeat(spark, counting_filter(flagged, counters), counters)
    firsts = first_copies(rows.select("doc_id", "digest", "text").where(test("digest"))).withColumn("first", F.lit(True))
    marked = flagged.withColumn("possible", test("digest") & F.col("doc_id").isNotNull())
    repeat = F.col("possible") & F.col("first").isNull()
    return marked.join(firsts, ["doc_id", "digest"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(repeat, 1 << FILTERS.index("E")).otherwise(0)).alias("mask")
    )


def mask_counts(flagged: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """``part, n, good, toxic``: documents per mask (arrays by mask), all and those with each label.

    Of several labels of an id any that is 1 counts.
    """
    known = (
        labels.where(F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("doc_id"))
        .agg(*(F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long")).alias(c) for c in ("quality", "toxic")))
    )
    labelled = flagged.join(known, "doc_id", "left")
    per_mask = labelled.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("quality"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad"),
    )
    at = lambda measure, m: F.sum(F.when(F.col("mask") == m, F.col(measure)).otherwise(0))
    return per_mask.groupBy("part").agg(
        *(F.array(*(at(measure, m) for m in range(1 << len(FILTERS)))).alias(measure) for measure in ("n", "good", "bad"))
    )


def steps_of_all_orders(filters: str = FILTERS) -> Column:
    """Every step of every order: order, step, mask of the filters before, bit of its own filter."""
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(step).alias("step"),
            F.lit(sum(1 << filters.index(f) for f in order[: step - 1])).alias("before"),
            F.lit(1 << filters.index(order[step - 1])).alias("own"),
        )
        for order in permutations(filters)
        for step in range(1, len(filters) + 1)
    ]
    return F.array(*steps)


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters, and step: what the step keeps, removes and loses.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.
    Filters: A too few words, B too few distinct words, C too many capitals, D symbols, E a copy of a text with a
    smaller id. ``redundant`` fail the step's filter but went before; ``unique_fails`` fail it and no other;
    ``good_lost`` and ``toxic_lost`` are the removed ones labelled so; ``shapley`` sums what the filter removes over
    all orders, wherever it stands.

    A null part is the empty one, a null text the empty text, which fails A. A very long text is one row and is
    compared whole. Rows without an id neither are copies nor have copies, and have no label. Rows repeated with
    their id are no copies of each other, since no id is smaller; each counts. An empty table gives no rows. Other
    columns are ignored.
    """
    counts = mask_counts(flag_documents(docs, doc_id, text, part), labels)
    stepped = counts.withColumn("step_of", F.explode(steps_of_all_orders())).select("*", "step_of.*")
    before, own = F.col("before"), F.col("own")

    def total(measure: str, chosen) -> Column:
        return F.aggregate(
            F.transform(F.col(measure), lambda n, mask: F.when(chosen(mask), n).otherwise(0)), F.lit(0).cast("long"), lambda a, b: a + b
        )

    removed = lambda mask: (mask.bitwiseAND(before) == 0) & (mask.bitwiseAND(own) != 0)
    orders = len(list(permutations(FILTERS)))
    # A document that fails k filters falls to each of them in one of k orders.
    share = F.transform(
        F.col("n"),
        lambda n, mask: F.when(mask.bitwiseAND(own) != 0, n * (F.lit(orders) / F.bit_count(mask)).cast("long")).otherwise(0),
    )
    return stepped.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda mask: mask.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda mask: (mask.bitwiseAND(before) != 0) & (mask.bitwiseAND(own) != 0)).alias("redundant"),
        total("n", lambda mask: mask == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("bad", removed).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("long"), lambda a, b: a + b).alias("shapley"),
    )
