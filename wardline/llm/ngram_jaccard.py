"""Near-duplicate documents by Jaccard similarity of word n-grams, joined on their rarest ones.

Prefix filtering: if two sets are similar enough, they share an n-gram among the first few of each in any
common order. Documents with equal sets are one class from the start. Two passes then narrow the rest:

1. In the order of the fingerprints: if the first ``p`` n-grams of each must share one, the first ``2p - 1``
   must share as many as the smaller prefix has. An index of these finds the classes that can have a partner at all.
2. Of these classes the whole sets are taken, n-grams counted over them, and the prefix of the rarest
   taken. Classes meet on the n-grams of their prefixes, with length, positional and suffix filters.

Candidates are not all pairs of a group: first every class of a group meets the group's most common
one; classes then linked are one component, and only pairs across components are left to verify.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import components, joined
from wardline.llm.phrase_index import dealt, fold, index_blocks, unpack_codes, unpack_owners
from wardline.llm.python_tasks import prepare
from wardline.llm.words import NOT_BLANK, Words, blocks, mix, windows, words_of
from wardline.workspace import release, stage

BLOCK_BYTES = 4 << 20
#: Parts of the fingerprint range that a set is counted in for the suffix filter; a count above ``MOST_COUNTED`` is taken
#: as that, which makes two sets look more alike, never less.
RANGES, MOST_COUNTED = 64, 127
#: N-grams of a prefix that every posting carries, so that most pairs come up once only.
HEAD = 8


@dataclass(frozen=True)
class Threshold:
    """Similarity of ``num / den`` or more, in whole numbers."""

    num: int
    den: int

    def overlap(self, total):
        """Least number of common n-grams of two sets with ``total`` members together."""
        return -(-self.num * total // (self.num + self.den))

    def prefix(self, size):
        """Length of a prefix that two similar sets must share a member of."""
        return size - -(-self.num * size // self.den) + 1


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text in order of (text, fingerprint), their texts, and where each text begins.

    A text of fewer words, but not none, has its whole sequence as its one n-gram.
    """
    code, first = windows(words, size)
    text = words.text[first]
    counts = words.counts()
    ends = np.cumsum(counts)
    short = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for length in range(1, size):
        which = np.flatnonzero(counts == length)
        whole = np.full(len(which), length, np.uint64)
        for k in range(length):
            whole = mix(whole + words.code[ends[which] - length + k]) * np.uint64(3)
        short[0].append(mix(whole))
        short[1].append(which)
    code, text = np.concatenate([code, *short[0]]), np.concatenate([text, *short[1]])
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[new], text[new]
    return code, text, np.searchsorted(text, np.arange(len(counts) + 1))


def set_names(code: np.ndarray, text: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each text's whole set."""
    n = np.diff(cuts)
    names = []
    for seed in (0x51ED270B, 0x2545F491):
        total = np.zeros(len(n), np.uint64)
        np.add.at(total, text, mix(code ^ np.uint64(seed)))
        names.append(mix(total + n.astype(np.uint64)).view(np.int64))
    return names


def profiles(docs: DataFrame, size: int, at_least: Threshold) -> DataFrame:
    """``doc_id, n, class, check, lead``: set size, the set's two hashes, and its leading n-grams."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            code, text, cuts = shingles(words_of(block.column("text"), NOT_BLANK, lower=True), size)
            n = np.diff(cuts)
            sums = set_names(code, text, cuts)
            most = 2 * at_least.prefix(n) - 1
            lead = [code[a : a + min(m, b - a)].tobytes() for a, b, m in zip(cuts[:-1], cuts[1:], most, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), *map(pa.array, sums), pa.array(lead, pa.binary())],
                ["doc_id", "n", "class", "check", "lead"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, class bigint, check bigint, lead binary")


LEADS = "part int, codes binary, owners binary, numbers binary, class bigint, shared bigint"
#: Stands for several classes of one block that share an n-gram.
SEVERAL = (1 << 63) - 1


def lead_entries(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Index entries of leading n-grams, one per n-gram and block, and what the block alone shows to be shared."""
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["part", "codes", "owners", "numbers", "class", "shared"]
    kept: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(kept)
        lead = [np.frombuffer(x, np.uint64) for x in table.column("lead").to_pylist()]
        owner = np.repeat(table.column("class").to_numpy(), [len(x) for x in lead])
        code = np.concatenate(lead)
        opens, order, group = fold(code, owner)
        code, owner = code[order], owner[order]
        heads = np.flatnonzero(opens)
        if not len(heads):
            return
        last = np.append(heads[1:], len(code)) - 1
        several = owner[heads] != owner[last]
        for row in dealt(code[heads], np.where(several, SEVERAL, owner[heads]), parts):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*row, None, None), types, strict=True)], names)
        classes, counts = np.unique(distinct(code, owner)[1][several[distinct(group, owner)[0]]], return_counts=True)
        if len(classes):
            empty = pa.nulls(len(classes), pa.binary())
            part = pa.array((classes.view(np.uint64) % np.uint64(parts)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part, empty, empty, empty, pa.array(classes), pa.array(counts)], names)

    held = 0
    for batch in batches:
        kept.append(batch)
        held += batch.nbytes
        if held >= BLOCK_BYTES:
            yield from flush()
            kept.clear()
            held = 0
    if kept:
        yield from flush()


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct neighbouring pairs of two columns that are sorted together."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def count_shared(table: pa.Table) -> pa.Table:
    """One index block: how many of each class's leading n-grams another class has too."""
    has = pc.is_valid(table.column("codes"))
    ready = table.filter(pc.invert(has)).select(["class", "shared"])
    entries = table.filter(has)
    if not entries.num_rows:
        return ready
    columns = [entries.column(c).to_pylist() for c in ("codes", "owners", "numbers")]
    code = np.concatenate([unpack_codes(c) for c in columns[0]])
    owner = np.concatenate([unpack_owners(o, n) for o, n in zip(*columns[1:], strict=True)])
    _, order, _ = fold(code, owner)
    code, owner = distinct(code[order], owner[order])
    opens = np.ones(len(code), bool)
    opens[1:] = code[1:] != code[:-1]
    heads = np.flatnonzero(opens)
    size = np.diff(np.append(heads, len(code)))
    shared = np.repeat((size > 1) | (owner[heads] == SEVERAL), size) & (owner != SEVERAL)
    classes, counts = np.unique(owner[shared], return_counts=True)
    return pa.concat_tables([ready, pa.table({"class": pa.array(classes, pa.int64()), "shared": pa.array(counts, pa.int64())})])


def whole_sets(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``class, n, grams, ranges`` of the chosen classes, from the text of one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            code, text, cuts = shingles(words_of(block.column("text"), NOT_BLANK, lower=True), size)
            part = (code >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
            counted = np.bincount(text * RANGES + part, minlength=block.num_rows * RANGES)
            ranges = np.minimum(counted, MOST_COUNTED).astype(np.int8)
            names = set_names(code, text, cuts)
            found = pa.RecordBatch.from_arrays(
                [
                    block.column("class").combine_chunks(),
                    pa.array(np.diff(cuts), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(code.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(ranges) + 1, RANGES), pa.int32()), pa.array(ranges)),
                ],
                ["class", "n", "grams", "ranges"],
            )
            # An id can have several texts; only the one of the class counts.
            yield found.filter(pa.array(names[0] == found.column("class").to_numpy()))

    texts = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["first_id"])).select("class", "text")
    sets = texts.mapInArrow(run, "class bigint, n bigint, grams array<bigint>, ranges array<tinyint>")
    return sets.dropDuplicates(["class"])


def postings(sets: DataFrame, at_least: Threshold) -> DataFrame:
    """``gram, class, n, place, unique, ranges, head``: the n-grams of each prefix that some other class has.

    ``place`` counts from the rarest; ``ranges`` and the ``head`` of the prefix come with each, so that a pair
    can be judged where it meets.
    """
    each = sets.select("class", "n", F.explode("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count("*").alias("held")).where("held > 1")
    common = each.join(often, "gram")
    ranked = common.groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("held", "gram"))).alias("common"))
    # N-grams of this class alone come first and meet nobody; the prefix goes on with the rest.
    unique = (F.col("n") - F.size("common")).cast("long")
    prefix = F.col("n") - F.ceil(F.col("n") * at_least.num / F.lit(at_least.den)) + 1
    left = F.greatest(prefix - unique, F.lit(0)).cast("int")
    taken = ranked.select("class", "n", unique.alias("unique"), F.slice("common", F.lit(1), left).alias("taken"))
    taken = taken.join(sets.select("class", "ranges"), "class").withColumn("head", F.slice("taken.gram", 1, HEAD))
    return taken.select("class", "n", "unique", "ranges", "head", F.posexplode("taken").alias("at", "member")).select(
        F.col("member.gram").alias("gram"),
        "class",
        "n",
        (F.col("unique") + F.col("at") + 1).alias("place"),
        "unique",
        "ranges",
        "head",
    )


def least_overlap(at_least: Threshold, total: Column) -> Column:
    return F.ceil(total * at_least.num / F.lit(at_least.num + at_least.den))


def similar_length(at_least: Threshold, a: Column, b: Column) -> Column:
    return F.least(a, b) * at_least.den >= F.greatest(a, b) * at_least.num


def possible(at_least: Threshold, x: str, y: str) -> Column:
    """Whether two postings that meet on an n-gram are a pair to verify.

    Before and after the n-gram, the sets can share no more than the shorter of their parts there
    (positional filter); what their counts in ranges of the fingerprint differ in they cannot share
    (suffix filter). A pair whose heads share an n-gram comes up on the first such one only.
    """
    a, b = F.col(x), F.col(y)
    total = a["n"] + b["n"]
    needed = least_overlap(at_least, total)
    most = F.least(a["place"], b["place"]) + F.least(a["n"] - a["place"], b["n"] - b["place"])
    met = F.get(F.array_intersect(a["head"], b["head"]), F.lit(0))
    apart = F.aggregate(
        F.zip_with(a["ranges"], b["ranges"], lambda p, q: F.abs(p.cast("int") - q.cast("int"))), F.lit(0), lambda sum_, d: sum_ + d
    )
    return (
        (a["class"] != b["class"])
        & similar_length(at_least, a["n"], b["n"])
        & (most >= needed)
        & (apart <= total - 2 * needed)
        & (met.isNull() | (met == F.col("gram")))
    )


def verified(pairs: DataFrame, sets: DataFrame, at_least: Threshold) -> DataFrame:
    """The pairs ``a, b`` that are similar, each checked once on whole sets."""
    grams = sets.select("class", "grams")
    both = pairs.distinct().join(grams.toDF("a", "ga"), "a").join(grams.toDF("b", "gb"), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    union = F.size("ga") + F.size("gb") - common
    return both.where(common * at_least.den >= union * at_least.num).select("a", "b")


def linked_classes(sets: DataFrame, at_least: Threshold) -> DataFrame:
    """``key, label``: components of the classes under all links between them."""
    found = stage(postings(sets, at_least), "prefixes")
    row = F.struct("class", "n", "place", "ranges", "head")
    # The most common class of a group: the one with the fewest n-grams of its own.
    hubs = found.groupBy("gram").agg(F.min(F.struct("unique", row.alias("row")))["row"].alias("y"))
    stars = found.select("gram", row.alias("x")).join(hubs, "gram").where(possible(at_least, "x", "y"))
    ends = [F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")]
    first = stage(verified(stars.select(*ends), sets, at_least), "first-links")
    labels = components(first)
    # Pairs across components: one side is outside its group's largest component or both are. Labels are joined to
    # class and n-gram alone; the rows themselves are taken from groups of several components only.
    of = labels.withColumnRenamed("key", "class")
    named = found.select("gram", "class").join(of, "class", "left").select("gram", F.coalesce("label", "class").alias("label"))
    sizes = named.groupBy("gram", "label").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("gram").agg(F.max(F.struct("size", "label")).alias("most"), F.count("*").alias("parts"))
    parted = largest.where("parts > 1").select("gram", F.col("most.label").alias("main"))
    mixed = found.join(parted, "gram").join(of, "class", "left").withColumn("label", F.coalesce("label", "class"))
    mixed = stage(mixed, "mixed-prefixes")
    left = mixed.where("label != main").select("gram", row.alias("x"), F.col("label").alias("la"))
    right = mixed.select("gram", row.alias("y"), F.col("label").alias("lb"), "main")
    once = (F.col("lb") == F.col("main")) | (F.col("x.class") < F.col("y.class"))
    across = left.join(right, "gram").where((F.col("la") != F.col("lb")) & once & possible(at_least, "x", "y"))
    # A pair that meets in a group of another component may have met its hub before: it is not verified twice.
    rest = across.select(*ends).join(first, ["a", "b"], "left_anti")
    linked = joined(labels, verified(rest, sets, at_least))
    release(found, first, labels, mixed)
    return linked


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    num: int = 8,
    den: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Words are runs of bytes other than white space, A-Z in lower case; a document's set has its distinct
    n-grams of ``size`` words, or its whole sequence if it has fewer words. Two documents are linked if
    their sets' Jaccard similarity is ``num / den`` or more; ``component_id`` is the smallest id reachable by
    links. Documents without words have an empty set and are linked with nothing. Null texts have no
    words. Null ids are linked like others and are nobody's ``component_id`` unless all of a component
    are null; repeated rows are linked with each other as equal sets. An empty table gives no rows; other columns are
    ignored. A very long text counts whole; its set is one row. N-grams are compared by 64-bit fingerprints, equal sets
    by 128 bits.
    """
    spark = prepare(docs.sparkSession)
    at_least = Threshold(num, den)
    parts = index_blocks(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = stage(profiles(rows, size, at_least), "profiles")
    full = found.where("n > 0")
    groups = full.groupBy("class", "check", "n").agg(F.min("doc_id").alias("first_id"))
    shared = (
        full.select("class", "lead")
        .mapInArrow(lambda batches: lead_entries(batches, parts), LEADS)
        .groupBy("part")
        .applyInArrow(count_shared, "class bigint, shared bigint")
        .groupBy("class")
        .agg(F.sum("shared").alias("shared"))
    )
    smallest = F.ceil(F.col("n") * num / F.lit(den))  # size of the smallest possible partner
    needed = F.least(smallest - F.ceil(smallest * num / F.lit(den)) + 1, smallest)
    chosen = groups.join(shared, "class").where(F.col("shared") >= needed).select("class", "first_id")
    sets = stage(whole_sets(rows, chosen, size), "sets")
    labels = linked_classes(sets, at_least)
    linked = groups.join(labels.withColumnRenamed("key", "class"), "class")
    ids = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(ids, "label").select("class", "check", "component_id")
    classes = groups.join(linked, ["class", "check"], "left").select(
        "class", "check", F.coalesce("component_id", "first_id").alias("component_id")
    )
    # Written, so that the last join deals out both sides itself and can split a frequent set's rows.
    classes = stage(classes, "classes")
    release(sets, labels)
    return found.join(classes, ["class", "check"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
