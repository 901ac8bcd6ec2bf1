"""Benchmark decontamination with a positional inverted index of the training text.

The index is dealt out by documents: a segment holds the posting lists of one stretch of documents, each
list the positions of one term, and is one row of a stored table. Test windows are looked up in every
segment. A window starts from the positions of its rarest term in the whole corpus, moved back by the
term's place in the window; each next rarer term keeps only the starts at whose offset it occurs too.
What is left after all terms are exact phrase matches. Proximity matches come from the same lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.python_tasks import prepare
from wardline.llm.words import ALNUM, blocks, covered, words_of
from wardline.workspace import stage

#: Text of one segment of the index.
SEGMENT_BYTES = 8 << 20
#: Test words that are looked up in one pass over the index; a larger test set takes several passes.
QUERY_WORDS = 2_000_000

SPANS = "array<struct<start:bigint,length:bigint>>"


@dataclass
class Windows:
    """Distinct test windows of one length, as numbers of terms, and which item holds which window."""

    terms: np.ndarray  # (windows, length)
    item: np.ndarray  # of each (item, window) pair
    window: np.ndarray


@dataclass
class TestSet:
    """A block of the test set: its vocabulary, its windows by length, and its item ids."""

    vocabulary: np.ndarray  # sorted fingerprints
    windows: list[Windows]
    items: list


def test_set(items: list, texts: list[str], size: int) -> TestSet:
    """Windows of ``size`` words of each item; an item of fewer words, but not none, is one window."""
    words = words_of(pa.array(texts, pa.string()), ALNUM, lower=True)
    vocabulary, term = np.unique(words.code, return_inverse=True)
    counts = words.counts()
    ends = np.cumsum(counts)
    by_length: dict[int, tuple[list, list]] = {}
    for number, (end, count) in enumerate(zip(ends, counts, strict=True)):
        length = min(size, int(count))
        if length:
            found = np.lib.stride_tricks.sliding_window_view(term[end - count : end], length)
            rows, owners = by_length.setdefault(length, ([], []))
            rows.append(found)
            owners.append(np.full(len(found), number))
    windows = []
    for _, (rows, owners) in sorted(by_length.items()):
        distinct, window = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([np.concatenate(owners), window.ravel()], 1), axis=0)
        windows.append(Windows(distinct, pairs[:, 0], pairs[:, 1]))
    return TestSet(vocabulary, windows, items)


def test_sets(tests: DataFrame, size: int, item_id: str, text: str) -> Iterator[TestSet]:
    """The test set in blocks of ``QUERY_WORDS`` words, read to the driver one block at a time."""
    rows = tests.select(F.col(item_id).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).toLocalIterator()
    items, texts, held = [], [], 0
    for row in rows:
        items.append(row["item"])
        texts.append(row["text"])
        held += 1 + len(row["text"]) // 2  # an upper bound of its words
        if held >= QUERY_WORDS:
            yield test_set(items, texts, size)
            items, texts, held = [], [], 0
    if items:
        yield test_set(items, texts, size)


@dataclass
class Segment:
    """Posting lists of one stretch of documents; positions count all its words, one document after another."""

    terms: np.ndarray
    cuts: np.ndarray
    positions: np.ndarray
    words: np.ndarray  # of each document

    def __post_init__(self):
        self.keys = np.repeat(self.terms.astype(np.int64) << 40, np.diff(self.cuts)) + self.positions
        self.ends = np.cumsum(self.words)

    def list_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each term's posting list; empty for a term that is not in the segment."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        return np.where(known, self.cuts[at], 0), np.where(known, self.cuts[at + 1], 0)

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term occurs at its place."""
        wanted = (terms.astype(np.int64) << 40) + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (self.keys[at] == wanted) & (places >= 0)

    def phrases(self, windows: Windows, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact matches: number of the window, and position of its first word."""
        if not len(self.terms) or not len(windows.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = windows.terms.shape[1]
        offsets = np.argsort(rarity[windows.terms], axis=1, kind="stable")
        rarest = windows.terms[np.arange(len(offsets)), offsets[:, 0]]
        a, b = self.list_of(rarest)
        count = b - a
        window = np.repeat(np.arange(len(offsets)), count)
        start = self.positions[np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        start = start - offsets[window, 0]
        for k in range(1, length):
            offset = offsets[window, k]
            kept = self.holds(windows.terms[window, offset], start + offset)
            window, start = window[kept], start[kept]
        # A window lies within one document.
        kept = (start >= 0) & (np.searchsorted(self.ends, start, "right") == np.searchsorted(self.ends, start + length - 1, "right"))
        return window[kept], start[kept]

    def near(self, windows: Windows, rarity: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretches of at most ``span`` words with all terms of a window: its number, and the first position.

        The stretches counted begin at a term of the window and are the shortest from there.
        """
        if not len(self.terms) or not len(windows.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(rarity[windows.terms], axis=1, kind="stable")
        terms = np.take_along_axis(windows.terms, order, 1)
        a, b = self.list_of(terms[:, 0])
        count = b - a
        window = np.repeat(np.arange(len(terms)), count)
        middle = self.positions[np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        # Every stretch holds the rarest term, so it begins at most span - 1 before one of its positions.
        found = []
        for back in range(span):
            first, now = middle - back, window
            kept = first >= 0
            first, now = first[kept], now[kept]
            begins = np.zeros(len(now), bool)
            for k in range(terms.shape[1]):
                term = terms[now, k]
                wanted = (term.astype(np.int64) << 40) + first
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                inside = (self.keys[at] >= wanted) & (self.keys[at] < wanted + span)
                begins |= self.keys[at] == wanted
                now, first, begins = now[inside], first[inside], begins[inside]
            found.append(np.stack([now[begins], first[begins]], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        window, first = pairs[:, 0], pairs[:, 1]
        last = np.full(len(window), -1)
        for k in range(terms.shape[1]):
            wanted = (terms[window, k].astype(np.int64) << 40) + first
            at = np.searchsorted(self.keys, wanted)
            last = np.maximum(last, self.keys[at] - wanted + first)
        kept = np.searchsorted(self.ends, first, "right") == np.searchsorted(self.ends, last, "right")
        return window[kept], first[kept]


def build_index(docs: DataFrame, vocabulary: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored posting lists of the terms in ``vocabulary``, one row per segment of documents.

    A document is kept as its id, a hash of its text that tells rows with equal ids apart, and its words.
    """
    spark = prepare(docs.sparkSession)
    known = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema[doc_id].dataType
    schema = (
        f"docs array<struct<doc_id:{kind.simpleString()},key:bigint,words:bigint>>, "
        "terms binary, cuts binary, positions binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.value
        for block in blocks(batches, "text", SEGMENT_BYTES):
            words = words_of(block.column("text"), ALNUM, lower=True)
            if len(vocabulary):
                term = np.minimum(np.searchsorted(vocabulary, words.code), len(vocabulary) - 1)
                place = np.flatnonzero(vocabulary[term] == words.code)
                term = term[place]
            else:
                term = place = np.zeros(0, np.int64)
            order = np.argsort(term, kind="stable")
            terms, first = np.unique(term[order], return_index=True)
            ids, keys = (block.column(c).combine_chunks() for c in ("doc_id", "key"))
            each = pa.StructArray.from_arrays([ids, keys, pa.array(words.counts(), pa.int64())], ["doc_id", "key", "words"])
            row = [
                pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), each),
                *(
                    pa.array([v.astype(np.int32).tobytes()], pa.binary())
                    for v in (terms, np.append(first, len(order)), place[order])
                ),
            ]
            yield pa.RecordBatch.from_arrays(row, ["docs", "terms", "cuts", "positions"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(run, schema), "postings")


def opened(batch: pa.RecordBatch, row: int) -> tuple[pa.StructArray, Segment]:
    """The documents and posting lists of one stored segment."""
    docs = batch.column("docs")[row].values
    lists = [np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("terms", "cuts", "positions")]
    return docs, Segment(*lists, docs.field("words").to_numpy())


def rarity_of(index: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each term of the vocabulary in the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                terms, cuts = (np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("terms", "cuts"))
                total[terms] += np.diff(cuts)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counted = index.select("terms", "cuts").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most one row for each term of a block of the test set
    rarity = np.zeros(size, np.int64)
    rarity[found["term"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return rarity


def over_segments(index: DataFrame, tests: TestSet, look: Callable, schema: str) -> DataFrame:
    """``look(documents, segment, tests, rarity)`` on every segment, as record batches."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((tests, rarity_of(index, len(tests.vocabulary))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, rarity = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                yield look(*opened(batch, row), tests, rarity)

    return index.mapInArrow(run, schema)


def phrase_hits(docs: pa.StructArray, segment: Segment, tests: TestSet, rarity: np.ndarray) -> pa.RecordBatch:
    """Words and items hit in each document of a segment."""
    total = int(segment.ends[-1]) if len(segment.ends) else 0
    inside = np.zeros(total, bool)
    pairs = []
    for windows in tests.windows:
        window, start = segment.phrases(windows, rarity)
        inside |= covered(start, windows.terms.shape[1], total)
        doc = np.searchsorted(segment.ends, start, "right")
        seen = np.unique(np.stack([doc, window], 1), axis=0)
        # All items of each window seen.
        order = np.argsort(windows.window, kind="stable")
        a = np.searchsorted(windows.window[order], seen[:, 1])
        count = np.searchsorted(windows.window[order], seen[:, 1], "right") - a
        item = windows.item[order][np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        pairs.append(np.stack([np.repeat(seen[:, 0], count), item], 1))
    pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    starts = segment.ends - segment.words
    spans: list[list[dict]] = [[] for _ in range(len(docs))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    for a, b in edges.reshape(-1, 2):
        doc = int(np.searchsorted(segment.ends, a, "right"))
        while a < b:  # a run of hit words can go on in the next document
            end = min(b, int(segment.ends[doc]))
            if end > a:
                spans[doc].append({"start": int(a - starts[doc]), "length": int(end - a)})
            a, doc = end, doc + 1
    items: list[list] = [[] for _ in range(len(docs))]
    for doc, item in pairs:
        items[doc].append(tests.items[item])
    return pa.RecordBatch.from_arrays(
        [
            docs.field("doc_id"),
            docs.field("key"),
            pa.array(segment.words),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
            pa.array(items, pa.list_(pa.int64())),
        ],
        ["doc_id", "key", "n_words", "hits", "items"],
    )


def near_hits(span: int) -> Callable:
    def look(docs: pa.StructArray, segment: Segment, tests: TestSet, rarity: np.ndarray) -> pa.RecordBatch:
        found = []
        for windows in tests.windows:
            window, first = segment.near(windows, rarity, span)
            doc = np.searchsorted(segment.ends, first, "right")
            place = first - (segment.ends - segment.words)[doc] if len(first) else first
            for w, d, p in zip(window, doc, place, strict=True):
                found += [(int(d), tests.items[i], int(p)) for i in windows.item[windows.window == w]]
        found = sorted(set(found), key=lambda f: (f[0], f[2], str(f[1])))
        return pa.RecordBatch.from_arrays(
            [
                docs.field("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                pa.array([f[1] for f in found], pa.int64()),
                pa.array([f[2] for f in found], pa.int64()),
            ],
            ["doc_id", "item_id", "start"],
        )

    return look


def find_phrases(
    docs: DataFrame,
    tests: DataFrame,
    size: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, hits, items``.

    ``hits`` (array of ``start, length`` in words) covers every occurrence of a window of ``size`` words of an
    item, or of a shorter item as a whole; ``items`` lists the items with such a window, each once per
    test row. Words are runs of digits, letters and bytes beyond ASCII, A-Z in lower case. Null and empty
    texts have no words and items without words match nothing; null item ids are listed as null.
    Repeated rows and null ids of documents pass through, empty tables give no rows or no hits, other
    columns are ignored. A very long text is one document of its segment and is searched whole. Item ids are integers. Terms are compared by 64-bit fingerprints.

    Only terms of the test set have posting lists. A test set of more than ``QUERY_WORDS`` words is
    looked up in blocks, each with an index of its own; a document's rows of all blocks are then put together.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, key bigint, n_words bigint, hits {SPANS}, items array<bigint>"
    whole = None
    for block in one_at_least(test_sets(tests, size, item_id, item_text), size):
        index = build_index(docs, block.vocabulary, doc_id, text)
        found = over_segments(index, block, phrase_hits, schema)
        whole = found if whole is None else put_together(whole, found)
    return whole.drop("key")


def one_at_least(sets: Iterator[TestSet], size: int) -> Iterator[TestSet]:
    """Blocks of a test set, read one after the other; an empty block where there is none."""
    first = next(sets, None)
    yield test_set([], [], size) if first is None else first
    first = None
    yield from sets


def put_together(whole: DataFrame, found: DataFrame) -> DataFrame:
    """The findings of one more block of the test set added to each row; rows that agree have equal findings."""
    more = found.dropDuplicates(["doc_id", "key"]).select(
        F.col("doc_id").alias("id"), F.col("key").alias("k"), F.col("hits").alias("more"), F.col("items").alias("others")
    )
    return whole.join(more, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left").select(
        "doc_id", "key", "n_words", merge_spans(F.concat("hits", "more")).alias("hits"), F.concat("items", "others").alias("items")
    )


def merge_spans(spans: Column) -> Column:
    """Spans in order, those that touch or overlap as one."""

    def add(seen: Column, span: Column) -> Column:
        last = F.get(seen, F.size(seen) - 1)
        end = last["start"] + last["length"]
        joined = F.struct(
            last["start"].alias("start"),
            (F.greatest(end, span["start"] + span["length"]) - last["start"]).alias("length"),
        )
        touching = F.concat(F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(0))), F.array(joined))
        return F.when((F.size(seen) > 0) & (span["start"] <= end), touching).otherwise(F.concat(seen, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def find_near(
    docs: DataFrame,
    tests: DataFrame,
    size: int = 10,
    span: int = 15,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Proximity matches: ``doc_id, item_id, start``, one row per match.

    A match is a stretch of at most ``span`` words of a document that holds every term of a test window,
    in any order, and begins with one of them; ``start`` is its first word. Rows, nulls and empty tables
    count as in ``find_phrases``.
    """
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id bigint, start bigint"
    whole = None
    for block in test_sets(tests, size, item_id, item_text):
        index = build_index(docs, block.vocabulary, doc_id, text)
        found = over_segments(index, block, near_hits(span), schema)
        whole = found if whole is None else whole.unionByName(found)
    return whole if whole is not None else docs.sparkSession.createDataFrame([], schema)
