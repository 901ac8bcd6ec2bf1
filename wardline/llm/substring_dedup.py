"""Substring duplicates by factoring documents against an indexed reference, after relative Lempel-Ziv.

The reference is the corpus itself, cut into phrases of ``size`` words and indexed in blocks by the
phrases' 64-bit fingerprints. Every phrase of every document is looked up in the reference block that would hold it,
also those that straddle the border of two factors. Factors are the runs of phrases found, which is what greedy
factoring against all reference texts comes to for factors of ``size`` words and more; no factor is extended word by
word against the text of one reference, and phrases are not compared beyond their fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.phrase_index import dealt, fold, index_blocks, unpack_codes, unpack_owners
from wardline.llm.python_tasks import prepare
from wardline.llm.words import NOT_BLANK, Words, blocks, covered, mix, windows, words_of

#: Text of one block of documents, whose phrases are folded before the shuffle.
BLOCK_BYTES = 10 << 20
#: Stands for a null id: later than any document, so its copies go and it is nobody's reference.
NO_ID = (1 << 63) - 1

ENTRIES = "part int, codes binary, owners binary, numbers binary, doc bigint, text_key bigint, spans binary"


def text_keys(words: Words) -> np.ndarray:
    """A number for the words of each text, to tell apart rows that share an id."""
    total = len(words.offsets) - 1
    first = np.searchsorted(words.text, np.arange(total))
    place = np.arange(len(words.code)) - first[words.text] if len(words.code) else np.zeros(0, int)
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, words.text, mix(words.code + place.astype(np.uint64)))
    return sums.view(np.int64)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of set flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def phrase_entries(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Index entries of each block of documents, and the spans that the block alone shows to be copies.

    Of a phrase's documents in the block only the one with the smallest id goes to the index: the
    others are copies of it already.
    """
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("codes", pa.binary()),
            ("owners", pa.binary()),
            ("numbers", pa.binary()),
            ("doc", pa.int64()),
            ("text_key", pa.int64()),
            ("spans", pa.binary()),
        ]
    )
    for block in blocks(batches, "text", BLOCK_BYTES):
        words = words_of(block.column("text"), NOT_BLANK)
        docs = block.column("doc").to_numpy()
        code, first = windows(words, size)
        opens, order, group = fold(code, docs[words.text[first]])
        code, first = code[order], first[order]
        owner = docs[words.text[first]]
        heads = np.flatnonzero(opens)
        for row in dealt(code[heads], owner[heads], parts):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*row, None, None, None), schema.types)], schema=schema)
        copies = first[owner > owner[heads][group]] if len(heads) else first
        begin, end = runs(covered(copies, size, len(words.code)))
        if len(begin):
            yield local_spans(words, docs, begin, end, parts, schema)


def local_spans(
    words: Words, docs: np.ndarray, begin: np.ndarray, end: np.ndarray, parts: int, schema: pa.Schema
) -> pa.RecordBatch:
    """Spans of words of a block as one row per text, in numbers of the text's words."""
    # A run of covered words can go on in the next text; each text gets its own part.
    counts = words.counts()
    starts = np.cumsum(counts) - counts
    low, high = words.text[begin], words.text[end - 1]
    pieces = high - low + 1
    text = np.repeat(low, pieces) + np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    a = np.maximum(np.repeat(begin, pieces), starts[text]) - starts[text]
    b = np.minimum(np.repeat(end, pieces), starts[text] + counts[text]) - starts[text]
    keep = b > a
    text, pairs = text[keep], np.stack([a[keep], b[keep]], 1).astype(np.int32)
    keys = text_keys(words)
    texts, at = np.unique(text, return_index=True)
    cuts = [*at, len(text)]
    packed = [pairs[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    empty = pa.nulls(len(texts), pa.binary())
    part = pa.array((texts % parts).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [part, empty, empty, empty, pa.array(docs[texts]), pa.array(keys[texts]), pa.array(packed, pa.binary())],
        schema=schema,
    )


def look_up(table: pa.Table) -> pa.Table:
    """One reference block: phrases whose document has an earlier one, by document.

    Spans found in the blocks of text pass through.
    """
    entries = table.filter(pc.is_valid(table.column("codes")))
    ready = table.filter(pc.is_null(table.column("codes"))).select(["doc", "text_key", "spans"])
    ready = ready.append_column("codes", pa.nulls(ready.num_rows, pa.binary()))
    if entries.num_rows:
        columns = [entries.column(c).to_pylist() for c in ("codes", "owners", "numbers")]
        code = np.concatenate([unpack_codes(c) for c in columns[0]])
        owner = np.concatenate([unpack_owners(o, n) for o, n in zip(*columns[1:], strict=True)])
        opens, order, group = fold(code, owner)
        code, owner = code[order], owner[order]
        later = owner > owner[np.flatnonzero(opens)][group]
        code, owner = code[later], owner[later]
        order = np.argsort(owner, kind="stable")
        code, owner = code[order], owner[order]
        docs, at = np.unique(owner, return_index=True)
        cuts = [*at, len(owner)]
        found = pa.table(
            {
                "doc": pa.array(docs, pa.int64()),
                "text_key": pa.nulls(len(docs), pa.int64()),
                "spans": pa.nulls(len(docs), pa.binary()),
                "codes": pa.array([code[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            }
        )
        ready = pa.concat_tables([ready, found])
    return ready.select(["doc", "text_key", "spans", "codes"])


def parse(words: Words, size: int, found: list[list[dict] | None]) -> np.ndarray:
    """Which words of a batch lie in a factor, given what the look-up returned for each text."""
    code, first = windows(words, size)
    counts = words.counts()
    starts = np.cumsum(counts) - counts
    hit = np.zeros(len(code), bool)
    keys = text_keys(words)
    marks = []
    cuts = np.searchsorted(words.text[first], np.arange(len(counts) + 1))
    for text, rows in enumerate(found):
        if not rows:
            continue
        a, b = cuts[text], cuts[text + 1]
        known = [np.frombuffer(r["codes"], np.uint64) for r in rows if r["codes"]]
        if known:
            hit[a:b] = np.isin(code[a:b], np.concatenate(known))
        marks += [
            starts[text] + np.frombuffer(r["spans"], np.int32).reshape(-1, 2)
            for r in rows
            if r["spans"] and r["text_key"] == keys[text]
        ]
    inside = covered(first[hit], size, len(words.code))
    if marks:
        edges = np.zeros(len(words.code) + 1, np.int32)
        pairs = np.concatenate(marks)
        np.add.at(edges, pairs[:, 0], 1)
        np.add.at(edges, pairs[:, 1], -1)
        inside |= np.cumsum(edges[:-1]) > 0
    return inside


def remove_repeats(docs: DataFrame, size: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, factors, kept``.

    Words are runs of bytes other than white space. A word is removed if it lies in a window of ``size``
    words whose sequence also starts in a row with a smaller id; windows are judged on the input.
    ``factors`` (array of ``start, length`` in words) are the removed spans, ``kept`` the other words,
    joined by one space. Ids are integers. A null id counts as larger than all; rows with equal ids are
    not each other's reference. Null and empty texts have no words, an empty table gives no rows, other
    columns are ignored. Phrases are compared by 64-bit fingerprints.

    The text crosses the shuffle once, to meet its own findings; phrases cross as about nine bytes each.
    """
    spark = prepare(docs.sparkSession)
    parts = index_blocks(spark)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    entries = rows.select("doc", "text").mapInArrow(lambda batches: phrase_entries(batches, size, parts), ENTRIES)
    found = entries.groupBy("part").applyInArrow(look_up, "doc bigint, text_key bigint, spans binary, codes binary")
    by_doc = found.groupBy("doc").agg(F.collect_list(F.struct("text_key", "spans", "codes")).alias("found"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES // 4):
            words = words_of(block.column("text"), NOT_BLANK)
            inside = parse(words, size, block.column("found").to_pylist())
            counts = words.counts()
            ends = np.cumsum(counts)
            texts, kept, factors = block.column("text").to_pylist(), [], []
            data = words.data
            for i in range(block.num_rows):
                a, b = ends[i] - counts[i], ends[i]
                begin, end = runs(inside[a:b])
                factors.append([{"start": int(x), "length": int(y - x)} for x, y in zip(begin, end, strict=True)])
                stay = np.flatnonzero(~inside[a:b]) + a
                raw = data[words.offsets[i] : words.offsets[i + 1]].tobytes()
                low = words.offsets[i]
                kept.append(
                    b" ".join(raw[s:e] for s, e in zip(words.start[stay] - low, words.end[stay] - low, strict=True)).decode()
                    if texts[i]
                    else ""
                )
            removed = np.bincount(words.text[inside], minlength=block.num_rows) if len(inside) else np.zeros(block.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").combine_chunks(),
                    pa.array(counts, pa.int64()),
                    pa.array(removed.astype(np.int64)),
                    pa.array(factors, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "factors", "kept"],
            )

    joined = rows.join(by_doc, "doc", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(
        remove,
        "doc_id bigint, n_words bigint, n_removed bigint, factors array<struct<start:bigint,length:bigint>>, kept string",
    )
