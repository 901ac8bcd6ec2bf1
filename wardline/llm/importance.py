"""Importance resampling towards a target: hashed n-gram features, exact bucket totals, a drawn top share.

Features are runs of one to three words; a feature's bucket is the CRC-32 of its bytes modulo the number of
buckets. The vocabulary has a head and a tail. The head is broadcast: the CRC states of the most frequent words and
the CRC of the most frequent pairs of them, looked up in a table. All other words and pairs take their CRC directly,
from their bytes or from the states of their words. Both ways give the same CRC, so the head decides about speed
only and the bucket totals are exact whatever it holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.python_tasks import prepare
from wardline.llm.words import ALNUM, LOWER, blocks, text_bytes
from wardline.operators.rows import number_rows
from wardline.workspace import release, stage

BUCKETS = 10_000
#: Text one step of a task works on.
BLOCK_BYTES = 1 << 20
#: The head has the words, of at most 64 bytes, and the pairs of them that make up this share of all words: 20,000 of
#: each at most, which bounds what is broadcast. What has the share in the corpus has it in a block of text.
SHARE = 1 / 20_000
HEAD_BYTES = 64
PAIR_SLOTS = 1 << 17

#: Lower case for A-Z, and a blank for every byte that is in no word.
_READ = bytes(int(LOWER[b]) if ALNUM[b] else 0x20 for b in range(256))


def _byte_table() -> np.ndarray:
    """The CRC-32 of one more byte, by its rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _shift_tables(table: np.ndarray) -> np.ndarray:
    """What a CRC becomes when n bytes follow, for n up to ``HEAD_BYTES`` and each of its four bytes."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    tables = [state]
    for _ in range(HEAD_BYTES):
        state = table[state & 255] ^ (state >> np.uint32(8))
        tables.append(state)
    return np.stack(tables)


_BYTE = _byte_table()
_SHIFT = _shift_tables(_BYTE).reshape(-1)


def blank_after(crc: np.ndarray) -> np.ndarray:
    """CRC of a text and a blank, from the CRC of the text."""
    state = ~crc
    return ~(_BYTE[(state ^ np.uint32(0x20)) & 255] ^ (state >> np.uint32(8)))


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of two texts put together, from both CRCs and the second's length in bytes (``HEAD_BYTES`` at most)."""
    row = length.astype(np.int64) * 1024
    out = second ^ _SHIFT[row + (first & 255)]
    for part in range(1, 4):
        out ^= _SHIFT[row + part * 256 + ((first >> np.uint32(8 * part)) & 255)]
    return out


@dataclass
class Head:
    """Frequent words with their CRC, and a table of frequent pairs: number of both words and CRC of the pair."""

    words: list[bytes]
    keys: np.ndarray
    crcs: np.ndarray


class Vocabulary(dict):
    """Numbers of words: those of the head first, then each word of the block that the head has not."""

    def __init__(self, head: Head) -> None:
        super().__init__((w, k) for k, w in enumerate(head.words))
        self.size = len(head.words)
        self.crc = [zlib.crc32(w) for w in head.words]
        self.length = [len(w) for w in head.words]

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        self[word] = number
        self.crc.append(zlib.crc32(word))
        self.length.append(len(word))
        return number

    def forget(self) -> None:
        """Drop what is not of the head, so that memory follows the block."""
        while len(self) > self.size:
            self.popitem()
        del self.crc[self.size :], self.length[self.size :]


def pair_slot(key: np.ndarray) -> np.ndarray:
    return ((key * np.int64(0x2545F4914F6CDD1D)) >> np.int64(40)) & (PAIR_SLOTS - 1)


def pair_keys(number: np.ndarray) -> np.ndarray:
    return (number[:-1] << np.int64(32)) | number[1:]


@dataclass
class Read:
    """Words of a block: bytes, number in the vocabulary, and how many each text has."""

    words: list[bytes]
    number: np.ndarray
    counts: np.ndarray


def read_words(column: pa.ChunkedArray, vocabulary: Vocabulary) -> Read:
    data, offsets = text_bytes(column)
    flat = data.tobytes().translate(_READ)
    words: list[bytes] = []
    counts = np.zeros(len(offsets) - 1, np.int64)
    for k, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        found = flat[low:high].split()
        counts[k] = len(found)
        words += found
    number = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    return Read(words, number, counts)


def features(found: Read, vocabulary: Vocabulary, head: Head) -> tuple[np.ndarray, np.ndarray]:
    """CRC of every run of one to three words, and the number of its text."""
    text = np.repeat(np.arange(len(found.counts)), found.counts)
    crc = np.array(vocabulary.crc, np.uint32)[found.number]
    if not len(crc):
        return crc, text
    length = np.array(vocabulary.length, np.int64)[found.number]
    long = length > HEAD_BYTES
    short = np.where(long, 0, length)
    key = pair_keys(found.number)
    pair = joined_crc(blank_after(crc[:-1]), crc[1:], short[1:]) if not len(head.keys) else _pairs(key, crc, short, head)
    for k in np.flatnonzero(long[1:]).tolist():
        pair[k] = zlib.crc32(b" ".join(found.words[k : k + 2]))
    triple = joined_crc(blank_after(pair[:-1]), crc[2:], short[2:])
    for k in np.flatnonzero(long[2:]).tolist():
        triple[k] = zlib.crc32(b" ".join(found.words[k : k + 3]))
    two, three = text[:-1] == text[1:], text[:-2] == text[2:]
    return np.concatenate([crc, pair[two], triple[three]]), np.concatenate([text, text[:-1][two], text[:-2][three]])


def _pairs(key: np.ndarray, crc: np.ndarray, short: np.ndarray, head: Head) -> np.ndarray:
    slot = pair_slot(key)
    pair = head.crcs[slot]
    rest = np.flatnonzero(head.keys[slot] != key)
    pair[rest] = joined_crc(blank_after(crc[rest]), crc[rest + 1], short[rest + 1])
    return pair


NO_HEAD = Head([], np.zeros(0, np.int64), np.zeros(0, np.uint32))


def frequent(docs: DataFrame, text: str = "text") -> Head:
    """The head of the vocabulary, counted over all texts.

    Each block of text names the words and pairs with ``SHARE`` of its words, and how many words it has.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(NO_HEAD)
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = read_words(block.column("text"), vocabulary)
            least = SHARE * len(found.words)
            names = list(vocabulary)
            held = np.bincount(found.number, minlength=len(names))
            short = np.array(vocabulary.length, np.int64) <= HEAD_BYTES
            chosen = np.flatnonzero((held >= least) & short)
            number = np.where(short[found.number], found.number, -1) if len(names) else found.number
            key, times = np.unique(pair_keys(number)[(number[:-1] >= 0) & (number[1:] >= 0)], return_counts=True)
            key, times = key[times >= least], times[times >= least]
            first = [b""] + [names[k] for k in chosen] + [names[k] for k in (key >> 32).tolist()]
            second = [b""] * (1 + len(chosen)) + [names[k] for k in (key & 0xFFFFFFFF).tolist()]
            vocabulary.forget()
            counts = np.concatenate([[len(found.words)], held[chosen], times])
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(counts, pa.int64())],
                ["first", "second", "n"],
            )

    named = docs.select(F.col(text).alias("text")).mapInArrow(run, "first binary, second binary, n long")
    counted = stage(named.groupBy("first", "second").agg(F.sum("n").alias("n")), "vocabulary")
    total = counted.where(F.length("first") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counted.where((F.length("first") > 0) & (F.col("n") >= SHARE * total)).collect()
    release(counted)
    rows.sort(key=lambda r: (-r["n"], bytes(r["first"]), bytes(r["second"])))
    words = [bytes(r["first"]) for r in rows if not r["second"]]
    return head_of(words, [(bytes(r["first"]), bytes(r["second"])) for r in rows if r["second"]])


def head_of(words: list[bytes], pairs: list[tuple[bytes, bytes]]) -> Head:
    """A head from its words and pairs, the most frequent first; of two pairs in one slot the first stays."""
    number = {w: k for k, w in enumerate(words)}
    known = [(number[a], number[b], zlib.crc32(a + b" " + b)) for a, b in pairs if a in number and b in number]
    keys, crcs = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, np.uint32)
    if known:
        key = np.array([a << 32 | b for a, b, _ in known], np.int64)
        slot, first = np.unique(pair_slot(key), return_index=True)
        keys[slot] = key[first]
        crcs[slot] = np.array([c for _, _, c in known], np.uint32)[first]
    return Head(words, keys, crcs)


def bucket_totals(docs: DataFrame, head: Head, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts per bucket; buckets without a feature are left out."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        vocabulary = Vocabulary(head)
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            crc, _ = features(read_words(block.column("text"), vocabulary), vocabulary, head)
            total += np.bincount(crc % buckets, minlength=buckets)
            vocabulary.forget()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    partial = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of target to corpus per bucket, with one feature added to each, in whole thousandths."""
    spark = raw.sparkSession
    sums = [df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for df in (raw, target)]
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t"))
    ratio = (t + 1) * F.lit(float(sums[0] + buckets)) / ((s + 1) * F.lit(float(sums[1] + buckets)))
    rows = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))
    )
    gains = np.zeros(buckets, np.int64)
    for bucket, gain in rows.collect():
        gains[bucket] = gain
    return gains


def weigh(docs: DataFrame, gains: np.ndarray, head: Head, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_features, weight``."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast((gains, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, head = shared.value
        vocabulary = Vocabulary(head)
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = read_words(block.column("text"), vocabulary)
            crc, of = features(found, vocabulary, head)
            vocabulary.forget()
            total = block.num_rows
            # Sums of whole numbers below 2**53 are exact in doubles.
            weight = np.bincount(of, gains[crc % len(gains)], total).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array(found.counts), pa.array(np.bincount(of, minlength=total).astype(np.int64)), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of a document in whole thousandths, from a hash of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-F.log(-F.log(uniform)) * 1000)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_features, weight, score, rank``.

    ``weight`` sums over all features of the whole text how much likelier their buckets are in ``target`` than in
    ``docs``; ``score`` adds Gumbel noise, so that the highest scores are a draw by weight without replacement. Of
    the N rows with ``least_words`` words, ``percent * N // 100`` are drawn and numbered from the highest score on;
    ``rank`` is null for all others. Ties go to the smaller id, null ids last, then to the row with fewer features;
    rows equal in all that are numbered in any order.

    Null and empty texts have no words, weight 0, and are never drawn; an empty table gives no rows and an empty
    target leaves every feature with what the corpus says. A very long text is read whole, in one block of its task.
    Null ids share one noise. Repeated rows are rows of their own; other columns are ignored.
    """
    head = frequent(docs, text)
    # As many rows as there are buckets, read several times.
    raw, wanted = (stage(totals, "buckets") for totals in (bucket_totals(docs, head, text), bucket_totals(target, head, target_text)))
    gains = bucket_gains(raw, wanted)
    release(raw, wanted)
    scored = weigh(docs, gains, head, doc_id, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    order = {
        "_below": -F.col("score"),
        "_no_id": F.col("doc_id").isNull(),
        "_row": F.monotonically_increasing_id(),
    }
    scored = stage(scored.withColumns(order), "weighed")
    fit = F.col("n_words") >= least_words
    taken = scored.where(fit).count() * percent // 100
    ranked = number_rows(scored.where(fit), ["_below", "_no_id", "doc_id", "n_features", "_row"], out="rank", staged=True)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= taken, F.col("rank")))
    rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop(*order)
