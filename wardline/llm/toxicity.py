"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, from document labels.

A document is toxic if any of its sentences is: P(document) = 1 - prod(1 - P(sentence)). Only documents
are labelled; the gradient of the document's loss tells the sentences apart. A sentence's score is a
logistic of its distinct words' weights, so the same weights point at the offending sentences afterwards.
A word's weight adds those of the word and of its beginnings, so that inflected forms of a stem count
although they were never seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.python_tasks import prepare
from wardline.llm.words import ALNUM, LOWER, blocks, mix, span_codes, spans, text_bytes

#: Bounds of the training sample: labelled documents, and the bytes of each; scoring has no bounds.
SAMPLE_DOCUMENTS = 5_000
SAMPLE_BYTES = 20_000
#: A word or beginning is a feature if toxic documents hold it more often than chance would have it, by so
#: many standard deviations. The many words that merely happen to be rare are left out.
LEAST_EXCESS = 5.0
STEPS = 200
RATE = 0.2
DECAY = 1e-4

BLOCK_BYTES = 4 << 20

#: Bytes that end a sentence.
ENDS = np.zeros(256, bool)
ENDS[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


#: Lengths in bytes of the beginnings of a word that are features beside the whole word.
BEGINNINGS = (3, 4, 5, 6, 7)


@dataclass
class Sentences:
    """Sentences of a batch, the distinct words of the batch, and which sentence holds which word."""

    text: np.ndarray  # number of the text of each sentence
    start: np.ndarray  # byte span within the batch
    end: np.ndarray
    features: np.ndarray  # fingerprints of each distinct word and its beginnings; 0 for none
    word: np.ndarray  # number of each distinct word of a sentence
    of: np.ndarray  # number of that word's sentence
    data: np.ndarray
    offsets: np.ndarray


def sentences_of(column: pa.Array | pa.ChunkedArray) -> Sentences:
    data, offsets = text_bytes(column)
    data = LOWER[data]
    start, end = spans(data, offsets, ~ENDS)
    begin, stop = spans(data, offsets, ALNUM)
    of = np.searchsorted(start, begin, "right") - 1
    codes, one, distinct = np.unique(span_codes(data, begin, stop), return_index=True, return_inverse=True)
    features = np.zeros((len(codes), 1 + len(BEGINNINGS)), np.uint64)
    features[:, 0] = codes
    begin, stop = begin[one], stop[one]
    for k, size in enumerate(BEGINNINGS, 1):
        longer = np.flatnonzero(stop - begin > size)
        longer = longer[np.argsort(begin[longer])]
        # A beginning is another feature than the word that is spelled alike.
        features[longer, k] = mix(span_codes(data, begin[longer], begin[longer] + size) + np.uint64(size))
    pairs = np.unique(of * max(1, len(codes)) + distinct)
    of, word = np.divmod(pairs, max(1, len(codes)))
    text = np.searchsorted(offsets, start, "right") - 1
    return Sentences(text, start, end, features, word, of, data, offsets)


@dataclass
class Model:
    """Weights by fingerprint, sorted by it, and the weight that every sentence has."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_scores(self, found: Sentences) -> np.ndarray:
        """Log odds of each sentence."""
        if not len(self.features):
            return np.full(len(found.text), self.bias)
        at = np.minimum(np.searchsorted(self.features, found.features), len(self.features) - 1)
        weight = np.where(self.features[at] == found.features, self.weights[at], 0.0).sum(1)
        return self.bias + np.bincount(found.of, weight[found.word], len(found.text))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def document_scores(odds: np.ndarray, text: np.ndarray, total: int) -> np.ndarray:
    """Noisy-or of each document's sentences; without sentences it is 0."""
    return -np.expm1(-np.bincount(text, softplus(odds), total))


def associated(found: Sentences, label: np.ndarray, share: float) -> np.ndarray:
    """Sorted fingerprints of the features that documents of label 1 hold more often than chance would have it."""
    documents = len(label)
    pairs = np.unique(found.word * documents + found.text[found.of])
    word, document = np.divmod(pairs, documents)
    chosen = []
    for column in found.features.T:  # one length of beginning at a time, to keep the tables small
        names, number = np.unique(column, return_inverse=True)
        pairs = np.unique(number[word] * documents + document)
        feature, holder = np.divmod(pairs, documents)
        held = np.bincount(feature, minlength=len(names))
        toxic = np.bincount(feature, label[holder], len(names))
        excess = (toxic - held * share) / np.sqrt(np.maximum(held, 1) * share * (1 - share))
        chosen.append(names[(excess >= LEAST_EXCESS) & (names != 0)])
    return np.unique(np.concatenate(chosen))


def fit(found: Sentences, label: np.ndarray) -> Model:
    """Train on the sentences of documents with labels 0 and 1.

    Without both labels the model gives every sentence the one there is (0 if none).
    """
    share = float(label.mean()) if len(label) else 0.0
    if share in (0.0, 1.0) or not len(found.word):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 if share == 1.0 else -30.0)
    documents, sentences = len(label), len(found.text)
    features = associated(found, label, share)
    word, number = [], []
    for column in found.features.T:
        at = np.minimum(np.searchsorted(features, column), max(0, len(features) - 1))
        known = np.flatnonzero(features[at] == column) if len(features) else np.zeros(0, np.int64)
        word.append(known)
        number.append(at[known])
    word, number = np.concatenate(word), np.concatenate(number)
    weights, bias = np.zeros(len(features)), float(np.log(share / max(1.0, sentences / documents)))
    first, second = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    # Words without a chosen feature weigh nothing.
    counted = np.zeros(len(found.features), bool)
    counted[word] = True
    use = counted[found.word]
    in_word, in_sentence = found.word[use], found.of[use]
    for step in range(1, STEPS + 1):
        by_word = np.bincount(word, weights[number], len(found.features))
        odds = bias + np.bincount(in_sentence, by_word[in_word], sentences)
        clean = np.exp(-np.bincount(found.text, softplus(odds), documents))
        pull = np.where(label == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        slope = pull[found.text] / (1 + np.exp(-odds)) / documents
        on_word = np.bincount(in_word, slope[in_sentence], len(found.features))
        gradient = np.append(np.bincount(number, on_word[word], len(features)) + DECAY * weights, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    matters = np.abs(weights) > 1e-3
    return Model(features[matters], weights[matters], bias)


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, label_id: str) -> DataFrame:
    """A bounded set of labelled documents, by the order of a hash of their ids."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    fit_for = docs.where(F.col(doc_id).isNotNull() & (F.octet_length(text) <= SAMPLE_BYTES))
    chosen = (
        fit_for.select(F.col(doc_id).alias("doc_id"))
        .distinct()
        .join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCUMENTS)
    )
    texts = fit_for.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample has a fixed number of rows of two numbers each. Of several texts of an id the least one is taken, in
    # every task first, so an id that many rows have brings one of them.
    met = texts.join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    label_id: str = "doc_id",
) -> Model:
    """Fit on at most ``SAMPLE_DOCUMENTS`` labelled documents of at most ``SAMPLE_BYTES`` bytes.

    Labels other than 0 and 1 are no labels; of several labels of a document the larger holds, of several texts of an
    id the least.
    """
    rows = sample(docs, labels, doc_id, text, label, label_id)
    # In a fixed order, so that the same rows give the same weights bit by bit.
    found = rows.orderBy("doc_id", "text").toPandas()
    return fit(sentences_of(pa.array(found["text"], pa.string())), found["label"].to_numpy(dtype=np.int64))


def score(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per input row: ``doc_id, score, offending``, and the columns in ``carry`` as the struct ``row``.

    ``score`` is the noisy-or of the sentence scores over the whole text; null and empty texts have no
    sentence and score 0. ``offending`` lists the sentences that score 0.5 or more as ``start, length``
    (code points) and ``score``. Repeated rows and null ids pass through, an empty table gives no rows,
    other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = sentences_of(block.column("text"))
            odds = model.sentence_scores(found)
            total = block.num_rows
            bad = np.flatnonzero(odds >= 0)
            begins = (found.data & 0xC0) != 0x80
            letters = np.zeros(len(begins) + 1, np.int64)
            np.cumsum(begins, out=letters[1:])
            start = letters[found.start[bad]] - letters[found.offsets[found.text[bad]]]
            length = letters[found.end[bad]] - letters[found.start[bad]]
            at = np.searchsorted(found.text[bad], np.arange(total + 1)).astype(np.int32)
            spans_of = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(length), pa.array(1 / (1 + np.exp(-odds[bad])))], ["start", "length", "score"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(c).combine_chunks() for c in kept),
                    pa.array(np.clip(document_scores(odds, found.text, total), 0, 1)),
                    pa.ListArray.from_arrays(pa.array(at), spans_of),
                ],
                [*kept, "score", "offending"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *([F.struct(*carry).alias("row")] if carry else []), F.col(text).alias("text")
    )
    kept = rows.columns[:-1]
    made = T.StructType.fromDDL("score double, offending array<struct<start:bigint,length:bigint,score:double>>")
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in kept), *made]))
