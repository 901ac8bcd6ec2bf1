"""Language identification of code-switched text by a linear-chain conditional random field.

Every word has a label; forward-backward gives each word's label probabilities in its context, and a
text's language is the one with the largest share of its words. A word's features are its prefixes and
suffixes, its byte n-grams and the word itself, all hashed into one weight table, and the lexicons that hold it: each
language's common words in the training sample, with weights of their own. Transitions between the labels of
neighbouring words are learned with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.python_tasks import prepare
from wardline.llm.words import LOWER, blocks, mix, span_codes, spans, text_bytes

#: Bounds of the training sample: documents of each language, and words of each document.
SAMPLE_DOCUMENTS = 400
SAMPLE_WORDS = 150
#: Bytes of a document's words in the sample.
SAMPLE_BYTES = 20_000
#: Words of the sample times languages, which the memory of training follows; more languages get fewer words each, down to a least number.
SAMPLE_CELLS = 1 << 23
LEAST_DOCUMENTS, LEAST_WORDS = 8, 24

FEATURES = 1 << 15
CHAIN = 48
STEPS = 60
RATE = 0.1
DECAY = 1e-5
BLOCK_BYTES = 4 << 20
#: Words of a stretch for which the chain is worked out at once.
STRETCH = 32
#: From so many labels on, the product of a stretch's steps costs more than taking its steps one after the other.
MANY_LABELS = 12
#: Words times labels worked out at once; a text with more is passed through in pieces.
CELLS = 1 << 21
#: Words of each language's lexicon at most, and how many sampled documents of the language hold each at least.
LEXICON_WORDS, LEXICON_DOCUMENTS = 4000, 2

UNKNOWN = "und"

#: Bytes of words: ASCII letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def features_of(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of words given by byte spans, as parts of (number of the word, feature).

    They are the word, the affixes of 1 to 4 bytes and the n-grams of 2 to 4.
    """

    def hashed(value: np.ndarray) -> np.ndarray:
        return (mix(value) % np.uint64(FEATURES)).astype(np.int64)

    length = end - start
    number = np.arange(len(start))
    yield number, hashed(code + np.uint64(1))
    at = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
    owner = np.repeat(number, length)
    gram = np.zeros(len(at), np.uint64)
    for size in range(1, 5):
        inside = at + size <= end[owner]
        at, owner, gram = at[inside], owner[inside], gram[inside]
        gram = gram * np.uint64(257) + data[at + size - 1].astype(np.uint64) + np.uint64(1)
        tagged = gram * np.uint64(8) + np.uint64(size)
        if size > 1:
            yield owner, hashed(tagged)
        head, tail = at == start[owner], at + size == end[owner]
        yield owner[head], hashed(tagged[head] + np.uint64(1 << 50))
        yield owner[tail], hashed(tagged[tail] + np.uint64(1 << 51))


@dataclass
class Lexicon:
    """Fingerprints of each language's common words, in order, and the number of the language."""

    code: np.ndarray
    label: np.ndarray

    def features(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lexicons that hold each word, as (number of the word, feature); a word may be in several."""
        low, high = np.searchsorted(self.code, code, "left"), np.searchsorted(self.code, code, "right")
        count = high - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.repeat(np.arange(len(code)), count), FEATURES + self.label[at]


NO_LEXICON = Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64))


def lexicon_of(codes: np.ndarray, distinct: np.ndarray, text: np.ndarray, langs: np.ndarray) -> Lexicon:
    """Lexicons of a sample: words ``codes[distinct]`` in the documents ``text``, whose languages are ``langs``."""
    held = np.unique(np.stack([distinct, text]), axis=1)
    pair, documents = np.unique(langs[held[1]] * len(codes) + held[0], return_counts=True)
    pair, documents = pair[documents >= LEXICON_DOCUMENTS], documents[documents >= LEXICON_DOCUMENTS]
    lang = pair // max(len(codes), 1)
    order = np.lexsort((pair, -documents, lang))
    begins = np.searchsorted(lang[order], lang[order])
    pair = pair[order[np.arange(len(order)) - begins < LEXICON_WORDS]]
    code, lang = codes[pair % max(len(codes), 1)], pair // max(len(codes), 1)
    order = np.lexsort((lang, code))
    return Lexicon(code[order], lang[order])


def emissions(parts: Iterable[tuple[np.ndarray, np.ndarray]], total: int, weights: np.ndarray) -> np.ndarray:
    """Score of each distinct word for each label."""
    scores = np.zeros((total, weights.shape[1]))
    columns = np.ascontiguousarray(weights.T)
    for word, feature in parts:
        for k, column in enumerate(columns):
            scores[:, k] += np.bincount(word, column[feature], total)
    return scores


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: Lexicon = field(default_factory=lambda: NO_LEXICON)


def no_model(labels: list[str]) -> Crf:
    size = len(labels)
    return Crf(labels, np.zeros((FEATURES + size, size)), np.zeros((size, size)))


def chain_marginals(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Label probabilities of every word by forward-backward over chains laid end to end; ``first`` marks where one begins."""
    if not len(scores):
        return scores
    return passes(scores, transitions, first)[0]


Passes = tuple[np.ndarray, np.ndarray, np.ndarray]


def passes(
    scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None
) -> Passes:
    """Label probabilities, the forward message after the last word and the backward message before the first one.

    ``before`` and ``after`` are such messages of the rest of a single chain.
    """
    by = passes_by_stretch if scores.shape[1] < MANY_LABELS else passes_by_word
    return by(scores, transitions, first, before, after)


def passes_by_word(
    scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, before: np.ndarray | None, after: np.ndarray | None
) -> Passes:
    """All chains side by side, word by word; memory follows words times labels."""
    potential = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(scores)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    live = np.searchsorted(-length, -np.arange(length[0]), "left")
    found = np.empty_like(potential)
    message = np.ones((1, scores.shape[1])) if before is None else before @ step
    for t in range(length[0]):
        rows = begin[: live[t]] + t
        moved = (message[: live[t]] @ step if t else message) * potential[rows]
        message = moved / moved.sum(1, keepdims=True)
        found[rows] = message
    end = found[-1:].copy()
    message = np.ones((len(begin), scores.shape[1])) if after is None else after.copy()
    for t in range(length[0] - 1, -1, -1):
        rows = begin[: live[t]] + t
        found[rows] *= message[: live[t]]
        moved = (message[: live[t]] * potential[rows]) @ step.T
        message[: live[t]] = moved / moved.sum(1, keepdims=True)
    return found / found.sum(1, keepdims=True), end, message[:1]


def passes_by_stretch(
    scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, before: np.ndarray | None, after: np.ndarray | None
) -> Passes:
    """The chains are cut into stretches of ``STRETCH`` words.

    For each stretch the product of its steps is a small matrix; passing messages from stretch
    to stretch through those gives each its incoming message, and then all stretches are worked out
    side by side. Results are those of the plain recursion, with a chain of any length.
    """
    total, labels = scores.shape
    potential = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    number = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    place = np.arange(total) - begins[number]
    opens = place % STRETCH == 0
    stretch = np.cumsum(opens) - 1
    column = place % STRETCH
    count = int(opens.sum())
    width = int(column.max()) + 1
    grid = np.ones((width, count, labels))
    grid[column, stretch] = potential
    filled = np.zeros((width, count), bool)
    filled[column, stretch] = True
    heads = place[opens] == 0
    heads[0] &= before is None
    #: Stretches by how many come before (after) them in their chain: those of one turn are independent.
    index = place[opens] // STRETCH
    last = np.zeros(int(number[-1]) + 1, np.int64)
    np.maximum.at(last, number[opens], index)
    remaining = last[number[opens]] - index

    products = np.broadcast_to(np.eye(labels), (count, labels, labels)).copy()
    long = np.flatnonzero(last[number[opens]] > 0)
    if len(long):
        part = products[long]
        for t in range(width):
            # A chain's first word has no transition before it.
            moved = np.where(heads[long][:, None, None], part, part @ step) if t == 0 else part @ step
            moved = moved * grid[t, long][:, None, :]
            moved /= moved.sum((1, 2), keepdims=True)
            part = np.where(filled[t, long][:, None, None], moved, part)
        products[long] = part

    incoming = np.full((count, labels), 1.0 / labels)  # probabilities after the word before the stretch
    outgoing = np.ones((count, labels))  # message from the word after the stretch
    if before is not None:
        incoming[0] = before
    if after is not None:
        outgoing[-1] = after
    order = np.argsort(index, kind="stable")
    cuts = np.searchsorted(index[order], np.arange(1, index.max() + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        now = order[a:b]
        alpha = np.einsum("nk,nkl->nl", incoming[now - 1], products[now - 1])
        incoming[now] = alpha / alpha.sum(1, keepdims=True)
    order = np.argsort(remaining, kind="stable")
    cuts = np.searchsorted(remaining[order], np.arange(1, remaining.max() + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        now = order[a:b]
        beta = np.einsum("nkl,nl->nk", products[now + 1], outgoing[now + 1])
        outgoing[now] = beta / beta.sum(1, keepdims=True)

    alphas = np.empty_like(grid)
    message = incoming
    for t in range(width):
        moved = message @ step
        if t == 0:
            moved = np.where(heads[:, None], 1.0, moved)
        moved = moved * grid[t]
        message = moved / moved.sum(1, keepdims=True)
        alphas[t] = message
    betas = np.empty_like(grid)
    message = outgoing
    for t in range(width - 1, -1, -1):
        betas[t] = np.where(filled[t][:, None], message, 1.0)
        moved = (message * grid[t]) @ step.T
        moved /= moved.sum(1, keepdims=True)
        message = np.where(filled[t][:, None], moved, message)
    found = alphas[column, stretch] * betas[column, stretch]
    return found / found.sum(1, keepdims=True), alphas[column[-1], stretch[-1]][None], message[:1]


def text_shares(model: Crf, data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Share of each text's words that each label has; ``start``, ``end`` and ``text`` are those of the words."""
    size = len(model.labels)
    shares = np.zeros((len(offsets) - 1, size))
    most = max(CELLS // max(size, 1), 1)
    cuts = np.searchsorted(text, np.arange(len(offsets)))

    def scores(a: int, b: int) -> np.ndarray:
        codes, one, distinct = np.unique(span_codes(data, start[a:b], end[a:b]), return_index=True, return_inverse=True)
        parts = features_of(data, start[a:b][one], end[a:b][one], codes)
        return emissions(chain(parts, [model.lexicon.features(codes)]), len(codes), model.weights)[distinct]

    at = 0
    while at < len(shares):
        # As many whole texts as there is room for, or one text in pieces.
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + most, "right")) - 1)
        a, b = int(cuts[at]), int(cuts[to])
        if b - a > most:
            shares[at] = long_share(scores, a, b, model.transitions, most)
        elif b > a:
            first = np.ones(b - a, bool)
            first[1:] = text[a + 1 : b] != text[a : b - 1]
            chances = chain_marginals(scores(a, b), model.transitions, first)
            shares[at:to] = np.stack([np.bincount(text[a:b] - at, chances[:, k], to - at) for k in range(size)], 1)
        at = to
    return shares / np.maximum(shares.sum(1, keepdims=True), 1e-300)


def long_share(scores: Callable[[int, int], np.ndarray], a: int, b: int, transitions: np.ndarray, most: int) -> np.ndarray:
    """Summed label probabilities of one chain, in pieces: first the messages forward, then the pieces from the last one on."""
    pieces = [(at, min(at + most, b)) for at in range(a, b, most)]
    before: list[np.ndarray | None] = [None]
    for low, high in pieces[:-1]:
        before.append(passes(scores(low, high), transitions, np.arange(high - low) == 0, before[-1])[1])
    total, after = np.zeros(transitions.shape[0]), None
    for (low, high), message in zip(reversed(pieces), reversed(before), strict=True):
        found, _, after = passes(scores(low, high), transitions, np.arange(high - low) == 0, message, after)
        total += found.sum(0)
    return total


def training_chains(texts: list[str], langs: list[int]) -> tuple[np.ndarray, ...]:
    """Chains of ``CHAIN`` words put together from short runs of several documents.

    Documents carry one language each; runs of 6 to 24 words side by side show the model what a switch
    looks like. The runs are drawn in a fixed order.
    """
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    data = LOWER[data]
    start, end = spans(data, offsets, LETTERS)
    text = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(text, np.arange(len(texts)))
    last = np.minimum(np.searchsorted(text, np.arange(len(texts)), "right"), first + SAMPLE_WORDS)
    random = np.random.default_rng(7)
    runs: list[tuple[int, int, int]] = []
    for number, lang in enumerate(langs):
        at = int(first[number])
        while at < last[number]:
            to = min(at + int(random.integers(6, 25)), int(last[number]))
            runs.append((at, to, lang))
            at = to
    order = random.permutation(len(runs))
    word = np.concatenate([np.arange(runs[i][0], runs[i][1]) for i in order] or [np.zeros(0, int)])
    label = np.concatenate([np.full(runs[i][1] - runs[i][0], runs[i][2]) for i in order] or [np.zeros(0, int)])
    if 0 < len(word) < CHAIN:
        word, label = np.tile(word, CHAIN)[:CHAIN], np.tile(label, CHAIN)[:CHAIN]
    whole = len(word) // CHAIN * CHAIN
    return data, start, end, text, word[:whole].reshape(-1, CHAIN).T, label[:whole].reshape(-1, CHAIN).T


def fit(texts: list[str], langs: list[str]) -> Crf:
    """Maximum likelihood of the labels of the training chains, by gradient steps on forward-backward."""
    labels = sorted(set(langs))
    number = {lang: k for k, lang in enumerate(labels)}
    size = len(labels)
    table = FEATURES + size
    weights, transitions = np.zeros((table, size)), np.zeros((size, size))
    if size < 2:
        return no_model(labels)
    data, start, end, text, word, label = training_chains(texts, [number[lang] for lang in langs])
    if not word.size:
        return no_model(labels)
    codes, one, distinct = np.unique(span_codes(data, start, end), return_index=True, return_inverse=True)
    lexicon = lexicon_of(codes, distinct, text, np.array([number[lang] for lang in langs]))
    parts = [*features_of(data, start[one], end[one], codes), lexicon.features(codes)]
    owner, feature = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    word = distinct[word]
    steps, chains = word.shape
    truth = np.eye(size)
    seen = np.stack([np.bincount(word.ravel(), truth[label.ravel(), k], len(codes)) for k in range(size)], 1)
    seen_moves = np.zeros((size, size))
    np.add.at(seen_moves, (label[:-1].ravel(), label[1:].ravel()), 1.0)
    first, second = np.zeros((table + size, size)), np.zeros((table + size, size))
    for turn in range(1, STEPS + 1):
        scores = emissions([(owner, feature)], len(codes), weights)
        potential = np.exp(scores - scores.max(1, keepdims=True))[word]
        step = np.exp(transitions - transitions.max())
        alpha, beta = np.empty_like(potential), np.ones_like(potential)
        alpha[0] = potential[0] / potential[0].sum(1, keepdims=True)
        for t in range(1, steps):
            moved = (alpha[t - 1] @ step) * potential[t]
            alpha[t] = moved / moved.sum(1, keepdims=True)
        moves = np.zeros((size, size))
        for t in range(steps - 2, -1, -1):
            ahead = potential[t + 1] * beta[t + 1]
            whole = ((alpha[t] @ step) * ahead).sum(1, keepdims=True)
            moves += step * ((alpha[t] / whole).T @ ahead)
            moved = ahead @ step.T
            beta[t] = moved / moved.sum(1, keepdims=True)
        node = alpha * beta
        node /= node.sum(2, keepdims=True)
        flat = node.reshape(-1, size)
        expected = np.stack([np.bincount(word.ravel(), flat[:, k], len(codes)) for k in range(size)], 1)
        slope = expected - seen
        gradient = np.concatenate(
            [
                np.stack([np.bincount(feature, slope[owner, k], table) for k in range(size)], 1) / chains
                + DECAY * weights,
                (moves - seen_moves) / chains,
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
        weights -= move[:table]
        transitions -= move[table:]
    return Crf(labels, weights, transitions, lexicon)


def sample_size(languages: int) -> tuple[int, int]:
    """Documents of each language in the sample, and words of each document."""
    words = SAMPLE_CELLS // languages**2
    documents = min(SAMPLE_DOCUMENTS, max(LEAST_DOCUMENTS, words // 50))
    return documents, min(SAMPLE_WORDS, max(LEAST_WORDS, words // documents))


def drawn_words(text: str, most: int) -> str:
    """At most ``most`` words of a text, in runs of ``LEAST_WORDS`` or more spread evenly over the whole of it.

    Of a word with more than its share of ``SAMPLE_BYTES`` the beginning is taken.
    """
    data, offsets = text_bytes(pa.array([text], pa.string()))
    start, end = spans(data, offsets, LETTERS)
    chosen = np.arange(len(start))
    if len(start) > most:
        runs = most // LEAST_WORDS
        length = most // runs
        begins = np.linspace(0, len(start) - length, runs).astype(np.int64) if runs > 1 else np.array([(len(start) - length) // 2])
        chosen = np.unique(begins[:, None] + np.arange(length))
    share = SAMPLE_BYTES // max(len(chosen), 1)
    return b" ".join(data[start[k] : min(end[k], start[k] + share)].tobytes() for k in chosen).decode("utf-8", "ignore")


def earliest(keys: DataFrame, most: int) -> DataFrame:
    """The rows of ``keys`` (``doc_id, lang``) that can be among a language's first ``most`` by the hash of the id.

    Rows are counted by the leading bits that their hash has in common with the least one. Of a language stay those
    with the most such bits that ``most`` rows have: about ``most`` to twice as many, however many there are in all.
    """
    least = F.lit(-(1 << 63))
    # A number's binary digits begin at its first set bit.
    bits = 64 - F.length(F.bin(F.xxhash64("doc_id").bitwiseXOR(least)))
    keys = keys.withColumn("bits", bits)
    held = keys.groupBy("lang", "bits").agg(F.count("*").alias("rows"))
    above = Window.partitionBy("lang").orderBy(F.desc("bits"))
    enough = held.withColumn("rows", F.sum("rows").over(above)).where(F.col("rows") >= most)
    bounds = enough.groupBy("lang").agg(F.max("bits").alias("bound"))
    # One row for each language at most.
    return keys.join(F.broadcast(bounds), "lang", "left").where("bound is null or bits >= bound").select("doc_id", "lang")


def train(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text") -> Crf:
    """Fit on a sample of every language: at most ``SAMPLE_DOCUMENTS`` documents and ``SAMPLE_WORDS`` words of each.

    Rows without a language or text are left out. With many languages the sample has fewer documents and words of
    each (``sample_size``). It is taken in the order of a hash of the ids; words are drawn from the whole text.
    """
    prepare(docs.sparkSession)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    languages = known.select(F.col(lang)).distinct().count()
    if not languages:
        return no_model([])
    documents, most = sample_size(languages)
    keys = earliest(known.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang")), documents)
    # Spark trims each language to its first rows before the shuffle.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= documents).drop("place")
    texts = known.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [drawn_words(t, most) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(words, pa.string())], batch.schema.names)

    # The chosen ids are a bounded number for each language; an id that many rows have brings the least of its texts.
    met = texts.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = met.select("doc_id", "lang", "text").mapInArrow(draw, met.select("doc_id", "lang", "text").schema)
    rows = rows.orderBy("doc_id", "text").toPandas()
    return fit(rows["text"].tolist(), rows["lang"].tolist())


def predict(docs: DataFrame, model: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, shares``.

    ``shares`` (label to share of the words, a map) adds the words' label probabilities over the whole text;
    ``lang_pred`` has the largest share, the first in order of a tie, and ``score`` is that share. A null
    text, or one without a letter, is ``und`` with score 0 and no shares; so is every text if no label
    was learned. Repeated rows and null ids pass through, an empty table gives no rows, other columns
    are ignored. Memory is bounded however many labels there are and however long a text is: the chain of a very
    long text is passed through in pieces, with the same result.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size = len(model.labels)
        for block in blocks(batches, "text", BLOCK_BYTES):
            total = block.num_rows
            column = block.column("text").combine_chunks()
            data, offsets = text_bytes(column)
            data = LOWER[data]
            start, end = spans(data, offsets, LETTERS)
            text = np.searchsorted(offsets, start, "right") - 1
            shares = text_shares(model, data, offsets, start, end, text) if size else np.zeros((total, 0))
            ascii_letter = np.bincount(text, data[start] < 0x80, total) > 0 if len(start) else np.zeros(total, bool)
            lettered = ascii_letter.copy()
            for i in np.flatnonzero(~ascii_letter & (np.bincount(text, minlength=total) > 0)):
                lettered[i] = any(map(str.isalpha, column[i].as_py()))
            langs, best, maps = [], np.zeros(total), []
            for i in range(total):
                if size and lettered[i]:
                    k = int(shares[i].argmax())
                    langs.append(model.labels[k])
                    best[i] = min(1.0, shares[i, k])
                    maps.append(list(zip(model.labels, shares[i].tolist(), strict=True)))
                else:
                    langs.append(UNKNOWN)
                    maps.append([])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").combine_chunks(),
                    pa.array(langs, pa.string()),
                    pa.array(best),
                    pa.array(maps, pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "shares"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, shares map<string,double>")
