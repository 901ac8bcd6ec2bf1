"""Operators that treat each document alone: words, tokens, toxicity, language."""

import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.fixtures import documents, no_documents, odd_rows, prose, sorted_rows
from wardline.llm import bpe, exact_dedup, language_id, token_counts, toxicity, words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.ByteBpe(bpe.read_file(PATH))


def texts_of(rows):
    return [t for _, t in rows]


def test_words_are_those_of_the_patterns():
    texts = [t or "" for t in texts_of(odd_rows())]
    for member, pattern in ((words.NOT_BLANK, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        found = words.words_of(pa.array(texts), member)
        assert found.counts().tolist() == [len(re.findall(pattern, t)) for t in texts]
        spelled = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
        assert spelled == [w for t in texts for w in re.findall(pattern, t)]
        by_code = {}
        assert all(by_code.setdefault(c, w) == w for c, w in zip(found.code.tolist(), spelled))


def test_words_do_not_depend_on_chunks(monkeypatch):
    texts = pa.array([prose(k, 200) for k in range(30)])
    whole = words.words_of(texts, words.NOT_BLANK)
    monkeypatch.setattr(words, "CHUNK", 50)
    parts = words.words_of(texts, words.NOT_BLANK)
    assert (whole.code == parts.code).all()


def test_windows_stay_in_a_text():
    found = words.words_of(pa.array(["a b c d", None, "b c", "x a b c d"]), words.NOT_BLANK)
    code, first = words.windows(found, 3)
    assert first.tolist() == [0, 1, 6, 7, 8]
    assert code[0] == code[3] and code[1] == code[4] and len(set(code.tolist())) == 3


def test_blocks_keep_every_row_whole():
    batch = pa.RecordBatch.from_pydict({"text": [None, "", "abc" * 10, "d", None, "e" * 100, "f"], "n": list(range(7))})
    for most in (1, 30, 31, 1000):
        parts = list(words.blocks(iter([batch, batch]), "text", most))
        assert [n for p in parts for n in p.column("n").to_pylist()] == [*range(7), *range(7)]


@given(st.lists(st.text(alphabet=st.sampled_from("ab' é1٣ \n\t　<|endoftext|>\U00010940̈—s'll"), max_size=60), max_size=4))
@settings(max_examples=150, deadline=None)
def test_tokens_of_any_text(texts):
    library, vocabulary = Tokenizer.from_file(PATH), bpe.opened(bpe.read_file(PATH))
    counter = token_counts.counter_for(bpe.read_file(PATH), token_counts.whole_tokens(vocabulary))
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(vocabulary.encode(text), np.int32).tolist() == ids
        assert counter.count(text) == len(ids)


def test_every_character_is_cut_as_in_the_library(library, vocabulary):
    for base in range(0, 0x30000, 0x400):
        chars = [chr(c) for c in range(base, base + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}2 {c}\n" for c in chars)
        assert vocabulary.pre_tokens(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_long_fragments_merge_like_short_ones(vocabulary):
    pick = random.Random(3)
    for size in (1, 2, 31, 32, 33, 200):
        fragment = "".join(pick.choice("ethanis") for _ in range(size)).encode()
        assert vocabulary.merge(fragment) == vocabulary.merge_long(fragment)


def test_cuts_are_forced(vocabulary):
    piece = prose(4, 30).replace(" ", "").encode()
    parts = vocabulary.fragments(piece)
    assert b"".join(parts) == piece and len(parts) > 1
    assert sum((vocabulary.merge(p) for p in parts), []) == vocabulary.merge_long(piece)


def test_whole_tokens_are_proven_by_merging(vocabulary):
    proven = token_counts.whole_tokens(vocabulary)
    assert all(vocabulary.merge(t) == [vocabulary.ids[t]] for t in random.Random(1).sample(proven, 500))


def test_decoding_broken_bytes(library, vocabulary):
    for ids in ([255, 128, 40, 200], [50256, 1, 222, 223, 224], [], [100, 101, 50256]):
        expected = library.decode(ids, skip_special_tokens=False)
        assert vocabulary.decode(np.array(ids, dtype=np.int64), np.array([0, len(ids)])) == [expected]


def test_encode_and_decode_rows(spark, library):
    encoded = bpe.encode(documents(spark), PATH)
    expected = sorted(
        ((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in odd_rows()), key=repr
    )
    assert sorted_rows(bpe.decode(encoded, PATH), "doc_id", "ids", "text") == expected
    assert bpe.encode(no_documents(spark), PATH).count() == 0
    assert bpe.decode(bpe.encode(no_documents(spark), PATH), PATH).count() == 0


def test_token_counts(spark, library):
    counted = token_counts.count_tokens(documents(spark), PATH, limit=100)
    counts = [(i, t, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows()]
    expected = sorted(((i, len((t or "").encode()), n, n > 100) for i, t, n in counts), key=repr)
    assert sorted_rows(counted, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_counts.count_tokens(no_documents(spark), PATH).count() == 0


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_duplicates(spark, keep):
    groups = {}
    for i, t in odd_rows():
        groups.setdefault(t or "", []).append(i)
    best = {t: (min if keep == "min" else max)([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    expected = sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""]) for i, t in odd_rows()), key=repr)
    found = exact_dedup.exact_duplicates(documents(spark), keep=keep)
    assert sorted_rows(found, "doc_id", "keep_id", "group_size", "kept") == expected
    assert exact_dedup.exact_duplicates(no_documents(spark)).count() == 0


def test_bytes_keep_colliding_texts_apart(spark):
    from pyspark.sql import functions as F

    weak = lambda text: F.length(text).cast("string").cast("binary")
    rows = [(k, f"text {k % 7}") for k in range(50)]
    found = exact_dedup.exact_duplicates(documents(spark, rows), hashed=weak)
    assert sorted_rows(found, "doc_id", "keep_id") == sorted(((k, k % 7) for k in range(50)), key=repr)


def mil_rows(count=400, seed=0):
    """Documents of several sentences; label 1 if some sentence has a word of a few bad stems."""
    pick = random.Random(seed)
    rows = []
    for k in range(count):
        label = int(pick.random() < 0.3)
        sentences = [prose(pick.randrange(10**9), 12, 1) for _ in range(pick.randint(2, 12))]
        if label:
            at = pick.randrange(len(sentences))
            sentences[at] = sentences[at][:-1] + " " + pick.choice(["grolk", "snarf"]) + pick.choice(["", "ed", "ing", "o"]) + "."
        rows.append((k, " ".join(sentences), label))
    return rows


def test_toxicity_learns_sentences_from_document_labels(spark):
    rows = mil_rows()
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    truth = {i: (t, y) for i, t, y in rows}
    right = 0
    for r in toxicity.score(docs, model).where("doc_id % 4 = 0").collect():
        text, label = truth[r["doc_id"]]
        right += (r["score"] >= 0.5) == bool(label)
        for span in r["offending"]:
            sentence = text[span["start"] : span["start"] + span["length"]]
            assert "grolk" in sentence or "snarf" in sentence
    assert right >= 98


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (17, 5), (6, 0)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark), labels)
    scored = toxicity.score(documents(spark), model, carry=["doc_id", "kept", "row"])
    assert sorted_rows(scored, "doc_id") == sorted(((i,) for i, _ in odd_rows()), key=repr)
    assert all(0 <= r["score"] <= 1 and r["row"]["kept"] == "kept" for r in scored.collect())
    assert [r["score"] for r in scored.where("doc_id in (5, 6)").collect()] == [0.0, 0.0]
    none = toxicity.train(no_documents(spark), labels)
    assert max(r["score"] for r in toxicity.score(documents(spark), none).collect()) < 1e-6
    assert toxicity.score(no_documents(spark), model).count() == 0


def test_noisy_or():
    odds = np.array([0.0, 0.0, -50.0, 3.0])
    found = toxicity.document_scores(odds, np.array([0, 0, 1, 3]), 4)
    assert np.allclose(found, [0.75, 0.0, 0.0, 1 / (1 + np.exp(-3))])


def test_marginals_are_those_of_the_plain_recursion():
    random_ = np.random.default_rng(0)
    for labels in (1, 2, 4, language_id.MANY_LABELS, 20):
        lengths = [1, 2, 31, 32, 33, 64, 65, 200, 5, 1]
        scores, moves = random_.normal(size=(sum(lengths), labels)), random_.normal(size=(labels, labels))
        first = np.zeros(len(scores), bool)
        first[np.cumsum([0, *lengths[:-1]])] = True
        found, at = language_id.chain_marginals(scores, moves, first), 0
        for n in lengths:
            p, step = np.exp(scores[at : at + n]), np.exp(moves)
            alpha, beta = [p[0]], [np.ones(labels)]
            for t in range(1, n):
                alpha.append((alpha[-1] @ step) * p[t] / alpha[-1].sum())
            for t in range(n - 2, -1, -1):
                message = step @ (p[t + 1] * beta[0])
                beta.insert(0, message / message.sum())
            plain = np.array(alpha) * np.array(beta)
            assert np.allclose(found[at : at + n], plain / plain.sum(1, keepdims=True))
            at += n


def random_model(labels, seed=0):
    random_ = np.random.default_rng(seed)
    weights = random_.normal(size=(language_id.FEATURES + labels, labels)) / 10
    return language_id.Crf([f"l{k:03}" for k in range(labels)], weights, random_.normal(size=(labels, labels)))


def shares_of(model, texts):
    data, offsets = words.text_bytes(pa.array(texts))
    start, end = words.spans(data, offsets, language_id.LETTERS)
    text = np.searchsorted(offsets, start, "right") - 1
    return language_id.text_shares(model, data, offsets, start, end, text)


@pytest.mark.parametrize("labels", [1, 3, 20])
def test_texts_in_pieces_have_the_same_shares(monkeypatch, labels):
    model = random_model(labels)
    texts = [prose(1, 30), "", prose(2, 400), "12 34", "x", prose(3, 12), prose(4, 90)]
    whole = shares_of(model, texts)
    for most in (1, 7, 32, 50, 100):
        monkeypatch.setattr(language_id, "CELLS", most * labels)
        assert np.allclose(shares_of(model, texts), whole)
    assert np.allclose(whole.sum(1), [1, 0, 1, 0, 1, 1, 1])


@pytest.mark.parametrize("labels", [64, 200])
def test_memory_does_not_follow_labels_and_length(labels):
    texts = [prose(1, 70_000)] + [prose(k, 500) for k in range(100)]
    tracemalloc.start()
    shares = shares_of(random_model(labels), texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The long text alone has several times as many words as a piece with 200 labels may hold.
    assert np.allclose(shares.sum(1), 1) and peak < 400 << 20


def test_lexicons_hold_common_words_of_each_language():
    codes = np.array([5, 9, 11, 20], np.uint64)
    # Documents 0 and 1 are of language 0, 2 and 3 of language 1.
    distinct, text = np.array([0, 1, 0, 2, 0, 3, 3, 0, 3]), np.array([0, 0, 1, 1, 2, 2, 2, 3, 3])
    found = language_id.lexicon_of(codes, distinct, text, np.array([0, 0, 1, 1]))
    assert found.code.tolist() == [5, 5, 20] and found.label.tolist() == [0, 1, 1]
    word, feature = found.features(np.array([20, 7, 5], np.uint64))
    assert word.tolist() == [0, 2, 2] and (feature - language_id.FEATURES).tolist() == [1, 0, 1]
    # Shared affixes and n-grams say nothing here; the lexicons get weights for their own language.
    texts = [" ".join(w + "xyz" for w in ("ab", "ba", "abab")) * 3, " ".join(w + "xyz" for w in ("ba", "bb", "baba")) * 3] * 5
    model = language_id.fit(texts, ["a", "b"] * 5)
    own = model.weights[language_id.FEATURES :]
    assert own[0, 0] > own[0, 1] and own[1, 1] > own[1, 0]


def test_the_earliest_rows_of_each_language(spark):
    rows = [(k, "many" if k % 10 else "few") for k in range(20_000)] + [(k, "rare") for k in range(3)] + [(7, "many")] * 500
    keys = spark.createDataFrame(rows, "doc_id long, lang string")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    expected = keys.withColumn("place", F.row_number().over(order)).where("place <= 100").drop("place")
    kept = language_id.earliest(keys, 100)
    found = kept.withColumn("place", F.row_number().over(order)).where("place <= 100").drop("place")
    assert sorted(found.collect()) == sorted(expected.collect())
    counts = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert counts["rare"] == 3 and 100 <= counts["few"] < 400 and 100 <= counts["many"] < 1000


def test_language_of_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    learned = docs.where(~docs["doc_id"].isin(out))
    model = language_id.train(learned)
    found = language_id.predict(docs.where(docs["doc_id"].isin(out)), model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_code_switched_text_is_split_between_its_languages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.train(docs)
    some = {}
    for r in docs.where("length(text) > 1000").orderBy("doc_id").collect():
        some.setdefault(r["lang"], r["text"])
    mixed = " ".join(some["en"].split()[:100]) + " " + " ".join(some["de"].split()[:50])
    (row,) = language_id.predict(documents(spark, [(1, mixed)]), model).collect()
    assert row["lang_pred"] == "en" and 0.55 < row["score"] < 0.8 and 0.2 < row["shares"]["de"] < 0.45


def test_language_of_odd_rows(spark, folder):
    model = language_id.train(spark.read.parquet(f"{folder}/documents.parquet"))
    found = language_id.predict(documents(spark), model)
    assert sorted_rows(found, "doc_id") == sorted(((i,) for i, _ in odd_rows()), key=repr)
    rows = {r["doc_id"]: r for r in found.where("doc_id is not null").collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (5, 6, 7, 14))
    assert all(rows[i]["lang_pred"] != "und" for i in (1, 8, 10, 13, 15))
    assert language_id.predict(no_documents(spark), model).count() == 0
    nothing = language_id.train(documents(spark))  # no language is given
    assert {r["lang_pred"] for r in language_id.predict(documents(spark), nothing).collect()} == {"und"}
    one = language_id.fit(["abc def"], ["xx"])
    assert {r["lang_pred"] for r in language_id.predict(documents(spark, [(1, "abc")]), one).collect()} == {"xx"}


def test_every_language_is_learned_from_the_whole_text(spark):
    rows = []
    for k in range(70):
        pick = random.Random(k)
        own = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        for d in range(3 if k < 69 else 2):
            words = " ".join(pick.choice(own) for _ in range(30))
            # The words of the rarest language come late in its texts.
            rows.append((10 * k + d, f"l{k:02}", "1 " * (3000 if k == 69 else 0) + words))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language_id.train(docs)
    assert model.labels == [f"l{k:02}" for k in range(70)]
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    assert found == {i: lang for i, lang, _ in rows}
    late = language_id.drawn_words(" ".join(f"w{chr(97 + k % 26)}" for k in range(6000)) + " end", 150)
    assert len(late.split()) <= 150 and late.endswith("end")
