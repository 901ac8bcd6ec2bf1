"""Quality rules, importance resampling and the filter audit on odd rows, held against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, no_documents, odd_rows, prose, sorted_rows
from wardline.llm import filter_audit, importance, quality_rules
from wardline.llm.queries import NIBBLES

BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

FURNITURE = "\n".join(
    [
        prose(31, 90, 6),
        "Home | News | Sport | Contact",
        "All rights reserved.",
        "A heading without an end",
        "BUY!! NOW!! CHEAP!!",
        "Hello there!",
        "  ",
        prose(31, 90, 6).split("\n")[0],
    ]
)
MORE = [(30, FURNITURE), (31, "\n".join(["Menu | Shop | Help"] * 40)), (32, "one two three four " * 30), (33, prose(40, 200, 9))]


# Quality rules.
def repeated(words):
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if grams[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    return len(covered)


def line_fails(line):
    chars = sum(map(len, re.findall(BLANK, line)))
    body = line.strip("\t\n\x0b\x0c\r ")
    marks, separators = len(re.findall(quality_rules.MARKS, line)), len(re.findall(quality_rules.SEPARATORS, line))
    bad_end = chars > 0 and (body[-1] not in quality_rules.SENTENCE_END or (marks > 1 and marks * 10 > chars))
    return bad_end, separators > 1 and separators * 25 >= chars, any(p in line.lower() for p in quality_rules.BOILERPLATE)


def expected_quality(doc_id, text):
    text = text or ""
    words, lines = re.findall(BLANK, text), text.split("\n")
    real = [x for x in lines if re.search(BLANK, x)]
    lost = sum(sum(map(len, re.findall(BLANK, x))) for x in lines if any(line_fails(x)))
    chars = sum(map(len, words))
    base = len(words) < 50 or 100 * repeated(words) > 50 * len(words)
    kept = not base and lost * 100 <= chars * 30
    cleaned = "\n".join(x for x in lines if not any(line_fails(x)))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return doc_id, len(words), chars, symbols, len(real) - len(set(real)), repeated(words), base, kept, lost, cleaned


QUALITY = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "cleaned"]


def test_quality_against_brute_force(spark):
    rows = odd_rows() + MORE
    found = quality_rules.clean_lines(documents(spark, rows))
    assert sorted_rows(found, *QUALITY) == sorted((expected_quality(*r) for r in rows), key=repr)


def test_lines_by_rule(spark):
    found = quality_rules.clean_lines(documents(spark, [(30, FURNITURE)])).first()
    assert (found["n_punctuation"], found["n_navigation"], found["n_boilerplate"], found["n_dup_lines"]) == (3, 1, 1, 1)
    assert "Hello there!" in found["cleaned"] and "Home" not in found["cleaned"]


def test_quality_of_an_empty_table_and_one_scan(spark):
    assert quality_rules.clean_lines(no_documents(spark)).count() == 0
    plan = quality_rules.clean_lines(documents(spark, partitions=1).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_plan_reads_two_columns_without_a_shuffle(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = quality_rules.clean_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_one_text_of_many_windows(spark):
    """A text of 60,000 words of which only one window is repeated."""
    words = [f"w{k}" for k in range(60_000)]
    words[50_000:50_003] = words[100:103]
    found = quality_rules.clean_lines(documents(spark, [(1, " ".join(words))])).first()
    assert (found["n_words"], found["n_repeat_words"]) == (60_000, 6)


# Importance resampling.
def ngrams(text):
    words = re.findall(ALNUM, (text or "").translate(LOWER))
    return words, [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def expected_draw(rows, target, percent):
    raw, wanted = Counter(), Counter()
    for _, text in rows:
        raw.update(map(bucket, ngrams(text)[1]))
    for text in target:
        wanted.update(map(bucket, ngrams(text)[1]))
    S, T = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (S + 10_000) / ((raw[b] + 1) * (T + 10_000))))
    out = []
    for doc_id, text in rows:
        words, grams = ngrams(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(g)) for g in grams)
        out.append((doc_id, len(words), len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = [r for r in out if r[1] >= 20]
    fit.sort(key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    ranks = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted(((*r, ranks.get(id(r))) for r in out), key=repr)


DRAW = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
LONG_WORDS = [(40, " ".join(["ab" * 50, "cd", "é" * 70, "X" * 64, "Y" * 65] * 6)), (41, "a\x00b-C_d " * 30)]


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_draw_against_brute_force(spark, percent):
    rows = odd_rows() + MORE + LONG_WORDS
    target = [prose(1), prose(40, 200, 9), "ab" * 50 + " cd", None, ""]
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    found = importance.resample(documents(spark, rows), goal, percent=percent)
    assert sorted_rows(found, *DRAW) == expected_draw(rows, target, percent)


def test_draw_without_rows_or_target(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(no_documents(spark), none).count() == 0
    assert sorted_rows(importance.resample(documents(spark), none, percent=50), *DRAW) == expected_draw(odd_rows(), [], 50)


def test_head_decides_nothing(spark):
    """Features are the same with a head from other texts, with one, and with none."""
    rows = odd_rows() + MORE + LONG_WORDS
    column = pa.chunked_array([pa.array([t for _, t in rows], pa.string())])
    frames = documents(spark, rows)
    heads = [importance.NO_HEAD, importance.frequent(frames), importance.head_of([b"na", b"cd"], [(b"na", b"na"), (b"cd", b"xx")])]
    assert len(heads[1].words) > 20 and (heads[1].keys >= 0).sum() > 20
    want = sorted(zlib.crc32(g.encode()) for _, t in rows for g in ngrams(t)[1])
    for head in heads:
        vocabulary = importance.Vocabulary(head)
        for _ in range(2):
            crc, _ = importance.features(importance.read_words(column, vocabulary), vocabulary, head)
            vocabulary.forget()
            assert len(vocabulary) == len(head.words)
            assert sorted(crc.tolist()) == want


def test_joined_crc_and_nibbles():
    pick = np.random.default_rng(3)
    for length in (0, 1, 5, 64):
        a, b = pick.bytes(37), pick.bytes(length)
        crc = importance.joined_crc(*(np.array([zlib.crc32(x)], np.uint32) for x in (a, b)), np.array([length]))
        assert crc[0] == zlib.crc32(a + b)
    state = 0xFFFFFFFF
    for byte in "Überfluß".encode():
        for half in (byte & 15, byte >> 4):
            state = (state >> 4) ^ NIBBLES[(state ^ half) & 15]
    assert state ^ 0xFFFFFFFF == zlib.crc32("Überfluß".encode())


def test_draw_where_a_third_of_the_rows_have_no_id(spark):
    rows = [(k if k % 3 else None, prose(k % 7, 60)) for k in range(600)]
    goal = spark.createDataFrame([(1, prose(3))], "item_id long, text string")
    found = importance.resample(documents(spark, rows), goal, percent=50)
    assert sorted_rows(found, *DRAW[:5]) == sorted((r[:5] for r in expected_draw(rows, [prose(3)], 50)), key=repr)
    assert sorted(r["rank"] for r in found.where("rank is not null").collect()) == list(range(1, 301))


# Filter audit.
def masks(rows):
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(BLANK, text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            doc_id is not None and doc_id > first[text],
        ]
        out.append((doc_id, {f for f, bad in zip("ABCDE", fails) if bad}))
    return out


def expected_audit(rows, labels, parts):
    good, toxic = ({i for i, *l in labels if l[k] == 1 and i is not None} for k in (0, 1))
    out = {}
    for part in set(parts):
        flagged = [m for m, p in zip(masks(rows), parts) if p == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            gone = set()
            for step, letter in enumerate(order, 1):
                failing = {k for k, (_, fails) in enumerate(flagged) if letter in fails}
                removed = failing - gone
                ids = [flagged[k][0] for k in removed]
                alone = sum(fails == {letter} for _, fails in flagged)
                out[part, "".join(order), step] = [
                    len(flagged) - len(gone | failing), len(removed), len(failing & gone), alone,
                    sum(i in good for i in ids), sum(i in toxic for i in ids),
                ]
                removed_by[letter] += len(removed)
                gone |= failing
        for (p, order, step), values in out.items():
            if p == part:
                values.append(removed_by[order[step - 1]])
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDITED = odd_rows() + MORE + [(50, "A" * 30), (51, "A" * 30), (52, prose(60, 300) + " #"), (49, prose(60, 300) + " #"), (None, "A" * 30)]


def test_audit_against_brute_force(spark):
    labels = [(50, 1, 0), (51, 1, 1), (51, 0, None), (52, None, 1), (3, 1, 1), (None, 1, 1), (999, 1, 1), (13, 0, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, AUDITED).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x").when(F.col("doc_id") % 3 == 0, ""))
    parts = ["x" if i is not None and i % 2 == 0 else "" for i, _ in AUDITED]
    assert sorted_rows(filter_audit.audit(docs, known), *AUDIT) == expected_audit(AUDITED, labels, parts)


def test_audit_of_an_empty_table(spark):
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_documents(spark), known).count() == 0
    assert filter_audit.audit(documents(spark), known).where("good_lost + toxic_lost > 0").count() == 0


def test_sketch_clears_unique_texts_only(spark):
    """Half of the texts are copies, a third of all rows are one text: no copy is cleared, few others stay."""
    texts = ["same"] * 1000 + [f"pair {k}" for k in range(500)] * 2 + [f"single {k}" for k in range(1000)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    hashed = docs.withColumn("digest", filter_audit.digest_of(F.col("text")))
    for counters, most in ((1 << 15, 300), (1 << 17, 10)):
        bits = filter_audit.counting_filter(hashed, counters)
        test = filter_audit.possible_repeat(spark, bits, counters)
        possible = hashed.where(test("digest"))
        assert possible.where("text not like 'single%'").count() == 2000
        assert possible.where("text like 'single%'").count() <= most


def test_colliding_digests_are_told_apart_by_text(spark):
    rows = [(1, "a", b"x" * 16), (2, "b", b"x" * 16), (3, "a", b"x" * 16)]
    firsts = filter_audit.first_copies(spark.createDataFrame(rows, "doc_id long, text string, digest binary"))
    assert sorted_rows(firsts, "doc_id") == [(1,), (2,)]
