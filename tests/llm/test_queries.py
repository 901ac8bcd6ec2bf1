"""Registered corpus queries: reference SQL, contracts, and the pipeline against a brute-force version."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of, rows_of_duck
from tests.llm import test_relational_operators as brute
from tests.llm.fixtures import documents, no_documents, odd_rows
from wardline.llm import queries, toxicity


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_reference_sql(spark, duck, folder, name):
    assert rows_of(queries.QUERIES[name](spark, folder)) == rows_of_duck(duck, queries.ORACLE[name])


@pytest.mark.parametrize("name", ["op1_toxicity", "op7_language_id"])
def test_models_learn_without_the_held_out_rows(spark, folder, name):
    found = queries.QUERIES[name](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found.count() == docs.count()
    assert found.where("held_out != (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0) or score < 0 or score > 1").count() == 0


def test_lines_query_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.where("length(text) < 4000").collect()]
    from wardline.llm import line_dedup

    found = line_dedup.remove_lines(documents(spark, rows))
    got = sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["kept"]) for r in found.collect()), key=repr)
    assert got == brute.expected_lines(rows, 5, 3, 80)


def items(spark, folder):
    return [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


def is_contaminated(text, grams):
    words = re.findall(brute.ALNUM, (text or "").translate(brute.LOWER))
    return any(tuple(words[k : k + n]) in seen for n, seen in grams.items() for k in range(len(words) - n + 1))


def windows_of(tests):
    grams = {}
    for _, text in tests:
        words = re.findall(brute.ALNUM, (text or "").translate(brute.LOWER))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            grams.setdefault(n, set()).add(tuple(words[k : k + n]))
    return grams


def check_stages(spark, docs, folder):
    """Each stage of a small table against plain code on the stage's own input."""
    columns = docs.columns
    shown = lambda frame: sorted(map(tuple, frame.select(*columns).collect()), key=repr)
    at = {c: k for k, c in enumerate(columns)}
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    before = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, before, folder)
        assert after.columns == columns
        rows = [tuple(r) for r in before.collect()]
        texts = [(r[at["doc_id"]], r[at["text"]]) for r in rows]
        if name == "toxicity":
            scores = toxicity.score(before.where("doc_id is not null").dropDuplicates(["doc_id"]), model).collect()
            bad = {r["doc_id"] for r in scores if r["score"] >= 0.5}
            expected = [r for r in rows if r[at["doc_id"]] not in bad]
        elif name == "line_dedup":
            kept = brute.expected_lines(texts, 5, 3, 80)
            got = sorted(((r["doc_id"], r["text"]) for r in after.collect()), key=repr)
            assert got == sorted(((k[0], k[3]) for k in kept), key=repr)
            expected = None
        elif name == "ngram_jaccard":
            groups = brute.expected_jaccard(texts, 5, 8, 10)
            stay = [k[0] for k in groups if k[0] == k[2] or k[1] == 0]
            got = [r["doc_id"] for r in after.collect()]
            assert {i for i in got if i is not None} == {i for i in stay if i is not None}
            expected = None
        else:
            grams = windows_of(items(spark, folder))
            expected = [r for r in rows if not is_contaminated(r[at["text"]], grams)]
        if expected is not None:
            assert shown(after) == sorted(expected, key=repr)
        before = spark.createDataFrame([tuple(r) for r in after.collect()], before.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert last.count() == before.count()
    return last


def test_pipeline_on_the_test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    small = docs.where("length(text) < 3000")
    last = check_stages(spark, small, folder)
    assert 0 < last.count() < small.count()


def test_pipeline_on_odd_rows(spark, folder):
    rows = [r for r in odd_rows() if r[0] not in (11, 12, 20)]
    check_stages(spark, documents(spark, rows).withColumn("n_chars", F.length("text").cast("long")), folder)


def test_stages_of_an_empty_table(spark, folder):
    docs = no_documents(spark)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, folder).count() == 0


def test_run_chains_the_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids"] and found.count() > 0
