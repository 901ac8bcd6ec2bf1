"""Substring search through the gram index equals the scan."""

import random

import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of, values
from wardline.operators import substring_index
from wardline.workspace import exists, released, stage

PICK = random.Random(12)
TEXTS = ["".join(PICK.choice("abAB é-") for _ in range(PICK.randrange(0, 14))) for _ in range(300)] + [None, "", "ab", "xyz" * 30]


def test_containment_against_every_pair(spark):
    patterns = [t[k : k + PICK.randrange(0, 6)] for t in TEXTS[:120] if t for k in [PICK.randrange(len(t))]] + [None, "", "A", "zx", "nowhere", "yzx"]
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    found = substring_index.containing(spark.createDataFrame([(p,) for p in patterns], "pattern string"), "pattern", texts, "text")
    want = {(p, t) for p in patterns for t in TEXTS if p is not None and t is not None and p.lower() in t.lower()}
    got = [tuple(r) for r in found.select("pattern", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("needle", ["", "a", "É", "aB", "ab-", "bab", "zxyzx", "none of it"])
def test_search_equals_the_scan(spark, needle):
    rows = [(k, TEXTS[k], TEXTS[-1 - k]) for k in range(200)]
    frame = spark.createDataFrame(rows, "id long, one string, two string")
    index = substring_index.build(frame, "id", ["one", "two"])
    found = substring_index.search(spark, frame, "id", ["one", "two"], needle, index)
    assert values(found, "id") == sorted([(k,) for k, *ts in rows if any(t is not None and needle.lower() in t.lower() for t in ts)], key=repr)


def test_a_lookup_reads_its_own_grams(spark):
    frame = spark.range(5000).select("id", F.concat(F.lit("patient "), F.hex("id")).alias("name"))
    index = substring_index.build(frame, "id", ["name"])
    plan = index.postings.where(F.col("_gram").isin(["12f"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(_gram,12f)" in plan
    assert substring_index.search(spark, frame, "id", ["name"], "t 12F", index).count() == 17


def test_patients_do_not_pair_drugs_with_allergens(spark):
    """One patient with 2,000 drugs and 1,500 allergens: pairs are made of distinct names that share rare grams."""
    drugs = spark.range(2000).select(F.lit(1).alias("PatientID"), F.concat(F.lit("drug"), F.format_string("%05d", "id")).alias("DrugName"))
    allergies = spark.range(1500).select(
        F.lit(1).alias("PatientID"), F.lit("DRUG").alias("AllergyType"), F.lit("ACTIVE").alias("AllergyStatus"),
        F.concat(F.lit("UG"), F.format_string("%05d", F.col("id") * 2)).alias("AllergenName"),
    )
    found = substring_index.drug_allergy_matches(drugs, allergies)
    assert found.count() == 1000
    index = substring_index.build(drugs.select("DrugName"), "DrugName", ["DrugName"])
    met = substring_index.candidates(allergies.select(F.lower("AllergenName").alias("a")), "a", index).count()
    assert met < 1500 * 2000 / 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_what_is_staged_in_a_block_goes_with_it(spark):
    with released():
        kept = stage(spark.range(3), "inside")
        rows = rows_of(kept)
        assert exists(spark, kept.staged_at) and len(rows[1]) == 3
    assert not exists(spark, kept.staged_at)
    outside = stage(spark.range(2), "outside")
    assert exists(spark, outside.staged_at)
