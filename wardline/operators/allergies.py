"""Matching drugs against a patient's recorded drug allergies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.dialect import ci_contains


def active_allergens(allergies: DataFrame) -> DataFrame:
    """One row per patient and allergen text, with how many records it stands for.

    Collapsing repeats first bounds the match below by the size of the drug
    vocabulary, however many allergy rows one patient has.
    """
    live = allergies.filter((F.col("AllergyType") == "DRUG") & (F.col("AllergyStatus") == "ACTIVE"))
    first = F.min(F.struct("AllergyID", "AllergenName", "Severity", "Reaction"))
    return live.groupBy("PatientID", F.lower("AllergenName").alias("_allergen")).agg(
        F.count("*").alias("_records"), first.alias("_first")
    )


def matching_allergens(drugs: DataFrame, allergies: DataFrame, names: list[str]) -> DataFrame:
    """(patient, drug names) rows with each allergen contained in one of the names."""
    wanted = drugs.select("PatientID", *names).distinct().alias("d")
    allergens = active_allergens(allergies).alias("a")
    hit = F.lit(False)
    for name in names:
        hit = hit | F.coalesce(ci_contains(F.col(f"d.{name}"), F.col("a._allergen")), F.lit(False))
    same = (F.col("d.PatientID") == F.col("a.PatientID")) & hit
    return wanted.join(allergens, same).select("d.*", "a._records", "a._first")


def flag_conflicts(meds: DataFrame, allergies: DataFrame, out: str) -> DataFrame:
    """Add 1 where the drug name contains one of the patient's active drug allergens, else 0."""
    conflicts = matching_allergens(meds, allergies, ["DrugName"]).select("PatientID", "DrugName").distinct()
    marked = conflicts.withColumn(out, F.lit(1))
    return meds.join(marked, ["PatientID", "DrugName"], "left").withColumn(out, F.coalesce(out, F.lit(0)))
