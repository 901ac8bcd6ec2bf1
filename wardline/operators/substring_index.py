"""Substring search through an inverted index of character grams.

Every text is posted under its grams of up to three characters, in lower case. A pattern of three characters or more
can only be inside texts that hold all of its grams, so it meets the posting lists of its rarest grams and the few
texts in all of them are compared. A shorter pattern is a gram itself. Nothing is scanned, and no text meets a
pattern it shares no gram with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.clinical_reports import c
from wardline.workspace import run_dir

#: Length of the longest grams.
SIZE = 3
#: Posting lists that a pattern meets.
RAREST = 2
#: Rows whose grams one task makes.
ROWS_PER_TASK = 25_000


def grams(text: Column, size: int = SIZE) -> Column:
    """Distinct grams of every length up to ``size`` of a text in lower case, the empty one included."""
    low = F.lower(text)

    def of_length(n: int) -> Column:
        starts = F.when(F.length(low) >= n, F.sequence(F.lit(1), F.length(low) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.substring(low, at, F.lit(n)))

    return F.array_distinct(F.concat(F.array(F.lit("")), *[of_length(n) for n in range(1, size + 1)]))


@dataclass(frozen=True)
class Index:
    """Stored postings ``_gram, _key`` in order of the grams, and how many keys each gram has."""

    postings: DataFrame
    sizes: DataFrame


def build(rows: DataFrame, key: str, texts: list[str]) -> Index:
    """Index the texts of every row under its key; a key is found by any of its texts. Null texts hold nothing.

    Postings are written in ranges of grams, sorted, so that looking up a gram reads the row groups that can hold it.
    A row gives many postings, so the rows are dealt out by their number first: a small file is one task otherwise.
    """
    spark = rows.sparkSession
    read = rows.select(*dict.fromkeys([key, *texts]))
    rows = read.repartition(max(1, -(-read.count() // ROWS_PER_TASK)))
    held = F.array_distinct(F.flatten(F.array(*[F.coalesce(grams(c(n)), F.array().cast("array<string>")) for n in texts])))
    posted = rows.select(F.explode(held).alias("_gram"), c(key).alias("_key")).distinct()
    path = run_dir(spark, "grams")
    # The key is in the order too: a gram that most texts hold goes on over several ranges.
    posted.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_gram", "_key").sortWithinPartitions("_gram", "_key").write.parquet(path)
    postings = spark.read.schema(posted.schema).parquet(path)
    sizes = run_dir(spark, "gram-sizes")
    counted = postings.groupBy("_gram").agg(F.count("*").alias("_keys"))
    counted.sort("_gram").write.parquet(sizes)
    return Index(postings, spark.read.schema(counted.schema).parquet(sizes))


def _own_grams(pattern: Column) -> Column:
    """The grams a pattern is looked up by: those of full length, or the pattern itself."""
    low = F.lower(pattern)
    return F.when(F.length(low) < SIZE, F.array(low)).otherwise(F.filter(grams(low), lambda g: F.length(g) == SIZE))


def candidates(patterns: DataFrame, pattern: str, index: Index) -> DataFrame:
    """``pattern, _key`` of the texts in the posting lists of each pattern's rarest grams; one row per distinct pattern."""
    looked_up = patterns.select(pattern).where(c(pattern).isNotNull()).distinct()
    wanted = looked_up.withColumn("_gram", F.explode(_own_grams(c(pattern)))).join(index.sizes, "_gram", "left")
    rarest = (
        wanted.groupBy(pattern)
        .agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("_keys", F.lit(0)).alias("n"), "_gram"))), 1, RAREST).alias("_rare"))
        # A gram that no text has: the pattern is nowhere.
        .where(c("_rare")[0]["n"] > 0)
        .select(pattern, F.size("_rare").alias("_of"), F.explode("_rare._gram").alias("_gram"))
    )
    met = rarest.join(index.postings, "_gram").groupBy(pattern, "_key", "_of").agg(F.count("*").alias("_in"))
    return met.where(c("_in") == c("_of")).select(pattern, "_key")


def containing(patterns: DataFrame, pattern: str, texts: DataFrame, text: str, index: Index | None = None) -> DataFrame:
    """``pattern, text`` of every distinct pattern inside every distinct text, whatever the case of their letters."""
    distinct = texts.select(text).where(c(text).isNotNull()).distinct()
    found = candidates(patterns, pattern, index or build(distinct, text, [text])).withColumnRenamed("_key", text)
    return found.where(F.contains(F.lower(c(text)), F.lower(c(pattern))))


def search(spark: SparkSession, rows: DataFrame, key: str, texts: list[str], needle: str, index: Index) -> DataFrame:
    """Rows with the needle in one of the texts, whatever the case: those of its rarest posting lists, compared."""
    low = needle.lower()
    own = [low] if len(low) < SIZE else sorted({low[k : k + SIZE] for k in range(len(low) - SIZE + 1)})
    # One row for each gram of the needle at most.
    sizes = {r["_gram"]: r["_keys"] for r in index.sizes.where(c("_gram").isin(own)).collect()}
    if len(sizes) < len(own):
        return rows.limit(0)
    rare = sorted(own, key=lambda g: (sizes[g], g))[:RAREST]
    lists = index.postings.where(c("_gram").isin(rare))
    keys = lists.groupBy("_key").agg(F.count("*").alias("_in")).where(c("_in") == len(rare)).select(c("_key").alias(key))
    hit = F.lit(False)
    for name in texts:
        hit = hit | F.coalesce(F.contains(F.lower(c(name)), F.lit(low)), F.lit(False))
    return rows.join(keys, key, "left_semi").where(hit)


def drug_allergy_matches(medications: DataFrame, allergies: DataFrame) -> DataFrame:
    """``PatientID, DrugName, Allergen``: drugs whose name holds one of the patient's active drug allergens.

    Which allergen is in which drug name is found once for all patients through the index; patients then meet these
    pairs by equality alone, so nobody's drugs are paired with all of their allergens.
    """
    live = allergies.where((c("AllergyType") == "DRUG") & (c("AllergyStatus") == "ACTIVE"))
    allergens = live.select("PatientID", F.lower("AllergenName").alias("Allergen")).distinct()
    drugs = medications.select("PatientID", "DrugName").distinct()
    pairs = containing(allergens, "Allergen", drugs, "DrugName")
    return allergens.join(pairs, "Allergen").join(drugs, ["PatientID", "DrugName"]).select("PatientID", "DrugName", "Allergen")
