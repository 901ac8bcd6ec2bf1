"""The corpus pipeline: documents through five stages, each written and read again by the next.

``run`` applies all stages to the table ``documents``. A stage takes ``(spark, docs, sf_dir)`` and works on
every row its predecessor kept; all but the last return the columns of ``docs``. Null ids and texts,
repeated rows, empty tables and further columns are allowed everywhere. Stages that decide about whole
documents tell rows apart by id and content; rows that agree in both share every decision.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, decontamination, line_dedup, ngram_jaccard, toxicity
from wardline.workspace import stage

#: Documents that score this much or more are toxic.
TOXIC = 0.5
BPE_FILE = "byte_bpe_50k.json"


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identity() -> Column:
    """Id and content of a document, without nulls inside; null ids come last."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
        F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("content"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from the labelled ones among ``docs``."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, carry=docs.columns)
    return scored.where(F.col("score") < TOXIC).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur before, or nearly so, go from the texts; every document stays, an emptied one too. Null texts become empty."""
    others = [c for c in docs.columns if c != "text"]
    found = line_dedup.remove_lines(docs, carry=others)
    values = {c: F.col("row").getField(c) for c in others} | {"text": F.col("kept")}
    if "n_chars" in others:
        changed = F.length("kept").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(F.col("n_removed") > 0, changed).otherwise(values["n_chars"])
    return found.select(*(values[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    key = free_name(docs, "identity")
    keyed = docs.withColumn(key, identity())
    found = ngram_jaccard.near_duplicates(keyed, doc_id=key)
    stay = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    key = free_name(docs, "identity")
    keyed = docs.withColumn(key, identity())
    found = decontamination.find_phrases(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=key)
    hit = found.where(F.size("hits") > 0).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document."""
    encoded = bpe.encode(docs, public_tokenizers.path(BPE_FILE))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: A trained model decides in the first stage, which SQL cannot express; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
