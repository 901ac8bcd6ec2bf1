"""Whole numbers that are folded 64 neighbours to a row: profiles, unique keys and references."""

from collections import Counter

from pyspark.sql import functions as F

from wardline.operators import quality

VALUES = [None, None, 0, 0, 1, 63, 64, 64, 64, -1, -64, -65, 2**63 - 1, -(2**63), 2**40]


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def test_running_numbers_fold_64_to_a_row(spark):
    df = spark.range(6400).select(F.col("id").alias("a"), F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int") % 64).alias("d"))
    words = {r["ColumnName"]: r for r in quality.distinct_words(df, ["a", "d"]).groupBy("ColumnName").agg(F.count("*").alias("words"), F.sum("DistinctValues").alias("n"), F.sum("Rows").alias("rows")).collect()}
    assert (words["a"]["words"], words["a"]["n"], words["a"]["rows"]) == (100, 6400, 6400)
    assert words["d"]["words"] <= 2 and (words["d"]["n"], words["d"]["rows"]) == (64, 6400)


def test_exact_profile_of_all_types(spark):
    rows = [(v, None if v is None else str(v), float(i % 3), f"{i % 4}.50", i % 2 == 0, f"2001-01-0{1 + i % 5}") for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "k bigint, t string, f double, m string, b boolean, day string").withColumns(
        {"m": F.col("m").cast("decimal(10,2)"), "day": F.col("day").cast("date"), "at": F.col("day").cast("timestamp_ntz"), "none": F.lit(None).cast("string")}
    )
    found = {r["ColumnName"]: r for r in quality.profile_table(df, "x", exact=True).collect()}
    known = [v for v in VALUES if v is not None]
    texts = [str(v) for v in known]
    assert set(found) == set(df.columns)
    assert [found["k"][n] for n in ("Rows", "Nulls", "DistinctValues", "MinValue", "MaxValue")] == [15, 2, 10, str(min(known)), str(max(known))]
    assert [found["t"][n] for n in ("Rows", "Nulls", "DistinctValues", "MinValue", "MaxValue")] == [15, 2, 10, min(texts), max(texts)]
    assert [found[n]["DistinctValues"] for n in ("f", "m", "b", "day", "at", "none")] == [3, 4, 2, 5, 5, 0]
    assert [found["none"][n] for n in ("Rows", "Nulls", "MinValue")] == [15, 15, None]
    empty = quality.profile_table(df.where("false"), "x", exact=True).collect()
    assert {(r["Rows"], r["Nulls"], r["DistinctValues"], r["MinValue"]) for r in empty} == {(0, 0, 0, None)} and len(empty) == len(df.columns)


def test_no_number_is_shuffled_as_text(spark):
    df = spark.range(10).select("id", F.col("id").cast("timestamp").alias("at"), F.col("id").cast("decimal(10,2)").alias("m"))
    plan = quality.distinct_values(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "as string" not in plan
    rules = quality.Rules({}, ("id",), unique=("id", ("id", "m")))
    plan = quality.check_constraints(df, "x", rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan


def test_repeated_keys(spark):
    df = numbers(spark, VALUES).withColumn("t", F.col("k").cast("string"))
    rules = quality.Rules({}, ("k",), unique=("k", "t", ("k", "t")))
    found = {r["ColumnName"]: r["Violations"] for r in quality.check_constraints(df, "x", rules).where("Rule = 'UNIQUE'").collect()}
    assert found == {"k": 3, "t": 3, "k+t": 3}
    none = quality.check_constraints(df.where("k = 1"), "x", rules).where("Rule = 'UNIQUE'").collect()
    assert {r["Violations"] for r in none} == {0} and len(none) == 3


def test_missing_keys_of_number_references(spark):
    parents = [None, 0, 64, -65, 5, 5, 2**40]
    tables = {"c": numbers(spark, VALUES).withColumn("k2", F.col("k").cast("string")), "p": numbers(spark, parents), "d": numbers(spark, [0, 5]),
              "s": spark.createDataFrame([("1",), ("x",)], "k2 string")}
    references = [("c", "k", "p", "k"), ("d", "k", "p", "k"), ("c", "k2", "s", "k2"), ("d", "k", "c", "k")]
    found = {(r["Reference"], r["Key"]): r["Rows"] for r in quality.all_orphans(tables, references).collect()}
    known = [v for v in VALUES if v is not None]
    wanted = {("c.k", str(k)): n for k, n in Counter(v for v in known if v not in parents).items()}
    wanted |= {("c.k2", str(k)): n for k, n in Counter(v for v in known if v != 1).items()}
    wanted[("d.k", "5")] = 1
    assert found == wanted


def test_no_missing_key(spark):
    tables = {"c": numbers(spark, [None, 1, 1]), "p": numbers(spark, [1, 2])}
    found = quality.all_orphans(tables, [("c", "k", "p", "k")])
    assert found.columns == ["Reference", "Key", "Rows"] and found.collect() == []
