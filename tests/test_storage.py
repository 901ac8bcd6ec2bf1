"""Co-located facts, stored profiles and differences by key range."""

import random
import re
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of, values
from wardline.operators import billing, profiles, quality
from wardline.operators import management_reports as management
from wardline.plans import catalog
from wardline.sources import colocated
from wardline.sources.shapes import Tables
from wardline.sources.sinks import write_partitioned
from wardline.workspace import exists, run_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(text, scan):
    """Whether an exchange lies between a scan and the join or aggregate that reads it first."""
    found = []
    lines = text.split("\n")
    for at, line in enumerate(lines):
        if scan not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-*()0123456789|"))
        for above in reversed(lines[:at]):
            name = above.lstrip(" :+-*()0123456789|")
            higher = len(above) - len(name)
            if higher >= depth:
                continue
            depth = higher
            if name.startswith(("Exchange", "SortMergeJoin", "HashAggregate", "SortAggregate")):
                found.append(name.split(" ")[0].split("(")[0])
                break
    return found


@pytest.fixture
def shuffled(spark):
    """Joins as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_are_not_exchanged(spark, folder, shuffled):
    t = Tables(spark, folder)
    visits = catalog._visit_facts(t)
    assert visits.heavy is None
    reconciled = plan(visits.per_key(lambda f: billing.reconcile_encounters(f["encounters"], f["billing_charges"], f["payments"], catalog.CLOCK)))
    assert "Exchange" not in reconciled and reconciled.count("Bucketed: true") == 3
    posted = plan(
        visits.per_key(
            lambda f: billing.post_encounter_charges(
                f["procedures"], f["encounters"], t["chargemaster"], f["billing_charges"], t["departments"], t["physicians"], f["diagnoses"], catalog.CLOCK
            )["charges"]
        )
    )
    for fact in ("procedures", "billing_charges", "encounters", "diagnoses"):
        used = below(posted, f"_{fact}[")
        assert used and "Exchange" not in used, (fact, used)


def test_patient_facts_are_folded_where_they_lie(spark, folder, shuffled):
    t = Tables(spark, folder)
    names = ("patients", "encounters", "billing_charges", "payments", "insurance_claims", "invoices", "collections")
    stored = colocated.store({n: t[n] for n in names}, "PatientID", 8, "patients")
    text = plan(
        stored.per_key(
            lambda f: management.patient_financial_summary(
                f["patients"], t["insurers"], f["encounters"], f["billing_charges"], f["payments"], f["insurance_claims"], f["invoices"], f["collections"]
            )
        )
    )
    assert not re.search(r"Exchange[^\n]*\n[^\n]*HashAggregate", text)
    assert text.count("Bucketed: true") == 6


def test_heavy_keys_are_kept_apart(spark):
    """A visit with a third of all charges: its rows are in no bucket, the sums are the same."""
    pick = random.Random(4)
    ids = [7] * 1000 + [pick.randrange(500) for _ in range(2000)] + [None] * 5
    charges = spark.createDataFrame([(k, i, k % 13) for k, i in enumerate(ids)], "ChargeID long, EncounterID long, amount long")
    visits = spark.createDataFrame([(i, f"v{i}") for i in range(500)], "EncounterID long, name string")
    stored = colocated.store({"charges": charges, "visits": visits}, "EncounterID", 8, "heavy")
    assert stored.heavy["charges"].count() == ids.count(7) and stored.heavy["visits"].count() == 1
    join = lambda f: f["visits"].join(f["charges"].groupBy("EncounterID").agg(F.sum("amount").alias("total")), "EncounterID", "left")
    assert rows_of(stored.per_key(join)) == rows_of(join({"charges": charges, "visits": visits}))
    folders = list(stored.stored.values())
    colocated.forget(spark, stored)
    assert not any(exists(spark, f) for f in folders)


# Profiles.
def numbers(spark, count, first_day=1, days=4):
    return spark.range(count).select(
        F.format_string("2001-07-%02d", (F.col("id") % days + first_day)).alias("day"),
        F.col("id").alias("id"),
        (F.col("id") % 1000).cast("int").alias("thousand"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("t"), (F.col("id") % 7).cast("string"))).alias("text"),
        ((F.col("id") % 50) / 4).cast("decimal(8,2)").alias("price"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("when"),
        F.lit(None).cast("double").alias("empty"),
    )


def test_profile_of_stored_sketches(spark):
    path, store = run_dir(spark, "table"), run_dir(spark, "sketches")
    write_partitioned(numbers(spark, 40_000), path, ["day"])
    table = spark.read.parquet(path)
    assert len(profiles.refresh(spark, table, ["day"], store)) == 4
    found = {r["ColumnName"]: r for r in profiles.stored_profile(spark, table, ["day"], store, "numbers").collect()}
    exact = {r["ColumnName"]: r for r in quality.profile_table(table.drop("day"), "numbers", exact=True).collect()}
    assert set(found) == set(exact) and len(found) == 6
    for name, row in found.items():
        for column in ("Rows", "Nulls", "MinValue", "MaxValue"):
            assert row[column] == exact[name][column], (name, column)
        assert abs(row["DistinctValues"] - exact[name]["DistinctValues"]) <= 0.05 * exact[name]["DistinctValues"]
    assert abs(found["id"]["Quartiles"][1] - 20_000) < 800 and found["text"]["Quartiles"] is None and found["empty"]["Quartiles"] is None


def test_tables_are_profiled_side_by_side(spark, folder, monkeypatch):
    all_there, single = Barrier(len(catalog.SKETCHED)), catalog._partitioned

    def waiting(t, rows):
        all_there.wait(60)
        return single(t, rows)

    monkeypatch.setattr(catalog, "_partitioned", waiting)
    found = catalog.QUERIES["table_profile_from_sketches"](spark, folder)
    assert {r["TableName"] for r in found.select("TableName").distinct().collect()} == set(catalog.SKETCHED)


def test_only_new_partitions_are_read(spark):
    path, store = run_dir(spark, "table"), run_dir(spark, "sketches")
    write_partitioned(numbers(spark, 4000), path, ["day"])
    profiles.refresh(spark, spark.read.parquet(path), ["day"], store)
    assert profiles.refresh(spark, spark.read.parquet(path), ["day"], store) == []
    write_partitioned(numbers(spark, 1000, first_day=20, days=1), path, ["day"], mode="append")
    # An old partition that cannot be read any more does not matter.
    old = [f for f in spark.read.parquet(path).inputFiles() if "day=2001-07-02" in f]
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    for file in old:
        target = spark._jvm.org.apache.hadoop.fs.Path(file)
        system.delete(target, False)
        stream = system.create(target)
        stream.write(bytearray(b"no table any more"))
        stream.close()
    table = spark.read.schema(numbers(spark, 1).schema).parquet(path)
    assert profiles.refresh(spark, table, ["day"], store) == [("2001-07-20",)]
    found = profiles.stored_profile(spark, table, ["day"], store, "numbers").where("ColumnName = 'id'").first()
    assert found["Rows"] == 5000
    # A rewritten partition is sketched again.
    assert profiles.resketch(table, ["day"], store, [("2001-07-20",)]) and spark.read.parquet(store).count() == 5


def test_profile_of_an_empty_table(spark):
    none = numbers(spark, 0)
    sketches = profiles.sketch_partitions(none, ["day"])
    assert profiles.merged_profile(sketches, profiles.profiled(none, ["day"]), "none").count() == 0


# Differences by range.
DIFF = ["RecordID", "Action", "OldValues", "NewValues"]
SNAPSHOT = "id long, a long, b string"


def both_ways(spark, old, new, key="id", schema=SNAPSHOT, width=64):
    left, right = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    by_range = quality.snapshot_diff_by_range(left, right, key, "t", catalog.CLOCK, width=width)
    assert values(by_range, *DIFF) == values(quality.snapshot_diff(left, right, key, "t", catalog.CLOCK), *DIFF)
    return by_range


def test_random_changes(spark):
    pick = random.Random(8)
    old = [(k, k % 5, None if k % 11 == 0 else f"x{k % 3}") for k in range(3000)]
    new = [(k, a + (pick.random() < 0.01), b) for k, a, b in old if pick.random() > 0.01] + [(5000 + k, 1, "new") for k in range(9)]
    new += [(None, 1, "no key")]
    assert both_ways(spark, old, new).count() > 30
    texts = "id string, a long, b string"
    both_ways(spark, [(f"k{k}", a, b) for k, a, b in old], [(f"k{k}" if k else None, a, b) for k, a, b in new], schema=texts)
    both_ways(spark, [], new)
    both_ways(spark, old, old)


def test_sums_do_not_hide_a_change(spark):
    """Values exchanged between rows, between columns, and nulls moved leave naive sums as they are."""
    swapped = both_ways(spark, [(1, 10, "a"), (2, 20, "b")], [(1, 20, "a"), (2, 10, "b")])
    assert swapped.count() == 2
    schema = "id long, a string, b string"
    assert both_ways(spark, [(1, "x", None), (2, None, "x")], [(1, None, "x"), (2, "x", None)], schema=schema).count() == 2
    # Rows that come twice cancel out in an exclusive or, but not in the sum and the count.
    a, b = (quality.range_digests(spark.createDataFrame(r, SNAPSHOT), "id", ["id", "a", "b"], 64) for r in ([(1, 1, "a")] * 2, [(2, 2, "b")] * 2))
    assert a.first()["_mix"] == b.first()["_mix"] == 0 and quality.changed_ranges(a, b).count() == 1


def test_the_join_gets_changed_ranges_only(spark):
    old = spark.range(100_000).select("id", (F.col("id") % 7).alias("a"), F.lit("x").alias("b"))
    new = old.withColumn("a", F.when(F.col("id").isin(5, 50_000), -1).otherwise(F.col("a")))
    columns = ["id", "a", "b"]
    changed = quality.changed_ranges(*(quality.range_digests(df, "id", columns, 1024) for df in (old, new)))
    assert values(changed, "_range") == [(0,), (48,)]
    kept = quality.range_digests(old, "id", columns, 1024)
    found = quality.snapshot_diff_by_range(old, new, "id", "t", catalog.CLOCK, old_digests=kept)
    assert values(found, "RecordID", "Action") == [(5, "UPDATE"), (50_000, "UPDATE")]
    met = [df.withColumn("_range", quality.key_range(df, "id", 1024)).join(changed, "_range", "left_semi").count() for df in (old, new)]
    assert met == [2048, 2048]


# Foreign keys.
def test_bitmaps_against_the_join(spark):
    """Keys at the borders of pieces, negative and repeated ones, null keys, and a child key on a third of the rows."""
    pick = random.Random(13)
    held = [0, 1, 7, 8, 32_767, 32_768, 32_769, 65_536, -1, -40_000, None] + [pick.randrange(100_000) for _ in range(3000)]
    used = [2, 32_766, 65_535, -2, 7, None] + [5] * 2000 + [pick.randrange(-50_000, 110_000) for _ in range(4000)]
    tables = {
        "parents": spark.createDataFrame([(k,) for k in held + held[:50]], "id long"),
        "others": spark.createDataFrame([(k,) for k in range(10)], "id int"),
        "children": spark.createDataFrame([(k, None if k is None else k % 12) for k in used], "parent long, other long"),
    }
    references = [("children", "parent", "parents", "id"), ("children", "other", "others", "id")]
    found = quality.orphans_by_bitmap(tables, references)
    assert values(found, "Reference", "Key", "Rows") == values(quality.all_orphans(tables, references), "Reference", "Key", "Rows")
    assert found.where("Reference = 'children.other'").count() == 2
