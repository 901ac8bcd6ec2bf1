"""What one task holds and how often rows are shuffled does not grow with the tables."""

import re

from pyspark.sql import functions as F

from tests.compare import rows_of, values
from wardline.clock import Clock
from wardline.operators import daily, retention, substring_index
from wardline.plans import catalog
from wardline.session import TASK_BYTES, TASK_SIZE, tune
from wardline.sources import colocated
from wardline.sources.shapes import Tables
from wardline.sources.sinks import merge_partitions, write_partitioned
from wardline.streaming import broker
from wardline.workspace import run_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, run):
    """Jobs that a call starts, counted by their group."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_task_reads_no_more_than_its_size(spark):
    before = spark.conf.get(TASK_SIZE)
    try:
        spark.conf.set(TASK_SIZE, "64m")
        tune(spark)
        assert spark.conf.get(TASK_SIZE) == str(TASK_BYTES)
        spark.conf.set(TASK_SIZE, "8m")
        assert tune(spark).conf.get(TASK_SIZE) == "8m"
    finally:
        spark.conf.set(TASK_SIZE, before)


def test_bitmaps_are_made_from_single_ids(spark):
    """Rows are folded to distinct ids before bitmaps are made, and no bitmap is shuffled while they are."""
    facts = spark.range(1000).select((F.col("id") % 9).alias("visit"), (F.col("id") % 4).alias("day"))
    text = plan(daily.daily_bitmaps(facts, F.col("day"), [], {"Visits": F.col("visit")}))
    above = text[: text.index("bitmap_construct_agg(_id") if "bitmap_construct_agg(_id" in text else text.rindex("partial_bitmap_construct_agg")]
    assert "Exchange" not in above


def test_merged_bitmaps_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(daily, "BITMAPS_PER_TASK", 10)
    facts = spark.range(3000).select("id", (F.col("id") % 40).alias("day"))
    made = daily.daily_bitmaps(facts, F.col("day"), [], {"Visits": F.col("id")})
    merged = daily.distinct_counts(made, [], ["Visits"])
    text = plan(merged)
    assert re.search(r"hashpartitioning\(Measure#\d+, Piece#\d+L?, 5\), REPARTITION_BY_NUM", text), text
    assert merged.first()["Visits"] == 3000


def test_archive_counts_fold_all_tables_at_once(spark):
    """Null and repeated visits, a table without rows; one row a visit meets the archived ones."""
    encounters = spark.createDataFrame([(k, k, "DISCHARGED") for k in range(4)], "EncounterID long, PatientID long, EncounterStatus string")
    day = F.when(F.col("EncounterID") < 2, F.lit("1990-01-01")).otherwise(F.lit("2001-01-01")).cast("timestamp_ntz")
    encounters = encounters.withColumns({"AdmitDate": day, "DischargeDate": day})
    one = lambda ids: spark.createDataFrame([(i,) for i in ids], "EncounterID long")
    counted = retention.archive_counts(encounters, {"a": one([0, 0, 1, 2, None, 9]), "b": one([3]), "none": one([])}, Clock.at("2001-07-20"), 36)
    assert values(counted, "TableName", "Side", "Rows") == [
        ("a", "kept", 3), ("a", "moved", 3), ("b", "kept", 1), ("b", "moved", 0), ("none", "kept", 0), ("none", "moved", 0),
    ]
    wide = retention.archive_counts(encounters, {str(k): one([k]) for k in range(8)}, Clock.at("2001-07-20"), 36)
    assert len(re.findall(r"HashAggregate\(keys=\[EncounterID", plan(wide))) <= 9


def test_rows_are_dealt_before_their_grams(spark, monkeypatch):
    """One file of one part is indexed by several tasks; repeated and null keys and texts as before."""
    rows = spark.createDataFrame([(1, "abcd"), (1, "abcd"), (None, "abx"), (2, None), (3, "ABC")], "id long, text string").coalesce(1)
    monkeypatch.setattr(substring_index, "ROWS_PER_TASK", 2)
    dealt = []
    kept = type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda df, n, *cols: (dealt.append(n), kept(df, n, *cols))[1])
    index = substring_index.build(rows, "id", ["text"])
    assert dealt == [3]
    assert values(index.postings.where("_gram = 'ab'"), "_key") == [(1,), (3,), (None,)]
    assert index.postings.where("_gram = 'abc'").count() == 2


def test_heavy_keys_are_looked_for_in_one_pass(spark):
    even = spark.range(1000).select((F.col("id") % 500).alias("k"))
    assert jobs(spark, lambda: colocated.heavy_keys({"even": even}, "k", 8)) <= 3
    hot = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 4 == 1, F.col("id")).alias("k"))
    assert colocated.heavy_keys({"hot": hot, "even": even, "none": even.limit(0)}, "k", 8) == [7]


def test_lines_are_joined_once(spark, folder):
    t = Tables(spark, folder)
    joined = t.joined()
    assert t.joined() is joined
    for name in ("orders", "billing_charges", "radiology_studies"):
        assert "Join" not in plan(joined[name])
        assert rows_of(joined[name]) == rows_of(t[name])
    assert "Join" in plan(t["orders"])


def test_only_columns_of_named_tables_are_joined(spark, folder):
    t = Tables(spark, folder)
    narrow = t.joined("billing_charges")
    assert t.joined("billing_charges") is narrow
    held = spark.read.parquet(narrow._lines).columns
    assert "l_quantity" in held and "l_tax" not in held and "o_orderkey" not in held
    assert rows_of(narrow["billing_charges"]) == rows_of(t["billing_charges"])
    whole = t.joined()
    assert whole is not narrow and t.joined("payments") is whole


def test_rows_of_a_merge_cross_one_shuffle(spark):
    path = run_dir(spark, "merged")
    table = spark.range(40).select("id", (F.col("id") % 3).cast("int").alias("Year"), F.lit("a").alias("state"))
    write_partitioned(table, path, ["Year"])
    change = lambda ids: spark.createDataFrame([(i, i % 3, "b") for i in ids], "id long, Year int, state string")
    merge_partitions(spark, path, ["id"], ["Year"], change([1, 2, 50]), change([2, 3, 3, 60]).drop("state"))
    found = {r["id"]: r["state"] for r in spark.read.parquet(path).collect()}
    assert found == {i: "b" if i in (1, 50) else "a" for i in [*range(40), 50] if i not in (2, 3)}


def test_neighbouring_visits_are_marked_together(spark, tmp_path):
    """Visits below zero, at the borders of an entry, twice in a batch and again in a later one."""
    path, seen = str(tmp_path / "in"), {}
    batches = [[-1, 0, 1023, 1023, None], [1023, 1024, -1, 5], [0, 5, 6]]
    for ids in batches:
        spark.createDataFrame([("h", 1, i) for i in ids], broker.DISCHARGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        keep = lambda df, n: seen.setdefault(len(seen), {r["EncounterID"]: r["again"] for r in df.collect()})
        stream = spark.readStream.schema(broker.DISCHARGE_SCHEMA).parquet(path)
        query = broker.mark_visits(stream).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert [s for s in seen.values() if s] == [
        {-1: False, 0: False, 1023: False}, {1023: True, 1024: False, -1: True, 5: False}, {0: True, 5: True, 6: False},
    ]


def test_jobs_read_stored_charges_with_the_columns_of_the_table(spark, folder):
    left = catalog.QUERIES["charges_after_billing_and_purge"](spark, folder)
    assert left.columns == Tables(spark, folder)["billing_charges"].columns


def test_buckets_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(colocated, "ROWS_PER_BUCKET", 100)
    rows = spark.range(1000).select((F.col("id") % 400).alias("k"), "id")
    stored = colocated.store({"rows": rows, "few": rows.limit(5)}, "k", 4, "follow")
    assert stored.buckets == 10
    assert rows_of(stored.per_key(lambda f: f["rows"])) == rows_of(rows)
    assert colocated.store({"few": rows.limit(5)}, "k", 4, "few").buckets == 4
