"""Fees by interval, distinct counts from bitmaps, and sums kept per day."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.compare import rows_of, values
from wardline.operators import billing, daily, management_reports
from wardline.plans import catalog
from wardline.sources.shapes import Tables
from wardline.workspace import run_dir

FEES = "ChargeCode string, CPTCode string, RevenueCode string, StandardCharge decimal(10,2), EffectiveDate date, ExpirationDate date, IsActive int"
ROWS = "id long, CPTCode string, at timestamp_ntz"
D0 = date(1999, 1, 1)


def expected_fee(fees, code, day):
    held = [f for f in fees if f[1] == code and code and f[6] == 1 and f[4] <= day and (f[5] is None or f[5] > day)]
    best = max(held, key=lambda f: (f[4], f[0], f[2], f[3]), default=None)
    return (best[0], best[3]) if best else (None, None)


def both(spark, fees, rows, bin_days):
    found = billing.fees_on_date(spark.createDataFrame(rows, ROWS), spark.createDataFrame(fees, FEES), "at", bin_days)
    got = {r["id"]: (r["ChargeCode"], r["StandardCharge"]) for r in found.collect()}
    assert len(got) == len(rows) == found.count()
    assert got == {i: expected_fee(fees, code, at.date()) if at else (None, None) for i, code, at in rows}


def test_fees_against_every_pair(spark):
    """Open ends, gaps, overlaps, equal starts, expiry on the first day, days before and after everything."""
    pick = random.Random(6)
    from decimal import Decimal

    fees = []
    for k in range(300):
        start = D0 + timedelta(days=pick.randrange(900))
        end = pick.choice([None, start, start + timedelta(days=pick.randrange(1, 400))])
        fees.append((f"C{k}", pick.choice(["a", "b", "c", None]), "R", Decimal(k), start, end, pick.choice([1, 1, 1, 0])))
    fees += [("X1", "a", "R", Decimal(1), D0, None, 1), ("X2", "a", "R", Decimal(2), D0, None, 1)]
    at = lambda: datetime.combine(D0, datetime.min.time()) + timedelta(days=pick.randrange(-50, 1400), minutes=pick.randrange(1440))
    rows = [(k, pick.choice(["a", "b", "c", "z", None]), at()) for k in range(1500)] + [(9000, "a", None)]
    for bin_days in (1, 64, 5000):
        both(spark, fees, rows, bin_days)
    both(spark, [], rows[:20], 64)
    both(spark, fees, [(1, "a", None)], 64)


def test_one_code_on_most_rows_is_dealt_by_its_days(spark, folder):
    """No nested loop, an equality join on code and bin; the hot code's rows lie in many bins."""
    rows = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 < 9, "1").otherwise("2").alias("CPTCode"), F.expr("TIMESTAMP_NTZ '1999-02-01 00:00:00' + make_interval(0, 0, 0, cast(id % 900 as int))").alias("at")
    )
    found = billing.fees_on_date(rows, Tables(spark, folder)["chargemaster"], "at")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    bins = rows.withColumn("_bin", F.floor(F.unix_date(F.to_date("at")) / billing.FEE_BIN_DAYS)).groupBy("CPTCode", "_bin").count()
    assert bins.where("CPTCode = '1'").count() >= 14
    assert found.count() == 20_000


# Bitmaps.
def test_counts_from_bitmaps_of_days(spark):
    pick = random.Random(5)
    rows = [(pick.randrange(4), pick.randrange(5), pick.randrange(0, 100_000) if k % 9 else None, pick.randrange(40)) for k in range(4000)]
    rows += [(1, 2, 0, 0), (1, 2, 32_768, 32_767), (2, 2, 32_767, 1)] * 50
    facts = spark.createDataFrame(rows, "day int, side int, visit long, patient long")
    by_day = daily.daily_bitmaps(facts, F.col("day"), ["side"], {"Visits": F.col("visit"), "Patients": F.col("patient")})
    # The same days again, and a part of them a third time, change nothing.
    stored = by_day.unionByName(by_day).unionByName(by_day.where("Day = 1"))
    want = facts.groupBy("side").agg(F.countDistinct("visit").alias("Visits"), F.countDistinct("patient").alias("Patients"))
    assert rows_of(daily.distinct_counts(stored, ["side"], ["Visits", "Patients"])) == rows_of(want)
    none = facts.where("visit < 0")
    assert daily.distinct_counts(daily.daily_bitmaps(none, F.col("day"), ["side"], {"Visits": F.col("visit")}), ["side"], ["Visits"]).count() == 0


def test_a_repeated_id_is_one_bit_per_task(spark):
    """A third of the rows with one id: the shuffle carries a bitmap per task, not the rows."""
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("visit"), F.lit(1).alias("day"))
    made = daily.daily_bitmaps(facts, F.col("day"), [], {"Visits": F.col("visit")})
    assert made.count() == 1
    assert "partial_bitmap_construct_agg" in made._jdf.queryExecution().executedPlan().toString()
    assert daily.distinct_counts(made, [], ["Visits"]).first()["Visits"] == 20_000


# Sums.
def kept(spark, store):
    return spark.read.parquet(store)


def test_loads_add_up_to_the_full_scan(spark, folder):
    t = Tables(spark, folder)
    names = {"charges": "billing_charges", "payments": "payments", "claims": "insurance_claims", "invoices": "invoices", "collections": "collections", "encounters": "encounters"}
    tables = {fact: t[name] for fact, name in names.items()}
    store = run_dir(spark, "daily")
    full = management_reports.revenue_cycle_summary(*[tables[n] for n in ("charges", "payments", "claims", "invoices", "collections", "encounters")], catalog.CLOCK)
    for part in range(5):
        rows = {fact: df.where(F.col(df.columns[0]) % 5 == part) for fact, df in tables.items()}
        daily.add_load(store, f"load-{part}", daily.fold_load(rows))
    assert rows_of(daily.revenue_cycle(kept(spark, store), catalog.CLOCK)) == rows_of(full)
    # A load that is written again replaces itself.
    daily.add_load(store, "load-4", daily.fold_load(rows))
    assert rows_of(daily.revenue_cycle(kept(spark, store), catalog.CLOCK)) == rows_of(full)
    plan = daily.revenue_cycle(kept(spark, store), catalog.CLOCK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and folder not in plan


def test_a_changed_row_moves_its_amount(spark):
    schema = "ClaimID long, CreatedDate timestamp_ntz, ClaimStatus string, TotalCharges decimal(10,2)"
    day = datetime(2001, 7, 1, 9)
    claims = spark.createDataFrame([(1, day, "CREATED", 10), (2, day, "CREATED", 20), (3, None, None, None)], "ClaimID long, CreatedDate timestamp_ntz, ClaimStatus string, TotalCharges int")
    claims = claims.withColumn("TotalCharges", F.col("TotalCharges").cast("decimal(10,2)"))
    store = run_dir(spark, "daily")
    daily.add_load(store, "1", daily.fold_load({"claims": claims}))
    old = claims.where("ClaimID = 1")
    new = spark.createDataFrame([(1, day, "DENIED")], "ClaimID long, CreatedDate timestamp_ntz, ClaimStatus string").withColumn("TotalCharges", F.lit(12).cast("decimal(10,2)"))
    assert new.schema.fieldNames() == [f.split()[0] for f in schema.split(", ")]
    daily.add_load(store, "2", daily.fold_load({"claims": daily.changes(old, new)}))
    got = daily.revenue_cycle(kept(spark, store), catalog.CLOCK).first()
    assert (got["ClaimsPendingSubmission"], got["ClaimsDenied"], float(got["DeniedClaimsValue"])) == (1, 1, 12.0)
    summed = kept(spark, store).groupBy("Status").agg(F.sum("Rows").alias("n")).where("n <> 0")
    assert values(summed, "Status", "n") == sorted([("CREATED", 1), ("DENIED", 1), (None, 1)], key=repr)
