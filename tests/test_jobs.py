"""Batch jobs: invariants and hand rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of, values
from wardline.clock import Clock
from wardline.operators import admissions, billing, quality, retention
from wardline.operators import management_reports as management
from wardline.operators import rows as rows_module
from wardline.plans import catalog
from wardline.plans.nightly import after_run, nightly_billing
from wardline.sources.shapes import Tables
from wardline.sources.sinks import upsert

CLOCK = Clock.at("2001-07-20 10:30:00")


@pytest.fixture(scope="module")
def tables(spark, folder):
    return Tables(spark, folder)


@pytest.fixture(scope="module")
def night(tables):
    inputs = catalog.billing_tables(tables)
    return inputs, nightly_billing(inputs, CLOCK)


def test_second_nightly_run_adds_nothing(night):
    inputs, result = night
    assert result["room_charges"].count() > 0 and result["invoices"].count() > 0
    again = nightly_billing(after_run(inputs, result), CLOCK)
    for name in ("room_charges", "procedure_charges", "claims", "claim_lines", "submitted", "invoices"):
        assert again[name].count() == 0, name


def test_nightly_totals_start_from_the_written_charges(night):
    inputs, result = night
    text = result["totals"]._jdf.queryExecution().optimizedPlan().toString()
    assert "ProcedureStatus" not in text and "StandardCharge" not in text
    again = billing.post_encounter_charges(
        inputs.procedures, inputs.encounters.filter(F.col("EncounterType").isin(*billing.ROOM_CODE)), inputs.chargemaster,
        inputs.charges.unionByName(result["room_charges"], allowMissingColumns=True), inputs.departments, inputs.physicians, inputs.diagnoses, CLOCK,
    )["totals"]
    assert rows_of(result["totals"]) == rows_of(again)


def test_claim_lines_add_up(tables):
    made = billing.create_claims(
        tables["encounters"], tables["patients"], tables["insurers"], tables["insurance_claims"],
        tables["billing_charges"], CLOCK, days_back=3650,
    )
    lines = billing.claim_lines(made["visits"], tables["billing_charges"]).groupBy("ClaimID").agg(
        F.sum("ChargeAmount").alias("s"), F.count("*").alias("n"), F.max("LineNumber").alias("top"), F.countDistinct("LineNumber").alias("d")
    )
    joined = made["claims"].join(lines, "ClaimID", "left")
    assert joined.count() > 50
    assert joined.filter("coalesce(s, 0) <> TotalCharges or n <> top or n <> d").count() == 0
    assert made["claims"].select("ClaimNumber").distinct().count() == joined.count()


def test_claims_of_one_dominant_visit(spark, tables, monkeypatch):
    """One visit holds nearly all charges, many on one instant."""
    monkeypatch.setattr(rows_module.number_rows, "__defaults__", (*rows_module.number_rows.__defaults__[:-1], 100))
    n = 2500
    charges = spark.createDataFrame(
        [(i, 1 if i % 20 else 2, "C", None if i % 7 else "X", datetime(2001, 7, 1 + i % 3), 1, Decimal(5), Decimal(1), "POSTED") for i in range(n)],
        "ChargeID int, EncounterID bigint, ChargeCode string, CPTCode string, ServiceDate timestamp_ntz, Quantity int, ChargeAmount decimal(10,2), AdjustmentAmount decimal(10,2), ChargeStatus string",
    )
    visits = spark.createDataFrame(
        [(e, 10 + e, "DISCHARGED", datetime(2001, 7, 20), None) for e in (1, 2)],
        "EncounterID bigint, PatientID bigint, EncounterStatus string, DischargeDate timestamp_ntz, PreAuthNumber string",
    )
    people = spark.createDataFrame(
        [(11, 1, "P", "G"), (12, 1, "P", "G")],
        "PatientID bigint, PrimaryInsuranceID int, PrimaryPolicyNumber string, PrimaryGroupNumber string",
    )
    claims = spark.createDataFrame([], "ClaimID bigint, ClaimNumber string, EncounterID bigint")
    made = billing.create_claims(visits, people, tables["insurers"], claims, charges, CLOCK)
    assert values(made["claims"], "ClaimID", "ClaimNumber", "TotalCharges") == [
        (1, "CLM-20010720-00001", Decimal("9500.00")),
        (2, "CLM-20010720-00002", Decimal("500.00")),
    ]
    order = sorted((1 + i % 3, i) for i in range(n) if i % 20)
    want = {i: k for k, (_, i) in enumerate(order, 1)}
    got = billing.claim_lines(made["visits"], charges).filter("ClaimID = 1").collect()
    assert {r["ChargeID"]: r["LineNumber"] for r in got} == want
    assert {r["CPTCode"] for r in got} == {"C", "X"}


def test_fee_validity(spark):
    fees = spark.createDataFrame(
        [
            ("a", "1", date(2001, 1, 1), date(2001, 7, 20), 1, Decimal(1)),  # expires today: closed
            ("b", "2", date(2001, 7, 20), None, 1, Decimal(2)),  # starts today: open
            ("c", "3", date(2000, 1, 1), None, 1, Decimal(3)),
            ("d", "3", date(2001, 1, 1), None, 1, Decimal(4)),  # later of two
            ("e", "4", date(2001, 1, 1), None, 0, Decimal(5)),  # switched off
            ("f", None, date(2001, 1, 1), None, 1, Decimal(6)),
        ],
        "ChargeCode string, CPTCode string, EffectiveDate date, ExpirationDate date, IsActive int, StandardCharge decimal(10,2)",
    ).withColumn("RevenueCode", F.lit("0300"))
    assert values(billing.current_fees(fees, CLOCK), "CPTCode", "ChargeCode") == [("2", "b"), ("3", "d")]


def test_room_charge_needs_fee_and_is_posted_once_a_day(spark):
    visits = spark.createDataFrame(
        [(1, 1, "INPATIENT", "ACTIVE"), (2, 2, "OBSERVATION", "ACTIVE"), (3, 3, "INPATIENT", "ACTIVE"), (4, 4, "EMERGENCY", "ACTIVE")],
        "EncounterID int, PatientID int, EncounterType string, EncounterStatus string",
    )
    fees = spark.createDataFrame([("RC-SEMI-PRIV", date(2001, 1, 1), 1, Decimal(2500))], "ChargeCode string, EffectiveDate date, IsActive int, StandardCharge decimal(10,2)")
    posted = spark.createDataFrame(
        [(3, "RC-SEMI-PRIV", datetime(2001, 7, 20, 1)), (1, "RC-SEMI-PRIV", datetime(2001, 7, 19, 23))],
        "EncounterID int, ChargeCode string, ServiceDate timestamp_ntz",
    )
    got = billing.post_room_charges(visits, fees, posted, CLOCK)
    assert values(got, "EncounterID", "ChargeCode", "ChargeAmount") == [(1, "RC-SEMI-PRIV", Decimal("2500.00"))]


def test_receivables_bounds(spark):
    ages = [0, 30, 31, 60, 61, 90, 91, -5]
    rows = [(date.fromordinal(CLOCK.now.date().toordinal() - a), Decimal(10 ** i), Decimal(0), "OPEN") for i, a in enumerate(ages)]
    rows.append((date(2001, 7, 1), Decimal(7), Decimal(0), "PARTIAL"))
    invoices = spark.createDataFrame(rows, "InvoiceDate date, TotalAmount decimal(12,2), PaidAmount decimal(12,2), InvoiceStatus string")
    got = management.receivables_ageing(invoices, CLOCK).first()
    assert [float(v) for v in got] == [1 + 10 + 1e7, 100 + 1000, 1e4 + 1e5, 1e6]


def test_late_plans_and_overdue_invoices(spark):
    day = CLOCK.now.date().toordinal()
    plans = spark.createDataFrame([(n, 1, date.fromordinal(day - n), "ACTIVE") for n in (59, 60, 61)], "PaymentPlanID int, PatientID int, NextPaymentDate date, PlanStatus string")
    # A due date counts from midnight, so one exactly 60 days back is already late at 10:30.
    assert values(billing.default_plans(plans, CLOCK), "PaymentPlanID") == [(60,), (61,)]
    invoices = spark.createDataFrame(
        [(1, 1, date.fromordinal(day - 120), Decimal(100), Decimal(0), "OPEN"), (2, 1, date.fromordinal(day - 121), Decimal(100), Decimal(0), "OPEN"),
         (3, 1, date.fromordinal(day - 121), Decimal(100), Decimal(50), "OPEN")],
        "InvoiceID int, PatientID int, DueDate date, TotalAmount decimal(12,2), PaidAmount decimal(12,2), InvoiceStatus string",
    )
    assert values(billing.send_to_collections(invoices, CLOCK), "InvoiceID") == [(2,)]


def test_appeals(spark):
    day = CLOCK.now.date().toordinal()
    claims = spark.createDataFrame(
        [(n, f"C{n}", "DENIED", date.fromordinal(day + n), Decimal(500 if n == 2 else 900)) for n in (-1, 0, 1, 2, 30, 31)] + [(99, "C99", "DENIED", None, Decimal(900))],
        "ClaimID int, ClaimNumber string, ClaimStatus string, AppealDeadline date, TotalCharges decimal(12,2)",
    )
    audit = spark.createDataFrame([("InsuranceClaims", -1, "APPEAL_EXPIRED")], "TableName string, RecordID int, Action string")
    got = billing.appeal_claims(claims, audit, CLOCK)
    assert values(got["claims"], "ClaimID") == [(1,), (30,)]
    assert values(got["audit"], "RecordID", "NewValues") == [(0, "Claim C0 denial is past appeal deadline ($900.00)")]


def test_registration_rules(spark):
    people = spark.createDataFrame([(7, "MRN-000041", "1"), (9, "MRN-000007", None)], "PatientID bigint, MRN string, SSN string")
    asked = spark.createDataFrame(
        [(1, "A", "A", "1"), (2, "B", "B", "2"), (3, "C", "C", "2"), (4, "D", "D", None), (5, "E", "E", None)],
        "RequestID int, FirstName string, LastName string, SSN string",
    )
    got = admissions.register_patients(asked, people, CLOCK)
    assert values(got["patients"], "RequestID", "MRN", "PatientID") == [(2, "MRN-000042", 10), (4, "MRN-000043", 11), (5, "MRN-000044", 12)]
    assert values(got["refused"], "RequestID") == [(1,), (3,)]
    assert got["audit"].first()["NewValues"] == "New patient registered: B B MRN: MRN-000042"


def test_archive_split_is_whole(tables):
    children = {n: tables[n] for n in ("orders", "diagnoses")}
    made = retention.archive_encounters(tables["encounters"], children, CLOCK, 36, 50, dry_run=False)
    assert made["log"].count() == 50
    for name, child in children.items():
        moved, kept = made[f"moved_{name}"], made[f"kept_{name}"]
        assert moved.count() > 0
        assert moved.unionByName(kept).exceptAll(child).count() == 0 and moved.count() + kept.count() == child.count()
    assert made["encounters"].filter("EncounterStatus = 'ARCHIVED'").count() == 50
    assert made["encounters"].count() == tables["encounters"].count()


def test_purge_split_is_whole(tables):
    made = catalog._purge(tables)
    for name, source in (("invoices", "invoices"), ("charges", "billing_charges"), ("audit_log", "audit_log")):
        assert made[f"purged_{name}"].count() + made[f"kept_{name}"].count() == tables[source].count()


def test_snapshot_of_itself_is_unchanged(tables):
    assert quality.snapshot_diff(tables["encounters"], tables["encounters"], "EncounterID", "Encounters", CLOCK).count() == 0


def test_snapshot_actions(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, "e")], "id int, v string")
    got = quality.snapshot_diff(old, new, "id", "T", CLOCK)
    assert values(got, "RecordID", "Action", "OldValues", "NewValues") == [
        (2, "UPDATE", '<OldRecord id="2"/>', '<NewRecord id="2" v="b"/>'),
        (3, "DELETE", '<OldRecord id="3" v="c"/>', None),
        (5, "INSERT", None, '<NewRecord id="5" v="e"/>'),
    ]


def test_upsert(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, v string, w int")
    change = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert values(upsert(table, change, ["id"]), "id", "v", "w") == [(1, "a", 1), (2, None, 2), (3, "c", None)]


def test_constraints(spark):
    df = spark.createDataFrame([("A", "x", 1), ("Z", None, 1), (None, "long", 2)], "s string, t string, k int")
    rules = quality.Rules({"s": ("A",)}, ("t",), {"t": 3}, ("k",))
    assert values(quality.check_constraints(df, "T", rules), "Rule", "ColumnName", "Violations") == [
        ("DOMAIN", "s", 1), ("LENGTH", "t", 1), ("REQUIRED", "t", 1), ("UNIQUE", "k", 1),
    ]


def test_profile_reads_every_row(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    for exact in (False, True):
        profile = quality.profile_table(df, "T", exact)
        assert values(profile, "ColumnName", "Rows", "MinValue", "MaxValue", "DistinctValues")[1] == ("v", 1000, "0", "6", 7)


def test_empty_census_department(spark, tables):
    got = management.hospital_census(tables["departments"], tables["encounters"].filter("false"), tables["rooms"], tables["room_assignments"], CLOCK)
    row = got.first()
    assert row["InpatientCount"] == 0 and row["AdmissionsToday"] == 0 and row["AvgCurrentLOS"] is None


def test_segmented_numbers_equal_plain_ones(spark, folder, tables, monkeypatch):
    """The whole registered numbering queries, cut into many ranges, against the run in few."""
    names = ("claim_lines_backlog", "admit_encounters", "register_patients", "self_pay_invoices", "patient_summary")
    plain = {n: catalog.QUERIES[n](spark, folder).collect() for n in names}
    monkeypatch.setattr(rows_module.number_rows, "__defaults__", (*rows_module.number_rows.__defaults__[:-1], 50))
    for n in names:
        assert sorted(map(repr, catalog.QUERIES[n](spark, folder).collect())) == sorted(map(repr, plain[n])), n
