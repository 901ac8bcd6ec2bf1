"""Registered queries: each runs one operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.clinical import (
    check_interaction,
    format_name,
    icd10_shape_ok,
    icd10_strict_ok,
    normalize_drug,
)
from wardline.functions.dialect import is_weekend
from wardline.operators import admissions, billing, daily, lookups, profiles, quality, retention, substring_index
from wardline.operators import clinical_reports as clinical
from wardline.operators import management_reports as management
from wardline.operators.rows import union_all
from wardline.plans.nightly import BillingTables, after_run, nightly_billing
from wardline.session import tune
from wardline.sources import colocated
from wardline.sources.catalog import appointments_on, literal_rows, profile_schema
from wardline.sources.shapes import PROFILED, SHAPES, Tables
from wardline.sources.sinks import append, merge_partitions, write_partitioned
from wardline.streaming import broker
from wardline.workspace import run_dir

CLOCK = Clock.at("2001-07-20 10:30:00")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def opened(spark: SparkSession, folder: str) -> Tables:
    return Tables.of(tune(spark), folder)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the hospital tables under its own name."""
    QUERIES[build.__name__] = lambda spark, folder: build(opened(spark, folder))
    return build


def joined_query(build: Callable[[Tables], DataFrame], *names: str) -> Callable[[Tables], DataFrame]:
    """Register a function that reads tables made of line items several times: they are joined with their visits once.

    ``names`` are the tables made of line items that it reads; all of them, if none are given.
    """
    QUERIES[build.__name__] = lambda spark, folder: build(opened(spark, folder).joined(*names))
    return build


def joined_query_of(*names: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    return lambda build: joined_query(build, *names)


def register(operator: Callable, *tables: str, clock: bool = False, name: str | None = None, **options) -> None:
    """Register an operator that takes tables in order, and the clock if asked for."""
    if clock:
        options["clock"] = CLOCK

    def run(spark: SparkSession, folder: str) -> DataFrame:
        source = opened(spark, folder)
        return operator(*[source[t] for t in tables], **options)

    QUERIES[name or operator.__name__] = run


# Clinical reports.
register(clinical.active_patients, "patients", "insurers", clock=True)
register(
    clinical.inpatient_census,
    "encounters", "patients", "physicians", "departments", "insurers", "medications", "orders",
    clock=True,
)
register(clinical.pending_lab_orders, "orders", "encounters", "patients", "physicians", "departments", clock=True)
register(clinical.critical_lab_results, "lab_results", "encounters", "patients", "physicians", clock=True)
register(clinical.active_medications, "medications", "patients", "physicians", "allergies", clock=True)
register(clinical.patient_encounter_summary, "patients", "encounters")
register(clinical.physician_workload, "physicians", "departments", "encounters", "orders", "clinical_notes", clock=True)
register(clinical.department_statistics, "departments", "encounters", "physicians", clock=True)

# Management reports and their blocks.
register(
    management.patient_financial_summary,
    "patients", "insurers", "encounters", "billing_charges", "payments", "insurance_claims", "invoices", "collections",
)
register(management.hospital_census, "departments", "encounters", "rooms", "room_assignments", clock=True)
register(
    management.physician_productivity,
    "physicians", "departments", "encounters", "orders", "procedures", "billing_charges", "appointments", "clinical_notes",
    clock=True,
)
register(
    management.revenue_cycle_summary,
    "billing_charges", "payments", "insurance_claims", "invoices", "collections", "encounters",
    clock=True,
)
register(management.charge_flow, "billing_charges", clock=True)
register(management.payment_flow, "payments", clock=True)
register(management.claim_queue, "insurance_claims")
register(management.receivables_ageing, "invoices", clock=True)
register(management.collection_totals, "collections")
register(management.visit_volume, "encounters", clock=True)
register(
    management.quality_metrics,
    "encounters", "orders", "clinical_notes", "lab_results", "audit_log", "insurance_claims",
    clock=True,
)
register(management.readmission_rate, "encounters", clock=True)
register(management.average_stay, "encounters", clock=True)
register(management.ed_time_to_first_order, "encounters", "orders", clock=True)
register(management.unsigned_notes, "clinical_notes", clock=True)
register(management.critical_lab_age, "lab_results", clock=True)
register(management.allergy_warning_count, "audit_log", clock=True)
register(management.claim_denial_rate, "insurance_claims", clock=True)


@query
def readmission_flags(t: Tables) -> DataFrame:
    """Every inpatient discharge on file, not only the reporting window."""
    return management.readmission_flags(t["encounters"])


# Lookups.
register(lookups.patient_encounters, "encounters", "physicians", "departments", "diagnoses", clock=True)
register(
    lookups.patient_encounters,
    "encounters", "physicians", "departments", "diagnoses",
    clock=True, name="patient_encounters_between", start=date(1998, 1, 1), end=date(1999, 6, 30),
)
register(lookups.active_medication_list, "medications", "physicians", "allergies", clock=True)
register(lookups.lab_trends, "lab_results", clock=True)
register(lookups.lab_trends, "lab_results", clock=True, name="lab_trends_one_test", test="purchase", days_back=5)
register(lookups.physician_schedule, "physicians")
register(lookups.search_patients, "patients", "insurers", "encounters", clock=True)
register(
    lookups.search_patients,
    "patients", "insurers", "encounters",
    clock=True, name="search_patients_filtered", first_name="b", status="ACTIVE", department_id=7, phone="5",
    sort="DateOfBirth", direction="DESC", limit=15,
)
register(
    lookups.search_patients,
    "patients", "insurers", "encounters",
    clock=True, name="search_patients_fallback", last_name="CUST", physician_id=3, sort="Shoe", direction="UP", limit=20,
)
register(lookups.patient_summary, "patients", "encounters", "medications", "allergies", "lab_results")
register(lookups.readmission_risk, "patients", "encounters", "diagnoses", "medications", clock=True)
register(lookups.drug_interactions, "medications")
register(lookups.interaction_pair_counts, "medications")
register(lookups.hl7_segments, "hl7_messages")
register(lookups.hl7_segments, "lab_messages", name="hl7_segments_of_lab_messages")
register(substring_index.drug_allergy_matches, "medications", "allergies")


@query
def patients_by_phone_part(t: Tables) -> DataFrame:
    """Patients with a part of a number in one of their phones, through the index of grams."""
    phones = ["HomePhone", "MobilePhone", "WorkPhone"]
    index = substring_index.build(t["patients"], "PatientID", phones)
    return substring_index.search(t.spark, t["patients"], "PatientID", phones, "0012", index).select("PatientID", *phones)


@query
def drug_interaction_check(t: Tables) -> DataFrame:
    """The pair check as a column, over every pair of drug columns on file."""
    return t["drug_pairs"].select(
        "PairID", "DrugA", "DrugB", check_interaction(F.col("DrugA"), F.col("DrugB")).alias("Result")
    )


def outputs(job: Callable[[Tables], dict[str, DataFrame]], names: dict[str, str]) -> None:
    """Register outputs of a job: query name to output key."""
    for name, key in names.items():
        QUERIES[name] = lambda spark, folder, key=key: job(opened(spark, folder))[key]


# Admissions.
outputs(
    lambda t: admissions.register_patients(t["registrations"], t["patients"], CLOCK),
    {"register_patients": "patients", "register_refused": "refused", "register_audit": "audit"},
)
outputs(
    lambda t: admissions.admit(t["admission_requests"], t["patients"], t["encounters"], t["invoices"], CLOCK),
    {"admit_encounters": "encounters", "admit_refused": "refused", "admit_messages": "messages"},
)
outputs(
    lambda t: admissions.discharge(
        t["discharge_requests"], t["encounters"], t["medications"], t["orders"], t["billing_charges"], CLOCK
    ),
    {
        "discharge_encounters": "encounters",
        "discharge_medications": "medications",
        "discharge_orders": "orders",
        "discharge_notes": "notes",
    },
)
outputs(
    lambda t: admissions.order_medications(t["medication_requests"], t["encounters"], t["allergies"], CLOCK),
    {
        "allergy_warnings": "warnings",
        "allergy_audit": "audit",
        "medication_orders": "orders",
        "medications_ordered": "medications",
    },
)


@query
def visits_by_weekend(t: Tables) -> DataFrame:
    """Visits per kind that began on a weekend and on other days."""
    weekend = is_weekend(F.col("AdmitDate")).cast("int").alias("Weekend")
    return t["encounters"].groupBy("EncounterType", weekend).agg(F.count("*").alias("Visits"))


# Billing.
def _posting(t: Tables) -> dict[str, DataFrame]:
    return billing.post_encounter_charges(
        t["procedures"], t["encounters"], t["chargemaster"], t["billing_charges"], t["departments"],
        t["physicians"], t["diagnoses"], CLOCK,
    )


def _claiming(days_back: int) -> Callable[[Tables], dict[str, DataFrame]]:
    return lambda t: billing.create_claims(
        t["encounters"], t["patients"], t["insurers"], t["insurance_claims"], t["billing_charges"], CLOCK,
        days_back=days_back,
    )


outputs(
    _posting,
    {
        "procedure_charges": "charges",
        "unpriced_procedures": "unpriced",
        "charge_totals": "totals",
        "charge_posting_audit": "audit",
    },
)
register(billing.current_fees, "chargemaster", clock=True)
register(billing.backdated_charges, "procedures", "encounters", "chargemaster", "billing_charges")


@query
def charge_fees_on_date(t: Tables) -> DataFrame:
    """Every charge with the fee that its procedure code had on the day of service."""
    charges = t["billing_charges"].select("ChargeID", "CPTCode", "ServiceDate", "ChargeAmount")
    return billing.fees_on_date(charges, t["chargemaster"], "ServiceDate")


register(billing.post_room_charges, "encounters", "chargemaster", "billing_charges", clock=True, name="room_charges")
def _lines(days_back: int) -> Callable[[Tables], DataFrame]:
    return lambda t: billing.claim_lines(_claiming(days_back)(t)["visits"], t["billing_charges"])


outputs(_claiming(1), {"claims_created": "claims", "claim_billed_charges": "charges"})
outputs(_claiming(3650), {"claims_created_backlog": "claims"})
for _name, _days in (("claim_lines", 1), ("claim_lines_backlog", 3650)):
    outputs(lambda t, days=_days: {"lines": _lines(days)(t)}, {_name: "lines"})
outputs(
    lambda t: billing.submit_claims(t["insurance_claims"], CLOCK),
    {"claims_submitted": "claims", "claims_submitted_audit": "audit"},
)
register(
    billing.self_pay_invoices,
    "billing_charges", "insurance_claims", "invoices", "patients", "payments",
    clock=True,
)
register(billing.reconcile_encounters, "encounters", "billing_charges", "payments", clock=True)
register(billing.default_plans, "payment_plans", clock=True)
register(billing.send_to_collections, "invoices", clock=True)
register(billing.adjudicate_claims, "insurance_claims", clock=True)
outputs(
    lambda t: billing.appeal_claims(t["insurance_claims"], t["billing_audit"], CLOCK),
    {"claims_appealed": "claims", "claims_appeal_expired": "audit"},
)


def billing_tables(t: Tables) -> BillingTables:
    return BillingTables(
        t["encounters"], t["patients"], t["insurers"], t["procedures"], t["diagnoses"], t["physicians"],
        t["departments"], t["chargemaster"], t["billing_charges"], t["insurance_claims"], t["invoices"], t["payments"],
    )


outputs(
    lambda t: nightly_billing(billing_tables(t.joined()), CLOCK),
    {"nightly_summary": "summary", "nightly_invoices": "invoices", "nightly_claim_lines": "claim_lines"},
)

RUN_STEPS = ("room_charges", "procedure_charges", "claims", "claim_lines", "submitted", "invoices")


@joined_query
def nightly_second_run(t: Tables) -> DataFrame:
    """Rows each step adds when the run is repeated on the tables that the first run left: none."""
    tables = billing_tables(t)
    again = nightly_billing(after_run(tables, nightly_billing(tables, CLOCK)), CLOCK)
    return union_all([again[n].agg(F.lit(n).alias("Step"), F.count("*").alias("Rows")) for n in RUN_STEPS])


@query
def nightly_claims_after(t: Tables) -> DataFrame:
    """Every claim as a run leaves it."""
    tables = billing_tables(t)
    left = after_run(tables, nightly_billing(tables, CLOCK))
    return left.claims.select("ClaimID", "ClaimNumber", "EncounterID", "TotalCharges", "ClaimStatus", "EDIBatchID")


@joined_query_of("procedures", "diagnoses", "billing_charges", "payments")
def nightly_visit_totals(t: Tables) -> DataFrame:
    """Visits with the posted total that a run writes back, and how many of their charges it leaves open."""
    tables = billing_tables(t)
    left = after_run(tables, nightly_billing(tables, CLOCK))
    posted = left.charges.groupBy("EncounterID").agg(F.count_if(F.col("ChargeStatus") == "POSTED").alias("OpenCharges"))
    visits = left.encounters.select("EncounterID", F.col("TotalCharges").cast("decimal(18,2)").alias("TotalCharges"))
    return visits.join(posted, "EncounterID", "left").withColumn("OpenCharges", F.coalesce("OpenCharges", F.lit(0)))

# Retention and the reporting extract.
ARCHIVE_MONTHS = 36
CHILD_TABLES = [
    "vitals", "lab_results", "medications", "orders", "clinical_notes", "diagnoses", "procedures", "radiology_studies",
]
PURGED = ["invoices", "charges", "audit_log", "billing_audit"]


def _archive(t: Tables, dry_run: bool = False, batch: int | None = None) -> dict[str, DataFrame]:
    children = {name: t[name] for name in CHILD_TABLES}
    return retention.archive_encounters(t["encounters"], children, CLOCK, ARCHIVE_MONTHS, batch, dry_run)


def _purge(t: Tables) -> dict[str, DataFrame]:
    archived = _archive(t)["encounters"]
    audits = {name: t[name] for name in ("audit_log", "billing_audit")}
    return retention.purge_billing(t["invoices"], t["billing_charges"], archived, audits, CLOCK, ARCHIVE_MONTHS)


outputs(lambda t: _archive(t, dry_run=True), {"archive_dry_run": "log"})
# The batch limit of a run, as the caller gives it.
outputs(lambda t: _archive(t, dry_run=True, batch=500), {"archive_oldest_500": "log"})
outputs(
    _archive,
    {"archive_summary": "summary", "archive_moved_diagnoses": "moved_diagnoses", "archive_kept_labs": "kept_lab_results", "archive_marked": "encounters"},
)
outputs(_purge, {"purged_charges": "purged_charges", "purge_kept_invoices": "kept_invoices"})


@joined_query
def archive_split_counts(t: Tables) -> DataFrame:
    return retention.archive_counts(t["encounters"], {n: t[n] for n in CHILD_TABLES}, CLOCK, ARCHIVE_MONTHS)


@query
def purge_split_counts(t: Tables) -> DataFrame:
    return retention.split_counts(_purge(t), PURGED, "purged", "kept")


# Partitioned tables: a year's folder each, changed partition by partition.
def by_year(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("Year", F.year(day))


def _partitioned(t: Tables, rows: DataFrame) -> str:
    path = run_dir(t.spark, "partitioned")
    write_partitioned(rows, path, ["Year"])
    return path


# The test lines' numbers repeat; these columns tell charges apart.
CHARGE_KEY = ["ChargeID", "ChargeCode", "ServiceDate", "ChargeAmount"]


@query
def charges_after_billing_and_purge(t: Tables) -> DataFrame:
    """Charges by year of service: those of new claims become BILLED, purged ones go, other years stay as written."""
    path = _partitioned(t, by_year(t["billing_charges"], "ServiceDate"))
    # The jobs read the charges as they are stored now.
    stored = t.spark.read.schema(t["billing_charges"].schema).parquet(path)
    t = t.having("billing_charges", stored.select(*t["billing_charges"].columns))
    billed = by_year(_claiming(1)(t)["charges"], "ServiceDate").select(*CHARGE_KEY, "Year", "ChargeStatus")
    purged = by_year(_purge(t)["purged_charges"], "ServiceDate").select(*CHARGE_KEY, "Year")
    merge_partitions(t.spark, path, CHARGE_KEY, ["Year"], billed, purged)
    return t.spark.read.parquet(path).select(*t["billing_charges"].columns)


@query
def visits_after_archive(t: Tables) -> DataFrame:
    """Visits by year of admission: archived ones move to an archive of the same form; both sides with their side's name."""
    active = _partitioned(t, by_year(t["encounters"], "AdmitDate"))
    archive = run_dir(t.spark, "archive")
    columns = t["encounters"].columns
    moved = by_year(_archive(t)["encounters"].where("EncounterStatus = 'ARCHIVED'").select(*columns), "AdmitDate")
    append(moved, archive, ["Year"])
    merge_partitions(t.spark, active, ["EncounterID"], ["Year"], removed=moved)
    sides = [t.spark.read.parquet(path).select(F.lit(side).alias("Side"), *columns) for side, path in (("active", active), ("archive", archive))]
    return union_all(sides)


register(retention.sync_chargemaster, "chargemaster")


@query
def literal_appointments(t: Tables) -> DataFrame:
    """Two lists of literal appointments for patients given by record number, one of them unknown."""
    columns = "MRN string, DayOffset int, AppointmentType string"
    first = literal_rows(t.spark, [("MRN-000001", 1, "CONSULT"), ("MRN-000002", 3, "FOLLOW_UP"), ("MRN-999999", 3, "CONSULT")], columns)
    second = literal_rows(t.spark, [("MRN-000002", -2, "PROCEDURE"), ("MRN-000007", 0, "CONSULT")], columns)
    return appointments_on(union_all([first, second]), t["patients"], CLOCK)


register(retention.appointment_extract, "appointments", "patients", "rooms")


# Data quality.
@query
def snapshot_diff(t: Tables) -> DataFrame:
    return quality.snapshot_diff(t["encounters"], t["encounters_after"], "EncounterID", "Encounters", CLOCK)


@query
def snapshot_diff_by_range(t: Tables) -> DataFrame:
    return quality.snapshot_diff_by_range(t["encounters"], t["encounters_after"], "EncounterID", "Encounters", CLOCK)


@joined_query
def constraint_violations(t: Tables) -> DataFrame:
    checked = {n: rules for n, rules in quality.CONSTRAINTS.items() if n in SHAPES}
    return union_all([quality.check_constraints(t[n], n, rules) for n, rules in checked.items()])


# Declared references, and those across databases: (child table, child key, parent table, parent key).
REFERENCES = [
    ("patients", "PrimaryInsuranceID", "insurers", "InsuranceProviderID"),
    ("physicians", "DepartmentID", "departments", "DepartmentID"),
    ("encounters", "PatientID", "patients", "PatientID"),
    ("encounters", "AttendingPhysicianID", "physicians", "PhysicianID"),
    ("encounters", "DepartmentID", "departments", "DepartmentID"),
    ("orders", "EncounterID", "encounters", "EncounterID"),
    ("orders", "PatientID", "patients", "PatientID"),
    ("orders", "OrderingPhysicianID", "physicians", "PhysicianID"),
    ("medications", "EncounterID", "encounters", "EncounterID"),
    ("medications", "PatientID", "patients", "PatientID"),
    ("medications", "PrescribingPhysicianID", "physicians", "PhysicianID"),
    ("lab_results", "EncounterID", "encounters", "EncounterID"),
    ("lab_results", "PatientID", "patients", "PatientID"),
    ("radiology_studies", "OrderID", "orders", "OrderID"),
    ("radiology_studies", "EncounterID", "encounters", "EncounterID"),
    ("radiology_studies", "PatientID", "patients", "PatientID"),
    ("diagnoses", "EncounterID", "encounters", "EncounterID"),
    ("diagnoses", "PatientID", "patients", "PatientID"),
    ("procedures", "EncounterID", "encounters", "EncounterID"),
    ("procedures", "PatientID", "patients", "PatientID"),
    ("procedures", "PerformingPhysicianID", "physicians", "PhysicianID"),
    ("vitals", "EncounterID", "encounters", "EncounterID"),
    ("vitals", "PatientID", "patients", "PatientID"),
    ("clinical_notes", "EncounterID", "encounters", "EncounterID"),
    ("clinical_notes", "AuthorID", "physicians", "PhysicianID"),
    ("allergies", "PatientID", "patients", "PatientID"),
    ("billing_charges", "EncounterID", "encounters_after", "EncounterID"),
    ("billing_charges", "ChargeCode", "chargemaster", "ChargeCode"),
    ("collections", "InvoiceID", "invoices", "InvoiceID"),
    ("payments", "ClaimID", "insurance_claims", "ClaimID"),
    ("appointments", "PatientID", "patients", "PatientID"),
    ("room_assignments", "RoomID", "rooms", "RoomID"),
    ("room_assignments", "EncounterID", "encounters_after", "EncounterID"),
]


@joined_query
def orphan_keys(t: Tables) -> DataFrame:
    return quality.all_orphans({n: t[n] for n in dict.fromkeys([r[0] for r in REFERENCES] + [r[2] for r in REFERENCES])}, REFERENCES)


@joined_query
def orphan_summary(t: Tables) -> DataFrame:
    return quality.orphan_summary(orphan_keys(t))


@joined_query
def orphan_keys_by_bitmap(t: Tables) -> DataFrame:
    """The references between whole numbers, tested against bitmaps of the parents' keys."""
    whole = [r for r in REFERENCES if r[3] != "ChargeCode"]
    return quality.orphans_by_bitmap({n: t[n] for n in dict.fromkeys([r[0] for r in whole] + [r[2] for r in whole])}, whole)


@joined_query
def table_profile(t: Tables) -> DataFrame:
    """Every column of every table, with exact distinct counts."""
    return union_all([quality.profile_table(t[n], n, exact=True) for n in PROFILED])


LATE_YEAR = 2000
SKETCHED = {"billing_charges": "ServiceDate", "encounters": "AdmitDate", "payments": "PaymentDate"}


@joined_query_of("billing_charges", "payments")
def table_profile_from_sketches(t: Tables) -> DataFrame:
    """Profiles of tables kept by year, merged from the stored sketches of the years; later years are added last."""

    def profile(name: str, rows: DataFrame) -> DataFrame:
        late = F.coalesce(F.col("Year") >= LATE_YEAR, F.lit(False))
        path, store = _partitioned(t, rows.where(~late)), run_dir(t.spark, "sketches")
        profiles.refresh(t.spark, t.spark.read.schema(rows.schema).parquet(path), ["Year"], store)
        write_partitioned(rows.where(late), path, ["Year"], mode="append")
        table = t.spark.read.schema(rows.schema).parquet(path)
        profiles.refresh(t.spark, table, ["Year"], store)
        return profiles.stored_profile(t.spark, table, ["Year"], store, name)

    # The tables do not depend on each other: the jobs of one fill the cores that those of another leave free.
    rows = [by_year(t[name], day) for name, day in SKETCHED.items()]
    with ThreadPoolExecutor(len(rows)) as pool:
        parts = list(pool.map(profile, SKETCHED, rows))
    return union_all(parts).select("TableName", "ColumnName", "Rows", "Nulls", "MinValue", "MaxValue")


CATALOGUED = ["insurance_claims", "collections", "payments"]


@query
def schema_profile(t: Tables) -> DataFrame:
    """Every table that a catalog schema lists, profiled one after the other."""
    path = run_dir(t.spark, "schema")
    schema = path.rsplit("/", 1)[1].replace("-", "_")
    t.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}'")
    for name in CATALOGUED:
        t[name].write.saveAsTable(f"{schema}.{name}")
    return profile_schema(t.spark, schema, exact=True)


# Reports from aggregates kept per day.
def _bitmaps(t: Tables, rows: DataFrame, by: list[str], ids: dict[str, str], day: str) -> DataFrame:
    """Bitmaps stored day by day, a part of the days later and a part of the rows loaded twice."""
    store = run_dir(t.spark, "bitmaps")
    late = F.coalesce(F.year(day) >= LATE_YEAR, F.lit(False))
    columns = {name: F.col(column) for name, column in ids.items()}
    loads = (rows.where(~late), rows.where(late), rows.where(F.col(next(iter(ids.values()))) % 3 == 0))
    for load in loads:
        append(daily.daily_bitmaps(load, F.to_date(day), by, columns), store)
    return t.spark.read.parquet(store)


@joined_query
def order_distinct_counts(t: Tables) -> DataFrame:
    """Distinct visits, patients and physicians per kind of order, from bitmaps of single days."""
    ids = {"Visits": "EncounterID", "Patients": "PatientID", "Physicians": "OrderingPhysicianID"}
    return daily.distinct_counts(_bitmaps(t, t["orders"], ["OrderType"], ids, "OrderDate"), ["OrderType"], list(ids))


@query
def department_distinct_visits(t: Tables) -> DataFrame:
    """Open visits and their patients per department and kind, where a part of the visit rows was loaded twice."""
    ids, by = {"Visits": "EncounterID", "Patients": "PatientID"}, ["DepartmentID", "EncounterType"]
    active = t["encounters"].where(F.col("EncounterStatus") == "ACTIVE")
    return daily.distinct_counts(_bitmaps(t, active, by, ids, "AdmitDate"), by, list(ids))


@query
def revenue_cycle_daily(t: Tables) -> DataFrame:
    """The revenue report from kept sums: old days, new days, then late rows and rows whose state changed."""
    store = run_dir(t.spark, "daily")
    names = {"charges": "billing_charges", "payments": "payments", "claims": "insurance_claims", "invoices": "invoices", "collections": "collections", "encounters": "encounters"}
    tables = {fact: t[name] for fact, name in names.items()}
    loads: dict[str, dict[str, DataFrame]] = {"old": {}, "new": {}, "changes": {}}
    for fact, df in tables.items():
        key, spec = F.col(df.columns[0]), daily.REVENUE_FACTS[fact]
        recent = F.coalesce(spec.day() >= F.lit("2001-07-01").cast("date"), F.lit(False))
        # A tenth of the old rows comes late, and another tenth was on file in another state first.
        first = df.where(~recent & (key % 10 != 3)).withColumn(spec.status, F.when(key % 10 == 7, "DRAFT").otherwise(F.col(spec.status)))
        changed = df.where(~recent & (key % 10 == 7))
        loads["old"][fact], loads["new"][fact] = first, df.where(recent)
        signed = daily.changes(changed.withColumn(spec.status, F.lit("DRAFT")), changed)
        loads["changes"][fact] = signed.unionByName(df.where(~recent & (key % 10 == 3)).withColumn(daily.SIGN, F.lit(1)))
    for load, rows in loads.items():
        daily.add_load(store, load, daily.fold_load(rows))
    return daily.revenue_cycle(t.spark.read.parquet(store), CLOCK)


# The same reports over facts stored bucketed by their common key.
BUCKETS = 16


VISIT_FACTS = ("encounters", "procedures", "diagnoses", "billing_charges", "payments")


def _visit_facts(t: Tables, names: tuple[str, ...] = VISIT_FACTS) -> colocated.Colocated:
    """Tables stored by visit: all of them, or those that a job reads."""
    return colocated.store({n: t[n] for n in names}, "EncounterID", BUCKETS, "visits")


@joined_query
def reconcile_encounters_colocated(t: Tables) -> DataFrame:
    stored = _visit_facts(t, ("encounters", "billing_charges", "payments"))
    return stored.per_key(lambda f: billing.reconcile_encounters(f["encounters"], f["billing_charges"], f["payments"], CLOCK))


@joined_query
def procedure_charges_colocated(t: Tables) -> DataFrame:
    def post(f: dict[str, DataFrame]) -> DataFrame:
        return billing.post_encounter_charges(
            f["procedures"], f["encounters"], t["chargemaster"], f["billing_charges"], t["departments"], t["physicians"], f["diagnoses"], CLOCK,
        )["charges"]

    return _visit_facts(t, ("encounters", "procedures", "diagnoses", "billing_charges")).per_key(post)


@joined_query
def patient_financial_summary_colocated(t: Tables) -> DataFrame:
    names = ("patients", "encounters", "billing_charges", "payments", "insurance_claims", "invoices", "collections")
    facts = colocated.store({n: t[n] for n in names}, "PatientID", BUCKETS, "patients")
    return facts.per_key(
        lambda f: management.patient_financial_summary(
            f["patients"], t["insurers"], f["encounters"], f["billing_charges"], f["payments"], f["insurance_claims"], f["invoices"], f["collections"],
        )
    )


register(quality.icd_quality, "diagnoses")
register(quality.vitals_enriched, "vitals")
register(quality.kidney_function, "lab_results", "patients", name="kidney_function", creatinine_test="signup", clock=True)
register(quality.drug_name_clusters, "medications")


@query
def patient_names(t: Tables) -> DataFrame:
    """Every name style for every patient."""
    parts = [F.col(n) for n in ("FirstName", "MiddleName", "LastName", "Suffix")]
    styles = ["LAST_FIRST", "FIRST_LAST", "FULL", "FORMAL", "OTHER"]
    return t["patients"].select("PatientID", *[format_name(*parts, style=s).alias(s) for s in styles])


@query
def icd_checks(t: Tables) -> DataFrame:
    code = F.col("ICDCode")
    return t["diagnoses"].select(
        "DiagnosisID",
        "ICDCode",
        icd10_shape_ok(code).cast("int").alias("ShapeOk"),
        icd10_strict_ok(code).cast("int").alias("StrictOk"),
    )


@query
def drug_names_normalized(t: Tables) -> DataFrame:
    return t["medications"].select(
        "MedicationID", "DrugName", normalize_drug(F.col("DrugName")).alias("NormalName")
    )


# Streaming: each drains a queue of several files, a file at a time, and returns one output.
QUEUE_FILES = 4


def queue(t: Tables) -> DataFrame:
    """The test messages in a queue folder, in order of their time, so that repeats come in later batches."""
    path = run_dir(t.spark, "queue")
    broker.send(t["messages"].repartitionByRange(QUEUE_FILES, "ts"), path)
    return broker.read_queue(t.spark, path, files_per_batch=1)


def _billing_stream(output: str, with_postings: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = opened(spark, folder)
        # Every batch reads the billing tables.
        effects = broker.billing_effects(CLOCK, billing_tables(t.joined()) if with_postings else None)
        return broker.run_once(spark, queue(t), effects, output)

    return run


QUERIES["stream_encounter_audit"] = _billing_stream("audit")
QUERIES["stream_encounter_replies"] = _billing_stream("replies")
QUERIES["stream_dead_letters"] = _billing_stream("dead_letters")
QUERIES["stream_activation_errors"] = _billing_stream("errors")
QUERIES["stream_discharge_charges"] = _billing_stream("charges", with_postings=True)
QUERIES["stream_discharge_errors"] = _billing_stream("posting_errors", with_postings=True)


@query
def stream_lab_alerts(t: Tables) -> DataFrame:
    return broker.run_once(t.spark, queue(t), broker.lab_effects(CLOCK), "alerts")


@query
def stream_routes(t: Tables) -> DataFrame:
    """Messages per route over the whole stream, folded per batch and then over batches."""
    count = lambda routed, earlier: {"routes": broker.count_routes(routed)}
    per_batch = broker.run_once(t.spark, queue(t), count, "routes")
    return per_batch.groupBy("route").agg(F.sum("Messages").alias("Messages"))


@query
def stream_admission_replies(t: Tables) -> DataFrame:
    """Admissions send their messages to a queue folder; the billing consumer answers them."""
    path = run_dir(t.spark, "queue")
    admitted = admissions.admit(t["admission_requests"], t["patients"], t["encounters"], t["invoices"], CLOCK)
    broker.send(admitted["messages"], path)
    return broker.run_once(t.spark, broker.read_queue(t.spark, path), broker.billing_effects(CLOCK), "replies")
