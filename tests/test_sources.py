"""Sources, sinks and the search and summary options."""

import contextlib
import io
from datetime import date, datetime

import pytest

from tests.compare import values
from wardline.clock import Clock
from wardline.operators import lookups
from wardline.plans import catalog as registered
from wardline.sources import catalog, remote, sinks
from wardline.sources.shapes import Tables
from wardline.workspace import run_dir, shared_dir, stage

CLOCK = Clock.at("2001-07-20 10:30:00")


@pytest.fixture(scope="module")
def tables(spark, folder):
    return Tables(spark, folder)


def test_remote_options(spark):
    spark.conf.set("spark.wardline.remote.pharmacy.url", "jdbc:x://host/db")
    spark.conf.set("spark.wardline.remote.pharmacy.user", "reader")
    plain = remote.remote_options(spark, "pharmacy", query=remote.low_stock_query())
    assert plain["query"].endswith("StockQuantity < 10") and plain["queryTimeout"] == "60" and plain["user"] == "reader"
    assert "password" not in plain
    table = remote.remote_options(spark, "pharmacy", table="lab.results")
    assert table["dbtable"] == "lab.results" and "query" not in table
    split = remote.remote_options(spark, "pharmacy", query="SELECT 1", split=remote.Split("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT 1) remote_rows" and split["numPartitions"] == "8" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        remote.remote_options(spark, "pharmacy")
    assert "O''X" in remote.studies_query("O'X")


def test_recent_remote_results(spark):
    rows = [("M1", datetime(2001, 7, 13, 10, 30)), ("M1", datetime(2001, 7, 13, 10, 29)), ("M2", datetime(2001, 7, 19))]
    df = spark.createDataFrame(rows, "PatientMRN string, ResultDate timestamp_ntz")
    assert values(remote.recent_results(df, "M1", CLOCK), "ResultDate") == [(datetime(2001, 7, 13, 10, 30),)]


def test_tables_by_schema_and_append(spark, tables):
    root = run_dir(spark, "tables")
    sinks.replace(tables["departments"], f"{root}/patient/departments")
    sinks.append(tables["departments"], f"{root}/patient/departments")
    loaded = catalog.load_tables(spark, root, {"patient": ["departments"]})
    assert loaded["patient.departments"].count() == 2 * tables["departments"].count()


def test_profile_of_a_schema(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS ward_test")
    try:
        path = run_dir(spark, "warehouse")
        tables["departments"].write.option("path", path).mode("overwrite").saveAsTable("ward_test.departments")
        assert set(catalog.catalog_tables(spark, "ward_test")) == {"departments"}
        got = catalog.profile_schema(spark, "ward_test")
        assert values(got, "ColumnName", "Rows")[0] == ("DepartmentCode", tables["departments"].count())
    finally:
        spark.sql("DROP DATABASE ward_test CASCADE")


def test_literal_rows_by_record_number(spark, tables):
    rows = catalog.literal_rows(
        spark, [("MRN-000001", "DRUG", "Penicillin"), ("MRN-999999", "FOOD", "Nuts")], "MRN string, AllergyType string, AllergenName string"
    )
    assert values(catalog.attach_by_mrn(rows, tables["patients"]), "PatientID", "AllergenName") == [(1, "Penicillin")]
    visits = catalog.literal_rows(spark, [("MRN-000002", 3)], "MRN string, DayOffset int")
    assert values(catalog.appointments_on(visits, tables["patients"], CLOCK), "PatientID", "AppointmentDate") == [(2, date(2001, 7, 23))]


def test_derived_columns(tables):
    assert catalog.add_derived_columns("invoices", tables["invoices"]).filter("BalanceDue <> TotalAmount - PaidAmount").count() == 0
    assert catalog.add_derived_columns("billing_charges", tables["billing_charges"]).filter("NetAmount <> ChargeAmount - AdjustmentAmount").count() == 0
    assert "BMI" in catalog.add_derived_columns("vitals", tables["vitals"]).columns


def test_shared_folder_comes_from_the_session(spark, tables):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(tables["insurers"], "x")
    assert staged.schema.names == tables["insurers"].schema.names and staged.count() == tables["insurers"].count()


def test_single_patient_lookups_agree_with_whole_population(tables):
    t = tables
    whole = lookups.patient_encounters(t["encounters"], t["physicians"], t["departments"], t["diagnoses"], CLOCK)
    one = lookups.patient_encounters(t["encounters"], t["physicians"], t["departments"], t["diagnoses"], CLOCK, patient_id=7)
    assert one.count() > 0 and one.exceptAll(whole.filter("PatientID = 7")).count() == 0 and one.count() == whole.filter("PatientID = 7").count()
    args = (t["patients"], t["encounters"], t["diagnoses"], t["medications"], CLOCK)
    assert lookups.readmission_risk(*args, patient_id=7).first() == lookups.readmission_risk(*args).filter("PatientID = 7").first()


def test_search_options(tables):
    args = (tables["patients"], tables["insurers"], tables["encounters"], CLOCK)
    assert lookups.search_patients(*args, mrn="MRN-000007").count() == 1
    assert lookups.search_patients(*args, ssn="900-08-0000008").first()["PatientID"] == 8
    assert lookups.search_patients(*args, policy="SEC-14").first()["PatientID"] == 7
    born = tables["patients"].filter("PatientID = 9").first()["DateOfBirth"]
    assert 9 in [r["PatientID"] for r in lookups.search_patients(*args, date_of_birth=born).collect()]
    newest = lookups.search_patients(*args, sort="CreatedDate", direction="DESC", limit=3).collect()
    assert [r["CreatedDate"] for r in newest] == sorted((r["CreatedDate"] for r in newest), reverse=True)
    names = [r["LastName"] for r in lookups.search_patients(*args, sort="x; DROP", direction="sideways").collect()]
    assert names == sorted(names) and len(names) == 100



def test_summary_limits(spark, tables):
    person = tables["patients"].filter("PatientID = 1")
    at = datetime(2001, 1, 1)
    visits = spark.createDataFrame([(1, i, f"N{i}", "INPATIENT", at) for i in range(12)], "PatientID bigint, EncounterID int, EncounterNumber string, EncounterType string, AdmitDate timestamp_ntz")
    drugs = spark.createDataFrame([(1, i, f"D{i}", "1", "BID", "ACTIVE") for i in range(11)], "PatientID bigint, MedicationID int, DrugName string, Dosage string, Frequency string, MedicationStatus string")
    labs = spark.createDataFrame([(1, i, "T", None, None, "FINAL") for i in range(21)], "PatientID bigint, LabResultID int, TestName string, ResultValue string, ReportedDate timestamp_ntz, ResultStatus string")
    none = tables["allergies"].filter("false")
    got = lookups.patient_summary(person, visits, drugs, none, labs).groupBy("SectionName").count()
    assert values(got, "SectionName", "count") == [("DEMOGRAPHICS", 3), ("ENCOUNTERS", 10), ("LAB_RESULTS", 20), ("MEDICATIONS", 11)]


def test_hl7_edges(spark):
    text = "MSH|^~\\&|LAB\r\nPID|1\r  \rAB\rOBX|1|NM|GLU"
    df = spark.createDataFrame([(1, text), (2, None), (3, "\u00a0ZZZ|x\u2003")], "LabResultID int, RawHL7Message string")
    assert values(lookups.hl7_segments(df), "LabResultID", "SegmentIndex", "SegmentType", "FieldCount", "RawSegment") == [
        (1, 0, "MSH", 3, "MSH|^~\\&|LAB"),
        (1, 1, "PID", 2, "PID|1"),
        (1, 4, "OBX", 4, "OBX|1|NM|GLU"),
        (3, 0, "ZZZ", 2, "ZZZ|x"),
    ]


def test_schedule_edges(spark):
    day = '<Day name="{}" startTime="19:00" endTime="07:00" location="ER" onCall="{}"/>'
    rows = [(1, "<Schedule>" + day.format("Monday", "1") + day.format("Friday", "false") + "</Schedule>"), (2, "<Schedule>" + day.format("Sunday", "0") + "</Schedule>"), (3, None)]
    df = spark.createDataFrame(rows, "PhysicianID int, WeeklyScheduleXML string")
    assert values(lookups.physician_schedule(df), "PhysicianID", "DayOfWeek", "StartTime", "IsOnCall") == [
        (1, "Friday", "19:00", 0), (1, "Monday", "19:00", 1), (2, "Sunday", "19:00", 0),
    ]


PLANS = list(registered.QUERIES)


@pytest.mark.parametrize("name", PLANS)
def test_plans_stay_in_the_engine(spark, folder, name):
    """No cross product, nested-loop join or Python step in any physical plan."""
    plan = scan_of(registered.QUERIES[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"):
        assert bad not in plan


def scan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_date_filters_and_columns_reach_the_scan(spark, tables):
    """On stored hospital tables the clock's bounds are pushed down and only used columns are read."""
    from wardline.operators import billing
    from wardline.operators import management_reports as management

    visits, charges = stage(tables["encounters"], "e"), stage(tables["billing_charges"], "c")
    invoices, claims = stage(tables["invoices"], "i"), stage(tables["insurance_claims"], "k")
    plan = scan_of(management.average_stay(visits, CLOCK))
    assert "GreaterThanOrEqual(DischargeDate,2001-06-20T10:30)" in plan and "EqualTo(EncounterStatus,DISCHARGED)" in plan
    assert "RoomNumber" not in plan
    plan = scan_of(management.charge_flow(charges, CLOCK))
    assert "GreaterThanOrEqual(PostedDate,2001-01-01T00:00)" in plan and "CPTCode" not in plan
    plan = scan_of(billing.send_to_collections(invoices, CLOCK))
    assert "LessThan(DueDate,2001-03-22)" in plan
    plan = scan_of(billing.adjudicate_claims(claims, CLOCK))
    assert "LessThan(SubmittedDate,2001-07-06T00:00)" in plan and "EqualTo(ClaimStatus,SUBMITTED)" in plan
    plan = scan_of(management.readmission_rate(visits, CLOCK))
    assert "GreaterThanOrEqual(AdmitDate,2001-04-21T10:30)" in plan and "WindowGroupLimit" in plan


def scans(plan):
    return plan.count("Scan parquet")


def test_each_child_is_read_once_for_all_its_references(spark, folder):
    from wardline.operators import quality
    from wardline.plans.catalog import REFERENCES

    tables = {n: stage(Tables(spark, folder)[n], "t") for n in dict.fromkeys([r[0] for r in REFERENCES] + [r[2] for r in REFERENCES])}
    plan = scan_of(quality.all_orphans(tables, REFERENCES))
    children = {r[0] for r in REFERENCES}
    parents = {(r[2], r[3]) for r in REFERENCES}
    # The formatted plan names each scan twice: in the tree and in its details.
    # A child or parent with keys of both kinds is read once for each kind.
    assert scans(plan) <= 2 * (len(children) + 1 + len(parents))


def test_unique_keys_of_a_table_are_read_once(spark, folder):
    from wardline.operators import quality

    visits = stage(Tables(spark, folder)["encounters"], "t")
    plan = scan_of(quality.check_constraints(visits, "encounters", quality.CONSTRAINTS["encounters"]))
    assert scans(plan) <= 2 * 3  # single-row rules, the keys, and the list of keys


def test_archive_counts_read_each_child_once(spark, folder):
    from wardline.operators import retention

    tables = Tables(spark, folder)
    children = {n: stage(tables[n], "t") for n in ("orders", "vitals", "diagnoses")}
    plan = scan_of(retention.archive_counts(stage(tables["encounters"], "t"), children, CLOCK, 36))
    assert scans(plan) <= 2 * (len(children) + 1)
