"""Parameterised patient lookups, computed for the whole population at once."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock, date_lit, ts_lit
from wardline.functions.clinical import INTERACTIONS, age_exact, drug_key
from wardline.functions.dialect import (
    ci_contains,
    ci_startswith,
    day_diff,
    last_first,
    trim_unicode,
    us_date,
    year_diff,
)
from wardline.operators.allergies import flag_conflicts
from wardline.operators.clinical_reports import c, name_of, physician_name, with_insurer
from wardline.operators.rows import first_rows, fold_facts, number_rows, union_all


def primary_diagnosis(diagnoses: DataFrame) -> DataFrame:
    """One PRIMARY diagnosis per visit: the smallest id."""
    row = F.struct("DiagnosisID", "ICDCode", "ICDDescription")
    return (
        diagnoses.filter(c("DiagnosisType") == "PRIMARY")
        .groupBy("EncounterID")
        .agg(F.min(row).alias("_dx"))
        .select("EncounterID", "_dx.ICDCode", "_dx.ICDDescription")
    )


def patient_encounters(
    encounters: DataFrame,
    physicians: DataFrame,
    departments: DataFrame,
    diagnoses: DataFrame,
    clock: Clock,
    patient_id: int | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Visits with stay, attending physician, department and primary diagnosis."""
    visits = encounters
    if patient_id is not None:
        visits = visits.filter(c("PatientID") == patient_id)
    if start is not None:
        visits = visits.filter(c("AdmitDate") >= ts_lit(datetime.combine(start, datetime.min.time())))
    if end is not None:
        visits = visits.filter(c("AdmitDate") <= ts_lit(datetime.combine(end, datetime.min.time())))
    return (
        visits.alias("e")
        .join(primary_diagnosis(diagnoses).alias("dx"), c("e.EncounterID") == c("dx.EncounterID"), "left")
        .join(physicians.alias("ph"), c("e.AttendingPhysicianID") == c("ph.PhysicianID"))
        .join(departments.alias("d"), c("e.DepartmentID") == c("d.DepartmentID"), "left")
        .select(
            "e.PatientID",
            "e.EncounterID",
            "e.EncounterNumber",
            "e.EncounterType",
            "e.AdmitDate",
            "e.DischargeDate",
            day_diff(c("e.AdmitDate"), F.coalesce(c("e.DischargeDate"), clock.ts)).alias("LengthOfStay"),
            physician_name("ph").alias("AttendingPhysician"),
            "d.DepartmentName",
            c("dx.ICDDescription").alias("PrimaryDiagnosis"),
            "e.TotalCharges",
            "e.EncounterStatus",
        )
    )


def active_medication_list(
    medications: DataFrame,
    physicians: DataFrame,
    allergies: DataFrame,
    clock: Clock,
    patient_id: int | None = None,
) -> DataFrame:
    live = medications.filter(c("MedicationStatus") == "ACTIVE")
    if patient_id is not None:
        live = live.filter(c("PatientID") == patient_id)
        allergies = allergies.filter(c("PatientID") == patient_id)
    return (
        flag_conflicts(live, allergies, "HasAllergyConflict")
        .alias("m")
        .join(physicians.alias("ph"), c("m.PrescribingPhysicianID") == c("ph.PhysicianID"))
        .select(
            "m.PatientID",
            "m.MedicationID",
            "m.DrugName",
            "m.GenericName",
            "m.DrugClass",
            "m.Dosage",
            "m.Route",
            "m.Frequency",
            "m.StartDate",
            day_diff(c("m.StartDate"), clock.ts).alias("DaysOnMedication"),
            name_of("ph").alias("PrescribingPhysician"),
            "m.IsControlledSubstance",
            "m.HasAllergyConflict",
        )
    )


# Relative change beyond which a result counts as moving (fixed values).
TREND_UP, TREND_DOWN = "1.05", "0.95"


def lab_trends(
    labs: DataFrame,
    clock: Clock,
    patient_id: int | None = None,
    test: str | None = None,
    days_back: int = 90,
) -> DataFrame:
    """Latest FINAL result per patient and test against the last strictly earlier one.

    Results of one instant are first reduced to the one with the largest id, so the two
    newest rows per group are the latest and the previous result; Spark trims each
    group to two rows before that shuffle.
    """
    if patient_id is not None:
        labs = labs.filter(c("PatientID") == patient_id)
    if test is not None:
        labs = labs.filter(c("TestCode") == test)
    group = ["PatientID", "TestCode"]
    detail = [
        "LabResultID",
        "TestName",
        "ResultValue",
        "ResultNumeric",
        "ReferenceRangeLow",
        "ReferenceRangeHigh",
        "AbnormalFlag",
    ]
    counts = labs.groupBy(*group).agg(F.count("*").alias("ResultCount"))
    per_instant = (
        labs.filter((c("ResultStatus") == "FINAL") & c("ReportedDate").isNotNull())
        .groupBy(*group, "ReportedDate")
        .agg(F.max(F.struct(*detail)).alias("_row"))
    )
    newest = first_rows(per_instant, group, [c("ReportedDate").desc()], 2, "_rank")
    dated = F.struct("ReportedDate", "_row")
    pair = newest.groupBy(*group).agg(
        F.max(F.when(c("_rank") == 1, dated)).alias("_latest"),
        F.max(F.when(c("_rank") == 2, dated)).alias("_previous"),
    )
    now_value, old_value = c("_latest._row.ResultNumeric"), c("_previous._row.ResultNumeric")

    def times(factor: str) -> Column:
        return old_value * F.lit(factor).cast("decimal(3,2)")

    trend = F.when(
        now_value.isNotNull() & old_value.isNotNull(),
        F.when(now_value > times(TREND_UP), "UP").when(now_value < times(TREND_DOWN), "DOWN").otherwise("STABLE"),
    )
    return (
        pair.filter(c("_latest.ReportedDate") >= clock.days(-days_back))
        .join(counts, group)
        .select(
            *group,
            "_latest._row.TestName",
            c("_latest._row.ResultValue").alias("LatestValue"),
            now_value.alias("LatestNumeric"),
            c("_latest.ReportedDate").alias("LatestDate"),
            c("_previous._row.ResultValue").alias("PreviousValue"),
            c("_previous.ReportedDate").alias("PreviousDate"),
            "_latest._row.ReferenceRangeLow",
            "_latest._row.ReferenceRangeHigh",
            "_latest._row.AbnormalFlag",
            trend.alias("TrendDirection"),
            "ResultCount",
        )
    )


SCHEDULE_SCHEMA = (
    "Day array<struct<_name string, _startTime string, _endTime string, _location string, _onCall string>>"
)


def physician_schedule(physicians: DataFrame, physician_id: int | None = None) -> DataFrame:
    """One row per day of each physician's weekly schedule document."""
    if physician_id is not None:
        physicians = physicians.filter(c("PhysicianID") == physician_id)
    days = physicians.filter(c("WeeklyScheduleXML").isNotNull()).select(
        "PhysicianID", F.explode(F.from_xml("WeeklyScheduleXML", SCHEDULE_SCHEMA).getField("Day")).alias("d")
    )
    return days.select(
        "PhysicianID",
        c("d._name").alias("DayOfWeek"),
        c("d._startTime").alias("StartTime"),
        c("d._endTime").alias("EndTime"),
        c("d._location").alias("Location"),
        F.when(F.lower("d._onCall").isin("1", "true"), 1)
        .when(F.lower("d._onCall").isin("0", "false"), 0)
        .alias("IsOnCall"),
    )


SORT_COLUMNS = ("LastName", "FirstName", "MRN", "DateOfBirth", "PatientID", "CreatedDate")


def search_patients(
    patients: DataFrame,
    insurers: DataFrame,
    encounters: DataFrame,
    clock: Clock,
    last_name: str | None = None,
    first_name: str | None = None,
    mrn: str | None = None,
    ssn: str | None = None,
    date_of_birth: date | None = None,
    phone: str | None = None,
    policy: str | None = None,
    status: str | None = None,
    department_id: int | None = None,
    physician_id: int | None = None,
    limit: int = 100,
    sort: str = "LastName",
    direction: str = "ASC",
) -> DataFrame:
    """Filtered, sorted top-n patients with their last visit. Unknown sort arguments fall back.

    The list is cut to the top n before the visits are read, so only the visits of
    those patients are aggregated. Ties end in patient id order.
    """
    found = patients
    if last_name is not None:
        found = found.filter(ci_startswith(c("LastName"), last_name))
    if first_name is not None:
        found = found.filter(ci_startswith(c("FirstName"), first_name))
    for name, value in (("MRN", mrn), ("SSN", ssn), ("PatientStatus", status)):
        if value is not None:
            found = found.filter(c(name) == value)
    if date_of_birth is not None:
        found = found.filter(c("DateOfBirth") == date_lit(date_of_birth))
    if phone is not None:
        hits = [ci_contains(c(n), F.lit(phone)) for n in ("HomePhone", "MobilePhone", "WorkPhone")]
        found = found.filter(hits[0] | hits[1] | hits[2])
    if policy is not None:
        found = found.filter((c("PrimaryPolicyNumber") == policy) | (c("SecondaryPolicyNumber") == policy))
    for name, value in (("DepartmentID", department_id), ("AttendingPhysicianID", physician_id)):
        if value is not None:
            present = encounters.filter((c(name) == value) & (c("EncounterStatus") == "ACTIVE")).select("PatientID")
            found = found.join(present, "PatientID", "left_semi")
    column = sort if sort in SORT_COLUMNS else "LastName"
    lead = c(column).desc() if direction == "DESC" else c(column).asc()
    top = found.orderBy(lead, c("PatientID")).limit(limit)
    visit = F.struct("AdmitDate", "EncounterID", "EncounterType")
    last = (
        encounters.select("PatientID", "AdmitDate", "EncounterID", "EncounterType")
        .join(top.select("PatientID"), "PatientID", "left_semi")
        .groupBy("PatientID")
        .agg(F.max(visit).alias("_last"))
    )
    return (
        with_insurer(top, insurers)
        .join(last.alias("v"), c("p.PatientID") == c("v.PatientID"), "left")
        .select(
            "p.PatientID",
            "p.MRN",
            "p.LastName",
            "p.FirstName",
            "p.MiddleName",
            "p.DateOfBirth",
            year_diff(c("p.DateOfBirth"), clock.ts).alias("Age"),
            "p.Gender",
            "p.Address1",
            "p.City",
            "p.State",
            "p.ZipCode",
            "p.HomePhone",
            "p.MobilePhone",
            "p.Email",
            "p.PatientStatus",
            c("ip.ProviderName").alias("PrimaryInsurance"),
            "p.PrimaryPolicyNumber",
            c("v._last.AdmitDate").alias("LastEncounterDate"),
            c("v._last.EncounterType").alias("LastEncounterType"),
            *([c("p.CreatedDate")] if column == "CreatedDate" else []),
        )
        .orderBy(lead, c("PatientID"))
    )


# Section order of the summary (fixed values).
SECTIONS = {"DEMOGRAPHICS": 0, "ENCOUNTERS": 10, "MEDICATIONS": 20, "ALLERGIES": 30, "LAB_RESULTS": 40}
SUMMARY_VISITS, SUMMARY_LABS = 10, 20


def _texts(*columns: str) -> list[Column]:
    """Up to three text columns under common names."""
    values = [c(n).cast("string") for n in columns] + [F.lit(None).cast("string")] * (3 - len(columns))
    return [value.alias(name) for value, name in zip(values, ("_a", "_b", "_c"))]


def patient_summary(
    patients: DataFrame,
    encounters: DataFrame,
    medications: DataFrame,
    allergies: DataFrame,
    labs: DataFrame,
    patient_id: int | None = None,
) -> DataFrame:
    """Text lines in five sections per patient; sort by (SectionOrder, LineNumber) to read.

    Visits and labs are trimmed to the newest few per patient before any shuffle. The
    medication and allergy lists are unlimited, so they are numbered in ranges.
    """
    sources = {"p": patients, "e": encounters, "m": medications, "a": allergies, "l": labs}
    if patient_id is not None:
        sources = {k: v.filter(c("PatientID") == patient_id) for k, v in sources.items()}
    known = sources["p"].select("PatientID")

    def lines(df: DataFrame, name: str, number: Column, text: Column) -> DataFrame:
        return df.select(
            "PatientID",
            F.lit(name).alias("SectionName"),
            F.lit(SECTIONS[name]).alias("SectionOrder"),
            number.cast("long").alias("LineNumber"),
            text.alias("DetailLine"),
        )

    full_name = F.concat(
        last_first(c("LastName"), c("FirstName")), F.lit(" "), F.coalesce(c("MiddleName"), F.lit(""))
    )
    about = F.array(
        F.concat(F.lit("Patient: "), full_name),
        F.concat(F.lit("MRN: "), c("MRN")),
        F.concat(F.lit("DOB: "), us_date(c("DateOfBirth")), F.lit(" | Gender: "), c("Gender")),
    )
    demographics = sources["p"].select("PatientID", F.posexplode(about).alias("_at", "_text"))
    visits = first_rows(
        sources["e"].select("PatientID", "EncounterID", "EncounterNumber", "EncounterType", "AdmitDate"),
        ["PatientID"],
        [c("AdmitDate").desc(), c("EncounterID").desc()],
        SUMMARY_VISITS,
    )
    results = first_rows(
        sources["l"]
        .filter(c("ResultStatus") == "FINAL")
        .select("PatientID", "LabResultID", "TestName", "ResultValue", "ReportedDate"),
        ["PatientID"],
        [c("ReportedDate").desc(), c("LabResultID").desc()],
        SUMMARY_LABS,
    )
    drugs = (
        sources["m"]
        .filter((c("MedicationStatus") == "ACTIVE") & c("PatientID").isNotNull())
        .select("PatientID", "MedicationID", "DrugName", "Dosage", "Frequency")
    )
    allergens = (
        sources["a"]
        .filter((c("AllergyStatus") == "ACTIVE") & c("PatientID").isNotNull())
        .select("PatientID", "AllergyID", "AllergenName", "Severity")
    )
    # Both lists are numbered at once.
    listed = union_all(
        [
            drugs.select("PatientID", F.lit("MEDICATIONS").alias("_list"), c("MedicationID").alias("_id"), *_texts("DrugName", "Dosage", "Frequency")),
            allergens.select("PatientID", F.lit("ALLERGIES").alias("_list"), c("AllergyID").alias("_id"), *_texts("AllergenName", "Severity")),
        ]
    )
    listed = number_rows(listed, ["_id", "_a", "_b", "_c"], ["PatientID", "_list"])
    drugs, allergens = (listed.filter(c("_list") == name) for name in ("MEDICATIONS", "ALLERGIES"))
    blank = F.lit(" ")
    sections = union_all(
        [
            lines(demographics, "DEMOGRAPHICS", c("_at") + 1, c("_text")),
            lines(
                visits,
                "ENCOUNTERS",
                c("RowNumber"),
                F.concat(c("EncounterNumber"), F.lit(" | "), c("EncounterType"), F.lit(" | "), us_date(c("AdmitDate"))),
            ),
            lines(
                drugs,
                "MEDICATIONS",
                c("RowNumber"),
                F.concat(c("_a"), blank, c("_b"), blank, c("_c")),
            ),
            lines(
                allergens,
                "ALLERGIES",
                c("RowNumber"),
                F.concat(c("_a"), F.lit(" ["), c("_b"), F.lit("]")),
            ),
            lines(
                results,
                "LAB_RESULTS",
                c("RowNumber"),
                F.concat(
                    c("TestName"),
                    F.lit(": "),
                    F.coalesce(c("ResultValue"), F.lit("Pending")),
                    F.lit(" ("),
                    us_date(c("ReportedDate")),
                    F.lit(")"),
                ),
            ),
        ]
    )
    return sections.join(known, "PatientID", "left_semi")


# Risk points (fixed values): the first threshold reached gives the points.
AGE_POINTS = ((75, 15), (65, 10), (50, 5))
CHRONIC_POINTS = ((5, 20), (3, 12), (1, 5))
MEDICATION_POINTS = ((10, 15), (5, 8))
VISIT_POINTS, RISK_CAP = 8, 100


def points(value: Column, steps: tuple[tuple[int, int], ...]) -> Column:
    score = F.lit(0)
    for threshold, award in reversed(steps):
        score = F.when(value >= threshold, award).otherwise(score)
    return score


def readmission_risk(
    patients: DataFrame,
    encounters: DataFrame,
    diagnoses: DataFrame,
    medications: DataFrame,
    clock: Clock,
    patient_id: int | None = None,
) -> DataFrame:
    """Score from age, recent visits, chronic conditions and active drugs, capped at 100."""
    sources = [patients, encounters, diagnoses, medications]
    if patient_id is not None:
        sources = [s.filter(c("PatientID") == patient_id) for s in sources]
    people, visits, conditions, drugs = sources
    folded = fold_facts(
        "PatientID",
        [
            visits.filter(c("AdmitDate") >= clock.days(-30)).select("PatientID", F.lit(1).alias("_visits")),
            conditions.filter((c("ChronicIndicator").cast("int") == 1) & c("ICDCode").isNotNull())
            .select("PatientID", "ICDCode")
            .distinct()
            .select("PatientID", F.lit(1).alias("_chronic")),
            drugs.filter(c("MedicationStatus") == "ACTIVE").select("PatientID", F.lit(1).alias("_drugs")),
        ],
        ["_visits", "_chronic", "_drugs"],
    )

    def known(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0))

    score = (
        points(age_exact(c("DateOfBirth"), clock.today), AGE_POINTS)
        + known("_visits") * VISIT_POINTS
        + points(known("_chronic"), CHRONIC_POINTS)
        + points(known("_drugs"), MEDICATION_POINTS)
    )
    return people.join(folded, "PatientID", "left").select(
        "PatientID", F.least(score, F.lit(RISK_CAP)).cast("decimal(5,2)").alias("RiskScore")
    )


def drug_interactions(medications: DataFrame, patient_id: int | None = None) -> DataFrame:
    """Known interactions among each patient's active drugs, with how often each drug is listed.

    Drugs are collapsed per patient first and only the vocabulary of the pair table is
    kept, so a patient contributes at most sixteen pairs however many rows there are.
    """
    live = medications.filter(c("MedicationStatus") == "ACTIVE")
    if patient_id is not None:
        live = live.filter(c("PatientID") == patient_id)
    listed = sorted({name for pair in INTERACTIONS for name in pair[:2]})
    drugs = (
        live.select("PatientID", drug_key(c("DrugCode")).alias("Drug"))
        .filter(c("Drug").isin(listed))
        .groupBy("PatientID", "Drug")
        .agg(F.count("*").alias("Rows"))
    )
    # The partners of each anchor drug come from a literal map, so the pair table needs no join.
    partners: dict[str, list[Column]] = {}
    for anchor, partner, warning in INTERACTIONS:
        entry = F.struct(F.lit(partner).alias("DrugB"), F.lit(warning).alias("Warning"))
        partners.setdefault(anchor, []).append(entry)
    table = F.create_map(*[x for anchor, rows in partners.items() for x in (F.lit(anchor), F.array(*rows))])
    first = (
        drugs.filter(c("Drug").isin(list(partners)))
        .select("PatientID", c("Drug").alias("DrugA"), c("Rows").alias("RowsA"), F.explode(table[c("Drug")]).alias("_p"))
        .select("PatientID", "DrugA", "RowsA", "_p.DrugB", "_p.Warning")
    )
    second = drugs.select("PatientID", c("Drug").alias("DrugB"), c("Rows").alias("RowsB"))
    return first.join(second, ["PatientID", "DrugB"]).select(
        "PatientID", "DrugA", "DrugB", "RowsA", "RowsB", "Warning"
    )


def interaction_pair_counts(medications: DataFrame) -> DataFrame:
    """Per patient: pairs of different active drugs, how many are known to interact, how many are not.

    Pairs are counted from the number of drugs, never listed.
    """
    distinct = (
        medications.filter((c("MedicationStatus") == "ACTIVE") & c("DrugCode").isNotNull())
        .select("PatientID", drug_key(c("DrugCode")).alias("Drug"))
        .distinct()
        .groupBy("PatientID")
        .agg(F.count("*").alias("Drugs"))
    )
    known = drug_interactions(medications).groupBy("PatientID").agg(F.count("*").alias("Interacting"))
    pairs = F.expr("Drugs * (Drugs - 1) div 2")
    hits = F.coalesce(c("Interacting"), F.lit(0))
    return distinct.join(known, "PatientID", "left").select(
        "PatientID", "Drugs", pairs.alias("Pairs"), hits.alias("Interacting"), (pairs - hits).alias("NoInteraction")
    )


MIN_SEGMENT = 3


def hl7_segments(messages: DataFrame, key: str = "LabResultID", text: str = "RawHL7Message") -> DataFrame:
    """Segments of line-based messages. Short segments are skipped but keep their index."""
    parts = F.filter(F.split(c(text), "[\r\n]"), lambda part: part != "")
    trimmed = F.transform(parts, trim_unicode)
    return (
        messages.filter(c(text).isNotNull())
        .select(key, F.posexplode(trimmed).alias("SegmentIndex", "RawSegment"))
        .filter(F.length("RawSegment") >= MIN_SEGMENT)
        .select(
            key,
            "SegmentIndex",
            F.left("RawSegment", F.lit(3)).alias("SegmentType"),
            (F.length("RawSegment") - F.length(F.replace("RawSegment", F.lit("|"), F.lit(""))) + 1).alias("FieldCount"),
            "RawSegment",
        )
    )
