"""Registration, admission, discharge and drug ordering as whole-batch jobs.

Each job returns the rows it adds or changes; nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.dialect import iso_seconds, sum_or_zero, xml_row
from wardline.operators.allergies import matching_allergens
from wardline.operators.clinical_reports import PENDING, c
from wardline.operators.numbering import assign_numbers, next_ids
from wardline.sources.sinks import audit_rows
from wardline.workspace import stage

DUPLICATE_SSN = "A patient with this SSN already exists."
NO_PATIENT = "Patient not found or inactive."
OPEN_VISIT = "Patient already has an active encounter of this type."
UNKNOWN_TYPE = "Unknown encounter type."


def register_patients(
    requests: DataFrame, patients: DataFrame, clock: Clock, by: str = "SYSTEM", mrn_prefix: str = "MRN-"
) -> dict[str, DataFrame]:
    """New patients with record numbers; a repeated SSN is refused, the batch's first request wins.

    Requests without an SSN cannot clash and skip the joins, so they never pile up on
    a null key.
    """
    with_ssn = requests.filter(c("SSN").isNotNull())
    row = F.struct("RequestID", *[n for n in requests.columns if n not in ("RequestID", "SSN")])
    firsts = with_ssn.groupBy("SSN").agg(F.min(row).alias("_r")).select("SSN", "_r.*")
    fresh = firsts.join(patients.select("SSN"), "SSN", "left_anti").select(*requests.columns)
    # Numbering reads its input more than once, so the accepted batch is written first.
    accepted = stage(fresh.unionByName(requests.filter(c("SSN").isNull())), "registrations")
    added = assign_numbers(
        accepted,
        patients.select("MRN", "PatientID"),
        "MRN",
        [mrn_prefix],
        6,
        ["RequestID"],
        key="PatientID",
        staged=True,
    ).withColumn("PatientStatus", F.lit("ACTIVE"))
    refused = with_ssn.join(accepted.select("RequestID"), "RequestID", "left_anti").select(
        "RequestID", F.lit(DUPLICATE_SSN).alias("Reason")
    )
    text = F.concat(
        F.lit("New patient registered: "), c("FirstName"), F.lit(" "), c("LastName"), F.lit(" MRN: "), c("MRN")
    )
    audit = audit_rows(added, "Patients", c("PatientID"), "REGISTER", text, by, clock)
    return {"patients": added, "refused": refused, "audit": audit}


# Visit number prefixes (fixed values).
TYPE_PREFIX = {"INPATIENT": "IP", "OUTPATIENT": "OP", "EMERGENCY": "ER", "OBSERVATION": "OB"}


def admit(
    requests: DataFrame, patients: DataFrame, encounters: DataFrame, invoices: DataFrame, clock: Clock
) -> dict[str, DataFrame]:
    """Open visits for a batch of requests, with opening balances and outgoing messages.

    Whether a request can be accepted depends only on (patient, type), so the batch is
    first folded to its first request per pair; a patient with very many requests is
    one row per type by the time the joins run.
    """
    pair = ["PatientID", "EncounterType"]
    row = F.struct("RequestID", *[n for n in requests.columns if n not in ("RequestID", *pair)])
    firsts = requests.groupBy(*pair).agg(F.min(row).alias("_r")).select(*pair, "_r.*")
    active = patients.filter(c("PatientStatus") == "ACTIVE").select("PatientID")
    open_pairs = encounters.filter(c("EncounterStatus") == "ACTIVE").select(*pair)
    fits = firsts.join(active, "PatientID", "left_semi").join(open_pairs, pair, "left_anti")
    accepted = stage(fits.filter(c("EncounterType").isin(*TYPE_PREFIX)), "admissions")
    balances = (
        invoices.filter(c("InvoiceStatus") == "OPEN")
        .groupBy("PatientID")
        .agg(sum_or_zero(c("TotalAmount") - c("PaidAmount")).alias("PatientBalance"))
    )
    day = clock.stamp("%Y%m%d")
    prefix = F.lit(None).cast("string")
    for kind, short in TYPE_PREFIX.items():
        prefix = F.when(c("EncounterType") == kind, f"{short}-{day}-").otherwise(prefix)
    numbered = assign_numbers(
        accepted,
        encounters.select("EncounterNumber"),
        "EncounterNumber",
        [f"{short}-{day}-" for short in TYPE_PREFIX.values()],
        4,
        ["RequestID"],
        prefix,
        staged=True,
    )
    keyed = next_ids(numbered, encounters, "EncounterID", ["RequestID"])
    opened = (
        keyed.join(balances, "PatientID", "left")
        .withColumn("PatientBalance", F.coalesce("PatientBalance", F.lit(0).cast("decimal(18,2)")))
        .withColumn("AdmitDate", clock.ts)
        .withColumn("EncounterStatus", F.lit("ACTIVE"))
    )
    people = active.distinct().withColumn("_known", F.lit(True))
    refused = (
        requests.select("RequestID", "PatientID", "EncounterType")
        .join(accepted.select("RequestID"), "RequestID", "left_anti")
        .join(people, "PatientID", "left")
        .select(
            "RequestID",
            F.when(c("_known").isNull(), NO_PATIENT)
            .when(c("EncounterType").isin(*TYPE_PREFIX), OPEN_VISIT)
            .otherwise(UNKNOWN_TYPE)
            .alias("Reason"),
        )
    )
    return {"encounters": opened, "refused": refused, "messages": encounter_messages(opened)}


def encounter_messages(encounters: DataFrame) -> DataFrame:
    """One NewEncounter message per visit; the handle is derived from the visit, so a replay repeats it."""
    body = xml_row(
        "NewEncounter",
        {
            "EncounterID": c("EncounterID"),
            "PatientID": c("PatientID"),
            "EncounterType": c("EncounterType"),
            "AdmitDate": iso_seconds(c("AdmitDate")),
        },
    )
    return encounters.select(
        F.concat(F.lit("enc-"), c("EncounterID").cast("string")).alias("conversation_handle"),
        F.lit(0).cast("long").alias("message_sequence"),
        F.lit("PatientEncounterMessage").alias("message_type"),
        body.alias("body"),
        c("AdmitDate").alias("ts"),
    )


def discharge(
    requests: DataFrame,
    encounters: DataFrame,
    medications: DataFrame,
    orders: DataFrame,
    charges: DataFrame,
    clock: Clock,
) -> dict[str, DataFrame]:
    """Close active visits: end their drugs, cancel open orders, total charges, draft a summary note."""
    row = F.struct("DischargeDisposition", "DischargeDiagnosis")
    asked = requests.groupBy("EncounterID").agg(F.min(row).alias("_r")).select("EncounterID", "_r.*")
    closing = encounters.filter(c("EncounterStatus") == "ACTIVE").join(asked, "EncounterID")
    ids = closing.select("EncounterID")
    # Folded before the join, so a visit with very many charges is one row.
    totals = charges.groupBy("EncounterID").agg(sum_or_zero(c("ChargeAmount")).alias("TotalCharges"))
    closed = (
        closing.select("EncounterID", "PatientID", "DischargeDisposition", "DischargeDiagnosis")
        .join(totals, "EncounterID", "left")
        .select(
            "EncounterID",
            "PatientID",
            F.lit("DISCHARGED").alias("EncounterStatus"),
            clock.ts.alias("DischargeDate"),
            "DischargeDiagnosis",
            "DischargeDisposition",
            F.coalesce("TotalCharges", F.lit(0).cast("decimal(18,2)")).alias("TotalCharges"),
        )
    )
    ended = (
        medications.filter(c("MedicationStatus") == "ACTIVE")
        .join(ids, "EncounterID", "left_semi")
        .select(
            "MedicationID", "EncounterID", F.lit("COMPLETED").alias("MedicationStatus"), clock.ts.alias("EndDate")
        )
    )
    cancelled = (
        orders.filter(c("OrderStatus").isin(*PENDING))
        .join(ids, "EncounterID", "left_semi")
        .select(
            "OrderID",
            "EncounterID",
            F.lit("CANCELLED").alias("OrderStatus"),
            clock.ts.alias("CancelledDate"),
            F.lit("Patient discharged").alias("CancelledReason"),
        )
    )
    text = F.concat(
        F.lit("Auto-generated discharge summary. Disposition: "),
        c("DischargeDisposition"),
        F.lit(". Diagnosis: "),
        F.coalesce("DischargeDiagnosis", F.lit("Not specified")),
    )
    notes = closing.select(
        "EncounterID",
        "PatientID",
        F.lit("DISCHARGE_SUMMARY").alias("NoteType"),
        c("AttendingPhysicianID").alias("AuthorID"),
        text.alias("NoteContent"),
        F.lit("DRAFT").alias("NoteStatus"),
    )
    return {"encounters": closed, "medications": ended, "orders": cancelled, "notes": notes}


def order_medications(
    requests: DataFrame, encounters: DataFrame, allergies: DataFrame, clock: Clock, by: str = "SYSTEM"
) -> dict[str, DataFrame]:
    """Place drug orders on active visits and screen them against drug allergies.

    A match warns but does not stop the order. Matching runs once per distinct
    (patient, drug name, generic name); the warning document lists distinct allergens,
    so its length is bounded by the drug vocabulary.
    """
    active = encounters.filter(c("EncounterStatus") == "ACTIVE").select("EncounterID", "PatientID")
    placed = requests.join(active, "EncounterID")
    names = ["DrugName", "GenericName"]
    warning = xml_row(
        "AllergyWarning",
        {n: c(f"_first.{n}") for n in ("AllergyID", "AllergenName", "Severity", "Reaction")},
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct(c("_first.AllergyID"), warning.alias("x")))), lambda r: r["x"])
    screened = (
        matching_allergens(placed, allergies, names)
        .withColumn("_generic", F.coalesce("GenericName", F.lit("")))
        .groupBy("PatientID", "DrugName", "_generic")
        .agg(
            F.sum("_records").alias("AllergyCount"),
            F.concat(F.lit("<Warnings>"), F.concat_ws("", listed), F.lit("</Warnings>")).alias("InteractionCheckXML"),
        )
    )
    checked = (
        placed.withColumn("_generic", F.coalesce("GenericName", F.lit("")))
        .join(screened, ["PatientID", "DrugName", "_generic"], "left")
        .drop("_generic")
    )
    warned = checked.filter(c("AllergyCount") > 0)
    text = F.concat(
        F.lit("Drug allergy warning for patient "),
        c("PatientID").cast("string"),
        F.lit(": "),
        c("DrugName"),
        F.lit(" - "),
        c("AllergyCount").cast("string"),
        F.lit(" allergy match(es)"),
    )
    orders = checked.select(
        "RequestID",
        "EncounterID",
        "PatientID",
        F.lit("MEDICATION").alias("OrderType"),
        c("DrugCode").alias("OrderCode"),
        F.concat(c("DrugName"), F.lit(" "), c("Dosage"), F.lit(" "), c("Route")).alias("OrderDescription"),
        c("PrescribingPhysicianID").alias("OrderingPhysicianID"),
        F.lit("ROUTINE").alias("OrderPriority"),
        F.lit("ORDERED").alias("OrderStatus"),
    )
    medications = checked.select(
        "RequestID",
        "EncounterID",
        "PatientID",
        "DrugCode",
        "DrugName",
        "GenericName",
        "Dosage",
        "Route",
        "Frequency",
        clock.ts.alias("StartDate"),
        "PrescribingPhysicianID",
        F.lit("ACTIVE").alias("MedicationStatus"),
        "InteractionCheckXML",
    )
    return {
        "warnings": warned.select("RequestID", "PatientID", "DrugName", "GenericName", "AllergyCount", "InteractionCheckXML"),
        "audit": audit_rows(warned, "Medications", F.lit(0), "ALLERGY_WARNING", text, by, clock),
        "orders": orders,
        "medications": medications,
    }
