"""Management report views: finances, census, productivity, revenue cycle, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.clock import Clock
from wardline.functions.dialect import day_diff, flag, minute_diff, money, second_index
from wardline.operators.clinical_reports import (
    c,
    count_if,
    critical_and_current,
    name_of,
    or_zero,
    physician_name,
    with_insurer,
)
from wardline.operators.rows import fold_facts, stack_totals


def charge_counts() -> Column:
    """Charges that were not voided; a null status is left out."""
    return c("ChargeStatus") != "VOIDED"


def payment_counts() -> Column:
    return c("PaymentStatus") != "VOIDED"


def amount_or_zero(name: str) -> Column:
    return money(F.coalesce(c(name), F.lit(0))).alias(name)


def patient_financial_summary(
    patients: DataFrame,
    insurers: DataFrame,
    encounters: DataFrame,
    charges: DataFrame,
    payments: DataFrame,
    claims: DataFrame,
    invoices: DataFrame,
    collections: DataFrame,
) -> DataFrame:
    """Ten lifetime figures per patient from six facts, folded with one shuffle."""
    counts = ["TotalEncounters", "ActiveEncounters", "TotalClaims", "DeniedClaims"]
    amounts = [
        "TotalCharges",
        "TotalAdjustments",
        "TotalPayments",
        "InsurancePaidTotal",
        "OutstandingBalance",
        "InCollections",
    ]
    folded = fold_facts(
        "PatientID",
        [
            encounters.select(
                "PatientID",
                F.lit(1).alias("TotalEncounters"),
                count_if(c("EncounterStatus") == "ACTIVE").alias("ActiveEncounters"),
            ),
            charges.filter(charge_counts()).select(
                "PatientID", c("ChargeAmount").alias("TotalCharges"), c("AdjustmentAmount").alias("TotalAdjustments")
            ),
            payments.filter(payment_counts()).select("PatientID", c("PaymentAmount").alias("TotalPayments")),
            claims.select(
                "PatientID",
                F.lit(1).alias("TotalClaims"),
                count_if(c("ClaimStatus") == "DENIED").alias("DeniedClaims"),
                F.when(c("ClaimStatus").isin("PAID", "PARTIAL_PAID"), c("PaidAmount")).alias("InsurancePaidTotal"),
            ),
            invoices.filter(c("InvoiceStatus") == "OPEN").select(
                "PatientID", (c("TotalAmount") - c("PaidAmount")).alias("OutstandingBalance")
            ),
            collections.filter(c("CollectionStatus") == "ACTIVE").select(
                "PatientID", c("OriginalBalance").alias("InCollections")
            ),
        ],
        counts + amounts,
    )
    return (
        with_insurer(patients, insurers)
        .join(folded.alias("f"), c("p.PatientID") == c("f.PatientID"), "left")
        .select(
            "p.PatientID",
            "p.MRN",
            name_of("p").alias("PatientName"),
            "p.DateOfBirth",
            "p.PatientStatus",
            c("ip.ProviderName").alias("PrimaryInsurance"),
            "p.PrimaryPolicyNumber",
            *[or_zero(n) for n in counts],
            *[amount_or_zero(n) for n in amounts],
        )
    )


def hospital_census(
    departments: DataFrame, encounters: DataFrame, rooms: DataFrame, assignments: DataFrame, clock: Clock
) -> DataFrame:
    """Per active department: open visits by kind, rooms, today's movements, current stay."""
    active = c("EncounterStatus") == "ACTIVE"
    kinds = {"InpatientCount": "INPATIENT", "ObservationCount": "OBSERVATION", "EmergencyCount": "EMERGENCY"}
    admitted, left = clock.is_today(c("AdmitDate")), clock.is_today(c("DischargeDate"))
    visits = fold_facts(
        "DepartmentID",
        [
            encounters.filter(active | admitted | left).select(
                "DepartmentID",
                *[count_if(active & (c("EncounterType") == kind)).alias(name) for name, kind in kinds.items()],
                count_if(admitted).alias("AdmissionsToday"),
                count_if(left).alias("DischargesToday"),
                F.when(active, day_diff(c("AdmitDate"), clock.ts)).alias("_days"),
                count_if(active & c("AdmitDate").isNotNull()).alias("_stays"),
            )
        ],
        [*kinds, "AdmissionsToday", "DischargesToday", "_days", "_stays"],
    )
    # Room use is counted per room before it meets the rooms, so a hot room is one row.
    in_use = (
        assignments.filter(c("AssignmentStatus") == "ACTIVE").groupBy("RoomID").agg(F.count("*").alias("OccupiedRooms"))
    )
    per_code = (
        rooms.join(in_use, "RoomID", "left")
        .groupBy("DepartmentCode")
        .agg(F.count_if(flag(c("IsActive"))).alias("TotalRooms"), F.sum("OccupiedRooms").alias("OccupiedRooms"))
    )
    return (
        departments.filter(flag(c("IsActive")))
        .join(visits, "DepartmentID", "left")
        .join(per_code, "DepartmentCode", "left")
        .select(
            "DepartmentName",
            "DepartmentCode",
            "FloorNumber",
            *[or_zero(n) for n in kinds],
            or_zero("TotalRooms"),
            or_zero("OccupiedRooms"),
            or_zero("AdmissionsToday"),
            or_zero("DischargesToday"),
            (c("_days").cast("double") / c("_stays")).alias("AvgCurrentLOS"),
        )
    )


def physician_productivity(
    physicians: DataFrame,
    departments: DataFrame,
    encounters: DataFrame,
    orders: DataFrame,
    procedures: DataFrame,
    charges: DataFrame,
    appointments: DataFrame,
    notes: DataFrame,
    clock: Clock,
) -> DataFrame:
    """Month and year figures per active physician; charges are matched on the NPI."""
    month, year = clock.month_start, clock.year_start
    month_day = month.cast("date")
    booked = ~c("AppointmentStatus").isin("CANCELLED", "NO_SHOW")
    by_id = ["MonthlyEncounters", "MonthlyOrders", "MonthlyProcedures"]
    by_booking = ["MonthlyAppointments", "MonthlyNoShows", "UnsignedNotes"]

    def one(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(c(key).alias("PhysicianID"), F.lit(1).alias(name))

    activity = fold_facts(
        "PhysicianID",
        [
            one(encounters.filter(c("AdmitDate") >= month), "AttendingPhysicianID", "MonthlyEncounters"),
            one(orders.filter(c("OrderDate") >= month), "OrderingPhysicianID", "MonthlyOrders"),
            one(
                procedures.filter((c("ProcedureDate") >= month) & (c("ProcedureStatus") == "COMPLETED")),
                "PerformingPhysicianID",
                "MonthlyProcedures",
            ),
            appointments.filter(c("AppointmentDate") >= month_day).select(
                "PhysicianID",
                count_if(booked).alias("MonthlyAppointments"),
                count_if(c("AppointmentStatus") == "NO_SHOW").alias("MonthlyNoShows"),
            ),
            one(notes.filter(c("NoteStatus") == "DRAFT"), "AuthorID", "UnsignedNotes"),
        ],
        by_id + by_booking,
    )
    # The month lies inside the year, so the year bound is the one pushed to the scan.
    billed = (
        charges.filter((c("ServiceDate") >= year) & charge_counts())
        .groupBy(c("PerformingPhysicianNPI").alias("NPI"))
        .agg(
            F.sum(F.when(c("ServiceDate") >= month, c("ChargeAmount"))).alias("MonthlyCharges"),
            F.sum("ChargeAmount").alias("YTDCharges"),
        )
    )
    return (
        physicians.filter(flag(c("IsActive")))
        .join(activity, "PhysicianID", "left")
        .join(billed, "NPI", "left")
        .alias("ph")
        .join(departments.alias("d"), c("ph.DepartmentID") == c("d.DepartmentID"), "left")
        .select(
            "ph.PhysicianID",
            "ph.NPI",
            physician_name("ph").alias("PhysicianName"),
            "ph.Specialty",
            "d.DepartmentName",
            *[or_zero(n) for n in by_id],
            amount_or_zero("MonthlyCharges"),
            amount_or_zero("YTDCharges"),
            *[or_zero(n) for n in by_booking],
        )
    )


# --- revenue cycle: each block is one aggregate over one fact ---------------------------


def total(amount: Column, condition: Column, name: str) -> Column:
    return money(F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))).alias(name)


def charge_flow(charges: DataFrame, clock: Clock) -> DataFrame:
    posted, amount = c("PostedDate"), c("ChargeAmount")
    recent = charges.filter(charge_counts() & (posted >= clock.year_start))
    return recent.agg(
        total(amount, clock.is_today(posted), "TodayCharges"),
        total(amount, posted >= clock.month_start, "MTDCharges"),
        total(amount, F.lit(True), "YTDCharges"),
    )


def payment_flow(payments: DataFrame, clock: Clock) -> DataFrame:
    posted, amount = c("PostedDate"), c("PaymentAmount")
    recent = payments.filter(payment_counts() & (posted >= clock.month_start))
    return recent.agg(
        total(amount, clock.is_today(posted), "TodayPayments"), total(amount, F.lit(True), "MTDPayments")
    )


def claim_queue(claims: DataFrame) -> DataFrame:
    status = c("ClaimStatus")
    return claims.filter(status.isin("CREATED", "SUBMITTED", "DENIED")).agg(
        F.count_if(status == "CREATED").alias("ClaimsPendingSubmission"),
        F.count_if(status == "SUBMITTED").alias("ClaimsSubmitted"),
        F.count_if(status == "DENIED").alias("ClaimsDenied"),
        total(c("TotalCharges"), status == "DENIED", "DeniedClaimsValue"),
    )


def receivables_ageing(invoices: DataFrame, clock: Clock) -> DataFrame:
    """Open balances by days since the invoice date; future dates fall in the first band."""
    age = day_diff(c("InvoiceDate"), clock.today)
    balance = c("TotalAmount") - c("PaidAmount")
    return invoices.filter(c("InvoiceStatus") == "OPEN").agg(
        total(balance, age <= 30, "AR_0_30"),
        total(balance, age.between(31, 60), "AR_31_60"),
        total(balance, age.between(61, 90), "AR_61_90"),
        total(balance, age > 90, "AR_Over90"),
    )


def collection_totals(collections: DataFrame) -> DataFrame:
    return collections.filter(c("CollectionStatus") == "ACTIVE").agg(
        F.count("*").alias("ActiveCollectionAccounts"),
        total(c("CurrentBalance"), F.lit(True), "TotalInCollections"),
    )


def visit_volume(encounters: DataFrame, clock: Clock) -> DataFrame:
    active, today = c("EncounterStatus") == "ACTIVE", clock.is_today(c("AdmitDate"))
    return encounters.filter(active | today).agg(
        F.count_if(active).alias("CurrentActiveEncounters"), F.count_if(today).alias("TodayAdmissions")
    )


def revenue_cycle_summary(
    charges: DataFrame,
    payments: DataFrame,
    claims: DataFrame,
    invoices: DataFrame,
    collections: DataFrame,
    encounters: DataFrame,
    clock: Clock,
) -> DataFrame:
    blocks = [
        charge_flow(charges, clock),
        payment_flow(payments, clock),
        claim_queue(claims),
        receivables_ageing(invoices, clock),
        collection_totals(collections),
        visit_volume(encounters, clock),
    ]
    return stack_totals(blocks).select(clock.today.alias("ReportDate"), "*")


# --- quality metrics -------------------------------------------------------------------


def rate(hits: Column, base: Column) -> Column:
    """Percentage to two places, null over an empty base."""
    return F.when(base > 0, (hits.cast("decimal(18,0)") * 100 / base).cast("decimal(5,2)"))


READMISSION_DAYS = 30
_BUCKET_SECONDS = READMISSION_DAYS * 86_400


def _bucket(moment: Column) -> Column:
    return F.floor(second_index(moment) / F.lit(_BUCKET_SECONDS)).cast("long")


def readmission_flags(encounters: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Inpatient discharges in [start, end] with whether another inpatient visit followed in 30 days.

    An open bound takes everything on that side.

    Time is cut into 30-day buckets. A later admission in the discharge's own bucket is
    within reach whenever it is not before the discharge, so the latest admission
    decides; in the next bucket the earliest one decides. Two candidates per patient
    and bucket (the visit itself may be one) answer the question exactly, and Spark
    trims to those two before the shuffle: no patient's visits are ever paired up.
    """
    inpatient = encounters.filter(c("EncounterType") == "INPATIENT")
    discharged = (c("EncounterStatus") == "DISCHARGED") & c("DischargeDate").isNotNull()
    admitted = c("AdmitDate").isNotNull()
    if start is not None:
        discharged, admitted = discharged & (c("DischargeDate") >= start), admitted & (c("AdmitDate") >= start)
    if end is not None:
        last = end + F.expr(f"INTERVAL '{READMISSION_DAYS}' DAY")
        discharged, admitted = discharged & (c("DischargeDate") <= end), admitted & (c("AdmitDate") <= last)
    index = inpatient.filter(discharged).select(
        "EncounterID", "PatientID", "AdmitDate", "DischargeDate", _bucket(c("DischargeDate")).alias("_bucket")
    )
    admissions = inpatient.filter(admitted).select("PatientID", "EncounterID", "AdmitDate", _bucket(c("AdmitDate")).alias("_bucket"))

    def candidates(order: list[Column], prefix: str, shift: int) -> DataFrame:
        window = Window.partitionBy("PatientID", "_bucket").orderBy(*order)
        best = admissions.withColumn("_rank", F.row_number().over(window)).filter(c("_rank") <= 2)
        row = F.struct("AdmitDate", "EncounterID")
        return (
            best.groupBy("PatientID", "_bucket")
            .agg(
                F.max(F.when(c("_rank") == 1, row)).alias(f"{prefix}1"),
                F.max(F.when(c("_rank") == 2, row)).alias(f"{prefix}2"),
            )
            .withColumn("_bucket", c("_bucket") - shift)
        )

    latest = candidates([c("AdmitDate").desc(), c("EncounterID")], "_late", 0)
    earliest = candidates([c("AdmitDate"), c("EncounterID")], "_early", 1)

    def reached(candidate: str) -> Column:
        admit = c(f"{candidate}.AdmitDate")
        within = admit.between(
            c("DischargeDate"), c("DischargeDate") + F.expr(f"INTERVAL '{READMISSION_DAYS}' DAY")
        )
        return F.coalesce((c(f"{candidate}.EncounterID") != c("EncounterID")) & within, F.lit(False))

    found = reached("_late1") | reached("_late2") | reached("_early1") | reached("_early2")
    return (
        index.join(latest, ["PatientID", "_bucket"], "left")
        .join(earliest, ["PatientID", "_bucket"], "left")
        .select("EncounterID", "PatientID", "AdmitDate", "DischargeDate", found.cast("int").alias("Readmitted"))
    )


def readmission_rate(encounters: DataFrame, clock: Clock) -> DataFrame:
    flags = readmission_flags(encounters, clock.days(-90), clock.days(-30))
    return flags.agg(rate(F.sum("Readmitted"), F.count("*")).alias("ReadmissionRate30Day"))


def average_stay(encounters: DataFrame, clock: Clock) -> DataFrame:
    """Average inpatient stay in days over the last calendar month."""
    gone = encounters.filter(
        (c("EncounterType") == "INPATIENT")
        & (c("EncounterStatus") == "DISCHARGED")
        & (c("DischargeDate") >= clock.months(-1))
    )
    return gone.agg(F.avg(day_diff(c("AdmitDate"), c("DischargeDate")).cast("double")).alias("AvgLOS_Last30Days"))


def ed_time_to_first_order(encounters: DataFrame, orders: DataFrame, clock: Clock) -> DataFrame:
    visits = encounters.filter((c("EncounterType") == "EMERGENCY") & (c("AdmitDate") >= clock.days(-30)))
    # Only the orders of these visits matter, so the visits meet the orders before the
    # minimum is taken: the short list filters the large table.
    first = (
        orders.select("EncounterID", "OrderDate")
        .join(visits.select("EncounterID", "AdmitDate"), "EncounterID")
        .groupBy("EncounterID", "AdmitDate")
        .agg(F.min("OrderDate").alias("_first"))
    )
    wait = minute_diff(c("AdmitDate"), c("_first")).cast("double")
    return first.agg(F.avg(wait).alias("AvgEDTimeToFirstOrder_Minutes"))


def unsigned_notes(notes: DataFrame, clock: Clock) -> DataFrame:
    return notes.filter(c("NoteStatus") == "DRAFT").agg(
        F.count("*").alias("TotalUnsignedNotes"),
        F.count_if(clock.older_than_days(c("NoteDate"), 7)).alias("UnsignedNotesOver7Days"),
    )


def critical_lab_age(labs: DataFrame, clock: Clock) -> DataFrame:
    recent = labs.filter(critical_and_current() & (c("ReportedDate") >= clock.days(-30)))
    return recent.agg(
        F.avg(minute_diff(c("ReportedDate"), clock.ts).cast("double")).alias("AvgCriticalLabAge_Minutes")
    )


def allergy_warning_count(audit: DataFrame, clock: Clock) -> DataFrame:
    recent = audit.filter((c("Action") == "ALLERGY_WARNING") & (c("ChangedDate") >= clock.days(-30)))
    return recent.agg(F.count("*").alias("AllergyWarningsLast30Days"))


def claim_denial_rate(claims: DataFrame, clock: Clock) -> DataFrame:
    recent = claims.filter(c("SubmittedDate") >= clock.months(-3))
    return recent.agg(
        rate(F.count_if(c("ClaimStatus") == "DENIED"), F.count("*")).alias("ClaimDenialRate_Last90Days")
    )


def quality_metrics(
    encounters: DataFrame,
    orders: DataFrame,
    notes: DataFrame,
    labs: DataFrame,
    audit: DataFrame,
    claims: DataFrame,
    clock: Clock,
) -> DataFrame:
    blocks = [
        readmission_rate(encounters, clock),
        average_stay(encounters, clock),
        ed_time_to_first_order(encounters, orders, clock),
        unsigned_notes(notes, clock),
        critical_lab_age(labs, clock),
        allergy_warning_count(audit, clock),
        claim_denial_rate(claims, clock),
    ]
    return stack_totals(blocks).select(clock.today.alias("ReportDate"), "*")
