"""Clinical report views: patients, census, orders, results, medications, workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.clinical import age_exact
from wardline.functions.dialect import (
    as_bit,
    day_diff,
    flag,
    last_first,
    minute_diff,
    money,
    with_credentials,
    year_diff,
)
from wardline.operators.allergies import flag_conflicts
from wardline.operators.rows import fold_facts

PENDING = ("ORDERED", "IN_PROGRESS")


def c(name: str) -> Column:
    return F.col(name)


def name_of(alias: str) -> Column:
    return last_first(c(f"{alias}.LastName"), c(f"{alias}.FirstName"))


def physician_name(alias: str) -> Column:
    return with_credentials(c(f"{alias}.LastName"), c(f"{alias}.FirstName"), c(f"{alias}.Credentials"))


def count_if(condition: Column) -> Column:
    return F.when(condition, 1)


def or_zero(name: str) -> Column:
    return F.coalesce(c(name), F.lit(0)).cast("long").alias(name)


def with_insurer(patients: DataFrame, insurers: DataFrame) -> DataFrame:
    """Patients (alias p) with their primary insurer (alias ip), if any."""
    return patients.alias("p").join(
        insurers.alias("ip"), c("p.PrimaryInsuranceID") == c("ip.InsuranceProviderID"), "left"
    )


def active_patients(patients: DataFrame, insurers: DataFrame, clock: Clock) -> DataFrame:
    live = patients.filter((c("PatientStatus") == "ACTIVE") & ~flag(c("DeceasedIndicator")))
    return with_insurer(live, insurers).select(
        "p.PatientID",
        "p.MRN",
        "p.FirstName",
        "p.MiddleName",
        "p.LastName",
        "p.DateOfBirth",
        age_exact(c("p.DateOfBirth"), clock.today).alias("Age"),
        "p.Gender",
        "p.Address1",
        "p.City",
        "p.State",
        "p.ZipCode",
        "p.HomePhone",
        "p.MobilePhone",
        "p.Email",
        c("ip.ProviderName").alias("PrimaryInsurance"),
        "p.PrimaryPolicyNumber",
        c("p.CreatedDate").alias("RegistrationDate"),
    )


def inpatient_census(
    encounters: DataFrame,
    patients: DataFrame,
    physicians: DataFrame,
    departments: DataFrame,
    insurers: DataFrame,
    medications: DataFrame,
    orders: DataFrame,
    clock: Clock,
) -> DataFrame:
    """Open inpatient and observation visits with their drug and order counts."""
    open_visits = encounters.filter(
        (c("EncounterStatus") == "ACTIVE") & c("EncounterType").isin("INPATIENT", "OBSERVATION")
    )
    counts = fold_facts(
        "EncounterID",
        [
            medications.filter(c("MedicationStatus") == "ACTIVE").select(
                "EncounterID", F.lit(1).alias("ActiveMedicationCount")
            ),
            orders.filter(c("OrderStatus").isin(*PENDING)).select("EncounterID", F.lit(1).alias("PendingOrderCount")),
        ],
        ["ActiveMedicationCount", "PendingOrderCount"],
    )
    return (
        open_visits.join(counts, "EncounterID", "left")
        .alias("e")
        .join(patients.alias("p"), c("e.PatientID") == c("p.PatientID"))
        .join(physicians.alias("ph"), c("e.AttendingPhysicianID") == c("ph.PhysicianID"))
        .join(departments.alias("d"), c("e.DepartmentID") == c("d.DepartmentID"), "left")
        .join(insurers.alias("ip"), c("p.PrimaryInsuranceID") == c("ip.InsuranceProviderID"), "left")
        .select(
            "e.EncounterID",
            "e.EncounterNumber",
            "p.PatientID",
            "p.MRN",
            name_of("p").alias("PatientName"),
            "p.DateOfBirth",
            year_diff(c("p.DateOfBirth"), clock.ts).alias("Age"),
            "p.Gender",
            "e.EncounterType",
            "e.AdmitDate",
            day_diff(c("e.AdmitDate"), clock.ts).alias("LengthOfStay"),
            "e.RoomNumber",
            "e.BedNumber",
            "d.DepartmentName",
            physician_name("ph").alias("AttendingPhysician"),
            "e.AdmitDiagnosis",
            c("ip.ProviderName").alias("Insurance"),
            "e.TotalCharges",
            or_zero("ActiveMedicationCount"),
            or_zero("PendingOrderCount"),
        )
    )


def pending_lab_orders(
    orders: DataFrame,
    encounters: DataFrame,
    patients: DataFrame,
    physicians: DataFrame,
    departments: DataFrame,
    clock: Clock,
) -> DataFrame:
    waiting = orders.filter((c("OrderType") == "LAB") & c("OrderStatus").isin(*PENDING))
    return (
        waiting.alias("o")
        .join(encounters.alias("e"), c("o.EncounterID") == c("e.EncounterID"))
        .join(patients.alias("p"), c("o.PatientID") == c("p.PatientID"))
        .join(physicians.alias("ph"), c("o.OrderingPhysicianID") == c("ph.PhysicianID"))
        .join(departments.alias("d"), c("e.DepartmentID") == c("d.DepartmentID"), "left")
        .select(
            "o.OrderID",
            "o.EncounterID",
            "p.MRN",
            name_of("p").alias("PatientName"),
            "o.OrderCode",
            "o.OrderDescription",
            "o.OrderPriority",
            "o.IsStatOrder",
            "o.OrderDate",
            minute_diff(c("o.OrderDate"), clock.ts).alias("MinutesSinceOrdered"),
            name_of("ph").alias("OrderingPhysician"),
            "d.DepartmentName",
            "e.RoomNumber",
            "e.BedNumber",
        )
    )


def critical_and_current() -> Column:
    return flag(c("CriticalFlag")) & c("ResultStatus").isin("PRELIMINARY", "FINAL")


def critical_lab_results(
    labs: DataFrame, encounters: DataFrame, patients: DataFrame, physicians: DataFrame, clock: Clock
) -> DataFrame:
    return (
        labs.filter(critical_and_current())
        .alias("r")
        .join(encounters.alias("e"), c("r.EncounterID") == c("e.EncounterID"))
        .join(patients.alias("p"), c("r.PatientID") == c("p.PatientID"))
        .join(physicians.alias("ph"), c("e.AttendingPhysicianID") == c("ph.PhysicianID"))
        .select(
            "r.LabResultID",
            "p.MRN",
            name_of("p").alias("PatientName"),
            "e.RoomNumber",
            "e.BedNumber",
            "r.TestCode",
            "r.TestName",
            "r.ResultValue",
            "r.ResultUnit",
            "r.AbnormalFlag",
            "r.ReferenceRangeLow",
            "r.ReferenceRangeHigh",
            "r.ReportedDate",
            minute_diff(c("r.ReportedDate"), clock.ts).alias("MinutesSinceReported"),
            name_of("ph").alias("AttendingPhysician"),
            c("ph.Phone").alias("PhysicianPhone"),
        )
    )


def active_medications(
    medications: DataFrame, patients: DataFrame, physicians: DataFrame, allergies: DataFrame, clock: Clock
) -> DataFrame:
    live = medications.filter(c("MedicationStatus") == "ACTIVE")
    return (
        flag_conflicts(live, allergies, "PotentialAllergyConflict")
        .alias("m")
        .join(patients.alias("p"), c("m.PatientID") == c("p.PatientID"))
        .join(physicians.alias("ph"), c("m.PrescribingPhysicianID") == c("ph.PhysicianID"))
        .select(
            "m.MedicationID",
            "p.MRN",
            name_of("p").alias("PatientName"),
            "m.DrugCode",
            "m.DrugName",
            "m.GenericName",
            "m.DrugClass",
            "m.Dosage",
            "m.DosageUnit",
            "m.Route",
            "m.Frequency",
            "m.StartDate",
            day_diff(c("m.StartDate"), clock.ts).alias("DaysOnMedication"),
            name_of("ph").alias("PrescribingPhysician"),
            "m.IsControlledSubstance",
            "m.DEASchedule",
            "m.PharmacyVerified",
            "m.PotentialAllergyConflict",
        )
    )


def patient_encounter_summary(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Every patient with lifetime visit counts, dates and amounts.

    The visits are folded per patient before the join, so only one row per patient
    is shuffled however many visits a patient has. The visit number is the key of
    the visits, hence a plain count of it is the distinct count.
    """
    kind = c("EncounterType")
    per_patient = encounters.groupBy("PatientID").agg(
        F.count("EncounterID").alias("TotalEncounters"),
        F.count_if(kind == "INPATIENT").alias("InpatientCount"),
        F.count_if(kind == "OUTPATIENT").alias("OutpatientCount"),
        F.count_if(kind == "EMERGENCY").alias("EmergencyCount"),
        F.min("AdmitDate").alias("FirstVisitDate"),
        F.max("AdmitDate").alias("LastVisitDate"),
        F.sum("TotalCharges").alias("LifetimeCharges"),
        F.sum("TotalPayments").alias("LifetimePayments"),
        F.sum("PatientBalance").alias("OutstandingBalance"),
        F.max(as_bit(c("EncounterStatus") == "ACTIVE")).alias("HasActiveEncounter"),
    )

    def amount(name: str) -> Column:
        return money(F.coalesce(c(name), F.lit(0))).alias(name)

    return (
        patients.alias("p")
        .join(per_patient, "PatientID", "left")
        .select(
            "PatientID",
            "MRN",
            name_of("p").alias("PatientName"),
            "DateOfBirth",
            "Gender",
            "PatientStatus",
            or_zero("TotalEncounters"),
            or_zero("InpatientCount"),
            or_zero("OutpatientCount"),
            or_zero("EmergencyCount"),
            "FirstVisitDate",
            "LastVisitDate",
            amount("LifetimeCharges"),
            amount("LifetimePayments"),
            amount("OutstandingBalance"),
            F.coalesce("HasActiveEncounter", F.lit(0)).alias("HasActiveEncounter"),
        )
    )


def physician_workload(
    physicians: DataFrame,
    departments: DataFrame,
    encounters: DataFrame,
    orders: DataFrame,
    notes: DataFrame,
    clock: Clock,
) -> DataFrame:
    measures = ["ActivePatientCount", "TodaysOrderCount", "UnsignedNoteCount", "MonthlyEncounterCount"]
    active, this_month = c("EncounterStatus") == "ACTIVE", c("AdmitDate") >= clock.month_start
    counts = fold_facts(
        "PhysicianID",
        [
            encounters.filter(active | this_month).select(
                c("AttendingPhysicianID").alias("PhysicianID"),
                count_if(active).alias("ActivePatientCount"),
                count_if(this_month).alias("MonthlyEncounterCount"),
            ),
            orders.filter(clock.is_today(c("OrderDate"))).select(
                c("OrderingPhysicianID").alias("PhysicianID"), F.lit(1).alias("TodaysOrderCount")
            ),
            notes.filter(c("NoteStatus") == "DRAFT").select(
                c("AuthorID").alias("PhysicianID"), F.lit(1).alias("UnsignedNoteCount")
            ),
        ],
        measures,
    )
    return (
        physicians.filter(flag(c("IsActive")))
        .join(counts, "PhysicianID", "left")
        .alias("ph")
        .join(departments.alias("d"), c("ph.DepartmentID") == c("d.DepartmentID"), "left")
        .select(
            "ph.PhysicianID",
            "ph.NPI",
            physician_name("ph").alias("PhysicianName"),
            "ph.Specialty",
            "d.DepartmentName",
            *[or_zero(m) for m in measures],
        )
    )


def department_statistics(
    departments: DataFrame, encounters: DataFrame, physicians: DataFrame, clock: Clock
) -> DataFrame:
    """Census, 30-day average stay, month charges and physicians per active department."""
    active = c("EncounterStatus") == "ACTIVE"
    left_lately = (c("EncounterStatus") == "DISCHARGED") & (c("DischargeDate") >= clock.days(-30))
    this_month = c("AdmitDate") >= clock.month_start
    stay = day_diff(c("AdmitDate"), c("DischargeDate"))
    folded = fold_facts(
        "DepartmentID",
        [
            encounters.filter(active | left_lately | this_month).select(
                "DepartmentID",
                count_if(active).alias("CurrentCensus"),
                F.when(left_lately, stay).alias("_days"),
                count_if(left_lately & stay.isNotNull()).alias("_stays"),
                F.when(this_month, c("TotalCharges")).alias("MonthlyCharges"),
            ),
            physicians.filter(flag(c("IsActive"))).select("DepartmentID", F.lit(1).alias("ActivePhysicianCount")),
        ],
        ["CurrentCensus", "_days", "_stays", "MonthlyCharges", "ActivePhysicianCount"],
    )
    return (
        departments.filter(flag(c("IsActive")))
        .join(folded, "DepartmentID", "left")
        .select(
            "DepartmentID",
            "DepartmentCode",
            "DepartmentName",
            "FloorNumber",
            or_zero("CurrentCensus"),
            (c("_days").cast("double") / c("_stays")).alias("AvgLengthOfStay30Days"),
            money(F.coalesce("MonthlyCharges", F.lit(0))).alias("MonthlyCharges"),
            or_zero("ActivePhysicianCount"),
            "IsActive",
        )
    )
