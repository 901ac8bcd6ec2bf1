"""Charge posting, claims, invoices and the receivables jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.dialect import flag, money, sum_or_zero
from wardline.operators.clinical_reports import c
from wardline.operators.lookups import primary_diagnosis
from wardline.operators.management_reports import charge_counts, payment_counts
from wardline.operators.numbering import assign_numbers
from wardline.operators.rows import fold_facts, number_rows
from wardline.sources.sinks import audit_rows
from wardline.workspace import stage

BILLABLE = ("POSTED", "BILLED")
CHARGE_COLUMNS = [
    "EncounterID",
    "PatientID",
    "ChargeCode",
    "CPTCode",
    "RevenueCode",
    "ChargeDescription",
    "ServiceDate",
    "Quantity",
    "UnitPrice",
    "ChargeAmount",
    "DepartmentCode",
    "PerformingPhysicianNPI",
    "DiagnosisCode1",
    "ChargeStatus",
]


def current_fees(chargemaster: DataFrame, clock: Clock) -> DataFrame:
    """One fee row per procedure code valid today: the latest effective one."""
    valid = (
        flag(c("IsActive"))
        & (c("EffectiveDate") <= clock.today)
        & (c("ExpirationDate").isNull() | (c("ExpirationDate") > clock.today))
    )
    row = F.struct("EffectiveDate", "ChargeCode", "RevenueCode", "StandardCharge")
    return (
        chargemaster.filter(valid & c("CPTCode").isNotNull())
        .groupBy("CPTCode")
        .agg(F.max(row).alias("_fee"))
        .select("CPTCode", "_fee.ChargeCode", "_fee.RevenueCode", "_fee.StandardCharge")
    )


#: Days one bin of the fee history covers.
FEE_BIN_DAYS = 64


def fees_by_bin(chargemaster: DataFrame, first: int, last: int, bin_days: int = FEE_BIN_DAYS) -> DataFrame:
    """The fee history cut into bins of days: ``CPTCode, _bin`` and the fees of the code valid on some day of the bin.

    ``first`` and ``last`` bound the bins, so an open end stops at the last bin asked for. A bin holds the fees of
    one code whose validity touches its days, whatever length the history has.
    """
    number = lambda day: F.floor(F.unix_date(day) / bin_days)
    start, end = number(c("EffectiveDate")), number(F.date_sub("ExpirationDate", 1))
    span = F.sequence(F.greatest(start, F.lit(first)), F.least(F.coalesce(end, F.lit(last)), F.lit(last)))
    valid = flag(c("IsActive")) & c("CPTCode").isNotNull() & (c("ExpirationDate").isNull() | (c("ExpirationDate") > c("EffectiveDate")))
    touched = (start <= last) & (end.isNull() | (end >= first))
    fee = F.struct("EffectiveDate", "ChargeCode", "RevenueCode", "StandardCharge", "ExpirationDate")
    cut = chargemaster.filter(valid).filter(touched).select("CPTCode", F.explode(span).alias("_bin"), fee.alias("_fee"))
    return cut.groupBy("CPTCode", "_bin").agg(F.collect_set("_fee").alias("_fees"))


def fees_on_date(rows: DataFrame, chargemaster: DataFrame, day: str, bin_days: int = FEE_BIN_DAYS) -> DataFrame:
    """Rows with ``ChargeCode, RevenueCode, StandardCharge`` of the fee valid on each row's own day; nulls without one.

    Of several valid fees the latest effective one is taken. Rows meet the fees by code and bin of days, an equality
    join, and choose among the few fees of their bin; a code that most rows have is dealt out by its bins.
    """
    of_day = F.to_date(c(day))
    bounds = rows.agg(F.min(of_day).alias("low"), F.max(of_day).alias("high")).first()
    number = lambda d: ((d - date(1970, 1, 1)).days if d else 0) // bin_days
    fees = fees_by_bin(chargemaster, number(bounds["low"]), number(bounds["high"]), bin_days)
    keyed = rows.withColumn("_day", of_day).withColumn("_bin", F.floor(F.unix_date("_day") / bin_days))
    valid = lambda f: (f["EffectiveDate"] <= c("_day")) & (f["ExpirationDate"].isNull() | (f["ExpirationDate"] > c("_day")))
    chosen = keyed.join(fees, ["CPTCode", "_bin"], "left").withColumn("_fee", F.array_max(F.filter("_fees", valid)))
    return chosen.select(*[c(n) for n in rows.columns], "_fee.ChargeCode", "_fee.RevenueCode", "_fee.StandardCharge")


def backdated_charges(procedures: DataFrame, encounters: DataFrame, chargemaster: DataFrame, charges: DataFrame) -> DataFrame:
    """Completed procedures of closed visits that were never charged, at the fee of the day they were done."""
    closed = encounters.filter(c("EncounterStatus") == "DISCHARGED").select("EncounterID")
    posted = charges.filter(c("CPTCode").isNotNull()).select("EncounterID", "CPTCode", c("ServiceDate").alias("ProcedureDate"))
    due = (
        procedures.filter(c("ProcedureStatus") == "COMPLETED")
        .join(closed, "EncounterID", "left_semi")
        .join(posted, ["EncounterID", "CPTCode", "ProcedureDate"], "left_anti")
    )
    return fees_on_date(due, chargemaster, "ProcedureDate").select(
        "ProcedureID", "EncounterID", "CPTCode", c("ProcedureDate").alias("ServiceDate"), "ChargeCode", "RevenueCode", c("StandardCharge").alias("UnitPrice")
    )


def post_encounter_charges(
    procedures: DataFrame,
    encounters: DataFrame,
    chargemaster: DataFrame,
    charges: DataFrame,
    departments: DataFrame,
    physicians: DataFrame,
    diagnoses: DataFrame,
    clock: Clock,
    by: str = "SYSTEM",
) -> dict[str, DataFrame]:
    """Post completed procedures of active visits that have no charge yet.

    Procedures without a valid fee come back as ``unpriced`` instead of failing the run.
    """
    active = encounters.filter(c("EncounterStatus") == "ACTIVE").select("EncounterID", "DepartmentID")
    posted = charges.filter(c("CPTCode").isNotNull()).select(
        "EncounterID", "CPTCode", c("ServiceDate").alias("ProcedureDate")
    )
    # Closed visits go first, so only procedures of active ones are checked for a charge.
    due = (
        procedures.filter(c("ProcedureStatus") == "COMPLETED")
        .join(active, "EncounterID")
        .join(posted, ["EncounterID", "CPTCode", "ProcedureDate"], "left_anti")
    )
    diagnosis = primary_diagnosis(diagnoses.join(active, "EncounterID", "left_semi"))
    priced = (
        due.join(current_fees(chargemaster, clock), "CPTCode", "left")
        .alias("x")
        .join(departments.alias("d"), c("x.DepartmentID") == c("d.DepartmentID"), "left")
        .join(physicians.alias("ph"), c("x.PerformingPhysicianID") == c("ph.PhysicianID"), "left")
        .join(diagnosis.alias("dx"), c("x.EncounterID") == c("dx.EncounterID"), "left")
        .select(
            "x.ProcedureID",
            "x.EncounterID",
            "x.PatientID",
            "x.ChargeCode",
            "x.CPTCode",
            "x.RevenueCode",
            c("x.CPTDescription").alias("ChargeDescription"),
            c("x.ProcedureDate").alias("ServiceDate"),
            F.lit(1).alias("Quantity"),
            c("x.StandardCharge").alias("UnitPrice"),
            c("x.StandardCharge").alias("ChargeAmount"),
            "d.DepartmentCode",
            c("ph.NPI").alias("PerformingPhysicianNPI"),
            c("dx.ICDCode").alias("DiagnosisCode1"),
            F.lit("POSTED").alias("ChargeStatus"),
        )
    )
    added = priced.filter(c("ChargeCode").isNotNull()).select(*CHARGE_COLUMNS)
    unpriced = due.join(current_fees(chargemaster, clock), "CPTCode", "left_anti").select(
        "ProcedureID", "EncounterID", "CPTCode"
    )
    totals = posted_totals(active, charges, added)
    text = F.concat(
        F.lit("Posted "),
        c("Posted").cast("string"),
        F.lit(" charges totaling $"),
        c("TotalCharges").cast("string"),
        F.lit(" for encounter "),
        c("EncounterID").cast("string"),
    )
    audit = audit_rows(totals, "BillingCharges", c("EncounterID"), "CHARGE_POSTING", text, by, clock)
    return {"charges": added, "unpriced": unpriced, "totals": totals, "audit": audit}


def posted_totals(active: DataFrame, charges: DataFrame, added: DataFrame) -> DataFrame:
    """New posted total per active visit: what is on file plus what was just added.

    Charges are folded before they meet the visits, so only one row per visit is shuffled.
    """
    on_file = charges.filter(c("ChargeStatus") == "POSTED")
    totals = active.select("EncounterID").join(
        fold_facts(
            "EncounterID",
            [
                on_file.select("EncounterID", c("ChargeAmount").alias("TotalCharges")),
                added.select("EncounterID", c("ChargeAmount").alias("TotalCharges"), F.lit(1).alias("Posted")),
            ],
            ["TotalCharges", "Posted"],
        ),
        "EncounterID",
        "left",
    )
    return totals.select(
        "EncounterID",
        money(c("TotalCharges")).alias("TotalCharges"),
        F.coalesce("Posted", F.lit(0)).cast("long").alias("Posted"),
    )


# Daily room charge per visit type (fixed values).
ROOM_CODE = {"INPATIENT": "RC-SEMI-PRIV", "OBSERVATION": "RC-OBS"}
ROOM_TEXT = {"INPATIENT": "Room & Board - Semi-Private", "OBSERVATION": "Observation Room"}


def _by_type(values: dict[str, str]) -> Column:
    text = F.lit(None).cast("string")
    for kind, value in values.items():
        text = F.when(c("EncounterType") == kind, value).otherwise(text)
    return text


def post_room_charges(encounters: DataFrame, chargemaster: DataFrame, charges: DataFrame, clock: Clock) -> DataFrame:
    """Today's room charge for open inpatient and observation visits that have none yet."""
    staying = encounters.filter(
        (c("EncounterStatus") == "ACTIVE") & c("EncounterType").isin(*ROOM_CODE)
    ).select("EncounterID", "PatientID", _by_type(ROOM_CODE).alias("ChargeCode"), _by_type(ROOM_TEXT).alias("ChargeDescription"))
    fees = (
        chargemaster.filter(flag(c("IsActive")) & c("ChargeCode").isin(*ROOM_CODE.values()))
        .groupBy("ChargeCode")
        .agg(F.max(F.struct("EffectiveDate", "StandardCharge")).alias("_fee"))
        .select("ChargeCode", c("_fee.StandardCharge").alias("UnitPrice"))
    )
    today = charges.filter(c("ChargeCode").isin(*ROOM_CODE.values()) & clock.is_today(c("ServiceDate")))
    # Two codes, so two fee rows at most: safe to broadcast.
    return (
        staying.join(today.select("EncounterID", "ChargeCode"), ["EncounterID", "ChargeCode"], "left_anti")
        .join(F.broadcast(fees), "ChargeCode")
        .select(
            "EncounterID",
            "PatientID",
            "ChargeCode",
            "ChargeDescription",
            clock.ts.alias("ServiceDate"),
            "UnitPrice",
            c("UnitPrice").alias("ChargeAmount"),
            F.lit("POSTED").alias("ChargeStatus"),
        )
    )


def net_amount() -> Column:
    return c("ChargeAmount") - c("AdjustmentAmount")


def create_claims(
    encounters: DataFrame,
    patients: DataFrame,
    insurers: DataFrame,
    claims: DataFrame,
    charges: DataFrame,
    clock: Clock,
    claim_type: str = "INSTITUTIONAL",
    days_back: int = 1,
) -> dict[str, DataFrame]:
    """Claims and billed charges for insured visits discharged lately without a claim.

    ``visits`` pairs each new claim with its visit, for :func:`claim_lines`.
    """
    insured = patients.filter(c("PrimaryInsuranceID").isNotNull()).select(
        "PatientID", c("PrimaryInsuranceID").alias("InsuranceProviderID"), c("PrimaryPolicyNumber").alias("PolicyNumber"),
        c("PrimaryGroupNumber").alias("GroupNumber"),
    )
    due = (
        encounters.filter((c("EncounterStatus") == "DISCHARGED") & (c("DischargeDate") >= clock.days(-days_back)))
        .join(claims.select("EncounterID"), "EncounterID", "left_anti")
        .select("EncounterID", "PatientID", "PreAuthNumber")
        .join(insured, "PatientID")
    )
    # Headers, totals, lines and status changes all start from these visits and their numbers.
    due = stage(due, "claim-visits")
    keyed = assign_numbers(
        due,
        claims.select("ClaimNumber", "ClaimID"),
        "ClaimNumber",
        [f"CLM-{clock.stamp('%Y%m%d')}-"],
        5,
        ["EncounterID"],
        key="ClaimID",
        staged=True,
    )
    keyed = stage(keyed, "claim-numbers")
    chosen = keyed.select("EncounterID", "ClaimID")
    # Charges are folded first, so that a large visit is never joined row by row.
    billable = charges.filter(c("ChargeStatus").isin(*BILLABLE))
    totals = billable.groupBy("EncounterID").agg(sum_or_zero(net_amount()).alias("TotalCharges"))
    form = "UB04" if claim_type == "INSTITUTIONAL" else "CMS1500"
    headers = (
        keyed.join(totals, "EncounterID", "left")
        .join(insurers.select("InsuranceProviderID", "PayerID"), "InsuranceProviderID", "left")
        .select(
            "ClaimID",
            "ClaimNumber",
            "EncounterID",
            "PatientID",
            "InsuranceProviderID",
            "PayerID",
            "PolicyNumber",
            "GroupNumber",
            F.lit(claim_type).alias("ClaimType"),
            F.lit(form).alias("ClaimForm"),
            F.coalesce("TotalCharges", F.lit(0).cast("decimal(18,2)")).alias("TotalCharges"),
            F.lit("CREATED").alias("ClaimStatus"),
            "PreAuthNumber",
        )
    )
    billed = (
        charges.filter(c("ChargeStatus") == "POSTED")
        .join(chosen, "EncounterID", "left_semi")
        .withColumn("ChargeStatus", F.lit("BILLED"))
    )
    return {"claims": headers, "charges": billed, "visits": keyed.select("EncounterID", "ClaimID")}


def claim_lines(visits: DataFrame, charges: DataFrame) -> DataFrame:
    """Numbered line items of new claims, from the visits they were made for.

    Room charges carry no procedure code; the line then shows the charge code. Visits
    have one claim each, so lines are numbered per visit; only the charges of the claimed
    visits are numbered.
    """
    items = charges.filter(c("ChargeStatus").isin(*BILLABLE)).select(
        "EncounterID",
        "ChargeID",
        "ServiceDate",
        F.coalesce("CPTCode", "ChargeCode").alias("CPTCode"),
        "Quantity",
        net_amount().alias("ChargeAmount"),
    )
    sort, visit = ["ServiceDate", "ChargeID", "CPTCode", "ChargeAmount", "Quantity"], ["EncounterID"]
    entries = items.join(visits, "EncounterID")
    return number_rows(entries, sort, visit, "LineNumber").select(
        "ClaimID",
        "LineNumber",
        "ChargeID",
        c("ServiceDate").cast("date").alias("ServiceDate"),
        "CPTCode",
        F.lit("1").alias("DiagnosisPointer"),
        "Quantity",
        "ChargeAmount",
        F.lit("PENDING").alias("LineStatus"),
    )


def submit_claims(
    claims: DataFrame, clock: Clock, claim_id: int | None = None, sender: str = "HOSPITAL", by: str = "SYSTEM"
) -> dict[str, DataFrame]:
    """CREATED claims as SUBMITTED rows with their outgoing document, and one audit row each."""
    ready = claims.filter(c("ClaimStatus") == "CREATED")
    if claim_id is not None:
        ready = ready.filter(c("ClaimID") == claim_id)
    batch = "EDI-" + clock.stamp("%Y%m%d%H%M%S")
    payer = F.coalesce("PayerID", F.lit("UNKNOWN"))
    blank = " " * 10
    # Outgoing claim document, one segment per line (fixed format).
    segments = [
        F.concat(
            F.lit(f"ISA*00*{blank}*00*{blank}*ZZ*{sender:<15}*ZZ*"),
            payer,
            F.lit(f"*{clock.stamp('%y%m%d')}*{clock.stamp('%H%M')}~"),
        ),
        F.concat(F.lit(f"GS*HC*{sender}*"), payer, F.lit(f"*{clock.stamp('%Y%m%d')}~")),
        F.lit("ST*837*0001~"),
        F.concat(F.lit("CLM*"), c("ClaimNumber"), F.lit("~")),
        F.lit("SE*4*0001~GE*1~IEA*1~"),
    ]
    document = segments[0]
    for segment in segments[1:]:
        document = F.concat(document, F.lit("\r\n"), segment)
    sent = ready.select(
        "ClaimID",
        "ClaimNumber",
        F.lit("SUBMITTED").alias("ClaimStatus"),
        clock.ts.alias("SubmittedDate"),
        F.lit(batch).alias("EDIBatchID"),
        document.alias("EDI837Content"),
    )
    text = F.concat(F.lit("Claim "), c("ClaimNumber"), F.lit(f" submitted in batch {batch}"))
    return {
        "claims": sent,
        "audit": audit_rows(sent, "InsuranceClaims", c("ClaimID"), "CLAIM_SUBMITTED", text, by, clock),
    }


def self_pay_invoices(
    charges: DataFrame,
    claims: DataFrame,
    invoices: DataFrame,
    patients: DataFrame,
    payments: DataFrame,
    clock: Clock,
) -> DataFrame:
    """Invoices for posted visits of uninsured patients with neither claim nor invoice.

    Charges and payments are folded per visit in one shuffle before any join.
    """
    visit = ["PatientID", "EncounterID"]
    net = fold_two(
        charges.filter(c("ChargeStatus").isin(*BILLABLE)).select(
            *visit, net_amount().alias("_charged"), F.when(c("ChargeStatus") == "POSTED", 1).alias("_posted")
        ),
        payments.filter(c("PaymentStatus").isin("POSTED", "APPLIED")).select(*visit, c("PaymentAmount").alias("_paid")),
        visit,
    )
    balance = money(c("_charged") - F.coalesce("_paid", F.lit(0)))
    insured = patients.filter(c("PrimaryInsuranceID").isNotNull()).select("PatientID")
    due = (
        net.filter((c("_posted") > 0) & c("EncounterID").isNotNull())
        .select(*visit, balance.alias("TotalAmount"))
        .filter(c("TotalAmount") > 0)
        .join(claims.select("EncounterID"), "EncounterID", "left_anti")
        .join(invoices.select("EncounterID"), "EncounterID", "left_anti")
        .join(insured, "PatientID", "left_anti")
    )
    due = stage(due, "self-pay-visits")
    keyed = assign_numbers(
        due,
        invoices.select("InvoiceNumber", "InvoiceID"),
        "InvoiceNumber",
        [f"INV-{clock.stamp('%Y%m')}-"],
        5,
        ["EncounterID", "PatientID"],
        key="InvoiceID",
        staged=True,
    )
    return keyed.select(
        "InvoiceID",
        "InvoiceNumber",
        "PatientID",
        "EncounterID",
        clock.today.alias("InvoiceDate"),
        clock.date_in_days(30).alias("DueDate"),
        "TotalAmount",
        F.lit(0).cast("decimal(18,2)").alias("PaidAmount"),
        F.lit("OPEN").alias("InvoiceStatus"),
    )


def fold_two(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Sum the measures of two facts per composite key with one shuffle."""
    stacked = first.unionByName(second, allowMissingColumns=True)
    return stacked.groupBy(*key).agg(*[F.sum(m).alias(m) for m in stacked.columns if m not in key])


def reconcile_encounters(encounters: DataFrame, charges: DataFrame, payments: DataFrame, clock: Clock) -> DataFrame:
    """Net charges, payments and balance of last year's active and discharged visits."""
    scope = encounters.filter(
        c("EncounterStatus").isin("ACTIVE", "DISCHARGED") & (c("AdmitDate") >= clock.years(-1))
    ).select("EncounterID")
    # Folding the facts first shuffles one row per visit; filtering them to the scope first
    # would shuffle every row.
    sums = fold_two(
        charges.filter(charge_counts()).select("EncounterID", net_amount().alias("TotalCharges")),
        payments.filter(payment_counts()).select("EncounterID", c("PaymentAmount").alias("TotalPayments")),
        ["EncounterID"],
    )
    zero = F.lit(0)
    charged, paid = F.coalesce("TotalCharges", zero), F.coalesce("TotalPayments", zero)
    return scope.join(sums, "EncounterID", "left").select(
        "EncounterID",
        money(charged).alias("TotalCharges"),
        money(paid).alias("TotalPayments"),
        money(charged - paid).alias("PatientBalance"),
    )


def default_plans(plans: DataFrame, clock: Clock) -> DataFrame:
    """Active payment plans more than 60 days late."""
    late = plans.filter((c("PlanStatus") == "ACTIVE") & (c("NextPaymentDate") < late_limit(clock, 60)))
    return late.select(
        "PaymentPlanID", "PatientID", F.lit("DEFAULTED").alias("PlanStatus"), clock.ts.alias("DefaultedDate")
    )


def late_limit(clock: Clock, days: int) -> Column:
    """First date that is not before now minus the days: a midnight counts as earlier than a later time that day."""
    whole_day = clock.now == clock.day_start
    return clock.date_in_days(-days if whole_day else 1 - days)


def send_to_collections(invoices: DataFrame, clock: Clock) -> DataFrame:
    """Open invoices more than 120 days overdue with a balance above 50."""
    overdue = invoices.filter(
        (c("InvoiceStatus") == "OPEN")
        & (c("DueDate") < clock.date_in_days(-120))
        & (c("TotalAmount") - c("PaidAmount") > 50)
    )
    return overdue.select(
        "InvoiceID",
        "PatientID",
        F.lit("COLLECTIONS").alias("InvoiceStatus"),
        F.lit(1).alias("SentToCollections"),
        clock.ts.alias("CollectionDate"),
        money(c("TotalAmount") - c("PaidAmount")).alias("BalanceDue"),
    )


def adjudicate_claims(claims: DataFrame, clock: Clock) -> DataFrame:
    """Claims submitted more than 14 days ago, allowed at 80 percent."""
    waiting = claims.filter(
        (c("ClaimStatus") == "SUBMITTED") & clock.older_than_days(c("SubmittedDate"), 14)
    )
    allowed = (c("TotalCharges") * F.lit("0.80").cast("decimal(3,2)")).cast("decimal(12,2)")
    return waiting.select(
        "ClaimID",
        F.lit("ADJUDICATED").alias("ClaimStatus"),
        clock.ts.alias("AdjudicatedDate"),
        allowed.alias("AllowedAmount"),
    )


def appeal_claims(claims: DataFrame, audit: DataFrame, clock: Clock, by: str = "SYSTEM") -> dict[str, DataFrame]:
    """Denied claims to appeal in time, and one APPEAL_EXPIRED audit row per claim past its deadline.

    A claim already audited as expired is not logged again on later runs.
    """
    denied = claims.filter(c("ClaimStatus") == "DENIED")
    appealed = denied.filter(
        c("AppealDeadline").between(clock.date_in_days(1), clock.date_in_days(30)) & (c("TotalCharges") > 500)
    ).select("ClaimID", F.lit("APPEALED").alias("ClaimStatus"), clock.ts.alias("AppealedDate"))
    logged = audit.filter((c("TableName") == "InsuranceClaims") & (c("Action") == "APPEAL_EXPIRED"))
    expired = denied.filter(c("AppealDeadline") < late_limit(clock, 0)).join(
        logged.select(c("RecordID").alias("ClaimID")), "ClaimID", "left_anti"
    )
    text = F.concat(
        F.lit("Claim "),
        c("ClaimNumber"),
        F.lit(" denial is past appeal deadline ($"),
        c("TotalCharges").cast("string"),
        F.lit(")"),
    )
    return {
        "claims": appealed,
        "audit": audit_rows(expired, "InsuranceClaims", c("ClaimID"), "APPEAL_EXPIRED", text, by, clock),
    }
