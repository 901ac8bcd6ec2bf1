"""The nightly billing run as one chain of set-based steps."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.operators import billing
from wardline.operators.clinical_reports import c
from wardline.operators.rows import union_all
from wardline.sources.sinks import upsert
from wardline.workspace import stage


@dataclass(frozen=True)
class BillingTables:
    """Inputs of the nightly run."""

    encounters: DataFrame
    patients: DataFrame
    insurers: DataFrame
    procedures: DataFrame
    diagnoses: DataFrame
    physicians: DataFrame
    departments: DataFrame
    chargemaster: DataFrame
    charges: DataFrame
    claims: DataFrame
    invoices: DataFrame
    payments: DataFrame


def log_rows(df: DataFrame, action: str, result: str) -> DataFrame:
    return df.select("EncounterID", F.lit(action).alias("Action"), F.lit(result).alias("Result"))


def nightly_billing(tables: BillingTables, clock: Clock) -> dict[str, DataFrame]:
    """Room charges, procedure charges, claims, submission, self-pay invoices, and a log.

    Posted charges and new claims feed every later step, so both are written once to
    the shared folder instead of being recomputed per output.
    """
    t = tables
    staying = t.encounters.filter(
        (c("EncounterStatus") == "ACTIVE") & c("EncounterType").isin(*billing.ROOM_CODE)
    )
    room = stage(billing.post_room_charges(t.encounters, t.chargemaster, t.charges, clock), "room-charges")
    on_file = t.charges.unionByName(room, allowMissingColumns=True)
    posting = billing.post_encounter_charges(
        t.procedures, staying, t.chargemaster, on_file, t.departments, t.physicians, t.diagnoses, clock
    )
    added = stage(posting["charges"], "procedure-charges")
    fresh = room.unionByName(added, allowMissingColumns=True).withColumn(
        "AdjustmentAmount", F.lit(0).cast("decimal(10,2)")
    )
    posted = t.charges.unionByName(fresh, allowMissingColumns=True)

    claiming = billing.create_claims(t.encounters, t.patients, t.insurers, t.claims, posted, clock)
    created = stage(claiming["claims"], "new-claims")
    all_claims = t.claims.unionByName(created, allowMissingColumns=True)
    submitted = billing.submit_claims(all_claims, clock)
    invoices = billing.self_pay_invoices(posted, all_claims, t.invoices, t.patients, t.payments, clock)

    log = union_all(
        [
            log_rows(room, "ROOM_CHARGE", "SUCCESS"),
            log_rows(posting["unpriced"].select("EncounterID").distinct(), "ROOM_CHARGE", "ERROR"),
            log_rows(created, "CLAIM_CREATED", "SUCCESS"),
        ]
    )
    summary = log.groupBy("Action", "Result").agg(F.count("*").alias("Count"))
    return {
        "room_charges": room,
        "procedure_charges": added,
        "unpriced": posting["unpriced"],
        # From the written charges: those of ``posting`` would be worked out a second time.
        "totals": billing.posted_totals(staying, on_file, added),
        "claims": created,
        "claim_lines": billing.claim_lines(claiming["visits"], posted),
        "billed_charges": claiming["charges"],
        "claim_visits": claiming["visits"],
        "submitted": submitted["claims"],
        "invoices": invoices,
        "log": log,
        "summary": summary,
    }


def after_run(tables: BillingTables, result: dict[str, DataFrame]) -> BillingTables:
    """The tables as the run leaves them, for the next run to start from.

    New charges, claims and invoices are added; charges of claimed visits are BILLED, sent claims
    SUBMITTED with their batch, and visits carry their posted total.
    """
    fresh = result["room_charges"].unionByName(result["procedure_charges"], allowMissingColumns=True)
    fresh = fresh.withColumn("AdjustmentAmount", F.lit(0).cast("decimal(10,2)"))
    charges = tables.charges.unionByName(fresh, allowMissingColumns=True)
    claimed = result["claim_visits"].select("EncounterID", F.lit(True).alias("_claimed"))
    billed = F.when(c("_claimed") & (c("ChargeStatus") == "POSTED"), "BILLED").otherwise(c("ChargeStatus"))
    columns = charges.columns
    charges = charges.join(claimed, "EncounterID", "left").withColumn("ChargeStatus", billed).select(*columns)
    claims = tables.claims.unionByName(result["claims"], allowMissingColumns=True)
    for name in ("SubmittedDate", "EDIBatchID"):
        if name not in claims.columns:
            claims = claims.withColumn(name, F.lit(None).cast(result["submitted"].schema[name].dataType))
    sent = result["submitted"].select("ClaimID", "ClaimStatus", "SubmittedDate", "EDIBatchID")
    return replace(
        tables,
        encounters=upsert(tables.encounters, result["totals"].select("EncounterID", "TotalCharges"), ["EncounterID"]),
        charges=charges,
        claims=upsert(claims, sent, ["ClaimID"]),
        invoices=tables.invoices.unionByName(result["invoices"], allowMissingColumns=True),
    )
