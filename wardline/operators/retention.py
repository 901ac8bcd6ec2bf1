"""Archival, purging and the reporting extract."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.dialect import last_first
from wardline.operators.clinical_reports import c
from wardline.operators.rows import fold_facts, union_all
from wardline.workspace import stage

RETENTION_MONTHS = 84


def archive_batch(
    encounters: DataFrame, clock: Clock, retention_months: int = RETENTION_MONTHS, batch: int | None = None
) -> DataFrame:
    """All discharged visits past retention, or the oldest ``batch`` of them."""
    old = encounters.filter(
        (c("EncounterStatus") == "DISCHARGED")
        & (c("DischargeDate") < clock.date_in_months(-retention_months).cast("timestamp_ntz"))
    ).select("EncounterID", "PatientID", "AdmitDate", "DischargeDate")
    if batch is None:
        return old
    return old.orderBy("DischargeDate", "EncounterID").limit(batch)


def archive_encounters(
    encounters: DataFrame,
    children: dict[str, DataFrame],
    clock: Clock,
    retention_months: int = RETENTION_MONTHS,
    batch: int | None = None,
    dry_run: bool = True,
) -> dict[str, DataFrame]:
    """Split each child table into moved and kept rows and mark the visits ARCHIVED.

    The chosen visits are written once and read by every output. Moved and kept rows of a child are a semi and an
    anti join with them, each read for itself. A dry run returns only the log of what would move.
    """
    chosen = stage(archive_batch(encounters, clock, retention_months, batch), "archive-visits")
    log = chosen.select(
        "EncounterID",
        "PatientID",
        "AdmitDate",
        F.lit("WOULD_ARCHIVE" if dry_run else "ARCHIVED").alias("ArchiveStatus"),
    )
    result = {"log": log, "summary": log.groupBy("ArchiveStatus").agg(F.count("*").alias("RecordCount"))}
    if dry_run:
        return result
    keys = chosen.select("EncounterID")
    for name, child in children.items():
        result[f"moved_{name}"] = child.join(keys, "EncounterID", "left_semi").select(*child.columns)
        result[f"kept_{name}"] = child.join(keys, "EncounterID", "left_anti").select(*child.columns)
    marked = encounters.join(keys.withColumn("_old", F.lit(True)), "EncounterID", "left")
    before = c("ModifiedDate") if "ModifiedDate" in encounters.columns else F.lit(None).cast("timestamp_ntz")
    changed = {
        "EncounterStatus": F.when(c("_old"), "ARCHIVED").otherwise(c("EncounterStatus")),
        "ModifiedDate": F.when(c("_old"), clock.ts).otherwise(before),
    }
    result["encounters"] = marked.withColumns(changed).drop("_old")
    return result


def archive_counts(
    encounters: DataFrame,
    children: dict[str, DataFrame],
    clock: Clock,
    retention_months: int = RETENTION_MONTHS,
    batch: int | None = None,
) -> DataFrame:
    """Rows moved and kept per child table, all children folded to one row per visit before the join."""
    keys = stage(archive_batch(encounters, clock, retention_months, batch), "archive-visits").select(
        "EncounterID", F.lit(True).alias("_old")
    )
    # One fold with a count per table: a task keeps one hash table of visits, not one for every table.
    counts = [f"_n{i}" for i in range(len(children))]
    held = fold_facts("EncounterID", [child.select("EncounterID", F.lit(1).alias(n)) for n, child in zip(counts, children.values())], counts)
    side = F.when(c("_old"), "moved").otherwise("kept").alias("Side")
    sums = held.join(keys, "EncounterID", "left").groupBy(side).agg(*[F.sum(n).alias(n) for n in counts])
    entries = F.array(*[F.struct(F.lit(name).alias("TableName"), c(n).alias("Rows")) for n, name in zip(counts, children)])
    counted = sums.select("Side", F.explode(entries).alias("_c")).select("Side", "_c.*")
    # A side without rows is listed with 0; the names come from the caller.
    all_sides = F.explode(F.array(*[F.struct(F.lit(n).alias("TableName"), F.lit(s).alias("Side")) for n in children for s in ("moved", "kept")]))
    listed = held.sparkSession.range(1).select(all_sides.alias("_s")).select("_s.*")
    return listed.join(counted, ["TableName", "Side"], "left").withColumn("Rows", F.coalesce("Rows", F.lit(0)).cast("long"))


def purge_billing(
    invoices: DataFrame,
    charges: DataFrame,
    encounters: DataFrame,
    audits: dict[str, DataFrame],
    clock: Clock,
    retention_months: int = RETENTION_MONTHS,
) -> dict[str, DataFrame]:
    """Split invoices, charges and audit logs into purged and kept rows.

    The kept rows are the negated condition, not a second join; rows whose condition
    is unknown are kept.
    """
    cutoff = clock.date_in_months(-retention_months)
    closed = F.coalesce(
        c("InvoiceStatus").isin("PAID", "WRITTEN_OFF", "VOIDED") & (c("InvoiceDate") < cutoff), F.lit(False)
    )
    old = c("ServiceDate") < cutoff.cast("timestamp_ntz")
    live = encounters.filter(c("EncounterStatus") != "ARCHIVED").select("EncounterID")
    # Only old charges can go, so only they meet the visits.
    aged = charges.filter(old)
    result = {
        "purged_invoices": invoices.filter(closed),
        "kept_invoices": invoices.filter(~closed),
        "purged_charges": aged.join(live, "EncounterID", "left_anti").select(*charges.columns),
        "kept_charges": charges.filter(~F.coalesce(old, F.lit(False))).unionByName(
            aged.join(live, "EncounterID", "left_semi")
        ),
    }
    for name, audit in audits.items():
        stale = F.coalesce(c("ChangedDate") < clock.years(-3), F.lit(False))
        result[f"purged_{name}"] = audit.filter(stale)
        result[f"kept_{name}"] = audit.filter(~stale)
    return result


# Commercial rate as a share of the standard charge (fixed value).
COMMERCIAL_SHARE = Decimal("0.85")


def sync_chargemaster(chargemaster: DataFrame) -> DataFrame:
    """Fee rows copied for billing, with the commercial rate derived."""
    return chargemaster.select(
        "ChargeCode",
        "CPTCode",
        "RevenueCode",
        "ChargeDescription",
        "StandardCharge",
        "MedicareRate",
        "MedicaidRate",
        (c("StandardCharge") * F.lit(COMMERCIAL_SHARE)).cast("decimal(10,2)").alias("CommercialRate"),
        "EffectiveDate",
    )


def appointment_extract(appointments: DataFrame, patients: DataFrame, rooms: DataFrame) -> DataFrame:
    """Appointments with patient name, first known phone, and the first exam room.

    The room is a scalar looked up once, so nothing is cross joined.
    """
    room = rooms.filter(c("RoomType") == "EXAM").agg(F.min(F.struct("RoomNumber", "RoomID"))["RoomID"]).scalar()
    return appointments.join(patients, "PatientID").select(
        "AppointmentID",
        "PatientID",
        "PhysicianID",
        "AppointmentDate",
        "AppointmentType",
        "AppointmentStatus",
        room.alias("RoomID"),
        last_first(c("LastName"), c("FirstName")).alias("PatientName"),
        F.coalesce("MobilePhone", "HomePhone").alias("PatientPhone"),
    )


def split_counts(result: dict[str, DataFrame], names: list[str], moved: str, kept: str) -> DataFrame:
    """Rows moved and kept per table, one aggregate each."""
    parts = []
    for name in names:
        for side in (moved, kept):
            counted = result[f"{side}_{name}"].agg(F.count("*").alias("Rows"))
            parts.append(counted.select(F.lit(name).alias("TableName"), F.lit(side).alias("Side"), "Rows"))
    return union_all(parts)
