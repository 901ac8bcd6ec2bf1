"""Aggregates kept per day, that reports read instead of the facts.

Two kinds are kept, and both merge over days and loads: bitmaps of whole-number ids for distinct counts, and sums of
signed rows for counts and amounts. A load adds its own rows to the store; rows that come late name their old day,
and a changed row is the old version with a minus and the new one with a plus. A load written twice replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.clock import Clock
from wardline.functions.dialect import day_diff
from wardline.operators.clinical_reports import c
from wardline.operators.management_reports import total
from wardline.operators.rows import union_all
from wardline.sources.sinks import write_partitioned

# --- distinct counts -----------------------------------------------------------------


def daily_bitmaps(facts: DataFrame, day: Column, by: list[str], ids: dict[str, Column]) -> DataFrame:
    """``Day``, the group columns, ``Measure``, ``Piece``, ``Bits``: the ids of each measure seen on a day in a group.

    An id is one bit of a piece of 32,768 neighbouring ids, so ids should be running numbers. Null ids are left out.
    Repeated ids are folded in every task first, so a row repeated any number of times is shuffled as one; a bitmap is
    then made from at most as many rows as it has bits, and no bitmaps are sorted or shuffled for it.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("Measure"), value.cast("long").alias("_id")) for name, value in ids.items()])
    seen = facts.select(day.alias("Day"), *by, F.explode(entries).alias("_e")).select("Day", *by, "_e.*").filter(c("_id").isNotNull())
    piece = ["Day", *by, "Measure", "Piece"]
    ids_once = seen.withColumn("Piece", F.bitmap_bucket_number("_id")).distinct()
    return ids_once.repartition(*piece).groupBy(*piece).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("Bits"))


#: Bitmaps of 4 KB that one task merges: 64 MB to sort.
BITMAPS_PER_TASK = 16_384


def distinct_counts(bitmaps: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Distinct ids per group over all days and loads of the bitmaps, a column per measure.

    Bitmaps are 4 KB each to sort but next to nothing compressed, so they are dealt by their number, not by their bytes.
    """
    tasks = max(1, -(-bitmaps.count() // BITMAPS_PER_TASK))
    pieces = bitmaps.repartition(tasks, *by, "Measure", "Piece").groupBy(*by, "Measure", "Piece").agg(F.bitmap_or_agg("Bits").alias("Bits"))
    counted = pieces.withColumn("_n", F.bitmap_count("Bits"))
    return counted.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(c("Measure") == m, c("_n"))), F.lit(0)).cast("long").alias(m) for m in measures]
    )


# --- sums ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fact:
    """What of a table is kept: the day and state rows are folded by, and the amount that is summed."""

    day: Callable[[], Column]
    status: str
    amount: Callable[[], Column]


REVENUE_FACTS = {
    "charges": Fact(lambda: F.to_date("PostedDate"), "ChargeStatus", lambda: c("ChargeAmount")),
    "payments": Fact(lambda: F.to_date("PostedDate"), "PaymentStatus", lambda: c("PaymentAmount")),
    "claims": Fact(lambda: F.to_date("CreatedDate"), "ClaimStatus", lambda: c("TotalCharges")),
    "invoices": Fact(lambda: F.to_date("InvoiceDate"), "InvoiceStatus", lambda: c("TotalAmount") - c("PaidAmount")),
    "collections": Fact(lambda: F.lit(None).cast("date"), "CollectionStatus", lambda: c("CurrentBalance")),
    "encounters": Fact(lambda: F.to_date("AdmitDate"), "EncounterStatus", lambda: F.lit(0)),
}
SIGN = "_sign"


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """A table's changed rows as signed rows: the old versions taken away, the new ones added."""
    return old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


def fold_load(tables: dict[str, DataFrame], facts: dict[str, Fact] = REVENUE_FACTS) -> DataFrame:
    """``Fact, Day, Status, Rows, Amount`` of the rows of one load; a ``_sign`` of -1 takes a row away."""
    parts = []
    for name, df in tables.items():
        fact = facts[name]
        sign = c(SIGN) if SIGN in df.columns else F.lit(1)
        amount = (fact.amount() * sign).cast("decimal(18,2)")
        parts.append(df.select(F.lit(name).alias("Fact"), fact.day().alias("Day"), c(fact.status).alias("Status"), sign.alias("_n"), amount.alias("_amount")))
    return union_all(parts).groupBy("Fact", "Day", "Status").agg(
        F.sum("_n").cast("long").alias("Rows"), F.sum("_amount").cast("decimal(28,2)").alias("Amount")
    )


def add_load(store: str, load: str, folded: DataFrame) -> None:
    """Keep a load's rows in the store, in place of what the same load wrote before."""
    write_partitioned(folded.withColumn("Load", F.lit(load)), store, ["Load"])


def revenue_cycle(kept: DataFrame, clock: Clock) -> DataFrame:
    """``management_reports.revenue_cycle_summary`` from the kept sums of all loads."""
    status, amount, rows = c("Status"), c("Amount"), c("Rows")
    of = lambda fact, condition: (c("Fact") == fact) & condition
    on_or_after = lambda bound: c("Day") >= F.to_date(bound)
    today = c("Day") == clock.today
    live_charge, live_payment = of("charges", status != "VOIDED"), of("payments", status != "VOIDED")
    age = day_diff(c("Day"), clock.today)
    open_invoice = of("invoices", status == "OPEN")

    def count(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("long").alias(name)

    return kept.agg(
        total(amount, live_charge & today, "TodayCharges"),
        total(amount, live_charge & on_or_after(clock.month_start), "MTDCharges"),
        total(amount, live_charge & on_or_after(clock.year_start), "YTDCharges"),
        total(amount, live_payment & today, "TodayPayments"),
        total(amount, live_payment & on_or_after(clock.month_start), "MTDPayments"),
        count(of("claims", status == "CREATED"), "ClaimsPendingSubmission"),
        count(of("claims", status == "SUBMITTED"), "ClaimsSubmitted"),
        count(of("claims", status == "DENIED"), "ClaimsDenied"),
        total(amount, of("claims", status == "DENIED"), "DeniedClaimsValue"),
        total(amount, open_invoice & (age <= 30), "AR_0_30"),
        total(amount, open_invoice & age.between(31, 60), "AR_31_60"),
        total(amount, open_invoice & age.between(61, 90), "AR_61_90"),
        total(amount, open_invoice & (age > 90), "AR_Over90"),
        count(of("collections", status == "ACTIVE"), "ActiveCollectionAccounts"),
        total(amount, of("collections", status == "ACTIVE"), "TotalInCollections"),
        count(of("encounters", status == "ACTIVE"), "CurrentActiveEncounters"),
        count(of("encounters", today), "TodayAdmissions"),
    ).select(clock.today.alias("ReportDate"), "*")
