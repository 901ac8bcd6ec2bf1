"""Snapshot differences, constraint checks, orphans, profiles and code quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.clock import Clock
from wardline.functions.clinical import (
    age_exact,
    bmi,
    bmi_category,
    egfr,
    icd10_shape_ok,
    icd10_strict_ok,
    normalize_drug,
)
from wardline.functions.dialect import xml_attributes
from wardline.operators.clinical_reports import c
from wardline.operators.rows import union_all
from wardline.workspace import stage


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, table: str, clock: Clock, by: str = "SYSTEM") -> DataFrame:
    """INSERT, UPDATE and DELETE audit rows between two versions of a table with a unique key."""
    columns = [n for n in old.columns if n in new.columns]
    left = old.select(*columns).withColumn("_there", F.lit(True)).alias("o")
    right = new.select(*columns).withColumn("_there", F.lit(True)).alias("n")
    joined = left.join(right, c(f"o.{key}") == c(f"n.{key}"), "full")
    changed = F.lit(False)
    for name in columns:
        changed = changed | ~c(f"o.{name}").eqNullSafe(c(f"n.{name}"))
    had, has = c("o._there").isNotNull(), c("n._there").isNotNull()
    action = F.when(had & has, "UPDATE").when(has, "INSERT").otherwise("DELETE")
    return joined.filter(changed).select(
        F.lit(table).alias("TableName"),
        F.coalesce(c(f"o.{key}"), c(f"n.{key}")).alias("RecordID"),
        action.alias("Action"),
        F.when(had, xml_attributes("OldRecord", {n: c(f"o.{n}") for n in columns})).alias("OldValues"),
        F.when(has, xml_attributes("NewRecord", {n: c(f"n.{n}") for n in columns})).alias("NewValues"),
        F.lit(by).alias("ChangedBy"),
        clock.ts.alias("ModifiedDate"),
    )


def range_digests(df: DataFrame, key: str, columns: list[str], width: int) -> DataFrame:
    """Order-independent digest of the rows of every range of keys.

    ``_range, _rows, _sum, _mix``: rows, the sum of a hash of each row, and the exclusive or of another hash. The sum
    tells rows that come twice, which cancel out in the other; both hash all columns together, so that values changed
    between rows or columns count. Rows are folded in their own task first.
    """
    row = F.xxhash64(*columns, *[c(n).isNull() for n in columns])
    other = F.xxhash64(F.lit("other"), *[c(n).isNull() for n in columns], *columns)
    return df.groupBy(key_range(df, key, width).alias("_range")).agg(
        F.count("*").alias("_rows"), F.sum(row.cast("decimal(38,0)")).alias("_sum"), F.bit_xor(other).alias("_mix")
    )


def key_range(df: DataFrame, key: str, width: int) -> Column:
    """Number of a row's range: neighbouring whole numbers lie together, other keys are dealt by hash. Null keys have their own."""
    dealt = F.floor(c(key) / width) if isinstance(df.schema[key].dataType, T.IntegralType) else F.pmod(F.xxhash64(key), F.lit(1 << 20))
    return F.coalesce(F.when(c(key).isNotNull(), dealt), F.lit(-(1 << 62)))


def changed_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ranges whose digests differ, or that only one side has."""
    joined = old.alias("o").join(new.alias("n"), c("o._range").eqNullSafe(c("n._range")), "full")
    same = [c(f"o.{n}").eqNullSafe(c(f"n.{n}")) for n in ("_rows", "_sum", "_mix")]
    return joined.filter(~(same[0] & same[1] & same[2])).select(F.coalesce("o._range", "n._range").alias("_range"))


#: Keys in one range of a digest.
RANGE_WIDTH = 1024


def snapshot_diff_by_range(
    old: DataFrame,
    new: DataFrame,
    key: str,
    table: str,
    clock: Clock,
    by: str = "SYSTEM",
    width: int = RANGE_WIDTH,
    old_digests: DataFrame | None = None,
) -> DataFrame:
    """``snapshot_diff`` that joins only the ranges of keys in which something changed.

    Both versions are read once for their digests; ``old_digests``, kept from the last comparison, saves the older
    one's. Rows of equal ranges never meet: the join gets the rows of changed ranges, of which there are as many as
    the change touches. The few range numbers are left to Spark's size check for broadcasting.
    """
    columns = [n for n in old.columns if n in new.columns]
    before = range_digests(old, key, columns, width) if old_digests is None else old_digests
    changed = changed_ranges(before, range_digests(new, key, columns, width))
    chosen = [
        df.withColumn("_range", key_range(df, key, width)).join(changed, "_range", "left_semi").drop("_range") for df in (old, new)
    ]
    return snapshot_diff(*chosen, key, table, clock, by)


@dataclass(frozen=True)
class Rules:
    """Declared constraints of one table."""

    domains: dict[str, tuple[str, ...]]
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = None
    unique: tuple[str | tuple[str, ...], ...] = ()


# Allowed values, declared lengths, required and unique columns (fixed values).
CONSTRAINTS: dict[str, Rules] = {
    "patients": Rules(
        {"Gender": ("M", "F", "U"), "PatientStatus": ("ACTIVE", "INACTIVE", "DECEASED", "MERGED")},
        ("MRN", "FirstName", "LastName", "DateOfBirth", "Gender"),
        {"MRN": 20, "SSN": 11, "FirstName": 50, "LastName": 50},
        ("PatientID", "MRN"),
    ),
    "encounters": Rules(
        {
            "EncounterType": ("INPATIENT", "OUTPATIENT", "EMERGENCY", "OBSERVATION"),
            "EncounterStatus": ("ACTIVE", "DISCHARGED", "CANCELLED", "PREADMIT"),
        },
        ("PatientID", "EncounterType", "AdmitDate"),
        {"EncounterNumber": 20, "RoomNumber": 10},
        ("EncounterID", "EncounterNumber"),
    ),
    "orders": Rules(
        {
            "OrderType": ("LAB", "RADIOLOGY", "MEDICATION", "DIET", "CONSULT", "PROCEDURE"),
            "OrderPriority": ("STAT", "URGENT", "ROUTINE", "TIMED"),
            "OrderStatus": ("ORDERED", "IN_PROGRESS", "COMPLETED", "CANCELLED", "DISCONTINUED"),
        },
        ("EncounterID", "PatientID", "OrderType"),
        {"OrderCode": 20},
        ("OrderID",),
    ),
    "medications": Rules(
        {"MedicationStatus": ("ACTIVE", "COMPLETED", "DISCONTINUED", "ON_HOLD")},
        ("EncounterID", "PatientID", "DrugName"),
        {"DrugName": 200},
        ("MedicationID",),
    ),
    "lab_results": Rules(
        {"ResultStatus": ("PRELIMINARY", "FINAL", "CORRECTED", "CANCELLED")},
        ("PatientID", "TestCode"),
        {"TestCode": 20, "AbnormalFlag": 5},
        ("LabResultID",),
    ),
    "diagnoses": Rules(
        {"DiagnosisType": ("ADMITTING", "PRIMARY", "SECONDARY", "WORKING")}, ("ICDCode",), {"ICDCode": 10}, ("DiagnosisID",)
    ),
    "allergies": Rules(
        {
            "AllergyType": ("DRUG", "FOOD", "ENVIRONMENTAL", "LATEX", "CONTRAST"),
            "Severity": ("MILD", "MODERATE", "SEVERE", "LIFE_THREATENING"),
        },
        ("PatientID", "AllergenName"),
        {"AllergenName": 200},
        ("AllergyID",),
    ),
    "audit_log": Rules({}, ("TableName", "Action"), {"Action": 10}, ("AuditLogID",)),
    "billing_audit": Rules({}, ("TableName", "Action"), {"Action": 20}, ("AuditID",)),
    "billing_charges": Rules(
        {"ChargeStatus": ("POSTED", "BILLED", "PAID", "ADJUSTED", "VOIDED", "TRANSFERRED")},
        ("EncounterID", "ChargeCode", "ChargeAmount"),
        {"CPTCode": 10},
        ("ChargeID",),
    ),
    "insurance_claims": Rules(
        {
            "ClaimStatus": (
                "CREATED",
                "SUBMITTED",
                "ACKNOWLEDGED",
                "ADJUDICATED",
                "PAID",
                "PARTIAL_PAID",
                "DENIED",
                "APPEALED",
                "VOIDED",
            )
        },
        ("EncounterID", "ClaimNumber"),
        {"ClaimNumber": 20},
        ("ClaimID", "ClaimNumber"),
    ),
    "payments": Rules(
        {"PaymentStatus": ("POSTED", "APPLIED", "VOIDED", "REFUNDED")}, ("PatientID", "PaymentAmount"), {}, ("PaymentID",)
    ),
    "invoices": Rules(
        {"InvoiceStatus": ("OPEN", "PAID", "PARTIAL", "COLLECTIONS", "WRITTEN_OFF", "VOIDED")},
        ("PatientID", "InvoiceNumber"),
        {"InvoiceNumber": 20},
        ("InvoiceID", "InvoiceNumber"),
    ),
    "procedures": Rules(
        {"ProcedureStatus": ("SCHEDULED", "IN_PROGRESS", "COMPLETED", "CANCELLED")},
        ("EncounterID", "CPTCode"),
        {"CPTCode": 10},
        ("ProcedureID",),
    ),
    "clinical_notes": Rules(
        {"NoteStatus": ("DRAFT", "SIGNED", "COSIGNED", "AMENDED", "ADDENDED")}, ("EncounterID", "AuthorID"), {}, ("NoteID",)
    ),
    "radiology_studies": Rules(
        {"StudyStatus": ("ORDERED", "SCHEDULED", "IN_PROGRESS", "COMPLETED", "DICTATED", "FINAL", "CANCELLED")},
        ("EncounterID", "PatientID"),
        {},
        ("StudyID",),
    ),
    "room_assignments": Rules(
        {"AssignmentStatus": ("ACTIVE", "TRANSFERRED", "DISCHARGED", "CANCELLED")},
        ("EncounterID", "RoomID"),
        {},
        ("AssignmentID",),
    ),
    "staff_schedules": Rules(
        {
            "ShiftType": ("DAY", "EVENING", "NIGHT", "ON_CALL", "SPLIT"),
            "ScheduleStatus": ("SCHEDULED", "CONFIRMED", "CANCELLED", "CALLED_OFF", "SWAPPED"),
        },
        (),
        {},
        ("ScheduleID",),
    ),
    "waiting_list": Rules(
        {"WaitListStatus": ("WAITING", "NOTIFIED", "SCHEDULED", "CANCELLED", "EXPIRED")}, (), {}, ("WaitListID",)
    ),
    "payment_plans": Rules({"PlanStatus": ("ACTIVE", "COMPLETED", "DEFAULTED", "CANCELLED")}, ("PatientID",), {}, ("PaymentPlanID",)),
    "collections": Rules(
        {"CollectionStatus": ("ACTIVE", "RECOVERED", "WRITTEN_OFF", "RECALLED")}, ("InvoiceID",), {}, ("CollectionID",)
    ),
    "chargemaster": Rules(
        {},
        ("ChargeCode", "ChargeDescription", "StandardCharge", "EffectiveDate"),
        {"ChargeCode": 20, "ChargeDescription": 500},
        (("ChargeCode", "EffectiveDate"),),
    ),
    "rooms": Rules(
        {"RoomType": ("EXAM", "OR", "PROCEDURE", "IMAGING", "CONFERENCE", "OFFICE", "ICU", "NICU", "ED_BAY")},
        ("RoomNumber",),
        {"RoomNumber": 10},
        ("RoomID", "RoomNumber"),
    ),
    "appointments": Rules(
        {
            "AppointmentType": (
                "NEW_PATIENT",
                "FOLLOW_UP",
                "PROCEDURE",
                "CONSULT",
                "URGENT",
                "TELEHEALTH",
                "LAB",
                "IMAGING",
            ),
            "AppointmentStatus": (
                "SCHEDULED",
                "CONFIRMED",
                "CHECKED_IN",
                "ROOMED",
                "IN_PROGRESS",
                "COMPLETED",
                "CANCELLED",
                "NO_SHOW",
                "RESCHEDULED",
            ),
        },
        ("PatientID", "PhysicianID"),
        {},
        ("AppointmentID",),
    ),
}


def check_constraints(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """Violations per rule: allowed values, required columns, lengths (one pass) and duplicate keys (another).

    A null passes the allowed-value rule, as a check constraint does. A unique key may have several
    columns; rows with a null in it are not compared. Keys of one whole number are folded 64 neighbours
    to a row, all others as (key, value) pairs; the table is read once for each kind.
    """
    tests: dict[tuple[str, str], Column] = {}
    for name, allowed in rules.domains.items():
        tests[("DOMAIN", name)] = ~c(name).isin(*allowed)
    for name in rules.required:
        tests[("REQUIRED", name)] = c(name).isNull()
    for name, limit in (rules.lengths or {}).items():
        tests[("LENGTH", name)] = F.length(name) > limit
    labels = list(tests)
    counted = df.agg(*[F.count_if(test).alias(f"v{i}") for i, test in enumerate(tests.values())])
    entries = [
        F.struct(F.lit(rule).alias("Rule"), F.lit(name).alias("ColumnName"), c(f"v{i}").alias("Violations"))
        for i, (rule, name) in enumerate(labels)
    ]
    keys = {key if isinstance(key, str) else "+".join(key): [key] if isinstance(key, str) else list(key) for key in rules.unique}
    entries += [
        F.struct(F.lit("UNIQUE").alias("Rule"), F.lit(k).alias("ColumnName"), F.lit(0).cast("long").alias("Violations")) for k in keys
    ]
    single = counted.select(F.explode(F.array(*entries)).alias("_v")).select("_v.*")
    if not keys:
        return single.select(F.lit(table).alias("TableName"), "*")
    whole = [label for label, names in keys.items() if len(names) == 1 and _whole(df, names[0])]
    parts = []
    if whole:
        words = distinct_words(df, whole).groupBy("ColumnName")
        parts.append(words.agg((F.sum("Rows") - F.sum("DistinctValues")).alias("Violations")))
    values = [
        F.struct(F.lit(label).alias("ColumnName"), F.when(_none_null(names), F.to_json(F.struct(*names))).alias("v"))
        for label, names in keys.items()
        if label not in whole
    ]
    if values:
        held = df.select(F.explode(F.array(*values)).alias("_v")).select("_v.*").filter(c("v").isNotNull()).groupBy("ColumnName", "v")
        parts.append(held.agg((F.count("*") - 1).alias("Violations")).select("ColumnName", "Violations"))
    repeated = union_all(parts).select(F.lit("UNIQUE").alias("Rule"), "ColumnName", "Violations")
    summed = single.unionByName(repeated).groupBy("Rule", "ColumnName").agg(F.sum("Violations").alias("Violations"))
    return summed.select(F.lit(table).alias("TableName"), "*")


def distinct_words(df: DataFrame, names: list[str]) -> DataFrame:
    """``ColumnName, Rows, DistinctValues`` of the whole numbers or dates in each 64 neighbours that hold one; nulls are left out.

    The rows of a column add up to its figures. A bit stands for each value, so running numbers shuffle one row for
    64 of them, and numbers far apart one row for each.
    """
    dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    numbers = df.select(*[(F.unix_date(c(n)) if n in dates else c(n)).cast("long").alias(n) for n in names])
    pairs = numbers.unpivot([], names, "ColumnName", "v").filter(c("v").isNotNull())
    words = pairs.groupBy("ColumnName", F.shiftright("v", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(v & 63 AS INT))")).alias("bits"), F.count("*").alias("Rows")
    )
    return words.select("ColumnName", "Rows", F.bit_count("bits").cast("long").alias("DistinctValues"))


def distinct_values(df: DataFrame) -> DataFrame:
    """``ColumnName, DistinctValues`` of every column with a value, counted exactly; of texts ``Held, Low, High`` too.

    Columns of one type are stacked and folded as that type. Least and greatest texts are looked for among the
    distinct ones only, which are far fewer as a rule; ``Held`` are the rows with a value.
    """
    words, typed = [], {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.IntegralType, T.DateType)):
            words.append(field.name)
        else:
            kept = isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DecimalType))
            typed.setdefault(field.dataType if kept else T.StringType(), []).append(field.name)
    counted, texts = [], []
    if words:
        counted.append(distinct_words(df, words).select("ColumnName", "DistinctValues"))
    for kind, names in typed.items():
        pairs = df.select(*[c(n).cast(kind).alias(n) for n in names]).unpivot([], names, "ColumnName", "v").filter(c("v").isNotNull())
        if kind == T.StringType():
            texts.append(pairs.groupBy("ColumnName", "v").agg(F.count("*").alias("Rows")))
        else:
            counted.append(pairs.distinct().select("ColumnName", F.lit(1).cast("long").alias("DistinctValues")))
    parts = [union_all(counted).groupBy("ColumnName").agg(F.sum("DistinctValues").alias("DistinctValues"))] if counted else []
    figures = [F.count("*").alias("DistinctValues"), F.sum("Rows").alias("Held"), F.min("v").alias("Low"), F.max("v").alias("High")]
    parts += [folded.groupBy("ColumnName").agg(*figures) for folded in texts]
    nothing = {"Held": F.lit(None).cast("long"), "Low": F.lit(None).cast("string"), "High": F.lit(None).cast("string")}
    parts = [p if "Held" in p.columns else p.withColumns(nothing) for p in parts]
    return union_all(parts)


def _none_null(names: list[str]) -> Column:
    found = F.lit(True)
    for name in names:
        found = found & c(name).isNotNull()
    return found


def all_orphans(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str]]) -> DataFrame:
    """Keys without a parent row over many references ``(child, column, parent, column)``, with how many rows use each.

    References between whole numbers are compared 64 neighbouring keys to a row first; only the child tables of those
    that miss a key are read again, for the rows that use it. Other keys are stacked as (reference, key) pairs and
    folded. So are the parents' keys, and one join finds what is missing.
    """
    numbers, others = [], []
    for i, r in enumerate(references):
        (numbers if _whole(tables[r[0]], r[1]) & _whole(tables[r[2]], r[3]) else others).append((i, r))
    parts = [_missing_numbers(tables, numbers)] if numbers else []
    if others:
        parts.append(_missing(tables, others, "string"))
    labels = F.array(*[F.lit(f"{child}.{column}") for child, column, _, _ in references])
    return union_all(parts).select(F.element_at(labels, c("_reference") + 1).alias("Reference"), "Key", "Rows")


def _whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _missing_numbers(tables: dict[str, DataFrame], references: list[tuple[int, tuple]]) -> DataFrame:
    """``_reference, Key, Rows`` of the missing keys of references between whole numbers."""
    parents = list(dict.fromkeys((parent, key) for _, (_, _, parent, key) in references))
    children: dict[str, dict[int, str]] = {}
    for number, (child, column, _, _) in references:
        children.setdefault(child, {})[number] = column
    known: dict[str, dict[int, str]] = {}
    for number, (parent, key) in enumerate(parents):
        known.setdefault(parent, {})[number] = key
    of = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(parents.index((r[2], r[3]))).alias("p")) for n, r in references])
    parent_of = F.filter(of, lambda x: x["n"] == c("_reference"))[0]["p"]
    used = union_all([_key_words(_numbered(tables[child], columns, "_reference"), "_reference") for child, columns in children.items()])
    there = union_all([_key_words(_numbered(tables[parent], columns, "_parent"), "_parent") for parent, columns in known.items()])
    there = there.withColumnRenamed("_bits", "_there")
    joined = used.withColumn("_parent", parent_of).join(there, ["_parent", "_word"], "left")
    lost = c("_bits").bitwiseAND(F.bitwise_not(F.coalesce("_there", F.lit(0).cast("long"))))
    missing = stage(joined.select("_reference", "_word", lost.alias("_lost")).filter("_lost != 0"), "missing-words")
    # As many numbers as there are references at most.
    open_ = {r["_reference"] for r in missing.select("_reference").distinct().collect()}
    parts = []
    for child, columns in children.items():
        chosen = {n: column for n, column in columns.items() if n in open_}
        if chosen:
            parts.append(_numbered(tables[child], chosen, "_reference").groupBy("_reference", "_key").agg(F.count("*").alias("Rows")))
    if not parts:
        return missing.select("_reference", c("_lost").cast("string").alias("Key"), c("_lost").alias("Rows"))
    rows = union_all(parts).withColumn("_word", F.shiftright("_key", 6))
    found = rows.join(missing, ["_reference", "_word"]).filter(c("_lost").bitwiseAND(F.expr(_KEY_BIT)) != 0)
    return found.select("_reference", c("_key").cast("string").alias("Key"), "Rows")


#: The bit of a key among its 64 neighbours.
_KEY_BIT = "shiftleft(1L, CAST(_key & 63 AS INT))"


def _numbered(df: DataFrame, columns: dict[int, str], name: str) -> DataFrame:
    """Columns of whole numbers stacked as their number, under ``name``, and ``_key``; nulls are left out."""
    stacked = df.select(*[c(column).cast("long").alias(str(n)) for n, column in columns.items()])
    pairs = stacked.unpivot([], [str(n) for n in columns], name, "_key").filter(c("_key").isNotNull())
    return pairs.withColumn(name, c(name).cast("int"))


def _key_words(pairs: DataFrame, name: str) -> DataFrame:
    """One row for each 64 neighbouring keys of which there is one, a bit for each."""
    return pairs.groupBy(name, F.shiftright("_key", 6).alias("_word")).agg(F.bit_or(F.expr(_KEY_BIT)).alias("_bits"))


def _missing(tables: dict[str, DataFrame], references: list[tuple[int, tuple]], kind: str) -> DataFrame:
    """``_reference, Key, Rows`` of the missing keys of references whose keys are all of one kind."""
    parents = list(dict.fromkeys((parent, key) for _, (_, _, parent, key) in references))
    children: dict[str, list[Column]] = {}
    for number, (child, column, parent, key) in references:
        entry = F.struct(
            F.lit(number).alias("_reference"),
            F.lit(parents.index((parent, key))).alias("_parent"),
            c(column).cast(kind).alias("_key"),
        )
        children.setdefault(child, []).append(entry)
    used = []
    for child, entries in children.items():
        stacked = tables[child].select(F.explode(F.array(*entries)).alias("_p")).select("_p.*").filter(c("_key").isNotNull())
        used.append(stacked.groupBy("_reference", "_parent", "_key").agg(F.count("*").alias("Rows")))
    known = [
        tables[parent].select(F.lit(number).alias("_parent"), c(key).cast(kind).alias("_key"))
        for number, (parent, key) in enumerate(parents)
    ]
    there = union_all(known).distinct().withColumn("_there", F.lit(True))
    # An anti join would be moved into every part of the union, and read the parents once for each.
    found = union_all(used).join(there, ["_parent", "_key"], "left").filter(c("_there").isNull())
    return found.select("_reference", c("_key").cast("string").alias("Key"), "Rows")


def parent_bitmaps(parents: dict[int, Column], tables: dict[int, DataFrame]) -> DataFrame:
    """``_parent, _piece, _bits``: the whole-number keys of every parent table, a bit each in pieces of 32,768 keys.

    Bits are set in every task first, so a repeated key costs nothing, and a table is a bit per key instead of a row.
    """
    known = [
        tables[number].select(F.lit(number).alias("_parent"), key.cast("long").alias("_key")).filter(c("_key").isNotNull())
        for number, key in parents.items()
    ]
    return (
        union_all(known)
        .groupBy("_parent", F.bitmap_bucket_number("_key").alias("_piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("_bits"))
    )


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap holds a position."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def orphans_by_bitmap(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str]]) -> DataFrame:
    """``all_orphans`` for references between whole numbers: children are tested against the parents' bitmaps.

    Children are folded to one row per key and reference as there; each then meets the one piece that can hold its
    key. Keys should be running numbers: of keys far apart every one needs a piece of its own.
    """
    parents = list(dict.fromkeys((parent, key) for _, _, parent, key in references))
    bitmaps = parent_bitmaps({n: c(key) for n, (_, key) in enumerate(parents)}, {n: tables[parent] for n, (parent, _) in enumerate(parents)})
    children: dict[str, list[Column]] = {}
    for number, (child, column, parent, key) in enumerate(references):
        entry = F.struct(F.lit(number).alias("_reference"), F.lit(parents.index((parent, key))).alias("_parent"), c(column).cast("long").alias("_key"))
        children.setdefault(child, []).append(entry)
    used = []
    for child, entries in children.items():
        stacked = tables[child].select(F.explode(F.array(*entries)).alias("_p")).select("_p.*").filter(c("_key").isNotNull())
        used.append(stacked.groupBy("_reference", "_parent", "_key").agg(F.count("*").alias("Rows")))
    placed = union_all(used).withColumn("_piece", F.bitmap_bucket_number("_key"))
    there = F.coalesce(has_bit(c("_bits"), F.bitmap_bit_position("_key")), F.lit(False))
    missing = placed.join(bitmaps, ["_parent", "_piece"], "left").filter(~there)
    labels = F.array(*[F.lit(f"{child}.{column}") for child, column, _, _ in references])
    return missing.select(F.element_at(labels, c("_reference") + 1).alias("Reference"), c("_key").cast("string").alias("Key"), "Rows")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, reference: str) -> DataFrame:
    """Keys of the child without a parent row, with how many rows use each.

    The child is folded to one row per key before the join.
    """
    used = child.filter(c(child_key).isNotNull()).groupBy(c(child_key).alias("Key")).agg(F.count("*").alias("Rows"))
    missing = used.join(parent.select(c(parent_key).alias("Key")), "Key", "left_anti")
    return missing.select(F.lit(reference).alias("Reference"), c("Key").cast("string").alias("Key"), "Rows")


def orphan_summary(missing: DataFrame) -> DataFrame:
    return missing.groupBy("Reference").agg(
        F.count("*").alias("OrphanKeys"), F.sum("Rows").alias("OrphanRows"), F.min("Key").alias("SampleKey")
    )


def profile_table(df: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, least and greatest value per column, over the whole table.

    One pass with a distinct-count sketch by default; all other figures are exact. ``exact``
    counts distinct values from (column, value) pairs of one type, folded map-side, in one more shuffle.
    """
    names = df.columns
    # Texts are compared where they have been folded already.
    later = {f.name for f in df.schema.fields if exact and f.dataType == T.StringType()}
    aggregates = [F.count("*").alias("_rows")]
    for i, name in enumerate(names):
        if name in later:
            continue
        text_low, text_high = F.min(name).cast("string"), F.max(name).cast("string")
        aggregates += [F.count(name).alias(f"c{i}"), text_low.alias(f"lo{i}"), text_high.alias(f"hi{i}")]
        if not exact:
            aggregates.append(F.approx_count_distinct(name).alias(f"d{i}"))
    wide = df.agg(*aggregates)
    entries = []
    for i, name in enumerate(names):
        none = F.lit(None).cast("string")
        fields = [
            F.lit(name).alias("ColumnName"),
            c("_rows").alias("Rows"),
            (F.lit(None).cast("long") if name in later else c("_rows") - c(f"c{i}")).alias("Nulls"),
            (none if name in later else c(f"lo{i}")).alias("MinValue"),
            (none if name in later else c(f"hi{i}")).alias("MaxValue"),
        ]
        if not exact:
            fields.append(c(f"d{i}").alias("DistinctValues"))
        entries.append(F.struct(*fields))
    profile = wide.select(F.explode(F.array(*entries)).alias("_p")).select(F.lit(table).alias("TableName"), "_p.*")
    if not exact:
        return profile
    joined = profile.join(distinct_values(df), "ColumnName", "left")
    return joined.select(
        "ColumnName",
        "TableName",
        "Rows",
        F.coalesce("Nulls", c("Rows") - F.coalesce("Held", F.lit(0))).alias("Nulls"),
        F.coalesce("MinValue", "Low").alias("MinValue"),
        F.coalesce("MaxValue", "High").alias("MaxValue"),
        F.coalesce("DistinctValues", F.lit(0)).alias("DistinctValues"),
    )


def icd_quality(diagnoses: DataFrame) -> DataFrame:
    """Codes per chapter letter passing the loose check, the strict check, and on which they differ."""
    loose, strict = icd10_shape_ok(c("ICDCode")), icd10_strict_ok(c("ICDCode"))
    return diagnoses.groupBy(F.upper(F.left(F.ltrim("ICDCode"), F.lit(1))).alias("Chapter")).agg(
        F.count("*").alias("Codes"),
        F.count_if(loose).alias("ShapeValid"),
        F.count_if(strict).alias("StrictValid"),
        F.count_if(loose != strict).alias("Disagree"),
    )


def vitals_enriched(vitals: DataFrame) -> DataFrame:
    """Vitals with body mass index and its band."""
    with_index = vitals.withColumn("BMI", bmi(c("HeightInches"), c("WeightPounds")))
    return with_index.withColumn("BMICategory", bmi_category(c("BMI")))


def kidney_function(labs: DataFrame, patients: DataFrame, creatinine_test: str, clock: Clock) -> DataFrame:
    """Filtration rate of every creatinine result from the patient's present age and gender."""
    results = labs.filter((c("TestCode") == creatinine_test) & c("ResultNumeric").isNotNull())
    female = F.when(c("Gender") == "F", True).when(c("Gender") == "M", False)
    age = age_exact(c("DateOfBirth"), clock.today)
    return results.join(patients.select("PatientID", "DateOfBirth", "Gender"), "PatientID").select(
        "LabResultID",
        "PatientID",
        "ResultNumeric",
        age.alias("Age"),
        "Gender",
        egfr(c("ResultNumeric"), age, female).alias("EGFR"),
    )


def drug_name_clusters(medications: DataFrame) -> DataFrame:
    """Normalised drug names with the number of spellings and rows behind each.

    Spellings are folded first, so the name rule runs once per spelling.
    """
    spellings = medications.groupBy("DrugName").agg(F.count("*").alias("n"))
    return spellings.groupBy(normalize_drug(c("DrugName")).alias("NormalName")).agg(
        F.count("DrugName").alias("Spellings"), F.sum("n").alias("Rows")
    )
