"""Reference SQL for data quality and enrichment."""

import re

from wardline.plans.oracle.constants import (
    BMI_BANDS,
    BMI_TOP_BAND,
    CONSTRAINTS,
    DOSAGE_FORMS,
    ICD_CHAPTER_MAX,
    ICD_STRICT,
    SALT_SUFFIXES,
    STRENGTHS,
)
from wardline.plans.oracle.reports import AGE, NOW
from wardline.sources.shapes import PROFILED, SHAPES

_DIFF_COLUMNS = ["EncounterID", "PatientID", "EncounterStatus", "PreAuthNumber"]


def _record(root: str, alias: str) -> str:
    parts = ", ".join(f"""'{n}="' || {alias}.{n} || '"'""" for n in _DIFF_COLUMNS)
    return f"'<{root} ' || concat_ws(' ', {parts}) || '/>'"


_SAME = " AND ".join(f"o.{n} IS NOT DISTINCT FROM n.{n}" for n in _DIFF_COLUMNS)


def _violations() -> str:
    parts = []
    for table, (domains, required, lengths, unique) in CONSTRAINTS.items():
        if table not in SHAPES:
            continue
        tests = [("DOMAIN", n, f"{n} NOT IN ({', '.join(repr(v) for v in allowed)})") for n, allowed in domains.items()]
        tests += [("REQUIRED", n, f"{n} IS NULL") for n in required]
        tests += [("LENGTH", n, f"length({n}) > {limit}") for n, limit in lengths.items()]
        parts += [f"SELECT '{table}' AS TableName, '{r}' AS Rule, '{n}' AS ColumnName, COUNT(*) FILTER (WHERE {t}) AS Violations FROM h_{table}" for r, n, t in tests]
        for key in unique:
            names = [key] if isinstance(key, str) else list(key)
            there = " AND ".join(f"{n} IS NOT NULL" for n in names)
            parts.append(f"SELECT '{table}', 'UNIQUE', '{'+'.join(names)}', COUNT(*) FILTER (WHERE {there}) - COUNT(DISTINCT ({', '.join(names)})) FILTER (WHERE {there}) FROM h_{table}")
    return " UNION ALL ".join(parts)


_REFERENCES = [
    ("patients", "PrimaryInsuranceID", "insurers", "InsuranceProviderID"),
    ("physicians", "DepartmentID", "departments", "DepartmentID"),
    ("encounters", "PatientID", "patients", "PatientID"),
    ("encounters", "AttendingPhysicianID", "physicians", "PhysicianID"),
    ("encounters", "DepartmentID", "departments", "DepartmentID"),
    ("orders", "EncounterID", "encounters", "EncounterID"),
    ("orders", "PatientID", "patients", "PatientID"),
    ("orders", "OrderingPhysicianID", "physicians", "PhysicianID"),
    ("medications", "EncounterID", "encounters", "EncounterID"),
    ("medications", "PatientID", "patients", "PatientID"),
    ("medications", "PrescribingPhysicianID", "physicians", "PhysicianID"),
    ("lab_results", "EncounterID", "encounters", "EncounterID"),
    ("lab_results", "PatientID", "patients", "PatientID"),
    ("radiology_studies", "OrderID", "orders", "OrderID"),
    ("radiology_studies", "EncounterID", "encounters", "EncounterID"),
    ("radiology_studies", "PatientID", "patients", "PatientID"),
    ("diagnoses", "EncounterID", "encounters", "EncounterID"),
    ("diagnoses", "PatientID", "patients", "PatientID"),
    ("procedures", "EncounterID", "encounters", "EncounterID"),
    ("procedures", "PatientID", "patients", "PatientID"),
    ("procedures", "PerformingPhysicianID", "physicians", "PhysicianID"),
    ("vitals", "EncounterID", "encounters", "EncounterID"),
    ("vitals", "PatientID", "patients", "PatientID"),
    ("clinical_notes", "EncounterID", "encounters", "EncounterID"),
    ("clinical_notes", "AuthorID", "physicians", "PhysicianID"),
    ("allergies", "PatientID", "patients", "PatientID"),
    ("billing_charges", "EncounterID", "encounters_after", "EncounterID"),
    ("billing_charges", "ChargeCode", "chargemaster", "ChargeCode"),
    ("collections", "InvoiceID", "invoices", "InvoiceID"),
    ("payments", "ClaimID", "insurance_claims", "ClaimID"),
    ("appointments", "PatientID", "patients", "PatientID"),
    ("room_assignments", "RoomID", "rooms", "RoomID"),
    ("room_assignments", "EncounterID", "encounters_after", "EncounterID"),
]
_ORPHAN_PARTS = {
    (a, x): f"SELECT '{a}.{x}' AS Reference, CAST({x} AS VARCHAR) AS Key, COUNT(*) AS Rows FROM h_{a} c WHERE {x} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM h_{b} p WHERE p.{y} = c.{x}) GROUP BY ALL"
    for a, x, b, y in _REFERENCES
}
_ORPHANS = " UNION ALL ".join(_ORPHAN_PARTS.values())


def _columns(table: str) -> list[str]:
    """Column names of a shape, as its text gives them."""
    named = re.findall(r"\bAS ([A-Z]\w*)(?=\s*(?:,|$|\s+FROM\b))", SHAPES[table])
    return list(dict.fromkeys(named))


def _profile(tables: list[str], distinct: bool = True) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS TableName, '{n}' AS ColumnName, COUNT(*) AS Rows, COUNT(*) - COUNT({n}) AS Nulls, CAST(MIN({n}) AS VARCHAR) AS MinValue, CAST(MAX({n}) AS VARCHAR) AS MaxValue"
        + (f", COUNT(DISTINCT {n}) AS DistinctValues" if distinct else "")
        + f" FROM h_{t}"
        for t in tables
        for n in _columns(t)
    )


_CLEAN = "upper(trim(ICDCode))"
_CAPS = " ".join(f"WHEN '{k}' THEN CAST(substr({_CLEAN}, 2, 2) AS INTEGER) <= {v}" for k, v in ICD_CHAPTER_MAX.items())
_SHAPE = "COALESCE(regexp_matches(rtrim(ICDCode), '^[A-Za-z][0-9][0-9]([.][A-Za-z0-9]*)?$'), FALSE)"
_STRICT = f"""COALESCE(CASE WHEN regexp_matches({_CLEAN}, '{ICD_STRICT}') THEN
  CASE left({_CLEAN}, 1) {_CAPS} WHEN 'F' THEN CAST(substr({_CLEAN}, 2, 2) AS INTEGER) >= 1 WHEN 'U' THEN FALSE ELSE TRUE END END, FALSE)"""
_BMI = "CASE WHEN HeightInches > 0 AND WeightPounds > 0 THEN CAST(round(CAST(WeightPounds AS DOUBLE) * 703 / (CAST(HeightInches AS DOUBLE) * CAST(HeightInches AS DOUBLE)), 2) AS DECIMAL(5,2)) END"
_BANDS = " ".join(f"WHEN BMI < {top} THEN '{name}'" for top, name in BMI_BANDS)
_NORMAL = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(trim(DrugName)), "
    f"' ({'|'.join(SALT_SUFFIXES)})$', ''), '{DOSAGE_FORMS}', ' ', 'g'), '{STRENGTHS}', ' ', 'g'), '\\s+', ' ', 'g'))"
)

SQL: dict[str, str] = {
    "snapshot_diff": f"""
SELECT 'Encounters' AS TableName, COALESCE(o.EncounterID, n.EncounterID) AS RecordID,
       CASE WHEN o.EncounterID IS NULL THEN 'INSERT' WHEN n.EncounterID IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS Action,
       CASE WHEN o.EncounterID IS NOT NULL THEN {_record('OldRecord', 'o')} END AS OldValues, CASE WHEN n.EncounterID IS NOT NULL THEN {_record('NewRecord', 'n')} END AS NewValues,
       'SYSTEM' AS ChangedBy, {NOW} AS ModifiedDate
FROM h_encounters o FULL JOIN h_encounters_after n ON o.EncounterID = n.EncounterID WHERE NOT ({_SAME})""",
    "constraint_violations": _violations(),
    "orphan_keys": _ORPHANS,
    "orphan_summary": f"SELECT Reference, COUNT(*) AS OrphanKeys, CAST(SUM(Rows) AS BIGINT) AS OrphanRows, MIN(Key) AS SampleKey FROM ({_ORPHANS}) GROUP BY 1",
    "table_profile": _profile(PROFILED),
    "table_profile_from_sketches": _profile(["billing_charges", "encounters", "payments"], distinct=False),
    "schema_profile": _profile(["insurance_claims", "collections", "payments"]),
    "icd_quality": f"""
SELECT upper(left(ltrim(ICDCode), 1)) AS Chapter, COUNT(*) AS Codes, COUNT(*) FILTER (WHERE a) AS ShapeValid, COUNT(*) FILTER (WHERE b) AS StrictValid, COUNT(*) FILTER (WHERE a <> b) AS Disagree
FROM (SELECT ICDCode, {_SHAPE} AS a, {_STRICT} AS b FROM h_diagnoses) GROUP BY 1""",
    "icd_checks": f"SELECT DiagnosisID, ICDCode, CAST({_SHAPE} AS INTEGER) AS ShapeOk, CAST({_STRICT} AS INTEGER) AS StrictOk FROM h_diagnoses",
    "vitals_enriched": f"SELECT *, CASE WHEN BMI > 0 THEN CASE {_BANDS} ELSE '{BMI_TOP_BAND}' END END AS BMICategory FROM (SELECT *, {_BMI} AS BMI FROM h_vitals)",
    "kidney_function": f"""
WITH r AS (SELECT l.LabResultID, l.PatientID, l.ResultNumeric, {AGE} AS Age, p.Gender, CAST(l.ResultNumeric AS DOUBLE) AS s,
   CASE p.Gender WHEN 'F' THEN TRUE WHEN 'M' THEN FALSE END AS f FROM h_lab_results l JOIN h_patients p USING (PatientID) WHERE l.TestCode = 'signup' AND l.ResultNumeric IS NOT NULL)
SELECT LabResultID, PatientID, ResultNumeric, Age, Gender, CASE WHEN s > 0 AND f IS NOT NULL AND Age IS NOT NULL THEN round_even(
   141.0 * pow(least(s / CASE WHEN f THEN 0.7 ELSE 0.9 END, 1.0), CASE WHEN f THEN -0.329 ELSE -0.411 END) * pow(greatest(s / CASE WHEN f THEN 0.7 ELSE 0.9 END, 1.0), -1.209)
   * pow(0.993, Age) * CASE WHEN f THEN 1.018 ELSE 1.0 END, 2) END AS EGFR FROM r""",
    "drug_name_clusters": f"SELECT {_NORMAL} AS NormalName, COUNT(DISTINCT DrugName) AS Spellings, COUNT(*) AS Rows FROM h_medications GROUP BY 1",
    "drug_names_normalized": f"SELECT MedicationID, DrugName, {_NORMAL} AS NormalName FROM h_medications",
    "patient_names": """
SELECT PatientID, LastName || ', ' || FirstName || COALESCE(' ' || left(MiddleName, 1) || '.', '') AS LAST_FIRST,
       FirstName || COALESCE(' ' || MiddleName, '') || ' ' || LastName || COALESCE(' ' || Suffix, '') AS FIRST_LAST,
       FirstName || COALESCE(' ' || MiddleName, '') || ' ' || LastName || COALESCE(', ' || Suffix, '') AS "FULL",
       LastName || ', ' || FirstName || COALESCE(' ' || MiddleName, '') || COALESCE(', ' || Suffix, '') AS FORMAL, LastName || ', ' || FirstName AS OTHER FROM h_patients""",
}
SQL["snapshot_diff_by_range"] = SQL["snapshot_diff"]
SQL["orphan_keys_by_bitmap"] = " UNION ALL ".join(text for (_, column), text in _ORPHAN_PARTS.items() if column != "ChargeCode")
