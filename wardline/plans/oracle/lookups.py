"""Reference SQL for the lookups."""

from wardline.plans.oracle.constants import INTERACTIONS
from wardline.plans.oracle.reports import AGE, DOCTOR, NOW

_PRIMARY = """dx AS (SELECT EncounterID, arg_min(ICDDescription, (DiagnosisID, ICDCode, ICDDescription)) AS t, arg_min(ICDCode, (DiagnosisID, ICDCode, ICDDescription)) AS code
  FROM h_diagnoses WHERE DiagnosisType = 'PRIMARY' GROUP BY 1)"""

_VISITS = f"""
WITH {_PRIMARY}
SELECT e.PatientID, e.EncounterID, e.EncounterNumber, e.EncounterType, e.AdmitDate, e.DischargeDate,
       CAST(date_diff('day', e.AdmitDate, COALESCE(e.DischargeDate, {NOW})) AS INTEGER) AS LengthOfStay, {DOCTOR} AS AttendingPhysician, d.DepartmentName,
       dx.t AS PrimaryDiagnosis, e.TotalCharges, e.EncounterStatus
FROM h_encounters e JOIN h_physicians ph ON ph.PhysicianID = e.AttendingPhysicianID LEFT JOIN h_departments d ON d.DepartmentID = e.DepartmentID
LEFT JOIN dx ON dx.EncounterID = e.EncounterID"""


def _trends(extra: str, days: int) -> str:
    return f"""
WITH fin AS (SELECT * FROM h_lab_results WHERE ResultStatus = 'FINAL' {extra}),
top AS (SELECT * FROM fin QUALIFY row_number() OVER (PARTITION BY PatientID, TestCode ORDER BY ReportedDate DESC, LabResultID DESC) = 1),
old AS (SELECT f.* FROM fin f JOIN top t ON t.PatientID = f.PatientID AND t.TestCode = f.TestCode AND f.ReportedDate < t.ReportedDate
        QUALIFY row_number() OVER (PARTITION BY f.PatientID, f.TestCode ORDER BY f.ReportedDate DESC, f.LabResultID DESC) = 1),
n AS (SELECT PatientID, TestCode, COUNT(*) AS k FROM h_lab_results GROUP BY 1, 2)
SELECT t.PatientID, t.TestCode, t.TestName, t.ResultValue AS LatestValue, t.ResultNumeric AS LatestNumeric, t.ReportedDate AS LatestDate,
       o.ResultValue AS PreviousValue, o.ReportedDate AS PreviousDate, t.ReferenceRangeLow, t.ReferenceRangeHigh, t.AbnormalFlag,
       CASE WHEN t.ResultNumeric IS NULL OR o.ResultNumeric IS NULL THEN NULL WHEN t.ResultNumeric > o.ResultNumeric * CAST(1.05 AS DECIMAL(3,2)) THEN 'UP'
            WHEN t.ResultNumeric < o.ResultNumeric * CAST(0.95 AS DECIMAL(3,2)) THEN 'DOWN' ELSE 'STABLE' END AS TrendDirection, n.k AS ResultCount
FROM top t JOIN n USING (PatientID, TestCode) LEFT JOIN old o ON o.PatientID = t.PatientID AND o.TestCode = t.TestCode
WHERE t.ReportedDate >= {NOW} - INTERVAL {days} DAY"""


def _search(where: str, order: str, limit: int) -> str:
    return f"""
WITH top AS (SELECT * FROM h_patients p WHERE {where} ORDER BY {order}, PatientID LIMIT {limit}),
v AS (SELECT * FROM h_encounters QUALIFY row_number() OVER (PARTITION BY PatientID ORDER BY AdmitDate DESC, EncounterID DESC) = 1)
SELECT p.PatientID, p.MRN, p.LastName, p.FirstName, p.MiddleName, p.DateOfBirth, CAST(year({NOW}) - year(p.DateOfBirth) AS INTEGER) AS Age, p.Gender, p.Address1, p.City,
       p.State, p.ZipCode, p.HomePhone, p.MobilePhone, p.Email, p.PatientStatus, i.ProviderName AS PrimaryInsurance, p.PrimaryPolicyNumber,
       v.AdmitDate AS LastEncounterDate, v.EncounterType AS LastEncounterType
FROM top p LEFT JOIN h_insurers i ON i.InsuranceProviderID = p.PrimaryInsuranceID LEFT JOIN v ON v.PatientID = p.PatientID"""


_ACTIVE = "SELECT 1 FROM h_encounters e WHERE e.PatientID = p.PatientID AND e.EncounterStatus = 'ACTIVE' AND"
_PAIRS = ", ".join(f"('{a}', '{b}', '{w}')" for a, b, w in INTERACTIONS)

SQL: dict[str, str] = {
    "patient_encounters": _VISITS,
    "patient_encounters_between": _VISITS + "\nWHERE e.AdmitDate >= DATE '1998-01-01' AND e.AdmitDate <= DATE '1999-06-30'",
    "active_medication_list": f"""
SELECT m.PatientID, m.MedicationID, m.DrugName, m.GenericName, m.DrugClass, m.Dosage, m.Route, m.Frequency, m.StartDate,
       CAST(date_diff('day', m.StartDate, {NOW}) AS INTEGER) AS DaysOnMedication, ph.LastName || ', ' || ph.FirstName AS PrescribingPhysician, m.IsControlledSubstance,
       CAST(EXISTS (SELECT 1 FROM h_allergies a WHERE a.PatientID = m.PatientID AND a.AllergyType = 'DRUG' AND a.AllergyStatus = 'ACTIVE'
                    AND contains(lower(m.DrugName), lower(a.AllergenName))) AS INTEGER) AS HasAllergyConflict
FROM h_medications m JOIN h_physicians ph ON ph.PhysicianID = m.PrescribingPhysicianID WHERE m.MedicationStatus = 'ACTIVE'""",
    "lab_trends": _trends("", 90),
    "lab_trends_one_test": _trends("AND TestCode = 'purchase'", 5),
    "physician_schedule": """
SELECT PhysicianID, regexp_extract(d, 'name="([^"]*)"', 1) AS DayOfWeek, regexp_extract(d, 'startTime="([^"]*)"', 1) AS StartTime,
       regexp_extract(d, 'endTime="([^"]*)"', 1) AS EndTime, regexp_extract(d, 'location="([^"]*)"', 1) AS Location,
       CAST(regexp_extract(d, 'onCall="([^"]*)"', 1) AS INTEGER) AS IsOnCall
FROM (SELECT PhysicianID, unnest(regexp_extract_all(WeeklyScheduleXML, '<Day [^>]*/>')) AS d FROM h_physicians)""",
    "search_patients": _search("TRUE", "LastName", 100),
    "search_patients_filtered": _search(
        f"lower(FirstName) LIKE 'b%' AND PatientStatus = 'ACTIVE' AND (contains(HomePhone, '5') OR contains(MobilePhone, '5') OR contains(WorkPhone, '5')) AND EXISTS ({_ACTIVE} e.DepartmentID = 7)",
        "DateOfBirth DESC NULLS LAST",
        15,
    ),
    "search_patients_fallback": _search(f"lower(LastName) LIKE 'cust%' AND EXISTS ({_ACTIVE} e.AttendingPhysicianID = 3)", "LastName", 20),
    "patient_summary": """
WITH v AS (SELECT *, row_number() OVER (PARTITION BY PatientID ORDER BY AdmitDate DESC, EncounterID DESC) AS n FROM h_encounters),
m AS (SELECT *, row_number() OVER (PARTITION BY PatientID ORDER BY MedicationID, DrugName, Dosage, Frequency) AS n FROM h_medications WHERE MedicationStatus = 'ACTIVE'),
a AS (SELECT *, row_number() OVER (PARTITION BY PatientID ORDER BY AllergyID) AS n FROM h_allergies WHERE AllergyStatus = 'ACTIVE'),
l AS (SELECT *, row_number() OVER (PARTITION BY PatientID ORDER BY ReportedDate DESC, LabResultID DESC) AS n FROM h_lab_results WHERE ResultStatus = 'FINAL')
SELECT PatientID, 'DEMOGRAPHICS' AS SectionName, 0 AS SectionOrder, 1 AS LineNumber, 'Patient: ' || LastName || ', ' || FirstName || ' ' || COALESCE(MiddleName, '') AS DetailLine FROM h_patients
UNION ALL SELECT PatientID, 'DEMOGRAPHICS', 0, 2, 'MRN: ' || MRN FROM h_patients
UNION ALL SELECT PatientID, 'DEMOGRAPHICS', 0, 3, 'DOB: ' || strftime(DateOfBirth, '%m/%d/%Y') || ' | Gender: ' || Gender FROM h_patients
UNION ALL SELECT PatientID, 'ENCOUNTERS', 10, n, EncounterNumber || ' | ' || EncounterType || ' | ' || strftime(AdmitDate, '%m/%d/%Y') FROM v WHERE n <= 10
UNION ALL SELECT PatientID, 'MEDICATIONS', 20, n, DrugName || ' ' || Dosage || ' ' || Frequency FROM m
UNION ALL SELECT PatientID, 'ALLERGIES', 30, n, AllergenName || ' [' || Severity || ']' FROM a
UNION ALL SELECT PatientID, 'LAB_RESULTS', 40, n, TestName || ': ' || COALESCE(ResultValue, 'Pending') || ' (' || strftime(ReportedDate, '%m/%d/%Y') || ')' FROM l
WHERE n <= 20 AND PatientID IN (SELECT PatientID FROM h_patients)""",
    "readmission_risk": f"""
WITH v AS (SELECT PatientID, COUNT(*) AS n FROM h_encounters WHERE AdmitDate >= {NOW} - INTERVAL 30 DAY GROUP BY 1),
x AS (SELECT PatientID, COUNT(DISTINCT ICDCode) AS n FROM h_diagnoses WHERE ChronicIndicator = 1 GROUP BY 1),
m AS (SELECT PatientID, COUNT(*) AS n FROM h_medications WHERE MedicationStatus = 'ACTIVE' GROUP BY 1),
s AS (SELECT p.PatientID, {AGE} AS age, COALESCE(v.n, 0) AS v, COALESCE(x.n, 0) AS x, COALESCE(m.n, 0) AS m
      FROM h_patients p LEFT JOIN v USING (PatientID) LEFT JOIN x USING (PatientID) LEFT JOIN m USING (PatientID))
SELECT PatientID, CAST(least(100, v * 8 + CASE WHEN age >= 75 THEN 15 WHEN age >= 65 THEN 10 WHEN age >= 50 THEN 5 ELSE 0 END
       + CASE WHEN x >= 5 THEN 20 WHEN x >= 3 THEN 12 WHEN x >= 1 THEN 5 ELSE 0 END + CASE WHEN m >= 10 THEN 15 WHEN m >= 5 THEN 8 ELSE 0 END) AS DECIMAL(5,2)) AS RiskScore FROM s""",
    "drug_interactions": f"""
WITH pairs(DrugA, DrugB, Warning) AS (VALUES {_PAIRS}),
d AS (SELECT PatientID, upper(trim(DrugCode)) AS Drug, COUNT(*) AS n FROM h_medications WHERE MedicationStatus = 'ACTIVE' GROUP BY 1, 2)
SELECT a.PatientID, pairs.DrugA, pairs.DrugB, a.n AS RowsA, b.n AS RowsB, pairs.Warning
FROM pairs JOIN d a ON a.Drug = pairs.DrugA JOIN d b ON b.Drug = pairs.DrugB AND b.PatientID = a.PatientID""",
    "interaction_pair_counts": f"""
WITH pairs(DrugA, DrugB, Warning) AS (VALUES {_PAIRS}),
d AS (SELECT DISTINCT PatientID, upper(trim(DrugCode)) AS Drug FROM h_medications WHERE MedicationStatus = 'ACTIVE'),
q AS (SELECT a.PatientID, COUNT(*) AS n, COUNT(p.Warning) AS k FROM d a JOIN d b ON a.PatientID = b.PatientID AND a.Drug < b.Drug
      LEFT JOIN pairs p ON (p.DrugA = a.Drug AND p.DrugB = b.Drug) OR (p.DrugA = b.Drug AND p.DrugB = a.Drug) GROUP BY 1),
c AS (SELECT PatientID, COUNT(*) AS n FROM d GROUP BY 1)
SELECT c.PatientID, c.n AS Drugs, COALESCE(q.n, 0) AS Pairs, COALESCE(q.k, 0) AS Interacting, COALESCE(q.n - q.k, 0) AS NoInteraction FROM c LEFT JOIN q USING (PatientID)""",
    "hl7_segments": """
WITH parts AS (SELECT LabResultID, list_filter(regexp_split_to_array(RawHL7Message, '[\r\n]'), lambda x: x <> '') AS p FROM h_hl7_messages),
rows AS (SELECT LabResultID, unnest(p) AS s, generate_subscripts(p, 1) - 1 AS i FROM parts),
clean AS (SELECT LabResultID, i, regexp_replace(s, '^[\\t-\\r\\x20\\x{85}\\pZ]+|[\\t-\\r\\x20\\x{85}\\pZ]+$', '', 'g') AS s FROM rows)
SELECT LabResultID, CAST(i AS INTEGER) AS SegmentIndex, left(s, 3) AS SegmentType, CAST(length(s) - length(replace(s, '|', '')) + 1 AS INTEGER) AS FieldCount, s AS RawSegment
FROM clean WHERE length(s) >= 3""",
    "drug_interaction_check": f"""
WITH pairs(a, b, w) AS (VALUES {_PAIRS}),
both_ways AS (SELECT a, b, w FROM pairs UNION ALL SELECT b, a, w FROM pairs)
SELECT q.PairID, q.DrugA, q.DrugB, CASE WHEN q.DrugA IS NULL OR q.DrugB IS NULL THEN NULL ELSE COALESCE(k.w, 'NO_INTERACTION') END AS Result
FROM h_drug_pairs q LEFT JOIN both_ways k ON k.a = upper(trim(q.DrugA)) AND k.b = upper(trim(q.DrugB))""",
}

SQL["hl7_segments_of_lab_messages"] = SQL["hl7_segments"].replace("h_hl7_messages", "h_lab_messages")
SQL["patients_by_phone_part"] = "SELECT PatientID, HomePhone, MobilePhone, WorkPhone FROM h_patients WHERE contains(HomePhone, '0012') OR contains(MobilePhone, '0012') OR contains(WorkPhone, '0012')"
SQL["drug_allergy_matches"] = """
SELECT DISTINCT m.PatientID, m.DrugName, lower(a.AllergenName) AS Allergen FROM h_medications m JOIN h_allergies a ON a.PatientID = m.PatientID AND contains(lower(m.DrugName), lower(a.AllergenName))
WHERE a.AllergyType = 'DRUG' AND a.AllergyStatus = 'ACTIVE'"""
SQL["visits_by_weekend"] = "SELECT EncounterType, CAST(isodow(AdmitDate) >= 6 AS INTEGER) AS Weekend, COUNT(*) AS Visits FROM h_encounters GROUP BY 1, 2"
