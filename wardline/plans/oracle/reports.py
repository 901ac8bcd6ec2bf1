"""Reference SQL for the report views, in DuckDB's dialect over ``h_<table>`` names."""

NOW = "TIMESTAMP '2001-07-20 10:30:00'"
TODAY = "DATE '2001-07-20'"
MONTH = "TIMESTAMP '2001-07-01 00:00:00'"
YEAR = "TIMESTAMP '2001-01-01 00:00:00'"


def today(column: str) -> str:
    return f"CAST({column} AS DATE) = {TODAY}"


AGE = (
    f"CAST(date_diff('year', p.DateOfBirth, {TODAY}) - CASE WHEN p.DateOfBirth + to_years(CAST(date_diff('year', p.DateOfBirth, {TODAY}) AS INTEGER)) > {TODAY} THEN 1 ELSE 0 END AS INTEGER)"
)
PATIENT = "p.LastName || ', ' || p.FirstName"
DOCTOR = "ph.LastName || ', ' || ph.FirstName || ' ' || COALESCE(ph.Credentials, '')"

SQL: dict[str, str] = {
    "active_patients": f"""
SELECT p.PatientID, p.MRN, p.FirstName, p.MiddleName, p.LastName, p.DateOfBirth, {AGE} AS Age, p.Gender, p.Address1, p.City, p.State,
       p.ZipCode, p.HomePhone, p.MobilePhone, p.Email, i.ProviderName AS PrimaryInsurance, p.PrimaryPolicyNumber, p.CreatedDate AS RegistrationDate
FROM h_patients p LEFT JOIN h_insurers i ON i.InsuranceProviderID = p.PrimaryInsuranceID
WHERE p.PatientStatus = 'ACTIVE' AND p.DeceasedIndicator = 0""",
    "inpatient_census": f"""
WITH med AS (SELECT EncounterID, COUNT(*) AS n FROM h_medications WHERE MedicationStatus = 'ACTIVE' GROUP BY 1),
ord AS (SELECT EncounterID, COUNT(*) AS n FROM h_orders WHERE OrderStatus IN ('ORDERED', 'IN_PROGRESS') GROUP BY 1)
SELECT e.EncounterID, e.EncounterNumber, p.PatientID, p.MRN, {PATIENT} AS PatientName, p.DateOfBirth,
       CAST(year({NOW}) - year(p.DateOfBirth) AS INTEGER) AS Age, p.Gender, e.EncounterType, e.AdmitDate, CAST(date_diff('day', e.AdmitDate, {NOW}) AS INTEGER) AS LengthOfStay,
       e.RoomNumber, e.BedNumber, d.DepartmentName, {DOCTOR} AS AttendingPhysician, e.AdmitDiagnosis, i.ProviderName AS Insurance, e.TotalCharges,
       COALESCE(med.n, 0) AS ActiveMedicationCount, COALESCE(ord.n, 0) AS PendingOrderCount
FROM h_encounters e JOIN h_patients p USING (PatientID) JOIN h_physicians ph ON ph.PhysicianID = e.AttendingPhysicianID
LEFT JOIN h_departments d ON d.DepartmentID = e.DepartmentID LEFT JOIN h_insurers i ON i.InsuranceProviderID = p.PrimaryInsuranceID
LEFT JOIN med ON med.EncounterID = e.EncounterID LEFT JOIN ord ON ord.EncounterID = e.EncounterID
WHERE e.EncounterStatus = 'ACTIVE' AND e.EncounterType IN ('INPATIENT', 'OBSERVATION')""",
    "pending_lab_orders": f"""
SELECT o.OrderID, o.EncounterID, p.MRN, {PATIENT} AS PatientName, o.OrderCode, o.OrderDescription, o.OrderPriority, o.IsStatOrder, o.OrderDate,
       date_diff('minute', o.OrderDate, {NOW}) AS MinutesSinceOrdered, ph.LastName || ', ' || ph.FirstName AS OrderingPhysician, d.DepartmentName, e.RoomNumber, e.BedNumber
FROM h_orders o JOIN h_encounters e USING (EncounterID) JOIN h_patients p ON p.PatientID = o.PatientID
JOIN h_physicians ph ON ph.PhysicianID = o.OrderingPhysicianID LEFT JOIN h_departments d ON d.DepartmentID = e.DepartmentID
WHERE o.OrderType = 'LAB' AND o.OrderStatus IN ('ORDERED', 'IN_PROGRESS')""",
    "critical_lab_results": f"""
SELECT r.LabResultID, p.MRN, {PATIENT} AS PatientName, e.RoomNumber, e.BedNumber, r.TestCode, r.TestName, r.ResultValue, r.ResultUnit, r.AbnormalFlag,
       r.ReferenceRangeLow, r.ReferenceRangeHigh, r.ReportedDate, date_diff('minute', r.ReportedDate, {NOW}) AS MinutesSinceReported,
       ph.LastName || ', ' || ph.FirstName AS AttendingPhysician, ph.Phone AS PhysicianPhone
FROM h_lab_results r JOIN h_encounters e USING (EncounterID) JOIN h_patients p ON p.PatientID = r.PatientID
JOIN h_physicians ph ON ph.PhysicianID = e.AttendingPhysicianID
WHERE r.CriticalFlag = 1 AND r.ResultStatus IN ('PRELIMINARY', 'FINAL')""",
    "active_medications": f"""
SELECT m.MedicationID, p.MRN, {PATIENT} AS PatientName, m.DrugCode, m.DrugName, m.GenericName, m.DrugClass, m.Dosage, m.DosageUnit, m.Route, m.Frequency,
       m.StartDate, CAST(date_diff('day', m.StartDate, {NOW}) AS INTEGER) AS DaysOnMedication, ph.LastName || ', ' || ph.FirstName AS PrescribingPhysician,
       m.IsControlledSubstance, m.DEASchedule, m.PharmacyVerified,
       CAST(EXISTS (SELECT 1 FROM h_allergies a WHERE a.PatientID = m.PatientID AND a.AllergyType = 'DRUG' AND a.AllergyStatus = 'ACTIVE'
                    AND contains(lower(m.DrugName), lower(a.AllergenName))) AS INTEGER) AS PotentialAllergyConflict
FROM h_medications m JOIN h_patients p USING (PatientID) JOIN h_physicians ph ON ph.PhysicianID = m.PrescribingPhysicianID
WHERE m.MedicationStatus = 'ACTIVE'""",
    "patient_encounter_summary": f"""
SELECT p.PatientID, p.MRN, {PATIENT} AS PatientName, p.DateOfBirth, p.Gender, p.PatientStatus, COUNT(DISTINCT e.EncounterID) AS TotalEncounters,
       COUNT(*) FILTER (WHERE e.EncounterType = 'INPATIENT') AS InpatientCount, COUNT(*) FILTER (WHERE e.EncounterType = 'OUTPATIENT') AS OutpatientCount,
       COUNT(*) FILTER (WHERE e.EncounterType = 'EMERGENCY') AS EmergencyCount, MIN(e.AdmitDate) AS FirstVisitDate, MAX(e.AdmitDate) AS LastVisitDate,
       CAST(COALESCE(SUM(e.TotalCharges), 0) AS DECIMAL(18,2)) AS LifetimeCharges, CAST(COALESCE(SUM(e.TotalPayments), 0) AS DECIMAL(18,2)) AS LifetimePayments,
       CAST(COALESCE(SUM(e.PatientBalance), 0) AS DECIMAL(18,2)) AS OutstandingBalance,
       CAST(COALESCE(bool_or(e.EncounterStatus = 'ACTIVE'), FALSE) AS INTEGER) AS HasActiveEncounter
FROM h_patients p LEFT JOIN h_encounters e USING (PatientID) GROUP BY ALL""",
    "physician_workload": f"""
WITH e AS (SELECT AttendingPhysicianID AS k, COUNT(*) FILTER (WHERE EncounterStatus = 'ACTIVE') AS a, COUNT(*) FILTER (WHERE AdmitDate >= {MONTH}) AS m FROM h_encounters GROUP BY 1),
o AS (SELECT OrderingPhysicianID AS k, COUNT(*) AS n FROM h_orders WHERE {today('OrderDate')} GROUP BY 1),
n AS (SELECT AuthorID AS k, COUNT(*) AS n FROM h_clinical_notes WHERE NoteStatus = 'DRAFT' GROUP BY 1)
SELECT ph.PhysicianID, ph.NPI, {DOCTOR} AS PhysicianName, ph.Specialty, d.DepartmentName, COALESCE(e.a, 0) AS ActivePatientCount,
       COALESCE(o.n, 0) AS TodaysOrderCount, COALESCE(n.n, 0) AS UnsignedNoteCount, COALESCE(e.m, 0) AS MonthlyEncounterCount
FROM h_physicians ph LEFT JOIN h_departments d USING (DepartmentID) LEFT JOIN e ON e.k = ph.PhysicianID LEFT JOIN o ON o.k = ph.PhysicianID LEFT JOIN n ON n.k = ph.PhysicianID
WHERE ph.IsActive = 1""",
    "department_statistics": f"""
WITH v AS (SELECT DepartmentID AS k, COUNT(*) FILTER (WHERE EncounterStatus = 'ACTIVE') AS census,
    AVG(CAST(date_diff('day', AdmitDate, DischargeDate) AS DOUBLE)) FILTER (WHERE EncounterStatus = 'DISCHARGED' AND DischargeDate >= {NOW} - INTERVAL 30 DAY) AS los,
    SUM(TotalCharges) FILTER (WHERE AdmitDate >= {MONTH}) AS charges FROM h_encounters GROUP BY 1),
s AS (SELECT DepartmentID AS k, COUNT(DISTINCT PhysicianID) AS n FROM h_physicians WHERE IsActive = 1 GROUP BY 1)
SELECT d.DepartmentID, d.DepartmentCode, d.DepartmentName, d.FloorNumber, COALESCE(v.census, 0) AS CurrentCensus, v.los AS AvgLengthOfStay30Days,
       CAST(COALESCE(v.charges, 0) AS DECIMAL(18,2)) AS MonthlyCharges, COALESCE(s.n, 0) AS ActivePhysicianCount, d.IsActive
FROM h_departments d LEFT JOIN v ON v.k = d.DepartmentID LEFT JOIN s ON s.k = d.DepartmentID WHERE d.IsActive = 1""",
    "patient_financial_summary": f"""
WITH e AS (SELECT PatientID, COUNT(*) AS n, COUNT(*) FILTER (WHERE EncounterStatus = 'ACTIVE') AS a FROM h_encounters GROUP BY 1),
b AS (SELECT PatientID, SUM(ChargeAmount) AS c, SUM(AdjustmentAmount) AS a FROM h_billing_charges WHERE ChargeStatus <> 'VOIDED' GROUP BY 1),
y AS (SELECT PatientID, SUM(PaymentAmount) AS p FROM h_payments WHERE PaymentStatus <> 'VOIDED' GROUP BY 1),
k AS (SELECT PatientID, COUNT(*) AS n, COUNT(*) FILTER (WHERE ClaimStatus = 'DENIED') AS d, SUM(PaidAmount) FILTER (WHERE ClaimStatus IN ('PAID', 'PARTIAL_PAID')) AS p FROM h_insurance_claims GROUP BY 1),
v AS (SELECT PatientID, SUM(TotalAmount - PaidAmount) AS o FROM h_invoices WHERE InvoiceStatus = 'OPEN' GROUP BY 1),
l AS (SELECT PatientID, SUM(OriginalBalance) AS o FROM h_collections WHERE CollectionStatus = 'ACTIVE' GROUP BY 1)
SELECT p.PatientID, p.MRN, {PATIENT} AS PatientName, p.DateOfBirth, p.PatientStatus, i.ProviderName AS PrimaryInsurance, p.PrimaryPolicyNumber,
       COALESCE(e.n, 0) AS TotalEncounters, COALESCE(e.a, 0) AS ActiveEncounters, COALESCE(k.n, 0) AS TotalClaims, COALESCE(k.d, 0) AS DeniedClaims,
       CAST(COALESCE(b.c, 0) AS DECIMAL(18,2)) AS TotalCharges, CAST(COALESCE(b.a, 0) AS DECIMAL(18,2)) AS TotalAdjustments,
       CAST(COALESCE(y.p, 0) AS DECIMAL(18,2)) AS TotalPayments, CAST(COALESCE(k.p, 0) AS DECIMAL(18,2)) AS InsurancePaidTotal,
       CAST(COALESCE(v.o, 0) AS DECIMAL(18,2)) AS OutstandingBalance, CAST(COALESCE(l.o, 0) AS DECIMAL(18,2)) AS InCollections
FROM h_patients p LEFT JOIN h_insurers i ON i.InsuranceProviderID = p.PrimaryInsuranceID LEFT JOIN e USING (PatientID) LEFT JOIN b USING (PatientID)
LEFT JOIN y USING (PatientID) LEFT JOIN k USING (PatientID) LEFT JOIN v USING (PatientID) LEFT JOIN l USING (PatientID)""",
    "hospital_census": f"""
WITH v AS (SELECT DepartmentID AS k, COUNT(DISTINCT EncounterID) FILTER (WHERE EncounterStatus = 'ACTIVE' AND EncounterType = 'INPATIENT') AS ip,
    COUNT(DISTINCT EncounterID) FILTER (WHERE EncounterStatus = 'ACTIVE' AND EncounterType = 'OBSERVATION') AS ob,
    COUNT(DISTINCT EncounterID) FILTER (WHERE EncounterStatus = 'ACTIVE' AND EncounterType = 'EMERGENCY') AS er,
    COUNT(*) FILTER (WHERE {today('AdmitDate')}) AS adm, COUNT(*) FILTER (WHERE {today('DischargeDate')}) AS dis,
    AVG(CAST(date_diff('day', AdmitDate, {NOW}) AS DOUBLE)) FILTER (WHERE EncounterStatus = 'ACTIVE') AS los FROM h_encounters GROUP BY 1),
r AS (SELECT DepartmentCode AS k, COUNT(*) FILTER (WHERE IsActive = 1) AS n FROM h_rooms GROUP BY 1),
u AS (SELECT r.DepartmentCode AS k, COUNT(*) AS n FROM h_room_assignments a JOIN h_rooms r USING (RoomID) WHERE a.AssignmentStatus = 'ACTIVE' GROUP BY 1)
SELECT d.DepartmentName, d.DepartmentCode, d.FloorNumber, COALESCE(v.ip, 0) AS InpatientCount, COALESCE(v.ob, 0) AS ObservationCount, COALESCE(v.er, 0) AS EmergencyCount,
       COALESCE(r.n, 0) AS TotalRooms, COALESCE(u.n, 0) AS OccupiedRooms, COALESCE(v.adm, 0) AS AdmissionsToday, COALESCE(v.dis, 0) AS DischargesToday, v.los AS AvgCurrentLOS
FROM h_departments d LEFT JOIN v ON v.k = d.DepartmentID LEFT JOIN r ON r.k = d.DepartmentCode LEFT JOIN u ON u.k = d.DepartmentCode WHERE d.IsActive = 1""",
    "physician_productivity": f"""
WITH e AS (SELECT AttendingPhysicianID AS k, COUNT(*) AS n FROM h_encounters WHERE AdmitDate >= {MONTH} GROUP BY 1),
o AS (SELECT OrderingPhysicianID AS k, COUNT(*) AS n FROM h_orders WHERE OrderDate >= {MONTH} GROUP BY 1),
r AS (SELECT PerformingPhysicianID AS k, COUNT(*) AS n FROM h_procedures WHERE ProcedureDate >= {MONTH} AND ProcedureStatus = 'COMPLETED' GROUP BY 1),
b AS (SELECT PerformingPhysicianNPI AS k, SUM(ChargeAmount) FILTER (WHERE ServiceDate >= {MONTH}) AS m, SUM(ChargeAmount) AS y
      FROM h_billing_charges WHERE ServiceDate >= {YEAR} AND ChargeStatus <> 'VOIDED' GROUP BY 1),
a AS (SELECT PhysicianID AS k, COUNT(*) FILTER (WHERE AppointmentStatus NOT IN ('CANCELLED', 'NO_SHOW')) AS n, COUNT(*) FILTER (WHERE AppointmentStatus = 'NO_SHOW') AS s
      FROM h_appointments WHERE AppointmentDate >= {MONTH} GROUP BY 1),
n AS (SELECT AuthorID AS k, COUNT(*) AS n FROM h_clinical_notes WHERE NoteStatus = 'DRAFT' GROUP BY 1)
SELECT ph.PhysicianID, ph.NPI, {DOCTOR} AS PhysicianName, ph.Specialty, d.DepartmentName, COALESCE(e.n, 0) AS MonthlyEncounters, COALESCE(o.n, 0) AS MonthlyOrders,
       COALESCE(r.n, 0) AS MonthlyProcedures, CAST(COALESCE(b.m, 0) AS DECIMAL(18,2)) AS MonthlyCharges, CAST(COALESCE(b.y, 0) AS DECIMAL(18,2)) AS YTDCharges,
       COALESCE(a.n, 0) AS MonthlyAppointments, COALESCE(a.s, 0) AS MonthlyNoShows, COALESCE(n.n, 0) AS UnsignedNotes
FROM h_physicians ph LEFT JOIN h_departments d USING (DepartmentID) LEFT JOIN e ON e.k = ph.PhysicianID LEFT JOIN o ON o.k = ph.PhysicianID
LEFT JOIN r ON r.k = ph.PhysicianID LEFT JOIN b ON b.k = ph.NPI LEFT JOIN a ON a.k = ph.PhysicianID LEFT JOIN n ON n.k = ph.PhysicianID WHERE ph.IsActive = 1""",
}


def _money(expr: str) -> str:
    return f"CAST(COALESCE({expr}, 0) AS DECIMAL(18,2))"


_BLOCKS = {
    "charge_flow": f"""
SELECT {_money(f"SUM(ChargeAmount) FILTER (WHERE {today('PostedDate')})")} AS TodayCharges,
       {_money(f"SUM(ChargeAmount) FILTER (WHERE PostedDate >= {MONTH})")} AS MTDCharges,
       {_money(f"SUM(ChargeAmount) FILTER (WHERE PostedDate >= {YEAR})")} AS YTDCharges FROM h_billing_charges WHERE ChargeStatus <> 'VOIDED'""",
    "payment_flow": f"""
SELECT {_money(f"SUM(PaymentAmount) FILTER (WHERE {today('PostedDate')})")} AS TodayPayments,
       {_money(f"SUM(PaymentAmount) FILTER (WHERE PostedDate >= {MONTH})")} AS MTDPayments FROM h_payments WHERE PaymentStatus <> 'VOIDED'""",
    "claim_queue": f"""
SELECT COUNT(*) FILTER (WHERE ClaimStatus = 'CREATED') AS ClaimsPendingSubmission, COUNT(*) FILTER (WHERE ClaimStatus = 'SUBMITTED') AS ClaimsSubmitted,
       COUNT(*) FILTER (WHERE ClaimStatus = 'DENIED') AS ClaimsDenied, {_money("SUM(TotalCharges) FILTER (WHERE ClaimStatus = 'DENIED')")} AS DeniedClaimsValue FROM h_insurance_claims""",
    "receivables_ageing": f"""
SELECT {_money("SUM(b) FILTER (WHERE a <= 30)")} AS AR_0_30, {_money("SUM(b) FILTER (WHERE a BETWEEN 31 AND 60)")} AS AR_31_60,
       {_money("SUM(b) FILTER (WHERE a BETWEEN 61 AND 90)")} AS AR_61_90, {_money("SUM(b) FILTER (WHERE a > 90)")} AS AR_Over90
FROM (SELECT TotalAmount - PaidAmount AS b, date_diff('day', InvoiceDate, {TODAY}) AS a FROM h_invoices WHERE InvoiceStatus = 'OPEN')""",
    "collection_totals": f"""
SELECT COUNT(*) AS ActiveCollectionAccounts, {_money('SUM(CurrentBalance)')} AS TotalInCollections FROM h_collections WHERE CollectionStatus = 'ACTIVE'""",
    "visit_volume": f"""
SELECT COUNT(*) FILTER (WHERE EncounterStatus = 'ACTIVE') AS CurrentActiveEncounters, COUNT(*) FILTER (WHERE {today('AdmitDate')}) AS TodayAdmissions FROM h_encounters""",
    "readmission_rate": f"""
SELECT CAST(round(100.0 * COUNT(*) FILTER (WHERE back) / NULLIF(COUNT(*), 0), 2) AS DECIMAL(5,2)) AS ReadmissionRate30Day FROM (
  SELECT EXISTS (SELECT 1 FROM h_encounters f WHERE f.PatientID = e.PatientID AND f.EncounterID <> e.EncounterID AND f.EncounterType = 'INPATIENT'
                 AND f.AdmitDate BETWEEN e.DischargeDate AND e.DischargeDate + INTERVAL 30 DAY) AS back
  FROM h_encounters e WHERE e.EncounterType = 'INPATIENT' AND e.EncounterStatus = 'DISCHARGED'
   AND e.DischargeDate BETWEEN {NOW} - INTERVAL 90 DAY AND {NOW} - INTERVAL 30 DAY)""",
    "average_stay": f"""
SELECT AVG(CAST(date_diff('day', AdmitDate, DischargeDate) AS DOUBLE)) AS AvgLOS_Last30Days FROM h_encounters
WHERE EncounterType = 'INPATIENT' AND EncounterStatus = 'DISCHARGED' AND DischargeDate >= {NOW} - INTERVAL 1 MONTH""",
    "ed_time_to_first_order": f"""
SELECT AVG(CAST(date_diff('minute', e.AdmitDate, o.f) AS DOUBLE)) AS AvgEDTimeToFirstOrder_Minutes
FROM h_encounters e LEFT JOIN (SELECT EncounterID, MIN(OrderDate) AS f FROM h_orders GROUP BY 1) o USING (EncounterID)
WHERE e.EncounterType = 'EMERGENCY' AND e.AdmitDate >= {NOW} - INTERVAL 30 DAY""",
    "unsigned_notes": f"""
SELECT COUNT(*) AS TotalUnsignedNotes, COUNT(*) FILTER (WHERE date_diff('day', NoteDate, {NOW}) > 7) AS UnsignedNotesOver7Days FROM h_clinical_notes WHERE NoteStatus = 'DRAFT'""",
    "critical_lab_age": f"""
SELECT AVG(CAST(date_diff('minute', ReportedDate, {NOW}) AS DOUBLE)) AS AvgCriticalLabAge_Minutes FROM h_lab_results
WHERE CriticalFlag = 1 AND ResultStatus IN ('PRELIMINARY', 'FINAL') AND ReportedDate >= {NOW} - INTERVAL 30 DAY""",
    "allergy_warning_count": f"""
SELECT COUNT(*) AS AllergyWarningsLast30Days FROM h_audit_log WHERE Action = 'ALLERGY_WARNING' AND ChangedDate >= {NOW} - INTERVAL 30 DAY""",
    "claim_denial_rate": f"""
SELECT CAST(round(100.0 * COUNT(*) FILTER (WHERE ClaimStatus = 'DENIED') / NULLIF(COUNT(*), 0), 2) AS DECIMAL(5,2)) AS ClaimDenialRate_Last90Days
FROM h_insurance_claims WHERE SubmittedDate >= {NOW} - INTERVAL 3 MONTH""",
}
SQL.update(_BLOCKS)
_REVENUE = ["charge_flow", "payment_flow", "claim_queue", "receivables_ageing", "collection_totals", "visit_volume"]
_QUALITY = ["readmission_rate", "average_stay", "ed_time_to_first_order", "unsigned_notes", "critical_lab_age", "allergy_warning_count", "claim_denial_rate"]


def _side_by_side(names: list[str]) -> str:
    return f"SELECT {TODAY} AS ReportDate, * FROM " + ", ".join(f"({_BLOCKS[n]}) AS t{i}" for i, n in enumerate(names))


SQL["revenue_cycle_summary"] = _side_by_side(_REVENUE)
SQL["quality_metrics"] = _side_by_side(_QUALITY)
SQL["readmission_flags"] = f"""
SELECT e.EncounterID, e.PatientID, e.AdmitDate, e.DischargeDate,
       CAST(EXISTS (SELECT 1 FROM h_encounters f WHERE f.PatientID = e.PatientID AND f.EncounterID <> e.EncounterID AND f.EncounterType = 'INPATIENT'
            AND f.AdmitDate BETWEEN e.DischargeDate AND e.DischargeDate + INTERVAL 30 DAY) AS INTEGER) AS Readmitted
FROM h_encounters e WHERE e.EncounterType = 'INPATIENT' AND e.EncounterStatus = 'DISCHARGED'"""
SQL["patient_financial_summary_colocated"] = SQL["patient_financial_summary"]
SQL["revenue_cycle_daily"] = SQL["revenue_cycle_summary"]
