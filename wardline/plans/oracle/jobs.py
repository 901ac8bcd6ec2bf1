"""Reference SQL for the batch jobs."""

from wardline.plans.oracle.lookups import _PRIMARY
from wardline.plans.oracle.reports import NOW, TODAY

_ACTOR = f"'SYSTEM' AS ChangedBy, {NOW} AS ChangedDate"


def _pad(expr: str, width: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), CAST(greatest({width}, length(CAST({expr} AS VARCHAR))) AS INTEGER), '0')"


# --- admissions -------------------------------------------------------------------------
_REGISTER = f"""
WITH firsts AS (SELECT * FROM h_registrations QUALIFY SSN IS NULL OR row_number() OVER (PARTITION BY SSN ORDER BY RequestID) = 1),
ok AS (SELECT *, row_number() OVER (ORDER BY RequestID) AS n FROM firsts f WHERE f.SSN IS NULL OR NOT EXISTS (SELECT 1 FROM h_patients p WHERE p.SSN = f.SSN)),
added AS (SELECT RequestID, FirstName, LastName, SSN, DateOfBirth, 'MRN-' || {_pad("n + (SELECT MAX(CAST(split_part(MRN, '-', 2) AS BIGINT)) FROM h_patients)", 6)} AS MRN,
   n + (SELECT MAX(PatientID) FROM h_patients) AS PatientID, 'ACTIVE' AS PatientStatus FROM ok)
"""
_ADMIT = f"""
WITH firsts AS (SELECT * FROM h_admission_requests QUALIFY row_number() OVER (PARTITION BY PatientID, EncounterType ORDER BY RequestID) = 1),
ok AS (SELECT f.* FROM firsts f WHERE EXISTS (SELECT 1 FROM h_patients p WHERE p.PatientID = f.PatientID AND p.PatientStatus = 'ACTIVE')
   AND NOT EXISTS (SELECT 1 FROM h_encounters e WHERE e.PatientID = f.PatientID AND e.EncounterType = f.EncounterType AND e.EncounterStatus = 'ACTIVE')),
numbered AS (SELECT *, CASE EncounterType WHEN 'INPATIENT' THEN 'IP' WHEN 'OUTPATIENT' THEN 'OP' WHEN 'EMERGENCY' THEN 'ER' ELSE 'OB' END || '-20010720-' AS px,
   row_number() OVER (PARTITION BY EncounterType ORDER BY RequestID) AS n, row_number() OVER (ORDER BY RequestID) AS g FROM ok),
filed AS (SELECT left(EncounterNumber, 12) AS px, MAX(CAST(right(EncounterNumber, 4) AS BIGINT)) AS k FROM h_encounters GROUP BY 1),
due AS (SELECT PatientID, SUM(TotalAmount - PaidAmount) AS b FROM h_invoices WHERE InvoiceStatus = 'OPEN' GROUP BY 1),
opened AS (SELECT RequestID, PatientID, EncounterType, AttendingPhysicianID, DepartmentID, AdmitDiagnosis, px || {_pad('COALESCE(k, 0) + n', 4)} AS EncounterNumber,
   g + (SELECT MAX(EncounterID) FROM h_encounters) AS EncounterID, CAST(COALESCE(b, 0) AS DECIMAL(18,2)) AS PatientBalance, {NOW} AS AdmitDate, 'ACTIVE' AS EncounterStatus
   FROM numbered LEFT JOIN filed USING (px) LEFT JOIN due USING (PatientID))
"""
_CLOSING = "WITH closing AS (SELECT e.*, r.DischargeDiagnosis, r.DischargeDisposition FROM h_encounters e JOIN h_discharge_requests r USING (EncounterID) WHERE e.EncounterStatus = 'ACTIVE')\n"
_ORDERED = """
WITH placed AS (SELECT r.*, e.PatientID FROM h_medication_requests r JOIN h_encounters e USING (EncounterID) WHERE e.EncounterStatus = 'ACTIVE'),
named AS (SELECT DISTINCT PatientID, DrugName, GenericName FROM placed),
alive AS (SELECT PatientID, lower(AllergenName) AS k, COUNT(*) AS n, arg_min((AllergyID, AllergenName, Severity, Reaction), AllergyID) AS f
   FROM h_allergies WHERE AllergyType = 'DRUG' AND AllergyStatus = 'ACTIVE' GROUP BY 1, 2),
hits AS (SELECT d.PatientID, d.DrugName, d.GenericName, SUM(a.n) AS AllergyCount,
   '<Warnings>' || string_agg('<AllergyWarning><AllergyID>' || f[1] || '</AllergyID><AllergenName>' || f[2] || '</AllergenName><Severity>' || f[3]
     || '</Severity><Reaction>' || replace(f[4], '&', '&amp;') || '</Reaction></AllergyWarning>', '' ORDER BY f[1]) || '</Warnings>' AS x
   FROM named d JOIN alive a ON a.PatientID = d.PatientID AND (contains(lower(d.DrugName), a.k) OR contains(lower(COALESCE(d.GenericName, '')), a.k)) GROUP BY 1, 2, 3),
checked AS (SELECT p.*, h.AllergyCount, h.x AS InteractionCheckXML FROM placed p LEFT JOIN hits h ON h.PatientID = p.PatientID AND h.DrugName = p.DrugName AND h.GenericName IS NOT DISTINCT FROM p.GenericName)
"""

SQL: dict[str, str] = {
    "register_patients": _REGISTER + "SELECT * FROM added",
    "register_refused": _REGISTER
    + "SELECT RequestID, 'A patient with this SSN already exists.' AS Reason FROM h_registrations WHERE RequestID NOT IN (SELECT RequestID FROM added)",
    "register_audit": _REGISTER
    + f"SELECT 'Patients' AS TableName, PatientID AS RecordID, 'REGISTER' AS Action, 'New patient registered: ' || FirstName || ' ' || LastName || ' MRN: ' || MRN AS NewValues, {_ACTOR} FROM added",
    "admit_encounters": _ADMIT + "SELECT * FROM opened",
    "admit_refused": _ADMIT
    + """SELECT r.RequestID, CASE WHEN p.PatientStatus = 'ACTIVE' THEN 'Patient already has an active encounter of this type.' ELSE 'Patient not found or inactive.' END AS Reason
FROM h_admission_requests r LEFT JOIN h_patients p USING (PatientID) WHERE r.RequestID NOT IN (SELECT RequestID FROM opened)""",
    "admit_messages": _ADMIT
    + """SELECT 'enc-' || EncounterID AS conversation_handle, CAST(0 AS BIGINT) AS message_sequence, 'PatientEncounterMessage' AS message_type,
 '<NewEncounter><EncounterID>' || EncounterID || '</EncounterID><PatientID>' || PatientID || '</PatientID><EncounterType>' || EncounterType
 || '</EncounterType><AdmitDate>2001-07-20T10:30:00</AdmitDate></NewEncounter>' AS body, AdmitDate AS ts FROM opened""",
    "discharge_encounters": _CLOSING
    + f"""SELECT c.EncounterID, c.PatientID, 'DISCHARGED' AS EncounterStatus, {NOW} AS DischargeDate, c.DischargeDiagnosis, c.DischargeDisposition,
 CAST(COALESCE((SELECT SUM(b.ChargeAmount) FROM h_billing_charges b WHERE b.EncounterID = c.EncounterID), 0) AS DECIMAL(18,2)) AS TotalCharges FROM closing c""",
    "discharge_medications": _CLOSING
    + f"SELECT MedicationID, EncounterID, 'COMPLETED' AS MedicationStatus, {NOW} AS EndDate FROM h_medications WHERE MedicationStatus = 'ACTIVE' AND EncounterID IN (SELECT EncounterID FROM closing)",
    "discharge_orders": _CLOSING
    + f"SELECT OrderID, EncounterID, 'CANCELLED' AS OrderStatus, {NOW} AS CancelledDate, 'Patient discharged' AS CancelledReason FROM h_orders WHERE OrderStatus IN ('ORDERED', 'IN_PROGRESS') AND EncounterID IN (SELECT EncounterID FROM closing)",
    "discharge_notes": _CLOSING
    + "SELECT EncounterID, PatientID, 'DISCHARGE_SUMMARY' AS NoteType, AttendingPhysicianID AS AuthorID, 'Auto-generated discharge summary. Disposition: ' || DischargeDisposition || '. Diagnosis: ' || COALESCE(DischargeDiagnosis, 'Not specified') AS NoteContent, 'DRAFT' AS NoteStatus FROM closing",
    "allergy_warnings": _ORDERED
    + "SELECT RequestID, PatientID, DrugName, GenericName, CAST(AllergyCount AS BIGINT) AS AllergyCount, InteractionCheckXML FROM checked WHERE AllergyCount > 0",
    "allergy_audit": _ORDERED
    + f"SELECT 'Medications' AS TableName, CAST(0 AS BIGINT) AS RecordID, 'ALLERGY_WARNING' AS Action, 'Drug allergy warning for patient ' || PatientID || ': ' || DrugName || ' - ' || CAST(AllergyCount AS BIGINT) || ' allergy match(es)' AS NewValues, {_ACTOR} FROM checked WHERE AllergyCount > 0",
    "medication_orders": _ORDERED
    + "SELECT RequestID, EncounterID, PatientID, 'MEDICATION' AS OrderType, DrugCode AS OrderCode, DrugName || ' ' || Dosage || ' ' || Route AS OrderDescription, PrescribingPhysicianID AS OrderingPhysicianID, 'ROUTINE' AS OrderPriority, 'ORDERED' AS OrderStatus FROM placed",
    "medications_ordered": _ORDERED
    + f"SELECT RequestID, EncounterID, PatientID, DrugCode, DrugName, GenericName, Dosage, Route, Frequency, {NOW} AS StartDate, PrescribingPhysicianID, 'ACTIVE' AS MedicationStatus, InteractionCheckXML FROM checked",
}

# --- billing ----------------------------------------------------------------------------
_FEES = f"""fees AS (SELECT CPTCode, ChargeCode, RevenueCode, StandardCharge FROM h_chargemaster
   WHERE IsActive = 1 AND CPTCode IS NOT NULL AND EffectiveDate <= {TODAY} AND (ExpirationDate IS NULL OR ExpirationDate > {TODAY})
   QUALIFY row_number() OVER (PARTITION BY CPTCode ORDER BY EffectiveDate DESC, ChargeCode DESC) = 1)"""


def _posting(types: str = "", extra: str = "") -> str:
    return f"""
WITH {_FEES}, {_PRIMARY},
act AS (SELECT EncounterID, DepartmentID FROM h_encounters WHERE EncounterStatus = 'ACTIVE' {types}),
due AS (SELECT p.*, a.DepartmentID FROM h_procedures p JOIN act a USING (EncounterID) WHERE p.ProcedureStatus = 'COMPLETED'
   AND NOT EXISTS (SELECT 1 FROM h_billing_charges b WHERE b.EncounterID = p.EncounterID AND b.CPTCode = p.CPTCode AND b.ServiceDate = p.ProcedureDate)),
added AS (SELECT u.EncounterID, u.PatientID, f.ChargeCode, u.CPTCode, f.RevenueCode, u.CPTDescription AS ChargeDescription, u.ProcedureDate AS ServiceDate, 1 AS Quantity,
   f.StandardCharge AS UnitPrice, f.StandardCharge AS ChargeAmount, d.DepartmentCode, ph.NPI AS PerformingPhysicianNPI, dx.code AS DiagnosisCode1, 'POSTED' AS ChargeStatus
   FROM due u JOIN fees f USING (CPTCode) LEFT JOIN h_departments d USING (DepartmentID) LEFT JOIN h_physicians ph ON ph.PhysicianID = u.PerformingPhysicianID LEFT JOIN dx ON dx.EncounterID = u.EncounterID),
totals AS (SELECT a.EncounterID, CAST(SUM(s.amt) AS DECIMAL(18,2)) AS TotalCharges, COUNT(s.isnew) AS Posted FROM act a LEFT JOIN (
   SELECT EncounterID, ChargeAmount AS amt, NULL AS isnew FROM h_billing_charges WHERE ChargeStatus = 'POSTED' UNION ALL SELECT EncounterID, ChargeAmount, 1 FROM added) s USING (EncounterID) GROUP BY 1)
{extra}"""


_ROOM = f"""room AS (SELECT e.EncounterID, e.PatientID, f.ChargeCode, CASE e.EncounterType WHEN 'INPATIENT' THEN 'Room & Board - Semi-Private' ELSE 'Observation Room' END AS ChargeDescription,
   {NOW} AS ServiceDate, f.StandardCharge AS UnitPrice, f.StandardCharge AS ChargeAmount, 'POSTED' AS ChargeStatus
 FROM h_encounters e JOIN h_chargemaster f ON f.IsActive = 1 AND f.ChargeCode = CASE e.EncounterType WHEN 'INPATIENT' THEN 'RC-SEMI-PRIV' WHEN 'OBSERVATION' THEN 'RC-OBS' END
 WHERE e.EncounterStatus = 'ACTIVE' AND NOT EXISTS (SELECT 1 FROM h_billing_charges b WHERE b.EncounterID = e.EncounterID AND b.ChargeCode = f.ChargeCode AND CAST(b.ServiceDate AS DATE) = {TODAY}))"""


def _claims(days: int) -> str:
    return f"""
WITH due AS (SELECT e.EncounterID, e.PatientID, e.PreAuthNumber, p.PrimaryInsuranceID AS ins, p.PrimaryPolicyNumber AS pol, p.PrimaryGroupNumber AS grp
   FROM h_encounters e JOIN h_patients p USING (PatientID) WHERE e.EncounterStatus = 'DISCHARGED' AND e.DischargeDate >= {NOW} - INTERVAL {days} DAY AND p.PrimaryInsuranceID IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM h_insurance_claims c WHERE c.EncounterID = e.EncounterID)),
n AS (SELECT *, row_number() OVER (ORDER BY EncounterID) AS n FROM due),
bill AS (SELECT *, ChargeAmount - AdjustmentAmount AS net FROM h_billing_charges WHERE ChargeStatus IN ('POSTED', 'BILLED')),
sums AS (SELECT EncounterID, SUM(net) AS t FROM bill GROUP BY 1),
heads AS (SELECT n.n + (SELECT MAX(ClaimID) FROM h_insurance_claims) AS ClaimID,
   'CLM-20010720-' || {_pad("n.n + (SELECT COALESCE(MAX(CAST(right(ClaimNumber, 5) AS BIGINT)), 0) FROM h_insurance_claims WHERE ClaimNumber LIKE 'CLM-20010720-%')", 5)} AS ClaimNumber,
   n.EncounterID, n.PatientID, n.ins AS InsuranceProviderID, i.PayerID, n.pol AS PolicyNumber, n.grp AS GroupNumber, 'INSTITUTIONAL' AS ClaimType, 'UB04' AS ClaimForm,
   CAST(COALESCE(s.t, 0) AS DECIMAL(18,2)) AS TotalCharges, 'CREATED' AS ClaimStatus, n.PreAuthNumber
   FROM n LEFT JOIN sums s USING (EncounterID) LEFT JOIN h_insurers i ON i.InsuranceProviderID = n.ins),
lines AS (SELECT h.ClaimID, row_number() OVER (PARTITION BY h.ClaimID ORDER BY b.ServiceDate, b.ChargeID, COALESCE(b.CPTCode, b.ChargeCode), b.net, b.Quantity) AS LineNumber, b.ChargeID,
   CAST(b.ServiceDate AS DATE) AS ServiceDate, COALESCE(b.CPTCode, b.ChargeCode) AS CPTCode, '1' AS DiagnosisPointer, b.Quantity, b.net AS ChargeAmount, 'PENDING' AS LineStatus
   FROM heads h JOIN bill b USING (EncounterID))
"""


_EDI_PAYER = "COALESCE(PayerID, 'UNKNOWN')"
_NET_OF_FILE = "net AS (SELECT PatientID, EncounterID, SUM(ChargeAmount - AdjustmentAmount) AS c, bool_or(ChargeStatus = 'POSTED') AS posted FROM h_billing_charges WHERE ChargeStatus IN ('POSTED', 'BILLED') GROUP BY 1, 2)"
_NET_OF_RUN = "net AS (SELECT PatientID, EncounterID, SUM(net) AS c, bool_or(posted) AS posted FROM charged GROUP BY 1, 2)"
_INVOICES = f"""
WITH {_NET_OF_FILE},
paid AS (SELECT PatientID, EncounterID, SUM(PaymentAmount) AS p FROM h_payments WHERE PaymentStatus IN ('POSTED', 'APPLIED') GROUP BY 1, 2),
owed AS (SELECT n.PatientID, n.EncounterID, n.c - COALESCE(p.p, 0) AS b FROM net n LEFT JOIN paid p USING (PatientID, EncounterID)
   WHERE n.posted AND n.c - COALESCE(p.p, 0) > 0 AND n.EncounterID NOT IN (SELECT EncounterID FROM h_insurance_claims)
   AND n.EncounterID NOT IN (SELECT EncounterID FROM h_invoices WHERE EncounterID IS NOT NULL) AND n.PatientID NOT IN (SELECT PatientID FROM h_patients WHERE PrimaryInsuranceID IS NOT NULL)),
k AS (SELECT *, row_number() OVER (ORDER BY EncounterID, PatientID) AS n FROM owed)
SELECT n + (SELECT MAX(InvoiceID) FROM h_invoices) AS InvoiceID,
       'INV-200107-' || {_pad("n + (SELECT COALESCE(MAX(CAST(right(InvoiceNumber, 5) AS BIGINT)), 0) FROM h_invoices WHERE InvoiceNumber LIKE 'INV-200107-%')", 5)} AS InvoiceNumber,
       PatientID, EncounterID, {TODAY} AS InvoiceDate, {TODAY} + 30 AS DueDate, CAST(b AS DECIMAL(18,2)) AS TotalAmount, CAST(0 AS DECIMAL(18,2)) AS PaidAmount, 'OPEN' AS InvoiceStatus FROM k"""

SQL.update({
    "procedure_charges": _posting() + "SELECT * FROM added",
    "unpriced_procedures": _posting() + "SELECT ProcedureID, EncounterID, CPTCode FROM due WHERE CPTCode NOT IN (SELECT CPTCode FROM fees)",
    "charge_totals": _posting() + "SELECT * FROM totals",
    "charge_posting_audit": _posting()
    + f"SELECT 'BillingCharges' AS TableName, EncounterID AS RecordID, 'CHARGE_POSTING' AS Action, 'Posted ' || Posted || ' charges totaling $' || TotalCharges || ' for encounter ' || EncounterID AS NewValues, {_ACTOR} FROM totals",
    "current_fees": f"WITH {_FEES} SELECT * FROM fees",
    "room_charges": f"WITH {_ROOM} SELECT * FROM room",
    "claims_created": _claims(1) + "SELECT * FROM heads",
    "claim_lines": _claims(1) + "SELECT * FROM lines",
    "claim_billed_charges": _claims(1)
    + "SELECT b.* REPLACE ('BILLED' AS ChargeStatus) FROM h_billing_charges b WHERE b.ChargeStatus = 'POSTED' AND b.EncounterID IN (SELECT EncounterID FROM due)",
    "claims_created_backlog": _claims(3650) + "SELECT * FROM heads",
    "claim_lines_backlog": _claims(3650) + "SELECT * FROM lines",
    "claims_submitted": f"""
SELECT ClaimID, ClaimNumber, 'SUBMITTED' AS ClaimStatus, {NOW} AS SubmittedDate, 'EDI-20010720103000' AS EDIBatchID,
 'ISA*00*          *00*          *ZZ*HOSPITAL       *ZZ*' || {_EDI_PAYER} || '*010720*1030~' || chr(13) || chr(10) || 'GS*HC*HOSPITAL*' || {_EDI_PAYER} || '*20010720~' || chr(13) || chr(10)
 || 'ST*837*0001~' || chr(13) || chr(10) || 'CLM*' || ClaimNumber || '~' || chr(13) || chr(10) || 'SE*4*0001~GE*1~IEA*1~' AS EDI837Content
FROM h_insurance_claims WHERE ClaimStatus = 'CREATED'""",
    "claims_submitted_audit": f"SELECT 'InsuranceClaims' AS TableName, ClaimID AS RecordID, 'CLAIM_SUBMITTED' AS Action, 'Claim ' || ClaimNumber || ' submitted in batch EDI-20010720103000' AS NewValues, {_ACTOR} FROM h_insurance_claims WHERE ClaimStatus = 'CREATED'",
    "self_pay_invoices": _INVOICES,
    "reconcile_encounters": f"""
WITH b AS (SELECT EncounterID, SUM(ChargeAmount - AdjustmentAmount) AS c FROM h_billing_charges WHERE ChargeStatus <> 'VOIDED' GROUP BY 1),
y AS (SELECT EncounterID, SUM(PaymentAmount) AS p FROM h_payments WHERE PaymentStatus <> 'VOIDED' GROUP BY 1)
SELECT e.EncounterID, CAST(COALESCE(c, 0) AS DECIMAL(18,2)) AS TotalCharges, CAST(COALESCE(p, 0) AS DECIMAL(18,2)) AS TotalPayments, CAST(COALESCE(c, 0) - COALESCE(p, 0) AS DECIMAL(18,2)) AS PatientBalance
FROM h_encounters e LEFT JOIN b USING (EncounterID) LEFT JOIN y USING (EncounterID) WHERE e.EncounterStatus IN ('ACTIVE', 'DISCHARGED') AND e.AdmitDate >= {NOW} - INTERVAL 1 YEAR""",
    "default_plans": f"SELECT PaymentPlanID, PatientID, 'DEFAULTED' AS PlanStatus, {NOW} AS DefaultedDate FROM h_payment_plans WHERE PlanStatus = 'ACTIVE' AND NextPaymentDate < {NOW} - INTERVAL 60 DAY",
    "send_to_collections": f"""SELECT InvoiceID, PatientID, 'COLLECTIONS' AS InvoiceStatus, 1 AS SentToCollections, {NOW} AS CollectionDate, CAST(TotalAmount - PaidAmount AS DECIMAL(18,2)) AS BalanceDue
FROM h_invoices WHERE InvoiceStatus = 'OPEN' AND date_diff('day', DueDate, {TODAY}) > 120 AND TotalAmount - PaidAmount > 50""",
    "adjudicate_claims": f"""SELECT ClaimID, 'ADJUDICATED' AS ClaimStatus, {NOW} AS AdjudicatedDate, CAST(TotalCharges * CAST(0.80 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS AllowedAmount
FROM h_insurance_claims WHERE ClaimStatus = 'SUBMITTED' AND date_diff('day', SubmittedDate, {NOW}) > 14""",
    "claims_appealed": f"SELECT ClaimID, 'APPEALED' AS ClaimStatus, {NOW} AS AppealedDate FROM h_insurance_claims WHERE ClaimStatus = 'DENIED' AND date_diff('day', {TODAY}, AppealDeadline) BETWEEN 1 AND 30 AND TotalCharges > 500",
    "claims_appeal_expired": f"""SELECT 'InsuranceClaims' AS TableName, ClaimID AS RecordID, 'APPEAL_EXPIRED' AS Action, 'Claim ' || ClaimNumber || ' denial is past appeal deadline ($' || TotalCharges || ')' AS NewValues, {_ACTOR}
FROM h_insurance_claims WHERE ClaimStatus = 'DENIED' AND AppealDeadline < {NOW} AND ClaimID NOT IN (SELECT RecordID FROM h_billing_audit WHERE TableName = 'InsuranceClaims' AND Action = 'APPEAL_EXPIRED')""",
    "nightly_summary": _posting("AND EncounterType IN ('INPATIENT', 'OBSERVATION')", f", {_ROOM}")
    + "SELECT * FROM (SELECT 'ROOM_CHARGE' AS Action, 'SUCCESS' AS Result, COUNT(*) AS Count FROM room UNION ALL SELECT 'ROOM_CHARGE', 'ERROR', COUNT(DISTINCT EncounterID) FROM due WHERE CPTCode NOT IN (SELECT CPTCode FROM fees)"
    + " UNION ALL SELECT 'CLAIM_CREATED', 'SUCCESS', (" + _claims(1) + "SELECT COUNT(*) FROM heads)) WHERE Count > 0",
    # Self-pay invoices also see the room and procedure charges the run has just posted.
    "nightly_invoices": _posting("AND EncounterType IN ('INPATIENT', 'OBSERVATION')", f""", {_ROOM},
charged AS (SELECT PatientID, EncounterID, ChargeAmount - AdjustmentAmount AS net, ChargeStatus = 'POSTED' AS posted FROM h_billing_charges WHERE ChargeStatus IN ('POSTED', 'BILLED')
   UNION ALL SELECT PatientID, EncounterID, ChargeAmount, TRUE FROM room UNION ALL SELECT PatientID, EncounterID, ChargeAmount, TRUE FROM added),
""") + _INVOICES.strip().removeprefix("WITH ").replace(_NET_OF_FILE, _NET_OF_RUN),
    # Claims and lines touch discharged visits, room and procedure charges only active ones.
    "nightly_claim_lines": _claims(1) + "SELECT * FROM lines",
    # Every step of a repeated run adds nothing; the visits only say that the tables are there.
    "nightly_second_run": "SELECT Step, COUNT(*) FILTER (WHERE EncounterID IS NULL) AS Rows FROM (VALUES ('room_charges'), ('procedure_charges'), ('claims'), ('claim_lines'), ('submitted'), ('invoices')) AS s(Step), h_encounters GROUP BY Step",
    "nightly_claims_after": _claims(1) + """SELECT ClaimID, ClaimNumber, EncounterID, CAST(TotalCharges AS DECIMAL(18,2)) AS TotalCharges, CASE ClaimStatus WHEN 'CREATED' THEN 'SUBMITTED' ELSE ClaimStatus END AS ClaimStatus,
       CASE ClaimStatus WHEN 'CREATED' THEN 'EDI-20010720103000' END AS EDIBatchID
FROM (SELECT ClaimID, ClaimNumber, EncounterID, TotalCharges, ClaimStatus FROM h_insurance_claims UNION ALL SELECT ClaimID, ClaimNumber, EncounterID, TotalCharges, ClaimStatus FROM heads)""",
    "nightly_visit_totals": _posting("AND EncounterType IN ('INPATIENT', 'OBSERVATION')", f", {_ROOM}") + """, due_claims AS (""" + _claims(1) + """SELECT EncounterID FROM heads),
 all_charges AS (SELECT EncounterID, CASE WHEN ChargeStatus = 'POSTED' AND EncounterID IN (SELECT EncounterID FROM due_claims) THEN 'BILLED' ELSE ChargeStatus END AS s, ChargeAmount, ChargeStatus FROM h_billing_charges
   UNION ALL SELECT EncounterID, 'POSTED', ChargeAmount, 'POSTED' FROM room UNION ALL SELECT EncounterID, 'POSTED', ChargeAmount, 'POSTED' FROM added),
 sums AS (SELECT EncounterID, COUNT(*) FILTER (WHERE s = 'POSTED') AS OpenCharges, SUM(ChargeAmount) FILTER (WHERE ChargeStatus = 'POSTED') AS total FROM all_charges GROUP BY 1)
SELECT e.EncounterID, CAST(CASE WHEN e.EncounterStatus = 'ACTIVE' AND e.EncounterType IN ('INPATIENT', 'OBSERVATION') THEN COALESCE(total, 0) ELSE e.TotalCharges END AS DECIMAL(18,2)) AS TotalCharges,
       COALESCE(OpenCharges, 0) AS OpenCharges FROM h_encounters e LEFT JOIN sums USING (EncounterID)""",
})

# --- retention --------------------------------------------------------------------------
_CUTOFF = "DATE '1998-07-20'"
_OLD = f"old AS (SELECT EncounterID, PatientID, AdmitDate FROM h_encounters WHERE EncounterStatus = 'DISCHARGED' AND DischargeDate < {_CUTOFF})"
_ALL_OLD = f"gone AS (SELECT EncounterID FROM h_encounters WHERE EncounterStatus = 'DISCHARGED' AND DischargeDate < {_CUTOFF})"
_CHILDREN = ["vitals", "lab_results", "medications", "orders", "clinical_notes", "diagnoses", "procedures", "radiology_studies"]
_LIVE = "SELECT EncounterID FROM h_encounters WHERE EncounterID NOT IN (SELECT EncounterID FROM gone)"
_PURGED_CHARGES = f"ServiceDate < {_CUTOFF} AND EncounterID NOT IN ({_LIVE})"
_CLOSED = f"InvoiceStatus IN ('PAID', 'WRITTEN_OFF', 'VOIDED') AND InvoiceDate < {_CUTOFF}"
_STALE = f"ChangedDate < {NOW} - INTERVAL 3 YEAR"


def _sides(table: str, label: str, moved: str, kept: str, condition: str) -> str:
    return (
        f"SELECT '{label}' AS TableName, '{moved}' AS Side, COUNT(*) FILTER (WHERE {condition}) AS Rows FROM {table} "
        f"UNION ALL SELECT '{label}', '{kept}', COUNT(*) FILTER (WHERE NOT ({condition})) FROM {table}"
    )


SQL.update({
    "archive_dry_run": f"WITH {_OLD} SELECT *, 'WOULD_ARCHIVE' AS ArchiveStatus FROM old",
    "literal_appointments": f"""SELECT v.AppointmentType, p.PatientID, {TODAY} + v.DayOffset AS AppointmentDate FROM h_patients p JOIN (VALUES ('MRN-000001', 1, 'CONSULT'), ('MRN-000002', 3, 'FOLLOW_UP'),
       ('MRN-999999', 3, 'CONSULT'), ('MRN-000002', -2, 'PROCEDURE'), ('MRN-000007', 0, 'CONSULT')) AS v(MRN, DayOffset, AppointmentType) USING (MRN)""",
    "archive_oldest_500": f"WITH {_OLD} SELECT *, 'WOULD_ARCHIVE' AS ArchiveStatus FROM (SELECT EncounterID, PatientID, AdmitDate FROM h_encounters WHERE EncounterID IN (SELECT EncounterID FROM old) ORDER BY DischargeDate, EncounterID LIMIT 500)",
    "archive_marked": f"WITH {_OLD} SELECT * REPLACE (CASE WHEN EncounterID IN (SELECT EncounterID FROM old) THEN 'ARCHIVED' ELSE EncounterStatus END AS EncounterStatus), CASE WHEN EncounterID IN (SELECT EncounterID FROM old) THEN TIMESTAMP '2001-07-20 10:30:00' END AS ModifiedDate FROM h_encounters",
    "archive_summary": f"WITH {_OLD} SELECT 'ARCHIVED' AS ArchiveStatus, COUNT(*) AS RecordCount FROM old",
    "archive_moved_diagnoses": f"WITH {_OLD} SELECT * FROM h_diagnoses WHERE EncounterID IN (SELECT EncounterID FROM old)",
    "archive_kept_labs": f"WITH {_OLD} SELECT * FROM h_lab_results WHERE EncounterID NOT IN (SELECT EncounterID FROM old)",
    "archive_split_counts": f"WITH {_OLD} " + " UNION ALL ".join(_sides(f"h_{n}", n, "moved", "kept", "EncounterID IN (SELECT EncounterID FROM old)") for n in _CHILDREN),
    "purged_charges": f"WITH {_ALL_OLD} SELECT * FROM h_billing_charges WHERE {_PURGED_CHARGES}",
    "purge_kept_invoices": f"SELECT * FROM h_invoices WHERE NOT ({_CLOSED})",
    "purge_split_counts": f"WITH {_ALL_OLD} " + " UNION ALL ".join([
        _sides("h_invoices", "invoices", "purged", "kept", _CLOSED),
        _sides("h_billing_charges", "charges", "purged", "kept", _PURGED_CHARGES),
        _sides("h_audit_log", "audit_log", "purged", "kept", _STALE),
        _sides("h_billing_audit", "billing_audit", "purged", "kept", _STALE),
    ]),
    "sync_chargemaster": "SELECT ChargeCode, CPTCode, RevenueCode, ChargeDescription, StandardCharge, MedicareRate, MedicaidRate, CAST(StandardCharge * CAST(0.85 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS CommercialRate, EffectiveDate FROM h_chargemaster",
    "appointment_extract": """
SELECT a.*, (SELECT RoomID FROM h_rooms WHERE RoomType = 'EXAM' ORDER BY RoomNumber LIMIT 1) AS RoomID, p.LastName || ', ' || p.FirstName AS PatientName,
       COALESCE(p.MobilePhone, p.HomePhone) AS PatientPhone FROM h_appointments a JOIN h_patients p USING (PatientID)""",
})

SQL.update({
    "charges_after_billing_and_purge": f"""
WITH billed AS (SELECT DISTINCT EncounterID FROM ({SQL["claim_billed_charges"]})), left_over AS (SELECT * FROM h_billing_charges EXCEPT ALL SELECT * FROM ({SQL["purged_charges"]}))
SELECT * REPLACE (CASE WHEN ChargeStatus = 'POSTED' AND EncounterID IN (SELECT EncounterID FROM billed) THEN 'BILLED' ELSE ChargeStatus END AS ChargeStatus) FROM left_over""",
    "visits_after_archive": f"""
WITH {_OLD} SELECT 'archive' AS Side, * REPLACE ('ARCHIVED' AS EncounterStatus) FROM h_encounters WHERE EncounterID IN (SELECT EncounterID FROM old)
UNION ALL SELECT 'active', * FROM h_encounters WHERE EncounterID NOT IN (SELECT EncounterID FROM old)""",
    "reconcile_encounters_colocated": SQL["reconcile_encounters"],
    "procedure_charges_colocated": SQL["procedure_charges"],
})

_OWN_DAY = "m.IsActive = 1 AND m.EffectiveDate <= k.d AND (m.ExpirationDate IS NULL OR m.ExpirationDate > k.d)"


def _on_date(rows: str, day: str, columns: str) -> str:
    """Rows with the latest effective fee that is valid on their own day, found once per code and day."""
    return f"""SELECT {columns} FROM {rows} x LEFT JOIN (
   SELECT k.CPTCode, k.d, m.ChargeCode AS fee_code, m.RevenueCode AS fee_revenue, m.StandardCharge AS fee,
     row_number() OVER (PARTITION BY k.CPTCode, k.d ORDER BY m.EffectiveDate DESC, m.ChargeCode DESC, m.RevenueCode DESC, m.StandardCharge DESC) AS nr
   FROM (SELECT DISTINCT CPTCode, CAST({day} AS DATE) AS d FROM {rows}) k JOIN h_chargemaster m ON m.CPTCode = k.CPTCode AND {_OWN_DAY}) f
   ON f.CPTCode = x.CPTCode AND f.d = CAST(x.{day} AS DATE) AND f.nr = 1"""


SQL.update({
    "backdated_charges": """
WITH late AS (SELECT p.* FROM h_procedures p WHERE p.ProcedureStatus = 'COMPLETED' AND p.EncounterID IN (SELECT EncounterID FROM h_encounters WHERE EncounterStatus = 'DISCHARGED')
   AND NOT EXISTS (SELECT 1 FROM h_billing_charges b WHERE b.EncounterID = p.EncounterID AND b.CPTCode = p.CPTCode AND b.ServiceDate = p.ProcedureDate))
"""
    + _on_date("late", "ProcedureDate", "x.ProcedureID, x.EncounterID, x.CPTCode, x.ProcedureDate AS ServiceDate, fee_code AS ChargeCode, fee_revenue AS RevenueCode, fee AS UnitPrice"),
    "charge_fees_on_date": _on_date(
        "h_billing_charges", "ServiceDate",
        "x.ChargeID, x.CPTCode, x.ServiceDate, x.ChargeAmount, fee_code AS ChargeCode, fee_revenue AS RevenueCode, fee AS StandardCharge",
    ),
    "order_distinct_counts": "SELECT OrderType, COUNT(DISTINCT EncounterID) AS Visits, COUNT(DISTINCT PatientID) AS Patients, COUNT(DISTINCT OrderingPhysicianID) AS Physicians FROM h_orders GROUP BY 1",
    "department_distinct_visits": "SELECT DepartmentID, EncounterType, COUNT(DISTINCT EncounterID) AS Visits, COUNT(DISTINCT PatientID) AS Patients FROM h_encounters WHERE EncounterStatus = 'ACTIVE' GROUP BY 1, 2",
})
