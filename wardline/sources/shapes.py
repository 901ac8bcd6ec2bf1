"""Hospital-shaped projections of the star-schema test tables.

Each text is plain SQL that Spark and DuckDB both run; ``{name}`` marks an input
table. The library itself never refers to these: it only sees hospital columns.
The events month (January 2024) is moved onto July 2001 so that labs, notes,
appointments and visits share one as-of time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.workspace import exists, run_dir

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Line items with the patient of their visit: the common base of clinical facts.
_LINES = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
_LINE_ID = "l_orderkey * 8 + l_linenumber"
_JULY = "INTERVAL '8219' DAY"

# Drug vocabulary of the projections: every anchor and partner of the interaction table.
_DRUG = """CASE {k} % 19
    WHEN 0 THEN 'WARFARIN' WHEN 1 THEN 'ASPIRIN' WHEN 2 THEN 'IBUPROFEN' WHEN 3 THEN 'AMIODARONE'
    WHEN 4 THEN 'FLUCONAZOLE' WHEN 5 THEN 'METRONIDAZOLE' WHEN 6 THEN 'METFORMIN' WHEN 7 THEN 'CONTRAST_DYE'
    WHEN 8 THEN 'ALCOHOL' WHEN 9 THEN 'LISINOPRIL' WHEN 10 THEN 'POTASSIUM' WHEN 11 THEN 'SPIRONOLACTONE'
    WHEN 12 THEN 'NSAID' WHEN 13 THEN 'SIMVASTATIN' WHEN 14 THEN 'CLARITHROMYCIN' WHEN 15 THEN 'GRAPEFRUIT'
    WHEN 16 THEN 'DIGOXIN' WHEN 17 THEN 'VERAPAMIL' ELSE 'FUROSEMIDE' END"""


def _drug(key: str) -> str:
    return _DRUG.replace("{k}", key)


def _pad(expr: str, width: int) -> str:
    return f"RIGHT(CONCAT('{'0' * width}', CAST({expr} AS STRING)), {width})"


def _ymd(column: str) -> str:
    return f"REPLACE(CAST(CAST({column} AS DATE) AS STRING), '-', '')"


_SUPPLIERS = "(SELECT COUNT(*) FROM {supplier})"
_TYPE = ("CASE o_orderkey % 4 WHEN 0 THEN 'INPATIENT' WHEN 1 THEN 'OUTPATIENT' "
         "WHEN 2 THEN 'EMERGENCY' ELSE 'OBSERVATION' END")
_INSURER = "CASE WHEN {k} % 10 = 0 THEN NULL ELSE CAST({k} % 5 AS INT) END"

SHAPES: dict[str, str] = {
    "departments": """
SELECT n_nationkey AS DepartmentID, n_name AS DepartmentCode, CONCAT('Dept ', n_name) AS DepartmentName,
       n_regionkey + 1 AS FloorNumber, CASE WHEN n_nationkey % 7 = 6 THEN 0 ELSE 1 END AS IsActive
FROM {nation}""",
    "insurers": """
SELECT r_regionkey AS InsuranceProviderID, r_name AS ProviderName,
       CASE WHEN r_regionkey = 4 THEN NULL ELSE CONCAT('PAY', CAST(r_regionkey AS STRING)) END AS PayerID
FROM {region}""",
    "patients": f"""
SELECT c_custkey AS PatientID, CONCAT('MRN-', {_pad('c_custkey', 6)}) AS MRN,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE CONCAT('900-', {_pad('c_custkey % 100', 2)}, '-', {_pad('c_custkey', 7)}) END AS SSN,
       c_mktsegment AS FirstName, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Quinn' ELSE '' END AS MiddleName,
       c_name AS LastName, CASE WHEN c_custkey % 29 = 0 THEN 'Jr' END AS Suffix,
       DATE '1930-01-01' + CAST((c_custkey * 37) % 26000 AS INT) AS DateOfBirth,
       CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'U' END AS Gender,
       CONCAT(CAST(c_custkey AS STRING), ' Main St') AS Address1, CONCAT('City ', CAST(c_nationkey AS STRING)) AS City,
       CONCAT('S', CAST(c_nationkey % 10 AS STRING)) AS State, {_pad('c_custkey', 5)} AS ZipCode,
       CONCAT('555-1', {_pad('c_custkey', 6)}) AS HomePhone,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CONCAT('555-2', {_pad('c_custkey', 6)}) END AS MobilePhone,
       CONCAT('555-3', {_pad('c_custkey * 3', 6)}) AS WorkPhone, CONCAT('p', CAST(c_custkey AS STRING), '@mail.test') AS Email,
       {_INSURER.replace('{k}', 'c_custkey')} AS PrimaryInsuranceID,
       CONCAT('POL-', CAST(c_custkey AS STRING)) AS PrimaryPolicyNumber, CONCAT('GRP-', CAST(c_custkey % 20 AS STRING)) AS PrimaryGroupNumber,
       CONCAT('SEC-', CAST(c_custkey * 2 AS STRING)) AS SecondaryPolicyNumber,
       CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS PatientStatus,
       CASE WHEN c_custkey % 41 = 0 THEN 1 ELSE 0 END AS DeceasedIndicator,
       TIMESTAMP_NTZ '1995-01-01 00:00:00' + (c_custkey % 2000) * INTERVAL '1' DAY AS CreatedDate
FROM {{customer}}""",
    "physicians": f"""
SELECT s_suppkey AS PhysicianID, {_pad('s_suppkey', 10)} AS NPI, s_name AS LastName, 'Dr' AS FirstName,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'MD' END AS Credentials,
       CONCAT('Specialty ', CAST(s_suppkey % 12 AS STRING)) AS Specialty, s_nationkey AS DepartmentID,
       CONCAT('555-9', {_pad('s_suppkey', 6)}) AS Phone, CASE WHEN s_suppkey % 9 = 8 THEN 0 ELSE 1 END AS IsActive,
       CASE WHEN s_suppkey % 5 = 4 THEN NULL ELSE CONCAT(
            '<Schedule><Day name="Monday" startTime="07:00" endTime="19:00" location="W', CAST(s_nationkey AS STRING), '" onCall="0"/>',
            CASE WHEN s_suppkey % 2 = 0 THEN '<Day name="Friday" startTime="19:00" endTime="07:00" location="ER" onCall="1"/>' ELSE '' END,
            '</Schedule>') END AS WeeklyScheduleXML
FROM {{supplier}}""",
    "encounters": f"""
SELECT o_orderkey AS EncounterID,
       CONCAT(CASE o_orderkey % 4 WHEN 0 THEN 'IP' WHEN 1 THEN 'OP' WHEN 2 THEN 'ER' ELSE 'OB' END, '-', {_ymd('o_orderdate')}, '-', {_pad('o_orderkey', 4)}) AS EncounterNumber,
       CASE WHEN o_orderkey % 12 = 0 AND CAST(o_orderdate AS DATE) >= DATE '2001-03-01' THEN o_custkey % 20 ELSE o_custkey END AS PatientID, {_TYPE} AS EncounterType,
       CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'DISCHARGED' ELSE 'CANCELLED' END AS EncounterStatus,
       o_orderdate + ((o_orderkey * 7) % 1440) * INTERVAL '1' MINUTE AS AdmitDate,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (o_orderkey % 12) * INTERVAL '1' DAY
            + ((o_orderkey * 7) % 1440 + (o_orderkey % 5) * 60) * INTERVAL '1' MINUTE END AS DischargeDate,
       o_orderkey % {_SUPPLIERS} AS AttendingPhysicianID, CAST(o_custkey % 25 AS INT) AS DepartmentID,
       CONCAT('R', CAST(o_orderkey % 300 AS STRING)) AS RoomNumber, CONCAT('B', CAST(o_orderkey % 3 AS STRING)) AS BedNumber,
       o_orderpriority AS AdmitDiagnosis, CASE WHEN o_orderkey % 6 = 0 THEN CONCAT('PA', CAST(o_orderkey AS STRING)) END AS PreAuthNumber,
       CAST(o_totalprice AS DECIMAL(12,2)) AS TotalCharges,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS TotalPayments,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS PatientBalance
FROM {{orders}}""",
    "orders": f"""
SELECT {_LINE_ID} AS OrderID, l_orderkey AS EncounterID, o_custkey AS PatientID,
       CASE l_linenumber % 4 WHEN 0 THEN 'RADIOLOGY' WHEN 1 THEN 'LAB' WHEN 2 THEN 'MEDICATION' ELSE 'LAB' END AS OrderType,
       CONCAT('T', CAST(l_partkey % 40 AS STRING)) AS OrderCode, CONCAT('Test ', CAST(l_partkey AS STRING)) AS OrderDescription,
       CASE WHEN l_partkey % 8 = 0 THEN 'STAT' ELSE 'ROUTINE' END AS OrderPriority,
       CASE WHEN l_partkey % 8 = 0 THEN 1 ELSE 0 END AS IsStatOrder, l_suppkey AS OrderingPhysicianID,
       o_orderdate + ((o_orderkey * 7) % 1440 + 5 + l_partkey % 900) * INTERVAL '1' MINUTE AS OrderDate,
       CASE l_returnflag WHEN 'N' THEN 'ORDERED' WHEN 'A' THEN 'COMPLETED' ELSE CASE WHEN l_linestatus = 'O' THEN 'IN_PROGRESS' ELSE 'CANCELLED' END END AS OrderStatus
FROM {_LINES}""",
    "medications": f"""
SELECT {_LINE_ID} AS MedicationID, l_orderkey AS EncounterID, o_custkey AS PatientID,
       {_drug('l_partkey')} AS DrugCode,
       CONCAT({_drug('l_partkey')}, CASE l_suppkey % 5 WHEN 0 THEN ' HCL' WHEN 1 THEN ' Sodium' WHEN 2 THEN ' 50 MG TABLET' WHEN 3 THEN ' tartrate 2.5mg' ELSE '' END) AS DrugName,
       CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE LOWER({_drug('l_partkey')}) END AS GenericName,
       CONCAT('Class ', CAST(l_partkey % 7 AS STRING)) AS DrugClass, CAST(CAST(l_quantity AS INT) AS STRING) AS Dosage, 'MG' AS DosageUnit,
       CASE l_partkey % 3 WHEN 0 THEN 'ORAL' WHEN 1 THEN 'IV' ELSE 'TOPICAL' END AS Route,
       CASE l_suppkey % 3 WHEN 0 THEN 'DAILY' WHEN 1 THEN 'BID' ELSE 'PRN' END AS Frequency,
       l_shipdate + (l_partkey % 600) * INTERVAL '1' MINUTE AS StartDate, l_suppkey AS PrescribingPhysicianID,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' WHEN l_returnflag = 'R' THEN 'ON_HOLD' ELSE 'ACTIVE' END AS MedicationStatus,
       CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE 0 END AS IsControlledSubstance,
       CASE WHEN l_partkey % 9 = 0 THEN 'II' END AS DEASchedule, CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS PharmacyVerified
FROM {_LINES}""",
    "allergies": f"""
SELECT c_custkey * 2 AS AllergyID, c_custkey AS PatientID, CASE WHEN c_custkey % 5 = 0 THEN 'FOOD' ELSE 'DRUG' END AS AllergyType,
       LOWER({_drug('c_custkey')}) AS AllergenName, 'Rash & hives' AS Reaction,
       CASE c_custkey % 3 WHEN 0 THEN 'MILD' WHEN 1 THEN 'MODERATE' ELSE 'SEVERE' END AS Severity,
       CASE WHEN c_custkey % 7 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS AllergyStatus FROM {{customer}}
UNION ALL
SELECT c_custkey * 2 + 1 AS AllergyID, c_custkey AS PatientID, 'DRUG' AS AllergyType,
       {_drug('(c_custkey * 5 + 3)')} AS AllergenName, 'Nausea' AS Reaction, 'MODERATE' AS Severity, 'ACTIVE' AS AllergyStatus
FROM {{customer}} WHERE c_acctbal >= 0""",
    "lab_results": """
SELECT event_id AS LabResultID, event_id % (SELECT COUNT(*) FROM {orders}) AS EncounterID, user_id AS PatientID, event_type AS TestCode,
       CONCAT('Test ', event_type) AS TestName, CASE WHEN event_id % 25 = 0 THEN NULL ELSE CONCAT('v', CAST(event_id % 1000 AS STRING)) END AS ResultValue, 'mg/dL' AS ResultUnit,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,6)) END AS ResultNumeric,
       CAST(10 AS DECIMAL(18,6)) AS ReferenceRangeLow, CAST(100 AS DECIMAL(18,6)) AS ReferenceRangeHigh,
       CASE WHEN value > 100 THEN 'H' WHEN value < 10 THEN 'L' END AS AbnormalFlag,
       CASE WHEN value > 100 THEN 1 ELSE 0 END AS CriticalFlag,
       CASE event_id % 10 WHEN 0 THEN 'PRELIMINARY' WHEN 1 THEN 'CORRECTED' ELSE 'FINAL' END AS ResultStatus,
       ts - """ + _JULY + """ AS ReportedDate
FROM {events}""",
    "diagnoses": f"""
SELECT {_LINE_ID} AS DiagnosisID, l_orderkey AS EncounterID, o_custkey AS PatientID,
       CONCAT(SUBSTRING(CASE WHEN l_suppkey % 10 = 0 THEN 'abcdefghijklmnopqrstuvwxyz' ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' END, CAST(l_partkey % 26 AS INT) + 1, 1),
              {_pad('l_partkey % 100', 2)},
              CASE l_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN '.' WHEN 2 THEN '.1' WHEN 3 THEN '.12A' WHEN 4 THEN '.A' ELSE 'X' END,
              CASE WHEN l_suppkey % 15 = 0 THEN '  ' ELSE '' END) AS ICDCode,
       CONCAT('Condition ', CAST(l_partkey AS STRING)) AS ICDDescription,
       CASE l_linenumber WHEN 1 THEN 'PRIMARY' WHEN 2 THEN 'ADMITTING' WHEN 3 THEN 'PRIMARY' ELSE 'SECONDARY' END AS DiagnosisType,
       CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END AS ChronicIndicator
FROM {_LINES}""",
    "procedures": f"""
SELECT {_LINE_ID} AS ProcedureID, l_orderkey AS EncounterID, o_custkey AS PatientID, CAST(l_partkey AS STRING) AS CPTCode,
       CONCAT('Procedure ', CAST(l_partkey AS STRING)) AS CPTDescription, l_shipdate AS ProcedureDate, l_suppkey AS PerformingPhysicianID,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'SCHEDULED' END AS ProcedureStatus, CAST(l_extendedprice AS DECIMAL(10,2)) AS ChargeAmount
FROM {_LINES}""",
    "radiology_studies": f"""
SELECT {_LINE_ID} AS StudyID, {_LINE_ID} AS OrderID, l_orderkey AS EncounterID, CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE o_custkey END AS PatientID,
       CASE l_partkey % 3 WHEN 0 THEN 'XRAY' WHEN 1 THEN 'CT' ELSE 'MRI' END AS Modality, l_shipdate AS StudyDate,
       CASE WHEN l_partkey % 37 = 0 THEN 'LOST' WHEN l_returnflag = 'N' THEN 'SCHEDULED' ELSE 'COMPLETED' END AS StudyStatus
FROM {_LINES} WHERE l_linenumber % 4 = 0""",
    "vitals": f"""
SELECT {_LINE_ID} AS VitalID, l_orderkey AS EncounterID, o_custkey AS PatientID,
       CASE WHEN CAST(l_quantity AS INT) % 13 = 0 THEN CAST(0 AS DECIMAL(5,2)) ELSE CAST(48 + CAST(l_quantity AS INT) AS DECIMAL(5,2)) END AS HeightInches,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(90 + l_partkey % 250 AS DECIMAL(6,2)) END AS WeightPounds, l_shipdate AS RecordedDate
FROM {_LINES}""",
    "clinical_notes": f"""
SELECT d.doc_id AS NoteID, d.doc_id % (SELECT COUNT(*) FROM {{orders}}) AS EncounterID, d.doc_id % {_SUPPLIERS} AS AuthorID, 'PROGRESS' AS NoteType,
       d.text AS NoteContent, CASE WHEN l.quality = 1 THEN 'SIGNED' ELSE 'DRAFT' END AS NoteStatus,
       TIMESTAMP_NTZ '2001-07-20 09:00:00' - (d.doc_id % 20) * INTERVAL '1' DAY AS NoteDate
FROM {{documents}} d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id""",
    "audit_log": f"""
SELECT event_id AS AuditLogID, CASE WHEN event_type = 'error' THEN 'Medications' ELSE 'Patients' END AS TableName, user_id AS RecordID,
       CASE event_type WHEN 'error' THEN 'ALLERGY_WARNING' WHEN 'signup' THEN 'REGISTER' ELSE 'UPDATE' END AS Action,
       ts - {_JULY} - (event_id % 2000) * INTERVAL '1' DAY AS ChangedDate FROM {{events}}""",
    "billing_audit": f"""
SELECT event_id AS AuditID, 'InsuranceClaims' AS TableName, event_id AS RecordID,
       CASE WHEN event_id % 3 = 0 THEN 'APPEAL_EXPIRED' ELSE 'CLAIM_SUBMITTED' END AS Action,
       ts - {_JULY} - (event_id % 1500) * INTERVAL '1' DAY AS ChangedDate FROM {{events}}""",
    "chargemaster": """
SELECT CONCAT('CH-', CAST(p_partkey AS STRING)) AS ChargeCode, CAST(p_partkey AS STRING) AS CPTCode, '0300' AS RevenueCode, p_name AS ChargeDescription,
       CAST(p_retailprice AS DECIMAL(10,2)) AS StandardCharge, CAST(p_retailprice * 0.5 AS DECIMAL(10,2)) AS MedicareRate, CAST(p_retailprice * 0.25 AS DECIMAL(10,2)) AS MedicaidRate,
       DATE '2001-07-20' - p_size * 10 AS EffectiveDate, CASE WHEN p_partkey % 7 = 6 THEN DATE '2001-07-20' WHEN p_partkey % 7 = 5 THEN DATE '2002-01-01' END AS ExpirationDate, 1 AS IsActive
FROM {part}
UNION ALL
SELECT CONCAT('CH-', CAST(p_partkey AS STRING)) AS ChargeCode, CAST(p_partkey AS STRING) AS CPTCode, '0300' AS RevenueCode, p_name AS ChargeDescription,
       CAST(p_retailprice + 5 AS DECIMAL(10,2)) AS StandardCharge, CAST(p_retailprice * 0.5 AS DECIMAL(10,2)) AS MedicareRate, CAST(p_retailprice * 0.25 AS DECIMAL(10,2)) AS MedicaidRate,
       DATE '1999-01-01' + p_size AS EffectiveDate, CAST(NULL AS DATE) AS ExpirationDate, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS IsActive
FROM {part} WHERE p_size <= 16
UNION ALL
SELECT CASE r_regionkey WHEN 0 THEN 'RC-SEMI-PRIV' ELSE 'RC-OBS' END AS ChargeCode, CAST(NULL AS STRING) AS CPTCode, '0120' AS RevenueCode, r_name AS ChargeDescription,
       CAST(2500 - 700 * r_regionkey AS DECIMAL(10,2)) AS StandardCharge, CAST(1200 AS DECIMAL(10,2)) AS MedicareRate, CAST(900 AS DECIMAL(10,2)) AS MedicaidRate,
       DATE '1999-01-01' AS EffectiveDate, CAST(NULL AS DATE) AS ExpirationDate, 1 AS IsActive
FROM {region} WHERE r_regionkey < 2""",
    "billing_charges": f"""
SELECT {_LINE_ID} AS ChargeID, l_orderkey AS EncounterID, o_custkey AS PatientID, CONCAT('CH-', CAST(l_partkey AS STRING)) AS ChargeCode,
       CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS CPTCode,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE {_pad('l_suppkey', 10)} END AS PerformingPhysicianNPI,
       l_shipdate AS ServiceDate, CAST(l_quantity AS INT) AS Quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS ChargeAmount,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS AdjustmentAmount,
       l_shipdate + (l_linenumber * 5) * INTERVAL '1' HOUR AS PostedDate,
       CASE l_returnflag WHEN 'N' THEN 'POSTED' WHEN 'A' THEN 'BILLED' ELSE 'VOIDED' END AS ChargeStatus
FROM {_LINES}""",
    "payments": f"""
SELECT {_LINE_ID} AS PaymentID, o_custkey AS PatientID, l_orderkey AS EncounterID, l_orderkey AS ClaimID,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS PaymentAmount,
       CAST(l_shipdate AS DATE) + 5 AS PaymentDate, l_shipdate + l_linenumber * INTERVAL '1' DAY + (l_partkey % 1440) * INTERVAL '1' MINUTE AS PostedDate,
       CASE l_linenumber WHEN 3 THEN 'APPLIED' WHEN 4 THEN 'APPLIED' WHEN 5 THEN 'REFUNDED' WHEN 6 THEN 'VOIDED' ELSE 'POSTED' END AS PaymentStatus
FROM {_LINES}""",
    "insurance_claims": f"""
SELECT o_orderkey AS ClaimID, CONCAT('CLM-', {_ymd('o_orderdate')}, '-', {_pad('o_orderkey', 5)}) AS ClaimNumber, o_orderkey AS EncounterID, o_custkey AS PatientID,
       CAST(o_custkey % 5 AS INT) AS InsuranceProviderID, CASE WHEN o_custkey % 5 = 4 THEN NULL ELSE CONCAT('PAY', CAST(o_custkey % 5 AS STRING)) END AS PayerID,
       CAST(o_totalprice AS DECIMAL(12,2)) AS TotalCharges,
       CASE WHEN o_orderkey % 8 IN (3, 4, 5) THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS PaidAmount,
       CASE o_orderkey % 8 WHEN 0 THEN 'CREATED' WHEN 1 THEN 'SUBMITTED' WHEN 2 THEN 'SUBMITTED' WHEN 3 THEN 'ADJUDICATED' WHEN 4 THEN 'PAID' WHEN 5 THEN 'PARTIAL_PAID' ELSE 'DENIED' END AS ClaimStatus,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderdate + 3 * INTERVAL '1' DAY END AS SubmittedDate,
       CASE WHEN o_orderkey % 8 = 6 THEN NULL ELSE CAST(o_orderdate AS DATE) + 45 END AS AppealDeadline, o_orderdate AS CreatedDate
FROM {{orders}} WHERE o_orderpriority NOT IN ('3-MEDIUM', '5-LOW')""",
    "invoices": """
SELECT o_orderkey AS InvoiceID, CONCAT('INV-', SUBSTRING(""" + _ymd("o_orderdate") + """, 1, 6), '-', """ + _pad("o_orderkey", 5) + """) AS InvoiceNumber, o_custkey AS PatientID,
       CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_orderkey END AS EncounterID,
       CAST(o_orderdate AS DATE) AS InvoiceDate, CAST(o_orderdate AS DATE) + 30 AS DueDate, CAST(o_totalprice AS DECIMAL(12,2)) AS TotalAmount,
       CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) - CAST(o_orderkey % 100 AS DECIMAL(12,2)) ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.30 AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS PaidAmount,
       CASE o_orderkey % 6 WHEN 0 THEN 'PAID' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'WRITTEN_OFF' ELSE 'OPEN' END AS InvoiceStatus
FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
    "payment_plans": """
SELECT c_custkey AS PaymentPlanID, c_custkey AS PatientID, DATE '2001-07-20' - CAST(c_custkey % 120 AS INT) AS NextPaymentDate,
       CASE c_custkey % 4 WHEN 0 THEN 'COMPLETED' ELSE 'ACTIVE' END AS PlanStatus FROM {customer}""",
    "collections": """
SELECT o_orderkey AS CollectionID, o_custkey AS PatientID, o_orderkey AS InvoiceID, CAST(o_totalprice AS DECIMAL(12,2)) AS OriginalBalance,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS CurrentBalance,
       CASE o_orderkey % 3 WHEN 0 THEN 'RECOVERED' ELSE 'ACTIVE' END AS CollectionStatus FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""",
    "rooms": """
SELECT s_suppkey AS RoomID, CONCAT('RM-', CAST(s_suppkey AS STRING)) AS RoomNumber, CASE s_suppkey % 3 WHEN 0 THEN 'EXAM' WHEN 1 THEN 'ICU' ELSE 'OR' END AS RoomType,
       CONCAT('NATION_', CAST(s_nationkey AS STRING)) AS DepartmentCode, CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1 END AS IsActive FROM {supplier}""",
    "room_assignments": f"""
SELECT o_orderkey AS AssignmentID, o_orderkey AS EncounterID, o_custkey % {_SUPPLIERS} AS RoomID,
       CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'DISCHARGED' ELSE 'CANCELLED' END AS AssignmentStatus FROM {{orders}}""",
    "appointments": f"""
SELECT event_id AS AppointmentID, user_id AS PatientID, event_id % {_SUPPLIERS} AS PhysicianID, CAST(ts - {_JULY} AS DATE) AS AppointmentDate,
       CASE event_type WHEN 'view' THEN 'FOLLOW_UP' WHEN 'click' THEN 'CONSULT' ELSE 'PROCEDURE' END AS AppointmentType,
       CASE event_type WHEN 'error' THEN 'NO_SHOW' WHEN 'signup' THEN 'CANCELLED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'SCHEDULED' END AS AppointmentStatus
FROM {{events}}""",
    # Shifts and waiting patients, with states outside the declared ones and repeated numbers among them.
    "staff_schedules": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN 7 ELSE o_orderkey END AS ScheduleID, o_custkey % 40 AS StaffID, CAST(o_orderdate AS DATE) AS ShiftDate,
       CASE o_orderkey % 13 WHEN 0 THEN 'DAY' WHEN 1 THEN 'EVENING' WHEN 2 THEN 'NIGHT' WHEN 3 THEN 'ON_CALL' WHEN 4 THEN 'SPLIT' WHEN 5 THEN 'day' WHEN 6 THEN NULL ELSE 'DAY' END AS ShiftType,
       CASE o_orderkey % 7 WHEN 0 THEN 'SCHEDULED' WHEN 1 THEN 'CONFIRMED' WHEN 2 THEN 'CANCELLED' WHEN 3 THEN 'CALLED_OFF' WHEN 4 THEN 'SWAPPED' WHEN 5 THEN 'LOST' ELSE 'SCHEDULED' END AS ScheduleStatus
FROM {orders}""",
    "waiting_list": """
SELECT CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 1 ELSE c_custkey END AS WaitListID, c_custkey AS PatientID,
       CASE c_custkey % 7 WHEN 0 THEN 'WAITING' WHEN 1 THEN 'NOTIFIED' WHEN 2 THEN 'SCHEDULED' WHEN 3 THEN 'CANCELLED' WHEN 4 THEN 'EXPIRED' WHEN 5 THEN 'GONE' ELSE 'WAITING' END AS WaitListStatus
FROM {customer}""",
    # Laboratory messages: a header, patient and order segment, results; line ends of both kinds, blank and short lines.
    "lab_messages": f"""
SELECT {_LINE_ID} AS LabResultID, CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CONCAT(
       'MSH|^~&|LAB|HOSP|EHR|HOSP|', {_ymd('l_shipdate')}, '||ORU^R01|', CAST(l_orderkey AS STRING), '|P|2.3', CHR(13), CHR(10),
       'PID|1||', CAST(o_custkey AS STRING), '^^^HOSP||DOE^', CAST(o_custkey % 7 AS STRING), CASE WHEN l_partkey % 3 = 0 THEN '  ' ELSE '' END, CHR(13),
       CASE WHEN l_partkey % 5 = 0 THEN CONCAT('ZZ', CHR(13)) ELSE '' END, CASE WHEN l_partkey % 4 = 0 THEN CONCAT('   ', CHR(10)) ELSE '' END,
       'OBR|1|', CAST(l_orderkey AS STRING), '||T', CAST(l_partkey % 40 AS STRING), '^Test', CHR(10),
       'OBX|1|NM|T', CAST(l_partkey % 40 AS STRING), '||', CAST(CAST(l_quantity AS INT) AS STRING), '|mg/dL|', CASE WHEN l_partkey % 6 = 0 THEN '' ELSE '1-40' END, '|||F',
       CASE WHEN l_partkey % 2 = 0 THEN CONCAT(CHR(13), 'NTE|1||', l_returnflag, '|') ELSE '' END) END AS RawHL7Message
FROM {_LINES} WHERE l_linenumber % 4 = 1""",
    "hl7_messages": "SELECT doc_id AS LabResultID, text AS RawHL7Message FROM {documents}",
    "drug_pairs": f"""
SELECT {_LINE_ID} AS PairID, {_drug('l_partkey')} AS DrugA,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CONCAT(' ', LOWER({_drug('l_suppkey')})) END AS DrugB FROM {{lineitem}}""",
    "registrations": f"""
SELECT c_custkey AS RequestID, c_mktsegment AS FirstName, c_name AS LastName,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('900-', {_pad('c_custkey % 100', 2)}, '-', {_pad('c_custkey', 7)})
            WHEN 2 THEN CONCAT('901-', {_pad('c_custkey', 7)}) WHEN 3 THEN CONCAT('901-', {_pad('c_custkey - 1', 7)})
            ELSE CONCAT('902-', {_pad('c_custkey', 7)}) END AS SSN,
       DATE '1950-01-01' + CAST(c_custkey % 9000 AS INT) AS DateOfBirth FROM {{customer}}""",
    "admission_requests": f"""
SELECT o_orderkey AS RequestID, o_custkey AS PatientID, {_TYPE} AS EncounterType, o_orderkey % {_SUPPLIERS} AS AttendingPhysicianID,
       CAST(o_custkey % 25 AS INT) AS DepartmentID, o_orderpriority AS AdmitDiagnosis FROM {{orders}} WHERE o_orderstatus = 'P'""",
    "discharge_requests": """
SELECT o_orderkey AS EncounterID, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS DischargeDiagnosis,
       CASE WHEN o_orderkey % 10 = 0 THEN 'SNF' ELSE 'HOME' END AS DischargeDisposition FROM {orders}""",
    "medication_requests": f"""
SELECT {_LINE_ID} AS RequestID, l_orderkey AS EncounterID, {_drug('l_partkey')} AS DrugCode,
       CONCAT({_drug('l_partkey')}, CASE l_suppkey % 3 WHEN 0 THEN ' HCL' ELSE '' END) AS DrugName,
       CASE WHEN l_partkey % 4 = 0 THEN LOWER({_drug('l_suppkey')}) END AS GenericName,
       CAST(CAST(l_quantity AS INT) AS STRING) AS Dosage, 'ORAL' AS Route, 'DAILY' AS Frequency, l_suppkey AS PrescribingPhysicianID
FROM {{lineitem}}""",
    "encounters_after": "",
    "messages": "",
}

# Broker messages: three to a conversation. Every 50th is sent again months later, some first arrive decades late,
# some bodies are cut off or hold a bad number, and some visits are discharged by two messages.
_K = "(event_id - CASE WHEN event_id % 50 = 1 THEN 1 ELSE 0 END)"
SHAPES["messages"] = f"""
SELECT CONCAT('c-', CAST((k - k % 3) AS STRING)) AS conversation_handle, CAST(k % 3 AS BIGINT) AS message_sequence,
       CASE k % 5 WHEN 0 THEN 'PatientEncounterMessage' WHEN 1 THEN 'PatientEncounterMessage' WHEN 2 THEN 'PatientDischargeMessage'
            WHEN 3 THEN 'LabResultNotificationMessage'
            ELSE CASE WHEN k % 3 = 0 THEN 'OtherMessage' ELSE 'http://schemas.microsoft.com/SQL/ServiceBroker/EndDialog' END END AS message_type,
       CASE WHEN k % 40 = 10 THEN '<NewEncounter><EncounterID>' WHEN k % 40 = 13 THEN '<LabNotification><PatientID>1</Pat'
            WHEN k % 60 = 5 THEN CONCAT('<NewEncounter><EncounterID>x', CAST(k AS STRING), '</EncounterID></NewEncounter>')
            WHEN k % 5 < 2 THEN CONCAT('<NewEncounter><EncounterID>', CAST(k AS STRING), '</EncounterID><PatientID>', CAST(k % 100 AS STRING), '</PatientID><EncounterType>',
                 CASE k % 2 WHEN 0 THEN 'INPATIENT' ELSE 'EMERGENCY' END, '</EncounterType><AdmitDate>2001-07-20T08:00:00</AdmitDate></NewEncounter>')
            WHEN k % 5 = 2 THEN CONCAT('<PatientDischarge><EncounterID>', CAST(k - CASE WHEN k % 20 = 12 THEN 10 ELSE 0 END AS STRING), '</EncounterID></PatientDischarge>')
            WHEN k % 5 = 3 THEN CONCAT('<LabNotification><PatientID>', CAST(k % 100 AS STRING), '</PatientID><TestName>Na &amp; K</TestName><CriticalFlag>', CAST(k % 2 AS STRING), '</CriticalFlag></LabNotification>')
       END AS body,
       CASE WHEN event_id <> k THEN ts + INTERVAL '100' DAY WHEN k % 97 = 0 THEN ts - INTERVAL '9000' DAY ELSE ts END AS ts
FROM (SELECT {_K} AS k, event_id, ts FROM {{events}}) AS numbered"""

# A changed copy of the visits: some rows gone, some new, some altered.
SHAPES["encounters_after"] = (
    "SELECT CASE WHEN o_orderkey % 101 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS EncounterID, o_custkey AS PatientID, "
    "CASE WHEN o_orderkey % 13 = 0 THEN 'DISCHARGED' ELSE CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'DISCHARGED' ELSE 'CANCELLED' END END AS EncounterStatus, "
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN CONCAT('PA', CAST(o_orderkey AS STRING)) END AS PreAuthNumber "
    "FROM {orders} WHERE o_totalprice >= 5000"
)


# Tables whose columns the profile reads. Message texts and requests are input, not stored tables.
PROFILED = [
    n for n in SHAPES
    if n not in ("messages", "lab_messages", "encounters_after", "drug_pairs", "registrations", "admission_requests", "discharge_requests", "medication_requests")
]


class Tables:
    """Hospital tables by name, built on first use from one folder of Parquet files."""

    _open: dict[tuple[int, str], "Tables"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._base: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}
        self._lines: str | None = None
        self._joined: list[tuple[set[str], "Tables"]] = []

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Tables":
        """The tables of a folder, opened once per session: file schemas are read a single time."""
        key = (id(spark), folder)
        known = cls._open.get(key)
        if known is None or known.spark is not spark:
            known = cls._open[key] = cls(spark, folder)
        return known

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._base[name]

    def joined(self, *names: str) -> "Tables":
        """The same tables, with line items and their visits joined once and written to the shared folder.

        For queries that read several tables made of line items, or one of them several times: every read of one
        would join and shuffle both files again. The rows are those of the join, all of them. With ``names``, only
        these of the tables made of line items can be read, and only their columns are joined.
        """
        texts = [SHAPES[n] for n in names or SHAPES]
        needed = set(re.findall(r"\b[lo]_[a-z]+", " ".join(text.replace(_LINES, "") for text in texts if _LINES in text)))
        for columns, known in self._joined:
            if needed <= columns and exists(self.spark, known._lines):
                return known
        known = Tables(self.spark, self.folder)
        known._base = self._base
        known._lines = run_dir(self.spark, "lines")
        both = self.base("lineitem").join(self.base("orders"), F.expr("l_orderkey = o_orderkey"))
        both.select(*[n for n in both.columns if n in needed]).write.option("compression", "zstd").parquet(known._lines)
        self._joined.append((needed, known))
        return known

    def having(self, name: str, stored: DataFrame) -> "Tables":
        """The same tables, one of them read from where a job has stored its rows."""
        other = Tables(self.spark, self.folder)
        other._base, other._built, other._lines = self._base, {**self._built, name: stored}, self._lines
        return other

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            text = SHAPES[name]
            if self._lines:
                text = text.replace(_LINES, "{joined_lines}")
            used = {t: self.base(t) for t in BASE_TABLES if "{" + t + "}" in text}
            if "{joined_lines}" in text:
                used["joined_lines"] = self.spark.read.parquet(self._lines)
            self._built[name] = self.spark.sql(text, **used)
        return self._built[name]


def duckdb_shape(name: str) -> str:
    """The same projection as DuckDB text over its registered views."""
    text = SHAPES[name].replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return text.format(**{t: t for t in BASE_TABLES})


def with_shapes(sql: str) -> str:
    """Prefix a query over ``h_<table>`` names with the projections it uses."""
    names = [n for n in SHAPES if re.search(rf"\bh_{n}\b", sql)]
    ctes = [f"h_{n} AS ({duckdb_shape(n)})" for n in names]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
