"""Reference SQL for the message consumers, computed from the numbers the bodies were made from."""

from wardline.plans.oracle.jobs import _ACTOR, _ADMIT, _posting
from wardline.plans.oracle.reports import NOW

_BROKER = _ACTOR.replace("'SYSTEM'", "'ServiceBroker'")
_ID = "CAST(substr(conversation_handle, 3) AS BIGINT) + message_sequence"
_M = f"""WITH m AS (SELECT DISTINCT {_ID} AS k, conversation_handle, message_sequence, message_type, body FROM h_messages),
r AS (SELECT *, CASE WHEN k % 5 = 4 THEN CASE WHEN k % 3 = 0 THEN 'ignored' ELSE 'control' END WHEN k % 40 IN (10, 13) OR k % 60 = 5 THEN 'malformed'
   WHEN k % 5 < 2 THEN 'encounter' WHEN k % 5 = 2 THEN 'discharge' ELSE 'lab' END AS route FROM m)
"""
# The visit a discharge message names.
_VISIT = "CASE WHEN k % 20 = 12 THEN k - 10 ELSE k END"
_REPLY = "'<BillingResponse><EncounterID>' || {id} || '</EncounterID><Status>RECEIVED</Status><ProcessedDate>2001-07-20T10:30:00</ProcessedDate></BillingResponse>' AS body"

SQL: dict[str, str] = {
    "stream_encounter_audit": _M
    + f"SELECT 'Encounters' AS TableName, k AS RecordID, 'NEW_ENCOUNTER_RECEIVED' AS Action, 'Encounter notification received via Service Broker. Patient: ' || (k % 100) || ', Type: ' || CASE k % 2 WHEN 0 THEN 'INPATIENT' ELSE 'EMERGENCY' END AS NewValues, {_BROKER} FROM r WHERE route = 'encounter'",
    "stream_encounter_replies": _M
    + f"SELECT conversation_handle, message_sequence, 'BillingResponseMessage' AS message_type, {_REPLY.format(id='k')}, {NOW} AS ts FROM r WHERE route = 'encounter'",
    "stream_dead_letters": _M + "SELECT conversation_handle, message_sequence, message_type, body FROM r WHERE route = 'malformed'",
    "stream_activation_errors": _M
    + f"SELECT 'ServiceBroker' AS TableName, CAST(0 AS BIGINT) AS RecordID, 'ACTIVATION_ERROR' AS Action, 'Message body could not be read: ' || message_type AS NewValues, {_BROKER} FROM r WHERE route = 'malformed'",
    "stream_lab_alerts": _M
    + f"SELECT 'LabResults' AS TableName, k % 100 AS RecordID, 'CRITICAL_LAB_NOTIFICATION' AS Action, 'Critical lab result notification processed: Na & K' AS NewValues, {_BROKER} FROM r WHERE route = 'lab' AND k % 2 = 1",
    "stream_routes": _M + "SELECT route, COUNT(*) AS Messages FROM r GROUP BY 1",
    "stream_discharge_errors": _M
    + f"SELECT 'Encounters' AS TableName, v AS RecordID, 'CHARGE_PROCESSING_ERROR' AS Action, 'Encounter ' || v || ' not found or is not active.' AS NewValues, {_BROKER} FROM (SELECT *, {_VISIT} AS v FROM r) WHERE route = 'discharge' AND v NOT IN (SELECT EncounterID FROM h_encounters WHERE EncounterStatus = 'ACTIVE')",
    "stream_discharge_charges": _posting(
        f"AND EncounterID IN (SELECT {_VISIT} FROM (SELECT {_ID} AS k FROM h_messages WHERE message_type = 'PatientDischargeMessage'))"
    )
    + "SELECT * FROM added",
    "stream_admission_replies": _ADMIT
    + f"SELECT 'enc-' || EncounterID AS conversation_handle, CAST(0 AS BIGINT) AS message_sequence, 'BillingResponseMessage' AS message_type, {_REPLY.format(id='EncounterID')}, {NOW} AS ts FROM opened",
}
