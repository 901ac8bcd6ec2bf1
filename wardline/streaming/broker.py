"""Message consumers as Structured Streaming queries.

A message is (conversation_handle, message_sequence, message_type, body, ts) with an XML body;
a conversation has many messages, and handle and sequence number together name one. A run
drains what is there, some files at a time, and stops. Each micro-batch writes to a folder named after its
batch id in overwrite mode, so a batch replayed after a failure replaces its own output.

What has been handled is keyed state of the stream, in RocksDB: one entry per message name, looked up by key, so
a batch costs what its own messages cost however many came before. A message that comes again takes effect once,
however late, and no message is too old to be handled. Messages without a handle or a sequence number have no
name; each of them is a message of its own. Visits whose charges a discharge has posted are keyed state of a
second query; only for visits discharged again are earlier postings looked up.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardline.clock import Clock
from wardline.functions.dialect import iso_seconds, xml_row
from wardline.operators import billing
from wardline.operators.clinical_reports import c
from wardline.plans.nightly import BillingTables
from wardline.sources.sinks import audit_rows
from wardline.workspace import exists, run_dir

IDENTITY = ["conversation_handle", "message_sequence"]
MESSAGE_SCHEMA = "conversation_handle string, message_sequence bigint, message_type string, body string, ts timestamp_ntz"

# Message types and the root element each one's body must have (fixed values).
ENCOUNTER, DISCHARGE, LAB = "PatientEncounterMessage", "PatientDischargeMessage", "LabResultNotificationMessage"
RESPONSE = "BillingResponseMessage"
CONTROL = (
    "http://schemas.microsoft.com/SQL/ServiceBroker/EndDialog",
    "http://schemas.microsoft.com/SQL/ServiceBroker/Error",
)
ROOTS = {ENCOUNTER: "NewEncounter", DISCHARGE: "PatientDischarge", LAB: "LabNotification"}
BODY_SCHEMA = (
    "EncounterID int, PatientID int, EncounterType string, TestName string, CriticalFlag string, _corrupt_record string"
)
# Texts a 0/1 flag may have (fixed values).
FLAG_ON, FLAG_OFF = ("1", "true"), ("0", "false")
# The name of the root element, after an optional XML declaration.
ROOT_NAME = r"^\s*(?:<\?[^>]*\?>\s*)?<([A-Za-z]+)"
ACTOR = "ServiceBroker"
FILES_PER_BATCH = 1000
# Keyed state lies in RocksDB; a batch adds its changes to the checkpoint instead of a copy of the state.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Visits that discharge messages name, as the first query hands them to the second.
DISCHARGES = "discharges"
DISCHARGE_SCHEMA = "conversation_handle string, message_sequence bigint, EncounterID int"


def read_queue(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Messages appended as Parquet files under a folder; a backlog is taken some files at a time."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def once(messages: DataFrame) -> DataFrame:
    """Each named message of a stream the first time it comes; messages without a full name always."""
    unnamed = c(IDENTITY[0]).isNull() | c(IDENTITY[1]).isNull()
    keyed = messages.withColumn("_unnamed", F.when(unnamed, F.uuid()))
    return keyed.dropDuplicates([*IDENTITY, "_unnamed"]).drop("_unnamed")


def route(messages: DataFrame) -> DataFrame:
    """Parse bodies and add the route each message takes.

    Bodies that are not well formed, or hold a value of the wrong type, come back as
    ``malformed`` with their text; types nobody handles are ``ignored``.
    """
    parsed = messages.withColumn(
        "m",
        F.from_xml("body", BODY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}),
    )
    kind = c("message_type")
    root = F.regexp_extract("body", ROOT_NAME, 1)
    expected = F.lit(None).cast("string")
    for name, element in ROOTS.items():
        expected = F.when(kind == name, element).otherwise(expected)
    bad_flag = ~F.lower("m.CriticalFlag").isin(*FLAG_ON, *FLAG_OFF)
    broken = c("body").isNull() | c("m._corrupt_record").isNotNull() | (root != expected) | F.coalesce(bad_flag, F.lit(False))
    return parsed.withColumn(
        "route",
        F.when(kind.isin(*CONTROL), "control")
        .when(~kind.isin(*ROOTS) | kind.isNull(), "ignored")
        .when(broken, "malformed")
        .when(kind == ENCOUNTER, "encounter")
        .when(kind == DISCHARGE, "discharge")
        .otherwise("lab"),
    )


def encounter_audit(routed: DataFrame, clock: Clock) -> DataFrame:
    text = F.concat(
        F.lit("Encounter notification received via Service Broker. Patient: "),
        c("m.PatientID").cast("string"),
        F.lit(", Type: "),
        c("m.EncounterType"),
    )
    new = routed.filter(c("route") == "encounter")
    return audit_rows(new, "Encounters", c("m.EncounterID"), "NEW_ENCOUNTER_RECEIVED", text, ACTOR, clock)


def encounter_replies(routed: DataFrame, clock: Clock) -> DataFrame:
    body = xml_row(
        "BillingResponse",
        {"EncounterID": c("m.EncounterID"), "Status": F.lit("RECEIVED"), "ProcessedDate": iso_seconds(clock.ts)},
    )
    return routed.filter(c("route") == "encounter").select(
        *IDENTITY, F.lit(RESPONSE).alias("message_type"), body.alias("body"), clock.ts.alias("ts")
    )


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(c("route") == "malformed").select(*IDENTITY, "message_type", "body")


def activation_errors(routed: DataFrame, clock: Clock) -> DataFrame:
    text = F.concat(F.lit("Message body could not be read: "), c("message_type"))
    broken = routed.filter(c("route") == "malformed")
    return audit_rows(broken, ACTOR, F.lit(0), "ACTIVATION_ERROR", text, ACTOR, clock)


def lab_alerts(routed: DataFrame, clock: Clock) -> DataFrame:
    """Audit rows for critical results only."""
    text = F.concat(F.lit("Critical lab result notification processed: "), c("m.TestName"))
    critical = routed.filter((c("route") == "lab") & F.lower("m.CriticalFlag").isin(*FLAG_ON))
    return audit_rows(critical, "LabResults", c("m.PatientID"), "CRITICAL_LAB_NOTIFICATION", text, ACTOR, clock)


def discharges(routed: DataFrame) -> DataFrame:
    return routed.filter(c("route") == "discharge").select(*IDENTITY, c("m.EncounterID").alias("EncounterID"))


def post_visits(visits: DataFrame, tables: BillingTables, clock: Clock, posted: DataFrame | None = None) -> DataFrame:
    """Charges of visits, given by number and repeated at will; ``posted`` are not posted again, like those on file."""
    charges = tables.charges if posted is None else tables.charges.unionByName(posted, allowMissingColumns=True)
    known = tables.encounters.join(visits.select("EncounterID"), "EncounterID", "left_semi")
    ids = known.select("EncounterID")
    return billing.post_encounter_charges(
        tables.procedures.join(ids, "EncounterID", "left_semi"),
        known,
        tables.chargemaster,
        charges.join(ids, "EncounterID", "left_semi"),
        tables.departments,
        tables.physicians,
        tables.diagnoses,
        clock,
    )["charges"]


def posting_errors(named: DataFrame, tables: BillingTables, clock: Clock) -> DataFrame:
    """Visits that are unknown or not active give one error row per message."""
    active = tables.encounters.filter(c("EncounterStatus") == "ACTIVE").select("EncounterID")
    failed = named.join(active, "EncounterID", "left_anti")
    text = F.concat(F.lit("Encounter "), c("EncounterID").cast("string"), F.lit(" not found or is not active."))
    return audit_rows(failed, "Encounters", c("EncounterID"), "CHARGE_PROCESSING_ERROR", text, ACTOR, clock)


def discharge_postings(
    routed: DataFrame, tables: BillingTables, clock: Clock, posted: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Charges and errors for all discharge messages of a batch at once."""
    named = discharges(routed)
    return {"charges": post_visits(named, tables, clock, posted), "posting_errors": posting_errors(named, tables, clock)}


# Reads an output as earlier batches have left it; nothing before the first.
Earlier = Callable[[str], DataFrame | None]
Effects = Callable[[DataFrame, Earlier], dict[str, DataFrame]]


@dataclass(frozen=True)
class BillingEffects:
    """What billing events leave behind: outputs of each batch, and the charges of discharged visits."""

    clock: Clock
    tables: BillingTables | None = None

    def __call__(self, routed: DataFrame, earlier: Earlier) -> dict[str, DataFrame]:
        out = {
            "audit": encounter_audit(routed, self.clock),
            "replies": encounter_replies(routed, self.clock),
            "dead_letters": dead_letters(routed),
            "errors": activation_errors(routed, self.clock),
        }
        if self.tables is not None:
            named = discharges(routed)
            out |= {DISCHARGES: named, "posting_errors": posting_errors(named, self.tables, self.clock)}
        return out

    def post(self, visits: DataFrame, earlier: Earlier) -> dict[str, DataFrame]:
        """Charges of a batch of visits, as ``mark_visits`` gives them."""
        again = visits.filter("again")
        # Visits discharged for the first time have nothing posted before.
        posted = None if again.isEmpty() else earlier("charges")
        if posted is not None:
            posted = posted.join(again.select("EncounterID"), "EncounterID", "left_semi")
        return {"charges": post_visits(visits, self.tables, self.clock, posted)}


def billing_effects(clock: Clock, tables: BillingTables | None = None) -> BillingEffects:
    return BillingEffects(clock, tables)


#: Neighbouring visits that share one entry of the state, a bit each.
VISITS_PER_ENTRY = 1024


def _mark(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    visits = np.unique(np.concatenate([f["EncounterID"].to_numpy("int64") for f in frames]))
    seen = np.unpackbits(np.frombuffer(bytes(state.get[0]), "uint8")) if state.exists else np.zeros(VISITS_PER_ENTRY, "uint8")
    at = visits - key[0] * VISITS_PER_ENTRY
    again = seen[at] == 1
    seen[at] = 1
    state.update((np.packbits(seen).tobytes(),))
    yield pd.DataFrame({"EncounterID": visits.astype("int32"), "again": again})


def mark_visits(named: DataFrame) -> DataFrame:
    """Visits of a stream of discharges, once per batch, with whether an earlier batch had them.

    Neighbouring visits are one group, so Python is called for each of their pieces and not for each visit.
    """
    return (
        named.filter(c("EncounterID").isNotNull())
        .withColumn("_piece", F.floor(c("EncounterID") / VISITS_PER_ENTRY))
        .groupBy("_piece")
        .applyInPandasWithState(_mark, "EncounterID int, again boolean", "seen binary", "append", GroupStateTimeout.NoTimeout)
    )


def lab_effects(clock: Clock) -> Effects:
    return lambda routed, earlier: {
        "alerts": lab_alerts(routed, clock),
        "dead_letters": dead_letters(routed.filter(c("message_type") == LAB)),
    }


def drain(messages: DataFrame, effects: Effects, folder: str, wanted: tuple[str, ...] | None = None) -> list[dict]:
    """Process everything waiting in the stream and stop; gives the progress of the last batches.

    The folder holds the checkpoints and one sub-folder per output and batch.
    Running again with the same folder continues where the last run ended.
    """
    spark = messages.sparkSession
    posts = isinstance(effects, BillingEffects) and effects.tables is not None and (wanted is None or "charges" in wanted)
    if wanted is not None and posts:
        wanted = (*wanted, DISCHARGES)
    progress = _run(once(messages), effects, folder, "_checkpoint", wanted, route)
    if posts and exists(spark, f"{folder}/{DISCHARGES}"):
        named = spark.readStream.schema(DISCHARGE_SCHEMA).parquet(f"{folder}/{DISCHARGES}/batch=*")
        _run(mark_visits(named), effects.post, folder, "_visits", wanted)
    return progress


def _run(
    rows: DataFrame,
    effects: Effects,
    folder: str,
    checkpoint: str,
    wanted: tuple[str, ...] | None,
    prepared: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> list[dict]:
    """One query over what is waiting: the outputs of every batch, each in a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def earlier(name: str) -> DataFrame | None:
            # Without this batch's own folder, so that a replay sees what the first try saw.
            if not exists(spark, f"{folder}/{name}"):
                return None
            found = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
            return found.filter(c("batch") != batch_id).drop("batch")

        # Only the chosen outputs are computed; the batch is read once for all of them.
        ready = prepared(batch).persist()
        try:
            for name, df in effects(ready, earlier).items():
                if wanted is None or name in wanted:
                    df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
        finally:
            ready.unpersist()

    for name, value in STATE_SETTINGS.items():
        rows.sparkSession.conf.set(name, value)
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/{checkpoint}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def output(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An output of all batches so far."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}").drop("batch")


def run_once(spark: SparkSession, messages: DataFrame, effects: Effects, name: str) -> DataFrame:
    """Drain a stream into a new folder and read one output back."""
    folder = run_dir(spark, "stream")
    drain(messages, effects, folder, (name,))
    return output(spark, folder, name)


def critical_alert_stream(messages: DataFrame, clock: Clock) -> DataFrame:
    """The lab consumer as a stateless streaming DataFrame, for any sink."""
    return lab_alerts(route(messages), clock)


def count_routes(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count("*").alias("Messages"))


def handled(spark: SparkSession, folder: str) -> DataFrame:
    """Names of all messages handled so far, from the state of the stream."""
    state = spark.read.format("statestore").load(f"{folder}/_checkpoint")
    return state.select(*[c(f"key.{n}").alias(n) for n in IDENTITY])


def send(messages: DataFrame, path: str) -> None:
    """Append messages to a queue folder."""
    messages.select(*[n.split()[0] for n in MESSAGE_SCHEMA.split(", ")]).write.mode("append").parquet(path)
