"""Message consumers: replay, repeats, broken bodies, and parallel outputs."""

from datetime import datetime, timedelta

from tests.compare import values
from wardline.clock import Clock
from wardline.plans import catalog
from wardline.sources.shapes import Tables
from wardline.streaming import broker
from wardline.workspace import run_dir

CLOCK = Clock.at("2001-07-20 10:30:00")
T0 = datetime(2001, 7, 20)


def new_visit(i, patient=5, kind="INPATIENT"):
    return f"<NewEncounter><EncounterID>{i}</EncounterID><PatientID>{patient}</PatientID><EncounterType>{kind}</EncounterType></NewEncounter>"


def push(spark, path, rows):
    data = [(*(h if isinstance(h, tuple) else (h, 0)), t, b, T0 + timedelta(minutes=n)) for n, (h, t, b) in enumerate(rows)]
    broker.send(spark.createDataFrame(data, broker.MESSAGE_SCHEMA), path)


def test_drained_twice_takes_effect_once(spark):
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    push(spark, queue, [("h1", broker.ENCOUNTER, new_visit(1)), ("h2", broker.ENCOUNTER, new_visit(2))])
    effects = broker.billing_effects(CLOCK)
    broker.drain(broker.read_queue(spark, queue), effects, out)
    first = values(broker.output(spark, out, "audit"), "RecordID", "NewValues")
    assert [r[0] for r in first] == [1, 2]
    assert first[0][1] == "Encounter notification received via Service Broker. Patient: 5, Type: INPATIENT"
    broker.drain(broker.read_queue(spark, queue), effects, out)
    assert values(broker.output(spark, out, "audit"), "RecordID", "NewValues") == first
    # A repeat of a known handle in a later file is dropped; a new one is taken.
    push(spark, queue, [("h2", broker.ENCOUNTER, new_visit(2)), ("h3", broker.ENCOUNTER, new_visit(3))])
    broker.drain(broker.read_queue(spark, queue), effects, out)
    assert values(broker.output(spark, out, "audit"), "RecordID") == [(1,), (2,), (3,)]
    assert values(broker.output(spark, out, "replies"), "conversation_handle", "message_type") == [
        (h, "BillingResponseMessage") for h in ("h1", "h2", "h3")
    ]


def test_replayed_batch_replaces_its_output(spark):
    out = run_dir(spark, "out")
    rows = [("h1", 0, broker.ENCOUNTER, new_visit(1), T0)]
    routed = broker.route(spark.createDataFrame(rows, broker.MESSAGE_SCHEMA))
    for _ in range(2):
        broker.encounter_audit(routed, CLOCK).write.mode("overwrite").parquet(f"{out}/audit/batch=0")
    assert broker.output(spark, out, "audit").count() == 1


def test_routes(spark):
    rows = [
        ("a", broker.ENCOUNTER, new_visit(1)),
        ("b", broker.ENCOUNTER, "<NewEncounter><EncounterID>"),
        ("c", broker.ENCOUNTER, "<NewEncounter><EncounterID>x</EncounterID></NewEncounter>"),
        ("d", broker.ENCOUNTER, "<PatientDischarge><EncounterID>1</EncounterID></PatientDischarge>"),
        ("e", broker.DISCHARGE, "<PatientDischarge><EncounterID>1</EncounterID></PatientDischarge>"),
        ("f", broker.LAB, "<LabNotification><PatientID>1</PatientID><TestName>K</TestName><CriticalFlag>0</CriticalFlag></LabNotification>"),
        ("g", broker.CONTROL[0], None),
        ("h", "Something", "<x/>"),
        ("i", broker.LAB, None),
        ("j", None, "<x/>"),
        ("k", broker.ENCOUNTER, '<?xml version="1.0"?>\n' + new_visit(4)),
        ("l", broker.LAB, "<LabNotification><PatientID>1</PatientID><CriticalFlag>true</CriticalFlag></LabNotification>"),
        ("m", broker.LAB, "<LabNotification><PatientID>1</PatientID><CriticalFlag>maybe</CriticalFlag></LabNotification>"),
    ]
    df = spark.createDataFrame([(h, 0, t, b, T0) for h, t, b in rows], broker.MESSAGE_SCHEMA)
    want = ["encounter", "malformed", "malformed", "malformed", "discharge", "lab", "control", "ignored", "malformed", "ignored"]
    want += ["encounter", "lab", "malformed"]
    assert values(broker.route(df), "conversation_handle", "route") == list(zip("abcdefghijklm", want))


def test_lab_alerts_only_for_critical(spark):
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")

    def note(flag):
        return f"<LabNotification><PatientID>7</PatientID><TestName>Na</TestName><CriticalFlag>{flag}</CriticalFlag></LabNotification>"

    push(spark, queue, [("a", broker.LAB, note(1)), ("b", broker.LAB, note(0)), ("c", broker.LAB, "<Lab")])
    broker.drain(broker.read_queue(spark, queue), broker.lab_effects(CLOCK), out)
    assert values(broker.output(spark, out, "alerts"), "RecordID", "Action", "NewValues") == [
        (7, "CRITICAL_LAB_NOTIFICATION", "Critical lab result notification processed: Na")
    ]
    assert values(broker.output(spark, out, "dead_letters"), "conversation_handle") == [("c",)]


def test_discharge_of_closed_visit_is_an_error(spark, folder):
    tables = Tables(spark, folder)
    closed = tables["encounters"].filter("EncounterStatus = 'DISCHARGED'").first()["EncounterID"]
    body = "<PatientDischarge><EncounterID>{}</EncounterID></PatientDischarge>"
    rows = [("a", 0, broker.DISCHARGE, body.format(closed), T0), ("b", 0, broker.DISCHARGE, body.format(-5), T0)]
    routed = broker.route(spark.createDataFrame(rows, broker.MESSAGE_SCHEMA))
    made = broker.discharge_postings(routed, catalog.billing_tables(tables), CLOCK)
    assert made["charges"].count() == 0
    assert values(made["posting_errors"], "RecordID") == sorted([(closed,), (-5,)], key=repr)


def test_handle_sent_very_many_times_in_many_files(spark):
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    for _ in range(6):
        push(spark, queue, [("hot", broker.ENCOUNTER, new_visit(1))] * 40 + [(f"h{i}", broker.ENCOUNTER, new_visit(i)) for i in range(2, 5)])
    broker.drain(broker.read_queue(spark, queue), broker.billing_effects(CLOCK), out)
    assert values(broker.output(spark, out, "audit"), "RecordID") == [(1,), (2,), (3,), (4,)]


def test_a_conversation_has_many_messages_of_any_age(spark):
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    effects = lambda routed, earlier: {"routes": routed.select("conversation_handle", "message_sequence", "route")}
    push(spark, queue, [(("h", 0), broker.ENCOUNTER, new_visit(1)), (("h", 1), broker.LAB, "<Lab")])
    broker.drain(broker.read_queue(spark, queue, 1), effects, out)
    old = [("h", 2, broker.CONTROL[0], None, datetime(1970, 1, 1)), ("h", 0, broker.ENCOUNTER, new_visit(1), datetime(2031, 1, 1))]
    old += [("n", None, "Other", "<x/>", None), ("n", None, "Other", "<x/>", None), (None, 0, broker.CONTROL[1], "", T0)]
    broker.send(spark.createDataFrame(old, broker.MESSAGE_SCHEMA), queue)
    for _ in range(2):
        broker.drain(broker.read_queue(spark, queue, 1), effects, out)
        assert values(broker.output(spark, out, "routes"), "conversation_handle", "message_sequence", "route") == sorted(
            # Messages without a full name are kept apart, the same text twice included.
            [("h", 0, "encounter"), ("h", 1, "malformed"), ("h", 2, "control"), ("n", None, "ignored"), ("n", None, "ignored"), (None, 0, "control")],
            key=repr,
        )


def test_every_message_ends_in_one_route(spark, folder):
    """All messages of the test table, drained a file at a time: each name once, none lost."""
    tables, out = Tables(spark, folder), run_dir(spark, "out")
    effects = lambda routed, earlier: {"routes": routed.select("conversation_handle", "message_sequence", "route")}
    broker.drain(catalog.queue(tables), effects, out)
    names = ["conversation_handle", "message_sequence"]
    routes = broker.output(spark, out, "routes")
    sent = tables["messages"].select(*names).distinct()
    assert routes.count() == sent.count() < tables["messages"].count()
    assert sent.exceptAll(routes.select(*names)).count() == 0
    assert broker.handled(spark, out).exceptAll(sent).count() == 0


def test_a_visit_discharged_again_later_is_posted_once(spark, folder):
    tables = Tables(spark, folder)
    billing_tables = catalog.billing_tables(tables)
    due = catalog._posting(tables)["charges"].groupBy("EncounterID").count().orderBy("EncounterID").first()
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    body = f"<PatientDischarge><EncounterID>{due['EncounterID']}</EncounterID></PatientDischarge>"
    for sequence in (0, 1, 2):
        push(spark, queue, [(("d", sequence), broker.DISCHARGE, body)])
        broker.drain(broker.read_queue(spark, queue), broker.billing_effects(CLOCK, billing_tables), out)
    assert broker.output(spark, out, "charges").count() == due["count"] > 0


def test_a_batch_costs_the_same_after_many_batches(spark):
    """Fifty batches of equal size, a part of each old: every batch adds its new names to the state and reads no output."""
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    for n in range(50):
        rows = [(f"h{n}-{k}", 0, "Other", "<x/>", T0) for k in range(30)] + [(f"h{n // 2}-{k}", 0, "Other", "<x/>", T0) for k in range(10)]
        spark.createDataFrame(rows, broker.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(queue)
    asked = []

    def effects(routed, earlier):
        asked.append(routed.count())
        return {"names": routed.select("conversation_handle")}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        progress = broker.drain(broker.read_queue(spark, queue, 1), effects, out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    state = [p["stateOperators"][0] for p in progress if p["numInputRows"]]
    assert len(state) == 50 and sum(asked) == 1500 == broker.handled(spark, out).count()
    assert all(s["numRowsUpdated"] <= 40 for s in state) and state[-1]["numRowsTotal"] == 1500
    # A batch sees its own 30 messages, and the ten of an earlier batch only where the file order brings them first.
    assert max(asked) <= 40
    took = [p["durationMs"]["triggerExecution"] for p in progress if p["numInputRows"]]
    assert sum(took[40:]) <= 2.5 * sum(took[10:20])


def test_a_batch_that_was_not_committed_is_done_again(spark):
    """The driver ends after a batch wrote its outputs, before it committed: the replay replaces them."""
    queue, out = run_dir(spark, "queue"), run_dir(spark, "out")
    effects = broker.billing_effects(CLOCK)
    push(spark, queue, [("h1", broker.ENCOUNTER, new_visit(1))])
    broker.drain(broker.read_queue(spark, queue), effects, out)
    push(spark, queue, [("h1", broker.ENCOUNTER, new_visit(1)), ("h2", broker.ENCOUNTER, new_visit(2))])
    broker.drain(broker.read_queue(spark, queue), effects, out)
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    for name in ("1", ".1.crc"):
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_checkpoint/commits/{name}"), False)
    broker.drain(broker.read_queue(spark, queue), effects, out)
    assert values(broker.output(spark, out, "audit"), "RecordID") == [(1,), (2,)]


def test_earlier_postings_are_read_for_repeated_visits_only(spark, folder):
    tables = Tables(spark, folder)
    effects = broker.billing_effects(CLOCK, catalog.billing_tables(tables))
    due = [r[0] for r in catalog._posting(tables)["charges"].select("EncounterID").distinct().orderBy("EncounterID").limit(2).collect()]
    asked = []
    earlier = lambda name: asked.append(name)
    marked = lambda *rows: spark.createDataFrame(list(rows), "EncounterID int, again boolean")
    first = effects.post(marked((due[0], False), (due[1], False)), earlier)["charges"]
    assert first.count() > 0 and asked == []
    effects.post(marked((due[0], True)), earlier)
    assert asked == ["charges"]
    again = effects.post(marked((due[0], True), (due[1], False)), lambda name: first.where(f"EncounterID = {due[0]}"))["charges"]
    assert {r["EncounterID"] for r in again.collect()} == {due[1]}
