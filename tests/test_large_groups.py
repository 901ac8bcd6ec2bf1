"""Operators on inputs where one key holds a large part of all rows, against brute force."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.compare import values
from wardline.clock import Clock, ts_lit
from wardline.functions.clinical import INTERACTIONS
from wardline.operators import allergies, lookups, management_reports, numbering, rows

DAY0 = datetime(2001, 1, 1)


@pytest.fixture(autouse=True)
def several_ranges(monkeypatch):
    """Few rows per task, so that small tables take several ranges; the path is the same for all sizes."""
    monkeypatch.setattr(rows.number_rows, "__defaults__", (*rows.number_rows.__defaults__[:-1], 100))


def hot_rows(count, seed, share=0.4, keys=40):
    """(key, id, moment) rows; one key holds a large share and many moments tie."""
    pick = random.Random(seed)
    out = []
    for i in range(count):
        key = 1 if pick.random() < share else pick.randrange(2, keys)
        out.append((key, i, DAY0 + timedelta(hours=pick.randrange(60))))
    return out


def expected_numbers(data, by_key):
    groups = defaultdict(list)
    for key, i, at in data:
        groups[key if by_key else 0].append((at, i))
    return {i: n for group in groups.values() for n, (_, i) in enumerate(sorted(group), 1)}


@pytest.mark.parametrize("by_key", [True, False])
@pytest.mark.parametrize("count", [50, 3000])
def test_numbering_is_dense_and_ordered(spark, by_key, count):
    data = hot_rows(count, count)
    df = spark.createDataFrame(data, "k int, i int, at timestamp_ntz")
    by = ["k"] if by_key else []
    numbered = rows.number_rows(df, ["at", "i"], by, "n")
    assert {r["i"]: r["n"] for r in numbered.collect()} == expected_numbers(data, by_key)


def test_numbering_keeps_null_groups_and_null_sort_keys(spark):
    data = [(None, i, None if i % 3 else DAY0) for i in range(400)] + [(2, 1000 + i, DAY0) for i in range(400)]
    df = spark.createDataFrame(data, "k int, i int, at timestamp_ntz")
    got = rows.number_rows(df, ["at", "i"], ["k"], "n").collect()
    assert len(got) == 800
    for key in (None, 2):
        assert sorted(r["n"] for r in got if r["k"] == key) == list(range(1, 401))


def test_running_numbers_with_one_dominant_prefix(spark):
    data = [(i, "A" if i % 10 else "B") for i in range(2000)]
    batch = spark.createDataFrame(data, "id int, kind string")
    filed = spark.createDataFrame([("A-2001-00041", 7), ("A-2000-00900", 9), ("B-2001-00002", 3)], "Number string, Key int")
    out = numbering.assign_numbers(
        batch, filed, "Number", ["A-2001-", "B-2001-"], 5, ["id"], F.concat("kind", F.lit("-2001-"))
    )
    want, last = {}, {"A": 41, "B": 2}
    for i, kind in data:
        last[kind] += 1
        want[i] = f"{kind}-2001-{last[kind]:05d}"
    assert {r["id"]: r["Number"] for r in out.collect()} == want


def test_single_prefix_gives_keys_too(spark):
    batch = spark.createDataFrame([(i,) for i in (5, 3, 9)], "id int")
    filed = spark.createDataFrame([("C-2001-99999", 70)], "Number string, Key int")
    out = numbering.assign_numbers(batch, filed, "Number", ["C-2001-"], 5, ["id"], key="Key")
    assert values(out, "id", "Number", "Key") == [(3, "C-2001-100000", 71), (5, "C-2001-100001", 72), (9, "C-2001-100002", 73)]
    none = spark.createDataFrame([], "Number string, Key int")
    out = numbering.assign_numbers(batch, none, "Number", ["C-2001-"], 5, ["id"], key="Key")
    assert values(out, "id", "Number", "Key") == [(3, "C-2001-00001", 1), (5, "C-2001-00002", 2), (9, "C-2001-00003", 3)]


VISIT = "EncounterID int, PatientID int, EncounterType string, EncounterStatus string, AdmitDate timestamp_ntz, DischargeDate timestamp_ntz"


def brute_readmissions(visits):
    out = {}
    for i, patient, kind, status, _, gone in visits:
        if kind == "INPATIENT" and status == "DISCHARGED" and gone is not None:
            limit = gone + timedelta(days=30)
            out[i] = int(
                any(p == patient and j != i and k == "INPATIENT" and gone <= a <= limit for j, p, k, _, a, _ in visits)
            )
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_readmissions_match_brute_force(spark, seed):
    pick = random.Random(seed)
    visits = []
    for i in range(600):
        admit = DAY0 + timedelta(days=pick.randrange(400), hours=pick.choice([0, 0, 6]))
        # Some stays end the moment they start, and some records end before they start.
        gone = admit + timedelta(days=pick.choice([0, 0, 3, 30, -5]))
        status = pick.choice(["DISCHARGED", "DISCHARGED", "ACTIVE"])
        visits.append(
            (i, 1 if pick.random() < 0.1 else pick.randrange(2, 200), pick.choice(["INPATIENT", "OUTPATIENT"]), status, admit, gone)
        )
    df = spark.createDataFrame(visits, VISIT)
    got = management_reports.readmission_flags(df, ts_lit(datetime(1990, 1, 1)), ts_lit(datetime(2010, 1, 1)))
    assert {r["EncounterID"]: r["Readmitted"] for r in got.collect()} == brute_readmissions(visits)


def test_readmission_edges(spark):
    left = datetime(2001, 5, 1, 12)

    def stay(i, patient, admit, gone=None, kind="INPATIENT"):
        return (i, patient, kind, "DISCHARGED" if gone else "ACTIVE", admit, gone)

    start = left - timedelta(days=2)
    visits = [
        stay(1, 1, start, left), stay(2, 1, left),  # back at the moment of discharge
        stay(3, 2, start, left), stay(4, 2, left + timedelta(days=30)),  # day 30, to the second
        stay(5, 3, start, left), stay(6, 3, left + timedelta(days=30, seconds=1)),  # just too late
        stay(7, 4, start, left), stay(8, 4, left + timedelta(days=3), kind="OUTPATIENT"),
        stay(9, 5, left, left),  # only itself
    ]
    df = spark.createDataFrame(visits, VISIT)
    clock = Clock.at("2001-06-15 00:00:00")
    got = management_reports.readmission_flags(df, clock.days(-90), clock.days(-30))
    assert values(got, "EncounterID", "Readmitted") == [(1, 1), (3, 1), (5, 0), (7, 0), (9, 0)]
    rate = management_reports.readmission_rate(df, clock).first()[0]
    assert float(rate) == 40.0
    empty = management_reports.readmission_rate(df.filter("false"), clock).first()[0]
    assert empty is None


LAB = (
    "LabResultID int, PatientID int, TestCode string, TestName string, ResultValue string, ResultNumeric decimal(18,6), "
    "ReferenceRangeLow decimal(18,6), ReferenceRangeHigh decimal(18,6), AbnormalFlag string, ResultStatus string, ReportedDate timestamp_ntz"
)


def lab(spark, results):
    from decimal import Decimal

    full = [
        (i, p, t, t, str(v), None if v is None else Decimal(str(v)), None, None, None, status, at)
        for i, p, t, v, status, at in results
    ]
    return spark.createDataFrame(full, LAB)


def test_lab_trends_of_a_dominant_patient(spark):
    pick = random.Random(5)
    results = [
        (i, 1 if i % 3 else pick.randrange(2, 30), pick.choice("AB"), pick.randrange(1, 40), pick.choice(["FINAL", "FINAL", "PRELIMINARY"]),
         DAY0 + timedelta(hours=pick.randrange(200)))
        for i in range(1500)
    ]
    groups, counts = defaultdict(list), defaultdict(int)
    for i, p, t, v, status, at in results:
        counts[(p, t)] += 1
        if status == "FINAL":
            groups[(p, t)].append((at, i, v))
    clock = Clock.at("2001-01-10 00:00:00")
    want = []
    for (p, t), found in groups.items():
        latest = max(found)
        earlier = [x for x in found if x[0] < latest[0]]
        previous = max(earlier) if earlier else None
        if latest[0] < clock.now - timedelta(days=2):
            continue
        trend = None
        if previous:
            trend = "UP" if latest[2] * 100 > previous[2] * 105 else "DOWN" if latest[2] * 100 < previous[2] * 95 else "STABLE"
        want.append((p, t, str(latest[2]), previous and str(previous[2]), trend, counts[(p, t)]))
    got = lookups.lab_trends(lab(spark, results), clock, days_back=2)
    columns = ["PatientID", "TestCode", "LatestValue", "PreviousValue", "TrendDirection", "ResultCount"]
    assert values(got, *columns) == sorted(want, key=repr)


def test_lab_trend_edges(spark):
    at = [DAY0 + timedelta(days=n) for n in range(5)]
    results = [
        (1, 1, "A", 100, "FINAL", at[0]), (2, 1, "A", 105, "FINAL", at[1]),  # exactly five percent up
        (3, 2, "A", 100, "FINAL", at[0]), (4, 2, "A", 105.01, "FINAL", at[1]),
        (5, 3, "A", -100, "FINAL", at[0]), (6, 3, "A", -100, "FINAL", at[1]),  # equal but negative: above 1.05 x
        (7, 4, "A", 50, "PRELIMINARY", at[0]), (8, 4, "A", 60, "FINAL", at[1]),  # earlier one is not final
        (9, 5, "A", 70, "FINAL", at[1]), (10, 5, "A", 80, "FINAL", at[1]), (11, 5, "A", 60, "FINAL", at[0]),  # tie at the top
        (12, 6, "A", None, "FINAL", at[1]), (13, 6, "A", 5, "FINAL", at[0]),
    ]
    got = lookups.lab_trends(lab(spark, results), Clock.at("2001-01-05 00:00:00"))
    assert values(got, "PatientID", "LatestValue", "PreviousValue", "TrendDirection", "ResultCount") == [
        (1, "105", "100", "STABLE", 2),
        (2, "105.01", "100", "UP", 2),
        (3, "-100", "-100", "UP", 2),
        (4, "60", None, None, 2),
        (5, "80", "60", "UP", 3),
        (6, "None", "5", None, 2),
    ]


def test_interactions_of_a_patient_with_very_many_rows(spark):
    drugs = [(1, "WARFARIN")] * 300 + [(1, "aspirin ")] * 200 + [(2, "DIGOXIN"), (2, "VERAPAMIL"), (3, "DIGOXIN"), (4, None)]
    meds = spark.createDataFrame([(p, d, "ACTIVE") for p, d in drugs], "PatientID int, DrugCode string, MedicationStatus string")
    got = lookups.drug_interactions(meds)
    assert values(got, "PatientID", "DrugA", "DrugB", "RowsA", "RowsB") == [
        (1, "WARFARIN", "ASPIRIN", 300, 200),
        (2, "DIGOXIN", "VERAPAMIL", 1, 1),
    ]
    counted = lookups.interaction_pair_counts(meds)
    assert values(counted, "PatientID", "Pairs", "Interacting") == [(1, 1, 1), (2, 1, 1), (3, 0, 0)]
    assert len({frozenset(p[:2]) for p in INTERACTIONS}) == 16


def test_allergy_match_collapses_repeats(spark):
    meds = spark.createDataFrame([(1, "Aspirin HCL")] * 50 + [(1, "Codeine"), (2, "Aspirin")], "PatientID int, DrugName string")
    notes = spark.createDataFrame(
        [(i, 1, "DRUG", "ASPIRIN", "ACTIVE", "r", "MILD") for i in range(30)]
        + [(90, 1, "FOOD", "codeine", "ACTIVE", "r", "MILD"), (91, 2, "DRUG", "aspirin", "INACTIVE", "r", "MILD")],
        "AllergyID int, PatientID int, AllergyType string, AllergenName string, AllergyStatus string, Reaction string, Severity string",
    )
    got = allergies.flag_conflicts(meds, notes, "Hit").groupBy("PatientID", "DrugName", "Hit").count()
    assert values(got, "PatientID", "DrugName", "Hit", "count") == [
        (1, "Aspirin HCL", 1, 50),
        (1, "Codeine", 0, 1),
        (2, "Aspirin", 0, 1),
    ]
    hits = allergies.matching_allergens(meds, notes, ["DrugName"])
    assert hits.count() == 1 and hits.first()["_records"] == 30


def test_a_large_group_is_spread_over_ranges(spark, monkeypatch):
    """One group with most rows takes many ranges of about the asked size, and offsets only at their borders."""
    written = []
    real = rows.stage
    monkeypatch.setattr(rows, "stage", lambda df, name: written.append(real(df, name)) or written[-1])
    data = spark.createDataFrame(hot_rows(3000, 9, share=0.9), "k int, i int, at timestamp_ntz")
    numbered = rows.number_rows(data, ["at", "i"], ["k"], "n")
    sizes = [r["count"] for r in written[-1].groupBy("_range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 400
    assert rows._offsets(written[-1], ["k"]).count() <= len(sizes)
    large = sorted(r["n"] for r in numbered.where("k = 1").collect())
    assert large == list(range(1, len(large) + 1))


def test_empty_tables_are_numbered(spark):
    none = spark.createDataFrame([], "k int, i int")
    assert rows.number_rows(none, ["i"], ["k"]).columns == ["k", "i", "RowNumber"]
    assert rows.number_rows(none, ["i"]).count() == 0
