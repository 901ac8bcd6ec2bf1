"""Vectors for the column functions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardline.clock import Clock, shift_months
from wardline.functions import clinical, dialect


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def d(y, m, day):
    return F.lit(date(y, m, day))


@pytest.mark.parametrize(
    "born, on, age",
    [
        (date(2000, 2, 29), date(2001, 2, 28), 1),
        (date(2000, 2, 29), date(2001, 2, 27), 0),
        (date(2000, 2, 29), date(2004, 2, 28), 3),
        (date(1960, 7, 20), date(2001, 7, 19), 40),
        (date(1960, 7, 20), date(2001, 7, 20), 41),
    ],
)
def test_age_exact(spark, born, on, age):
    assert one(spark, clinical.age_exact(F.lit(born), F.lit(on))) == age


def test_age_of_unknown_birth_date(spark):
    assert one(spark, clinical.age_exact(F.lit(None).cast("date"), d(2001, 1, 1))) is None


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2001-01-01 00:00:59", "2001-01-01 00:01:00", 1),
        ("2001-01-01 00:00:00", "2001-01-01 00:00:59", 0),
        ("2001-01-01 00:01:00", "2001-01-01 00:00:59", -1),
    ],
)
def test_minute_boundaries(spark, start, end, minutes):
    assert one(spark, dialect.minute_diff(ts(start), ts(end))) == minutes


def test_year_and_day_diff_count_boundaries(spark):
    assert one(spark, dialect.year_diff(d(2000, 12, 31), d(2001, 1, 1))) == 1
    assert one(spark, dialect.day_diff(ts("2001-01-01 23:59:00"), ts("2001-01-02 00:01:00"))) == 1


@pytest.mark.parametrize(
    "height, weight, expected, band",
    [
        (70, 180, "25.82", "Overweight"),
        (0, 180, None, None),
        (None, 180, None, None),
        (70, -1, None, None),
        (70, None, None, None),
    ],
)
def test_bmi(spark, height, weight, expected, band):
    value = clinical.bmi(F.lit(height).cast("decimal(5,2)"), F.lit(weight).cast("decimal(6,2)"))
    assert one(spark, value) == (Decimal(expected) if expected else None)
    assert one(spark, clinical.bmi_category(value)) == band


@pytest.mark.parametrize(
    "index, band",
    [
        (15.99, "Severe Thinness"), (16.0, "Moderate Thinness"), (17.0, "Mild Thinness"), (18.5, "Normal"),
        (25.0, "Overweight"), (30.0, "Obese Class I"), (35.0, "Obese Class II"), (40.0, "Obese Class III"),
        (0.0, None), (-1.0, None),
    ],
)
def test_bmi_bands(spark, index, band):
    assert one(spark, clinical.bmi_category(F.lit(index))) == band


@pytest.mark.parametrize(
    "creatinine, age, female, black, expected",
    [(1.2, 76, True, None, 43.86), (0.0, 50, True, None, None), (1.0, 50, None, None, None), (None, 50, True, None, None)],
)
def test_egfr(spark, creatinine, age, female, black, expected):
    column = clinical.egfr(
        F.lit(creatinine).cast("double"), F.lit(age), F.lit(female).cast("boolean"), F.lit(black).cast("boolean")
    )
    assert one(spark, column) == expected


def test_egfr_race_factor(spark):
    plain = one(spark, clinical.egfr(F.lit(1.1), F.lit(40), F.lit(False)))
    black = one(spark, clinical.egfr(F.lit(1.1), F.lit(40), F.lit(False), F.lit(True)))
    assert black == pytest.approx(plain * 1.159, abs=0.02)


@pytest.mark.parametrize(
    "style, middle, suffix, expected",
    [
        ("LAST_FIRST", "Quinn", "Jr", "Roe, Ann Q."), ("LAST_FIRST", None, None, "Roe, Ann"), ("LAST_FIRST", "", None, "Roe, Ann ."),
        ("FIRST_LAST", "Quinn", "Jr", "Ann Quinn Roe Jr"), ("FIRST_LAST", None, None, "Ann Roe"),
        ("FULL", "Quinn", "Jr", "Ann Quinn Roe, Jr"), ("FULL", "", None, "Ann  Roe"),
        ("FORMAL", "Quinn", "Jr", "Roe, Ann Quinn, Jr"), ("FORMAL", None, None, "Roe, Ann"), ("ODD", "Quinn", "Jr", "Roe, Ann"),
    ],
)
def test_names(spark, style, middle, suffix, expected):
    column = clinical.format_name(
        F.lit("Ann"), F.lit(middle).cast("string"), F.lit("Roe"), F.lit(suffix).cast("string"), style
    )
    assert one(spark, column) == expected


@pytest.mark.parametrize(
    "code, loose, strict",
    [
        ("A00", True, True), ("A00.", True, False), ("a00.1", True, True), ("C97", True, False), ("C96", True, True),
        ("F00", True, False), ("F01", True, True), ("U07.1", True, False), ("S72.001A", True, True),
        ("M80.0AXA", True, False), ("AB1", False, False), (None, False, False), ("", False, False), ("A00  ", True, True),
        (" A00", False, True), ("T88.9", True, True), ("T89", True, False), ("A0", False, False), ("A00-1", False, False),
        ("S72.00011", True, False), ("Z99", True, True),
    ],
)
def test_icd(spark, code, loose, strict):
    column = F.lit(code).cast("string")
    assert one(spark, clinical.icd10_shape_ok(column)) is loose
    assert one(spark, clinical.icd10_strict_ok(column)) is strict


@pytest.mark.parametrize(
    "name, normal",
    [
        ("metoprolol tartrate", "METOPROLOL"),
        ("METOPROLOL TARTRATE 50MG TABLET", "METOPROLOL TARTRATE"),
        ("Penicillin V Potassium", "PENICILLIN V"),
        ("  lisinopril 10 mg  ", "LISINOPRIL"),
        ("drug 2.5MG", "DRUG 2."),
        ("fentanyl 500 MCG patch", "FENTANYL"),
        (" aspirin ", "ASPIRIN"),
        ("\u00a0iron\u00a0sulfate\u00a05 MG", "IRON SULFATE"),
        (None, None),
    ],
)
def test_drug_names(spark, name, normal):
    assert one(spark, clinical.normalize_drug(F.lit(name).cast("string"))) == normal


@pytest.mark.parametrize(
    "a, b, starts",
    [
        ("ASPIRIN", "WARFARIN", "MAJOR: Increased bleeding risk. Monitor"),
        (" warfarin ", "aspirin", "MAJOR: Increased bleeding risk. Monitor"),
        ("ASPIRIN", "DIGOXIN", "NO_INTERACTION"),
        ("X", "Y", "NO_INTERACTION"),
    ],
)
def test_interaction_pairs(spark, a, b, starts):
    assert one(spark, clinical.check_interaction(F.lit(a), F.lit(b))).startswith(starts)


def test_interaction_of_null(spark):
    assert one(spark, clinical.check_interaction(F.lit("X"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("number, text", [(7, "00007"), (99999, "99999"), (123456, "123456")])
def test_zero_pad(spark, number, text):
    assert one(spark, dialect.zero_pad(F.lit(number), 5)) == text


def test_null_propagating_concat_and_contains(spark):
    assert one(spark, dialect.last_first(F.lit("Roe"), F.lit(None).cast("string"))) is None
    assert one(spark, dialect.with_credentials(F.lit("Roe"), F.lit("Ann"), F.lit(None).cast("string"))) == "Roe, Ann "
    assert one(spark, dialect.ci_contains(F.lit("Aspirin HCL"), F.lit("ASPIRIN"))) is True
    assert one(spark, dialect.ci_contains(F.lit("A5B"), F.lit("A_B"))) is False


def test_xml_helpers(spark):
    row = dialect.xml_row("R", {"A": F.lit("x & y"), "B": F.lit(None).cast("string"), "C": F.lit(3)})
    assert one(spark, row) == "<R><A>x &amp; y</A><C>3</C></R>"
    attributes = dialect.xml_attributes("R", {"A": F.lit('q"'), "B": F.lit(None).cast("string")})
    assert one(spark, attributes) == '<R A="q&quot;"/>'


def test_clock_bounds(spark):
    clock = Clock.at("2001-03-31 10:30:00")
    assert one(spark, clock.month_start) == datetime(2001, 3, 1)
    assert one(spark, clock.year_start) == datetime(2001, 1, 1)
    assert one(spark, clock.months(-1)) == datetime(2001, 2, 28, 10, 30)
    assert shift_months(datetime(2000, 2, 29), -12) == datetime(1999, 2, 28)
    assert one(spark, clock.is_today(ts("2001-03-31 23:59:59"))) is True
    assert one(spark, clock.is_today(ts("2001-04-01 00:00:00"))) is False
    assert one(spark, clock.older_than_days(ts("2001-03-24 23:59:59"), 7)) is False
    assert one(spark, clock.older_than_days(ts("2001-03-23 23:59:59"), 7)) is True


def test_wall_clock_differences_ignore_the_session_zone(spark):
    """Across a change to summer time the wall clock still counts 24 hours a day."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start, end = ts("2001-03-31 12:00:30"), ts("2001-04-01 12:00:00")
        assert one(spark, dialect.minute_diff(start, end)) == 1440
        assert one(spark, dialect.second_index(end) - dialect.second_index(start)) == 86_370
        assert one(spark, dialect.second_index(ts("1969-12-31 23:59:59.5"))) == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weekend(spark):
    days = [("2001-07-20", False), ("2001-07-21", True), ("2001-07-22", True), ("2001-07-23", False), (None, None)]
    df = spark.createDataFrame([(d,) for d, _ in days], "d string").select("d", dialect.is_weekend(F.to_date("d")).alias("w"))
    assert [(r["d"], r["w"]) for r in df.collect()] == days
