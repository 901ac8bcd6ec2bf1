"""Clinical scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions.dialect import trim_unicode, year_diff


def age_exact(born: Column, on: Column) -> Column:
    """Completed years; a 29 February birthday falls on 28 February in common years."""
    years = year_diff(born, on)
    return years - F.when(F.add_months(born, 12 * years) > on.cast("date"), 1).otherwise(0)


def bmi(height_inches: Column, weight_pounds: Column) -> Column:
    """Body mass index to two places; null where a measure is missing or not positive."""
    height = height_inches.cast("decimal(5,2)")
    weight = weight_pounds.cast("decimal(6,2)")
    index = (weight * F.lit(703.0).cast("decimal(4,1)")) / (height * height)
    return F.when((height > 0) & (weight > 0), index.cast("decimal(5,2)"))


# Upper bounds of the body-mass bands (fixed values).
BMI_BANDS = (
    (16.0, "Severe Thinness"),
    (17.0, "Moderate Thinness"),
    (18.5, "Mild Thinness"),
    (25.0, "Normal"),
    (30.0, "Overweight"),
    (35.0, "Obese Class I"),
    (40.0, "Obese Class II"),
)
BMI_TOP_BAND = "Obese Class III"


def bmi_category(index: Column) -> Column:
    value = index.cast("double")
    band = F.lit(BMI_TOP_BAND)
    for upper, name in reversed(BMI_BANDS):
        band = F.when(value < upper, name).otherwise(band)
    return F.when(value > 0, band)


# CKD-EPI 2009 constants (fixed values).
EGFR_SCALE, EGFR_AGE, EGFR_MAX_EXP = 141.0, 0.993, -1.209
EGFR_KAPPA = {"female": 0.7, "male": 0.9}
EGFR_ALPHA = {"female": -0.329, "male": -0.411}
EGFR_FEMALE, EGFR_BLACK = 1.018, 1.159


def egfr(creatinine: Column, age: Column, is_female: Column, is_black: Column | None = None) -> Column:
    """Estimated filtration rate, half-even to two places; an unknown race counts as false."""
    level = creatinine.cast("double")
    kappa = F.when(is_female, EGFR_KAPPA["female"]).otherwise(EGFR_KAPPA["male"])
    alpha = F.when(is_female, EGFR_ALPHA["female"]).otherwise(EGFR_ALPHA["male"])
    ratio = level / kappa
    rate = (
        F.lit(EGFR_SCALE)
        * F.pow(F.least(ratio, F.lit(1.0)), alpha)
        * F.pow(F.greatest(ratio, F.lit(1.0)), F.lit(EGFR_MAX_EXP))
        * F.pow(F.lit(EGFR_AGE), age)
        * F.when(is_female, EGFR_FEMALE).otherwise(1.0)
    )
    if is_black is not None:
        rate = rate * F.when(is_black, EGFR_BLACK).otherwise(1.0)
    return F.when((level > 0) & age.isNotNull() & is_female.isNotNull(), F.bround(rate, 2))


def format_name(first: Column, middle: Column, last: Column, suffix: Column, style: str = "LAST_FIRST") -> Column:
    """A display name. Null middle name and suffix vanish; null first or last name gives null."""

    def optional(before: str, part: Column, after: str = "") -> Column:
        return F.coalesce(F.concat(F.lit(before), part, F.lit(after)), F.lit(""))

    given = F.concat(first, optional(" ", middle))
    surname_first = F.concat(last, F.lit(", "), first)
    if style == "LAST_FIRST":
        return F.concat(surname_first, optional(" ", F.left(middle, F.lit(1)), "."))
    if style == "FIRST_LAST":
        return F.concat(given, F.lit(" "), last, optional(" ", suffix))
    if style == "FULL":
        return F.concat(given, F.lit(" "), last, optional(", ", suffix))
    if style == "FORMAL":
        return F.concat(surname_first, optional(" ", middle), optional(", ", suffix))
    return surname_first


# Code shapes (fixed values).
ICD_SHAPE = r"(?i)^[A-Z][0-9]{2}(\.[A-Z0-9]*)?$"
ICD_STRICT = r"^[A-Z]\d{2}(\.\d{1,4}[A-Z]?)?$"
# Chapter letters whose category number is bounded (fixed values).
ICD_CHAPTER_MAX = {"C": 96, "D": 89, "E": 89, "H": 95, "K": 95, "P": 96, "T": 88}
ICD_CHAPTER_MIN = {"F": 1}
ICD_CHAPTER_UNUSED = "U"


def icd10_shape_ok(code: Column) -> Column:
    """Loose check: letter, two digits, optional dot and alphanumerics; trailing blanks ignored."""
    return F.coalesce(F.rtrim(code).rlike(ICD_SHAPE), F.lit(False))


def icd10_strict_ok(code: Column) -> Column:
    """Strict check: digits after the dot, at most one final letter, chapter range respected."""
    clean = F.upper(trim_unicode(code))
    chapter = F.left(clean, F.lit(1))
    category = F.try_to_number(F.substring(clean, 2, 2), F.lit("99")).cast("int")
    in_range = chapter != ICD_CHAPTER_UNUSED
    for letter, top in ICD_CHAPTER_MAX.items():
        in_range = in_range & ((chapter != letter) | (category <= top))
    for letter, bottom in ICD_CHAPTER_MIN.items():
        in_range = in_range & ((chapter != letter) | (category >= bottom))
    return F.coalesce(F.when(clean.rlike(ICD_STRICT), in_range), F.lit(False))


# Salt suffixes, tried in this order; only the first match is removed (fixed values).
SALT_SUFFIXES = (
    "HCL",
    "HYDROCHLORIDE",
    "SODIUM",
    "POTASSIUM",
    "SULFATE",
    "ACETATE",
    "TARTRATE",
    "MALEATE",
    "MESYLATE",
    "BESYLATE",
    "FUMARATE",
)
# Words and strengths dropped from a drug name (fixed values).
DOSAGE_FORMS = r"\s*(TABLET|CAPSULE|INJECTION|SOLUTION|SUSPENSION|CREAM|OINTMENT|PATCH|INHALER)\s*"
STRENGTHS = r"\s*\d+\s*(MG|MCG|ML|G|%|UNITS?)\s*"


def normalize_drug(name: Column) -> Column:
    """Drug name without salt, dosage form and strength, for comparing spellings.

    No suffix ends with another one, so a single alternation removes at most one. The
    (?U) flag makes blanks and digits mean the Unicode ones.
    """
    clean = F.upper(trim_unicode(name))
    clean = F.regexp_replace(clean, " (" + "|".join(SALT_SUFFIXES) + ")$", "")
    clean = F.regexp_replace(clean, "(?U)" + DOSAGE_FORMS, " ")
    clean = F.regexp_replace(clean, "(?U)" + STRENGTHS, " ")
    return F.trim(F.regexp_replace(clean, r"(?U)\s+", " "))


# Known drug pairs and their warnings (fixed values).
INTERACTIONS = (
    ("WARFARIN", "ASPIRIN", "MAJOR: Increased bleeding risk. Monitor INR closely."),
    ("WARFARIN", "IBUPROFEN", "MAJOR: Increased bleeding risk. Avoid combination if possible."),
    ("WARFARIN", "AMIODARONE", "MAJOR: Significantly increases warfarin levels. Reduce warfarin dose by 30-50%."),
    ("WARFARIN", "FLUCONAZOLE", "MAJOR: Inhibits warfarin metabolism. Monitor INR."),
    ("WARFARIN", "METRONIDAZOLE", "MAJOR: Inhibits warfarin metabolism. Consider dose reduction."),
    ("METFORMIN", "CONTRAST_DYE", "MAJOR: Risk of lactic acidosis. Hold metformin 48h before/after contrast."),
    ("METFORMIN", "ALCOHOL", "MODERATE: Increased risk of lactic acidosis and hypoglycemia."),
    ("LISINOPRIL", "POTASSIUM", "MODERATE: Risk of hyperkalemia. Monitor potassium levels."),
    ("LISINOPRIL", "SPIRONOLACTONE", "MODERATE: Additive hyperkalemia risk. Monitor electrolytes."),
    ("LISINOPRIL", "NSAID", "MODERATE: NSAIDs may reduce ACE inhibitor efficacy and increase renal risk."),
    ("SIMVASTATIN", "AMIODARONE", "MAJOR: Increased risk of rhabdomyolysis. Limit simvastatin to 20mg."),
    ("SIMVASTATIN", "CLARITHROMYCIN", "MAJOR: Significantly increases statin levels. Suspend statin during therapy."),
    ("SIMVASTATIN", "GRAPEFRUIT", "MODERATE: Increases statin absorption. Avoid large quantities."),
    ("DIGOXIN", "AMIODARONE", "MAJOR: Increases digoxin levels by 70-100%. Reduce digoxin dose."),
    ("DIGOXIN", "VERAPAMIL", "MAJOR: Increases digoxin levels. Monitor levels closely."),
    ("DIGOXIN", "FUROSEMIDE", "MODERATE: Hypokalemia increases digoxin toxicity risk. Monitor K+."),
)
NO_INTERACTION = "NO_INTERACTION"


def drug_key(name: Column) -> Column:
    return F.upper(trim_unicode(name))


def check_interaction(drug_a: Column, drug_b: Column) -> Column:
    """The warning for a drug pair in either order, ``NO_INTERACTION``, or null for a null drug.

    The sixteen pairs are a literal map, so no join is needed.
    """
    pairs = F.create_map(
        *[F.lit(x) for a, b, text in INTERACTIONS for key in (f"{a}|{b}", f"{b}|{a}") for x in (key, text)]
    )
    key = F.concat(drug_key(drug_a), F.lit("|"), drug_key(drug_b))
    return F.when(key.isNotNull(), F.coalesce(F.try_element_at(pairs, key), F.lit(NO_INTERACTION)))
