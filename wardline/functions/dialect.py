"""Column helpers for the source dialect's expression rules.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def year_diff(start: Column, end: Column) -> Column:
    """Difference of calendar year numbers (not elapsed years)."""
    return F.year(end) - F.year(start)


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday, whatever the session's locale."""
    return F.weekday(day) >= 5


def day_diff(start: Column, end: Column) -> Column:
    """Calendar days from start to end, time of day ignored."""
    return F.datediff(end, start)


def minute_index(moment: Column) -> Column:
    """Whole minutes on the wall clock since 1970, whatever the session time zone."""
    days = F.datediff(moment, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(moment) * 60 + F.minute(moment)


def second_index(moment: Column) -> Column:
    """Whole seconds on the wall clock since 1970."""
    return minute_index(moment) * 60 + F.second(moment)


def minute_diff(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:00 is one."""
    return minute_index(end) - minute_index(start)


def flag(column: Column) -> Column:
    """True where a 0/1 or boolean flag is set."""
    return column.cast("int") == 1


def as_bit(condition: Column) -> Column:
    """0/1 for a condition; unknown counts as 0."""
    return F.when(condition, 1).otherwise(0)


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad a number with zeros. A number wider than the field keeps all its digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.right(F.concat(F.lit("0" * width), text), F.lit(width)))


def number_suffix(numbered: Column) -> Column:
    """The running number at the end of PREFIX-PERIOD-00001."""
    return F.substring_index(numbered, "-", -1).cast("long")


def ci_contains(text: Column, part: Column) -> Column:
    """Case-insensitive literal substring test."""
    return F.contains(F.lower(text), F.lower(part))


def ci_startswith(text: Column, prefix: str) -> Column:
    return F.lower(text).startswith(prefix.lower())


def last_first(last: Column, first: Column) -> Column:
    """LAST, FIRST; null if either part is null."""
    return F.concat(last, F.lit(", "), first)


def with_credentials(last: Column, first: Column, credentials: Column) -> Column:
    """LAST, FIRST CRED; the blank before missing credentials stays."""
    return F.concat(last_first(last, first), F.lit(" "), F.coalesce(credentials, F.lit("")))


def us_date(moment: Column) -> Column:
    return F.date_format(moment, "MM/dd/yyyy")


# Code points of the blanks a Unicode-aware trim drops (fixed values).
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def trim_unicode(text: Column) -> Column:
    """Strip every kind of blank, not only the space that trim() strips."""
    return F.btrim(text, F.lit("".join(map(chr, BLANKS))))


def xml_escape(text: Column) -> Column:
    """Escape markup characters for element text and attribute values."""
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def xml_element(name: str, value: Column) -> Column:
    """<name>value</name>, or null for a null value (null elements are left out)."""
    return F.concat(F.lit(f"<{name}>"), xml_escape(value.cast("string")), F.lit(f"</{name}>"))


def xml_row(root: str, fields: dict[str, Column]) -> Column:
    """One element per non-null field under a root element."""
    parts = [xml_element(name, value) for name, value in fields.items()]
    return F.concat(F.lit(f"<{root}>"), F.concat_ws("", *parts), F.lit(f"</{root}>"))


def xml_attributes(root: str, fields: dict[str, Column]) -> Column:
    """One attribute per non-null field on a single element."""
    parts = [
        F.concat(F.lit(f'{name}="'), xml_escape(value.cast("string")), F.lit('"')) for name, value in fields.items()
    ]
    return F.concat(F.lit(f"<{root} "), F.concat_ws(" ", *parts), F.lit("/>"))


def iso_seconds(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def sum_or_zero(amount: Column) -> Column:
    """Sum that is 0.00 for an empty group."""
    return money(F.coalesce(F.sum(amount), F.lit(0)))
