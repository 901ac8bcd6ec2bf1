"""Explicit as-of time.

Every operator that needs "now" takes a :class:`Clock`. All bounds are computed once
on the driver and reach the plan as literals on bare columns, so the comparisons
are pushed into the Parquet scan and repeated runs give the same rows.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_months(moment: datetime, months: int) -> datetime:
    """Calendar month shift; the day is clipped to the target month's last day."""
    index = moment.year * 12 + moment.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    day = min(moment.day, calendar.monthrange(year, month)[1])
    return moment.replace(year=year, month=month, day=day)


def ts_lit(moment: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'")


def date_lit(day: date) -> Column:
    return F.expr(f"DATE '{day.isoformat()}'")


@dataclass(frozen=True)
class Clock:
    """The instant a report or job runs at."""

    now: datetime

    @staticmethod
    def at(text: str) -> "Clock":
        return Clock(datetime.fromisoformat(text))

    @property
    def ts(self) -> Column:
        return ts_lit(self.now)

    @property
    def today(self) -> Column:
        return date_lit(self.now.date())

    @property
    def day_start(self) -> datetime:
        return datetime.combine(self.now.date(), datetime.min.time())

    @property
    def month_start(self) -> Column:
        return ts_lit(self.day_start.replace(day=1))

    @property
    def year_start(self) -> Column:
        return ts_lit(self.day_start.replace(month=1, day=1))

    def days(self, n: int) -> Column:
        """Now shifted by n days, time of day kept."""
        return ts_lit(self.now + timedelta(days=n))

    def months(self, n: int) -> Column:
        return ts_lit(shift_months(self.now, n))

    def years(self, n: int) -> Column:
        return self.months(12 * n)

    def date_in_days(self, n: int) -> Column:
        return date_lit(self.now.date() + timedelta(days=n))

    def date_in_months(self, n: int) -> Column:
        return date_lit(shift_months(self.now, n).date())

    def midnight(self, n: int = 0) -> Column:
        """Start of the day n days from today."""
        return ts_lit(self.day_start + timedelta(days=n))

    def is_today(self, column: Column) -> Column:
        """Same calendar day as now, as a half-open range on the bare column."""
        return (column >= self.midnight()) & (column < self.midnight(1))

    def older_than_days(self, column: Column, n: int) -> Column:
        """More than n calendar days before today, as a bare-column bound."""
        return column < self.midnight(-n)

    def stamp(self, pattern: str) -> str:
        return self.now.strftime(pattern)
