"""Report dates: fiscal years, cut-off, comparison windows.

Everything here is a handful of scalar parameters fixed before a plan is built;
per-row date logic lives in ``functions.fiscal`` as SQL expressions.
"""

from __future__ import annotations

import calendar
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

DAY = timedelta(days=1)


@dataclass(frozen=True, order=True)
class DateRange:
    """Inclusive range of days; empty when ``end`` lies before ``start``."""

    start: date
    end: date

    def contains(self, day: str = "date") -> str:
        """SQL test whether a date lies in the range."""
        return f"({day} between date'{self.start}' and date'{self.end}')"

    @property
    def days_between(self) -> int:
        """Days from start to end, the end day not counted."""
        return (self.end - self.start).days


def covering(ranges: Iterable[DateRange]) -> list[DateRange]:
    """Merge overlapping and touching ranges, so a scan reads each day once."""
    merged: list[DateRange] = []
    for span in sorted(r for r in ranges if r.start <= r.end):
        if merged and span.start <= merged[-1].end + DAY:
            merged[-1] = DateRange(merged[-1].start, max(merged[-1].end, span.end))
        else:
            merged.append(span)
    return merged


def within(ranges: Iterable[DateRange], day: str = "date") -> str:
    """SQL test for the union of some ranges, in a form that reaches the file scan."""
    return " or ".join(span.contains(day) for span in covering(ranges)) or "false"


def year_before(day: date) -> date:
    """Same day one year earlier; 29 February becomes 28 February."""
    last = calendar.monthrange(day.year - 1, day.month)[1]
    return date(day.year - 1, day.month, min(day.day, last))


def month_range(month: str) -> DateRange:
    """First to last day of a ``YYYY-MM`` month."""
    year, number = (int(part) for part in month.split("-"))
    return DateRange(date(year, number, 1), date(year, number, calendar.monthrange(year, number)[1]))


@dataclass(frozen=True)
class FiscalYear:
    """Fiscal year named after the calendar year it ends in."""

    number: int
    first_month: int = 2

    @classmethod
    def containing(cls, day: date, first_month: int = 2) -> FiscalYear:
        starts_this_year = first_month > 1 and day.month >= first_month
        return cls(day.year + (1 if starts_this_year else 0), first_month)

    @property
    def start(self) -> date:
        return date(self.number - (1 if self.first_month > 1 else 0), self.first_month, 1)

    @property
    def end(self) -> date:
        return FiscalYear(self.number + 1, self.first_month).start - DAY

    @property
    def range(self) -> DateRange:
        return DateRange(self.start, self.end)

    @property
    def label(self) -> str:
        return f"fy{self.number % 100:02d}"

    def back(self, years: int = 1) -> FiscalYear:
        return FiscalYear(self.number - years, self.first_month)


@dataclass(frozen=True)
class Comparison:
    """One named pair of periods."""

    name: str
    current: DateRange
    previous: DateRange


@dataclass(frozen=True)
class ReportDates:
    """All dates a report needs, derived from the day it is made.

    Costs of the last ``lag_days`` are incomplete, so the year to date stops at the
    cut-off. The prior year to date runs to the day one year before ``as_of`` with no
    lag; ``align_lag`` ends it one year before the cut-off instead.
    """

    as_of: date
    lag_days: int = 3
    first_month: int = 2
    align_lag: bool = False
    day: Comparison | None = field(default=None)
    week: Comparison | None = field(default=None)
    month: Comparison | None = field(default=None)

    @property
    def cutoff(self) -> date:
        return self.as_of - self.lag_days * DAY

    @property
    def fiscal_year(self) -> FiscalYear:
        return FiscalYear.containing(self.as_of, self.first_month)

    @property
    def prior_year(self) -> FiscalYear:
        return self.fiscal_year.back()

    @property
    def ytd(self) -> DateRange:
        return self.ytd_of(self.fiscal_year)

    def ytd_of(self, year: FiscalYear) -> DateRange:
        """From the start of a fiscal year to the cut-off, never past the year's end."""
        return DateRange(year.start, min(self.cutoff, year.end))

    @property
    def prior_ytd(self) -> DateRange:
        return DateRange(self.prior_year.start, year_before(self.cutoff if self.align_lag else self.as_of))

    @property
    def run_rate_days(self) -> int:
        return self.ytd.days_between

    @property
    def average_span(self) -> DateRange:
        """Days the daily-average table covers: two prior fiscal years and the current one."""
        return DateRange(self.fiscal_year.back(2).start, self.fiscal_year.end)

    @property
    def average_columns(self) -> dict[str, str]:
        """Names of the fiscal-year columns of the daily-average table, in table order."""
        year = self.fiscal_year
        return {
            "second_prior": f"{year.back(2).label}_avg_daily_spend",
            "prior": f"{year.back().label}_avg_daily_spend",
            "ytd": f"{year.label}_ytd_avg_daily_spend",
            "forecast": f"{year.label}_forecasted_avg_daily_spend",
            "current": f"{year.label}_avg_daily_spend",
        }

    @property
    def comparisons(self) -> list[Comparison]:
        """Configured day, week and month pairs, else the last complete ones."""
        return [self.day or self._last_day(), self.week or self._last_week(), self.month or self._last_month()]

    def _last_day(self) -> Comparison:
        before = self.cutoff - DAY
        return Comparison("day", DateRange(self.cutoff, self.cutoff), DateRange(before, before))

    def _last_week(self) -> Comparison:
        # Sunday-to-Saturday week ending on or before the cut-off.
        end = self.cutoff - ((self.cutoff.weekday() - 5) % 7) * DAY
        current = DateRange(end - 6 * DAY, end)
        return Comparison("week", current, DateRange(current.start - 7 * DAY, current.start - DAY))

    def _last_month(self) -> Comparison:
        end = self.cutoff.replace(day=1) - DAY
        start = end.replace(day=1)
        before = start - DAY
        return Comparison("month", DateRange(start, end), DateRange(before.replace(day=1), before))
