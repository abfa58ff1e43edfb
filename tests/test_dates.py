from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyfold.plans.dates import DateRange, FiscalYear, ReportDates, covering, month_range, year_before

DAYS = st.dates(date(1990, 1, 1), date(2060, 12, 31))


def test_fiscal_year_runs_from_february_to_january():
    year = FiscalYear(2026)
    assert (year.start, year.end, year.label) == (date(2025, 2, 1), date(2026, 1, 31), "fy26")


@pytest.mark.parametrize(
    ("day", "number"), [(date(2025, 1, 31), 2025), (date(2025, 2, 1), 2026), (date(2025, 12, 31), 2026)]
)
def test_fiscal_year_of_a_day(day, number):
    assert FiscalYear.containing(day).number == number


@given(DAYS, st.integers(1, 12))
def test_a_day_lies_in_its_fiscal_year(day, first_month):
    year = FiscalYear.containing(day, first_month)
    assert year.start <= day <= year.end


def test_default_comparisons_are_the_last_complete_periods():
    day, week, month = ReportDates(date(2025, 5, 6)).comparisons
    assert (day.current.start, day.previous.start) == (date(2025, 5, 3), date(2025, 5, 2))
    assert week.current == DateRange(date(2025, 4, 27), date(2025, 5, 3))
    assert week.previous == DateRange(date(2025, 4, 20), date(2025, 4, 26))
    assert month.current == month_range("2025-04")
    assert month.previous == month_range("2025-03")


@given(DAYS)
def test_default_week_is_complete_and_runs_from_sunday_to_saturday(day):
    dates = ReportDates(day)
    week = dates.comparisons[1].current
    assert week.start.isoweekday() == 7 and week.days_between == 6
    assert 0 <= (dates.cutoff - week.end).days < 7


def test_prior_year_to_date_has_no_lag_unless_aligned():
    assert ReportDates(date(2025, 5, 6)).prior_ytd.end == date(2024, 5, 6)
    assert ReportDates(date(2025, 5, 6), align_lag=True).prior_ytd.end == date(2024, 5, 3)


def test_leap_day_falls_on_the_28th_a_year_before():
    assert year_before(date(2024, 2, 29)) == date(2023, 2, 28)


def test_year_to_date_is_empty_while_the_cutoff_lies_before_the_fiscal_year():
    dates = ReportDates(date(2025, 2, 2))
    assert dates.ytd.start > dates.ytd.end
    assert dates.fiscal_year.number == 2026


def test_year_to_date_of_a_past_year_stops_at_its_end():
    dates = ReportDates(date(2025, 5, 6))
    assert dates.ytd_of(FiscalYear(2025)) == FiscalYear(2025).range


def test_december_month_ends_on_the_31st():
    assert month_range("2024-12") == DateRange(date(2024, 12, 1), date(2024, 12, 31))


@given(st.lists(st.tuples(DAYS, DAYS), max_size=6), DAYS)
def test_covering_keeps_exactly_the_days_of_the_ranges(pairs, day):
    ranges = [DateRange(a, b) for a, b in pairs]
    merged = covering(ranges)
    assert any(r.start <= day <= r.end for r in ranges) == any(r.start <= day <= r.end for r in merged)
    assert all(a.end < b.start for a, b in zip(merged, merged[1:]))
