"""Calendar and fiscal-calendar expressions over a date."""

from __future__ import annotations


def fiscal_year(day: str, first_month: int = 2) -> str:
    """Number of the fiscal year a day falls in (named after the year it ends in)."""
    return f"year(add_months({day}, {(13 - first_month) % 12}))"


def fiscal_year_start(day: str, first_month: int = 2) -> str:
    started = 1 if first_month > 1 else 0
    return f"make_date({fiscal_year(day, first_month)} - {started}, {first_month}, 1)"


def fiscal_year_end(day: str, first_month: int = 2) -> str:
    return f"date_sub(add_months({fiscal_year_start(day, first_month)}, 12), 1)"


def day_of_fiscal_year(day: str, first_month: int = 2) -> str:
    return f"datediff({day}, {fiscal_year_start(day, first_month)}) + 1"


def month_start(month: str) -> str:
    """First day of a ``YYYY-MM`` text."""
    return f"to_date(concat({month}, '-01'))"


def month_end(month: str) -> str:
    return f"last_day({month_start(month)})"


def month_label(day: str) -> str:
    return f"date_format({day}, 'MMM yyyy')"


def range_label(start: str, end: str) -> str:
    return f"concat(date_format({start}, 'MMM dd'), ' - ', date_format({end}, 'MMM dd, yyyy'))"


def relative_periods(today: str) -> dict[str, str]:
    """Day, week and month periods counted back from a day.

    The week ends on the last Sunday strictly before the day.
    """
    past_week_end = f"weekday({today}) + 1"
    return {
        "day_current": today,
        "day_previous": f"date_sub({today}, 1)",
        "week_current_start": f"date_sub({today}, {past_week_end} + 6)",
        "week_current_end": f"date_sub({today}, {past_week_end})",
        "week_previous_start": f"date_sub({today}, {past_week_end} + 13)",
        "week_previous_end": f"date_sub({today}, {past_week_end} + 7)",
        "month_current": f"to_date(trunc({today}, 'month'))",
        "month_previous": f"to_date(add_months(trunc({today}, 'month'), -1))",
    }


def report_window(today: str, days_back: int = 90, lag_days: int = 3) -> dict[str, str]:
    return {
        "report_start_date": f"date_sub({today}, {days_back})",
        "report_end_date": f"date_sub({today}, {lag_days})",
    }
