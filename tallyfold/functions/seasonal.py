"""Seasonal factors of the cost model: weekend dip, month-end rise, linear growth."""

from __future__ import annotations

from datetime import date


def weekend_factor(day: str, factor: float) -> str:
    """``factor`` on Saturday and Sunday, else 1."""
    return f"if(weekday({day}) >= 5, {factor}D, 1D)"


def month_end_factor(day: str, factor: float = 1.2, days: int = 5) -> str:
    """``factor`` on the last days of a month, else 1."""
    return f"if(day({day}) > day(last_day({day})) - {days}, {factor}D, 1D)"


def linear_growth(day: str, start: date, rate: float, period_days: int = 365) -> str:
    return f"(1D + datediff({day}, date'{start}') / {period_days}D * {rate}D)"


def seasonal_cost(base: str, day: str, start: date) -> str:
    """Cost of one fact: base cost with all three effects, to the cent."""
    growth = linear_growth(day, start, 0.12)
    return to_cents(f"double({base}) * {weekend_factor(day, 0.6)} * {month_end_factor(day)} * {growth}")


def seasonal_daily_averages(base: str, day: str, start: date) -> dict[str, str]:
    """Columns of the daily-average table modelled from one base daily cost."""
    level = f"double({base}) * {weekend_factor(day, 0.7)}"
    ytd = f"{level} * 0.97D"
    forecast = f"{level} * {linear_growth(day, start, 0.08, 180)}"
    return {
        "second_prior_avg": to_cents(f"{level} * 0.85D"),
        "prior_avg": to_cents(f"{level} * 0.92D"),
        "ytd_avg": to_cents(ytd),
        "forecasted_avg": to_cents(forecast),
        "current_avg": to_cents(f"({ytd} + {forecast}) / 2"),
        "daily_cost": to_cents(f"{level} * {linear_growth(day, start, 0.15)}"),
    }


def to_cents(amount: str) -> str:
    return f"double(round(cast({amount} as decimal(28,8)), 2))"
