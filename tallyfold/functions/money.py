"""Sums, ratios, forecasts and labels of costs.

Costs are summed as exact decimals and turned into doubles last, so a result does
not depend on the order in which tasks finish.
"""

from __future__ import annotations

# Optional sign, digits with an optional point, optional exponent; or a signed infinity.
# Narrower than a cast to double, which also takes suffixes such as "1d".
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def sum_where(condition: str, value: str = "cost") -> str:
    """Sum of ``value`` where the condition holds, zero for the other rows."""
    return f"sum(if({condition}, {value}, 0))"


def or_zero(amount: str) -> str:
    return f"coalesce({amount}, 0D)"


def safe_ratio(part: str, whole: str) -> str:
    """NULL where the denominator is zero."""
    return f"(double({part}) / nullif(double({whole}), 0D))"


def share_percent(part: str, whole: str) -> str:
    """Part of whole in percent, zero unless the whole is positive."""
    return f"if({whole} > 0, double({part}) / double({whole}) * 100, 0D)"


def percent_change(current: str, previous: str) -> str:
    """(current / previous - 1) in percent, zero unless the base is positive."""
    return or_zero(f"if({previous} > 0, (double({current}) / double({previous}) - 1) * 100, 0D)")


def growth_percent(current: str, prior: str) -> str:
    """(current - prior) / prior in percent, zero unless the base is positive."""
    return or_zero(f"if({prior} > 0, (double({current}) - double({prior})) / double({prior}) * 100, 0D)")


def change_direction(change: str) -> str:
    # Class names a report page styles changes by.
    return f"if({change} > 0, 'positive-change', if({change} < 0, 'negative-change', 'neutral-change'))"


def run_rate_forecast(total: str, elapsed_days: int | str) -> str:
    """Full-year cost at the average of the elapsed days; NULL before the first day ends."""
    return f"(double({total}) * 365 / nullif(double({elapsed_days}), 0D))"


def run_rate_forecast_at_least_one_day(total: str, elapsed_days: int | str) -> str:
    return f"(double({total}) * 365 / greatest({elapsed_days}, 1))"


def growth_forecast(average: str, growth: float = 1.15) -> str:
    return f"({average} * {growth}D)"


def to_millions(amount: str) -> str:
    return f"(double({amount}) / 1000000)"


def coerce_numeric(text: str) -> str:
    """Number in a text; zero for NULL and for text that is no number."""
    return or_zero(f"if({text} rlike r'{_NUMBER}', try_cast(trim({text}) as double), 0D)")


def total_or_parts(total: str, prod: str, nonprod: str) -> str:
    """A zero total next to a positive part is replaced by the sum of the parts."""
    return f"if({total} = 0 and ({prod} > 0 or {nonprod} > 0), {prod} + {nonprod}, {total})"


def environment_amounts(environment: str, amount: str) -> dict[str, str]:
    """Production and non-production amounts of a row that carries one environment label."""
    return {
        "prod_ytd_cost": f"if({environment} = 'PROD', {amount}, 0)",
        "nonprod_ytd_cost": f"if({environment} = 'NON-PROD', {amount}, 0)",
    }


def currency_label(amount: str) -> str:
    """``$1,234.56``; rounded once, from the exact value of the double, halves to even."""
    return f"concat('$', format_number(double({amount}), 2))"


def bar_label(amount: str, percent: str, millions: bool = False) -> str:
    """``$1234 (56.7%)`` or ``$1.23M (56.7%)``."""
    number = f"format_number({to_millions(amount)}, '0.00')" if millions else f"format_number(double({amount}), '0')"
    return f"concat('$', {number}, format_string('{'M' if millions else ''} (%.1f%%)', {percent}))"


def products_label(amount: str, products: str) -> str:
    """``$1,234.56 (7 products)``."""
    return f"concat({currency_label(amount)}, format_string(' (%d products)', coalesce({products}, 0)))"
