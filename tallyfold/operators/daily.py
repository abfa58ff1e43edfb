"""The daily-average table: cost per day next to fiscal-year averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.environment import classify_environment
from tallyfold.functions.money import growth_forecast, or_zero, sum_where
from tallyfold.operators.filters import NO_FILTER, CostFilter, between_dates, filter_facts
from tallyfold.plans.dates import DateRange, ReportDates

GROUP = ["environment_type", "cto"]
_DAILY_COST = "double(round(cost, 2)) as daily_cost"


def daily_rollup(
    facts: DataFrame, span: DateRange, mode: str = "prefix", chosen: CostFilter = NO_FILTER
) -> DataFrame:
    """Exact cost per (date, environment, organisation).

    One row per day and group, so a count of its rows is a count of distinct days, and
    everything below needs neither a second scan nor a distinct aggregate.
    """
    kept = between_dates(filter_facts(facts, chosen), span)
    environment = F.expr(f"{classify_environment(mode=mode)} as environment_type")
    return kept.groupBy("date", environment, "cto").agg(F.expr("sum(cost) as cost"))


def daily_costs(
    facts: DataFrame, span: DateRange, mode: str = "prefix", chosen: CostFilter = NO_FILTER
) -> DataFrame:
    """Cost per (date, environment, organisation) to the cent."""
    return daily_rollup(facts, span, mode, chosen).selectExpr("date", *GROUP, _DAILY_COST)


def _spans(dates: ReportDates) -> dict[str, DateRange]:
    year = dates.fiscal_year
    return {
        "second_prior": year.back(2).range,
        "prior": year.back().range,
        "ytd": dates.ytd,
        "current": year.range,
    }


def _days(span: DateRange) -> str:
    """Days with cost in a range: an aggregate of the roll-up."""
    return f"count(if({span.contains()}, date, null))"


def _average_columns(dates: ReportDates, over: str = "") -> list[str]:
    """Averages to the cent in table order; the forecast grows the year to date before rounding.

    ``over`` turns the aggregates of the roll-up into window functions.
    """
    exact = {
        role: f"(double({sum_where(span.contains())}{over}) / nullif(double({_days(span)}{over}), 0D))"
        for role, span in _spans(dates).items()
    }
    exact["forecast"] = growth_forecast(exact["ytd"])
    return [f"round({exact[role]}, 2) as {name}" for role, name in dates.average_columns.items()]


def fiscal_year_averages(
    facts: DataFrame, dates: ReportDates, mode: str = "prefix", chosen: CostFilter = NO_FILTER
) -> DataFrame:
    """Average cost per day with cost, per environment and organisation, for each fiscal-year column."""
    return averages_of_rollup(daily_rollup(facts, dates.average_span, mode, chosen), dates)


def averages_of_rollup(rollup: DataFrame, dates: ReportDates) -> DataFrame:
    """Fiscal-year averages of exact costs per (date, environment, organisation)."""
    return rollup.groupBy(*GROUP).agg(*[F.expr(column) for column in _average_columns(dates)])


def table_of_parts(rollup: DataFrame, averages: DataFrame, dates: ReportDates) -> DataFrame:
    """The daily-average table from costs and averages that are kept apart; a NULL organisation has averages of zero."""
    filled = [f"{or_zero(name)} as {name}" for name in dates.average_columns.values()]
    return rollup.join(averages, GROUP, "left").selectExpr("date", *GROUP, *filled, _DAILY_COST)


def conditional_distinct_days(facts: DataFrame, dates: ReportDates, mode: str = "prefix") -> DataFrame:
    """Number of days with cost per environment and organisation in each fiscal period."""
    rollup = daily_rollup(facts, dates.average_span, mode)
    counts = [F.expr(f"{_days(span)} as {role}_days") for role, span in _spans(dates).items()]
    return rollup.groupBy(*GROUP).agg(*counts)


def daily_average_table(
    facts: DataFrame,
    dates: ReportDates,
    mode: str = "prefix",
    how: str = "left",
    chosen: CostFilter = NO_FILTER,
) -> DataFrame:
    """Daily costs joined to the fiscal-year averages of their environment and organisation.

    Both sides come from the same roll-up, so the join is a window over it: the facts are
    read once and nothing is broadcast. A window partition holds one row per day, at most
    three fiscal years of them, whatever the number of facts.

    A NULL organisation equals no other in a join: ``left`` keeps its days with averages of
    zero, ``inner`` drops them. Missing averages are zero under ``left``, NULL under ``inner``.
    """
    rollup = daily_rollup(facts, dates.average_span, mode, chosen)
    if how == "inner":
        rollup = rollup.filter("cto is not null")
    averages = _average_columns(dates, f" over (partition by {', '.join(GROUP)})")
    table = rollup.selectExpr("date", *GROUP, *averages, _DAILY_COST)
    if how == "inner":
        return table
    names = dates.average_columns.values()
    filled = [f"{or_zero(f'if(cto is null, null, {name})')} as {name}" for name in names]
    return table.selectExpr("date", *GROUP, *filled, "daily_cost")
