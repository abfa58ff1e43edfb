"""Costs per environment over periods, and how they changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.environment import CLASSES, NON_PROD, PROD, classify_environment
from tallyfold.functions.money import (
    change_direction,
    growth_percent,
    percent_change,
    share_percent,
    sum_where,
)
from tallyfold.operators.filters import NO_FILTER, CostFilter, filter_facts
from tallyfold.plans.dates import Comparison, DateRange, FiscalYear, ReportDates, within


def _kept(facts: DataFrame, spans: list[DateRange], chosen: CostFilter) -> DataFrame:
    return filter_facts(facts, chosen).filter(within(spans))


def _aliased(values: dict[str, str]) -> list[str]:
    return [f"{value} as {name}" for name, value in values.items()]


def _sums_by_environment(
    facts: DataFrame, spans: list[DateRange], sums: dict[str, str], chosen: CostFilter
) -> DataFrame:
    """Sums per environment class, as doubles."""
    environment = F.expr(f"{classify_environment()} as environment_type")
    exact = [F.expr(f"double({value}) as {name}") for name, value in sums.items()]
    return _kept(facts, spans, chosen).groupBy(environment).agg(*exact)


def ytd_costs(
    facts: DataFrame, dates: ReportDates, year: FiscalYear | None = None, chosen: CostFilter = NO_FILTER
) -> DataFrame:
    """Cost per environment from the start of a fiscal year to the cut-off."""
    span = dates.ytd_of(year or dates.fiscal_year)
    return _sums_by_environment(facts, [span], {"ytd_cost": "sum(cost)"}, chosen)


def fy_total_costs(
    facts: DataFrame, dates: ReportDates, year: FiscalYear | None = None, chosen: CostFilter = NO_FILTER
) -> DataFrame:
    """Booked cost per environment over a whole fiscal year."""
    span = (year or dates.fiscal_year).range
    return _sums_by_environment(facts, [span], {"total_cost": "sum(cost)"}, chosen)


def prior_fy_costs(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Prior fiscal year per environment: the whole year, and up to a year before today."""
    sums = {"total_cost": "sum(cost)", "ytd_cost": sum_where(dates.prior_ytd.contains())}
    return _sums_by_environment(facts, [dates.prior_year.range], sums, chosen)


def _compare(facts: DataFrame, pair: Comparison, current: str, previous: str, chosen: CostFilter) -> DataFrame:
    sums = {current: sum_where(pair.current.contains()), previous: sum_where(pair.previous.contains())}
    return _sums_by_environment(facts, [pair.previous, pair.current], sums, chosen)


def day_comparison(facts: DataFrame, pair: Comparison, chosen: CostFilter = NO_FILTER) -> DataFrame:
    return _compare(facts, pair, "day_current_cost", "day_previous_cost", chosen)


def week_comparison(facts: DataFrame, pair: Comparison, chosen: CostFilter = NO_FILTER) -> DataFrame:
    return _compare(facts, pair, "this_week_cost", "prev_week_cost", chosen)


def month_comparison(facts: DataFrame, pair: Comparison, chosen: CostFilter = NO_FILTER) -> DataFrame:
    return _compare(facts, pair, "this_month_cost", "prev_month_cost", chosen)


def daily_environment_costs(facts: DataFrame, spans: list[DateRange], chosen: CostFilter = NO_FILTER) -> DataFrame:
    """One exact sum per day and environment.

    Every fused report below is computed from these few rows per day: the facts are
    read once and each adds to one sum, however many periods are asked for.
    """
    environment = F.expr(f"{classify_environment()} as environment_type")
    return _kept(facts, spans, chosen).groupBy("date", environment).agg(F.expr("sum(cost) as cost"))


def _amount(span: DateRange, environment: str) -> str:
    """Cost of one environment in a range, zero if there is none."""
    condition = f"{span.contains()} and environment_type = '{environment}'"
    return f"coalesce(double({sum_where(condition)}), 0D)"


def _with_change(pairs: DataFrame, change: str) -> DataFrame:
    changed = pairs.selectExpr("*", f"{change} as percent_change")
    return changed.selectExpr("*", f"{change_direction('percent_change')} as direction")


def compare_in_one_pass(facts: DataFrame, pairs: list[Comparison], chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Several period pairs for both environments from one scan, one row per pair and environment.

    An environment without facts shows zero costs and no change.
    """
    spans = [span for pair in pairs for span in (pair.current, pair.previous)]
    rows = [
        f"struct('{pair.name}' as period, '{environment}' as environment_type,"
        f" {_amount(pair.current, environment)} as current_cost,"
        f" {_amount(pair.previous, environment)} as previous_cost)"
        for pair in pairs
        for environment in CLASSES
    ]
    daily = daily_environment_costs(facts, spans, chosen)
    long = daily.selectExpr(f"array({', '.join(rows)}) as pairs").selectExpr("inline(pairs)")
    return _with_change(long, percent_change("current_cost", "previous_cost"))


def percent_change_comparison(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Day, week and month against the one before, per environment."""
    return compare_in_one_pass(facts, dates.comparisons, chosen)


def period_matrix(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Day, week, month, year to date and fiscal year against the one before, per environment."""
    pairs = [
        *dates.comparisons,
        Comparison("ytd", dates.ytd, dates.prior_ytd),
        Comparison("fiscal_year", dates.fiscal_year.range, dates.prior_year.range),
    ]
    return compare_in_one_pass(facts, pairs, chosen)


def _fiscal_summary(facts: DataFrame, dates: ReportDates, chosen: CostFilter) -> DataFrame:
    """One row of year-to-date, full-year and prior year-to-date sums, zero where nothing was booked."""
    spans = {"ytd": dates.ytd, "fy": dates.fiscal_year.range, "prior": dates.prior_ytd}
    daily = daily_environment_costs(facts, list(spans.values()), chosen)
    parts = {
        f"{name}_{period}": _amount(span, environment)
        for period, span in spans.items()
        for name, environment in (("prod", PROD), ("nonprod", NON_PROD))
    }
    totals = [f"prod_{period} + nonprod_{period} as total_{period}" for period in spans]
    return daily.selectExpr(*_aliased(parts)).selectExpr("*", *totals)


def grand_totals(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Both environments together: year to date, fiscal year, prior year to date."""
    return _fiscal_summary(facts, dates, chosen).selectExpr(
        "total_ytd as total_fy_ytd_cost", "total_fy as total_fy_cost", "total_prior as total_prior_ytd_cost"
    )


def prior_year_join(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Year to date next to the prior year to date, per environment with facts in either."""
    sums = {"ytd_cost": sum_where(dates.ytd.contains()), "prior_ytd_cost": sum_where(dates.prior_ytd.contains())}
    aligned = _sums_by_environment(facts, [dates.ytd, dates.prior_ytd], sums, chosen)
    return aligned.selectExpr("*", f"{growth_percent('ytd_cost', 'prior_ytd_cost')} as percent_change")


def yoy_ytd_change(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Year-to-date change against the prior year: production, non-production, total."""
    scopes = ((PROD, "prod"), (NON_PROD, "nonprod"), ("TOTAL", "total"))
    rows = [
        f"struct('{scope}' as scope, {name}_ytd as ytd_cost, {name}_prior as prior_ytd_cost)"
        for scope, name in scopes
    ]
    long = _fiscal_summary(facts, dates, chosen).selectExpr(f"inline(array({', '.join(rows)}))")
    return _with_change(long, growth_percent("ytd_cost", "prior_ytd_cost"))


def projected_vs_prior_ytd(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Fiscal-year cost booked so far against the prior year to date."""
    return _fiscal_summary(facts, dates, chosen).selectExpr(
        "total_fy as total_fy_cost",
        "total_prior as total_prior_ytd_cost",
        f"{growth_percent('total_fy', 'total_prior')} as fy_percent",
    )


_SHARE = share_percent("nonprod_ytd", "total_ytd")
_PRIOR_SHARE = share_percent("nonprod_prior", "total_prior")
_SHARE_CHANGE = f"if(total_prior > 0, {_SHARE} - {_PRIOR_SHARE}, 0D)"


def nonprod_share_change(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Non-production share of the year to date, a year ago, and the difference in points."""
    return _fiscal_summary(facts, dates, chosen).selectExpr(
        f"{_SHARE} as nonprod_percentage",
        f"{_PRIOR_SHARE} as prior_nonprod_percentage",
        f"{_SHARE_CHANGE} as nonprod_percentage_change",
    )


def environment_breakdown(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """One row: year-to-date cost of both environments, their total and shares in percent."""
    return _fiscal_summary(facts, dates, chosen).selectExpr(
        "prod_ytd as prod_cost",
        "nonprod_ytd as nonprod_cost",
        "total_ytd as total_cost",
        f"{share_percent('prod_ytd', 'total_ytd')} as prod_percentage",
        f"{_SHARE} as nonprod_percentage",
    )


def scorecard(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """One row with every headline figure of the report, from one scan."""
    return scorecard_figures(_fiscal_summary(facts, dates, chosen))


def scorecard_figures(sums: DataFrame, *kept: str) -> DataFrame:
    """Headline figures of rows of year-to-date, full-year and prior sums per environment, behind the columns ``kept``."""
    periods = [period for period in ("ytd", "fy", "prior") if f"total_{period}" not in sums.columns]
    totals = sums.selectExpr("*", *[f"prod_{period} + nonprod_{period} as total_{period}" for period in periods])
    amounts = {
        "prod_ytd_cost": "prod_ytd",
        "nonprod_ytd_cost": "nonprod_ytd",
        "prod_fy_ytd_cost": "prod_ytd",
        "nonprod_fy_ytd_cost": "nonprod_ytd",
        "total_fy_ytd_cost": "total_ytd",
        "prod_prior_cost": "prod_prior",
        "nonprod_prior_cost": "nonprod_prior",
        "total_prior_ytd_cost": "total_prior",
        "total_fy_cost": "total_fy",
        "nonprod_percentage": _SHARE,
    }
    changes = {
        "prod_ytd_percent": growth_percent("prod_ytd", "prod_prior"),
        "nonprod_ytd_percent": growth_percent("nonprod_ytd", "nonprod_prior"),
        "fy_ytd_percent": growth_percent("total_ytd", "total_prior"),
        "fy_percent": growth_percent("total_fy", "total_prior"),
        "nonprod_percentage_change": _SHARE_CHANGE,
    }
    classes = {f"{name}_class": change_direction(name) for name in changes}
    figures = totals.selectExpr(*kept, *_aliased(amounts), *_aliased(changes))
    return figures.selectExpr("*", *_aliased(classes))
