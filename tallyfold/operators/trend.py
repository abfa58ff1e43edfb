"""Daily trend series from the daily-average table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.environment import NON_PROD, PROD, classify_environment
from tallyfold.functions.money import or_zero
from tallyfold.operators.daily import daily_costs
from tallyfold.operators.filters import NO_FILTER, CostFilter, between_dates, filter_facts, with_forecast
from tallyfold.plans.dates import DateRange, ReportDates

_ENVIRONMENT = f"{classify_environment('environment_type', mode='prefix')} as environment_type"


@dataclass(frozen=True)
class Series:
    """One line of the trend chart: a column, for all rows or those of one environment."""

    name: str
    column: str
    environment: str | None = None


def default_series(dates: ReportDates) -> list[Series]:
    """Daily cost of both environments, and production averages of this and the prior fiscal year."""
    names = dates.average_columns
    year, prior = dates.fiscal_year.label.upper(), dates.prior_year.label.upper()
    return [
        Series(f"PROD Daily Cost ({year})", "daily_cost", PROD),
        Series(f"NON-PROD Daily Cost ({year})", "daily_cost", NON_PROD),
        Series(f"{year} Avg Daily Spend", names["current"], PROD),
        Series(f"{prior} Avg Daily Spend", names["prior"], PROD),
    ]


def daily_trend(
    averages: DataFrame,
    dates: ReportDates,
    span: DateRange | None = None,
    chosen: CostFilter = NO_FILTER,
) -> DataFrame:
    """Daily cost per environment and organisation over the year to date, or over a given range.

    The daily-average table has no pillar and product columns; with such a filter use
    ``daily_trend_from_facts``.
    """
    kept = between_dates(filter_facts(averages, chosen), span or dates.ytd)
    return kept.selectExpr("date", _ENVIRONMENT, "daily_cost")


def daily_trend_from_facts(
    facts: DataFrame,
    dates: ReportDates,
    span: DateRange | None = None,
    chosen: CostFilter = NO_FILTER,
) -> DataFrame:
    """The same trend under any filter, computed from the facts."""
    return daily_costs(facts, span or dates.ytd, "prefix", chosen).select("date", "environment_type", "daily_cost")


def daily_trend_by_env(trend: DataFrame) -> DataFrame:
    """One point per day and environment: the trend summed over organisations."""
    total = F.expr("double(sum(cast(daily_cost as decimal(18,2)))) as daily_cost")
    return trend.groupBy("date", "environment_type").agg(total)


def trend_order(frame: DataFrame) -> DataFrame:
    """Newest day first, for output; stored tables stay unsorted."""
    return frame.orderBy(F.desc("date"), "environment_type", "cto")


def add_missing_environments(trend: DataFrame, defaults: DataFrame) -> DataFrame:
    """Append the default rows of every environment the trend does not have."""
    present = trend.select("environment_type").distinct()
    return trend.unionByName(defaults.join(present, "environment_type", "left_anti"))


def env_mean_baseline(trend: DataFrame, prior_factor: float = 0.8) -> DataFrame:
    """Mean daily cost per environment as a constant column, and a fraction of it for the prior year.

    A window over the trend, so what it is made from is computed once. The trend is a roll-up: its
    rows are days and organisations, not facts.
    """
    labelled = trend.selectExpr("date", _ENVIRONMENT, "daily_cost")
    each = "over (partition by environment_type)"
    mean = f"double(sum(cast(daily_cost as decimal(18,2))) {each}) / count(daily_cost) {each}"
    return labelled.selectExpr("*", f"{mean} as current_avg_daily_spend").selectExpr(
        "date",
        "environment_type",
        "daily_cost",
        "current_avg_daily_spend",
        f"current_avg_daily_spend * {prior_factor}D as prior_avg_daily_spend",
    )


def _segment(dates: ReportDates) -> str:
    return f"if(date <= date'{dates.cutoff}', 'Actual', 'Forecast') as segment"


def actual_forecast_split(frame: DataFrame, dates: ReportDates) -> DataFrame:
    """Mark days up to the cut-off as actual, later ones as forecast."""
    return frame.selectExpr("*", _segment(dates))


def trend_series(
    averages: DataFrame, series: Sequence[Series], dates: ReportDates, span: DateRange | None = None
) -> DataFrame:
    """Long table (series, segment, date, organisation, value) of the configured lines, in one pass.

    Days of the fiscal year are shown unless another range is given; those after the cut-off are
    the forecast segment.
    """

    def point(line: Series) -> Column:
        value = F.expr(f"{or_zero(f'double({line.column})')} as value")
        both = F.struct(F.lit(line.name).alias("series"), value)
        if line.environment is None:
            return both
        return F.when(F.upper("environment_type") == F.upper(F.lit(line.environment)), both)

    points = F.explode(F.array_compact(F.array(*map(point, series)))).alias("point")
    shown = between_dates(averages, span or dates.fiscal_year.range)
    return shown.select("date", "cto", points).selectExpr(
        "point.series", _segment(dates), "date", "cto", "point.value"
    )


def forecast_band(averages: DataFrame, dates: ReportDates, width: float = 0.1) -> DataFrame:
    """Forecast daily spend with a band of plus and minus ``width`` around it."""
    forecast = dates.average_columns["forecast"]
    return with_forecast(averages, forecast).selectExpr(
        "date",
        "environment_type",
        "cto",
        "daily_cost",
        f"{forecast} as forecast",
        f"{forecast} * {1 - width}D as forecast_low",
        f"{forecast} * {1 + width}D as forecast_high",
    )
