"""Row filters on facts and on results."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.plans.dates import DateRange, ReportDates

COMBINATION = ["cto", "tr_product_pillar_team", "tr_product_id"]


@dataclass(frozen=True)
class CostFilter:
    """Organisation, pillar and product to keep; None or empty text keeps all."""

    cto: str | None = None
    pillar: str | None = None
    product: str | None = None

    def or_default(self, default: CostFilter) -> CostFilter:
        """A requested value wins, else the configured default."""
        return CostFilter(
            self.cto or default.cto, self.pillar or default.pillar, self.product or default.product
        )

    @property
    def by_column(self) -> dict[str, str]:
        """Chosen value per fact column."""
        chosen = dict(zip(COMBINATION, (self.cto, self.pillar, self.product)))
        return {column: value for column, value in chosen.items() if value}


NO_FILTER = CostFilter()


def filter_facts(facts: DataFrame, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Keep the facts of the chosen organisation, pillar and product."""
    for column, value in chosen.by_column.items():
        facts = facts.filter(F.col(column) == F.lit(value))
    return facts


def combination_exists(facts: DataFrame, chosen: CostFilter) -> DataFrame:
    """One row: does any fact match all chosen values?"""
    return filter_facts(facts, chosen).selectExpr("count(*) > 0 as combination_exists")


def existing_combinations(requested: DataFrame, facts: DataFrame) -> DataFrame:
    """Requested (organisation, pillar, product) rows that occur in the facts.

    Facts are reduced to their distinct combinations before the semi join, so a
    combination that holds most of the rows is one row by the time of the shuffle.
    """
    known = facts.select(COMBINATION).distinct()
    return requested.join(known, COMBINATION, "left_semi")


def between_dates(frame: DataFrame, span: DateRange, day: str = "date") -> DataFrame:
    return frame.filter(span.contains(day))


def on_dates(frame: DataFrame, days: Iterable[date], column: str = "date") -> DataFrame:
    return frame.filter(F.col(column).isin([F.lit(day) for day in days]))


def complete_days(frame: DataFrame, dates: ReportDates, day: str = "date") -> DataFrame:
    """Drop the last days, whose costs are still coming in."""
    return frame.filter(f"{day} <= date'{dates.cutoff}'")


def matching_text(frame: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose text equals the value in any case."""
    return frame.filter(F.upper(column) == F.upper(F.lit(value)))


def nonprod_over(frame: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Flag rows whose non-production share lies above the threshold."""
    return frame.selectExpr("*", f"coalesce(nonprod_percentage > {threshold}D, false) as over_threshold")


def with_forecast(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(f"{column} is not null")
