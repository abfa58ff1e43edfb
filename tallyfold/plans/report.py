"""The cost report: every section from two small stored roll-ups of the facts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators import breakdowns, daily, periods, trend
from tallyfold.operators.filters import NO_FILTER, CostFilter, between_dates, filter_facts, nonprod_over
from tallyfold.plans.dates import ReportDates, within
from tallyfold.sources.shared import stored

def costs_per_day(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Exact cost per day, environment label and organisation, for all periods of the report.

    It has the columns of facts that period and trend operators read, which find the same sums.
    """
    spans = [dates.average_span, *(span for pair in dates.comparisons for span in (pair.current, pair.previous))]
    kept = filter_facts(facts, chosen).filter(within(spans))
    return kept.groupBy("date", "environment", "cto").agg(F.expr("sum(cost) as cost"))


def costs_per_product(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Exact year-to-date cost per environment label, organisation, pillar and product, dated at its end."""
    keys = ["environment", "cto", "tr_product_pillar_team", "tr_product_id", "tr_product"]
    summed = between_dates(filter_facts(facts, chosen), dates.ytd).groupBy(*keys).agg(F.expr("sum(cost) as cost"))
    return summed.withColumn("date", F.lit(dates.ytd.end))


def _shares(table: DataFrame, threshold: float, *keys: str) -> DataFrame:
    """Bars of a breakdown table: both environments in percent, and a mark above the threshold."""
    bars = nonprod_over(breakdowns.stacked_share(table), threshold)
    return bars.select(*keys, "prod_share", "nonprod_share", F.expr("int(over_threshold) as over_threshold"))


def cost_report(
    facts: DataFrame,
    dates: ReportDates,
    top_n: int,
    chosen: CostFilter = NO_FILTER,
    threshold: float = 30.0,
    listed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All sections by name. The facts are scanned once per grain: days, products, filter lists.

    Both roll-ups, the averages and the top products are stored in the shared folder, since several
    sections read them; nothing removes them there, so clean that folder by age. Filter lists come
    from all facts given, whatever the filter and the period, so ``facts`` should not be cut; ``listed``
    gives them where ``facts`` is a roll-up of some years (see ``incremental``).
    """
    days = stored(costs_per_day(facts, dates, chosen), "report-days")
    per_product = stored(costs_per_product(facts, dates, chosen), "report-products")
    averages = stored(daily.daily_average_table(days, dates), "report-averages")
    top_products = stored(breakdowns.product_costs(per_product, dates, top_n), "report-top-products")
    products = breakdowns.breakdown_table_product(top_products)
    organisations = breakdowns.breakdown_table_cto(breakdowns.cto_costs(days, dates, top_n))
    pillars = breakdowns.breakdown_table_pillar(breakdowns.pillar_costs(per_product, dates, top_n))
    return {
        "scorecard": periods.scorecard(days, dates),
        "comparisons": periods.percent_change_comparison(days, dates),
        "period_matrix": periods.period_matrix(days, dates),
        "products": products,
        "organisations": organisations,
        "pillars": pillars,
        "product_shares": _shares(products, threshold, "product_id", "product_name", "pillar_team"),
        "organisation_shares": _shares(organisations, threshold, "cto_org"),
        "pillar_shares": _shares(pillars, threshold, "pillar_name"),
        "pillar_to_cto": breakdowns.pillar_to_cto(top_products),
        "daily_trend": trend.daily_trend_by_env(trend.daily_trend(averages, dates)),
        "trend_series": trend.trend_series(averages, trend.default_series(dates), dates),
        "filter_values": breakdowns.filter_value_lists(facts if listed is None else listed),
    }


def _is_amount(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _long_section(name: str, section: DataFrame) -> DataFrame:
    """Rows of one section as (section, item, metric, value); a section without amounts counts its items."""
    amounts = [field.name for field in section.schema.fields if _is_amount(field)]
    keys = [column for column in section.columns if column not in amounts]
    texts = "".join(f", coalesce(cast({key} as string), '')" for key in keys)
    values = {column: column for column in amounts} or {"present": "1"}
    metrics = [f"struct('{metric}' as metric, double({value}) as value)" for metric, value in values.items()]
    return section.selectExpr(
        f"'{name}' as section", f"concat_ws('|'{texts}) as item", f"inline(array({', '.join(metrics)}))"
    )


def long_form(sections: Mapping[str, DataFrame]) -> DataFrame:
    """All sections in one table (section, item, metric, value)."""
    return reduce(DataFrame.unionByName, [_long_section(name, section) for name, section in sections.items()])
