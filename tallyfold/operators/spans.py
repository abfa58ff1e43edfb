"""Costs over any list of named, overlapping spans, in one pass over the facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.functions.environment import CLASSES
from tallyfold.operators.filters import NO_FILTER, CostFilter
from tallyfold.operators.periods import daily_environment_costs
from tallyfold.plans.dates import DateRange


def spans_table(spark: SparkSession, spans: Iterable[tuple[str, DateRange]]) -> DataFrame:
    """Rows (name, start, end) of named ranges."""
    return spark.createDataFrame([(name, span.start, span.end) for name, span in spans], "name string, start date, end date")


def _pieces(spans: DataFrame) -> DataFrame:
    """Each span as whole months and the single days left at its ends: (name, unit, start of the unit)."""
    # A span that ends before it starts has no month; sequence() would count downwards.
    held = spans.filter("start <= end").selectExpr("name", "start", "end", "explode(sequence(trunc(start, 'MM'), end, interval 1 month)) as month")
    whole = "month >= start and last_day(month) <= end"
    days = "transform(sequence(greatest(month, start), least(last_day(month), end)), d -> struct('day' as unit, d as at))"
    return held.selectExpr("name", f"inline(if({whole}, array(struct('month' as unit, month as at)), {days}))")


def span_costs(facts: DataFrame, spans: DataFrame, within: DateRange, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Cost per named span and environment class; a pair without facts costs zero.

    The facts become one sum per day and environment, and one per month, before they meet the spans.
    Spans are taken apart into whole months and single days, at most 62 and one per month, so the
    join is on equality and grows with the number of spans, not with their days times the facts.
    ``within`` is what the scan reads and must cover all spans. Spans with equal names are one.
    """
    daily = daily_environment_costs(facts, [within], chosen)
    units = "inline(array(struct('day' as unit, date as at), struct('month' as unit, trunc(date, 'MM') as at)))"
    grain = daily.selectExpr("environment_type", "cost", units).groupBy("unit", "at", "environment_type")
    sums = grain.agg({"cost": "sum"}).withColumnRenamed("sum(cost)", "cost")
    booked = _pieces(spans).join(sums, ["unit", "at"]).select("name", "environment_type", "cost")
    classes = ", ".join(f"'{name}'" for name in CLASSES)
    every = spans.selectExpr("name", f"explode(array({classes})) as environment_type", "null as cost")
    total = booked.unionByName(every).groupBy("name", "environment_type").agg({"cost": "sum"})
    return total.selectExpr("name", "environment_type", "coalesce(double(`sum(cost)`), 0D) as cost")
