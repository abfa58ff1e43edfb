"""Actual cost against budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def budget_variance(actuals: DataFrame, budgets: DataFrame, fiscal_year: str) -> DataFrame:
    """Variance per environment for one fiscal year's budget: amount, percent, over or under.

    ``actuals`` has (environment_type, total_cost). Budget rows of an environment are added up. An
    environment without cost shows an actual of zero; one without a budget shows a budget of zero,
    no percentage, and is over budget as soon as it costs anything.
    """
    budget = (
        budgets.filter(F.col("fiscal_year") == F.lit(fiscal_year))
        .groupBy("environment_type")
        .agg(F.expr("double(sum(budget_amount)) as budget_amount"))
    )
    joined = budget.join(actuals, "environment_type", "full_outer").selectExpr(
        "environment_type", "coalesce(budget_amount, 0D) as budget_amount", "coalesce(total_cost, 0D) as actual_cost"
    )
    varied = joined.selectExpr("*", "actual_cost - budget_amount as variance_amount")
    return varied.selectExpr(
        "*",
        "variance_amount / nullif(budget_amount, 0D) * 100 as variance_percent",
        "case sign(variance_amount) when 1 then 'over' when -1 then 'under' else 'on budget' end as budget_status",
    )
