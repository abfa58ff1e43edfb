"""The scorecard for every choice of organisation, pillar and product at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.environment import NON_PROD, PROD, classify_environment
from tallyfold.functions.money import sum_where
from tallyfold.operators.periods import scorecard_figures
from tallyfold.plans.dates import ReportDates, within

KEYS = {"cto": "cto", "tr_product_pillar_team": "pillar", "tr_product_id": "product"}


def costs_by_choice(facts: DataFrame, dates: ReportDates) -> DataFrame:
    """Exact sums per organisation, pillar and product for both environments over the scorecard's periods.

    One row per product of an organisation, however many facts there are.
    """
    spans = {"ytd": dates.ytd, "fy": dates.fiscal_year.range, "prior": dates.prior_ytd}
    kept = facts.filter(within(spans.values())).withColumn("environment_type", F.expr(classify_environment()))
    classes = {"prod": PROD, "nonprod": NON_PROD}
    sums = [
        F.expr(f"{sum_where(span.contains() + f" and environment_type = '{environment}'")} as {name}_{period}")
        for period, span in spans.items()
        for name, environment in classes.items()
    ]
    return kept.groupBy(*KEYS).agg(*sums)


def scorecards(facts: DataFrame, dates: ReportDates) -> DataFrame:
    """Scorecard of all facts and of each value of each subset of the three filters.

    ``chosen_by`` names the filters that are set, comma-joined (empty: none); a filter that is not
    set is NULL in its column. Facts with a NULL in a key count where that key is not set, as no
    filter can choose them. The facts are scanned once and reduced to one row per product; the eight
    grouping sets multiply those rows only.
    """
    grain = costs_by_choice(facts, dates)
    sums = [name for name in grain.columns if name not in KEYS]
    added = grain.cube(*KEYS).agg(*[F.expr(f"sum({name}) as {name}") for name in sums], F.expr("grouping_id() as unset"))
    # The first key is the highest bit; a bit is set where the key is summed over.
    bits = {key: 1 << (len(KEYS) - 1 - place) for place, key in enumerate(KEYS)}
    for key, bit in bits.items():
        added = added.filter(f"unset & {bit} > 0 or {key} is not null")
    named = ", ".join(f"if(unset & {bit} > 0, null, '{KEYS[key]}')" for key, bit in bits.items())
    amounts = [f"coalesce(double({name}), 0D) as {name}" for name in sums]
    flat = added.selectExpr(f"concat_ws(',', {named}) as chosen_by", *[f"{key} as {name}" for key, name in KEYS.items()], *amounts)
    return scorecard_figures(flat, "chosen_by", *KEYS.values())
