"""Numbers of distinct products from mergeable sketches, for any span without a scan of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.filters import NO_FILTER, CostFilter, between_dates, filter_facts
from tallyfold.plans.dates import DateRange

PRECISION = 12  # 2^12 registers: relative standard error 1.04 / 64 = 1.6 %


def product_sketches(facts: DataFrame, chosen: CostFilter = NO_FILTER, precision: int = PRECISION) -> DataFrame:
    """One HyperLogLog sketch of product ids per day and pillar, at most 2^``precision`` bytes and a few more.

    Sketches are merged before the shuffle, so a pillar with most of the facts sends one sketch a
    task and day. Keep them in a table by day: spans are counted from it.
    """
    kept = filter_facts(facts, chosen).groupBy("date", "tr_product_pillar_team")
    return kept.agg(F.expr(f"hll_sketch_agg(tr_product_id, {precision}) as products"))


def product_counts(sketches: DataFrame, span: DateRange) -> DataFrame:
    """Approximate number of distinct products per pillar over a span.

    Small numbers (some hundreds of products at the default precision) are told apart by 26-bit
    hashes and as good as exact; beyond them the error is that of the precision.
    """
    held = between_dates(sketches, span).groupBy("tr_product_pillar_team")
    counted = held.agg(F.expr("hll_sketch_estimate(hll_union_agg(products)) as product_count"))
    return counted.selectExpr("tr_product_pillar_team as pillar_name", "product_count")


def product_counts_by_month(sketches: DataFrame) -> DataFrame:
    """Approximate number of distinct products per month and pillar, with that of the month and the two before it."""
    month = F.expr("trunc(date, 'MM') as month")
    months = sketches.groupBy(month, "tr_product_pillar_team").agg(F.expr("hll_union_agg(products) as products"))
    # A month counts for itself and the two after it; months after the last one with facts have no row.
    spread = months.selectExpr("*", "explode(sequence(month, add_months(month, 2), interval 1 month)) as until")
    grouped = spread.groupBy("until", "tr_product_pillar_team").agg(
        F.expr("max(if(month = until, hll_sketch_estimate(products), null)) as month_products"),
        F.expr("hll_sketch_estimate(hll_union_agg(products)) as quarter_products"),
    )
    held = grouped.filter("month_products is not null")
    return held.selectExpr("until as month", "tr_product_pillar_team as pillar_name", "month_products", "quarter_products")
