"""Year-to-date cost per organisation, pillar and product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.money import (
    environment_amounts,
    or_zero,
    run_rate_forecast,
    safe_ratio,
    share_percent,
    sum_where,
    total_or_parts,
)
from tallyfold.operators.filters import NO_FILTER, CostFilter, between_dates, filter_facts
from tallyfold.plans.dates import ReportDates

AMOUNTS = ["prod_ytd_cost", "nonprod_ytd_cost", "total_ytd_cost"]
PRODUCT_KEYS = ["display_id", "product_name", "pillar_team", "product_id", "cto_org"]

# Fact columns a breakdown groups by, under their report names.
_GROUPINGS = {
    "cto": {"cto_org": "cto"},
    "pillar": {"pillar_name": "tr_product_pillar_team"},
    "product": {
        "product_name": "tr_product",
        "pillar_team": "tr_product_pillar_team",
        "product_id": "tr_product_id",
        "cto_org": "cto",
    },
}

# Production and non-production by their exact labels; other labels count only in the total.
_SUMS = {
    "prod_ytd_cost": sum_where("environment = 'PROD'"),
    "nonprod_ytd_cost": sum_where("environment = 'NON-PROD'"),
    "total_ytd_cost": "sum(cost)",
}
_NONPROD_SHARE = share_percent("nonprod_ytd_cost", "total_ytd_cost")


def product_display_id(pillar: str = "tr_product_pillar_team", product: str = "tr_product_id") -> str:
    """``pillar - product``; NULL if either is NULL."""
    return f"concat({pillar}, ' - ', {product})"


def _ytd(facts: DataFrame, dates: ReportDates, chosen: CostFilter) -> DataFrame:
    return between_dates(filter_facts(facts, chosen), dates.ytd)


def env_pivot_sums(
    facts: DataFrame,
    dates: ReportDates,
    by: str = "cto",
    chosen: CostFilter = NO_FILTER,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Environment rows turned into production, non-production and total columns per group."""
    keys = [F.expr(f"{column} as {name}") for name, column in _GROUPINGS[by].items()]
    others = [F.expr(f"{value} as {name}") for name, value in (extra or {}).items()]
    sums = [F.expr(f"double({value}) as {name}") for name, value in _SUMS.items()]
    return _ytd(facts, dates, chosen).groupBy(*keys).agg(*others, *sums)


def _forecast(dates: ReportDates) -> str:
    return f"{run_rate_forecast('total_ytd_cost', dates.run_rate_days)} as forecasted_cost"


def all_cto_costs(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    share = safe_ratio("nonprod_ytd_cost", "total_ytd_cost")
    return env_pivot_sums(facts, dates, "cto", chosen).selectExpr(
        "*", _forecast(dates), f"{share} * 100 as nonprod_percentage"
    )


def cto_costs(facts: DataFrame, dates: ReportDates, top_n: int, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Organisations with the highest total cost."""
    return top(all_cto_costs(facts, dates, chosen), "total_ytd_cost", top_n, "cto_org")


def all_pillar_costs(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Every pillar, with its number of products.

    The distinct count is planned on (pillar, product) first, so a pillar that holds most
    of the facts is spread over its products.
    """
    counted = env_pivot_sums(facts, dates, "pillar", chosen, {"product_count": "count(distinct tr_product_id)"})
    return counted.selectExpr("*", _forecast(dates))


def with_nonprod_cost(groups: DataFrame) -> DataFrame:
    """Groups with some non-production cost."""
    return groups.filter("nonprod_ytd_cost > 0")


def pillar_costs(facts: DataFrame, dates: ReportDates, top_n: int, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Pillars with the highest non-production cost."""
    return top(with_nonprod_cost(all_pillar_costs(facts, dates, chosen)), "nonprod_ytd_cost", top_n, "pillar_name")


def all_product_costs(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Every product of a pillar and organisation; the display id follows from the other keys."""
    return env_pivot_sums(facts, dates, "product", chosen).selectExpr(
        f"{product_display_id('pillar_team', 'product_id')} as display_id",
        *PRODUCT_KEYS[1:],
        *AMOUNTS,
        _forecast(dates),
    )


def product_costs(facts: DataFrame, dates: ReportDates, top_n: int, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Products with the highest production cost."""
    return top(all_product_costs(facts, dates, chosen), "prod_ytd_cost", top_n, *PRODUCT_KEYS)


def top(frame: DataFrame, amount: str, n: int, *tie_keys: str) -> DataFrame:
    """The n rows with the largest amount; equal amounts in key order, NULL amounts last."""
    order = [F.col(amount).desc_nulls_last(), *[F.col(key).asc_nulls_first() for key in tie_keys]]
    return frame.orderBy(*order).limit(n)


def chart_order(frame: DataFrame, key: str, limit: int, amount: str = "total_ytd_cost") -> DataFrame:
    """The ``limit`` largest rows of a bar chart, numbered from the smallest bar up.

    Only these ``limit`` rows reach the single task that numbers them.
    """
    smallest_first = Window.orderBy(F.col(amount).asc_nulls_first(), F.col(key).desc_nulls_last())
    return top(frame, amount, limit, key).withColumn("rank", F.row_number().over(smallest_first))


def with_environment_columns(rows: DataFrame) -> DataFrame:
    """Production and non-production columns for rows of one environment label each."""
    amounts = environment_amounts("environment", "total_ytd_cost")
    missing = [f"{value} as {name}" for name, value in amounts.items() if name not in rows.columns]
    return rows.selectExpr("*", *missing)


def top_rows_then_rollup(rows: DataFrame, top_n: int) -> DataFrame:
    """Take the n largest (product, environment) rows, then one row per product among them."""
    largest = top(with_environment_columns(rows), "total_ytd_cost", top_n, "product_name", "environment")
    sums = {
        "prod_ytd_cost": sum_where("environment = 'PROD'", "prod_ytd_cost"),
        "nonprod_ytd_cost": sum_where("environment = 'NON-PROD'", "nonprod_ytd_cost"),
        "total_ytd_cost": "sum(total_ytd_cost)",
    }
    products = largest.groupBy("product_name").agg(
        *[F.expr(f"double({value}) as {name}") for name, value in sums.items()]
    )
    return products.selectExpr("*", f"{_NONPROD_SHARE} as nonprod_percentage")


def product_environment_rows(facts: DataFrame, dates: ReportDates, chosen: CostFilter = NO_FILTER) -> DataFrame:
    """Year-to-date total per product name and environment label, kept exact."""
    grouped = _ytd(facts, dates, chosen).groupBy(F.expr("tr_product as product_name"), "environment")
    return grouped.agg(F.expr("sum(cost) as total_ytd_cost"))


def stacked_share(breakdown: DataFrame) -> DataFrame:
    """Each environment's part of production plus non-production, in percent to one decimal."""

    def share(part: str) -> str:
        return or_zero(f"round({part} / nullif(prod_ytd_cost + nonprod_ytd_cost, 0D) * 100, 1)")

    return breakdown.selectExpr(
        "*", f"{share('prod_ytd_cost')} as prod_share", f"{share('nonprod_ytd_cost')} as nonprod_share"
    )


def fill_missing_costs(frame: DataFrame) -> DataFrame:
    """Missing costs become zero; a zero total becomes the sum of its parts."""
    prod, nonprod, total = (or_zero(name) for name in AMOUNTS)
    filled = {"prod_ytd_cost": prod, "nonprod_ytd_cost": nonprod, "total_ytd_cost": total_or_parts(total, prod, nonprod)}
    return frame.selectExpr(*[f"{filled.get(name, name)} as {name}" for name in frame.columns])


def breakdown_table_product(products: DataFrame) -> DataFrame:
    """Product rows as the report shows them, under their display ids."""
    return fill_missing_costs(products).selectExpr(
        "display_id as product_id",
        "product_name",
        "pillar_team",
        *AMOUNTS,
        "forecasted_cost",
        f"{_NONPROD_SHARE} as nonprod_percentage",
    )


def breakdown_table_pillar(pillars: DataFrame) -> DataFrame:
    return fill_missing_costs(pillars).selectExpr(
        "pillar_name", "product_count", *AMOUNTS, "forecasted_cost", f"{_NONPROD_SHARE} as nonprod_percentage"
    )


def breakdown_table_cto(organisations: DataFrame) -> DataFrame:
    return organisations.selectExpr(
        "cto_org",
        *[f"{or_zero(name)} as {name}" for name in AMOUNTS],
        "forecasted_cost",
        f"{or_zero('nonprod_percentage')} as nonprod_percentage",
    )


def pillar_to_cto(products: DataFrame) -> DataFrame:
    """One organisation per pillar: that of its last product in a top-n product list."""
    place = f"struct(coalesce(-prod_ytd_cost, double('infinity')), {', '.join(PRODUCT_KEYS)})"
    return products.groupBy("pillar_team").agg(F.expr(f"max_by(cto_org, {place}) as cto_org"))


def filter_value_lists(facts: DataFrame) -> DataFrame:
    """Every organisation, pillar and product a report can be filtered by, from one scan.

    The facts are reduced to distinct combinations first; the three lists are cut from those.
    """
    combinations = facts.select("cto", "tr_product_pillar_team", "tr_product_id", "tr_product").distinct()
    none = "cast(null as string)"
    entries = [
        ("cto", "cto", none, none, "cto"),
        ("pillar", "tr_product_pillar_team", none, none, "tr_product_pillar_team"),
        ("product", "tr_product_id", "tr_product", "tr_product_pillar_team", product_display_id()),
    ]
    rows = [
        f"struct('{kind}' as list_name, {value} as value, {name} as product_name,"
        f" {pillar} as pillar_team, {display} as display)"
        for kind, value, name, pillar, display in entries
    ]
    listed = combinations.selectExpr(f"inline(array({', '.join(rows)}))").filter("value is not null").distinct()
    return listed.orderBy("list_name", "display", "product_name")
