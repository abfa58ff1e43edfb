"""Registered queries: each reads the driver's tables through the star-schema view of cost facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import fiscal, money, seasonal
from tallyfold.functions.environment import classify_environment
from tallyfold.operators import breakdowns, budget, daily, filters, grid, periods, sketches, spans, subsets, trend
from tallyfold.operators.filters import CostFilter
from tallyfold.plans import incremental, report, stored_averages
from tallyfold.plans.dates import DateRange, ReportDates
from tallyfold.schemas import COST_FACTS, COST_FACTS_FLOAT, daily_average_fields, struct_of
from tallyfold.sources import delimited, named, shared, tables
from tallyfold.sources.star import star_facts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of every registered query; the oracle texts use the same values.
DATES = ReportDates(as_of=date(1998, 8, 6))
TOP_N = 10
THRESHOLD = 30.0
MODEL_START = DATES.prior_year.start
ORGANISATION, PILLAR, PRODUCT = "ASIA", "PROMO", "P17"
CHOSEN = CostFilter(ORGANISATION, PILLAR)
CHOSEN_PRODUCT = CostFilter(ORGANISATION, PILLAR, "P177")
GRID_ENVIRONMENTS = ("PROD", "NON-PROD")
GRID_CLOUDS = ("A", "N", "R")

_YTD = [DATES.ytd]
_SUMMARY = [DATES.ytd, DATES.fiscal_year.range, DATES.prior_ytd]
_AVERAGES = [DATES.average_span]
_PERIODS = [DATES.prior_year.range, DATES.fiscal_year.range]

_REGISTRY: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _as_float(facts: DataFrame) -> DataFrame:
    return facts.withColumn("cost", F.expr("double(cost)"))


def _by_environment(spark: SparkSession, folder: str, spans: list[DateRange]) -> DataFrame:
    return star_facts(spark, folder, "date", "environment", "cost", spans=spans)


def _of_chosen(spark: SparkSession, folder: str, *columns: str, spans: list[DateRange]) -> DataFrame:
    """Facts of one organisation and pillar."""
    wanted = dict.fromkeys([*columns, "cto", "tr_product_pillar_team"])
    return filters.filter_facts(star_facts(spark, folder, *wanted, spans=spans), CHOSEN)


def _by_cto(spark: SparkSession, folder: str, spans: list[DateRange] = _YTD) -> DataFrame:
    return star_facts(spark, folder, "date", "environment", "cost", "cto", spans=spans)


def _by_pillar(spark: SparkSession, folder: str) -> DataFrame:
    return star_facts(
        spark, folder, "date", "environment", "cost", "tr_product_pillar_team", "tr_product_id", spans=_YTD
    )


_PRODUCT_COLUMNS = ("date", "environment", "cost", "cto", "tr_product_pillar_team", "tr_product_id", "tr_product")


def _by_product(spark: SparkSession, folder: str, spans: list[DateRange] = _YTD) -> DataFrame:
    return star_facts(spark, folder, *_PRODUCT_COLUMNS, spans=spans)


def _averages(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_average_table(_by_cto(spark, folder, _AVERAGES), DATES)


# --- sources and sinks -------------------------------------------------------------------------


@_query
def scan_cost_facts(spark, folder):
    return _as_float(tables.conform_to_schema(star_facts(spark, folder), COST_FACTS))


@_query
def scan_daily_averages(spark, folder):
    path = shared.new_folder(spark, "daily-averages")
    tables.replace_table(_averages(spark, folder), path)
    return tables.read_table(spark, path, struct_of(daily_average_fields(DATES.average_columns.values())))


@_query
def conform_to_schema(spark, folder):
    facts = star_facts(spark, folder)
    texts = facts.selectExpr(*[f"string({name}) as {name}" for name in facts.columns])
    return tables.conform_to_schema(texts, COST_FACTS_FLOAT)


@_query
def csv_load_declared(spark, folder):
    path = shared.new_folder(spark, "facts-csv")
    delimited.csv_write(star_facts(spark, folder), path, header=False)
    return delimited.csv_load_declared(spark, path, COST_FACTS_FLOAT)


@_query
def csv_load_inferred(spark, folder):
    path = shared.new_folder(spark, "facts-csv")
    delimited.csv_write(star_facts(spark, folder), path, header=False)
    loaded = delimited.csv_load_inferred(spark, path, COST_FACTS.names)
    return tables.conform_to_schema(loaded, COST_FACTS_FLOAT)


@_query
def csv_load_table(spark, folder):
    """A file that does not fit: costs of one cloud are no numbers, and ids start with zeros."""
    path = shared.new_folder(spark, "facts-csv")
    odd = {"tr_product_id": "concat('00', substr(tr_product_id, 2))", "cost": "if(cloud = 'N', 'n/a', string(cost))"}
    delimited.csv_write(star_facts(spark, folder).withColumns({name: F.expr(text) for name, text in odd.items()}), path, header=False)
    loaded = delimited.csv_load_table(spark, path, COST_FACTS, shared.new_folder(spark, "facts"))
    return loaded.withColumns({"known": F.expr("not (cost <=> 'n/a')"), "cost": F.expr("try_cast(cost as double)")})


@_query
def csv_load_rejects(spark, folder):
    """A file in which the costs of one product are no numbers: few enough to stay rejects."""
    path, target = shared.new_folder(spark, "facts-csv"), shared.new_folder(spark, "facts")
    odd = f"if(tr_product_id <=> '{PRODUCT}', 'n/a', string(cost))"
    delimited.csv_write(star_facts(spark, folder).withColumn("cost", F.expr(odd)), path, header=False)
    loaded = delimited.csv_load_table(spark, path, COST_FACTS, target, tolerance=0.2)
    kept = loaded.selectExpr("'row' as kind", "string(null) as reason", "tr_product_pillar_team", "cost")
    left = delimited.read_rejects(spark, target).selectExpr(
        "'reject' as kind",
        "reject_reason as reason",
        f"from_csv(reject_record, '{', '.join(f'`{name}` string' for name in COST_FACTS.names)}').tr_product_pillar_team as tr_product_pillar_team",
        "cast(null as decimal(18, 4)) as cost",
    )
    return _count_and_cost(kept.unionByName(left), "kind", "reason", "tr_product_pillar_team")


@_query
def reconcile_load(spark, folder):
    """Days that differ after a load in which one organisation's costs were exchanged for others."""
    facts = star_facts(spark, folder)
    loaded = tables.replace_table(facts, shared.new_folder(spark, "facts"))
    changed = loaded.withColumn("cost", F.expr(f"cast(if(cto <=> '{ORGANISATION}' and tr_product_id <=> '{PRODUCT}', cost + 1, cost) as decimal(18, 4))"))
    return tables.reconciled(changed, tables.conform_to_schema(facts, COST_FACTS))


@_query
def csv_write(spark, folder):
    facts = star_facts(spark, folder)
    plain, headed = shared.new_folder(spark, "facts-plain"), shared.new_folder(spark, "facts-headed")
    delimited.csv_write(facts, plain, header=False)
    delimited.csv_write(facts, headed, header=True)
    read = [
        delimited.csv_load_declared(spark, path, COST_FACTS, header=header).withColumn("header", F.lit(header))
        for path, header in ((plain, False), (headed, True))
    ]
    both = read[0].unionByName(read[1])
    return _count_and_cost(both, "header", "date", "cloud")


@_query
def replace_table(spark, folder):
    path = shared.new_folder(spark, "facts")
    tables.replace_table(star_facts(spark, folder, spans=[DATES.prior_year.range]), path)
    return _as_float(tables.replace_table(star_facts(spark, folder), path, partition="month"))


@_query
def verify_row_count(spark, folder):
    facts = star_facts(spark, folder)  # all columns, so that every join of the view is verified
    loaded = tables.replace_table(facts, shared.new_folder(spark, "facts"))
    return tables.verify_row_count(loaded, spark.read.parquet(f"{folder}/lineitem.parquet"))


@_query
def create_daily_average_view(spark, folder):
    return tables.publish_view(_averages(spark, folder), "daily_average_view")


@_query
def union_sources(spark, folder):
    facts = star_facts(spark, folder)
    sources = [
        facts.filter("cloud = 'A'"),
        facts.filter("cloud = 'N'").drop("tr_subpillar_name"),
        facts.filter("cloud is null or cloud not in ('A', 'N')").withColumn("cost", F.expr("string(cost)")),
    ]
    return _as_float(tables.union_sources(sources))


def _grid(spark: SparkSession, folder: str) -> DataFrame:
    dimensions = star_facts(spark, folder, "tr_product_pillar_team", "tr_subpillar_name").distinct()
    span = DateRange(DATES.prior_year.start, DATES.cutoff)
    return grid.calendar_dimension_grid(dimensions, span, GRID_ENVIRONMENTS, GRID_CLOUDS)


GRID_KEYS = ["date", "tr_product_pillar_team", "tr_subpillar_name", "environment", "cloud"]


@_query
def grid_sample(spark, folder):
    return grid.grid_sample(_grid(spark, folder), GRID_KEYS)


def _stored_sections(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return report.cost_report(star_facts(spark, folder, *_PRODUCT_COLUMNS), DATES, TOP_N, threshold=THRESHOLD)


@_query
def write_report_tables(spark, folder):
    written = tables.write_sections(_stored_sections(spark, folder), shared.new_folder(spark, "report"))
    return report.long_form(written)


@_query
def incremental_report(spark, folder):
    """Two weeks after a first roll-up that lacked the costs of one cloud in one month, the report from the refreshed one."""
    facts, root = star_facts(spark, folder, *_PRODUCT_COLUMNS, "cloud"), shared.new_folder(spark, "daily-roll-up")
    before = replace(DATES, as_of=DATES.as_of - timedelta(14))
    late = DateRange(date(1998, 3, 1), date(1998, 3, 31))
    known = facts.filter(f"not (cloud <=> 'N' and {late.contains()}) and date <= date'{before.as_of}'")
    incremental.refresh(known, root, before)
    incremental.refresh(facts, root, DATES, [late])
    rolled = incremental.rolled_up(spark, root)
    return report.long_form(report.cost_report(rolled, DATES, TOP_N, threshold=THRESHOLD, listed=facts))


@_query
def stored_daily_averages(spark, folder):
    """The stored table after a refresh that finds that the costs of one environment were missing in one month."""
    facts, root = _by_cto(spark, folder, _AVERAGES), shared.new_folder(spark, "stored-averages")
    changed = DateRange(date(1998, 3, 1), date(1998, 3, 31))
    known = facts.filter(f"not (environment = 'PROD' and {changed.contains()})")
    stored_averages.refresh_averages(known, root, DATES)
    stored_averages.refresh_averages(facts, root, DATES)
    return stored_averages.read_averages(spark, root, DATES)


@_query
def named_query(spark, folder):
    _by_product(spark, folder).createOrReplaceTempView("named_query_facts")
    return named.named_query(
        spark,
        "cto_costs",
        "named_query_facts",
        fy_start=DATES.fiscal_year.start,
        cutoff=DATES.cutoff,
        top_n=TOP_N,
    )


# --- scalar derivations ------------------------------------------------------------------------


def _count_and_cost(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.groupBy(*keys).agg(F.expr("count(*) as fact_count"), F.expr("double(sum(cost)) as total_cost"))


def _classified(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    facts = star_facts(spark, folder, "environment", "cost")
    labelled = facts.selectExpr("*", f"{classify_environment(mode=mode)} as environment_type")
    return _count_and_cost(labelled, "environment", "environment_type")


@_query
def classify_env_exact(spark, folder):
    return _classified(spark, folder, "exact")


@_query
def classify_env_prefix(spark, folder):
    return _classified(spark, folder, "prefix")


@_query
def classify_env_contains(spark, folder):
    return _classified(spark, folder, "contains")


@_query
def product_display_id(spark, folder):
    facts = star_facts(spark, folder, "tr_product_pillar_team", "tr_product_id")
    return facts.distinct().selectExpr("*", f"{breakdowns.product_display_id()} as display_id")


@_query
def money_labels(spark, folder):
    rows = breakdowns.stacked_share(breakdowns.all_pillar_costs(_by_pillar(spark, folder), DATES))
    amount, share = "prod_ytd_cost", "prod_share"
    return rows.selectExpr(
        "pillar_name",
        f"{money.currency_label(amount)} as currency_label",
        f"{money.bar_label(amount, share)} as bar_label",
        f"{money.bar_label(amount, share, millions=True)} as millions_label",
        f"{money.products_label(amount, 'product_count')} as products_label",
    )


@_query
def scale_to_millions(spark, folder):
    costs = periods.ytd_costs(_by_environment(spark, folder, _YTD), DATES)
    return costs.selectExpr("*", f"{money.to_millions('ytd_cost')} as ytd_cost_millions")


@_query
def change_direction(spark, folder):
    pairs = periods.percent_change_comparison(_by_environment(spark, folder, _PERIODS), DATES)
    changes = pairs.selectExpr("period", "environment_type", "current_cost - previous_cost as change")
    return changes.selectExpr("*", f"{money.change_direction('change')} as direction")


@_query
def coerce_numeric(spark, folder):
    facts = star_facts(spark, folder, "tr_subpillar_name", "tr_product_id", "cost")
    distinct = facts.groupBy("tr_subpillar_name", "tr_product_id").agg(F.expr("string(max(cost)) as cost"))
    return distinct.selectExpr(
        "tr_subpillar_name",
        "tr_product_id",
        f"{money.coerce_numeric('tr_subpillar_name')} as subpillar_number",
        f"{money.coerce_numeric('substring(tr_product_id, 2)')} as product_number",
        f"{money.coerce_numeric('cost')} as cost_number",
    )


def _days(spark: SparkSession, folder: str) -> DataFrame:
    return star_facts(spark, folder, "date").distinct()


@_query
def month_bounds(spark, folder):
    months = _days(spark, folder).selectExpr("date_format(date, 'yyyy-MM') as month").distinct()
    return months.selectExpr(
        "month", f"{fiscal.month_start('month')} as month_start", f"{fiscal.month_end('month')} as month_end"
    )


@_query
def period_labels(spark, folder):
    return _days(spark, folder).selectExpr(
        "date",
        f"{fiscal.month_label('date')} as month_label",
        f"{fiscal.range_label('date_sub(date, 6)', 'date')} as week_label",
    )


@_query
def relative_periods(spark, folder):
    derived = fiscal.relative_periods("date")
    return _days(spark, folder).selectExpr("date", *[f"{value} as {name}" for name, value in derived.items()])


@_query
def report_window(spark, folder):
    derived = fiscal.report_window("date")
    return _days(spark, folder).selectExpr("date", *[f"{value} as {name}" for name, value in derived.items()])


@_query
def fiscal_year_of(spark, folder):
    return _days(spark, folder).selectExpr(
        "date",
        f"{fiscal.fiscal_year('date')} as fiscal_year",
        f"{fiscal.fiscal_year_start('date')} as fiscal_year_start",
        f"{fiscal.fiscal_year_end('date')} as fiscal_year_end",
        f"{fiscal.day_of_fiscal_year('date')} as day_of_fiscal_year",
    )


@_query
def seasonal_cost_model(spark, folder):
    facts = star_facts(spark, folder, "date", "cloud", "cost")
    base = facts.groupBy("date", "cloud").agg(F.expr("double(max(cost)) as base_cost"))
    averages = seasonal.seasonal_daily_averages("base_cost", "date", MODEL_START)
    return base.selectExpr(
        "*",
        f"{seasonal.seasonal_cost('base_cost', 'date', MODEL_START)} as seasonal_cost",
        *[f"{value} as {name}" for name, value in averages.items()],
    )


@_query
def fill_missing_costs(spark, folder):
    facts = _by_product(spark, folder)
    rows = breakdowns.env_pivot_sums(facts, DATES, "product")
    # Absent parts, and a total lost where the product is all non-production.
    thinned = rows.selectExpr(
        "product_name",
        "pillar_team",
        "product_id",
        "cto_org",
        "nullif(prod_ytd_cost, 0D) as prod_ytd_cost",
        "nonprod_ytd_cost",
        "nullif(total_ytd_cost, nonprod_ytd_cost) as total_ytd_cost",
    )
    return breakdowns.fill_missing_costs(thinned)


@_query
def env_columns_from_rows(spark, folder):
    rows = breakdowns.with_environment_columns(_environment_rows(spark, folder))
    return rows.selectExpr("product_name", "environment", *[f"double({name}) as {name}" for name in breakdowns.AMOUNTS])


def _environment_rows(spark: SparkSession, folder: str) -> DataFrame:
    facts = star_facts(spark, folder, "date", "environment", "cost", "tr_product", spans=_YTD)
    return breakdowns.product_environment_rows(facts, DATES)


# --- filters -----------------------------------------------------------------------------------


def _filtered(spark: SparkSession, folder: str, chosen: CostFilter) -> DataFrame:
    facts = star_facts(spark, folder, "date", "environment", "cost", *filters.COMBINATION)
    return _count_and_cost(filters.filter_facts(facts, chosen), "date", "environment", *filters.COMBINATION)


@_query
def filter_cto(spark, folder):
    return _filtered(spark, folder, CostFilter(cto=ORGANISATION))


@_query
def filter_pillar(spark, folder):
    return _filtered(spark, folder, CostFilter(pillar=PILLAR))


@_query
def filter_product(spark, folder):
    return _filtered(spark, folder, CostFilter(product=PRODUCT))


@_query
def filter_combined(spark, folder):
    requested = CostFilter(cto=ORGANISATION, product="")
    return _filtered(spark, folder, requested.or_default(CostFilter(cto="EUROPE", pillar=PILLAR)))


@_query
def filter_combination_exists(spark, folder):
    requested = star_facts(spark, folder, *filters.COMBINATION, spans=[DATES.prior_year.range]).distinct()
    current = star_facts(spark, folder, *filters.COMBINATION, spans=[DATES.fiscal_year.range])
    return filters.existing_combinations(requested, current)


@_query
def date_between(spark, folder):
    span = DATES.fiscal_year.range
    facts = star_facts(spark, folder, "date", "environment", "cost", spans=[span])
    return _count_and_cost(filters.between_dates(facts, span), "date", "environment")


@_query
def date_in(spark, folder):
    pair = DATES.comparisons[0]
    days = [pair.current.start, pair.previous.start]
    facts = star_facts(spark, folder, "date", "environment", "cost", spans=[pair.current, pair.previous])
    return _count_and_cost(filters.on_dates(facts, days), "date", "environment")


@_query
def complete_days_only(spark, folder):
    facts = star_facts(spark, folder, "date", "environment", "cost")
    return _count_and_cost(filters.complete_days(facts, DATES), "date", "environment")


@_query
def env_filter_case_insensitive(spark, folder):
    facts = star_facts(spark, folder, "date", "environment", "cost")
    return _count_and_cost(filters.matching_text(facts, "environment", "non-Prod"), "date", "environment")


@_query
def nonprod_over_threshold(spark, folder):
    products = breakdowns.all_product_costs(_by_product(spark, folder), DATES)
    return filters.nonprod_over(breakdowns.breakdown_table_product(products), THRESHOLD)


@_query
def forecast_not_null(spark, folder):
    name = DATES.average_columns["forecast"]
    facts = _by_cto(spark, folder, _AVERAGES)
    kept = filters.with_forecast(daily.daily_average_table(facts, DATES, how="inner"), name)
    return kept.select("date", "environment_type", "cto", name)


@_query
def null_safe_ratio_guard(spark, folder):
    rows = breakdowns.env_pivot_sums(_by_product(spark, folder), DATES, "product")
    share = money.safe_ratio("nonprod_ytd_cost", "prod_ytd_cost")
    return rows.selectExpr("pillar_team", "product_id", "cto_org", f"{share} as nonprod_to_prod")


# --- joins -------------------------------------------------------------------------------------


@_query
def daily_average_table(spark, folder):
    return _averages(spark, folder)


@_query
def daily_average_table_inner(spark, folder):
    return daily.daily_average_table(_by_cto(spark, folder, _AVERAGES), DATES, how="inner")


@_query
def calendar_dimension_grid(spark, folder):
    return _grid(spark, folder)


@_query
def add_missing_environments(spark, folder):
    prior = daily.daily_costs(_by_cto(spark, folder, [DATES.prior_year.range]), DATES.prior_year.range)
    current = daily.daily_costs(_by_cto(spark, folder), DATES.ytd)
    production_only = current.filter("environment_type = 'PROD'")
    return trend.add_missing_environments(production_only, prior)


@_query
def budget_variance(spark, folder):
    prior = periods.fy_total_costs(
        _by_environment(spark, folder, [DATES.prior_year.range]), DATES, DATES.prior_year
    )
    budgets = prior.selectExpr(
        "environment_type",
        "total_cost * 1.05D as budget_amount",
        f"'{DATES.fiscal_year.number}' as fiscal_year",
    )
    actuals = periods.fy_total_costs(_by_environment(spark, folder, [DATES.fiscal_year.range]), DATES)
    return budget.budget_variance(actuals, budgets, str(DATES.fiscal_year.number))


@_query
def budget_unplanned(spark, folder):
    """One environment has cost without a budget, another a budget without cost."""
    facts = _by_environment(spark, folder, _PERIODS)
    totals = "environment as environment_type", "cost"
    spent = filters.between_dates(facts, DATES.fiscal_year.range).filter("environment <> 'DEV'").selectExpr(*totals)
    planned = filters.between_dates(facts, DATES.prior_year.range).filter("environment <> 'PROD'").selectExpr(*totals)
    spent, planned = (f.groupBy("environment_type").agg(F.expr("double(sum(cost)) as total_cost")) for f in (spent, planned))
    year = str(DATES.fiscal_year.number)
    budgets = planned.selectExpr("environment_type", "total_cost * 1.05D as budget_amount", f"'{year}' as fiscal_year")
    return budget.budget_variance(spent, budgets, year)


@_query
def filtered_scorecard(spark, folder):
    facts = _of_chosen(spark, folder, "date", "environment", "cost", spans=_SUMMARY)
    return periods.scorecard(facts, DATES)


@_query
def filtered_product_costs(spark, folder):
    columns = "date", "environment", "cost", "tr_product_id", "tr_product"
    return breakdowns.product_costs(_of_chosen(spark, folder, *columns, spans=_YTD), DATES, TOP_N)


@_query
def filtered_daily_trend(spark, folder):
    """The daily trend under a pillar, which the daily-average table does not have."""
    return trend.daily_trend_from_facts(_of_chosen(spark, folder, "date", "environment", "cost", spans=_YTD), DATES)


@_query
def prior_year_join(spark, folder):
    return periods.prior_year_join(_by_environment(spark, folder, [DATES.ytd, DATES.prior_ytd]), DATES)


# --- aggregates --------------------------------------------------------------------------------


@_query
def ytd_costs(spark, folder):
    return periods.ytd_costs(_by_environment(spark, folder, _YTD), DATES)


@_query
def fy_ytd_costs(spark, folder):
    year = DATES.fiscal_year
    return periods.ytd_costs(_by_environment(spark, folder, [DATES.ytd_of(year)]), DATES, year)


@_query
def fy_total_costs(spark, folder):
    return periods.fy_total_costs(_by_environment(spark, folder, [DATES.fiscal_year.range]), DATES)


@_query
def prior_fy_costs(spark, folder):
    return periods.prior_fy_costs(_by_environment(spark, folder, [DATES.prior_year.range]), DATES)


def _pair(index: int):
    pair = DATES.comparisons[index]
    return pair, [pair.current, pair.previous]


@_query
def day_comparison(spark, folder):
    pair, spans = _pair(0)
    return periods.day_comparison(_by_environment(spark, folder, spans), pair)


@_query
def week_comparison(spark, folder):
    pair, spans = _pair(1)
    return periods.week_comparison(_by_environment(spark, folder, spans), pair)


@_query
def month_comparison(spark, folder):
    pair, spans = _pair(2)
    return periods.month_comparison(_by_environment(spark, folder, spans), pair)


@_query
def cto_costs(spark, folder):
    return breakdowns.cto_costs(_by_cto(spark, folder), DATES, TOP_N)


@_query
def pillar_costs(spark, folder):
    return breakdowns.pillar_costs(_by_pillar(spark, folder), DATES, TOP_N)


@_query
def product_costs(spark, folder):
    return breakdowns.product_costs(_by_product(spark, folder), DATES, TOP_N)


@_query
def env_pivot_sums(spark, folder):
    return breakdowns.env_pivot_sums(_by_cto(spark, folder), DATES)


@_query
def distinct_product_count(spark, folder):
    facts = star_facts(spark, folder, "tr_product_pillar_team", "tr_product_id")
    pillars = facts.groupBy(F.expr("tr_product_pillar_team as pillar_name"))
    return pillars.agg(F.expr("count(distinct tr_product_id) as product_count"))


@_query
def sketched_product_counts(spark, folder):
    """Numbers of products over months and quarters from stored sketches per day."""
    facts = star_facts(spark, folder, "date", "tr_product_pillar_team", "tr_product_id")
    kept = shared.stored(sketches.product_sketches(facts), "product-sketches")
    return sketches.product_counts_by_month(kept)


@_query
def having_nonprod(spark, folder):
    products = breakdowns.env_pivot_sums(_by_product(spark, folder), DATES, "product")
    return breakdowns.with_nonprod_cost(products)


@_query
def fiscal_year_averages(spark, folder):
    return daily.fiscal_year_averages(_by_cto(spark, folder, _AVERAGES), DATES)


@_query
def conditional_distinct_days(spark, folder):
    return daily.conditional_distinct_days(_by_cto(spark, folder, _AVERAGES), DATES)


@_query
def daily_costs(spark, folder):
    return daily.daily_costs(_by_cto(spark, folder, _AVERAGES), DATES.average_span, mode="contains")


@_query
def env_mean_baseline(spark, folder):
    return trend.env_mean_baseline(trend.daily_trend(_averages(spark, folder), DATES))


@_query
def environment_breakdown(spark, folder):
    return periods.environment_breakdown(_by_environment(spark, folder, _SUMMARY), DATES)


@_query
def top_rows_then_rollup(spark, folder):
    return breakdowns.top_rows_then_rollup(_environment_rows(spark, folder), TOP_N)


@_query
def grand_totals(spark, folder):
    return periods.grand_totals(_by_environment(spark, folder, _SUMMARY), DATES)


# --- order, lists ------------------------------------------------------------------------------


@_query
def top_n_cto(spark, folder):
    return breakdowns.cto_costs(_by_cto(spark, folder), DATES, 3).select("cto_org", "total_ytd_cost")


@_query
def top_n_pillar(spark, folder):
    return breakdowns.pillar_costs(_by_pillar(spark, folder), DATES, 3).select("pillar_name", "nonprod_ytd_cost")


@_query
def top_n_product(spark, folder):
    top = breakdowns.product_costs(_by_product(spark, folder), DATES, 25)
    return top.select("display_id", "cto_org", "prod_ytd_cost")


@_query
def chart_order(spark, folder):
    pillars = breakdowns.all_pillar_costs(_by_pillar(spark, folder), DATES)
    return breakdowns.chart_order(pillars, "pillar_name", 5).select("rank", "pillar_name", "total_ytd_cost")


@_query
def trend_order(spark, folder):
    return trend.trend_order(_averages(spark, folder))


@_query
def filter_value_lists(spark, folder):
    keys = ["cto", "tr_product_pillar_team", "tr_product_id", "tr_product"]
    return breakdowns.filter_value_lists(star_facts(spark, folder, *keys))


@_query
def distinct_values(spark, folder):
    return star_facts(spark, folder, "date", "environment").distinct()


# --- composite analytics -----------------------------------------------------------------------


@_query
def percent_change_comparison(spark, folder):
    spans = [span for pair in DATES.comparisons for span in (pair.current, pair.previous)]
    return periods.percent_change_comparison(_by_environment(spark, folder, spans), DATES)


@_query
def yoy_ytd_change(spark, folder):
    return periods.yoy_ytd_change(_by_environment(spark, folder, _SUMMARY), DATES)


@_query
def projected_vs_prior_ytd(spark, folder):
    return periods.projected_vs_prior_ytd(_by_environment(spark, folder, _SUMMARY), DATES)


@_query
def nonprod_share_change(spark, folder):
    return periods.nonprod_share_change(_by_environment(spark, folder, _SUMMARY), DATES)


@_query
def scorecard(spark, folder):
    return periods.scorecard(_by_environment(spark, folder, _SUMMARY), DATES)


@_query
def period_matrix(spark, folder):
    return periods.period_matrix(_by_environment(spark, folder, _PERIODS), DATES)


def _trailing_spans() -> list[tuple[str, DateRange]]:
    """For each day of two fiscal years the seven, thirty and ninety days that end on it, and the year to it."""
    found, day = [], DATES.prior_year.start
    while day <= DATES.cutoff:
        year = DATES.prior_year if day <= DATES.prior_year.end else DATES.fiscal_year
        found += [(f"{n} days to {day}", DateRange(day - timedelta(n - 1), day)) for n in (7, 30, 90)]
        found.append((f"year to {day}", DateRange(year.start, day)))
        day += timedelta(1)
    return found


@_query
def span_costs(spark, folder):
    """Some 2,200 overlapping spans in one pass."""
    within = DateRange(DATES.prior_year.start - timedelta(89), DATES.cutoff)
    facts = _by_environment(spark, folder, [within])
    return spans.span_costs(facts, spans.spans_table(spark, _trailing_spans()), within)


@_query
def scorecards(spark, folder):
    columns = "date", "environment", "cost", "cto", "tr_product_pillar_team", "tr_product_id"
    return subsets.scorecards(star_facts(spark, folder, *columns, spans=_SUMMARY), DATES)


@_query
def run_rate_forecast(spark, folder):
    costs = periods.ytd_costs(_by_environment(spark, folder, _YTD), DATES)
    return costs.selectExpr("*", f"{money.run_rate_forecast('ytd_cost', DATES.run_rate_days)} as forecasted_cost")


@_query
def run_rate_forecast_python(spark, folder):
    costs = periods.ytd_costs(_by_environment(spark, folder, _YTD), DATES)
    days = (DATES.as_of - DATES.fiscal_year.start).days
    return costs.selectExpr(
        "*", f"{money.run_rate_forecast_at_least_one_day('ytd_cost', days)} as forecasted_cost"
    )


@_query
def growth_forecast(spark, folder):
    averages = daily.fiscal_year_averages(_by_cto(spark, folder, _AVERAGES), DATES)
    names = DATES.average_columns
    return averages.select("environment_type", "cto", names["ytd"], names["forecast"])


@_query
def forecast_band(spark, folder):
    return trend.forecast_band(_averages(spark, folder), DATES)


@_query
def daily_trend(spark, folder):
    averages = daily.daily_average_table(_by_cto(spark, folder), DATES)
    return trend.daily_trend(averages, DATES)


@_query
def daily_trend_by_env(spark, folder):
    averages = daily.daily_average_table(_by_cto(spark, folder), DATES)
    return trend.daily_trend_by_env(trend.daily_trend(averages, DATES))


@_query
def trend_series(spark, folder):
    return trend.trend_series(_averages(spark, folder), trend.default_series(DATES), DATES)


@_query
def actual_forecast_split(spark, folder):
    span = DATES.fiscal_year.range
    current = daily.daily_costs(_by_cto(spark, folder, [span]), span)
    return trend.actual_forecast_split(current, DATES)


@_query
def stacked_share(spark, folder):
    organisations = breakdowns.all_cto_costs(_by_cto(spark, folder), DATES)
    return breakdowns.stacked_share(organisations).select("cto_org", "prod_share", "nonprod_share")


@_query
def breakdown_table_product(spark, folder):
    return breakdowns.breakdown_table_product(breakdowns.product_costs(_by_product(spark, folder), DATES, TOP_N))


@_query
def breakdown_table_cto(spark, folder):
    return breakdowns.breakdown_table_cto(breakdowns.cto_costs(_by_cto(spark, folder), DATES, TOP_N))


@_query
def breakdown_table_pillar(spark, folder):
    return breakdowns.breakdown_table_pillar(breakdowns.pillar_costs(_by_pillar(spark, folder), DATES, TOP_N))


@_query
def pillar_to_cto(spark, folder):
    return breakdowns.pillar_to_cto(breakdowns.product_costs(_by_product(spark, folder), DATES, TOP_N))


@_query
def cost_report(spark, folder):
    return report.long_form(_stored_sections(spark, folder))


@_query
def filtered_cost_report(spark, folder):
    """The whole report under an organisation, a pillar and a product."""
    facts = star_facts(spark, folder, *_PRODUCT_COLUMNS)
    return report.long_form(report.cost_report(facts, DATES, TOP_N, CHOSEN_PRODUCT, THRESHOLD))
