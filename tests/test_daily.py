from datetime import date

import pytest
from conftest import rows_of

from tallyfold.operators import budget, daily, trend
from tallyfold.operators.filters import CostFilter
from tallyfold.plans.dates import ReportDates

DATES = ReportDates(date(2025, 5, 6))
NAMES = list(DATES.average_columns.values())


def test_average_columns_are_named_after_their_fiscal_years():
    assert NAMES == [
        "fy24_avg_daily_spend",
        "fy25_avg_daily_spend",
        "fy26_ytd_avg_daily_spend",
        "fy26_forecasted_avg_daily_spend",
        "fy26_avg_daily_spend",
    ]


def test_averages_divide_by_days_with_cost(facts):
    table = facts(
        ("2023-03-01", "PROD", 10), ("2023-03-01", "PROD", 20), ("2023-03-05", "PROD", 1),
        ("2025-03-01", "PROD", 3), ("2025-06-01", "PROD", 7),
    )
    row = daily.fiscal_year_averages(table, DATES).first()
    assert [row[name] for name in NAMES] == [15.5, None, 3.0, 3.45, 5.0]


def test_a_day_whose_costs_are_missing_still_counts(facts):
    table = facts(("2025-03-01", "PROD", 4), ("2025-03-02", "PROD", None))
    row = daily.fiscal_year_averages(table, DATES).first()
    assert row.fy26_ytd_avg_daily_spend == 2.0


def test_left_keeps_days_without_organisation_inner_drops_them(facts):
    table = facts(("2025-03-01", "PROD", 4, None), ("2025-03-01", "PROD", 6, "T"))
    left = {row.cto: row for row in daily.daily_average_table(table, DATES).collect()}
    assert (left[None].daily_cost, left[None].fy26_avg_daily_spend) == (4.0, 0.0)
    assert (left["T"].fy24_avg_daily_spend, left["T"].fy26_avg_daily_spend) == (0.0, 6.0)
    inner = daily.daily_average_table(table, DATES, how="inner").collect()
    assert [(row.cto, row.fy24_avg_daily_spend, row.fy26_avg_daily_spend) for row in inner] == [("T", None, 6.0)]


def test_classifier_modes_differ(facts):
    table = facts(("2025-03-01", "PROD", 1), ("2025-03-01", "PROD-DR", 2), ("2025-03-01", "NON-PROD", 4))
    span = DATES.average_span

    def production(mode):
        costs = daily.daily_costs(table, span, mode).filter("environment_type = 'PROD'")
        return costs.first().daily_cost

    assert [production(mode) for mode in ("exact", "prefix", "contains")] == [1.0, 3.0, 7.0]


def test_daily_cost_rounds_half_up_on_the_exact_sum(facts):
    table = facts(("2025-03-01", "PROD", "1.0025"), ("2025-03-01", "PROD", "0.0025"))
    assert daily.daily_costs(table, DATES.average_span).first().daily_cost == 1.01


def test_window_gives_the_same_as_joining_the_averages(facts):
    table = facts(
        *[(f"2025-0{2 + i % 3}-1{i % 9}", ("PROD", "DEV")[i % 2], i * 1.7, ("A", "B", None)[i % 3]) for i in range(90)]
    )
    span = DATES.average_span
    joined = daily.daily_costs(table, span).join(
        daily.fiscal_year_averages(table, DATES), ["environment_type", "cto"], "inner"
    )
    columns = ["date", "environment_type", "cto", *NAMES, "daily_cost"]
    assert rows_of(joined.select(columns)) == rows_of(daily.daily_average_table(table, DATES, how="inner").select(columns))


def test_trend_from_facts_equals_trend_from_the_table(facts):
    table = facts(("2025-03-01", "PROD", 1, "A"), ("2025-03-01", "PROD", 2, "B"), ("2025-05-04", "PROD", 9, "B"))
    averages = daily.daily_average_table(table, DATES)
    expected = [(date(2025, 3, 1), "PROD", 1.0), (date(2025, 3, 1), "PROD", 2.0)]
    assert rows_of(trend.daily_trend(averages, DATES)) == expected
    assert rows_of(trend.daily_trend_from_facts(table, DATES)) == expected
    assert rows_of(trend.daily_trend_by_env(trend.daily_trend(averages, DATES))) == [(date(2025, 3, 1), "PROD", 3.0)]


def test_trend_under_a_product_filter(facts):
    table = facts(("2025-03-01", "PROD", 1, "A", "X", "P1"), ("2025-03-01", "PROD", 2, "A", "X", "P2"))
    filtered = trend.daily_trend_from_facts(table, DATES, chosen=CostFilter(product="P2"))
    assert rows_of(filtered) == [(date(2025, 3, 1), "PROD", 2.0)]


def test_series_split_at_the_cutoff_and_ignore_case(spark, facts):
    table = facts(("2025-05-03", "PROD", 1), ("2025-05-04", "PROD", 2), ("2025-05-04", "DEV", 4))
    averages = daily.daily_average_table(table, DATES)
    lines = [trend.Series("it's", "daily_cost", "prod"), trend.Series("all", "daily_cost")]
    found = trend.trend_series(averages, lines, DATES).select("series", "segment", "value")
    assert sorted(tuple(row) for row in found.collect()) == [
        ("all", "Actual", 1.0),
        ("all", "Forecast", 2.0),
        ("all", "Forecast", 4.0),
        ("it's", "Actual", 1.0),
        ("it's", "Forecast", 2.0),
    ]


def test_missing_environments_come_from_the_defaults(spark):
    schema = "date date, environment_type string, daily_cost double"
    day = date(2025, 3, 1)
    have = spark.createDataFrame([(day, "PROD", 1.0)], schema)
    defaults = spark.createDataFrame([(day, "PROD", 7.0), (day, "NON-PROD", 8.0)], schema)
    assert rows_of(trend.add_missing_environments(have, defaults)) == [(day, "NON-PROD", 8.0), (day, "PROD", 1.0)]


def test_baseline_is_the_mean_of_each_environment(spark):
    schema = "date date, environment_type string, daily_cost double"
    day = date(2025, 3, 1)
    rows = [(day, "PROD", 1.0), (day, "PROD-DR", 3.0), (day, "DEV", 5.0), (day, None, 7.0)]
    found = rows_of(trend.env_mean_baseline(spark.createDataFrame(rows, schema)))
    assert [(r[1], r[2], r[3], r[4]) for r in found] == [
        ("NON-PROD", 5.0, 6.0, pytest.approx(4.8)),
        ("NON-PROD", 7.0, 6.0, pytest.approx(4.8)),
        ("PROD", 1.0, 2.0, 1.6),
        ("PROD", 3.0, 2.0, 1.6),
    ]


def test_forecast_band_is_ten_percent_wide(facts):
    table = daily.daily_average_table(facts(("2025-03-01", "PROD", 100)), DATES)
    row = trend.forecast_band(table, DATES).first()
    assert (row.forecast, row.forecast_low, row.forecast_high) == (115.0, pytest.approx(103.5), pytest.approx(126.5))


def test_budget_variance(spark):
    actuals = spark.createDataFrame([("PROD", 120.0)], "environment_type string, total_cost double")
    budgets = spark.createDataFrame(
        [("PROD", 60.0, "2026"), ("PROD", 40.0, "2026"), ("NON-PROD", 50.0, "2026"), ("PROD", 1.0, "2025")],
        "environment_type string, budget_amount double, fiscal_year string",
    )
    assert rows_of(budget.budget_variance(actuals, budgets, "2026")) == [
        ("NON-PROD", 50.0, 0.0, -50.0, -100.0, "under"),
        ("PROD", 100.0, 120.0, 20.0, pytest.approx(20.0), "over"),
    ]


def test_budget_keeps_cost_without_a_budget(spark):
    actuals = spark.createDataFrame([("PROD", 100.0), ("NON-PROD", 50.0)], "environment_type string, total_cost double")
    budgets = spark.createDataFrame([("PROD", 80.0, "2026")], "environment_type string, budget_amount double, fiscal_year string")
    assert rows_of(budget.budget_variance(actuals, budgets, "2026")) == [
        ("NON-PROD", 0.0, 50.0, 50.0, None, "over"),
        ("PROD", 80.0, 100.0, 20.0, 25.0, "over"),
    ]


def test_series_hold_days_of_their_fiscal_year_only(facts):
    table = daily.daily_average_table(facts(("2024-01-15", "PROD", 1), ("2024-05-01", "PROD", 2), ("2025-03-01", "PROD", 3)), DATES)
    found = trend.trend_series(table, trend.default_series(DATES), DATES)
    assert {str(row.date) for row in found.collect()} == {"2025-03-01"}
