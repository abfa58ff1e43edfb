from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.functions import fiscal, money, seasonal
from tallyfold.operators.grid import calendar_dimension_grid, grid_sample
from tallyfold.plans.dates import DateRange, FiscalYear


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12.0), (" -1.5 ", -1.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("1d", 0.0), ("abc", 0.0),
     ("", 0.0), (None, 0.0), ("1,000", 0.0), ("inf", float("inf")), ("nan", 0.0), ("0x10", 0.0)],
)
def test_numbers_in_text(spark, text, number):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.selectExpr(money.coerce_numeric("t")).first()[0] == number


@pytest.mark.parametrize(
    ("amount", "label"), [(1234.56, "$1,234.56"), (0.0, "$0.00"), (1.005, "$1.00"), (1.00499999, "$1.00"), (1.0051, "$1.01"), (None, None), (-2.5, "$-2.50"), (1e9, "$1,000,000,000.00")]
)
def test_currency_labels(spark, amount, label):
    frame = spark.createDataFrame([(amount,)], "a double")
    assert frame.selectExpr(money.currency_label("a")).first()[0] == label


def test_bar_labels(spark):
    frame = spark.createDataFrame([(1234567.0, 45.25, 3)], "a double, p double, n int")
    row = frame.selectExpr(
        money.bar_label("a", "45.3D"), money.bar_label("a", "45.3D", millions=True), money.products_label("a", "n")
    ).first()
    assert tuple(row) == ("$1234567 (45.3%)", "$1.23M (45.3%)", "$1,234,567.00 (3 products)")
    near = spark.range(1).selectExpr(money.bar_label("1.5D - 1e-8D", "1D"), money.bar_label("-1234567.8D", "1D"))
    assert tuple(near.first()) == ("$1 (1.0%)", "$-1234568 (1.0%)")


def test_forecasts(spark):
    row = spark.range(1).selectExpr(
        money.run_rate_forecast("100", 0),
        money.run_rate_forecast("100", 73),
        money.run_rate_forecast_at_least_one_day("100", 0),
        money.growth_forecast("100D"),
    ).first()
    assert tuple(row) == (None, 500.0, 36500.0, pytest.approx(115.0))


def _strftime_week(day):
    week_end = day - timedelta(days=day.weekday() + 1)
    return week_end - timedelta(days=6), week_end


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(1999, 1, 1), date(2040, 1, 1)), min_size=50, max_size=50))
def test_calendar_expressions_agree_with_python(spark, days):
    derived = fiscal.relative_periods("d")
    frame = spark.createDataFrame([(day,) for day in days], "d date").selectExpr(
        "d",
        *[f"{value} as {name}" for name, value in derived.items()],
        f"{fiscal.fiscal_year('d')} as fy",
        f"{fiscal.fiscal_year_start('d')} as fy_start",
        f"{fiscal.fiscal_year_end('d')} as fy_end",
        f"{fiscal.fiscal_year('d', 1)} as calendar_year",
        f"{fiscal.month_label('d')} as month_label",
        f"{fiscal.range_label('d', 'd')} as range_label",
    )
    for row in frame.collect():
        year = FiscalYear.containing(row.d)
        assert (row.fy, row.fy_start, row.fy_end) == (year.number, year.start, year.end)
        assert row.calendar_year == row.d.year
        assert (row.week_current_start, row.week_current_end) == _strftime_week(row.d)
        assert row.month_previous == (row.d.replace(day=1) - timedelta(days=1)).replace(day=1)
        assert row.month_label == row.d.strftime("%b %Y")
        assert row.range_label == row.d.strftime("%b %d - %b %d, %Y")


def test_month_bounds_of_december_and_leap_february(spark):
    frame = spark.createDataFrame([("2024-12",), ("2024-02",)], "m string")
    assert [tuple(r) for r in frame.selectExpr(fiscal.month_start("m"), fiscal.month_end("m")).collect()] == [
        (date(2024, 12, 1), date(2024, 12, 31)),
        (date(2024, 2, 1), date(2024, 2, 29)),
    ]


@pytest.mark.parametrize(
    ("day", "cost"),
    [
        (date(2025, 2, 3), 100 * (1 + 2 / 365 * 0.12)),  # Monday
        (date(2025, 2, 8), 100 * 0.6 * (1 + 7 / 365 * 0.12)),  # Saturday
        (date(2025, 2, 24), 100 * 1.2 * (1 + 23 / 365 * 0.12)),  # fifth last day
        (date(2025, 2, 21), 100 * (1 + 20 / 365 * 0.12)),  # Friday before
    ],
)
def test_seasonal_cost(spark, day, cost):
    frame = spark.createDataFrame([(day, 100.0)], "d date, c double")
    found = frame.selectExpr(seasonal.seasonal_cost("c", "d", date(2025, 2, 1))).first()[0]
    assert found == pytest.approx(round(cost, 2), abs=1e-9)


def test_grid_and_its_sample(spark):
    dimensions = spark.createDataFrame([(f"P{i}",) for i in range(12)], "tr_product_id string")
    span = DateRange(date(2024, 2, 1), date(2025, 5, 4))
    grid = calendar_dimension_grid(dimensions, span, ["PROD", "NON-PROD"], ["AWS", "GCP", "Azure"])
    assert grid.count() == 459 * 12 * 2 * 3 == grid.distinct().count()
    kept = grid_sample(grid, grid.columns)
    assert 0.29 < kept.count() / 33048 < 0.31
    assert kept.exceptAll(grid_sample(grid.repartition(7), grid.columns)).count() == 0
