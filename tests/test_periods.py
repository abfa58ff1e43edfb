from datetime import date

import pytest
from conftest import rows_of

from tallyfold.operators import periods
from tallyfold.operators.filters import CostFilter
from tallyfold.plans.dates import Comparison, DateRange, ReportDates

DATES = ReportDates(date(2025, 5, 6))


def one_day(name, current, previous):
    return Comparison(name, DateRange(current, current), DateRange(previous, previous))


def test_other_and_missing_labels_are_non_production(facts):
    table = facts(("2025-03-01", "PROD", 1), ("2025-03-01", "PROD-DR", 2), ("2025-03-01", None, 4))
    assert rows_of(periods.ytd_costs(table, DATES)) == [("NON-PROD", 6.0), ("PROD", 1.0)]


def test_year_to_date_takes_the_first_day_and_the_cutoff_only(facts):
    table = facts(
        ("2025-01-31", "PROD", 1), ("2025-02-01", "PROD", 2), ("2025-05-03", "PROD", 4), ("2025-05-04", "PROD", 8)
    )
    assert rows_of(periods.ytd_costs(table, DATES)) == [("PROD", 6.0)]


def test_missing_costs_are_ignored_in_sums(facts):
    table = facts(("2025-03-01", "PROD", None), ("2025-03-02", "PROD", 3))
    assert rows_of(periods.ytd_costs(table, DATES)) == [("PROD", 3.0)]


def test_a_group_of_missing_costs_sums_to_null(facts):
    assert rows_of(periods.ytd_costs(facts(("2025-03-01", "PROD", None)), DATES)) == [("PROD", None)]


def test_prior_year_reports_whole_year_and_year_to_date(facts):
    table = facts(("2024-02-01", "PROD", 1), ("2024-05-06", "PROD", 2), ("2024-05-07", "PROD", 4))
    assert rows_of(periods.prior_fy_costs(table, DATES)) == [("PROD", 7.0, 3.0)]
    aligned = ReportDates(date(2025, 5, 6), align_lag=True)
    assert rows_of(periods.prior_fy_costs(table, aligned)) == [("PROD", 7.0, 1.0)]


def test_known_day_comparison(facts):
    table = facts(
        ("2025-05-03", "PROD", 10200), ("2025-05-02", "PROD", 10000),
        ("2025-05-03", "NON-PROD", 3800), ("2025-05-02", "NON-PROD", 3700),
    )
    pair = DATES.comparisons[0]
    assert rows_of(periods.day_comparison(table, pair)) == [("NON-PROD", 3800.0, 3700.0), ("PROD", 10200.0, 10000.0)]
    changes = {
        row.environment_type: row for row in periods.compare_in_one_pass(table, [pair]).collect()
    }
    assert changes["PROD"].percent_change == pytest.approx(2.0)
    assert changes["NON-PROD"].percent_change == pytest.approx(100 / 37)
    assert changes["PROD"].direction == "positive-change"


def test_change_is_zero_without_a_positive_base(facts):
    table = facts(("2025-05-03", "PROD", 5), ("2025-05-02", "NON-PROD", -2), ("2025-05-03", "NON-PROD", 1))
    rows = periods.compare_in_one_pass(table, [DATES.comparisons[0]]).collect()
    assert {(row.environment_type, row.percent_change, row.direction) for row in rows} == {
        ("PROD", 0.0, "neutral-change"),
        ("NON-PROD", 0.0, "neutral-change"),
    }


def test_an_environment_without_facts_shows_zeros(facts):
    rows = rows_of(periods.period_matrix(facts(("2025-05-03", "PROD", 5)), DATES))
    assert len(rows) == 10
    assert {row[2:] for row in rows if row[1] == "NON-PROD"} == {(0.0, 0.0, 0.0, "neutral-change")}


def test_periods_may_lie_anywhere(facts):
    table = facts(("2020-01-05", "PROD", 4), ("2010-07-01", "PROD", 2), ("2015-01-01", "PROD", 100))
    pair = one_day("far", date(2020, 1, 5), date(2010, 7, 1))
    row = periods.compare_in_one_pass(table, [pair]).filter("environment_type = 'PROD'").first()
    assert (row.current_cost, row.previous_cost, row.percent_change) == (4.0, 2.0, 100.0)


def test_scorecard_by_hand(facts):
    table = facts(
        ("2025-03-01", "PROD", 120), ("2025-03-01", "NON-PROD", 40), ("2025-06-01", "PROD", 10),
        ("2024-03-01", "PROD", 100), ("2024-03-01", "NON-PROD", 100), ("2024-12-01", "PROD", 999),
    )
    row = periods.scorecard(table, DATES).first()
    assert (row.prod_ytd_cost, row.nonprod_ytd_cost, row.total_fy_cost) == (120.0, 40.0, 170.0)
    assert (row.prod_prior_cost, row.nonprod_prior_cost, row.total_prior_ytd_cost) == (100.0, 100.0, 200.0)
    assert row.prod_ytd_percent == pytest.approx(20.0)
    assert row.nonprod_ytd_percent == pytest.approx(-60.0)
    assert row.fy_percent == pytest.approx(-15.0)
    assert row.nonprod_percentage == pytest.approx(25.0)
    assert row.nonprod_percentage_change == pytest.approx(-25.0)
    assert (row.prod_ytd_percent_class, row.fy_percent_class) == ("positive-change", "negative-change")


def test_scorecard_of_no_facts_is_all_zero(facts):
    row = periods.scorecard(facts(("1990-01-01", "PROD", 1)), DATES).first().asDict()
    assert {value for name, value in row.items() if not name.endswith("_class")} == {0.0}
    assert {value for name, value in row.items() if name.endswith("_class")} == {"neutral-change"}


def test_filters_apply_to_every_period(facts):
    table = facts(("2025-03-01", "PROD", 1, "A'b"), ("2025-03-01", "PROD", 2, "B"), ("2024-03-01", "PROD", 4, "A'b"))
    row = periods.scorecard(table, DATES, CostFilter(cto="A'b")).first()
    assert (row.prod_ytd_cost, row.prod_prior_cost) == (1.0, 4.0)


def test_fused_sums_equal_separate_queries(facts):
    table = facts(
        *[(f"2025-0{2 + i % 3}-0{1 + i % 9}", ("PROD", "NON-PROD", None)[i % 3], i * 1.37) for i in range(60)],
        *[(f"2024-0{2 + i % 8}-0{1 + i % 9}", ("PROD", "NON-PROD")[i % 2], i * 2.11) for i in range(60)],
    )
    matrix = {(r.period, r.environment_type): r for r in periods.period_matrix(table, DATES).collect()}
    for environment, cost in rows_of(periods.ytd_costs(table, DATES)):
        assert matrix["ytd", environment].current_cost == cost
    for environment, total, ytd in rows_of(periods.prior_fy_costs(table, DATES)):
        assert (matrix["fiscal_year", environment].previous_cost, matrix["ytd", environment].previous_cost) == (total, ytd)
    for environment, current, previous in rows_of(periods.month_comparison(table, DATES.comparisons[2])):
        pair = matrix["month", environment]
        assert (pair.current_cost, pair.previous_cost) == (current, previous)


def test_costs_may_be_doubles(facts):
    table = facts(("2025-03-01", "PROD", "1.25"), ("2024-03-01", "PROD", "0.5")).selectExpr(
        "* except (cost)", "double(cost) as cost"
    )
    row = periods.scorecard(table, DATES).first()
    assert (row.prod_ytd_cost, row.prod_prior_cost, row.prod_ytd_percent) == (1.25, 0.5, 150.0)
