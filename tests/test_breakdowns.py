from datetime import date

import pytest
from conftest import rows_of

from tallyfold.operators import breakdowns as b
from tallyfold.operators.filters import CostFilter, combination_exists, existing_combinations, nonprod_over
from tallyfold.plans.dates import ReportDates

DATES = ReportDates(date(2025, 5, 6))
MARCH = "2025-03-01"


def test_labels_other_than_the_two_count_only_in_the_total(facts):
    table = facts((MARCH, "PROD", 1), (MARCH, "NON-PROD", 2), (MARCH, "DEV", 4), (MARCH, None, 8))
    row = b.cto_costs(table, DATES, 10).first()
    assert (row.prod_ytd_cost, row.nonprod_ytd_cost, row.total_ytd_cost) == (1.0, 2.0, 15.0)
    assert row.nonprod_percentage == pytest.approx(200 / 15)


def test_forecast_is_the_run_rate_over_days_elapsed(facts):
    row = b.cto_costs(facts((MARCH, "PROD", 91)), DATES, 10).first()
    assert row.forecasted_cost == pytest.approx(365.0)  # 91 days from 1 February to 3 May


def test_forecast_is_null_on_the_first_day_of_the_year(facts):
    first = ReportDates(date(2025, 2, 4))
    assert b.cto_costs(facts(("2025-02-01", "PROD", 5)), first, 10).first().forecasted_cost is None


def test_share_of_a_zero_total_is_null_in_the_query_and_zero_in_the_table(facts):
    costs = b.cto_costs(facts((MARCH, "PROD", 1), (MARCH, "NON-PROD", -1)), DATES, 10)
    assert costs.first().nonprod_percentage is None
    assert b.breakdown_table_cto(costs).first().nonprod_percentage == 0.0


def test_equal_amounts_are_cut_in_key_order(facts):
    table = facts(*[(MARCH, "PROD", 5, name) for name in "dbca"])
    assert [row.cto_org for row in b.cto_costs(table, DATES, 3).collect()] == ["a", "b", "c"]


def test_pillars_need_non_production_cost_and_count_products(facts):
    table = facts(
        (MARCH, "PROD", 9, "T", "onlyprod", "P1"), (MARCH, "NON-PROD", 1, "T", "both", "P1"),
        (MARCH, "PROD", 1, "T", "both", "P1"), (MARCH, "PROD", 1, "T", "both", "P2"),
        (MARCH, "PROD", 1, "T", "both", None),
    )
    assert [(r.pillar_name, r.product_count) for r in b.pillar_costs(table, DATES, 10).collect()] == [("both", 2)]


def test_display_id_is_null_if_a_part_is(facts):
    table = facts((MARCH, "PROD", 1, "T", None, "P1"), (MARCH, "PROD", 2, "T", "X", "P1"))
    assert {r.display_id for r in b.product_costs(table, DATES, 10).collect()} == {None, "X - P1"}


def test_last_product_of_the_list_gives_a_pillar_its_organisation(facts):
    table = facts(
        (MARCH, "PROD", 9, "high", "X", "P1"), (MARCH, "PROD", 5, "low", "X", "P2"),
        (MARCH, "PROD", 5, "lower", "X", "P3"), (MARCH, "PROD", 1, "cut", "X", "P4"),
    )
    assert rows_of(b.pillar_to_cto(b.product_costs(table, DATES, 3))) == [("X", "lower")]


def test_rows_are_taken_before_they_are_rolled_up(spark):
    rows = spark.createDataFrame(
        [("A", "PROD", 10.0), ("A", "NON-PROD", 1.0), ("B", "PROD", 8.0), ("B", "NON-PROD", 7.0)],
        "product_name string, environment string, total_ytd_cost double",
    )
    assert rows_of(b.top_rows_then_rollup(rows, 3)) == [
        ("A", 10.0, 0.0, 10.0, 0.0),
        ("B", 8.0, 7.0, 15.0, pytest.approx(700 / 15)),
    ]


def test_missing_costs_and_lost_totals_are_filled(spark):
    schema = "k string, prod_ytd_cost double, nonprod_ytd_cost double, total_ytd_cost double"
    rows = spark.createDataFrame([("a", None, None, None), ("b", 3.0, None, 0.0), ("c", 3.0, 1.0, 9.0)], schema)
    assert rows_of(b.fill_missing_costs(rows)) == [("a", 0.0, 0.0, 0.0), ("b", 3.0, 0.0, 3.0), ("c", 3.0, 1.0, 9.0)]


def test_shares_of_nothing_are_zero(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "prod_ytd_cost double, nonprod_ytd_cost double")
    assert rows_of(b.stacked_share(rows)) == [(0.0, 0.0, 0.0, 0.0), (1.0, 2.0, 33.3, 66.7)]


def test_chart_order_counts_from_the_smallest_of_the_largest(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "k string, total_ytd_cost double")
    ranked = b.chart_order(rows, "k", 2)
    assert rows_of(ranked.select("rank", "k")) == [(1, "c"), (2, "b")]


def test_threshold_is_exceeded_not_met(spark):
    rows = spark.createDataFrame([(30.0,), (30.1,), (None,)], "nonprod_percentage double")
    assert [r.over_threshold for r in nonprod_over(rows, 30).collect()] == [False, True, False]


def test_value_lists_skip_missing_values_and_repeats(facts):
    table = facts((MARCH, "PROD", 1, "T", "X", "P1", "n"), (MARCH, "PROD", 1, None, "X", "P1", "n"))
    assert [tuple(r) for r in b.filter_value_lists(table).collect()] == [
        ("cto", "T", None, None, "T"),
        ("pillar", "X", None, None, "X"),
        ("product", "P1", "n", "X", "X - P1"),
    ]


def test_combinations(facts):
    table = facts((MARCH, "PROD", 1, "T", "X", "P1"), (MARCH, "PROD", 1, "T", "Y", "P2"))
    assert combination_exists(table, CostFilter(pillar="X", product="P1")).first()[0] is True
    assert combination_exists(table, CostFilter(pillar="Y", product="P1")).first()[0] is False
    requested = table.sparkSession.createDataFrame(
        [("T", "X", "P1"), ("T", "X", "P2")], "cto string, tr_product_pillar_team string, tr_product_id string"
    )
    assert rows_of(existing_combinations(requested, table)) == [("T", "X", "P1")]
