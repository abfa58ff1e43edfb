"""Stored daily averages, spans, scorecards per choice, and sketches against the operators that compute from the facts."""

from datetime import date, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyfold.operators import breakdowns, daily, periods, sketches, spans, subsets
from tallyfold.operators.filters import CostFilter
from tallyfold.plans import stored_averages
from tallyfold.plans.dates import DateRange, ReportDates
from tallyfold.sources import tables

DATES = ReportDates(as_of=date(2025, 5, 6))
LATER = ReportDates(as_of=date(2025, 5, 9))


@pytest.fixture
def many(facts):
    days = [date(2023, 12, 20) + timedelta(n) for n in range(0, 500, 3)]
    orgs = ["Org0", "Org1", None]
    return facts(*[(str(day), env, n % 50 + 1, orgs[n % 3], f"Pillar{n % 4}", f"P{n % 7}") for n, day in enumerate(days) for env in ("PROD", "NON-PROD", None)])


def _table(spark, root, dates=DATES, span=None):
    return rows_of(stored_averages.read_averages(spark, root, dates, span))


def test_stored_averages_equal_the_table_and_only_changed_months_are_rewritten(spark, tmp_path, many):
    root = f"{tmp_path}/a"
    known = many.filter("not (environment <=> 'PROD' and date between '2024-03-01' and '2024-03-31')")
    stored_averages.refresh_averages(known, root, DATES)
    assert _table(spark, root) == rows_of(daily.daily_average_table(known, DATES))
    before = stored_averages.stored_months(spark, root)
    assert stored_averages.refresh_averages(known, root, DATES) == []
    old = stored_averages.read_averages(spark, root, DATES)
    now = many.filter("date not between '2024-07-01' and '2024-07-31'")
    assert stored_averages.refresh_averages(now, root, DATES) == ["2024-03", "2024-07"]
    after = stored_averages.stored_months(spark, root)
    assert {month for month in before if after.get(month) != before[month]} == {"2024-03", "2024-07"}
    assert _table(spark, root) == rows_of(daily.daily_average_table(now, DATES))
    # Who opened the table before the refresh still reads it.
    assert rows_of(old) == rows_of(daily.daily_average_table(known, DATES))
    span = DateRange(date(2024, 12, 20), date(2025, 1, 10))
    assert _table(spark, root, span=span) == rows_of(daily.daily_average_table(now, DATES).filter(span.contains()))


def test_named_months_are_all_that_is_read(spark, tmp_path, many):
    root, path = f"{tmp_path}/a", f"{tmp_path}/facts"
    facts = tables.replace_table(many, path, partition="date")
    stored_averages.refresh_averages(facts, root, DATES)
    changed = facts.withColumn("cost", F.expr("if(date between '2024-03-01' and '2024-04-30', cost * 2, cost)").cast("decimal(18, 4)"))
    poisoned = changed.withColumn("cost", F.expr("if(date >= '2024-05-01', cast(raise_error('read') as decimal(18, 4)), cost)"))
    assert stored_averages.refresh_averages(poisoned, root, DATES, ["2024-03"]) == ["2024-03"]
    assert _table(spark, root) == rows_of(daily.daily_average_table(facts.withColumn("cost", F.expr("if(date between '2024-03-01' and '2024-03-31', cost * 2, cost)").cast("decimal(18, 4)")), DATES))
    prints = stored_averages.month_prints(facts, [DateRange(date(2024, 3, 1), date(2024, 3, 31))])
    assert "PartitionFilters: [isnotnull(date" in prints._jdf.queryExecution().executedPlan().toString()


def test_a_failed_refresh_changes_nothing_and_unused_folders_go(spark, tmp_path, many):
    root = f"{tmp_path}/a"
    stored_averages.refresh_averages(many, root, DATES)
    expected = _table(spark, root)
    broken = many.withColumn("cost", F.expr("if(date > '2025-01-01', cast(raise_error('lost') as decimal(18, 4)), cost)"))
    with pytest.raises(Exception, match="lost"):
        stored_averages.refresh_averages(broken, root, DATES)
    assert _table(spark, root) == expected
    # A later cut-off changes the year to date of every row, and no month.
    assert stored_averages.refresh_averages(many, root, LATER) == []
    assert _table(spark, root, LATER) == rows_of(daily.daily_average_table(many, LATER))
    stored_averages.refresh_averages(many.filter("date <> '2024-01-01'").limit(0), root, LATER)
    assert _table(spark, root, LATER) == []
    assert stored_averages.remove_unused(spark, root) >= 1
    stored_averages.refresh_averages(many, root, LATER)
    assert _table(spark, root, LATER) == rows_of(daily.daily_average_table(many, LATER))
    with pytest.raises(ValueError, match="mode"):
        stored_averages.refresh_averages(many, root, LATER, mode="contains")
    with pytest.raises(ValueError, match="no daily averages"):
        stored_averages.read_averages(spark, f"{tmp_path}/none", DATES)


def test_spans_of_all_lengths(spark, many):
    within = DateRange(date(2024, 1, 1), date(2025, 5, 3))
    days = [within.start + timedelta(n) for n in range(0, 480, 37)]
    named = [(f"{a} {b}", DateRange(a, b)) for a in days for b in days]
    found = {(r.name, r.environment_type): r.cost for r in spans.span_costs(many, spans.spans_table(spark, named), within).collect()}
    kept = many.selectExpr("date", "if(environment <=> 'PROD', 'PROD', 'NON-PROD') as e", "double(cost) as cost").collect()
    assert found == {(name, e): sum(r.cost for r in kept if r.e == e and span.start <= r.date <= span.end) for name, span in named for e in ("PROD", "NON-PROD")}


def test_spans_equal_the_period_matrix(spark, many):
    matrix = periods.period_matrix(many, DATES).collect()
    pairs = [*DATES.comparisons, periods.Comparison("ytd", DATES.ytd, DATES.prior_ytd), periods.Comparison("fiscal_year", DATES.fiscal_year.range, DATES.prior_year.range)]
    named = [(f"{pair.name} {side}", getattr(pair, side)) for pair in pairs for side in ("current", "previous")]
    within = DateRange(DATES.prior_year.start, DATES.fiscal_year.end)
    found = {(r.name, r.environment_type): r.cost for r in spans.span_costs(many, spans.spans_table(spark, named), within).collect()}
    assert found == {(f"{r.period} {side}", r.environment_type): r[f"{side}_cost"] for r in matrix for side in ("current", "previous")}


def test_scorecards_equal_the_filtered_ones(many):
    rows = {(r.chosen_by, r.cto, r.pillar, r["product"]): r for r in subsets.scorecards(many, DATES).collect()}
    assert len(rows) == subsets.scorecards(many, DATES).count()
    named = {"": CostFilter(), "cto": CostFilter("Org1"), "pillar": CostFilter(pillar="Pillar2"), "cto,pillar": CostFilter("Org0", "Pillar1")}
    named |= {"product": CostFilter(product="P3"), "cto,product": CostFilter("Org1", product="P4"), "pillar,product": CostFilter(None, "Pillar0", "P1")}
    one = many.filter("cto is not null and date between '2025-02-01' and '2025-05-03'").first()
    named["cto,pillar,product"] = CostFilter(one.cto, one.tr_product_pillar_team, one.tr_product_id)
    for chosen_by, chosen in named.items():
        row = rows[chosen_by, chosen.cto, chosen.pillar, chosen.product].asDict()
        expected = periods.scorecard(many, DATES, chosen).first().asDict()
        assert {name: row[name] for name in expected} == expected
    assert not [key for key in rows if "cto" in key[0] and key[1] is None]


def test_sketches_stay_within_their_error(spark, facts):
    """One pillar with 40,000 products, one with 200, over two days; the sketches are all that a span reads."""
    row = facts(("2025-03-01", "PROD", 1))
    large = spark.range(40_000).selectExpr("id", "'Large' as pillar").union(spark.range(200).selectExpr("id", "'Small' as pillar"))
    many = row.drop("tr_product_id", "tr_product_pillar_team", "date").crossJoin(large).selectExpr(
        "*", "pillar as tr_product_pillar_team", "concat('P', id) as tr_product_id", "date_add(date'2025-03-31', int(id % 2)) as date"
    )
    kept = sketches.product_sketches(many)
    found = {r.pillar_name: r.product_count for r in sketches.product_counts(kept, DATES.ytd).collect()}
    exact = {r.pillar_name: r.product_count for r in breakdowns.all_pillar_costs(many, DATES).collect()}
    assert exact == {"Large": 40_000, "Small": 200}
    # Four standard errors of 2^12 registers.
    assert abs(found["Large"] - 40_000) < 4 * 1.04 / 64 * 40_000 and found["Small"] == 200
    months = {(str(r.month), r.pillar_name): (r.month_products, r.quarter_products) for r in sketches.product_counts_by_month(kept).collect()}
    assert months["2025-03-01", "Small"] == (100, 100) and months["2025-04-01", "Small"] == (100, 200)
    assert sketches.product_counts(kept, DateRange(date(2025, 3, 31), date(2025, 3, 31))).filter("pillar_name = 'Small'").first().product_count == 100
