"""The kept roll-up: it equals a full report, and a refresh reads the days that can have changed only."""

from datetime import date, timedelta

import pytest
from conftest import rows_of

from tallyfold.operators.filters import CostFilter
from tallyfold.plans import incremental, report
from tallyfold.plans.dates import DateRange, ReportDates
from tallyfold.sources import tables

DATES = ReportDates(as_of=date(2025, 5, 6))
LATER = ReportDates(as_of=date(2025, 5, 9))


@pytest.fixture
def many(facts):
    days = [date(2024, 1, 20) + timedelta(n) for n in range(0, 480, 3)]
    return facts(*[(str(day), env, n % 50 + 1, f"Org{n % 3}", f"Pillar{n % 4}", f"P{n % 7}") for n, day in enumerate(days) for env in ("PROD", "NON-PROD", None)])


def _long(sections):
    return rows_of(report.long_form(sections))


def test_report_over_the_roll_up_equals_the_full_one(spark, tmp_path, many):
    incremental.refresh(many, f"{tmp_path}/r", DATES)
    rolled = incremental.rolled_up(spark, f"{tmp_path}/r")
    for chosen in (CostFilter(), CostFilter("Org1", "Pillar2", "P3")):
        found = report.cost_report(rolled, DATES, 5, chosen, listed=many)
        assert _long(found) == _long(report.cost_report(many, DATES, 5, chosen))


def test_refresh_reads_the_open_days_only(spark, tmp_path, many):
    root, path = f"{tmp_path}/r", f"{tmp_path}/facts"
    facts = tables.replace_table(many, path, partition="date")
    assert incremental.refresh(facts, root, DATES) == incremental.report_spans(DATES)
    due = incremental.due_days(spark, root, LATER)
    assert due == [DateRange(date(2025, 5, 4), date(2026, 1, 31))]
    scan = incremental.due_facts(facts, due)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in scan and "2025-05-04" in scan
    assert facts.filter("date >= '2025-05-04'").count() * 50 < facts.count()


def test_late_lost_and_new_facts(spark, tmp_path, many):
    root = f"{tmp_path}/r"
    incremental.refresh(many.filter("date < '2025-04-20' and not date between '2025-02-01' and '2025-02-10'"), root, DATES)
    # New days after the cut-off, a late load in February, and a day whose facts are gone.
    now = many.filter("date <> '2025-03-05'")
    late = [DateRange(date(2025, 2, 1), date(2025, 2, 28)), DateRange(date(2025, 3, 5), date(2025, 3, 5)), DateRange(date(2025, 4, 20), date(2025, 5, 3))]
    incremental.refresh(now, root, LATER, late)
    rolled = incremental.rolled_up(spark, root)
    assert _long(report.cost_report(rolled, LATER, 5, listed=now)) == _long(report.cost_report(now, LATER, 5))


def test_failed_refresh_is_repeated(spark, tmp_path, many):
    root = f"{tmp_path}/r"
    incremental.refresh(many, root, DATES)
    broken = many.selectExpr("* except (cost)", "cast(raise_error('lost') as decimal(18, 4)) as cost")
    with pytest.raises(Exception, match="lost"):
        incremental.refresh(broken, root, LATER)
    assert incremental.due_days(spark, root, LATER)[0].start == date(2025, 5, 4)
    incremental.refresh(many, root, LATER)
    rolled = incremental.rolled_up(spark, root)
    assert _long(report.cost_report(rolled, LATER, 5, listed=many)) == _long(report.cost_report(many, LATER, 5))


def test_a_longer_span_is_filled(spark, tmp_path, many):
    root = f"{tmp_path}/r"
    incremental.refresh(many, root, DATES)
    earlier = ReportDates(as_of=date(2024, 5, 6))
    assert incremental.due_days(spark, root, earlier) == [DateRange(date(2022, 2, 1), date(2023, 1, 31))]
