"""Loads that replace a table in one step, rejects of a load, and order-free reconciliation."""

import pathlib
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyfold.schemas import COST_FACTS
from tallyfold.sources import delimited, tables, versions


@pytest.fixture
def many(facts):
    return facts(*[(f"2025-03-{day:02d}", env, day) for day in range(1, 29) for env in ("PROD", "NON-PROD")])


@pytest.mark.parametrize("partition", [None, "date", "month"])
def test_failed_load_leaves_the_old_table(spark, tmp_path, many, partition):
    path = f"{tmp_path}/t"
    tables.replace_table(many, path, partition)
    # The rows before the bad one may be written already.
    broken = many.withColumn("cost", F.expr("if(date = '2025-03-20', cast(raise_error('lost') as decimal(18, 4)), cost)"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, path, partition)
    assert rows_of(tables.scan_cost_facts(spark, path)) == rows_of(many)


def test_check_refuses_a_version(spark, tmp_path, many):
    path = f"{tmp_path}/t"
    tables.replace_table(many, path)

    def full(stored):
        assert tables.verify_row_count(stored, many).first().row_counts_match, "rows are missing"

    with pytest.raises(AssertionError, match="missing"):
        tables.replace_table(many.limit(5), path, check=full)
    assert tables.read_table(spark, path).count() == many.count()


def test_readers_keep_their_version(spark, tmp_path, many, facts):
    path = f"{tmp_path}/t"
    before = tables.replace_table(many, path)
    after = tables.replace_table(facts(("1999-01-01", "PROD", 1)), path)
    assert (before.count(), after.count(), tables.read_table(spark, path).count()) == (56, 1, 1)
    # A load may read the table that it replaces.
    tables.replace_table(tables.read_table(spark, path).unionByName(many), path)
    assert versions.remove_old_versions(spark, path) == 2
    assert tables.read_table(spark, path).count() == 57
    assert len(list(pathlib.Path(path).glob("v-*"))) == 1


def test_one_bad_line_does_not_retype_a_column(spark, tmp_path, many):
    texts = many.selectExpr(*[f"string({name}) as {name}" for name in many.columns])
    lines = texts.withColumn("cost", F.expr("case when date = '2025-03-07' and environment = 'PROD' then '1,5x' when date = '2025-03-08' then '0.00001' else cost end"))
    delimited.csv_write(lines, f"{tmp_path}/in", header=False)
    target = f"{tmp_path}/out"
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, target, tolerance=0.1)
    assert loaded.schema == COST_FACTS and loaded.count() == 53
    left = delimited.read_rejects(spark, target)
    # A record that no type can hold, and two amounts that the decimal would lose.
    assert {(r.reject_reason, r.reject_record.split(",")[0]) for r in left.collect()} == {("cost", "2025-03-07"), ("cost", "2025-03-08")}
    assert left.count() == 3 and all("/in/" in r.reject_file for r in left.collect())
    kept = rows_of(many.filter("not (date = '2025-03-08' or (date = '2025-03-07' and environment = 'PROD'))"))
    assert rows_of(loaded) == kept
    # Beyond the tolerance the column is another one, and nothing is rejected.
    other = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, target, tolerance=0.01)
    assert other.count() == 56 and dict(other.dtypes)["cost"] == "string" and delimited.read_rejects(spark, target).count() == 0


def test_records_of_another_width_are_rejects(spark, tmp_path, many):
    (tmp_path / "in").mkdir()
    line = "2025-03-01,Tech,AWS,Data,Core,P1,One,S3,PROD,1.5"
    (tmp_path / "in" / "a.csv").write_text("\n".join([line] * 50 + [line + ",more", "2025-03-01,Tech"]) + "\n")
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, f"{tmp_path}/out", tolerance=0.1)
    left = delimited.read_rejects(spark, f"{tmp_path}/out").collect()
    assert loaded.count() == 50
    assert sorted((r.reject_reason, r.reject_record) for r in left) == [("width", "2025-03-01,Tech"), ("width", line + ",more")]


def test_failed_csv_load_leaves_the_old_table(spark, tmp_path, many):
    target = f"{tmp_path}/out"
    tables.replace_table(many, target)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,2,3\n" * 20)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, target)
    assert rows_of(tables.read_table(spark, target)) == rows_of(many)


def test_empty_csv_gives_an_empty_table(spark, tmp_path, many):
    delimited.csv_write(many.filter("false"), f"{tmp_path}/in", header=False)
    loaded = delimited.csv_load_table(spark, f"{tmp_path}/in", COST_FACTS, f"{tmp_path}/out")
    assert loaded.schema == COST_FACTS and loaded.count() == 0


def test_reconciliation_names_the_days_that_differ(many, facts):
    assert tables.reconciled(many, many.orderBy("cost")).count() == 0
    swapped = many.withColumn("cost", F.expr("if(date = '2025-03-05', cost + 1, cost)"))
    assert [tuple(r) for r in tables.reconciled(swapped, many).collect()] == [(date(2025, 3, 5), 2, 2, True)]
    lost = many.filter("date <> '2025-03-06'")
    assert [tuple(r) for r in tables.reconciled(lost, many).collect()] == [(date(2025, 3, 6), 0, 2, False)]
    # A row twice beside another once: same count, same set.
    a, b = facts(("2025-01-01", "PROD", 1), ("2025-01-01", "PROD", 1), ("2025-01-01", "PROD", 2)), facts(("2025-01-01", "PROD", 1), ("2025-01-01", "PROD", 2), ("2025-01-01", "PROD", 2))
    assert tables.reconciled(a, b).first().same_count
