"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest
from compare import difference, duckdb_on, oracle_rows, spark_rows

import __spark_entry__ as entry
from tallyfold.catalog.oracle import oracle_texts
from tallyfold.catalog.queries import registered

QUERIES, TEXTS = registered(), oracle_texts()


@pytest.fixture(scope="module")
def oracle(folder):
    return duckdb_on(folder)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(TEXTS)
    assert QUERIES.items() <= entry.queries().items() and TEXTS.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, folder, oracle, name):
    found = spark_rows(QUERIES[name](spark, folder))
    assert difference(found, oracle_rows(oracle, TEXTS[name])) is None


def test_entry_returns_every_period_of_both_environments(spark):
    rows = entry.entry(spark).collect()
    assert {(row.period, row.environment_type) for row in rows} == {
        (period, environment)
        for period in ("day", "week", "month", "ytd", "fiscal_year")
        for environment in ("PROD", "NON-PROD")
    }
