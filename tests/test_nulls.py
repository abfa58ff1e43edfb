"""Registered queries over random facts with NULLs in every column, against the same oracles."""

import datetime
import decimal
import random

import duckdb
import pytest
from compare import difference, oracle_rows, spark_rows

from tallyfold.catalog import oracle, queries
from tallyfold.plans.dates import within
from tallyfold.schemas import COST_FACTS

ROWS = 4000
# They count rows of the star schema itself.
OF_THE_STAR = {"verify_row_count"}
NAMES = sorted(set(queries.registered()) - OF_THE_STAR)


def random_facts(seed):
    pick = random.Random(seed)

    def maybe(value):
        return None if pick.random() < 0.04 else value

    first = datetime.date(1996, 1, 1)
    for _ in range(ROWS):
        number = pick.randint(1, 40)
        recent = pick.random() < 0.3
        day = datetime.date(1998, 8, 6) - datetime.timedelta(pick.randint(0, 70)) if recent else None
        yield (
            maybe(day or first + datetime.timedelta(pick.randint(0, 1200))),
            maybe(pick.choice(["ASIA", "EUROPE", "AFRICA"])),
            maybe(pick.choice("ANR")),
            maybe(pick.choice(["PROMO", "SMALL", "LARGE"])),
            maybe(f"Brand#{number % 7}"),
            maybe(f"P{number}"),
            maybe(f"name {number % 11}"),
            maybe(pick.choice(["S3", "EC2"])),
            maybe(pick.choice(["PROD", "PROD", "NON-PROD", "PROD-DR", "DEV"])),
            maybe(decimal.Decimal(pick.randint(-20_000, 900_000)) / 10_000),
        )


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """The same facts for Spark and for DuckDB."""
    path = str(tmp_path_factory.mktemp("nulls") / "facts.parquet")
    spark.createDataFrame(random_facts(11), COST_FACTS).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"create table random_facts as select * from '{path}/*.parquet'")
    return spark.read.schema(COST_FACTS).parquet(path), connection


@pytest.mark.parametrize("name", NAMES)
def test_query_over_facts_with_nulls(spark, both, monkeypatch, name):
    facts, connection = both

    def random_star(_spark, _folder, *columns, spans=None):
        kept = facts if spans is None else facts.filter(within(spans))
        return kept.select(*(columns or COST_FACTS.names))

    monkeypatch.setattr(queries, "star_facts", random_star)
    text = oracle.oracle_texts()[name].replace(oracle.FACTS, "\nfacts as (select * from random_facts)")
    found = spark_rows(queries.registered()[name](spark, ""))
    assert difference(found, oracle_rows(connection, text)) is None
