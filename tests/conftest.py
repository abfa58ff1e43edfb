import datetime
import decimal
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from tallyfold.schemas import COST_FACTS  # noqa: E402
from tallyfold.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def facts(spark):
    """Builder of a small fact table: (date, environment, cost, cto, pillar, product id, product)."""

    def build(*rows):
        def fact(day, environment, cost, cto="Tech", pillar="Data", product="P1", name="One"):
            return (
                datetime.date.fromisoformat(day),
                cto,
                "AWS",
                pillar,
                "Core",
                product,
                name,
                "S3",
                environment,
                None if cost is None else decimal.Decimal(str(cost)),
            )

        return spark.createDataFrame([fact(*row) for row in rows], COST_FACTS)

    return build


def rows_of(frame):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=str)
