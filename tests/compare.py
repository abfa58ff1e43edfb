"""Run registered queries in Spark and their oracle texts in DuckDB, and compare the rows.

As a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_on(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time() else value
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sort_key(row):
    return tuple((value is not None, str(round(value, 6) if isinstance(value, float) else value)) for value in row)


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_sort_key)


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    return normalised(frame.columns, [tuple(row) for row in frame.collect()])


def oracle_rows(connection, text: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(text)
    return normalised([column[0] for column in cursor.description], cursor.fetchall())


def _same(left, right) -> bool:
    if isinstance(left, float) or isinstance(right, float):
        if left is None or right is None:
            return left is right
        return math.isclose(left, right, rel_tol=1e-12, abs_tol=1e-12)
    return left == right


def difference(found, expected) -> str | None:
    """None if both results are the same, else what differs first."""
    if found[0] != expected[0]:
        return f"columns {found[0]} instead of {expected[0]}"
    if len(found[1]) != len(expected[1]):
        return f"{len(found[1])} rows instead of {len(expected[1])}"
    for left, right in zip(found[1], expected[1]):
        if not all(_same(a, b) for a, b in zip(left, right)):
            return f"row {left} instead of {right}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tallyfold.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(entry.queries())
    spark = local_session(8)
    connection, texts, builds = duckdb_on(folder), entry.oracle_sql(), entry.queries()
    bad = 0
    for name in names:
        started = time.time()
        try:
            found = spark_rows(builds[name](spark, folder))
            spent = time.time() - started
            verdict = difference(found, oracle_rows(connection, texts[name]))
            exact = verdict is None and found == oracle_rows(connection, texts[name])
        except Exception as error:
            spent, verdict, exact, found = time.time() - started, str(error)[:600], False, ([], [])
        bad += verdict is not None
        print(f"{name:32s} {spent:6.2f}s {len(found[1]):6d} {'exact' if exact else 'close'} {verdict or 'ok'}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
