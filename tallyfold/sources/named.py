"""SQL texts by name, run with bound parameters."""

from __future__ import annotations

import re
from importlib import resources
from typing import Any

from pyspark.sql import DataFrame, SparkSession


_FILTERS = ("cto", "pillar", "product")


def query_names() -> list[str]:
    folder = resources.files("tallyfold") / "sql"
    return sorted(entry.name[:-4] for entry in folder.iterdir() if entry.name.endswith(".sql"))


def _parameters(text: str) -> set[str]:
    return set(re.findall(r":(\w+)", text))


def load_query(name: str) -> str:
    """Text of a named query."""
    if name not in query_names():
        raise KeyError(f"no query named {name!r}")
    return (resources.files("tallyfold") / "sql" / f"{name}.sql").read_text(encoding="utf-8")


def named_query(spark: SparkSession, name: str, table: str, **parameters: Any) -> DataFrame:
    """Run a named query on a table or view. Values are bound, never pasted into the text.

    The filters ``cto``, ``pillar`` and ``product`` default to NULL or an empty text, which keep all
    rows. A set filter that the text does not have is an error, as is a parameter that no named
    query has; other parameters of a report may be passed to all of its queries.
    """
    text = load_query(name)
    known = _parameters(text)
    given = {key: value or None if key in _FILTERS else value for key, value in parameters.items()}
    of_any = set().union(*(_parameters(load_query(each)) for each in query_names()))
    refused = sorted(
        key for key, value in given.items() if key not in of_any or (key in _FILTERS and value is not None and key not in known)
    )
    if refused:
        raise ValueError(f"query {name!r} cannot apply {', '.join(refused)}")
    bound = {"table": table, **dict.fromkeys(_FILTERS), **given}
    return spark.sql(text, args={key: value for key, value in bound.items() if key in known})
