"""Declared tables: cost facts, daily averages, budgets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# Column names and declared types of the two tables.
COST_FACT_FIELDS = [
    ("date", "DATE"),
    ("cto", "STRING"),
    ("cloud", "STRING"),
    ("tr_product_pillar_team", "STRING"),
    ("tr_subpillar_name", "STRING"),
    ("tr_product_id", "STRING"),
    ("tr_product", "STRING"),
    ("managed_service", "STRING"),
    ("environment", "STRING"),
    ("cost", "FLOAT"),
]

DAILY_AVERAGE_KEYS = [
    ("date", "DATE"),
    ("environment_type", "STRING"),
    ("cto", "STRING"),
]

BUDGET_FIELDS = [
    ("environment_type", "STRING"),
    ("budget_amount", "FLOAT"),
    ("fiscal_year", "STRING"),
]

# Declared type -> Spark type; every other declared type is read as text.
_SPARK_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "DATE": T.DateType(),
}

# Cost is summed exactly, so facts carry it as a decimal; results are doubles.
MONEY = T.DecimalType(18, 4)


def struct_of(fields: Iterable[tuple[str, str]], money: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Nullable struct for declared ``(name, type)`` pairs; ``money`` overrides single columns."""
    money = money or {}
    return T.StructType(
        [
            T.StructField(name, money.get(name) or _SPARK_TYPES.get(kind.upper(), T.StringType()), True)
            for name, kind in fields
        ]
    )


def struct_from_json(entries: Iterable[Mapping[str, str]], money: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Struct from parsed JSON schema entries of the form ``{"name": ..., "type": ...}``."""
    return struct_of([(entry["name"], entry.get("type", "STRING")) for entry in entries], money)


def daily_average_fields(average_columns: Iterable[str]) -> list[tuple[str, str]]:
    """Declared columns of the daily-average table for one set of fiscal-year columns."""
    return [*DAILY_AVERAGE_KEYS, *((name, "FLOAT") for name in average_columns), ("daily_cost", "FLOAT")]


COST_FACTS = struct_of(COST_FACT_FIELDS, {"cost": MONEY})
COST_FACTS_FLOAT = struct_of(COST_FACT_FIELDS)
BUDGET = struct_of(BUDGET_FIELDS)
